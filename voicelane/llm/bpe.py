"""BPE encoding and decoding by prefix sharing.

A piece of text (a run of letters, one digit, a run of signs) is a sequence of byte
symbols whose last symbol carries the word end. For every prefix of a piece the
encoding is known from its last token alone: what stands before that token is again
the encoding of a prefix. So the distinct pieces of a batch are put in order, which
is the depth-first order of their trie; walking it, the last token of each prefix is
found once and shared by all pieces with that prefix. Among the tokens that end at a
place, the right one is the one that the token before it may stand next to.

Null and empty texts have no tokens and decode to the empty text. Repeated rows are
encoded row by row; extra columns are ignored by ``encode`` and kept by ``attach``.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicelane.llm.common import slices, small_batches

#: Pieces that a worker remembers in each of two generations.
CACHE_PIECES = 60_000
#: Texts encoded at a time: the more, the more prefixes their new pieces share.
TEXTS_AT_ONCE = 500
#: Pairs of tokens whose answer a task remembers.
CACHE_PAIRS = 250_000
NEVER = 1 << 60
#: Bytes at the end of a prefix that preselect the lengths of candidates.
TAIL = 4
#: Lengths to try where no token ends with the whole tail.
SHORT = tuple(range(TAIL - 1, 0, -1))

_PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
)
#: The same in ASCII text in lower case.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")


def byte_of_char() -> dict[str, int]:
    """The printable stand-in characters of bytes in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens and merges of a tokenizer file, prepared for the walk."""

    def __init__(self, definition: str):
        data = json.loads(definition)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for text, k in [*ids.items(), *self.special.items()]:
            self.tokens[k] = text
        if self.special:
            marks = "|".join(sorted(map(regex.escape, self.special), key=len, reverse=True))
            self.split_special = regex.compile(f"({marks})")
        self.merge: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int]] = {}
        made_at: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = ids[a], ids[b], ids[a + b]
            if max(made_at.get(left, -1), made_at.get(right, -1)) >= rank or whole in parts:
                raise ValueError("merges must build each token once, from earlier tokens")
            self.merge[left, right] = rank
            parts[whole], made_at[whole] = (left, right), rank
        self.parts, self.made_at = parts, made_at
        sound: dict[int, bool] = {}
        for k in sorted(ids.values(), key=lambda k: made_at.get(k, -1)):
            a, b = parts.get(k, (None, None))
            sound[k] = a is None or (sound[a] and sound[b] and self._first_join(a, b) == made_at[k])
        to_byte = byte_of_char()
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for text, k in ids.items():
            ends = bool(self.end) and text.endswith(self.end)
            body = text[: -len(self.end)] if ends else text
            if sound[k] and all(c in to_byte for c in body):
                table = self.final if ends or not self.end else self.inner
                table[bytes(to_byte[c] for c in body)] = k
        if not self.end:
            self.inner = self.final
        self.sizes_inner = _sizes_by_tail(self.inner)
        self.sizes_final = _sizes_by_tail(self.final)
        self.beside: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at a token's edge while it is being built, each with the rank
        at which it goes into something larger."""
        edge, until = [], NEVER
        while True:
            edge.append((token, until))
            if token not in self.parts:
                return edge
            until = self.made_at[token]
            token = self.parts[token][side]

    def _first_join(self, a: int, b: int) -> int:
        """Rank of the first merge across the border of two tokens; NEVER if none.

        Merges happen in the order of their ranks, equal ones from the left. The
        merge of x and y happens if, when its turn comes, x still is what the left
        token shows at the border and y what the right one shows.
        """
        first, left_edge = NEVER, self._edge(b, 0)
        for x, x_until in self._edge(a, 1):
            for y, y_until in left_edge:
                rank = self.merge.get((x, y), NEVER)
                if rank < first and rank < x_until and rank <= y_until:
                    first = rank
        return first

    def may_stand(self, a: int, b: int) -> bool:
        """Whether the encoding of two tokens' text is these two tokens."""
        if len(self.beside) > CACHE_PAIRS:
            self.beside.clear()
        known = self.beside[a << 32 | b] = self._first_join(a, b) == NEVER
        return known

    def encode_pieces(self, pieces: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct pieces, walking their trie depth first.

        ``last`` has the last token of each prefix of the piece at hand, and ``start``
        where that token begins; what a piece shares with the one before stays.
        """
        found, last, start, before = {}, [0], [0], b""
        beside = self.beside
        for piece in sorted(pieces):
            whole = self.final.get(piece)
            if whole is not None:
                found[piece] = [whole]
                continue
            size = len(piece)
            shared, most = 0, min(len(before), size) - 1
            while shared < most and before[shared] == piece[shared]:
                shared += 1
            del last[shared + 1 :], start[shared + 1 :]
            table, sizes = self.inner, self.sizes_inner
            for n in range(shared + 1, size + 1):
                if n == size:
                    table, sizes = self.final, self.sizes_final
                # Candidates end here; the longest that may stand is the last token.
                for length in sizes.get(piece[n - TAIL if n > TAIL else 0 : n], SHORT):
                    at = n - length
                    if at < 0:
                        continue
                    token = table.get(piece[at:n])
                    if token is None:
                        continue
                    if not at:
                        break
                    stands = beside.get(last[at] << 32 | token)
                    if stands or stands is None and self.may_stand(last[at], token):
                        break
                last.append(token)
                start.append(at)
            ids, n = [], size
            while n:
                ids.append(last[n])
                n = start[n]
            ids.reverse()
            found[piece] = ids
            before = piece
        return found


def _sizes_by_tail(table: dict[bytes, int]) -> dict[bytes, list[int]]:
    """Lengths of the tokens that can end with a tail of up to TAIL bytes, longest first."""
    sizes: dict[bytes, set[int]] = {}
    for body in table:
        for k in range(1, min(len(body), TAIL) + 1):
            sizes.setdefault(body[-k:], set()).add(len(body))
    # A longer tail also ends with tokens that are shorter than it.
    whole = {
        tail: own | {len(tail[k:]) for k in range(1, len(tail)) if tail[k:] in table}
        for tail, own in sizes.items()
    }
    return {tail: sorted(own, reverse=True) for tail, own in whole.items()}


def normalised(word: str) -> str:
    """NFC and lower case, character by character (no special final sigma)."""
    if word.isascii():
        return word.lower()
    return unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()


def pieces_of(text: str) -> list[str]:
    """The pieces of a text without special tokens; none crosses white space."""
    if text.isascii():
        return _ASCII_PIECES.findall(text.lower())
    return _PIECES.findall(normalised(text))


class Memory:
    """Remembers what was asked for lately.

    When the young generation is full it becomes the old one, whose entries live on if
    they are asked for again; so frequent words stay and rare ones go.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: Iterable) -> list:
        """Keys that are not known; known ones become young."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old, unknown = self.young, self.old, []
        for key in keys:
            if key not in young:
                value = old.get(key)
                if value is None:
                    unknown.append(key)
                else:
                    young[key] = value
        return unknown


class Numbers(dict):
    """Pieces numbered as they come."""

    def __missing__(self, piece: str | int) -> int:
        number = self[piece] = len(self)
        return number


class Encoder:
    """Encodes texts; distinct pieces are encoded once."""

    def __init__(self, definition: str):
        self.vocab = Vocabulary(definition)
        #: Ids and decoded text of pieces; a special token is named by its id.
        self.known = Memory(CACHE_PIECES)
        self.marks = {c[0] for c in self.vocab.special}

    def split(self, text: str | None) -> list[str | int]:
        """The pieces of a text, and the ids of special tokens between them."""
        if not text:
            return []
        if not any(c in text for c in self.marks):
            return pieces_of(text)
        parts: list[str | int] = []
        for k, part in enumerate(self.vocab.split_special.split(text)):
            if k % 2:
                parts.append(self.vocab.special[part])
            else:
                parts += pieces_of(part)
        return parts

    def learn(self, pieces: Iterable[str | int]) -> None:
        """Encode pieces not known yet."""
        new = self.known.missing(pieces)
        spelt = {p: p.encode("utf-8", "surrogatepass") for p in new if isinstance(p, str)}
        ids = self.vocab.encode_pieces(spelt.values())
        for piece in new:
            own = ids[spelt[piece]] if piece in spelt else [piece]
            self.known.young[piece] = own, self.decode(own)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Offsets and ids of all texts, and the texts decoded from the ids.

        Pieces are numbered first; ids are gathered by number for the whole slice, and
        what a piece decodes to is joined as it is.
        """
        split = list(map(self.split, texts))
        numbers = Numbers()
        codes = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        self.learn(numbers)
        entries = [self.known.young[p] for p in numbers]
        sizes = np.fromiter((len(ids) for ids, _ in entries), np.int64, len(entries))
        pool = np.fromiter(chain.from_iterable(ids for ids, _ in entries), np.int32, sizes.sum())
        starts = np.cumsum(sizes) - sizes
        spread = sizes[codes]
        ends = np.cumsum(spread)
        ids = pool[np.repeat(starts[codes] - (ends - spread), spread) + np.arange(spread.sum())]
        offsets = np.concatenate(([0], ends))[np.cumsum([0, *map(len, split)])]
        shown = dict(zip(numbers, (text for _, text in entries), strict=True))
        decoded = [" ".join(filter(None, map(shown.__getitem__, pieces))) for pieces in split]
        return offsets, ids, decoded

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by blanks, as the file names no decoder; unknown ids are left out."""
        tokens = self.vocab.tokens
        return " ".join([t for k in ids if 0 <= k < len(tokens) and (t := tokens[k])])


@functools.lru_cache(maxsize=1)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def _encode_batches(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(shared.value)
    for part in slices(batches, TEXTS_AT_ONCE):
        offsets, ids, decoded = encoder.encode(part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                pa.array(decoded, pa.string()),
            ],
            ["doc_id", "ids", "decoded"],
        )


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from the ids, for every row.

    ``path`` names a tokenizer file that the driver reads; it is sent to the tasks
    (a file of a few MB). No shuffle: each task shares prefixes among its own words.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(
        functools.partial(_encode_batches, shared), "doc_id bigint, ids array<int>, decoded string"
    )


def _decode_batches(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(shared.value)
    for batch in batches:
        texts = [encoder.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "decoded"]
        )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text of rows with ids; null ids decode to the empty text."""
    with open(path, encoding="utf-8") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    rows = encoded.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(functools.partial(_decode_batches, shared), "doc_id bigint, decoded string")
