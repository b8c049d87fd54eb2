"""Language-model scores from an interpolated bigram model in Elias-Fano tries.

Counts of all training tokens give smoothed unigram probabilities. The most frequent
words (a bounded table that every task holds) have short numbers; every other word is
known by its 64-bit hash, under a salt that keeps all words of the texts apart. Bigrams of
words are counted over all training text and dealt over shards: two frequent words by
bigram, others by their rare word, the second if both are. A shard stores the first kind as
a trie of Elias-Fano levels with quantised discounted probabilities, the others as an
Elias-Fano sequence with their counts. The probability of w after v is

    (c(v, w) - D) / c(v) + D * followers(v) / c(v) * P(w)    v frequent, or the begin
    (c(v, w) + prior * P(w)) / (c(v) + prior)                v rare

with the smoothed P(w), so all words sum to 1 after any v, with one symbol for unseen
words. The shard of a rare word sees each of its occurrences, so it knows its count: it
gives P(w) where the word comes second, and the divisor where it comes first, which the
logarithm parts from the rest. Documents send their bigrams to the shards. Tokens are
words of the text in ASCII lower case, then one end.

Null and empty texts are one token, the end. Without training text every token counts
as unseen. Rows are told apart by a number given when they are read, so repeated rows
are scored row by row. A null id belongs to the training part. Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voicelane.llm.common import record_batch, slices, small_batches, staged, utf8
from voicelane.llm.eliasfano import BigramTrie, EliasFano

END = b""
#: Class 0 marks the places of rare words, the last one starts a text.
RARE, BEGIN, CLASSES = 0, 65_535, 65_536
#: Hashes of words are not below: smaller numbers are classes before a rare word, or (from
#: ``CLASSES`` on) behind one.
HASHES = 2 * CLASSES


@dataclass(frozen=True)
class Settings:
    #: Words that every task holds, at most; the others are found in the shards.
    frequent: int = 65_000
    #: Weight of the unigram distribution after a rare word, in occurrences.
    prior: float = 2.0
    #: Training tokens per shard, about.
    shard_tokens: int = 4_000_000
    #: Documents whose bigrams travel together.
    bundle: int = 4_000


DEFAULT = Settings()
ENCODED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
    "ids binary, rare binary"
)


def tokens(text: str | None) -> list[bytes]:
    return [*utf8(text).lower().split(), END]


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 1)


def _unpacked(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _packed_long(x: np.ndarray) -> bytes:
    """64-bit numbers, all first bytes before all second ones: most of them are small."""
    return _packed(np.ascontiguousarray(x, np.uint64).view(np.uint8).reshape(-1, 8).T)


def _unpacked_long(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(_unpacked(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _rises(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=np.uint64(0))


def _falls(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.uint64)


def word_hash(word: bytes, salt: bytes) -> int:
    return xxhash.xxh64_intdigest(salt + word, 42)


def salt_of(words: DataFrame) -> bytes:
    """The first salt under which no two words (column ``word``) share a hash."""
    for k in itertools.count():
        salt = b"%d" % k if k else b""
        own = F.xxhash64(F.concat(F.lit(salt), "word"))
        seen = words.agg(
            F.count("*").alias("n"), F.count_distinct(own).alias("hashes"),
            F.count_if(own.between(0, HASHES - 1)).alias("low"),
        ).first()
        if seen["n"] == seen["hashes"] and not seen["low"]:
            return salt


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush():
        rows = [pa.array(list(counts.keys()), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(rows, ["word", "n"])

    for part in slices(batches):
        for text, held in zip(part.column("text").to_pylist(), part.column("held_out").to_pylist(), strict=True):
            if held:
                counts.update(dict.fromkeys(tokens(text), 0))
            else:
                counts.update(tokens(text))
        if len(counts) > 300_000:
            yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n: the tokens of all texts, with their counts in those not held out."""
    parts = texts.select("text", "held_out").mapInArrow(_count, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Unigrams:
    """Totals, frequent words and the constants of smoothing; bounded in size."""

    total: int
    distinct: int
    discount: float
    words: dict[bytes, int]
    counts: np.ndarray

    def probability(self, n):
        """Smoothed probability of a word of count n (0: the symbol for unseen words)."""
        if not self.total:
            return np.ones_like(np.asarray(n, float))
        spread = self.discount * self.distinct / (self.distinct + 1)
        return (np.maximum(np.asarray(n, float) - self.discount, 0) + spread) / self.total

    def base(self, n):
        return np.log10((np.asarray(n, float) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def classes(self) -> np.ndarray:
        """Probability of each frequent word."""
        p = np.zeros(CLASSES)
        p[1 : len(self.counts) + 1] = self.probability(self.counts)
        return p


def unigrams(counts: DataFrame, settings: Settings = DEFAULT) -> Unigrams:
    counts = counts.filter("n > 0")
    # Halved sixteen times per doubling, counts fall into a few hundred levels.
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total, distinct = sum(r["n"] for r in levels), sum(r["words"] for r in levels)
    by = {r["level"]: r["words"] for r in levels}
    once, twice = by.get(0, 0), by.get(16, 0)
    kept, limit = 0, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        if kept + r["words"] > settings.frequent:
            break
        kept, limit = kept + r["words"], r["level"]
    rows = []
    if limit is not None:
        rows = counts.filter(level >= limit).orderBy("word").collect()  # at most `frequent`
    return Unigrams(
        total, distinct, once / (once + 2 * twice) if once else 0.5,
        {bytes(r["word"]): k for k, r in enumerate(rows, 1)}, np.array([r["n"] for r in rows], np.int64),
    )


def _encode(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, salt = shared.value
    base = np.concatenate(([0.0], model.base(model.counts)))
    look, part, n = model.words.get, TaskContext.get().partitionId(), 0
    names = [c.split()[0] for c in ENCODED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
    for own in slices(batches):
        rows = []
        for doc_id, text, held in zip(*[own.column(c).to_pylist() for c in ("doc_id", "text", "held_out")], strict=True):
            words = tokens(text)
            ids = np.fromiter((look(w, RARE) for w in words), np.uint16, len(words))
            rare = np.array([word_hash(words[k], salt) for k in np.flatnonzero(ids == RARE)], np.uint64)
            rows.append((
                part << 40 | n, doc_id, held, len(words), int((ids != RARE).sum()),
                float(base[ids].sum()), ids.tobytes(), rare.tobytes(),
            ))
            n += 1
        yield record_batch(list(zip(*rows, strict=True)), names, types)


def _bigrams(ids: list[bytes], rare: list[bytes]) -> tuple[tuple, tuple]:
    """Bigrams of encoded texts, each with the number of the text it is from.

    First those of two frequent words: key, text. Then the others: hash of a rare word
    (the second, if both are), what is beside it, text. Beside it is the class or hash of
    the word before, or, above ``CLASSES``, the class of a frequent word behind.
    """
    each = [np.frombuffer(x, np.uint16) for x in ids]
    sizes = np.array([len(x) for x in each])
    word = np.concatenate(each).astype(np.uint64)
    word[word == RARE] = np.frombuffer(b"".join(rare), np.uint64)
    before = np.concatenate(([np.uint64(BEGIN)], word[:-1]))
    before[np.cumsum(sizes) - sizes] = BEGIN
    doc = np.repeat(np.arange(len(each)), sizes)
    second, first = word >= HASHES, before >= HASHES
    some = second | first
    key = (before[~some] << np.uint64(16) | word[~some]).astype(np.uint32)
    own = np.where(second, word, before)[some]
    beside = np.where(second, before, word + np.uint64(CLASSES))[some]
    return (key, doc[~some]), (own, beside, doc[some])


def _added(own: np.ndarray, beside: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct pairs in order, and how often each occurs."""
    order = np.lexsort((beside, own))
    own, beside = own[order], beside[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (beside[1:] != beside[:-1])
    times = np.ones(len(own), np.int64) if n is None else n[order].astype(np.int64)
    starts = np.flatnonzero(new)
    return own[new], beside[new], np.add.reduceat(times, starts) if len(starts) else times


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % shards


def _by_shard(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    """Places of each shard, in order."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    return [order[a:b] for a, b in itertools.pairwise(cuts)]


_TRAIN = ("shard", "keys", "counts", "own", "beside", "times")


def _train_bundles(shards: int, bundle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted bigrams of many texts, a row per shard."""
    for batch in batches:
        for at in range(0, batch.num_rows, bundle):
            part = batch.slice(at, bundle)
            (key, _), (own, beside, _) = _bigrams(part.column("ids").to_pylist(), part.column("rare").to_pylist())
            key, n = np.unique(key, return_counts=True)
            own, beside, times = _added(own, beside)
            dealt = zip(_by_shard(_shard(key, shards), shards), _by_shard(_shard(own, shards), shards), strict=True)
            rows = [
                (
                    k, _packed(np.diff(key[o], prepend=np.uint32(0))), _packed(n[o].astype(np.uint32)),
                    _packed_long(_rises(own[r])), _packed_long(beside[r]), _packed(times[r].astype(np.uint32)),
                )
                for k, (o, r) in enumerate(dealt) if len(o) or len(r)
            ]
            yield _shard_batch(rows, _TRAIN, [pa.int64(), *[pa.binary()] * 5])


def _shard_batch(rows, names, types) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], list(names))


def _keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint32), dtype=np.uint32)


@dataclass
class RareWords:
    """A shard's rare words: their counts, and those of their bigrams."""

    words: np.ndarray
    counts: np.ndarray
    besides: np.ndarray
    pairs: EliasFano
    times: np.ndarray

    @classmethod
    def of(cls, own: np.ndarray, beside: np.ndarray, times: np.ndarray) -> RareWords:
        """From distinct pairs in order; each occurrence of a word has one word before."""
        words, word = np.unique(own, return_inverse=True)
        besides, place = np.unique(beside, return_inverse=True)
        pairs = EliasFano.of(word * len(besides) + place, max(len(words) * len(besides), 1))
        return cls(words, np.bincount(word, np.where(_is_before(beside), times, 0), len(words)), besides, pairs, times)

    def row(self) -> dict:
        return {
            "words": _packed_long(_rises(self.words)), "counts": _packed(self.counts.astype(np.int64)),
            "besides": _packed_long(_rises(self.besides)), "pairs": vars(self.pairs),
            "times": _packed(self.times.astype(np.int64)),
        }

    @classmethod
    def read(cls, row) -> RareWords:
        return cls(
            _falls(_unpacked_long(row["words"])), _unpacked(row["counts"], np.int64),
            _falls(_unpacked_long(row["besides"])), _opened(row["pairs"]).open(), _unpacked(row["times"], np.int64),
        )

    def look(self, own: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the words and of the pairs; 0 where there is none."""
        if not len(self.words):
            return np.zeros(len(own)), np.zeros(len(own))
        word, known = _place(self.words, own)
        place, met = _place(self.besides, beside)
        at, found = self.pairs.successor(word * len(self.besides) + place)
        found &= known & met
        return np.where(known, self.counts[word], 0), np.where(found, self.times[np.where(found, at, 0)], 0)


def _is_before(beside: np.ndarray) -> np.ndarray:
    return (beside < CLASSES) | (beside >= HASHES)


def _place(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return at, table[at] == x


def _opened(row) -> EliasFano:
    # Beside rows without a level pandas holds its numbers as floats.
    return EliasFano(int(row["n"]), int(row["low_bits"]), bytes(row["low"]), bytes(row["high"]))


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    """All counts of one shard, bounded by the tokens of a shard."""
    key = np.concatenate([_keys(x) for x in pdf["keys"]])
    n = np.concatenate([_unpacked(x, np.uint32) for x in pdf["counts"]])
    key, inverse = np.unique(key, return_inverse=True)
    n = np.bincount(inverse, n).astype(np.int64)
    own, beside, times = _added(
        np.concatenate([_falls(_unpacked_long(x)) for x in pdf["own"]]),
        np.concatenate([_unpacked_long(x) for x in pdf["beside"]]),
        np.concatenate([_unpacked(x, np.uint32) for x in pdf["times"]]),
    )
    led = beside < CLASSES  # rare words behind frequent ones
    context = np.concatenate([key >> 16, beside[led].astype(np.uint32)])
    each = np.concatenate([n, times[led]])
    context, inverse = np.unique(context, return_inverse=True)
    stats = {
        "context": context.astype(np.int64).tolist(),
        "followers": np.bincount(inverse, minlength=len(context)).tolist(),
        "total": np.bincount(inverse, each, len(context)).astype(np.int64).tolist(),
    }
    return pd.DataFrame({
        "shard": [int(pdf["shard"].iloc[0])],
        "keys": [_packed(np.diff(key, prepend=np.uint32(0)))], "counts": [_packed(n)],
        "once": [int((each == 1).sum())], "twice": [int((each == 2).sum())],
        "stats": [[dict(zip(stats, x, strict=True)) for x in zip(*stats.values(), strict=True)]],
        "rare": [RareWords.of(own, beside, times).row()],
    })


_LEVEL = "struct<n:bigint,low_bits:int,low:binary,high:binary>"
RARE_WORDS = f"struct<words:binary,counts:binary,besides:binary,pairs:{_LEVEL},times:binary>"
SHARDS = (
    "shard bigint, keys binary, counts binary, once bigint, twice bigint, "
    f"stats array<struct<context:bigint,followers:bigint,total:bigint>>, rare {RARE_WORDS}"
)
_LEVELS = ("contexts", "pointers", "successors")
TRIES = "shard bigint, " + ", ".join(
    f"{k} {_LEVEL}" for k in _LEVELS
) + ", codes binary, book binary"


@dataclass
class Smoothing:
    """Per context: what absolute discounting leaves, and the count. Bounded tables."""

    discount: float
    total: np.ndarray
    backoff: np.ndarray


def _build(shared, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    smooth: Smoothing = shared.value
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            key, n = _keys(row.keys), _unpacked(row.counts, np.int64)
            context, word = (key >> 16).astype(np.int64), (key & 0xFFFF).astype(np.int64)
            trie = BigramTrie.of(context, word, (n - smooth.discount) / smooth.total[context], CLASSES)
            levels = {k: [vars(getattr(trie, k))] for k in _LEVELS}
            yield pd.DataFrame({"shard": [row.shard], **levels, "codes": [trie.codes], "book": [trie.book]})


def _query_bundles(shards: int, bundle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams of many texts, a row per shard: bigrams in order, and the text of each."""
    for batch in batches:
        numbers = batch.column("row").to_numpy()
        # A bundle is a run of consecutive rows, named by the first and its size.
        cuts = [0, *(np.flatnonzero(np.diff(numbers) != 1) + 1).tolist(), len(numbers)]
        runs = [
            (k, min(k + bundle, stop))
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True) for k in range(start, stop, bundle)
        ]
        for start, stop in runs:
            part = batch.slice(start, stop - start)
            (key, doc), (own, beside, near) = _bigrams(part.column("ids").to_pylist(), part.column("rare").to_pylist())
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order].astype(np.uint16)
            order = np.lexsort((beside, own))
            own, beside, near = own[order], beside[order], near[order].astype(np.uint16)
            dealt = zip(_by_shard(_shard(key, shards), shards), _by_shard(_shard(own, shards), shards), strict=True)
            rows = [
                (
                    k, int(numbers[start]), stop - start,
                    _packed(np.diff(key[o], prepend=np.uint32(0))), _packed(doc[o]),
                    _packed_long(_rises(own[r])), _packed_long(beside[r]), _packed(near[r]),
                )
                for k, (o, r) in enumerate(dealt) if len(o) or len(r)
            ]
            yield _shard_batch(rows, _QUERIES, [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5])


_QUERIES = ("shard", "bundle", "size", "keys", "docs", "own", "beside", "near")
QUERIES = "shard bigint, bundle bigint, size int, keys binary, docs binary, own binary, beside binary, near binary"


def _frequent_logs(key: np.ndarray, trie: BigramTrie | None, smooth: Smoothing, classes: np.ndarray) -> np.ndarray:
    """log10 probabilities of sorted bigrams of frequent words."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    own = key[new]
    context, word = (own >> 16).astype(np.int64), (own & 0xFFFF).astype(np.int64)
    p = smooth.backoff[context] * classes[word]
    if trie is not None:
        p = p + trie.value(context, word)
    return np.log10(np.maximum(p, 1e-300))[np.cumsum(new) - 1]


def _rare_logs(
    own: np.ndarray, beside: np.ndarray, rare: RareWords | None, smooth: Smoothing, classes: np.ndarray,
    model: Unigrams, prior: float, end: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 probabilities of bigrams with a rare word, its base score and whether it is known.

    Where the rare word comes second, the divisor of the bigram that it begins is taken too.
    """
    n, times = rare.look(own, beside) if rare else (np.zeros(len(own)), np.zeros(len(own)))
    p, second, led = model.probability(n), _is_before(beside), beside < CLASSES
    context = np.where(led, beside, 0).astype(np.int64)
    behind = np.where(second, 0, beside - np.uint64(CLASSES)).astype(np.int64)
    after = np.maximum(times - smooth.discount, 0) / np.maximum(smooth.total[context], 1) + smooth.backoff[context] * p
    mixed = times + prior * np.where(second, p, classes[behind])
    logs = np.log10(np.maximum(np.where(led, after, mixed), 1e-300))
    logs = logs - np.where(second & (own != np.uint64(end)), np.log10(n + prior), 0.0)
    return logs, np.where(second, model.base(n), 0.0), second & (n > 0)


def _ask(shared, queries: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
    """log10 probabilities of one shard's bigrams, added up by text of a bundle."""
    smooth, classes, model, prior, end = shared.value
    trie = rare = None
    for _, row in tries.iterrows():
        if row["rare"] is not None:
            rare = RareWords.read(row["rare"])
        else:
            trie = BigramTrie(
                *[_opened(row[k]) for k in _LEVELS], bytes(row["codes"]), bytes(row["book"]), CLASSES
            ).open()
    sums = []
    for q in queries.itertuples(index=False):
        logs = _frequent_logs(_keys(q.keys), trie, smooth, classes)
        pairs = np.bincount(_unpacked(q.docs, np.uint16), logs, q.size)
        near = _unpacked(q.near, np.uint16)
        logs, base, known = _rare_logs(
            _falls(_unpacked_long(q.own)), _unpacked_long(q.beside), rare, smooth, classes, model, prior, end
        )
        each = [pairs + np.bincount(near, logs, q.size), *[np.bincount(near, x, q.size) for x in (base, known)]]
        sums.append(_packed(np.stack(each)))
    return pd.DataFrame({"bundle": queries["bundle"].to_numpy(), "sums": sums})


def _sum_bundle(pdf: pd.DataFrame) -> pd.DataFrame:
    pairs, base, known = np.sum([_unpacked(x, np.float64).reshape(3, -1) for x in pdf["sums"]], axis=0)
    row = int(pdf["bundle"].iloc[0]) + np.arange(len(pairs))
    return pd.DataFrame({"row": row, "pairs": pairs, "rare_base": base, "rare_known": known.astype(np.int64)})


def score(docs: DataFrame, held_out: Column | str, settings: Settings = DEFAULT) -> DataFrame:
    """Score all rows with a model of the rows where ``held_out`` is not true.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    rows = small_batches(docs).select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    counts = staged(word_counts(rows), "lm-counts")
    model, salt = unigrams(counts, settings), salt_of(counts)
    encoded = staged(
        rows.mapInArrow(functools.partial(_encode, send((model, salt))), ENCODED), "lm-texts"
    )
    shards = max(8, -(-model.total // settings.shard_tokens))
    bundles = encoded.filter("not held_out").select("ids", "rare").mapInArrow(
        functools.partial(_train_bundles, shards, settings.bundle),
        "shard bigint, " + ", ".join(f"{c} binary" for c in _TRAIN[1:]),
    )
    counted = staged(bundles.groupBy("shard").applyInPandas(_add_up, SHARDS), "lm-shards")
    stats = (
        counted.select(F.explode("stats").alias("s")).groupBy("s.context")
        .agg(F.sum("s.followers").alias("followers"), F.sum("s.total").alias("total"))
        .collect()  # one row per class at most
    )
    seen = counted.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    once, twice = seen["once"] or 0, seen["twice"] or 0
    discount = once / (once + 2 * twice) if once and twice else 0.5
    total, backoff = np.zeros(CLASSES), np.ones(CLASSES)
    for r in stats:
        total[r["context"]] = r["total"]
        backoff[r["context"]] = discount * r["followers"] / r["total"]
    smooth = Smoothing(discount, total, backoff)
    tries = staged(
        counted.select("shard", "keys", "counts").mapInPandas(functools.partial(_build, send(smooth)), TRIES),
        "lm-tries",
    )
    # A shard's rare words need no smoothing by the driver: they are read where they were counted.
    pieces = tries.withColumn("rare", F.lit(None).cast(RARE_WORDS)).unionByName(
        counted.select("shard", "rare"), allowMissingColumns=True
    )
    shared = smooth, model.classes(), replace(model, words={}), settings.prior, word_hash(END, salt)
    queries = encoded.select("row", "ids", "rare").mapInArrow(
        functools.partial(_query_bundles, shards, settings.bundle), QUERIES
    )
    asked = queries.groupBy("shard").cogroup(pieces.groupBy("shard")).applyInPandas(
        functools.partial(_ask, send(shared)), "bundle bigint, sums binary"
    )
    sums = asked.groupBy("bundle").applyInPandas(
        _sum_bundle, "row bigint, pairs double, rare_base double, rare_known bigint"
    )
    return (
        encoded.drop("ids", "rare").join(sums, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens",
            (F.col("known") + F.col("rare_known")).cast("bigint").alias("n_known"),
            F.lit(model.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + F.col("rare_base")).alias("base_score"),
            F.col("pairs").alias("score"),
        )
    )
