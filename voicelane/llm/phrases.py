"""Phrases whose words belong together, mined best first by branch and bound.

A phrase of 2 to 4 words with a count ``a`` scores, at its weakest cut into a first
part of count ``l`` and a rest of count ``r``, ``2,000,000 a / (l + r)``. A phrase never
occurs more often than what it begins with, and its rest at least as often as itself,
so no phrase that begins with q can score more than ``2,000,000 f(q) / (f(w1) + f(q))``,
where w1 is the first word of q. This bound needs nothing but counts of prefixes.

Words, then pairs of words that are frequent themselves, are counted once. Then each
language has a level t: the bound of a frontier that holds some more pairs than results
are wanted. Prefixes with a bound of t or more are grown to three and four words; so are,
to the left, phrases that score t or more, because a phrase goes if a longer one around
it occurs nearly as often. (It is enough to look one word further: any longer phrase
around it holds one of those, which occurs at least as often.) As no other phrase can
reach t, a language is settled if enough phrases that score t or more survive, ties
included; the others go on with a frontier four times as large, in the end with all.

Texts are split into words by tasks; sets of prefixes reach them as bitmaps of fixed
size, which never miss a member, and every count is put right by an exact join. Within
a task equal phrases are added up before the shuffle.

Null and empty texts have no words; a null language is ``und``. Each row counts, also a
repeated one. Extra columns are ignored. An empty table has no phrases.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.llm.common import small_batches, staged, utf8
from voicelane.llm.shingles import mixed


@dataclass(frozen=True)
class Settings:
    top: int = 2000
    min_count: int = 30
    #: Percent of a phrase's occurrences from which a longer phrase replaces it.
    cover: int = 80
    #: Pairs in the first frontier, as a multiple of ``top``; four times more each round.
    frontier: int = 4


DEFAULT = Settings()
SCALE = 2_000_000
LONGEST = 4
#: Bits of the bitmap that stands for a set of phrases (4 MB).
BITS = 1 << 25
#: Languages whose names are sent to all tasks, to pass over settled ones.
BROADCAST_LANGS = 10_000
#: Bytes of text that a task counts at a time.
AT_ONCE = 4 << 20

_END = b"."
_PIECES = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 9 else _END[0] if b in b".,;:!?\n\x0b\x0c\r" else b
    for b in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_COUNTED = "lang string, phrase string, n bigint"


class Numbers(dict):
    """Words numbered as they come; number 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(utf8(lang))


def _hash(words: list[bytes], lang: str) -> np.ndarray:
    seed = _seed(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _joined(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its prefix and that of its last word."""
    return mixed(before * _STEP + word)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
            hashes = _hash(utf8(phrase).split(b" "), lang)
            h = hashes[:1]
            for k in range(1, len(hashes)):
                h = _joined(h, hashes[k : k + 1])
            out.append(int(h[0] % np.uint64(BITS)) + 1)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["slot"])


def bitmap(phrases: DataFrame):
    """The set of phrases (lang, phrase) as a broadcast bitmap of fixed size."""
    slots = phrases.select("lang", "phrase").mapInArrow(_slots, "slot bigint")
    rows = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    ).collect()  # at most BITS / 32,768 rows of 4 KB
    whole = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        bits = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * 4096
        whole[at : at + len(bits)] = bits
    return phrases.sparkSession.sparkContext.broadcast(whole)


def _member(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes % np.uint64(BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


@dataclass(frozen=True)
class Wanted:
    """Which phrases of ``size`` words to count; sets are broadcast bitmaps or None.

    Of two words: both in ``inner``. Of more: each pair in ``inner``, and the first words
    in ``prefixes``, or the last words in ``suffixes``, or the phrase in ``whole``.
    """

    size: int
    inner: object = None
    prefixes: object = None
    suffixes: object = None
    whole: object = None


def _distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers below ``size``, in order, and their counts."""
    bits = max((size - 1).bit_length(), 1)
    if bits * len(columns) <= 64:  # a row fits one number, which sorts fast
        key = columns[0].astype(np.uint64)
        for column in columns[1:]:
            key = key << np.uint64(bits) | column.astype(np.uint64)
        key, n = np.unique(key, return_counts=True)
        shifts = [np.uint64(bits * k) for k in reversed(range(len(columns)))]
        return [(key >> k & np.uint64((1 << bits) - 1)).astype(np.int64) for k in shifts], n
    key = columns[0]
    for k, column in enumerate(columns[1:]):
        if k:
            key = np.unique(key, return_inverse=True)[1]
        key = key << 32 | column
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [column[first] for column in columns], n


def _phrases(wanted: Wanted, lang: str, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Distinct wanted phrases of some texts of a language, and their counts."""
    joined = (b" " + _END + b" ").join(texts).translate(_PIECES)
    tokens = joined.replace(_END, b" " + _END + b" ").split(b" ")
    numbers = Numbers({_END: 0, b"": 1})
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    ids = ids[ids != 1]
    words = list(numbers)
    if wanted.size == 1:
        n = np.bincount(ids, minlength=len(words))
        use = np.flatnonzero(n[2:]) + 2
        found = pa.array([b"", *[words[k] for k in use]], pa.string())
        return found, np.concatenate(([n[2:].sum()], n[use]))
    hashes = _hash(words, lang)
    good = np.ones(len(words), bool)
    if wanted.size == 2:
        good = _member(wanted.inner.value, hashes)
    good[:2] = False
    places = np.arange(max(len(ids) - wanted.size + 1, 0))
    for k in range(wanted.size):
        places = places[good[ids[places + k]]]
    if wanted.size > 2:
        if wanted.inner is not None:
            for k in range(wanted.size - 1):
                pair = _joined(hashes[ids[places + k]], hashes[ids[places + k + 1]])
                places = places[_member(wanted.inner.value, pair)]

        def run(first: int, stop: int) -> np.ndarray:
            h = hashes[ids[places + first]]
            for k in range(first + 1, stop):
                h = _joined(h, hashes[ids[places + k]])
            return h

        use = np.zeros(len(places), bool)
        for bits, first, stop in (
            (wanted.prefixes, 0, wanted.size - 1), (wanted.suffixes, 1, wanted.size), (wanted.whole, 0, wanted.size),
        ):
            if bits is not None:
                use |= _member(bits.value, run(first, stop))
        places = places[use]
    columns, n = _distinct([ids[places + k] for k in range(wanted.size)], len(words))
    spelt = pa.array(words, pa.string())
    return pc.binary_join_element_wise(*[spelt.take(pa.array(c)) for c in columns], " "), n


def _count(wanted: Wanted, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size = 0

    def flush():
        for lang, texts in held.items():
            phrases, n = _phrases(wanted, lang, texts)
            if len(phrases):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(n, pa.int64())],
                    ["lang", "phrase", "n"],
                )
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = utf8(text)
            held.setdefault(lang, []).append(own)
            size += len(own)
            if size >= AT_ONCE:
                yield from flush()
                size = 0
    yield from flush()


def counted(texts: DataFrame, wanted: Wanted, settings: Settings, name: str) -> DataFrame:
    """lang, phrase, n of the wanted phrases that are frequent enough (lang, text).

    Of single words there is also the empty phrase, with the number of all words.
    """
    parts = texts.select("lang", "text").mapInArrow(functools.partial(_count, wanted), _COUNTED)
    sums = parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return staged(sums.filter((F.col("n") >= settings.min_count) | (F.col("phrase") == "")), name)


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(SCALE a / (l + r)) in exact numbers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(a) * F.lit(SCALE).cast("decimal(7,0)"), wide(l) + wide(r))


def _parts(phrase: str = "phrase") -> tuple[Column, Column]:
    """A phrase without its last word, and without its first word."""
    words = F.split(phrase, " ")
    return (
        F.array_join(F.slice(words, 1, F.size(words) - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "),
    )


def _weakest(cuts: list[tuple[Column, Column]], a: Column) -> Column:
    """score, k, l, r of the cut that scores least; ties go to the smallest k."""
    each = [
        F.struct(_score(a, l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
        for k, (l, r) in enumerate(cuts, 1)  # noqa: E741
    ]
    return F.least(*each) if len(each) > 1 else each[0]


_COLUMNS = ["lang", "phrase", "a", "f1", "bound", "score", "l", "r"]


def _scored(df: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """_COLUMNS: with the weakest cut and the bound of everything that begins alike."""
    weakest = _weakest([(F.col(x), F.col(y)) for x, y in cuts], F.col("a"))
    return df.withColumn("s", weakest).select(
        "lang", "phrase", "a", "f1", _score(F.col("a"), F.col("f1"), F.col("a")).alias("bound"),
        "s.score", "s.l", "s.r", *[c for c in ("f_last", "prefix", "suffix") if c in df.columns],
    )


def _two(pairs: DataFrame, words: DataFrame) -> DataFrame:
    first, last = _parts()
    one = words.select("lang", F.col("phrase").alias("prefix"), F.col("n").alias("f1"))
    two = words.select("lang", F.col("phrase").alias("suffix"), F.col("n").alias("f_last"))
    split = pairs.select("lang", "phrase", F.col("n").alias("a"), first.alias("prefix"), last.alias("suffix"))
    return _scored(split.join(one, ["lang", "prefix"]).join(two, ["lang", "suffix"]), [("f1", "f_last")])


def _three(found: DataFrame, pairs: DataFrame) -> DataFrame:
    first, last = _parts()
    split = found.select("lang", "phrase", F.col("n").alias("a"), first.alias("prefix"), last.alias("suffix"))
    one = pairs.select("lang", F.col("phrase").alias("prefix"), F.col("a").alias("f12"), "f1")
    two = pairs.select("lang", F.col("phrase").alias("suffix"), F.col("a").alias("f23"), "f_last")
    met = split.join(one, ["lang", "prefix"]).join(two, ["lang", "suffix"])
    return _scored(met, [("f1", "f23"), ("f12", "f_last")])


def _four(found: DataFrame, triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Phrases of four words; f234 is null where the last three words are not counted yet."""
    first, last = _parts()
    split = found.select("lang", "phrase", F.col("n").alias("a"), first.alias("prefix"), last.alias("suffix"))
    split = split.withColumns({"head": _parts("prefix")[0], "tail": _parts("suffix")[1]})
    one = triples.select("lang", F.col("phrase").alias("prefix"), F.col("a").alias("f123"), "f1")
    head = pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("f12"))
    tail = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("f34"), "f_last")
    two = triples.select("lang", F.col("phrase").alias("suffix"), F.col("a").alias("f234"))
    met = split.join(one, ["lang", "prefix"]).join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
    return met.join(two, ["lang", "suffix"], "left")


def _four_scored(met: DataFrame) -> DataFrame:
    return _scored(met, [("f1", "f234"), ("f12", "f34"), ("f123", "f_last")])


def levels(pairs: DataFrame, langs: DataFrame, size: int) -> DataFrame:
    """lang, t: the score that ``size`` pairs reach; 0 for languages with fewer pairs."""
    by_score = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    # At most SCALE / 2 scores in a language, so the window is bounded.
    running = F.sum("n").over(W.partitionBy("lang").orderBy(F.desc("score")))
    reached = (
        by_score.withColumn("so_far", running).filter(F.col("so_far") >= size)
        .groupBy("lang").agg(F.max("score").alias("t"))
    )
    return langs.select("lang").join(reached, "lang", "left").fillna(0, ["t"])


def _survivors(open_: DataFrame, longer: DataFrame, settings: Settings) -> DataFrame:
    """Phrases that no phrase one word longer (lang, phrase, n) covers."""
    first, last = _parts()
    around = longer.select("lang", F.explode(F.array(first, last)).alias("phrase"), F.col("n").alias("f"))
    most = around.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    covered = open_.join(most, ["lang", "phrase"], "left")
    return covered.filter(F.col("f").isNull() | (100 * F.col("f") < settings.cover * F.col("a"))).drop("f")


def mine(docs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best surviving phrases of each language."""
    texts = small_batches(docs).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = counted(texts, Wanted(1), settings, "phrase-words")
    totals = words.filter("phrase = ''").select("lang", "n")
    words = words.filter(f"phrase <> '' and n >= {settings.min_count}")
    inner = bitmap(words)
    pairs = counted(texts, Wanted(2, inner=inner), settings, "phrase-pairs")
    pairs = staged(_two(pairs, words), "phrase-pairs")
    inner.unpersist()
    frequent = bitmap(pairs)
    done, langs, size = None, totals.select("lang"), settings.frontier * settings.top
    while True:
        found, counts = _round(texts, pairs, frequent, levels(pairs, langs, size), settings)
        # A language is settled with enough survivors, or when its whole frontier is open.
        settled = counts.filter((F.col("n") >= settings.top) | (F.col("t") == 0)).select("lang")
        own = found.join(settled, "lang", "left_semi")
        done = own if done is None else done.union(own)
        langs = staged(counts.filter((F.col("n") < settings.top) & (F.col("t") > 0)).select("lang"), "phrase-langs")
        if not langs.limit(1).count():
            break
        size *= 4
    return _ranked(done, totals, settings)


def _round(texts, pairs, frequent, levels, settings) -> tuple[DataFrame, DataFrame]:
    """Surviving phrases that reach the levels, and per language their number and level."""
    levels = staged(levels, "phrase-levels")
    own = texts
    if levels.count() <= BROADCAST_LANGS:  # else the bitmaps alone leave the others out
        own = texts.join(F.broadcast(levels.select("lang")), "lang", "left_semi")
    at = lambda df, column: df.join(levels, "lang").filter(F.col(column) >= F.col("t")).drop("t")
    two = at(pairs, "score")
    prefixes, suffixes = bitmap(at(pairs, "bound")), bitmap(two)
    grown = counted(own, Wanted(3, frequent, prefixes, suffixes), settings, "phrase-three")
    triples = staged(_three(grown, pairs), "phrase-triples")
    three = at(triples, "score")
    prefixes, suffixes = bitmap(at(triples, "bound")), bitmap(three)
    longest = counted(own, Wanted(4, frequent, prefixes, suffixes), settings, "phrase-four")
    fours = staged(_four(longest, triples, pairs), "phrase-fours")
    # What scores enough even if its last three words were as rare as itself.
    hopeful = at(_four_scored(fours.withColumn("f234", F.coalesce("f234", "a"))), "score").select("lang", "phrase")
    hopeful = fours.join(hopeful, ["lang", "phrase"], "left_semi")
    missing = staged(
        hopeful.filter("f234 is null").select("lang", F.col("suffix").alias("phrase")).distinct(), "phrase-missing"
    )
    if missing.limit(1).count():
        rest = counted(own, Wanted(3, frequent, whole=bitmap(missing)), settings, "phrase-rest")
        rest = rest.select("lang", F.col("phrase").alias("suffix"), F.col("n").alias("f_rest"))
        hopeful = hopeful.join(rest, ["lang", "suffix"], "left").withColumn("f234", F.coalesce("f234", "f_rest"))
    four = at(_four_scored(hopeful), "score")
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    found = (
        _survivors(two.select(columns), grown, settings)
        .unionByName(_survivors(three.select(columns), longest, settings))
        .unionByName(four.select(columns))
    )
    found = staged(found, "phrase-found")
    n = found.groupBy("lang").agg(F.count("*").alias("n"))
    return found, staged(levels.join(n, "lang", "left").fillna(0, ["n"]), "phrase-settled")


def _ranked(found: DataFrame, totals: DataFrame, settings: Settings) -> DataFrame:
    """The first of each language; a histogram keeps all others out of the sort."""
    steps = found.groupBy("lang", "score").agg(F.count("*").alias("k"))
    before = F.sum("k").over(W.partitionBy("lang").orderBy(F.desc("score"))) - F.col("k")
    last = steps.withColumn("before", before).filter(F.col("before") < settings.top)
    last = last.groupBy("lang").agg(F.min("score").alias("least"))
    near = found.join(last, "lang").filter("score >= least")
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    first = near.withColumn("rank", place).filter(F.col("rank") <= settings.top)
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
