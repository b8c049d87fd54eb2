"""N-gram vocabulary, idf and tf-idf features.

Counting the corpus needs one shuffle by term, fed by map-side partial sums.
Turning reviews into feature vectors needs none: the vocabulary is bounded by
``max_features`` per block, so it travels to the tasks as a dictionary, and every
review is vectorised where it lies, by Arrow UDFs that work on whole batches. Words
are numbered once per distinct word of a batch, and word n-grams found by these numbers.
Character n-grams outnumber the words twenty to one but depend on the single word only:
they are looked up, as 64-bit numbers, once per distinct word of a chunk.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.config import scratch_path, small_batches
from voicelane.functions import text as tx
from voicelane.functions.fence import computed_once
from voicelane.operators.topk import first_k

BLOCKS = ("word", "char")
# --- fixed values -----------------------------------------------------------
MIN_DF = {"word": 2, "char": 3}
MAX_FEATURES = 50_000
WORD_RANGE = (1, 2)
CHAR_RANGE = (3, 5)
# ----------------------------------------------------------------------------


def normed(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_norm``, the normalised text, unless an earlier step has added it."""
    return df if "_norm" in df.columns else df.withColumn("_norm", tx.normalize(F.col(text)))


def ngrams_of(
    norm: Column, block: str, span: tuple[int, int] | None, df: DataFrame
) -> DataFrame:
    """Add ``_grams``, the n-gram array of one block, from a normalised text column."""
    if block == "word":
        lo, hi = span or WORD_RANGE
        # A column of its own: the word list is read once for every n.
        return (
            df.withColumn("_words", tx.model_words(norm))
            .withColumn("_grams", tx.word_ngrams(F.col("_words"), lo, hi))
            .drop("_words")
        )
    if block == "char":
        lo, hi = span or CHAR_RANGE
        return df.withColumn("_grams", tx.char_ngrams(norm, lo, hi))
    raise ValueError(f"unknown block {block!r}")


def with_ngrams(
    df: DataFrame, block: str, span: tuple[int, int] | None = None, text: str = "text"
) -> DataFrame:
    """Add ``grams``, the n-gram array of one block, from raw text (or its ``_norm``)."""
    return (
        ngrams_of(F.col("_norm"), block, span, normed(df, text))
        .withColumnRenamed("_grams", "grams")
        .drop("_norm")
    )


def _run_starts(ordered: str) -> Column:
    """Places in a sorted array where a run of equal entries starts."""
    place = F.transform(
        F.col(ordered), lambda g, i: F.when((i == 0) | (g != F.get(F.col(ordered), i - 1)), i)
    )
    return F.filter(place, lambda i: i.isNotNull())


def _runs(ordered: str, starts: str) -> Column:
    """Array of struct<term, tf>: the entry of each run and its length."""
    after = lambda k: F.coalesce(F.get(F.col(starts), k + 1), F.size(ordered))
    return F.transform(
        F.col(starts),
        lambda i, k: F.struct(
            F.get(F.col(ordered), i).alias("term"), (after(k) - i).cast("bigint").alias("tf")
        ),
    )


def ngram_counts(
    df: DataFrame, block: str, span: tuple[int, int] | None = None
) -> DataFrame:
    """Long table review_id, term, tf.

    Every review counts its own n-grams where it lies. Only reviews that share their id
    with another (or have none, if several) are added up by a shuffle; they are found by
    the ids alone, before any text is read.
    """
    shared = (
        df.groupBy("review_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("review_id")
    )
    path = scratch_path(df.sparkSession, "shared-ids")
    shared.write.parquet(path)
    shared = df.sparkSession.read.parquet(path)

    def listed(rows: DataFrame) -> DataFrame:
        grams = with_ngrams(rows.select("review_id", "text"), block, span).select("review_id", "grams")
        # Columns of their own: the n-grams are made once, and sorted once.
        grams = computed_once(grams, "ordered", F.array_sort("grams")).drop("grams")
        starts = computed_once(grams, "starts", _run_starts("ordered"))
        return computed_once(starts, "counted", _runs("ordered", "starts")).select(
            "review_id", F.inline("counted")
        )

    if not shared.limit(1).count():
        return listed(df)
    same = df["review_id"].eqNullSafe(shared["review_id"])
    several = listed(df.join(shared, same, "left_semi"))
    return listed(df.join(shared, same, "left_anti")).unionByName(
        several.groupBy("review_id", "term").agg(F.sum("tf").alias("tf"))
    )


def term_counts(
    df: DataFrame, block: str, span: tuple[int, int] | None = None
) -> DataFrame:
    """term, tf (occurrences), df (reviews containing it), in one pass and one shuffle.

    Both figures are plain sums and frequent terms combine before the shuffle. Word
    n-grams are counted as numbers, a batch of texts at a time. Character n-grams depend
    on the single word only: they are made once per distinct word of a chunk of
    texts.
    """
    source = df.select("_norm" if "_norm" in df.columns else "text")
    lo, hi = span or CHAR_RANGE
    if block == "char" and lo > 2:
        norm = small_batches(normed(source)).select("_norm")
        parts = norm.mapInArrow(functools.partial(_char_counts, (lo, hi)), _COUNTS)
        return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    if block == "word":
        return _word_terms(normed(source), span or WORD_RANGE)
    return _counted(with_ngrams(source, block, span).select("grams"))


def _word_terms(df: DataFrame, span: tuple[int, int], known: pa.Array | None = None) -> DataFrame:
    """term, tf, df of word n-grams (of ``known`` words only) of texts with ``_norm``."""
    listed = small_batches(df).select(tx.model_words(F.col("_norm")).alias("_words"))
    parts = listed.mapInArrow(functools.partial(_word_counts, span, known), _COUNTS)
    return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _word_counts(
    span: tuple[int, int], known: pa.Array | None, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """term, tf, df of the word n-grams of each batch of texts, as lists of words."""
    lo, hi = span
    for batch in batches:
        words, n_rows = batch.column("_words"), max(batch.num_rows, 1)
        flat = words.flatten().dictionary_encode()
        vocab, word = flat.dictionary, flat.indices.to_numpy().astype("int64")
        if known is not None:
            vocab, number = known, pc.index_in(vocab, value_set=known).fill_null(-1)
            word = number.to_numpy(zero_copy_only=False).astype("int64")[word]
        row = np.repeat(np.arange(len(words)), words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        place = np.flatnonzero(word >= 0)
        node = np.zeros(len(place), "int64")
        for n in range(1, hi + 1):
            place, node = _longer(place, node, row, word, n - 1)
            codes, node, tf = np.unique(node * len(vocab) + word[place + n - 1], return_inverse=True, return_counts=True)
            if n < lo or not len(codes):
                continue
            in_rows = np.unique(node * n_rows + row[place])
            df = np.bincount(in_rows // n_rows, minlength=len(codes))
            some = np.empty(len(codes), "int64")
            some[node] = place  # any place that has the n-gram
            each = [vocab.take(pa.array(word[some + k])) for k in range(n)]
            terms = pc.binary_join_element_wise(*each, " ") if n > 1 else each[0]
            yield from _count_batches(terms, tf, df)


def _longer(place: np.ndarray, node: np.ndarray, row: np.ndarray, word: np.ndarray, k: int):
    """Those of n-grams (where they start, and their number) that a ``k``-th listed word of the text follows."""
    inside = place + k < len(word)
    place, node = place[inside], node[inside]
    go = (row[place + k] == row[place]) & (word[place + k] >= 0)
    return place[go], node[go]


def _counted(grams: DataFrame) -> DataFrame:
    """term, tf, df of a column of n-gram arrays."""
    listed = grams.select(
        F.size("grams").alias("n"),
        F.posexplode(F.concat("grams", F.array_distinct("grams"))).alias("pos", "term"),
    )
    first_part = F.col("pos") < F.col("n")
    return listed.groupBy("term").agg(
        F.count_if(first_part).alias("tf"), F.count_if(~first_part).alias("df")
    )


def word_counts_for(
    df: DataFrame, span: tuple[int, int], max_features: int, min_df: int | None = None
) -> DataFrame:
    """``term_counts`` of word n-grams, less terms that can't be among ``max_features``.

    An n-gram occurs in no more places and reviews than any of its words. Single words are
    counted first. If ``max_features`` of them are frequent enough, the least of these is
    a bound that every term of the vocabulary reaches, so longer n-grams are only listed
    where all their words reach it (and the least number of reviews). What would be
    shuffled only to be dropped stays where it is; the vocabulary is the same. The words
    sent to the tasks are ``max_features`` and ties; with more ties than that times three
    nothing is left out.
    """
    lo, hi = span
    if lo > 1 or hi == 1:
        return term_counts(df, "word", span)
    least = MIN_DF["word"] if min_df is None else min_df
    path = scratch_path(df.sparkSession, "words")
    term_counts(df, "word", (1, 1)).write.parquet(path)
    singles = df.sparkSession.read.parquet(path)
    top = build_vocab(singles, "word", max_features, least).agg(
        F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf")
    ).first()
    bound = top["tf"] if top["n"] == max_features else 0
    frequent = singles.filter((F.col("df") >= least) & (F.col("tf") >= bound)).select("term")
    if frequent.count() > 4 * max_features:
        return term_counts(df, "word", span)
    words = frequent.toArrow().column("term").combine_chunks()
    source = normed(df.select("_norm" if "_norm" in df.columns else "text"))
    return singles.unionByName(_word_terms(source, (2, hi), words))


def build_vocab(
    counts: DataFrame, block: str, max_features: int = MAX_FEATURES, min_df: int | None = None
) -> DataFrame:
    """block, term, feature_id, tf, df: the most frequent terms, ids in term order.

    Ties in frequency go to the smaller term. The levels are powers of two, so the
    final sort sees about ``max_features`` rows however large the vocabulary is.
    """
    least = MIN_DF[block] if min_df is None else min_df
    top = first_k(
        counts.filter(F.col("df") >= least),
        max_features,
        level=-F.floor(F.log2("tf")).cast("int"),
        order=[F.desc("tf"), F.col("term")],
    )
    by_term = F.row_number().over(W.partitionBy("block").orderBy("term")) - 1
    return top.select(F.lit(block).alias("block"), "term", "tf", "df").withColumn(
        "feature_id", by_term
    )


def with_idf(vocab: DataFrame, n_reviews: Column) -> DataFrame:
    """Add the smoothed inverse document frequency."""
    return vocab.withColumn("idf", F.log((n_reviews + 1.0) / (F.col("df") + 1.0)) + 1.0)


def review_total(df: DataFrame) -> Column:
    """Number of reviews, as a scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


# Texts are expanded into character n-grams this many bytes at a time.
_CHUNK_BYTES = 1 << 20
_CACHE_WORDS = 200_000
# A task passes its counts on when it holds more n-grams than this.
_COUNTED = 400_000
_COUNTS = "term string, tf bigint, df bigint"


def _grams_of_word(word: str, lo: int, hi: int) -> list[str]:
    """Character n-grams of one padded word, repeats included."""
    if not word:
        return []
    padded = f" {word} "
    size = len(padded)
    return [padded] if size < lo else [
        padded[i : i + n] for n in range(lo, hi + 1) for i in range(size - n + 1)
    ]


def _slots_of_word(word: str, table: dict[str, int], lo: int, hi: int) -> list[int]:
    """Those of the n-grams that the table knows."""
    return [table[g] for g in _grams_of_word(word, lo, hi) if g in table]


def _chunks(norm: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``_CHUNK_BYTES``."""
    ends = np.cumsum(pc.binary_length(norm).fill_null(0).to_numpy(zero_copy_only=False))
    total = int(ends[-1]) if len(ends) else 0
    marks = np.arange(_CHUNK_BYTES, total, _CHUNK_BYTES)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, marks) + 1, [len(norm)]]))
    return zip(cuts[:-1], cuts[1:])


def _each_once(numbers: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The distinct numbers of an array; ``last`` has room for each of them."""
    place = np.arange(len(numbers))
    last[numbers] = place
    return numbers[last[numbers] == place]


def _count_batches(terms, tf: np.ndarray, df: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counted terms (an Arrow array or a list), some at a time."""
    for at in range(0, len(terms), 1 << 16):
        own = slice(at, at + (1 << 16))
        listed = terms[own] if isinstance(terms, pa.Array) else pa.array(terms[own], pa.string())
        yield pa.RecordBatch.from_arrays(
            [listed, pa.array(tf[own].astype("int64")), pa.array(df[own].astype("int64"))], ["term", "tf", "df"]
        )


def _window_codes(
    ids: np.ndarray, owner: np.ndarray, sizes: np.ndarray, span: tuple[int, int], bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of padded words (numbers of characters), and the word of each.

    N-grams with a character of number 0 are left out.
    """
    lo, hi = span
    code, known, codes, words = np.zeros(len(ids), np.uint64), ids > 0, [], []
    valid = known
    for n in range(1, hi + 1):
        here = max(len(ids) - n + 1, 0)
        code = code[:here] | ids[n - 1 :] << np.uint64(bits * (hi - n))
        valid = valid[:here] & known[n - 1 :]
        own = owner[:here]
        whole = valid & (own == owner[n - 1 :])
        if n < lo:  # words shorter than any n-gram are listed whole
            starts = np.ones(here, bool)
            starts[1:] = own[1:] != own[:-1]
            whole &= starts & (sizes[own] == n)
        codes.append(code[whole])
        words.append(own[whole])
    return np.concatenate(codes), np.concatenate(words)


def _padded(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words padded by a blank on either side, the word of each, and sizes."""
    sizes = pc.utf8_length(distinct).to_numpy().astype("int64")
    sizes = np.where(sizes > 0, sizes + 2, 0)
    some = distinct.filter(pc.greater(pc.binary_length(distinct), 0))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), "  ")
    padded = f" {whole[0].as_py()} " if len(some) else ""
    points = np.frombuffer(padded.encode("utf-32-le"), "<u4")
    return points, np.repeat(np.arange(len(distinct)), sizes), sizes


class _GramCodes:
    """Character n-grams as 64-bit numbers: places in a list of characters, side by side.

    The list grows with the texts as far as the bits of a number go (4,095 characters for
    n-grams of up to five); 0 stands for no character.
    """

    def __init__(self, span: tuple[int, int]):
        self.lo, self.hi = span
        self.bits = 64 // self.hi
        self.chars = np.zeros(1, np.uint32)

    def room(self, points: np.ndarray) -> bool:
        """Take the characters in; false if there are too many."""
        new = np.setdiff1d(points, self.chars[1:])
        if len(self.chars) + len(new) > 1 << self.bits:
            return False
        self.chars = np.concatenate([self.chars, new])
        return True

    def of(self, points: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams of padded words (code points, word of each), and their word."""
        order = np.argsort(self.chars[1:], kind="stable")
        ids = (order[np.searchsorted(self.chars[1:], points, sorter=order)] + 1).astype(np.uint64)
        return _window_codes(ids, owner, sizes, (self.lo, self.hi), self.bits)

    def terms(self, codes: np.ndarray) -> list[str]:
        shifts = np.array([self.bits * (self.hi - n) for n in range(1, self.hi + 1)], np.uint64)
        ids = (codes[:, None] >> shifts) & np.uint64((1 << self.bits) - 1)
        listed = self.chars[ids.astype(np.int64)].astype("<u4").view(f"<U{self.hi}").ravel().tolist()
        if (self.chars[1:] == 0).any():  # numpy drops the NULs a string ends with
            listed = [t.ljust(k, "\0") for t, k in zip(listed, (ids > 0).sum(axis=1).tolist())]
        return listed


def _summed(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    """One row per code of parts (codes, tf, df)."""
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    tf, df = (np.bincount(at, np.concatenate([p[k] for p in parts]), len(codes)).astype("int64") for k in (1, 2))
    return codes, tf, df


def _char_counts(span: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, tf, df of the character n-grams of a task's normalised texts, in parts."""
    book, held, met = _GramCodes(span), [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal met
        met = 0
        if held:
            codes, tf, df = _summed(held)
            yield from _count_batches(book.terms(codes), tf, df)
            held.clear()

    for batch in batches:
        norm = batch.column("_norm").drop_null()
        for start, stop in _chunks(norm):
            words = pc.split_pattern(norm.slice(start, stop - start), " ")
            coded = words.flatten().dictionary_encode()
            at, distinct = coded.indices.to_numpy(), coded.dictionary
            points, owner, sizes = _padded(distinct)
            seen = np.unique(points)
            if not book.room(seen):
                yield from flush()
                book = _GramCodes(span)
                if not book.room(seen):  # more characters than fit: n-grams as strings
                    listed = [_grams_of_word(w, *span) for w in distinct.to_pylist()]
                    coded_grams = pa.array([g for own in listed for g in own], pa.string()).dictionary_encode()
                    gram, terms = coded_grams.indices.to_numpy().astype("int64"), coded_grams.dictionary
                    owner = np.repeat(np.arange(len(listed)), [len(own) for own in listed])
                    yield from _count_batches(terms, *_tf_df(words, at, len(distinct), gram, owner, len(terms)))
                    continue
            codes, owner = book.of(points, owner, sizes)
            codes, gram = np.unique(codes, return_inverse=True)
            held.append((codes, *_tf_df(words, at, len(distinct), gram, owner, len(codes))))
            met += len(distinct)
            if sum(len(p[0]) for p in held) > 2 * _COUNTED:
                held[:] = [_summed(held)]
                if len(held[0][0]) > _COUNTED:
                    yield from flush()
            if met > 10 * _CACHE_WORDS:
                yield from flush()
    yield from flush()


def _tf_df(
    words: pa.ListArray, at: np.ndarray, n_words: int, gram: np.ndarray, owner: np.ndarray, n_grams: int
) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of n-grams, and the texts that hold each.

    ``at`` numbers the words of the texts; ``owner`` has the word of each entry of ``gram``.
    """
    times = np.bincount(at, minlength=n_words)
    tf, df = np.bincount(gram, times[owner], n_grams), np.zeros(n_grams, np.int64)
    pool = gram[np.argsort(owner, kind="stable")]
    sizes = np.bincount(owner, minlength=n_words)
    starts = np.cumsum(sizes) - sizes
    last_word, last_gram = np.empty(n_words, "int64"), np.empty(n_grams, "int64")
    ends = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy())])
    for a, b in zip(ends[:-1], ends[1:]):
        own = _each_once(at[a:b], last_word)
        spread = sizes[own]
        inner = np.arange(spread.sum()) + np.repeat(starts[own] - (np.cumsum(spread) - spread), spread)
        df[_each_once(pool[inner], last_gram)] += 1
    return tf, df


def _entries(keys: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, tf) arrays, in order, of keys row * size + slot of n rows."""
    keys.sort()
    first = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    at = np.flatnonzero(first)
    tf, keys = np.diff(np.append(at, len(keys))), keys[at].astype("int64")
    each = np.diff(np.searchsorted(keys, np.arange(n + 1) * size))
    rows = np.repeat(np.arange(n), each)
    return rows, keys - rows * size, tf.astype("float64")


def _key_type(n: int, size: int) -> str:
    return "int32" if n * size < 1 << 31 else "int64"


class _Numbers:
    """Numbers of known codes: looked up by a hash, and in order where two hashes meet."""

    BITS = 18

    def __init__(self, codes: np.ndarray, numbers: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.numbers = codes[order].astype(np.uint64), numbers[order]
        hashed = self._hash(self.codes)
        self.first = np.zeros(1 << self.BITS, np.int32)
        self.first[hashed] = np.arange(len(codes))
        self.several = np.bincount(hashed, minlength=1 << self.BITS) > 1

    def _hash(self, codes: np.ndarray) -> np.ndarray:
        mixed = (codes ^ codes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are known, and the numbers of those."""
        if not len(self.codes):
            return np.zeros(len(codes), bool), np.empty(0, self.numbers.dtype)
        codes = codes.astype(np.uint64, copy=False)
        hashed = self._hash(codes)
        at = self.first[hashed]
        known = self.codes[at] == codes
        left = np.flatnonzero(~known & self.several[hashed])
        if len(left):
            at[left] = np.minimum(np.searchsorted(self.codes, codes[left]), len(self.codes) - 1)
            known[left] = self.codes[at[left]] == codes[left]
        return known, self.numbers[at[known]]


class _CharSlots:
    """Slots of the known character n-grams of words, by codes as ``_GramCodes`` has.

    Characters are numbered as the vocabulary has them; one with more characters than the
    bits can number looks its n-grams up as strings.
    """

    def __init__(self, terms: list[str], span: tuple[int, int]):
        self.span, self.size, (_, hi) = span, max(len(terms), 1), span
        self.bits, self.table = 64 // hi, None
        sizes = np.array([len(t) for t in terms], "int64")
        points = np.frombuffer("".join(terms).encode("utf-32-le"), "<u4")
        self.chars = np.unique(points)
        if len(self.chars) >= 1 << self.bits:
            self.table = {term: slot for slot, term in enumerate(terms)}
            return
        owner = np.repeat(np.arange(len(terms)), sizes)
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = (np.searchsorted(self.chars, points) + 1).astype(np.uint64)
        fits = place < hi
        codes = np.zeros(len(terms), np.uint64)
        shift = np.uint64(self.bits) * (hi - 1 - place[fits]).astype(np.uint64)
        np.bitwise_or.at(codes, owner[fits], ids[fits] << shift)
        use = np.flatnonzero((sizes > 0) & (sizes <= hi))
        self.known = _Numbers(codes[use], use)

    def of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the n-grams of some words one word after the other, and how many each has."""
        if self.table is not None:
            found = [_slots_of_word(w, self.table, *self.span) for w in distinct.to_pylist()]
            return np.array([k for own in found for k in own], "int64"), np.array([len(own) for own in found], "int64")
        points, owner, sizes = _padded(distinct)
        ids = np.zeros(len(points), np.uint64)
        if len(self.chars):
            at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
            ids = np.where(self.chars[at] == points, at + 1, 0).astype(np.uint64)
        codes, owner = _window_codes(ids, owner, sizes, self.span, self.bits)
        known, slots = self.known.of(codes)
        owner = owner[known]
        return slots[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(distinct))

    def read(self, norm: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, slot, tf) arrays of normalised texts, in chunks."""
        for start, stop in _chunks(norm):
            words = pc.split_pattern(norm.slice(start, stop - start), " ")
            lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            coded, n = words.flatten().dictionary_encode(), stop - start
            pool, sizes = self.of(coded.dictionary)
            starts = np.cumsum(sizes) - sizes
            # Replace every word of every text by the slots of its n-grams.
            at = coded.indices.to_numpy()
            spread = sizes[at]
            inner = np.arange(spread.sum()) + np.repeat(starts[at] - (np.cumsum(spread) - spread), spread)
            kind = _key_type(n, self.size)
            first = np.repeat((np.arange(n) * self.size).astype(kind), lengths)
            rows, slots, tf = _entries(pool.astype(kind)[inner] + np.repeat(first, spread), n, self.size)
            yield rows + start, slots, tf


class _WordSlots:
    """Slots of the known word n-grams of texts, found word by word along their prefixes."""

    def __init__(self, terms: list[str], span: tuple[int, int]):
        (lo, hi), self.size = span, max(len(terms), 1)
        split = [t.split(" ") for t in terms]
        words = sorted({w for own in split for w in own})
        number = {w: k for k, w in enumerate(words)}
        self.words, self.levels = pa.array(words, pa.string()), []
        # Nodes of a level are prefixes of that many words.
        before = {(): 0}
        for n in range(1, hi + 1):
            nodes, slots = {}, []
            for slot, own in enumerate(split):
                if len(own) < n or len(own) > hi:
                    continue
                if (prefix := tuple(own[:n])) not in nodes:
                    nodes[prefix] = len(nodes)
                    slots.append(-1)
                if len(own) == n >= lo:
                    slots[nodes[prefix]] = slot
            codes = np.array([before[p[:-1]] * len(words) + number[p[-1]] for p in nodes], "int64")
            self.levels.append((_Numbers(codes, np.arange(len(nodes))), np.array(slots, "int64")))
            before = nodes

    def read(self, words: pa.ListArray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, slot, tf) arrays of texts as lists of words."""
        n, flat = len(words), words.flatten().dictionary_encode()
        lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        number = pc.index_in(flat.dictionary, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        word = number.astype("int64")[flat.indices.to_numpy()]
        row = np.repeat(np.arange(n), lengths)
        place = np.flatnonzero(word >= 0)  # where an n-gram that may be known starts
        node, keys = np.zeros(len(place), "int64"), []
        for k, (known, slots) in enumerate(self.levels):
            place, node = _longer(place, node, row, word, k)
            met, node = known.of(node * len(self.words) + word[place + k])
            place, slot = place[met], slots[node]
            keys.append((row[place] * self.size + slot)[slot >= 0])
        yield _entries(np.concatenate(keys).astype(_key_type(n, self.size)), n, self.size)


@dataclass
class Block:
    """One fitted n-gram vocabulary. Arrays are in slot order."""

    name: str
    span: tuple[int, int]
    terms: list[str]
    feature_ids: np.ndarray
    idf: np.ndarray

    def input(self) -> str:
        """The scratch column the weights are computed from."""
        return "_words" if self.name == "word" else "_char_norm"

    @functools.cached_property
    def reader(self):
        """Function from the input array of a batch to chunks of (row, slot, tf), in order."""
        return (_WordSlots if self.name == "word" else _CharSlots)(self.terms, self.span).read


@dataclass
class FeatureSpace:
    """A fitted vocabulary of at most ``max_features`` terms per block."""

    parts: list[Block]

    @classmethod
    def from_vocab(
        cls,
        vocab: DataFrame,
        word_range: tuple[int, int] = WORD_RANGE,
        char_range: tuple[int, int] = CHAR_RANGE,
    ) -> FeatureSpace:
        """Collect a vocabulary table (block, term, idf); its size is bounded.

        Joint feature ids count words in term order, then character n-grams.
        """
        table = vocab.select("block", "term", "idf").toArrow().to_pandas()
        parts, offset = [], 0
        for name, span in (("word", word_range), ("char", char_range)):
            rows = table[table["block"] == name].sort_values("term")
            if rows.empty:
                continue
            place = rows.assign(id=np.arange(offset, offset + len(rows))).set_index("term")
            terms = list(place.index)
            parts.append(Block(name, span, terms, place["id"].to_numpy(), place["idf"].to_numpy()))
            offset += len(rows)
        return cls(parts)

    @property
    def size(self) -> int:
        return sum(len(part.terms) for part in self.parts)

    def with_inputs(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add the scratch columns: the model's words, the normalised text.

        A column ``_norm`` that is already there is used and kept.
        """
        given = "_norm" in df.columns
        df = normed(small_batches(df), text)
        for part in self.parts:
            norm = F.col("_norm")
            df = df.withColumn(part.input(), tx.model_words(norm) if part.name == "word" else norm)
        return df if given else df.drop("_norm")

    def scratch(self) -> list[str]:
        return [part.input() for part in self.parts]

    def weights(self, part: Block) -> Column:
        """Array of struct<feature_id, weight> of one block, unit length, by id."""
        entry = [pa.field("feature_id", pa.int32()), pa.field("weight", pa.float64())]
        idf, feature_ids, read = part.idf, part.feature_ids, part.reader
        by_id = bool((np.diff(feature_ids) > 0).all())  # then entries come in order of ids

        @F.arrow_udf("array<struct<feature_id:int,weight:double>>")
        def weigh(column: pa.Array) -> pa.Array:
            n = len(column)
            counts, ids, weights = np.zeros(n, "int64"), [], []
            for rows, slots, tf in read(column):
                raw = (1.0 + np.log(tf)) * idf[slots]
                length = np.sqrt(np.bincount(rows, raw * raw, minlength=n))
                chunk_ids = feature_ids[slots]
                order = slice(None) if by_id else np.lexsort((chunk_ids, rows))
                ids.append(chunk_ids[order].astype("int32"))
                weights.append((raw / length[rows])[order])
                counts += np.bincount(rows, minlength=n)
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, "int32"), *ids])),
                    pa.array(np.concatenate([np.empty(0), *weights])),
                ],
                fields=entry,
            )
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype("int32")
            return pa.ListArray.from_arrays(pa.array(offsets), flat)

        return weigh(F.col(part.input()))

    def margin(self, coef: np.ndarray) -> Column:
        """Sum of weight times coefficient over all blocks; ``coef`` by joint id."""
        return F.get(self.margins([coef]), F.lit(0))

    def margins(self, coefs: list[np.ndarray]) -> Column:
        """Array of the margins under several lists of coefficients; texts are read once."""
        tables = [(part.idf, [coef[part.feature_ids] for coef in coefs], part.reader) for part in self.parts]

        @F.arrow_udf("array<double>")
        def dot(*columns: pa.Array) -> pa.Array:
            n = len(columns[0])
            out = np.zeros((n, len(coefs)))
            for (idf, by_slot, read), column in zip(tables, columns, strict=True):
                squares, sums = np.zeros(n), np.zeros((n, len(coefs)))
                for rows, slots, tf in read(column):
                    raw = (1.0 + np.log(tf)) * idf[slots]
                    squares += np.bincount(rows, raw * raw, minlength=n)
                    for k, own in enumerate(by_slot):
                        sums[:, k] += np.bincount(rows, raw * own[slots], minlength=n)
                out += sums / np.sqrt(np.where(squares > 0, squares, 1.0))[:, None]
            offsets = np.arange(0, out.size + 1, len(coefs), dtype="int32")
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

        return dot(*[F.col(c) for c in self.scratch()])

    def vectorize(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``features``: both blocks, each of unit length, as one sparse vector.

        The column has the physical layout of an ML vector, so written to Parquet
        it reads back as one.
        """
        df = self.with_inputs(df, text)
        for part in self.parts:
            df = df.withColumn(f"_{part.name}_weights", self.weights(part))
        joined = F.concat(*[F.col(f"_{part.name}_weights") for part in self.parts])
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.size).alias("size"),
            joined["feature_id"].alias("indices"),
            joined["weight"].alias("values"),
        )
        return df.withColumn("features", vector).drop(
            *self.scratch(), *[f"_{part.name}_weights" for part in self.parts]
        )


def tfidf(df: DataFrame, space: FeatureSpace) -> DataFrame:
    """Long table review_id, block, feature_id, weight (unit length per block)."""
    counted = space.with_inputs(df.select("review_id", "text"))
    for part in space.parts:
        counted = counted.withColumn(f"_{part.name}_weights", space.weights(part))
    per_block = [
        F.struct(F.lit(p.name).alias("block"), F.col(f"_{p.name}_weights").alias("terms"))
        for p in space.parts
    ]
    return counted.select("review_id", F.inline(F.array(*per_block))).select(
        "review_id", "block", F.inline("terms")
    )


def feature_union(df: DataFrame, space: FeatureSpace) -> DataFrame:
    """Long table review_id, feature_id, weight over one joint id range."""
    vectors = space.vectorize(df.select("review_id", "text")).select("review_id", "features")
    pairs = F.arrays_zip(
        F.col("features.indices").alias("feature_id"),
        F.col("features.values").alias("weight"),
    )
    return vectors.select("review_id", F.inline(pairs))
