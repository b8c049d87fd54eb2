"""Ranked lexical search over an index stratified by document length.

A document enters the ranking through its normaliser m, a whole number that follows from
its length and the mean length, and through the counts tf of its terms. Documents with
equal m form a stratum (a large one is split into parts). Inside a stratum the postings
of a term are ordered by tf, largest first, so a document's impact, which depends on
nothing but term, tf and m, is computed once per tf and shared by all documents that
have it; the first tf of each term gives the most that any document of the stratum can
score. Strata are visited in the order of these bounds, and a query passes over a
stratum whose bound is below its k-th score so far.

Documents are read once and become rows of term numbers; only terms that some query
asks for are kept. They are dealt by ranges of m and a hash, so that a task holds whole
strata but no length, however common, must fit one task. Each task returns its own best
documents and the score of its last one; the largest of these, per query, cuts off
nearly everything before the final ranking. Queries are searched in blocks of bounded
size. All arithmetic is in 64-bit integers but for the logarithm in a term's weight.

Null and empty texts have no terms: such documents are not counted, such queries find
nothing. Each document row is ranked, also repeated ones; among equal scores the smaller
id comes first and null ids last. Rows that repeat a query id add up their terms once
per different text. Extra columns are ignored. An empty table finds nothing.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.llm.common import folded_words, record_batch, slices, small_batches, staged


@dataclass(frozen=True)
class Settings:
    top: int = 20
    #: Bytes of query texts that are searched at a time.
    block_bytes: int = 4 << 20
    #: Postings of a task that builds strata.
    shard_postings: int = 2_000_000
    #: Documents of a part of a stratum.
    part: int = 4_096
    #: Bytes of strata whose visits a task orders at a time.
    window_bytes: int = 48 << 20


DEFAULT = Settings()
#: Queries whose scores in a stratum are held at a time.
_QUERIES = 256
_ROWS = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"
_STRATUM = "m bigint, docs array<bigint>, terms array<int>, tfs array<int>, sizes array<int>, places array<int>"
_FOUND = "item_id bigint, doc_id bigint, score bigint, floor bigint"
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    look = shared.value.get
    for part in slices(batches):
        split = [folded_words(t) for t in part.column("text").to_pylist()]
        known = [[k for w in words if (k := look(w)) is not None] for words in split]
        sizes = np.array([len(k) for k in known], np.int64)
        doc = np.repeat(np.arange(len(known)), sizes)
        term = np.fromiter((k for own in known for k in own), np.int64, len(doc))
        key, tf = np.unique(doc << 32 | term, return_counts=True)
        starts = np.searchsorted(key >> 32, np.arange(len(known) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"), pa.array([len(w) for w in split], pa.int64()),
                pa.ListArray.from_arrays(pa.array(starts), pa.array((key & 0xFFFFFFFF).astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(starts), pa.array(tf.astype(np.int32))),
            ],
            ["doc_id", "n", "terms", "tfs"],
        )


def _values(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lists of a column, and where each list starts (with the end)."""
    offsets = column.offsets.to_numpy()
    return _values(column), offsets - offsets[0]


def _strata(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of m become parts of strata with at most ``size`` documents."""
    held: list[tuple] = []
    m_held, n_held = None, 0

    def flush():
        docs, term, tf, place, at = [], [], [], [], 0
        for ids, terms, tfs, counts in held:
            docs += ids
            term.append(terms)
            tf.append(tfs)
            place.append(np.repeat(np.arange(at, at + len(ids)), counts))
            at += len(ids)
        term, tf, place = (np.concatenate(x).astype(np.int64) for x in (term, tf, place))
        order = np.lexsort((place, -tf, term))
        term, tf, place = term[order], tf[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1]))))
        sizes = np.diff(np.concatenate((first, [len(term)])))
        held.clear()
        return record_batch(
            [[m_held], [docs], [term[first]], [tf[first]], [sizes], [place]],
            ["m", "docs", "terms", "tfs", "sizes", "places"],
            [pa.int64(), _LONGS, _INTS, _INTS, _INTS, _INTS],
        )

    for batch in batches:
        m = batch.column("m").to_numpy()
        ids = batch.column("doc_id")
        terms, starts = _lists(batch.column("terms"))
        tfs, _ = _lists(batch.column("tfs"))
        edges = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1], [True]))) if len(m) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            while a < b:
                if n_held and (m_held != m[a] or n_held == size):
                    yield flush()
                    n_held = 0
                c = min(b, a + size - n_held)
                x, y = starts[a], starts[c]
                held.append((ids.slice(a, c - a).to_pylist(), terms[x:y], tfs[x:y], np.diff(starts[a : c + 1])))
                m_held, n_held, a = int(m[a]), n_held + int(c - a), int(c)
    if n_held:
        yield flush()


@dataclass
class Index:
    """Strata of all documents with a term asked for, and the statistics of the corpus."""

    strata: DataFrame
    #: Documents with at least one term, all their terms.
    n_docs: int
    n_terms: int
    #: Documents that hold each term.
    df: np.ndarray
    numbers: dict[bytes, int]

    def weight(self, number: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * int(self.df[number]) + 1)))


def build(docs: DataFrame, terms: list[bytes], settings: Settings = DEFAULT) -> Index:
    """Index all documents by ``terms`` (distinct, bounded by a block of queries)."""
    numbers = {w: k for k, w in enumerate(terms)}
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    texts = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text")
    rows = staged(texts.mapInArrow(functools.partial(_rows, shared), _ROWS).filter("n > 0"), "rank-rows")
    size = rows.agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_terms"), F.sum(F.size("terms")).alias("postings")
    ).first()
    n_docs, n_terms, postings = (int(x or 0) for x in size)
    df = np.zeros(len(terms), np.int64)
    for r in rows.select(F.explode("terms").alias("k")).groupBy("k").count().collect():  # one row per term
        df[r["k"]] = r["count"]
    m = F.expr(f"100 - 25 + ((25 * n * {n_docs}L) div {max(n_terms, 1)}L)")
    shards = max(1, -(-postings // settings.shard_postings), -(-n_docs // 100_000))
    dealt = (
        rows.filter("size(terms) > 0").select(m.alias("m"), "doc_id", "terms", "tfs")
        .repartitionByRange(shards, "m", F.xxhash64("doc_id")).sortWithinPartitions("m")
    )
    strata = staged(dealt.mapInArrow(functools.partial(_strata, settings.part), _STRATUM), "rank-strata")
    return Index(strata, n_docs, n_terms, df, numbers)


@dataclass
class Queries:
    """A block of queries: which query asks how often for which term, by term."""

    ids: list[int | None]
    #: Parallel arrays, ordered by term.
    term: np.ndarray
    query: np.ndarray
    repeats: np.ndarray
    #: Weight of each term.
    weight: np.ndarray

    def some(self, first: int, stop: int) -> Queries:
        use = (self.query >= first) & (self.query < stop)
        return Queries(
            self.ids[first:stop], self.term[use], self.query[use] - first, self.repeats[use], self.weight
        )


def _impacts(weight: np.ndarray, tf: np.ndarray, m: int) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _spread(term: np.ndarray, q: Queries, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each given term the active queries that ask for it: places in ``term`` and in ``q``."""
    live = np.flatnonzero(active[q.query])
    own = q.term[live]
    low, high = np.searchsorted(own, term, "left"), np.searchsorted(own, term, "right")
    n = high - low
    source = np.repeat(np.arange(len(term)), n)
    inner = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
    return source, live[np.repeat(low, n) + inner]


class Best:
    """The best documents of each query so far, and the score of the k-th."""

    def __init__(self, n: int, top: int):
        self.top, self.floor = top, np.zeros(n, np.int64)
        self.query, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.null = np.empty(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        self.query, self.score = np.concatenate((self.query, query)), np.concatenate((self.score, score))
        self.doc, self.null = np.concatenate((self.doc, doc)), np.concatenate((self.null, null))
        order = np.lexsort((self.doc, self.null, -self.score, self.query))
        self.query, self.score, self.doc, self.null = (x[order] for x in (self.query, self.score, self.doc, self.null))
        place = np.arange(len(order)) - np.searchsorted(self.query, self.query)
        last = place == self.top - 1
        self.floor[self.query[last]] = self.score[last]
        keep = place < self.top
        self.query, self.score, self.doc, self.null = (x[keep] for x in (self.query, self.score, self.doc, self.null))


def _visit(strata: list[tuple], q: Queries, best: Best) -> None:
    """Score strata (m, docs, null, terms, tfs, sizes, places), those with the largest bounds first."""
    bounds = np.zeros((len(strata), len(q.ids)), np.int64)
    everyone = np.ones(len(q.ids), bool)
    for k, (m, _, _, terms, tfs, _, _) in enumerate(strata):
        head = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
        most = _impacts(q.weight[terms[head]], tfs[head], m)
        source, entry = _spread(terms[head], q, everyone)
        np.add.at(bounds[k], q.query[entry], most[source] * q.repeats[entry])
    for k in np.argsort(-bounds.max(1), kind="stable"):
        active = (bounds[k] > 0) & (bounds[k] >= best.floor)
        if not active.any():
            continue
        m, docs, null, terms, tfs, sizes, places = strata[k]
        scores = np.zeros((len(docs), len(q.ids)), np.int64)
        impact = _impacts(q.weight[terms], tfs, m)
        source, entry = _spread(terms, q, active)
        gain = impact[source] * q.repeats[entry]
        stops = np.cumsum(sizes)
        starts = stops - sizes
        # Each level of a term adds its impact to all its documents, for all queries.
        total = np.cumsum(sizes[source])
        at, flat = 0, scores.reshape(-1)
        while at < len(source):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + 2_000_000, "right")))
            own = source[at:to]
            n = sizes[own]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = places[np.repeat(starts[own], n) + inner]
            np.add.at(flat, place * len(q.ids) + np.repeat(q.query[entry[at:to]], n), np.repeat(gain[at:to], n))
            at = to
        place, query = np.nonzero((scores > 0) & (scores >= best.floor) & active)
        best.add(query, scores[place, query], docs[place], null[place])


def _search(shared, settings: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    queries: Queries = shared.value
    groups = [queries.some(a, a + _QUERIES) for a in range(0, len(queries.ids), _QUERIES)]
    best = [Best(len(g.ids), settings.top) for g in groups]
    held, size = [], 0

    def visit():
        for own, found in zip(groups, best, strict=True):
            _visit(held, own, found)
        held.clear()

    for batch in batches:
        columns = [_lists(batch.column(c)) for c in ("docs", "terms", "tfs", "sizes", "places")]
        empty = batch.column("docs").flatten().is_null().to_numpy(zero_copy_only=False)
        for k, m in enumerate(batch.column("m").to_pylist()):
            cut = [values[at[k] : at[k + 1]] for values, at in columns]
            null = empty[columns[0][1][k] : columns[0][1][k + 1]]
            docs = np.where(null, 0, cut[0]).astype(np.int64)
            held.append((m, docs, null, *[x.astype(np.int64) for x in cut[1:]]))
            size += 8 * sum(len(x) for x in held[-1][1:])
        if size >= settings.window_bytes:
            visit()
            size = 0
    visit()
    for own, found in zip(groups, best, strict=True):
        ids = pa.array(found.doc, pa.int64(), mask=found.null)
        floor = found.floor[found.query]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([own.ids[k] for k in found.query], pa.int64()), ids, pa.array(found.score),
                pa.array(floor, pa.int64(), mask=floor == 0),
            ],
            ["item_id", "doc_id", "score", "floor"],
        )


def search(index: Index, items: list[tuple[int | None, Counter]], settings: Settings = DEFAULT) -> DataFrame:
    """item_id, doc_id, score, floor: candidates of all tasks for a block of queries."""
    spark = index.strata.sparkSession
    rows = sorted(
        (index.numbers[w], k, n) for k, (_, words) in enumerate(items) for w, n in words.items()
    )
    term, query, repeats = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    weight = np.array([index.weight(k) for k in range(len(index.df))], np.int64)
    shared = spark.sparkContext.broadcast(Queries([i for i, _ in items], term, query, repeats, weight))
    return small_batches(index.strata).mapInArrow(functools.partial(_search, shared, settings), _FOUND)


def blocks(items: DataFrame, settings: Settings) -> Iterator[list[tuple[int | None, Counter]]]:
    """Queries with their terms, some MB of texts at a time."""
    own = items.select(F.col("item_id").cast("bigint"), "text").distinct().orderBy("item_id", "text")
    held: list[tuple[int | None, Counter]] = []
    size = 0
    for r in own.toLocalIterator():
        words = Counter(folded_words(r["text"]))
        if not words:
            continue
        if held and held[-1][0] == r["item_id"]:
            held[-1][1].update(words)
        else:
            if size >= settings.block_bytes:
                yield held
                held, size = [], 0
            held.append((r["item_id"], words))
        size += len(r["text"])
    if held:
        yield held


def rank(docs: DataFrame, items: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each query with a score above 0."""
    found = None
    for block in blocks(items, settings):
        terms = sorted(set().union(*[words for _, words in block]))
        some = staged(search(build(docs, terms, settings), block, settings), "rank-found")
        found = some if found is None else found.union(some)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _FOUND)
    # The best last place of a full list: nothing below it can be among the first.
    floors = found.groupBy(F.col("item_id").alias("item")).agg(F.max("floor").alias("least"))
    near = found.join(floors, F.col("item_id").eqNullSafe(F.col("item"))).filter(
        F.col("least").isNull() | (F.col("score") >= F.col("least"))
    )
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        near.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= settings.top)
        .select("item_id", "rank", "doc_id", "score")
    )
