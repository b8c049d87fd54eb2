"""Document quality by histogram gradient-boosted trees over document statistics.

Each whole text becomes a row of numbers: shares of kinds of characters, word lengths,
repetition of words, pairs of words and lines, shape of lines, entropy. Nothing of it
depends on a label, a language tag, a source or an id. Values are put into at most 64 bins
whose edges are quantiles of a bounded sample of training rows.

Trees are grown level by level. For each level one job adds up gradient, curvature and
rows per node, statistic and bin over *all* training rows, within tasks first, so that
what reaches the driver has the size of the histograms and not of the rows. Gradients
are added as whole numbers: sums don't depend on how rows are dealt. The training rows
(one byte per statistic) lie in a table in the shared folder; a lost executor repeats
its part of one level. Fitted trees are complete and flattened into arrays; a batch of
rows goes through all of them at once by numpy indexing.

Null and empty texts have zeros for all statistics and get the score of such a row.
Without training rows of both classes every score is the share of label 1 (0.5 without
rows). Repeated rows are scored row by row; a document with several labels counts with
the largest; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicelane.llm.common import record_batch, slices, small_batches, staged, utf8

#: Labels that a task may hold (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


@dataclass(frozen=True)
class Settings:
    trees: int = 24
    depth: int = 3
    rate: float = 0.3
    bins: int = 64
    #: Ridge on leaf values, and the least curvature of a leaf.
    ridge: float = 1.0
    least: float = 1.0
    #: Training rows (about) whose values set the edges of the bins; all rows set the trees.
    sample: int = 20_000
    #: Training rows of a task that adds up histograms.
    task_rows: int = 20_000


DEFAULT = Settings()

STATISTICS = (
    "words", "bytes", "word_bytes", "distinct_words", "distinct_pairs", "top_word", "upper", "digits",
    "symbols", "stops", "shouts", "other_marks", "beyond_ascii", "lines", "distinct_lines", "longest_line",
    "short_words", "long_words", "entropy", "top_byte",
)


def _mask(chars: bytes) -> np.ndarray:
    kind = np.zeros(256, np.int64)
    kind[list(chars)] = 1
    return kind


_KINDS = np.stack([
    _mask(bytes(range(65, 91))), _mask(b"0123456789"), _mask(b"#*$%&|<>"), _mask(b".,;:"), _mask(b"!?"),
    _mask(b"\"'()[]{}-_/\\=+~^`@"), _mask(bytes(range(128, 256))),
])
_SPACE = _mask(b" \t\n\r\x0b\x0c")


def statistics(text: str | None) -> np.ndarray:
    """The statistics of a whole text."""
    data = utf8(text)
    words = data.split()
    if not words:
        return np.zeros(len(STATISTICS), np.float32)
    n = len(words)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    solid = int(seen.sum() - seen @ _SPACE)
    kinds = _KINDS @ seen
    sizes = np.fromiter(map(len, words), np.int64, n)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = len(np.unique(ids[:-1] << 32 | ids[1:])) / (n - 1) if n > 1 else 1.0
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = seen[seen > 0] / len(data)
    return np.array(
        [
            np.log1p(n), np.log1p(len(data)), solid / n, len(numbers) / n, pairs, np.bincount(ids).max() / n,
            kinds[0] / solid, kinds[1] / solid, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / n,
            kinds[6] / solid, len(lines) / n, len(set(lines)) / len(lines), max(map(len, lines)) / len(data),
            (sizes <= 3).mean(), (sizes >= 12).mean(), -(share * np.log2(share)).sum(), share.max(),
        ],
        np.float32,
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows = [statistics(t).tobytes() for t in part.column("text").to_pylist()]
        yield record_batch([part.column("doc_id"), rows], ["doc_id", "stats"], [pa.int64(), pa.binary()])


def described(docs: DataFrame) -> DataFrame:
    """doc_id, stats: the statistics of every document row, as packed 32-bit floats."""
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(_describe, "doc_id bigint, stats binary")


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def edges_of(values: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per statistic at most ``bins`` - 1 edges, at quantiles of its values."""
    at = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(v, at, method="lower").astype(np.float32)) for v in values.T]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: how many edges lie below it."""
    columns = [np.searchsorted(e, v, "left") for e, v in zip(edges, values.T, strict=True)]
    return np.stack(columns, 1).astype(np.uint8)


@dataclass
class Forest:
    """Complete trees of equal depth, flattened: node k of a tree has children 2k+1, 2k+2."""

    start: float
    edges: list[np.ndarray]
    depth: int
    #: Trees x inner nodes: the statistic asked for, and the last bin that goes left.
    statistic: np.ndarray
    bound: np.ndarray
    #: Trees x leaves.
    value: np.ndarray = field(repr=False)

    def leaves(self, bins: np.ndarray, tree: int, depth: int) -> np.ndarray:
        """Node of each row after ``depth`` steps, counted from the left of its level."""
        rows, at = np.arange(len(bins)), np.zeros(len(bins), np.int64)
        for _ in range(depth):
            right = bins[rows, self.statistic[tree, at]] > self.bound[tree, at]
            at = 2 * at + 1 + right
        return at - (2**depth - 1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.start)
        for tree in range(len(self.value)):
            total += self.value[tree, self.leaves(bins, tree, self.depth)]
        return total

    def probability(self, values: np.ndarray) -> np.ndarray:
        """P(label 1) of rows of statistics."""
        return 1 / (1 + np.exp(-self.margin(binned(values, self.edges))))


#: Gradients and curvatures are added in steps of 2^-30.
_UNIT = 1 << 30
_CELLS = "cell int, g bigint, h bigint, n bigint"


def histograms(
    forest: Forest, partial: tuple[np.ndarray, np.ndarray], depth: int, n_bins: int, bins: np.ndarray, label: np.ndarray
) -> np.ndarray:
    """g, h and rows (whole numbers) by node of a level, statistic and bin."""
    p = 1 / (1 + np.exp(-forest.margin(bins)))
    growing = Forest(0.0, forest.edges, forest.depth, *[x[None] for x in partial], np.zeros((1, 1)))
    node = growing.leaves(bins, 0, depth)
    weights = [np.rint((p - label) * _UNIT), np.rint(p * (1 - p) * _UNIT)]
    out = np.zeros((2**depth, bins.shape[1], n_bins, 3), np.int64)
    for f in range(bins.shape[1]):
        cell = node * n_bins + bins[:, f]
        for k, w in enumerate(weights):
            # Up to 2^53 a float holds whole numbers exactly; a batch has fewer than 2^22 rows.
            out[:, f, :, k] = np.bincount(cell, w, 2**depth * n_bins).reshape(-1, n_bins).astype(np.int64)
        out[:, f, :, 2] = np.bincount(cell, minlength=2**depth * n_bins).reshape(-1, n_bins)
    return out


def _add_up(shared, depth: int, n_bins: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest, partial = shared.value
    total = None
    for batch in batches:
        if batch.num_rows:
            bins = _matrix(batch.column("bins"), np.uint8, len(STATISTICS))
            own = histograms(forest, partial, depth, n_bins, bins, batch.column("label").to_numpy())
            total = own if total is None else total + own
    if total is not None:
        flat = total.reshape(-1, 3)
        cell = np.flatnonzero(flat[:, 2])
        yield record_batch(
            [cell, *flat[cell].T], ["cell", "g", "h", "n"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        )


def best_splits(h: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Statistic and last bin on the left for each node; bin 255 sends all rows left.

    ``h`` is nodes x statistics x bins x (g, h, n). Equal gains go to the first statistic
    and the smallest bin.
    """
    left = np.cumsum(h[..., :2], 2)[:, :, :-1] / _UNIT
    whole = h[..., :2].sum(2, keepdims=True) / _UNIT
    right = whole - left
    worth = lambda x: x[..., 0] ** 2 / (x[..., 1] + settings.ridge)
    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[..., 1] < settings.least) | (right[..., 1] < settings.least)] = 0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1)
    useful = flat[np.arange(len(flat)), at] > 1e-9
    statistic, bound = np.divmod(at, gain.shape[2])
    return np.where(useful, statistic, 0), np.where(useful, bound, 255)


def _bin_rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bins = binned(_matrix(batch.column("stats"), np.float32, len(STATISTICS)), shared.value)
        yield record_batch(
            [batch.column("label"), [row.tobytes() for row in bins]], ["label", "bins"], [pa.int32(), pa.binary()]
        )


def train(rows: DataFrame, settings: Settings = DEFAULT) -> Forest:
    """Fit trees to all rows (doc_id, stats, label 0 or 1)."""
    spark = rows.sparkSession
    rows = staged(rows.select("doc_id", "stats", F.col("label").cast("int").alias("label")), "boost-labelled")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    width, inner = len(STATISTICS), 2**settings.depth - 1
    blank = np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1))
    share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
    start = float(np.log(share / (1 - share)))
    forest = Forest(start, [np.empty(0, np.float32)] * width, settings.depth, *blank)
    if not 0 < ones < n:
        return forest
    drawn = rows.filter(F.xxhash64(F.lit("edges"), "doc_id") / 2.0**64 + 0.5 < settings.sample / n)
    sample = [r["stats"] for r in drawn.select("stats").collect()]  # about `sample` rows
    if not sample:
        sample = [r["stats"] for r in rows.select("stats").limit(settings.sample).collect()]
    edges = edges_of(np.frombuffer(b"".join(sample), np.float32).reshape(-1, width), settings.bins)
    forest = Forest(start, edges, settings.depth, *blank)
    shared = spark.sparkContext.broadcast(edges)
    dealt = rows.repartition(-(-n // settings.task_rows)).select("label", "stats")
    bins = staged(dealt.mapInArrow(functools.partial(_bin_rows, shared), "label int, bins binary"), "boost-bins")
    for _ in range(settings.trees):
        forest = _with_tree(forest, bins, settings)
    return forest


def _with_tree(forest: Forest, bins: DataFrame, settings: Settings) -> Forest:
    """The forest with one more tree; a level is one job over all training rows."""
    width = len(STATISTICS)
    statistic = np.zeros(2**settings.depth - 1, np.int64)
    bound = np.full(2**settings.depth - 1, 255, np.int64)
    for depth in range(settings.depth):
        shared = bins.sparkSession.sparkContext.broadcast((forest, (statistic, bound)))
        cells = bins.mapInArrow(functools.partial(_add_up, shared, depth, settings.bins), _CELLS)
        sums = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
        found = sums.toArrow().to_pandas()  # nodes x statistics x bins rows at most
        shared.unpersist()
        h = np.zeros((2**depth * width * settings.bins, 3), np.int64)
        h[found["cell"]] = found[["g", "h", "n"]]
        h = h.reshape(2**depth, width, settings.bins, 3)
        level = slice(2**depth - 1, 2 ** (depth + 1) - 1)
        statistic[level], bound[level] = best_splits(h, settings)
    # The last level's histograms also hold the sums of its leaves.
    value = np.zeros(2**settings.depth)
    for node in range(2 ** (settings.depth - 1)):
        at = node + 2 ** (settings.depth - 1) - 1
        own = h[node, statistic[at], :, :2] / _UNIT
        cut = int(bound[at]) + 1
        for side, (g, c) in enumerate((own[:cut].sum(0), own[cut:].sum(0))):
            value[2 * node + side] = -settings.rate * g / (c + settings.ridge)
    return Forest(
        forest.start, forest.edges, forest.depth,
        np.vstack([forest.statistic, statistic]), np.vstack([forest.bound, bound]), np.vstack([forest.value, value]),
    )


def _score(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _matrix(batch.column("stats"), np.float32, len(STATISTICS))
        yield record_batch(
            [batch.column("doc_id"), shared.value.probability(values)], ["doc_id", "score"],
            [pa.int64(), pa.float64()],
        )


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, score of every row of ``described``."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)
    return rows.select("doc_id", "stats").mapInArrow(
        functools.partial(_score, shared), "doc_id bigint, score double"
    )


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, stats, label of described rows that have a label (doc_id, quality)."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") > 0).cast("int")).alias("label")
    )
    # Sent to all tasks only if counted to be small; else both sides are shuffled.
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return rows.select("doc_id", "stats").join(known, "doc_id")
