"""L2-regularised logistic regression, solved until the gradient vanishes.

Minimises mean(loss) + penalty / 2 |w|^2 with a free intercept. The rows stay where they
are, packed into blocks of many entries that a task maps as arrays: an iteration is one
job, in which every task adds up loss and gradient of its rows; the sums of all tasks but
a few are added by a shuffle, and the driver takes a quasi-Newton step. Several penalties are
solved side by side and share each pass over the rows. The solver stops at a small norm
of the whole gradient, intercept included, not when the objective moves slowly.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicelane.config import scratch_path, small_batches

# --- settings ---------------------------------------------------------------
MAX_ITERATIONS = 1000
#: Norm of the gradient of the mean loss plus penalty at which the solver stops.
TOLERANCE = 1e-7
#: Steps remembered by the quasi-Newton update: each saved pass reads all rows once less.
MEMORY = 40
#: Bytes of partial sums the driver takes from the tasks of one pass; beyond it the
#: partial sums are added by a shuffle first.
DRIVER_BYTES = 4 << 20
#: Coordinates of a partial sum that travel together.
CHUNK = 1 << 13
#: Entries of the vectors that a task works on at a time.
ENTRIES = 1 << 18
# ----------------------------------------------------------------------------

_PARTS = "chunk int, part int, sums binary"


@dataclass(frozen=True)
class Solution:
    """Coefficients, intercept and how far from the optimum they are."""

    coef: np.ndarray
    intercept: float
    residual: float
    passes: int


def _add_rows(points: np.ndarray, label, starts, slots, values, loss: np.ndarray, slope: np.ndarray) -> None:
    """Add loss and gradient of some rows (sparse vectors) for every point."""
    n, sizes = len(label), np.diff(starts)
    row = np.repeat(np.arange(n), sizes)
    for k, point in enumerate(points):
        z = np.bincount(row, values * point[slots], n) + point[-1]
        loss[k] += np.logaddexp(0.0, z).sum() - z[label > 0].sum()
        gap = 0.5 * (1.0 + np.tanh(0.5 * z)) - label
        slope[k, :-1] += np.bincount(slots, values * np.repeat(gap, sizes), slope.shape[1] - 1)
        slope[k, -1] += gap.sum()


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """label, starts, slots, values of runs of rows with about ``ENTRIES`` entries."""
    label = batch.column("label").to_numpy()
    offsets = batch.column("indices").offsets.to_numpy()
    slots, values = batch.column("indices").flatten().to_numpy(), batch.column("values").flatten().to_numpy()
    offsets = offsets - offsets[0]
    at = 0
    while at < len(label):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + ENTRIES, "right")) - 1)
        own = slice(offsets[at], offsets[to])
        yield label[at:to], offsets[at : to + 1] - offsets[at], slots[own], values[own]
        at = to


_BLOCK = ("label", "starts", "slots", "weights")
#: Settings that the session of the blocks takes over.
_PASSED_ON = ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxBytesPerBatch")
_DTYPES = (np.float64, np.int64, np.int32, np.float64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for arrays in _arrays(batch):
            cells = [np.ascontiguousarray(x, t).tobytes() for x, t in zip(arrays, _DTYPES)]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], list(_BLOCK))


def packed(rows: DataFrame) -> DataFrame:
    """The rows as blocks of arrays, stored: passes over them convert no single entry.

    They are read by as many tasks as there are cores, so the partial sums of a pass do
    not grow with the rows. Reading takes most of a pass: the blocks don't compress and are
    large cells, so they are stored as they are and read one by one, not into batches of
    thousands. That is a setting of a session, so they get a session of their own.
    """
    path = scratch_path(rows.sparkSession, "blocks")
    blocks = small_batches(rows).mapInArrow(_pack, ", ".join(f"{c} binary" for c in _BLOCK))
    blocks.write.option("compression", "uncompressed").parquet(path)
    reader = rows.sparkSession.newSession()
    for key in _PASSED_ON:
        reader.conf.set(key, rows.sparkSession.conf.get(key))
    reader.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    return reader.read.parquet(path).coalesce(reader.sparkContext.defaultParallelism)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    if "starts" not in batch.schema.names:
        yield from _arrays(batch)
        return
    for cells in zip(*[batch.column(c) for c in _BLOCK]):
        yield tuple(np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, _DTYPES))


def _partial(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    points = shared.value
    loss, slope, any_rows = np.zeros(len(points)), np.zeros(points.shape), False
    for batch in batches:
        for run in _runs(batch):
            _add_rows(points, *run, loss, slope)
            any_rows = True
    if not any_rows:
        return
    part = TaskContext.get().partitionId()
    size = slope.shape[1]
    chunks = [(-1, loss), *((k, slope[:, a : a + CHUNK]) for k, a in enumerate(range(0, size, CHUNK)))]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k for k, _ in chunks], pa.int32()), pa.array([part] * len(chunks), pa.int32()),
            pa.array([np.ascontiguousarray(x).tobytes() for _, x in chunks], pa.binary()),
        ],
        ["chunk", "part", "sums"],
    )


def _add_parts(table: pa.Table) -> pa.Table:
    """One sum per chunk; parts are added in order, so that reruns agree."""
    ordered = table.sort_by("part")
    total = sum(np.frombuffer(x, np.float64) for x in ordered.column("sums").to_pylist())
    return pa.table(
        {
            "chunk": ordered.column("chunk").slice(0, 1), "part": pa.array([0], pa.int32()),
            "sums": pa.array([total.tobytes()], pa.binary()),
        }
    )


def evaluate(rows: DataFrame, points: np.ndarray, driver_bytes: int = DRIVER_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Summed loss and gradient at each point (coefficients, then intercept), in one job.

    ``rows`` holds label, indices, values, or blocks of ``packed``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(points)
    parts = rows.mapInArrow(functools.partial(_partial, shared), _PARTS)
    if rows.rdd.getNumPartitions() * points.nbytes > driver_bytes:
        parts = parts.groupBy("chunk").applyInArrow(_add_parts, _PARTS)
    loss, slope = np.zeros(len(points)), np.zeros(points.shape)
    for r in sorted(parts.collect(), key=lambda r: (r["chunk"], r["part"])):
        sums = np.frombuffer(r["sums"], np.float64)
        if r["chunk"] < 0:
            loss += sums
        else:
            at = r["chunk"] * CHUNK
            slope[:, at : at + CHUNK] += sums.reshape(len(points), -1)
    shared.destroy()
    return loss, slope


def _direction(slope: np.ndarray, steps: deque) -> np.ndarray:
    """Minus the gradient times the inverse curvature seen in the last steps."""
    d, factors = -slope, []
    for s, y, sy in reversed(steps):
        a = (s @ d) / sy
        factors.append(a)
        d = d - a * y
    if steps:
        s, y, sy = steps[-1]
        d = d * (sy / (y @ y))
    for (s, y, sy), a in zip(steps, reversed(factors)):
        d = d + s * (a - (y @ d) / sy)
    return d


def _descent(size: int, penalty: float, tolerance: float, most: int) -> Generator:
    """Ask for mean loss and gradient at points, one after the other; return a Solution."""

    def whole(point, answer):
        loss, slope = answer
        slope = slope.copy()
        slope[:-1] += penalty * point[:-1]
        return loss + 0.5 * penalty * (point[:-1] @ point[:-1]), slope

    x, passes = np.zeros(size + 1), 1
    f, g = whole(x, (yield x))
    steps: deque = deque(maxlen=MEMORY)
    while np.linalg.norm(g) > tolerance and passes < most:
        d = _direction(g, steps)
        fall = g @ d
        if fall >= 0:
            steps.clear()
            d, fall = -g, -(g @ g)
        low, high, step = 0.0, np.inf, 1.0
        for _ in range(30):
            new = x + step * d
            passes += 1
            f_new, g_new = whole(new, (yield new))
            turn = g_new @ d
            # Far down, values of f differ by less than their rounding; slopes still tell.
            lower = f_new <= f + 1e-4 * step * fall or (f_new <= f + 1e-10 * abs(f) and turn <= -0.98 * fall)
            if not lower or turn > -0.9 * fall:
                high = step
            elif turn < 0.9 * fall:
                low = step
            else:
                break
            step = (low + high) / 2 if high < np.inf else 2 * step
        s, y = new - x, g_new - g
        if s @ y > 1e-14 * (y @ y):
            steps.append((s, y, s @ y))
        x, f, g = new, f_new, g_new
    return Solution(x[:-1], float(x[-1]), float(np.linalg.norm(g)), passes)


def solve(
    rows: DataFrame, size: int, penalties: list[float], tolerance: float = TOLERANCE,
    max_iterations: int = MAX_ITERATIONS,
) -> list[Solution]:
    """One solution per penalty. ``rows`` holds label (0 or 1), indices, values.

    All penalties not yet at their optimum share each pass over the rows.
    """
    n = rows.count()
    if n == 0:
        raise ValueError("no training rows")
    paths = [_descent(size, p, tolerance, max_iterations) for p in penalties]
    asked = {k: next(path) for k, path in enumerate(paths)}
    rows = packed(rows)
    done: dict[int, Solution] = {}
    while asked:
        order = list(asked)
        loss, slope = evaluate(rows, np.stack([asked[k] for k in order]))
        for j, k in enumerate(order):
            try:
                asked[k] = paths[k].send((loss[j] / n, slope[j] / n))
            except StopIteration as stop:
                done[k] = stop.value
                del asked[k]
    return [done[k] for k in range(len(penalties))]


def as_rows(vectors: DataFrame) -> DataFrame:
    """label, indices, values of a table of ML vectors (label, features)."""
    return vectors.withColumn("_v", F.unwrap_udt("features")).select(
        F.col("label").cast("double").alias("label"), F.col("_v.indices").alias("indices"),
        F.col("_v.values").alias("values"),
    )
