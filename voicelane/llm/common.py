"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voicelane.config import scratch_path, small_batches  # noqa: F401  (used by the operators)

#: ASCII letters and digits stay (letters in lower case), other ASCII becomes a blank,
#: bytes of longer characters stay: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
#: The same words in a text as it is written.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def folded_words(text: str | None) -> list[bytes]:
    """Words of a whole text without case and punctuation."""
    return utf8(text).translate(FOLD).split()


_IN_WORD = np.array([b != 32 for b in FOLD], np.int8)


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets (start, stop) of the words of a text as it is written."""
    data = np.frombuffer(utf8(text), np.uint8)
    edge = np.diff(_IN_WORD[data], prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(data) == len(text):
        return starts, stops
    # Bytes that continue a character don't count.
    before = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80)))
    return starts - before[starts], stops - before[stops]


class WordHashes(dict):
    """64-bit hashes of words, each computed once; emptied when it grows large."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


#: Texts that a task works on at a time.
TEXTS_AT_ONCE = 250


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXTS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that what a task holds beside a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def record_batch(columns: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def sealed(docs: DataFrame, *own: str) -> DataFrame:
    """The columns ``own``, as far as they are there, and all others inside ``_rest``.

    Whatever extra columns are called, none meets a name that an operator gives.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(
        *[c for c in own if c in docs.columns], (F.struct(*rest) if rest else F.lit(True)).alias("_rest")
    )


def opened(rows: DataFrame, docs: DataFrame, *own: str) -> DataFrame:
    """Rows that ``sealed`` made of ``docs``, with the columns of ``docs`` again."""
    return rows.select(*[
        F.col(c) if c in own else F.col("_rest").getField(c).alias(c) for c in docs.columns
    ])


def sha256_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: Slots of the bitmap that stands for a set of ids (4 MB, whatever the set's size).
SLOTS = 1 << 25


def _slot(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("bigint")), F.lit(SLOTS)) + 1


def marked_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents with ``__maybe``: false only if the id surely is not among ``ids``.

    Ids are hashed into a bitmap of fixed size, which is sent to all tasks in up to
    1,024 rows of 4 KB. So long texts need no shuffle only to find a few of them; a
    set too large for the bitmap just leaves more rows to the exact join after it.
    """
    slot = _slot(ids[ids.columns[0]])
    bitmaps = ids.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bits")
    )
    place = F.bitmap_bit_position(_slot(docs["doc_id"]))
    met = docs.withColumn("__place", place).join(
        F.broadcast(bitmaps), F.bitmap_bucket_number(_slot(docs["doc_id"])) == F.col("__bucket"), "left"
    )
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.col("__place") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.pmod(F.floor(byte.cast("int") / F.pow(F.lit(2), F.col("__place") % 8)), F.lit(2)) == 1
    return met.withColumn("__maybe", F.coalesce(bit, F.lit(False))).drop("__place", "__bucket", "__bits")


def within(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is among ``ids`` (one column)."""
    own = ids.select(ids[ids.columns[0]].alias("__id"))
    some = marked_rows(docs, ids).filter("__maybe").drop("__maybe")
    return some.join(own, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not among ``ids`` (one column); a null id matches a null."""
    own = ids.select(ids[ids.columns[0]].alias("__id"))
    marked = marked_rows(docs, ids)
    some = marked.filter("__maybe").join(own, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")
    return marked.filter("not __maybe").union(some).drop("__maybe")


def bitmap_of(slots: DataFrame, size: int) -> np.ndarray:
    """A set of numbers below ``size`` (the one column of ``slots``) as bits, 8 to a byte."""
    slot = slots[slots.columns[0]] + 1
    rows = slots.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    ).collect()  # at most size / 32,768 rows of 4 KB
    whole = np.zeros(size // 8, np.uint8)
    for r in rows:
        bits = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * 4096
        whole[at : at + len(bits)] = bits
    return whole


def components(links: DataFrame, name: str) -> DataFrame:
    """node, root: the smallest node each node of undirected links (a, b) is linked with.

    Every round takes over the smallest root among the neighbours and then jumps to
    the root of that root, so chains shorten by powers of two. A round ends in a
    staged table. Rows are pairs of ids; nothing is gathered by group.
    """
    both = staged(
        links.select("a", "b")
        .union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a is not null and b is not null")
        .distinct(),
        f"{name}-links",
    )
    roots = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("root")
    )
    roots = staged(roots, f"{name}-roots")
    while True:
        near = (
            both.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = roots.join(near, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        up = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        moved = staged(
            lower.join(up, "root", "left").select(
                "node", "was", F.least("root", F.coalesce("top", "root")).alias("root")
            ),
            f"{name}-roots",
        )
        if not moved.filter("root <> was").limit(1).count():
            return roots
        roots = moved.select("node", "root")


def joined_components(roots: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Roots (node, root) of ``components`` after more links (a, b) were found.

    Only the classes that the new links join are linked again, not all their members.
    """
    root_of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}"))
    ends = staged(links.select("a", "b").join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        "a", "b", F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("_b")
    ), f"{name}-ends")
    linked = ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")).filter("a <> b")
    tops = components(linked, name).select(F.col("node").alias("root"), F.col("root").alias("top"))
    new = ends.select(F.col("a").alias("node"), F.col("_a").alias("root")).union(ends.select("b", "_b"))
    every = roots.union(new).distinct().join(tops, "root", "left")
    return staged(every.select("node", F.coalesce("top", "root").alias("root")), f"{name}-roots")
