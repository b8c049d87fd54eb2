"""Quality rules: base statistics of a text and the frequency of lines across documents.

Lines are normalised (ASCII case, blanks) and hashed with their host. A line that
more documents of a host hold than a limit allows is boilerplate: it is taken out of
all of them but the first (the one with the smallest id). A document is rejected if
it fails the base rules, or if it is depleted, that is if too little is left of it.
``judge`` tells what would be left, ``keep`` takes out lines and documents.

Null and empty texts have no words and fail the base rules. Each row counts as one
document; rows that repeat an id and its text get equal results. Rows without an id
are judged like others, but ``keep`` leaves their lines in. Hosts may be null. Extra
columns are ignored by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicelane.llm.common import (
    marked_rows, opened, record_batch, sealed, slices, small_batches, staged, utf8, without,
)

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line is boilerplate in more documents of its host than both limits.
    line_docs: int = 5
    line_share: float = 0.01
    #: A document is depleted if less than this share of its words is left.
    min_left: float = 0.5


DEFAULT = Rules()
FEATURES = (
    "doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "line_hashes array<bigint>, line_words array<int>"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # three ids would not fit 64 bits
        _, pairs = np.unique(pairs, return_inverse=True)
        keys = pairs[:-1] * (pairs.max() + 1) + pairs[1:]
    else:
        keys = pairs[:-1] * len(seen) + ids[2:]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    start = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= start
    return int(covered.sum())


def line_key(line: str) -> tuple[int, int] | None:
    """Hash of a line without case and surplus blanks, and its words; None without words."""
    inside = utf8(line).lower().split()
    return (xxhash.xxh3_64_intdigest(b" ".join(inside)), len(inside)) if inside else None


def describe(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines of one text.

    ``lines`` maps the hash of each distinct normalised line to its words in total.
    """
    text = text or ""
    words = utf8(text).split()
    seen, lines, duplicates = set(), {}, 0
    for line in text.split("\n"):
        found = line_key(line)
        if not found:
            continue
        duplicates += line in seen
        seen.add(line)
        key, size = found
        lines[key] = lines.get(key, 0) + size
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_words(words),
        lines,
    )


_TYPES = [
    pa.int64(), pa.string(), *[pa.int64()] * 6, pa.list_(pa.int64()), pa.list_(pa.int32()),
]


def _host_key(host: str | None) -> int:
    return xxhash.xxh3_64_intdigest(utf8(host)) + (host is None)


def _hashed(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest(utf8(text)) - 2**63


def _with_host(key: int, host: int) -> int:
    return (key ^ host * 0x9E3779B97F4A7C15) % 2**64 - 2**63


def without_lines(text: str, host: str | None, hashes: set[int]) -> str:
    """A text less its lines with one of ``hashes`` (as ``judge`` forms them)."""
    own, left = _host_key(host), []
    for line in text.split("\n"):
        found = line_key(line)
        if not found or _with_host(found[0], own) not in hashes:
            left.append(line)
    return "\n".join(left)


@F.pandas_udf(T.StringType())
def _stripped(text: pd.Series, host: pd.Series, hashes: pd.Series) -> pd.Series:
    rows = zip(text, host, hashes, strict=True)
    return pd.Series([t if t is None or k is None else without_lines(t, h, set(k.tolist())) for t, h, k in rows], dtype=object)


@F.pandas_udf(T.LongType())
def _text_hash(text: pd.Series) -> pd.Series:
    return pd.Series([_hashed(t) for t in text], dtype="int64")


def _describe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FEATURES.split(", ")]
    for part in slices(batches):
        texts = part.column("text").to_pylist()
        hosts = [_host_key(h) for h in part.column("host").to_pylist()]
        rows = [describe(t) for t in texts]
        columns = [
            part.column("doc_id"), part.column("host"),
            [_hashed(t) for t in texts],
            *[[r[k] for r in rows] for k in range(5)],
            [[_with_host(k, h) for k in r[5]] for r, h in zip(rows, hosts, strict=True)],
            [list(r[5].values()) for r in rows],
        ]
        yield record_batch(columns, names, _TYPES)


def _described(docs: DataFrame, host: str) -> DataFrame:
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text", F.col(host).cast("string").alias("host"))
    return staged(rows.mapInArrow(_describe_batches, FEATURES), "lines")


def _boilerplate(described: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, text_hash, line_hashes, line_words of lines to be taken out.

    Counting is one shuffle of line hashes that combines on the map side. It counts rows,
    of which there are at least as many as documents; only lines above the limit are
    joined back, each dealt over 16 parts, and their documents counted one by one. Rows
    that repeat an id are one document; rows without an id are told apart by their text.
    """
    document = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("text"))
    lines = described.select(
        "doc_id", "text_hash", "host",
        F.explode(F.arrays_zip("line_hashes", "line_words")).alias("line"),
    ).select("doc_id", "text_hash", "host", "line.line_hashes", "line.line_words")
    counted = (
        lines.groupBy(F.col("line_hashes").alias("line"))
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.first("host").alias("host"))
        .filter(F.col("n") > rules.line_docs)
    )
    sizes = (
        described.select(F.col("host").alias("_host"), document.alias("document")).distinct()
        .groupBy("_host").agg(F.count("*").alias("docs"))
    )
    limit = F.col("docs") * rules.line_share
    common = counted.join(sizes, F.col("host").eqNullSafe(F.col("_host"))).filter(F.col("n") > limit)
    common = common.select(
        "line", "first", "docs", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part")
    )
    dealt = lines.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(16)).cast("int"))
    met = dealt.join(common, (F.col("line_hashes") == F.col("line")) & (dealt["part"] == common["part"]))
    met = staged(met.select("doc_id", "text_hash", "line_hashes", "line_words", "first", "docs"), "common-lines")
    spread = (
        met.select("line_hashes", "docs", document.alias("document")).distinct()
        .groupBy("line_hashes").agg(F.count("*").alias("n"), F.first("docs").alias("docs"))
        .filter((F.col("n") > rules.line_docs) & (F.col("n") > limit))
    )
    return (
        met.filter(~F.col("doc_id").eqNullSafe(F.col("first")))
        .join(spread.select("line_hashes"), "line_hashes", "left_semi")
        .select("doc_id", "text_hash", "line_hashes", "line_words")
    )


def _verdicts(described: DataFrame, boilerplate: DataFrame, rules: Rules) -> DataFrame:
    removed = boilerplate.groupBy("doc_id", "text_hash").agg(F.sum("line_words").alias("removed"))
    # Rows that repeat an id and its text share one sum, so each takes its part of it.
    same = described.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_rows"))
    removed = removed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "removed")
    shares = same.join(
        removed,
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
    ).select("_id", "_hash", (F.col("removed") / F.col("_rows")).cast("bigint").alias("removed"))
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return (
        described.join(
            shares,
            F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")),
            "left",
        )
        .withColumn("base_failed", failed)
        .withColumn("left_words", left)
        .withColumn("kept", ~failed & (left >= rules.min_left * F.col("n_words")) & (left > 0))
        .select(
            "doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "left_words", "kept",
        )
    )


def judge(docs: DataFrame, host: str = "source", rules: Rules = DEFAULT) -> DataFrame:
    """Per document row: base statistics, base_failed, words left and kept."""
    described = _described(docs, host)
    return _verdicts(described, _boilerplate(described, rules), rules).drop("text_hash")


def keep(docs: DataFrame, host: str = "source", rules: Rules = DEFAULT) -> DataFrame:
    """Documents that pass, without boilerplate lines, with all their columns.

    Rows are told apart by id and text, so each text of an id (or of none) has a verdict
    and lines of its own. ``n_chars``, if there, follows a changed text.
    """
    own = ("doc_id", "text", host, "n_chars")
    given, docs = docs, sealed(docs, *own)
    described = _described(docs, host)
    lines = staged(_boilerplate(described, rules), "boilerplate")
    named = {"doc_id": "__id", "text_hash": "__hash"}
    bad = _verdicts(described, lines, rules).filter(~F.col("kept")).select("doc_id", "text_hash").distinct()
    bad = staged(bad.withColumnsRenamed(named), "rejected")
    # Of one text, no more hashes than there are boilerplate lines.
    changed = staged(
        lines.withColumnsRenamed(named).join(bad, ["__id", "__hash"], "left_anti").filter("__id is not null")
        .groupBy("__id", "__hash").agg(F.collect_set("line_hashes").alias("__hashes")),
        "stripped",
    )
    marked = marked_rows(docs, bad.select("__id").union(changed.select("__id")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash"))
    met = marked.filter("__maybe").withColumn("__own", _text_hash("text")).join(bad, same, "left_anti")
    met = met.join(changed, same, "left")
    met = met.withColumn("text", _stripped("text", F.col(host).cast("string"), "__hashes"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        met = met.withColumn("n_chars", F.when(F.col("__hashes").isNull(), F.col("n_chars")).otherwise(size))
    left = marked.filter("not __maybe").select(*docs.columns).union(met.select(*docs.columns))
    return opened(left, given, *own)
