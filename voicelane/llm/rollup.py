"""Token counts kept up to date by signed changes.

The ledger keeps, per document and tokenizer version, what was last stored, and a
log of deltas by source, language and tokenizer version. A batch of changes becomes
signed rows: an insert adds, a delete takes away what was stored, a revised count
does both. The deltas are additive, so totals are one sum over the log.

Commits are idempotent. A batch writes under a fresh attempt; then one row in
``commits/<batch>`` names the attempt, written only if that place is empty. A batch
that is sent again finds it taken and changes nothing; an attempt that died before
its commit is never read.

Changes of one document and version in a batch: the largest (seq, action, source,
lang, n_tokens) wins, so repeated rows count once. Deleting what is not stored
changes nothing; inserting what is stored revises it. Null ids, sources, languages,
versions and actions are values of their own (a null action counts as an upsert);
null counts are 0. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voicelane.llm.common import staged

KEYS = ("source", "lang", "tokenizer")
DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
ENTRIES = (
    "doc_id bigint, tokenizer string, source string, lang string, n_tokens bigint, live boolean"
)


class Ledger:
    """A ledger in a folder that driver and executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._claim("", "none")

    def _claim(self, batch: str, attempt: str) -> None:
        row = self.spark.range(1).select(
            F.lit(batch).alias("batch_id"), F.lit(attempt).alias("attempt"),
            F.current_timestamp().alias("at"),
        )
        # A letter in front: Spark's readers pass over names that start with _ or a dot.
        path = f"{self.path}/commits/b{quote(batch, safe='')}"
        row.coalesce(1).write.mode("ignore").parquet(path)
        if batch and all(b != batch for b, _ in self.commits()):
            # A writer died in between and left a folder without a row.
            row.coalesce(1).write.mode("overwrite").parquet(path)

    def commits(self) -> list[tuple[str, str]]:
        """Batch and attempt of every commit, oldest first (one row per batch)."""
        rows = (
            self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")
            .filter("batch_id <> ''")
            .groupBy("batch_id").agg(F.min(F.struct("at", "attempt")).alias("first"))
            .orderBy("first").collect()
        )
        return [(r["batch_id"], r["first"]["attempt"]) for r in rows]

    def _read(self, kind: str, schema: str) -> DataFrame:
        parts = [
            self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/{attempt}")
            .withColumn("_order", F.lit(k))
            for k, (_, attempt) in enumerate(self.commits())
        ]
        if not parts:
            return self.spark.createDataFrame([], schema).withColumn("_order", F.lit(0))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def entries(self) -> DataFrame:
        """What is stored now, per document and tokenizer version."""
        last = F.max_by(F.struct("source", "lang", "n_tokens", "live"), "_order").alias("e")
        return (
            self._read("entries", ENTRIES).groupBy("doc_id", "tokenizer").agg(last)
            .select("doc_id", "tokenizer", "e.*").filter("live").drop("live")
        )

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        return (
            self._read("deltas", DELTAS).groupBy(*KEYS)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .filter("n_docs <> 0")
        )

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch of changes; False if the batch was committed before.

        Changes have doc_id, tokenizer, action ("upsert" or "delete"), source, lang,
        n_tokens and, if it matters, seq.
        """
        if any(b == batch for b, _ in self.commits()):
            return False
        attempt = f"b{quote(batch, safe=str())}-{uuid.uuid4().hex}"
        seq = F.col("seq").cast("bigint") if "seq" in changes.columns else F.lit(0).cast("bigint")
        change = F.struct(
            seq.alias("seq"), F.coalesce("action", F.lit("upsert")).alias("action"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
            F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0)).alias("n_tokens"),
        )
        wanted = (
            changes.groupBy(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("tokenizer").cast("string").alias("tokenizer"))
            .agg(F.max(change).alias("new"))
        )
        old = self.entries().select(
            F.col("doc_id").alias("_id"), F.col("tokenizer").alias("_version"),
            F.struct("source", "lang", "n_tokens").alias("old"),
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("tokenizer").eqNullSafe(F.col("_version"))
        met = wanted.join(old, same, "left")
        upsert = F.col("new.action") != "delete"
        # Entries and deltas are both made of this; the changes are computed once.
        met = staged(met.filter(upsert | F.col("old").isNotNull()).select("doc_id", "tokenizer", "new", "old"), "changes")
        met.select(
            "doc_id", "tokenizer",
            F.coalesce(F.when(upsert, F.col("new.source")), F.when(~upsert, F.col("old.source"))).alias("source"),
            F.coalesce(F.when(upsert, F.col("new.lang")), F.when(~upsert, F.col("old.lang"))).alias("lang"),
            F.when(upsert, F.col("new.n_tokens")).otherwise(F.lit(0)).alias("n_tokens"),
            upsert.alias("live"),
        ).write.parquet(f"{self.path}/entries/{attempt}")
        signed = lambda e, sign: F.struct(
            F.col(f"{e}.source").alias("source"), F.col(f"{e}.lang").alias("lang"),
            F.lit(sign).cast("bigint").alias("n_docs"), (sign * F.col(f"{e}.n_tokens")).alias("n_tokens"),
        )
        rows = F.array(F.when(upsert, signed("new", 1)), F.when(F.col("old").isNotNull(), signed("old", -1)))
        (
            met.select("tokenizer", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
            .groupBy("r.source", "r.lang", "tokenizer")
            .agg(F.sum("r.n_docs").alias("n_docs"), F.sum("r.n_tokens").alias("n_tokens"))
            .write.parquet(f"{self.path}/deltas/{attempt}")
        )
        self._claim(batch, attempt)
        return dict(self.commits())[batch] == attempt

    def adds_up(self) -> bool:
        """Whether the summed log equals the totals of what is stored."""
        stored = self.entries().groupBy(*KEYS).agg(
            F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        totals = self.totals()
        odd = stored.exceptAll(totals).union(totals.exceptAll(stored))
        return odd.limit(1).count() == 0
