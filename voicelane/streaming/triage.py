"""Scoring and routing reviews as they arrive.

Scoring is stateless and row-local, so the batch functions run on a stream as
they are: no watermark, no state, no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voicelane.operators.routing import ROUTES
from voicelane.sources.reviews import reject_reason, response

Scorer = Callable[[DataFrame], DataFrame]
REJECTS = "rejected"


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Let the next start run the last micro-batch of a stopped query again; its number.

    This is the state after a failure between the output of a batch and its commit. Batch
    and offsets stay as they were, so the batch is replayed and not read anew.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(conf)
    last = max(int(f.getPath().getName()) for f in files.listStatus(folder) if f.getPath().getName().isdigit())
    files.delete(jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)
    return last


def start_scoring(
    reviews: DataFrame, scorer: Scorer, path: str, checkpoint: str, available_now: bool = True,
    partitions: int | None = None,
) -> StreamingQuery:
    """Append scored reviews to Parquet by route; the file sink commits each batch once.

    A source of few files is read by as many tasks; ``partitions`` deals each micro-batch
    over more of them before it is scored.
    """
    reviews = reviews.repartition(partitions) if partitions else reviews
    accepted = reviews.filter(reject_reason(F.col("text")).isNull())
    writer = (
        response(scorer(accepted))
        .writeStream.format("parquet")
        .partitionBy("route")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_routing(
    reviews: DataFrame, scorer: Scorer, sinks: dict[str, str], checkpoint: str,
    available_now: bool = True, partitions: int | None = None,
) -> StreamingQuery:
    """Send each route and the rejects to a folder of their own.

    ``sinks`` maps every route and ``rejected`` to a path. Each micro-batch is
    scored once and overwrites its own ``batch_id`` folders, so a batch replayed
    after a failure replaces its output instead of adding to it. An empty folder
    ``batch_id=-1`` makes every sink readable before the first batch. The folders of a
    batch are written side by side. ``partitions`` deals each micro-batch over as many
    tasks before it is scored, for sources of few files.
    """
    missing = {*ROUTES, REJECTS} - set(sinks)
    if missing:
        raise ValueError(f"no sink for {sorted(missing)}")

    def write(batch: DataFrame, batch_id: int) -> None:
        dealt = batch.repartition(partitions) if partitions else batch
        judged = dealt.withColumn("reason", reject_reason(F.col("text"))).persist()
        scored = response(scorer(judged.filter("reason is null").drop("reason"))).persist()
        try:
            outputs = {r: scored.filter(F.col("route") == r) for r in ROUTES}
            outputs[REJECTS] = judged.filter("reason is not null")

            @inheritable_thread_target(batch.sparkSession)
            def store(name: str) -> None:
                outputs[name].write.mode("overwrite").parquet(f"{sinks[name]}/batch_id={batch_id}")

            scored.count()  # once for all folders
            with ThreadPoolExecutor(len(outputs)) as pool:
                list(pool.map(store, outputs))
        finally:
            scored.unpersist()
            judged.unpersist()

    none = reviews.sparkSession.createDataFrame([], reviews.schema)
    for name in (*ROUTES, REJECTS):
        empty = none.withColumn("reason", F.lit("")) if name == REJECTS else response(scorer(none))
        empty.write.mode("ignore").parquet(f"{sinks[name]}/batch_id=-1")
    writer = reviews.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
