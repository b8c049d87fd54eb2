"""Reading, checking and writing reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicelane.functions import text as tx
from voicelane.functions.numbers import digits_to_int, hash_digits
from voicelane.sources import commits as cm

# --- fixed values -----------------------------------------------------------
MAX_CHARS = 20_000
# ----------------------------------------------------------------------------

INCOMING = T.StructType(
    [T.StructField("review_id", T.LongType()), T.StructField("text", T.StringType())]
)


#: Session setting: input partitions for tables of few files. Unset, tables are read as
#: they come, without a shuffle.
INPUT_PARTITIONS = "voicelane.inputPartitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the input over the partitions that the session asks for, if it does."""
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted), key) if wanted else df


def split_of(review_id: Column) -> Column:
    """'train' or 'test', fixed for each review by a hash of its id."""
    half = digits_to_int(hash_digits(review_id, F.lit("split")), 1) % 2
    return F.when(half == 0, "train").otherwise("test")


def load_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Labelled corpus: review_id, text, label (0 = negative), split."""
    documents = spark.read.parquet(f"{path}/documents.parquet").select(
        F.col("doc_id").alias("review_id"), "text"
    )
    labels = spark.read.parquet(f"{path}/labels.parquet").select(
        F.col("doc_id").alias("review_id"), F.col("quality").alias("label")
    )
    return documents.join(labels, "review_id").withColumn("split", split_of(F.col("review_id")))


def read_reviews(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    streaming: bool = False,
    files_per_trigger: int | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Unscored reviews as a batch or a stream, under a fixed schema.

    ``malformed`` names a column for lines that can't be parsed, kept as they came.
    """
    schema = T.StructType(list(INCOMING))
    reader = (spark.readStream if streaming else spark.read).format(fmt)
    if malformed:
        schema = schema.add(malformed, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    reader = reader.schema(schema)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def reject_reason(text: Column) -> Column:
    """Why a review cannot be scored; null if it can."""
    return (
        F.when(text.isNull(), "missing")
        .when(F.length(text) == 0, "empty")
        .when(F.length(text) > MAX_CHARS, "too_long")
        .when(tx.is_blank(text), "blank")
    )


def validate(df: DataFrame, malformed: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into accepted reviews and rejected ones with a reason.

    ``malformed`` is the column of ``read_reviews`` with lines that can't be parsed.
    """
    reason = reject_reason(F.col("text"))
    if malformed:
        reason = F.when(F.col(malformed).isNotNull(), "malformed").otherwise(reason)
    judged = df.withColumn("reason", reason)
    return (
        judged.filter(F.col("reason").isNull()).drop("reason"),
        judged.filter(F.col("reason").isNotNull()),
    )


def write_scored(scored: DataFrame, path: str, mode: str = "append") -> None:
    """Store scored reviews by route, in the response shape."""
    response(scored).write.mode(mode).partitionBy("route").parquet(path)


def response(scored: DataFrame) -> DataFrame:
    return scored.select(
        "review_id", "p_negative", "urgency", F.col("signals").alias("urgency_signals"), "route"
    )


def fan_out(
    scored: DataFrame, sinks: dict[str, str], mode: str = "append",
    commits: str | None = None, key: str | None = None,
) -> None:
    """Write each route's reviews to its own destination.

    The scores are stored once while they are written out; every sink then only
    filters the stored rows. A route without a sink is refused before anything is
    written. With ``commits`` (a folder) and ``key`` the delivery is all or nothing:
    ``lane`` shows it only once every sink has it, and running it again under its key
    adds nothing twice.
    """
    if (commits is None) != (key is None):
        raise ValueError("commits and key go together")
    if key is not None and cm.committed(scored.sparkSession, commits, key) is not None:
        return  # nothing is scored again
    kept = response(scored).persist()
    try:
        known = F.coalesce(F.col("route").isin(*sinks), F.lit(False))
        lost = [r["route"] for r in kept.filter(~known).select("route").distinct().limit(10).collect()]
        if lost:
            raise ValueError(f"no sink for {lost}")
        lanes = {path: kept.filter(F.col("route") == route) for route, path in sinks.items()}
        if key is not None:
            cm.deliver(lanes, commits, key, "json")
            return
        for path, rows in lanes.items():
            rows.write.mode(mode).json(path)
    finally:
        kept.unpersist()


def lane(spark: SparkSession, path: str, commits: str, schema: str) -> DataFrame:
    """Reviews of one sink from all finished deliveries of ``fan_out``."""
    return cm.delivered(spark, path, commits, schema, "json")
