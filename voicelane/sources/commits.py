"""Deliveries to several folders that become visible together.

A writer first writes all folders of a delivery and then commits its key: one row in a
folder of its own below ``commits``. Readers take what committed keys name, so a writer
that dies in between leaves nothing that anybody reads, and may be run again under the
same key: it replaces its own folders. A committed key is final. Keys are caller-given
and should tell the content: the same key means the same delivery.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMMIT = "key string, payload string, at timestamp"
#: Committed keys that are sent to all tasks of a reader; more are joined by a shuffle.
MOST_KEYS = 100_000


def _checked(key: str) -> str:
    if not re.fullmatch(r"[\w.-]+", key):
        raise ValueError(f"a key has letters, digits, '.', '_' and '-' only: {key!r}")
    return key


def commits(spark: SparkSession, path: str) -> DataFrame:
    """key, payload, at of all commits below a folder, also if there is none yet."""
    # The folder has to be there to be read; an unfinished commit holds no part file.
    spark.createDataFrame([], _COMMIT).write.mode("ignore").parquet(f"{path}/key_of=")
    return spark.read.schema(_COMMIT).option("recursiveFileLookup", "true").parquet(path)


def committed(spark: SparkSession, path: str, key: str) -> dict | None:
    """What a key was committed with; None if it is not."""
    row = commits(spark, path).filter(F.col("key") == key).first()
    return None if row is None else json.loads(row["payload"])


def commit(spark: SparkSession, path: str, key: str, payload: dict | None = None) -> None:
    """Commit a key; a commit that died half-way is replaced, a finished one stays."""
    if committed(spark, path, _checked(key)) is None:
        row = spark.createDataFrame([(key, json.dumps(payload or {}))], "key string, payload string")
        row = row.withColumn("at", F.current_timestamp()).coalesce(1)
        row.write.mode("overwrite").parquet(f"{path}/key_of={key}")


def latest(spark: SparkSession, path: str) -> dict | None:
    """Payload of the newest commit; of equal times the largest key."""
    row = commits(spark, path).select(F.max_by("payload", F.struct("at", "key")).alias("p")).first()
    return None if row["p"] is None else json.loads(row["p"])


def deliver(tables: dict[str, DataFrame], path: str, key: str, fmt: str = "parquet") -> bool:
    """Write every table to its folder (a folder of the key below it), then commit the key.

    Returns whether anything was written: a committed key is left alone.
    """
    spark = next(iter(tables.values())).sparkSession
    if committed(spark, path, _checked(key)) is not None:
        return False
    for folder, rows in tables.items():
        rows.write.mode("overwrite").format(fmt).save(f"{folder}/delivery={key}")
    commit(spark, path, key, {"folders": list(tables)})
    return True


def delivered(spark: SparkSession, folder: str, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Rows of all committed deliveries in a folder, with the key as ``delivery``."""
    keys = commits(spark, path).select(F.col("key").alias("delivery"))
    rows = spark.read.schema(f"{schema}, delivery string").format(fmt).load(folder)
    return rows.join(F.broadcast(keys) if keys.count() <= MOST_KEYS else keys, "delivery", "left_semi")
