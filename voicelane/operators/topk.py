"""Exact top-k that stays small however many partitions there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_k(df: DataFrame, k: int, level: Column, order: list[Column]) -> DataFrame:
    """The first k rows in ``order``.

    ``level`` is a coarse integer that never decreases along ``order`` and takes few
    values. A plain limit would send k rows of every partition to one task. Here a
    histogram of the levels finds the last level the first k rows can reach, and
    only rows up to it are sorted. If all rows share a level nothing is saved and
    the result is still exact. Rows without a level come last.
    """
    levelled = df.withColumn("_level", F.coalesce(level.cast("bigint"), F.lit(2**62)))
    running = F.sum("n").over(W.orderBy("_level"))
    last = (
        levelled.groupBy("_level")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", running - F.col("n"))
        .filter(F.col("before") < k)
        .agg(F.max("_level"))
        .scalar()
    )
    return levelled.filter(F.col("_level") <= last).orderBy(*order).limit(k).drop("_level")
