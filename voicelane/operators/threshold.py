"""Which score threshold earns the most."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Assumptions:
    """Monthly business case."""

    # --- fixed values -------------------------------------------------------
    reviews_per_month: int = 300_000
    p_at_risk: float = 0.30
    win_back_rate: float = 0.15
    arpu: float = 10.0
    retained_months: int = 6
    contact_cost: float = 1.0
    # ------------------------------------------------------------------------

    @property
    def value_per_save(self) -> float:
        return self.arpu * self.retained_months

    @property
    def breakeven_precision(self) -> float:
        """Precision at which a contact pays if every flagged negative is at risk."""
        return self.contact_cost / (self.win_back_rate * self.value_per_save)

    @property
    def marginal_breakeven(self) -> float:
        """Precision at which the profit curve itself turns."""
        return self.breakeven_precision / self.p_at_risk


def default_grid() -> list[float]:
    return [float(t) for t in np.linspace(0.01, 0.99, 99)]


def profit_curve(
    scored: DataFrame,
    assumptions: Assumptions | None = None,
    thresholds: list[float] | None = None,
) -> DataFrame:
    """t_no, t, contacted, caught, profit, precision for every threshold.

    One pass puts each score between two thresholds and counts; a running sum
    from the top over those few buckets gives what each threshold flags. A null or
    NaN score reaches no threshold and counts in the total only.
    """
    a = assumptions or Assumptions()
    grid = sorted(default_grid() if thresholds is None else thresholds)
    bucketizer = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol="p_negative", outputCol="_bucket"
    )
    lowest = F.lit(float("-inf"))
    score = F.coalesce(F.nanvl(F.col("p_negative").cast("double"), lowest), lowest)
    counts = (
        bucketizer.transform(scored.select("label", score.alias("p_negative")))
        .groupBy(F.col("_bucket").cast("int").alias("t_no"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 0).alias("neg"))
    )
    spark = scored.sparkSession
    # Row 0 stands for scores below every threshold; it only counts in the total.
    ladder = spark.createDataFrame(
        [(i, t) for i, t in enumerate([None, *grid])], "t_no int, t double"
    )
    steps = ladder.join(F.broadcast(counts), "t_no", "left").na.fill(0, ["n", "neg"])
    from_top = W.orderBy(F.desc("t_no")).rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.partitionBy()
    flagged = steps.select(
        "t_no",
        "t",
        F.sum("n").over(from_top).alias("flagged"),
        F.sum("neg").over(from_top).alias("flagged_negative"),
        (F.lit(float(a.reviews_per_month)) / F.sum("n").over(everything)).alias("scale"),
    ).filter(F.col("t").isNotNull())
    return (
        flagged.withColumn("contacted", F.col("flagged") * F.col("scale"))
        .withColumn("caught", F.col("flagged_negative") * F.col("scale"))
        .withColumn("saved", F.col("caught") * a.p_at_risk * a.win_back_rate)
        .select(
            "t_no",
            "t",
            "contacted",
            "caught",
            "saved",
            (F.col("saved") * a.value_per_save - F.col("contacted") * a.contact_cost).alias(
                "profit"
            ),
            F.when(F.col("flagged") == 0, F.lit(0.0))
            .otherwise(F.col("flagged_negative") / F.col("flagged"))
            .alias("precision"),
        )
    )


def optimal(curve: DataFrame) -> DataFrame:
    """The most profitable threshold with its volume and precision; first one wins."""
    return (
        curve.orderBy(F.desc("profit"), "t")
        .limit(1)
        .select("t", "profit", "contacted", "precision")
    )


def threshold_gain(curve: DataFrame, default: float = 0.5) -> DataFrame:
    """Profit at the optimum, at the threshold nearest the default, and the gain."""
    best = F.max("profit")
    # Nearest to the default; of equally near ones the lower.
    usual = F.min_by("profit", F.struct(F.abs(F.col("t") - default), F.col("t")))
    return curve.agg(
        best.alias("optimal_profit"), usual.alias("default_profit")
    ).withColumn("gain", F.col("optimal_profit") - F.col("default_profit"))


def above_break_even(curve: DataFrame, assumptions: Assumptions | None = None) -> DataFrame:
    """Thresholds whose precision stays above the break-even precision."""
    a = assumptions or Assumptions()
    return curve.filter(F.col("precision") > a.breakeven_precision).select(
        "t", "precision", F.lit(a.breakeven_precision).alias("breakeven_precision")
    )
