"""Metrics and summaries over scored or labelled reviews.

Every operator is one aggregation with map-side partial sums, or a bounded top-k.
Label 0 is the class of interest (negative) throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.functions import text as tx
from voicelane.functions.numbers import digits_to_unit, hash_digits, safe_ratio
from voicelane.operators.topk import first_k

# --- fixed values -----------------------------------------------------------
F1_GATE = 0.85
SHORT_WORDS = 40
HISTOGRAM_CLIP, HISTOGRAM_BINS = 1000, 50
PREVIEW_CHARS = 400
SAMPLE_SIZE, SAMPLE_SEED = 3000, 42
# ----------------------------------------------------------------------------


def confusion(threshold: float = 0.5, p: str = "p_negative") -> list[Column]:
    """Aggregates counting negatives and flagged reviews."""
    actual, flagged = F.col("label") == 0, F.col(p) >= threshold
    return [
        F.count_if(actual & flagged).alias("tp"),
        F.count_if(~actual & flagged).alias("fp"),
        F.count_if(actual & ~flagged).alias("fn"),
        F.count_if(~actual & ~flagged).alias("tn"),
    ]


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 (0 where undefined) and the acceptance gate."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "*",
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_negative"),
        safe_ratio(tp, tp + fn).alias("recall_negative"),
        safe_ratio(tp, tp + fp).alias("precision_negative"),
    ).withColumn("passes_gate", F.col("f1_negative") >= F1_GATE)


def negative_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Confusion counts and rates of the negative class, one row."""
    return with_rates(scored.agg(*confusion(threshold)))


def precision_at_k(scored: DataFrame, ks: tuple[int, ...] = (100, 1000)) -> DataFrame:
    """Share of true negatives among the k reviews with the highest score.

    One distributed top-k of the largest k; equal scores are ordered by id.
    """
    top = first_k(
        scored.select("review_id", "label", "p_negative"),
        max(ks),
        level=-F.floor(F.col("p_negative") * 1000).cast("int"),
        order=[F.desc("p_negative"), F.col("review_id")],
    )
    rank = F.row_number().over(W.orderBy(F.desc("p_negative"), "review_id"))
    ranked = top.withColumn("rank", rank)  # at most max(ks) rows
    wanted = F.array(*[F.lit(k) for k in ks])
    hits = ranked.select(
        F.explode(F.filter(wanted, lambda k: F.col("rank") <= k)).alias("k"),
        (F.col("label") == 0).cast("double").alias("hit"),
    )
    return hits.groupBy("k").agg(F.avg("hit").alias("precision_at_k"))


def calibration(scored: DataFrame, n_bins: int = 10) -> DataFrame:
    """Mean predicted and actual share of negatives in equal-width score bins."""
    edges = [i / n_bins for i in range(1, n_bins)]
    bin_no = sum(((F.col("p_negative") > e).cast("int") for e in edges), F.lit(0))
    return (
        scored.select(bin_no.alias("bin"), "p_negative", "label")
        .groupBy("bin")
        .agg(
            F.avg("p_negative").alias("mean_predicted"),
            F.avg((F.col("label") == 0).cast("double")).alias("share_negative"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def class_balance(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def _length_counts(reviews: DataFrame) -> DataFrame:
    """n_words, n: reviews per length; the number of lengths is small."""
    return (
        reviews.select(tx.word_count(F.col("text")).alias("n_words"))
        .groupBy("n_words")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def length_summary(reviews: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles of the word counts.

    Reviews are first counted per length, so the exact percentiles run over the
    few distinct lengths with their frequencies.
    """
    x, n = F.col("n_words"), F.col("n")
    sums = _length_counts(reviews).agg(
        F.sum("n").alias("count"),
        F.sum(x.cast("decimal(20,0)") * n).cast("double").alias("s1"),
        F.sum(x.cast("decimal(20,0)") * x * n).cast("double").alias("s2"),
        F.min(x).cast("double").alias("min"),
        *[F.percentile(x, q, n).alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
        F.max(x).cast("double").alias("max"),
    )
    count = F.col("count")
    spread = (F.col("s2") - F.col("s1") * F.col("s1") / count) / (count - 1)
    return sums.select(
        "count",
        F.round(F.col("s1") / count, 1).alias("mean"),
        F.when(count > 1, F.round(F.sqrt(spread), 1)).alias("std"),
        F.round("min", 1).alias("min"),
        *[F.round(q, 1).alias(q) for q in ("p25", "p50", "p75")],
        F.round("max", 1).alias("max"),
    )


def length_histogram(
    reviews: DataFrame, clip: int = HISTOGRAM_CLIP, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Reviews per equal-width bin of clipped word counts; empty bins included."""
    clipped = (
        _length_counts(reviews)
        .groupBy(F.least(F.col("n_words"), F.lit(clip)).alias("length"))
        .agg(F.sum("n").alias("n"))
    )
    # At most clip + 1 rows from here on: one row holds the whole distribution.
    packed = clipped.agg(
        F.min("length").alias("lo"),
        F.max("length").alias("hi"),
        F.collect_list(F.struct("length", "n")).alias("lengths"),
    ).select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "lengths",
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    placed = packed.select(
        "lo", step.alias("step"), "lengths",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    left = F.col("bin") * F.col("step") + F.col("lo")
    right = (F.col("bin") + 1) * F.col("step") + F.col("lo")
    inside = F.filter(
        "lengths",
        lambda x: (x["length"] >= left)
        & ((x["length"] < right) | (F.col("bin") == bins - 1)),
    )
    return placed.select(
        "bin",
        left.alias("left_edge"),
        F.aggregate(inside, F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"]).alias("n"),
    )


def class_preview(reviews: DataFrame, chars: int = PREVIEW_CHARS) -> DataFrame:
    """The first review of each class by id, shortened for display."""
    return (
        reviews.select("label", "review_id", F.left("text", F.lit(chars)).alias("preview"))
        .groupBy("label")
        .agg(
            F.min("review_id").alias("review_id"),
            F.min_by("preview", "review_id").alias("preview"),
        )
    )


def fixed_sample(df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """A reproducible random sample of n rows: the n smallest hashes of the id."""
    digest = hash_digits(F.col("review_id"), F.lit(seed))
    level = F.conv(F.left(digest, F.lit(4)), 16, 10).cast("int")
    return first_k(df, n, level, [digest, F.col("review_id")])


def short_slice(reviews: DataFrame, most_words: int = SHORT_WORDS) -> DataFrame:
    return reviews.filter(tx.word_count(F.col("text")) <= most_words)


def compare_models(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Metrics per model over a long table model, review_id, label, p_negative."""
    return with_rates(scores.groupBy("model").agg(*confusion(threshold)))


def winner(results: DataFrame) -> DataFrame:
    """The configuration with the highest F1; the first one wins ties."""
    return results.orderBy(F.desc("f1_negative"), "config_no").limit(1)


def pseudo_score(review_id: Column, label: Column, salt: str = "") -> Column:
    """A reproducible stand-in for a model score, overlapping between the classes."""
    digest = hash_digits(review_id, F.lit(salt)) if salt else F.md5(review_id.cast("string"))
    base = F.when(label == 0, F.lit(0.35)).otherwise(F.lit(0.05))
    return base + F.lit(0.6) * digits_to_unit(digest)
