"""Linear sentiment model over tf-idf features: fit, apply, save, inspect."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voicelane.config import scratch_path
from voicelane.functions.fence import computed_once
from voicelane.functions.numbers import round_exact
from voicelane.functions.text import rules_fingerprint
from voicelane.operators import features as ft
from voicelane.operators import solver
from voicelane.sources import commits as cm

# --- fixed values -----------------------------------------------------------
PROBE_TEXTS = (
    "this movie was bad", "this movie was vad", "the film was worst",
    "the film was borst", "absolutely terrible acting", "absolutely terrable acting",
    "i dont like it", "i love it", "this movie was wonderful", "its boring", "its borst",
    "Charged twice, I want a REFUND, cancelling today!!!",
    "The ending felt rushed and the pacing dragged.",
)
# ----------------------------------------------------------------------------


@dataclass
class ReviewModel:
    """Feature space, coefficients by joint feature id, intercept. Label 0 is negative."""

    space: ft.FeatureSpace
    coef: np.ndarray
    intercept: float

    def with_p_negative(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``p_negative``, unrounded. Row-local; unknown text keeps the intercept."""
        df = self.space.with_inputs(df, text).withColumn(
            "_margin", self.space.margin(self.coef)
        )
        return computed_once(
            df.drop(*self.space.scratch()), "p_negative", self.probability(F.col("_margin"))
        ).drop("_margin")

    def probability(self, margin: Column) -> Column:
        """P(negative) from the margin without intercept."""
        return 1.0 - 1.0 / (1.0 + F.exp(-(F.lit(float(self.intercept)) + margin)))

    def features_frame(self, spark: SparkSession) -> DataFrame:
        """block, term, feature_id, idf, coef; ids run on from words to characters."""
        rows = pd.concat(
            pd.DataFrame(
                {
                    "block": part.name,
                    "term": part.terms,
                    "feature_id": part.feature_ids.astype("int64"),
                    "idf": part.idf,
                    "coef": self.coef[part.feature_ids],
                }
            )
            for part in self.space.parts
        )
        return spark.createDataFrame(
            rows, "block string, term string, feature_id bigint, idf double, coef double"
        )

    @classmethod
    def from_features(cls, table: DataFrame, intercept: float, **ranges) -> ReviewModel:
        """Build from a table block, term, idf, coef (bounded by max_features)."""
        space = ft.FeatureSpace.from_vocab(table, **ranges)
        known = table.select("block", "term", "coef").toArrow().to_pandas()
        known = known.set_index(["block", "term"])["coef"]
        coef = np.zeros(space.size)
        for part in space.parts:
            coef[part.feature_ids] = known.loc[part.name].loc[part.terms].to_numpy()
        return cls(space, coef, intercept)

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the feature table with the intercept and the rules it was fitted under.

        Every save is a version in a folder of its own, which becomes the current one by
        a single commit at the end: readers see the old version or the new one.
        """
        version = uuid.uuid4().hex
        self.features_frame(spark).write.parquet(f"{path}/versions/{version}")
        spans = {f"{part.name}_range": part.span for part in self.space.parts}
        meta = {"intercept": float(self.intercept), "spans": spans, "version": version}
        cm.commit(spark, f"{path}/commits", version, meta | {"text_rules": rules_fingerprint()})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ReviewModel:
        """The version committed last."""
        meta = cm.latest(spark, f"{path}/commits")
        if meta is None:
            raise ValueError(f"no model was saved in {path}")
        if meta["text_rules"] != rules_fingerprint():
            raise ValueError("the model was fitted under other text rules; fit it again")
        return cls.from_features(
            spark.read.parquet(f"{path}/versions/{meta['version']}"),
            meta["intercept"],
            **{name: tuple(span) for name, span in meta["spans"].items()},
        )


def fit_space(
    train: DataFrame,
    max_features: int = ft.MAX_FEATURES,
    ngram: tuple[int, int] = ft.WORD_RANGE,
    char_ngram: tuple[int, int] = ft.CHAR_RANGE,
    use_char: bool = True,
    counts: dict[tuple, DataFrame] | None = None,
) -> ft.FeatureSpace:
    """Vocabulary and idf from training reviews.

    ``counts`` may hold tables of ``features.term_counts`` by (block, span); several
    vocabularies can be cut from one.
    """

    def cut(block: str, span: tuple[int, int]) -> DataFrame:
        known = (counts or {}).get((block, span))
        if known is None and block == "word":
            known = ft.word_counts_for(train, span, max_features)
        return ft.build_vocab(
            ft.term_counts(train, block, span) if known is None else known, block, max_features
        )

    vocab = cut("word", ngram)
    if use_char:
        vocab = vocab.unionByName(cut("char", char_ngram))
    return ft.FeatureSpace.from_vocab(
        ft.with_idf(vocab, F.lit(train.count())), word_range=ngram, char_range=char_ngram
    )


def prepared(train: DataFrame) -> DataFrame:
    """label and ``_norm`` of training rows, stored once: every later pass reads those."""
    path = scratch_path(train.sparkSession, "train")
    ft.normed(train.select("label", "text")).select("label", "_norm").write.parquet(path)
    return train.sparkSession.read.parquet(path)


def write_vectors(train: DataFrame, space: ft.FeatureSpace) -> DataFrame:
    """Vectorised training rows, written once and read back as ML vectors.

    The solver passes over the rows many times; a table in the shared folder costs
    one write and survives lost executors.
    """
    spark = train.sparkSession
    path = scratch_path(spark, "vectors")
    vectors = space.vectorize(ft.normed(train).select("label", "_norm")).select(
        F.col("label").cast("double").alias("label"), "features"
    )
    vectors.write.parquet(path)
    schema = T.StructType(
        [T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())]
    )
    return spark.read.schema(schema).parquet(path)


def penalty(C: float, n: int) -> float:
    """Weight of the penalty against the mean loss of n rows; ``C`` weighs the summed loss."""
    return 1.0 / (C * n)


def fit_linear(vectors: DataFrame, space: ft.FeatureSpace, *Cs: float) -> list[ReviewModel]:
    """L2 logistic regression, one model per ``C``; all share every pass over the rows."""
    n = vectors.count()
    if n == 0:
        raise ValueError("no training rows")
    found = solver.solve(solver.as_rows(vectors), space.size, [penalty(C, n) for C in Cs])
    return [ReviewModel(space, s.coef, s.intercept) for s in found]


def fit(train: DataFrame, C: float = 1.0, **space_options) -> ReviewModel:
    """Fit the whole model on ``train`` (text, label; or a frame from ``prepared``)."""
    if "_norm" not in train.columns:
        train = prepared(train)
    space = fit_space(train, **space_options)
    return fit_linear(write_vectors(train, space), space, C)[0]


def _add_derivatives(
    n_models: int, size: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Sums of gap times weight by coefficient (-1: the intercept) over a task's texts."""
    sums, any_rows = np.zeros((n_models, size + 1)), False
    for batch in batches:
        if not batch.num_rows:
            continue
        any_rows = True
        gaps = batch.column("gaps").flatten().to_numpy().reshape(-1, n_models)
        listed = batch.column("entries")
        each = listed.value_lengths().to_numpy()
        entries = listed.flatten()
        ids, weights = entries.field("feature_id").to_numpy(), entries.field("weight").to_numpy()
        for k in range(n_models):
            sums[k, 0] += gaps[:, k].sum()
            sums[k, 1:] += np.bincount(ids, weights * np.repeat(gaps[:, k], each), size)
    if any_rows:
        columns = [pa.array(np.arange(-1, size, dtype="int64")), *map(pa.array, sums)]
        yield pa.RecordBatch.from_arrays(columns, ["feature_id", *[f"s{k}" for k in range(n_models)]])


def optimality(train: DataFrame, models: list[tuple[ReviewModel, float]]) -> DataFrame:
    """How far fitted models are from the optimum, by the rows they were fitted to.

    ``models`` are pairs of model and C over one feature space. Per model (``no``) and
    block, the intercept as block ``bias``: the number of coefficients and the largest
    absolute derivative of mean loss plus penalty, from stored coefficients and the scores
    that the models give the training texts. At the optimum all derivatives are 0. Texts
    are read once for all models; the sums combine before the shuffle.
    """
    space, n = models[0][0].space, train.count()
    if any(m.space is not space for m, _ in models):
        raise ValueError("the models need a common feature space")
    read = space.with_inputs(train)
    read = read.withColumn("_margins", space.margins([model.coef for model, _ in models]))
    for part in space.parts:
        read = read.withColumn(f"_{part.name}_weights", space.weights(part))
    # P(negative) minus the label's share of it, with the sign of the loss of label 1.
    gaps = F.array(*[
        F.coalesce((1.0 - m.probability(F.col("_margins")[k])) - F.col("label"), F.lit(0.0))
        for k, (m, _) in enumerate(models)
    ])
    weights = [f"_{p.name}_weights" for p in space.parts]
    entries = F.concat(*[F.col(w) for w in weights])
    # Every task adds up its texts; what is left for the shuffle is one row per coefficient.
    schema = "feature_id bigint, " + ", ".join(f"s{k} double" for k in range(len(models)))
    sums = (
        read.select(gaps.alias("gaps"), entries.alias("entries"))
        .mapInArrow(functools.partial(_add_derivatives, len(models), space.size), schema)
        .groupBy("feature_id")
        .agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(len(models))])
    )
    coefs = pd.DataFrame({"feature_id": np.arange(-1, space.size, dtype="int64"), "block": "bias"})
    for part in space.parts:
        coefs.loc[part.feature_ids + 1, "block"] = part.name
    for k, (model, _) in enumerate(models):
        coefs[f"w{k}"] = np.concatenate([[0.0], model.coef])  # the intercept has no penalty
    known = train.sparkSession.createDataFrame(coefs)  # bounded by max_features
    derivatives = F.array(*[
        F.struct(
            F.lit(k).alias("no"),
            F.abs(F.coalesce(F.col(f"s{k}"), F.lit(0.0)) / n + penalty(C, n) * F.col(f"w{k}")).alias("d"),
        )
        for k, (_, C) in enumerate(models)
    ])
    return (
        known.join(sums, "feature_id", "left").select("block", F.inline(derivatives))
        .groupBy("no", "block")
        .agg(F.count(F.lit(1)).alias("n_coefficients"), F.max("d").alias("largest"))
    )


def export_model(features: DataFrame, intercept: float) -> DataFrame:
    """Model as an ordered table: words, then characters, then the bias row."""
    rounded = features.select(
        F.when(F.col("block") == "word", 0).otherwise(1).alias("block_no"),
        "block",
        "feature_id",
        "term",
        round_exact(F.col("idf"), 5).alias("idf"),
        round_signed(F.col("coef"), 5).alias("coef"),
    )
    bias = features.sparkSession.range(1).select(
        F.lit(2).alias("block_no"),
        F.lit("bias").alias("block"),
        F.lit(0).cast("bigint").alias("feature_id"),
        F.lit("").alias("term"),
        F.lit(0.0).alias("idf"),
        round_signed(F.lit(float(intercept)), 5).alias("coef"),
    )
    return rounded.unionByName(bias).orderBy("block_no", "feature_id")


def round_signed(value: Column, digits: int) -> Column:
    """``round_exact`` without a negative zero."""
    rounded = round_exact(value, digits)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def top_weights(features: DataFrame, k: int = 15) -> DataFrame:
    """The k most negative and the k most positive features: side, rank_no, term, coef."""
    named = features.select("block", "term", "coef")
    sides = []
    for side, key in (("negative", F.asc("coef")), ("positive", F.desc("coef"))):
        sides.append(
            named.orderBy(key, "block", "term").limit(k).withColumn("side", F.lit(side))
        )
    return sides[0].unionByName(sides[1]).select("side", "block", "term", "coef")


def agreement(a: DataFrame, b: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of reviews on which two score tables (review_id, p_negative) agree."""
    left = a.select("review_id", (F.col("p_negative") >= threshold).alias("va"))
    right = b.select("review_id", (F.col("p_negative") >= threshold).alias("vb"))
    return left.join(right, "review_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("va") == F.col("vb")).cast("double")).alias("agreement"),
    )


def agreement_on(
    df: DataFrame, a: ReviewModel, b: ReviewModel, threshold: float = 0.5
) -> DataFrame:
    """``agreement`` of two models over one feature space: every text is read once."""
    if a.space is not b.space:
        raise ValueError("the models need a common feature space")
    read = a.space.with_inputs(df)
    read = read.withColumn("_margins", a.space.margins([a.coef, b.coef]))
    in_a, in_b = (m.probability(F.col("_margins")[k]) >= threshold for k, m in enumerate((a, b)))
    same = in_a == in_b
    return read.agg(
        F.count(F.lit(1)).alias("n"), F.avg(same.cast("double")).alias("agreement")
    )


def write_export(features: DataFrame, intercept: float, path: str) -> None:
    """The exported model as one ordered JSON file; its rows are bounded by max_features."""
    export_model(features, intercept).coalesce(1).write.json(path)


def batch_score(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 32,
) -> DataFrame:
    """Score texts with an external model in fixed-size batches.

    ``make_scorer`` runs once for each task and returns a function from a list of
    texts to class probabilities of shape (n, classes); class 0 is negative.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            texts = frame["text"].tolist()
            scores = np.empty(len(texts))
            for at in range(0, len(texts), batch_size):
                part = slice(at, at + batch_size)
                scores[part] = np.asarray(scorer(texts[part]))[:, 0]
            yield pd.DataFrame({"review_id": frame["review_id"], "p_negative": scores})

    return df.select("review_id", "text").mapInPandas(
        run, "review_id bigint, p_negative double"
    )
