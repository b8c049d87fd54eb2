"""Every operator as a query over the given tables.

Reviews are the documents with one of a few complaint or praise sentences added
to each whole text, so that the lexicons have something to find. ``oracles`` holds
the same queries as SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voicelane.config import scratch_path
from voicelane.functions import text as tx
from voicelane.functions.numbers import digits_to_unit, hash_digits
from voicelane.lexicon import DEFAULT_LEXICON as LEX
from voicelane.operators import evaluation as ev
from voicelane.operators import features as ft
from voicelane.operators import matching as mt
from voicelane.operators import model as mo
from voicelane.operators import routing as ro
from voicelane.operators import threshold as th
from voicelane.operators import typos as ty
from voicelane.operators import urgency as ur
from voicelane.plans import scoring, studies
from voicelane.sources import reviews as rv
from voicelane.sources import runs
from voicelane.streaming import triage

SENTENCES = (
    "Last month I was charged twice and support is silent. Send a REFUND, I am cancelling!!!",
    "pls cancle my subscribtion, they charged twice again",
    "This app is a joy, we would never cancel it.",
    "I never read books of that sort. Please send me a refund.",
    "Dreadful support. I no longer want the membership.",
    "What an awful month, I want out.",
    "She killed the dragon in the last chapter.",
    "Relax, I wont be cancelling today",
    "You people stole my money, where is my REFUND!",
    "Nice concert.<br /><br />I don't want to say more, sooooo loud!",
    "Superb support, we would never cancle this plan.",
    "a terrable driver, and the lawful owner is not renewing",
    "Last year I would never cancel, this year I want to cancel.",
)
HEADS = ("cancel", "cancelling", "canceled", "cancellation", "refund", "unsubscribe",
         "switching", "switch")
INTERCEPT = 0.1
TURN_IDS = 1 << 31  # ids of the turns of one conversation
SWEEP_NAMES = ("A", "B", "C", "D", "E", "F")
STRICT = {"negative_threshold": 0.6, "urgency_threshold": 0.5, "clearly_positive": 0.2}


# --- inputs -----------------------------------------------------------------

def documents(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(f"{path}/documents.parquet")
    df = df.select(F.col("doc_id").alias("review_id"), "text")
    return rv.spread(df, "review_id")


def with_sentence(df: DataFrame) -> DataFrame:
    picked = F.get(
        F.array(*[F.lit(s) for s in SENTENCES]),
        (F.col("review_id") % len(SENTENCES)).cast("int"),
    )
    return df.withColumn("text", F.concat("text", F.lit(". "), picked))


def seeded(spark: SparkSession, path: str) -> DataFrame:
    return with_sentence(documents(spark, path))


def turns(spark: SparkSession, path: str) -> DataFrame:
    """Conversation turns as short reviews."""
    df = spark.read.parquet(f"{path}/conversations.parquet")
    key = (F.col("conv_id") * TURN_IDS + F.col("turn")).alias("review_id")
    return rv.spread(df.select(key, "text"), "review_id")


def labelled(spark: SparkSession, path: str) -> DataFrame:
    return rv.spread(rv.load_reviews(spark, path), "review_id")


def scored(spark: SparkSession, path: str, salt: str = "") -> DataFrame:
    """review_id, label, p_negative of every labelled review."""
    return rv.load_reviews(spark, path).select(
        "review_id", "label", ev.pseudo_score(F.col("review_id"), F.col("label"), salt)
        .alias("p_negative"),
    )


def scored_by(spark: SparkSession, path: str, salts: dict[str, str]) -> DataFrame:
    """no, name, review_id, label, p_negative: every review under every salt, in one scan."""
    entries = [
        F.struct(
            F.lit(no).alias("no"),
            F.lit(name).alias("name"),
            ev.pseudo_score(F.col("review_id"), F.col("label"), salt).alias("p_negative"),
        )
        for no, (name, salt) in enumerate(salts.items())
    ]
    return rv.load_reviews(spark, path).select("review_id", "label", F.inline(F.array(*entries)))


def unlabelled_score(review_id: Column) -> Column:
    return ev.pseudo_score(review_id, F.lit(None).cast("int"))


def triaged(spark: SparkSession, path: str) -> DataFrame:
    return scoring.score_given(seeded(spark, path), unlabelled_score(F.col("review_id")))


def vocab(df: DataFrame, block: str) -> DataFrame:
    if block == "word":
        return ft.build_vocab(ft.word_counts_for(df, ft.WORD_RANGE, ft.MAX_FEATURES), block)
    return ft.build_vocab(ft.term_counts(df, block), block)


def idf_table(df: DataFrame) -> DataFrame:
    stored = scratch_path(df.sparkSession, "norm")  # read by three passes
    ft.normed(df).select("_norm").write.parquet(stored)
    df = df.sparkSession.read.parquet(stored)
    both = vocab(df, "word").unionByName(vocab(df, "char"))
    return ft.with_idf(both, ft.review_total(df))


def with_coef(table: DataFrame, salt: str) -> DataFrame:
    digest = hash_digits(F.col("block"), F.col("term"), F.lit(salt))
    return table.withColumn("coef", (digits_to_unit(digest) - 0.5) * 4.0)


def joint_ids(table: DataFrame) -> DataFrame:
    """Character features continue the ids of the word features (a bounded table)."""
    place = F.row_number().over(W.orderBy(F.desc("block"), "term")) - 1
    return table.withColumn("feature_id", place.cast("bigint"))


def feature_table(spark: SparkSession, path: str, salt: str = "m1") -> DataFrame:
    return joint_ids(with_coef(idf_table(documents(spark, path)), salt))


_models: dict = {}


def model(spark: SparkSession, path: str, salt: str = "m1") -> mo.ReviewModel:
    """The model over the documents' vocabulary, loaded once per session and content."""
    content = spark.read.parquet(f"{path}/documents.parquet").agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("doc_id", "text").cast("decimal(20,0)"))
    )
    key = (spark.sparkContext.applicationId, path, *content.first())
    if key not in _models:
        stored = scratch_path(spark, "idf")
        idf_table(documents(spark, path)).write.parquet(stored)
        table = spark.read.parquet(stored)
        _models[key] = (table, ft.FeatureSpace.from_vocab(table))
    table, space = _models[key]
    coefs = with_coef(table, salt).select("block", "term", "coef").toArrow().to_pandas()
    coefs = coefs.set_index(["block", "term"])["coef"]
    coef = np.zeros(space.size)
    for part in space.parts:
        coef[part.feature_ids] = coefs.loc[part.name].loc[part.terms].to_numpy()
    return mo.ReviewModel(space, coef, INTERCEPT)


def turn_space(spark: SparkSession, path: str) -> ft.FeatureSpace:
    return ft.FeatureSpace.from_vocab(idf_table(turns(spark, path)))


def joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column.split(".")[-1])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks -------------------------------------------------------

def q_load_reviews(spark, path):
    return rv.load_reviews(spark, path).select("review_id", "text", "label", "split")


def q_validate_reviews(spark, path):
    docs = documents(spark, path)
    kind = F.col("review_id") % 4
    damaged = docs.select(
        (-F.col("review_id") - 1).alias("review_id"),
        F.when(kind == 0, "")
        .when(kind == 1, F.repeat(F.lit(" \t\n"), (F.col("review_id") % 7 + 1).cast("int")))
        .when(kind == 2, F.rpad("text", rv.MAX_CHARS, "."))
        .otherwise(F.rpad("text", rv.MAX_CHARS + 1, "."))
        .alias("text"),
    )
    accepted, rejected = rv.validate(docs.unionByName(damaged))
    ok = accepted.select("review_id", F.lit("accepted").alias("status"))
    return ok.unionByName(rejected.select("review_id", F.col("reason").alias("status")))


def q_route_support_queue(spark, path):
    return (
        triaged(spark, path)
        .filter(F.col("route") == ro.SUPPORT)
        .select("review_id", "p_negative", "urgency")
    )


def q_latest_runs(spark, path):
    docs = spark.read.parquet(f"{path}/documents.parquet").select(
        F.col("doc_id").alias("review_id"), "source", "lang"
    )
    labels = spark.read.parquet(f"{path}/labels.parquet").select(
        F.col("doc_id").alias("review_id"), F.col("quality").alias("label")
    )
    p = ev.pseudo_score(F.col("review_id"), F.col("label"))
    per_run = (
        docs.join(labels, "review_id")
        .withColumn("p_negative", p)
        .groupBy("source", "lang")
        .agg(*ev.confusion(0.4), F.max("review_id").alias("at"))
    )
    log = ev.with_rates(per_run).select(
        F.col("source").alias("experiment"),
        F.col("lang").alias("run_id"),
        F.timestamp_seconds("at").alias("start_time"),
        F.create_map(
            *[x for m in runs.COMPARED_METRICS for x in (F.lit(m), F.col(m))]
        ).alias("metrics"),
    )
    return runs.latest_runs(log)


def q_model_export(spark, path):
    return mo.export_model(feature_table(spark, path), INTERCEPT)


def q_exported_model(spark, path):
    """The export written as JSON and read back."""
    target = scratch_path(spark, "export")
    mo.write_export(feature_table(spark, path), INTERCEPT, target)
    return spark.read.schema(
        "block_no int, block string, feature_id bigint, term string, idf double, coef double"
    ).json(target)


def q_saved_model(spark, path):
    """Scores of a model that was saved and loaded."""
    target = scratch_path(spark, "model")
    model(spark, path).save(spark, target)
    out = mo.ReviewModel.load(spark, target).with_p_negative(seeded(spark, path))
    return rounded(out.select("review_id", "p_negative"), "p_negative")


def q_incoming_reviews(spark, path):
    """Reviews written as JSON lines, some broken, then read and validated."""
    target = scratch_path(spark, "incoming")
    whole = F.to_json(F.struct("review_id", "text"))
    broken = F.concat(F.lit("no json: "), F.col("review_id").cast("string"))
    documents(spark, path).select(
        F.when(F.col("review_id") % 50 == 7, broken).otherwise(whole).alias("value")
    ).write.text(target)
    read = rv.read_reviews(spark, target, malformed="raw")
    accepted, rejected = rv.validate(read, malformed="raw")
    names = ["review_id", "text", "raw"]
    return accepted.select(*names, F.lit("accepted").alias("status")).unionByName(
        rejected.select(*names, F.col("reason").alias("status"))
    )


_WRITTEN = ["review_id", "p_negative", "urgency", "route"]


def q_written_scores(spark, path):
    """Scores written by route and read back."""
    target = scratch_path(spark, "scored")
    rv.write_scored(triaged(spark, path), target)
    return spark.read.parquet(target).select(*_WRITTEN)


def q_fanned_out(spark, path):
    """Scores written to one destination per route and read back."""
    target = scratch_path(spark, "lanes")
    sinks = {lane: f"{target}/{lane}" for lane in ro.ROUTES}
    rv.fan_out(triaged(spark, path), sinks)
    schema = "review_id bigint, p_negative double, urgency double, route string"
    return spark.read.schema(schema).json(list(sinks.values())).select(*_WRITTEN)


def q_delivered_lanes(spark, path):
    """Deliveries of which some die between two sinks, run again and read back.

    The reviews go out in two deliveries. The first one dies after its first sink and is
    run again, then once more after it was committed; a third one is never finished.
    """
    target = scratch_path(spark, "deliveries")
    sinks = {lane: f"{target}/{lane}" for lane in ro.ROUTES}
    commits = f"{target}/commits"
    # Scored once: every delivery, retry and death below takes the stored scores.
    stored = scratch_path(spark, "scored")
    triaged(spark, path).select("review_id", "p_negative", "urgency", "signals", "route").write.parquet(stored)
    reviews = spark.read.parquet(stored)
    even = F.col("review_id") % 2 == 0

    def die_after_one(rows: DataFrame, key: str) -> None:
        lane = rows.filter(F.col("route") == ro.ROUTES[0])
        rv.response(lane).write.mode("overwrite").json(f"{sinks[ro.ROUTES[0]]}/delivery={key}")

    die_after_one(reviews.filter(even), "even")
    rv.fan_out(reviews.filter(even), sinks, commits=commits, key="even")
    rv.fan_out(reviews.filter(even), sinks, commits=commits, key="even")
    rv.fan_out(reviews.filter(~even), sinks, commits=commits, key="odd")
    die_after_one(reviews, "unfinished")
    schema = "review_id bigint, p_negative double, urgency double, route string"
    lanes = [rv.lane(spark, folder, commits, schema) for folder in sinks.values()]
    return functools.reduce(DataFrame.unionByName, lanes).select(*_WRITTEN)


def q_logged_runs(spark, path):
    """One logged run per language of the reviews, read back from the log."""
    target = scratch_path(spark, "runs")
    langs = spark.read.parquet(f"{path}/documents.parquet").select(
        F.col("doc_id").alias("review_id"), "lang"
    )
    rates = ev.with_rates(
        scored(spark, path).join(langs, "review_id").groupBy("lang").agg(*ev.confusion(0.4))
    )
    for row in rates.collect():  # one row per language
        metrics = {m: row[m] for m in runs.COMPARED_METRICS}
        for _ in range(2):  # a retried call logs nothing twice
            runs.log_run(
                spark, target, row["lang"], row["lang"], {"threshold": 0.4}, metrics, key=f"lang {row['lang']}"
            )
    return runs.read_runs(spark, target).select(
        "experiment", "name", F.col("params")["threshold"].alias("threshold"),
        *[F.round(F.col("metrics")[m], 6).alias(m) for m in runs.COMPARED_METRICS],
    )


# --- text --------------------------------------------------------------------

def q_normalize_text(spark, path):
    pages = spark.read.parquet(f"{path}/pages.parquet").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("review_id"),
        F.col("html").alias("text"),
    )
    texts = pages
    for kind, df in (("document", seeded(spark, path)), ("turn", turns(spark, path))):
        texts = texts.unionByName(df.select(F.lit(kind).alias("kind"), "review_id", "text"))
    return texts.select("kind", "review_id", tx.normalize(F.col("text")).alias("norm"))


def q_tokenize(spark, path):
    toks = tx.tokens(tx.normalize(F.col("text")))
    return seeded(spark, path).select("review_id", F.posexplode(toks).alias("pos", "token"))


def q_clause_tokens(spark, path):
    parts = tx.clauses(tx.normalize(F.col("text")))
    return (
        seeded(spark, path)
        .select("review_id", F.posexplode(parts).alias("clause_no", "clause"))
        .select("review_id", "clause_no", F.posexplode("clause").alias("pos", "token"))
    )


def q_word_count(spark, path):
    return seeded(spark, path).select("review_id", tx.word_count(F.col("text")).alias("n_words"))


def q_word_ngrams(spark, path):
    return ft.ngram_counts(seeded(spark, path), "word")


def q_char_ngrams(spark, path):
    return ft.ngram_counts(turns(spark, path), "char")


def q_char_ngrams_documents(spark, path):
    """Character n-grams of the review corpus, summed up by review."""
    grams = ft.with_ngrams(documents(spark, path), "char").select("review_id", "grams")
    return grams.select(
        "review_id",
        F.size("grams").cast("bigint").alias("n_grams"),
        F.size(F.array_distinct("grams")).cast("bigint").alias("n_terms"),
    )


def q_shout_intensity(spark, path):
    df = seeded(spark, path).select(
        "review_id", tx.shout_intensity(F.col("text")).alias("intensity")
    )
    return rounded(df, "intensity")


# --- matching ----------------------------------------------------------------

def q_lexicon_exact(spark, path):
    return mt.match_exact(seeded(spark, path)).withColumnRenamed("group", "term_group")


def q_lexicon_fuzzy(spark, path):
    return mt.match_fuzzy(seeded(spark, path))


def q_fuzzy_guard(spark, path):
    return mt.guard_report(seeded(spark, path)).withColumnRenamed("group", "term_group")


def q_lexicon_hits(spark, path):
    hits = mt.match_lexicon(seeded(spark, path))
    return hits.select("review_id", joined("churn"), joined("money"), joined("anger"))


def q_churn_patterns(spark, path):
    norm = seeded(spark, path).select(
        "review_id", tx.normalize(F.col("text")).alias("norm")
    )
    hits = norm.select("review_id", mt.pattern_hits(F.col("norm"), LEX.patterns).alias("hits"))
    return hits.select("review_id", joined("hits"))


def q_negation_scope(spark, path):
    return mt.negation_scope(seeded(spark, path), HEADS)


def q_churn_after_negation(spark, path):
    kept = mt.churn_after_negation(seeded(spark, path))
    return kept.select("review_id", joined("churn"), joined("kept"))


def q_mine_collisions(spark, path):
    return mt.mine_collisions(seeded(spark, path)).withColumnRenamed("group", "term_group")


# --- scoring -----------------------------------------------------------------

def _signals() -> list[Column]:
    return [
        joined("signals.churn_phrases"),
        joined("signals.money_phrases"),
        joined("signals.anger_words"),
        F.col("signals.intensity").alias("intensity"),
    ]


def q_urgency_score(spark, path):
    return ur.score_urgency(seeded(spark, path)).select("review_id", "urgency", *_signals())


def q_urgency_audit(spark, path):
    return ur.audit(ur.score_urgency(seeded(spark, path)))


def q_route_matrix(spark, path):
    p = unlabelled_score(F.col("review_id"))
    urgent = ur.score_urgency(seeded(spark, path)).select("review_id", "urgency")
    return urgent.select(
        "review_id",
        ro.route(p, F.col("urgency")).alias("route"),
        ro.route(p, F.col("urgency"), **STRICT).alias("strict_route"),
    )


def q_score_reviews(spark, path):
    out = scoring.score_reviews(seeded(spark, path), model(spark, path))
    return out.select("review_id", "p_negative", "urgency", "route", *_signals())


def q_probe_scores(spark, path):
    """The probe texts under the model of the documents."""
    return scoring.probe_table(spark, model(spark, path))


def q_route_summary(spark, path):
    return rounded(ro.route_summary(triaged(spark, path)), "share")


# --- features and model --------------------------------------------------------

def q_vocab_word(spark, path):
    return vocab(documents(spark, path), "word")


def q_vocab_char(spark, path):
    return vocab(documents(spark, path), "char")


def q_idf_table(spark, path):
    return rounded(idf_table(documents(spark, path)), "idf")


def q_tfidf_weights(spark, path):
    return rounded(ft.tfidf(turns(spark, path), turn_space(spark, path)), "weight")


def q_feature_union(spark, path):
    return rounded(ft.feature_union(turns(spark, path), turn_space(spark, path)), "weight")


def q_tfidf_documents(spark, path):
    """Weights of the review corpus, summed up by review and block."""
    weights = ft.tfidf(documents(spark, path), model(spark, path).space)
    per_review = weights.groupBy("review_id", "block").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("weight").alias("total"),
        F.sum("feature_id").alias("id_sum"),
    )
    return rounded(per_review, "total", digits=5)


def q_feature_union_documents(spark, path):
    """Joint feature vectors of the review corpus, summed up by review."""
    union = ft.feature_union(documents(spark, path), model(spark, path).space)
    per_review = union.groupBy("review_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("weight").alias("total"),
        F.sum("feature_id").alias("id_sum"),
    )
    return rounded(per_review, "total", digits=5)


def q_score_linear(spark, path):
    out = model(spark, path).with_p_negative(seeded(spark, path))
    return rounded(out.select("review_id", "p_negative"), "p_negative")


def q_model_agreement(spark, path):
    a, b = model(spark, path, "m1"), model(spark, path, "m2")
    return rounded(mo.agreement_on(seeded(spark, path), a, b), "agreement")


def q_top_weights(spark, path):
    return rounded(mo.top_weights(feature_table(spark, path)), "coef")


def _halves(spark, path) -> tuple[DataFrame, DataFrame]:
    reviews = labelled(spark, path)
    return reviews.filter("split = 'train'"), reviews.filter("split = 'test'")


def q_fit_model(spark, path):
    train, test = _halves(spark, path)
    fitted = mo.fit(train)
    return ev.negative_metrics(fitted.with_p_negative(test))


def q_fit_model_checks(spark, path):
    """What must hold of a fitted model exactly: sizes, and a settled intercept.

    At the optimum the probabilities of the training rows add up to the negatives.
    """
    train, test = _halves(spark, path)
    ready = mo.prepared(train)
    fitted = mo.fit(ready)
    parts = [
        fitted.with_p_negative(df).select(F.lit(part).alias("part"), "label", "p_negative")
        for part, df in (("train", ready), ("test", test))
    ]
    in_train, negative = F.col("part") == "train", F.col("label") == 0
    sizes = {part.name: len(part.terms) for part in fitted.space.parts}
    gap = F.sum(F.when(in_train, F.col("p_negative") - negative.cast("double")))
    return parts[0].unionByName(parts[1]).agg(
        F.count_if(in_train).alias("n_train"),
        F.count_if(in_train & negative).alias("train_negative"),
        F.count_if(~in_train & negative).alias("test_negative"),
        F.count_if(~in_train & ~negative).alias("test_other"),
        F.lit(sizes.get("word", 0)).cast("bigint").alias("word_features"),
        F.lit(sizes.get("char", 0)).cast("bigint").alias("char_features"),
        (F.abs(gap) <= 0.001 * F.count_if(in_train)).alias("intercept_settled"),
    )


#: Largest derivative of mean loss plus penalty that a fitted model may have.
OPTIMAL = 1e-6


def _optimal(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "block", "n_coefficients", (F.col("largest") <= OPTIMAL).alias("optimal"))


def q_fit_optimality(spark, path):
    """Per block of a fitted model: coefficients, and whether all are at the optimum."""
    ready = mo.prepared(_halves(spark, path)[0])
    return _optimal(mo.optimality(ready, [(mo.fit(ready), 1.0)]))


def q_config_sweep_optimality(spark, path):
    """The same for every configuration of the sweep."""
    ready = mo.prepared(_halves(spark, path)[0])
    models = studies.fit_configs(ready, studies.CONFIGS)
    return _optimal(studies.optimality(ready, studies.CONFIGS, models), "config_no", "name")


def q_robustness_optimality(spark, path):
    """The same for both models of the robustness report."""
    ready = mo.prepared(_halves(spark, path)[0])
    models = studies.fit_configs(ready, studies.FEATURE_SETS)
    return _optimal(studies.optimality(ready, studies.FEATURE_SETS, models), "name")


def q_config_sweep_checks(spark, path):
    """The parts of the sweep that don't depend on the solver."""
    return q_config_sweep(spark, path).select(
        "config_no", "name", "n_features", "n_negative", "n_other"
    )


def q_robustness_checks(spark, path):
    """The parts of the robustness report that don't depend on the solver."""
    gain = F.col("features") == "word"
    no_gain = (F.col("gain_clean") == 0) & (F.col("gain_typo") == 0)
    return q_robustness(spark, path).select(
        "features", "n_clean", "n_typo", "n_typo_short", (~gain | no_gain).alias("base_has_no_gain")
    )


def q_config_sweep(spark, path):
    return studies.sweep(*_halves(spark, path))


def q_robustness(spark, path):
    return studies.robustness(*_halves(spark, path))


def q_sweep_winner(spark, path):
    results = scored_by(spark, path, {name: name for name in SWEEP_NAMES})
    per_config = results.groupBy(F.col("no").alias("config_no"), "name").agg(*ev.confusion(0.4))
    best = ev.winner(ev.with_rates(per_config)).select("config_no", "name", "f1_negative")
    return rounded(best, "f1_negative")


def _letter_scorer():
    """A stand-in for an external model: the share of the letter e."""

    def score(texts: list[str]) -> np.ndarray:
        share = np.array([t.count("e") / len(t) if t else 0.0 for t in texts])
        return np.column_stack([share, 1.0 - share])

    return score


def q_batch_score(spark, path):
    return rounded(mo.batch_score(seeded(spark, path), _letter_scorer), "p_negative")


# --- evaluation ----------------------------------------------------------------

_RATES = ("f1_negative", "recall_negative", "precision_negative")


def q_negative_metrics(spark, path):
    return rounded(ev.negative_metrics(scored(spark, path)), *_RATES)


def q_precision_at_k(spark, path):
    return rounded(ev.precision_at_k(scored(spark, path)), "precision_at_k")


def q_calibration(spark, path):
    return rounded(ev.calibration(scored(spark, path)), "mean_predicted", "share_negative")


def q_profit_curve(spark, path):
    curve = th.profit_curve(scored(spark, path))
    return rounded(curve, "t", "contacted", "caught", "saved", "profit", "precision")


def q_optimal_threshold(spark, path):
    best = th.optimal(th.profit_curve(scored(spark, path)))
    return rounded(best, "t", "profit", "contacted", "precision")


def q_threshold_gain(spark, path):
    gain = th.threshold_gain(th.profit_curve(scored(spark, path)))
    return rounded(gain, "optimal_profit", "default_profit", "gain")


def q_above_break_even(spark, path):
    kept = th.above_break_even(th.profit_curve(scored(spark, path)))
    return rounded(kept, "t", "precision", "breakeven_precision")


def q_class_balance(spark, path):
    return ev.class_balance(rv.load_reviews(spark, path))


def q_length_summary(spark, path):
    return ev.length_summary(documents(spark, path))


def q_length_histogram(spark, path):
    return rounded(ev.length_histogram(documents(spark, path)), "left_edge")


def q_class_preview(spark, path):
    return ev.class_preview(rv.load_reviews(spark, path))


def q_fixed_sample(spark, path):
    return ev.fixed_sample(documents(spark, path), n=300).select("review_id", "text")


def q_short_slice_metrics(spark, path):
    short = ev.short_slice(labelled(spark, path)).withColumn(
        "p_negative", ev.pseudo_score(F.col("review_id"), F.col("label"))
    )
    return rounded(ev.negative_metrics(short), *_RATES)


def q_typo_corpus(spark, path):
    return ty.corrupt(documents(spark, path), seed=studies.TYPO_SEED).select("review_id", "text")


def q_model_comparison(spark, path):
    salts = {"base": "", "word": "word", "word+char": "word+char"}
    every = scored_by(spark, path, salts).withColumnRenamed("name", "model")
    return rounded(ev.compare_models(every), *_RATES)


# --- streaming -------------------------------------------------------------------

def q_stream_scores(spark, path):
    """Score the documents as a stream into per-route folders and read those back."""
    # A pattern, as it takes a single file as well as a folder of part files.
    source = (
        spark.readStream.schema("doc_id bigint, text string")
        .parquet(f"{path}/documents.parque[t]")
        .withColumnRenamed("doc_id", "review_id")
    )
    base = scratch_path(spark, "stream")
    sinks = {name: f"{base}/{name}" for name in (*ro.ROUTES, triage.REJECTS)}

    query = triage.start_routing(
        with_sentence(source), _row_local_scorer, sinks, f"{base}/checkpoint", partitions=_stream_partitions(spark)
    )
    query.awaitTermination()
    return _routed(spark, sinks)


def _stream_partitions(spark) -> int | None:
    wanted = spark.conf.get(rv.INPUT_PARTITIONS, None)
    return int(wanted) if wanted else None


def _routed(spark, sinks) -> DataFrame:
    """review_id, p_negative, urgency, and the route or the reason of rejection."""
    columns = "review_id bigint, p_negative double, urgency double, route string"
    out = [spark.read.schema(columns).parquet(sinks[r]) for r in ro.ROUTES]
    rejected = (
        spark.read.schema("review_id bigint, reason string")
        .parquet(sinks[triage.REJECTS])
        .select("review_id", F.lit(None).cast("double").alias("p_negative"),
                F.lit(None).cast("double").alias("urgency"), F.col("reason").alias("route"))
    )
    names = ["review_id", "p_negative", "urgency", "route"]
    result = out[0].select(*names)
    for df in out[1:]:
        result = result.unionByName(df.select(*names))
    return result.unionByName(rejected)


def _arriving(spark, path, base, start) -> None:
    """Run a stream over reviews that arrive in two halves, with one batch replayed.

    ``start`` starts a query over a source. A half arrives as two micro-batches of a file
    per core, so all cores score it. After the first half the last batch loses its commit,
    as if the driver had died before it.
    """
    source, cores = f"{base}/in", spark.sparkContext.defaultParallelism
    reviews = seeded(spark, path).withColumn("part", F.pmod(F.xxhash64("review_id"), F.lit(4)))
    for half in (0, 1):
        own = reviews.filter(F.col("part").between(2 * half, 2 * half + 1))
        own.repartition(2 * cores, "review_id").select("review_id", "text").write.mode("append").parquet(source)
        stream = rv.read_reviews(spark, source, "parquet", streaming=True, files_per_trigger=cores)
        start(stream).awaitTermination()
        if half == 0:
            triage.forget_last_commit(spark, f"{base}/checkpoint")


def _row_local_scorer(batch: DataFrame) -> DataFrame:
    return scoring.score_given(batch, unlabelled_score(F.col("review_id")))


def q_stream_scoring_restart(spark, path):
    """Reviews scored by a stream that is stopped, replays a batch and goes on."""
    base = scratch_path(spark, "stream")
    start = lambda stream: triage.start_scoring(
        stream, _row_local_scorer, f"{base}/out", f"{base}/checkpoint", partitions=_stream_partitions(spark)
    )
    _arriving(spark, path, base, start)
    return spark.read.parquet(f"{base}/out").select(*_WRITTEN)


def q_stream_routing_restart(spark, path):
    """Reviews routed by a stream that is stopped, replays a batch and goes on."""
    base = scratch_path(spark, "stream")
    sinks = {name: f"{base}/{name}" for name in (*ro.ROUTES, triage.REJECTS)}
    start = lambda stream: triage.start_routing(
        stream, _row_local_scorer, sinks, f"{base}/checkpoint", partitions=_stream_partitions(spark)
    )
    _arriving(spark, path, base, start)
    return _routed(spark, sinks)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name[2:]: fn for name, fn in globals().items()
        if name.startswith("q_") and callable(fn)
    }
