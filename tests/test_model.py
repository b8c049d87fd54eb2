import collections

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voicelane.operators import evaluation as ev
from voicelane.operators import features as ft
from voicelane.operators import model as mo
from voicelane.plans import scoring, studies

GOOD = ["wonderful", "brilliant", "lovely", "great", "superb", "delightful"]
BAD = ["bad", "worst", "terrible", "boring", "dreadful", "awful"]
FRAMES = ["this movie was {}", "the film was {}", "absolutely {} acting", "a {} story from start",
          "what a {} plot and cast", "its {}", "i found it {} overall"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for label, words in ((1, GOOD), (0, BAD)):
        for i, w in enumerate(words):
            for j, f in enumerate(FRAMES):
                for other in words[i:i + 2]:
                    rows.append((len(rows), f.format(w) + " and " + other, label))
    extra = [("i dont like it", 0), ("i dont like it at all", 0), ("i like it", 1), ("i love it", 1)]
    rows += [(len(rows) + k, t, lab) for k, (t, lab) in enumerate(extra * 5)]
    return spark.createDataFrame(rows, "review_id bigint, text string, label int")


@pytest.fixture(scope="module")
def model(corpus):
    return mo.fit(corpus)


def p_of(spark, model, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "review_id bigint, text string")
    rows = model.with_p_negative(df).select("review_id", "p_negative").collect()
    return [p for _, p in sorted(map(tuple, rows))]


def test_misspelt_negatives_read_as_negative(spark, model):
    bad = p_of(spark, model, "this movie was bad", "the film was borst",
               "absolutely terrable acting", "i dont like it")
    assert min(bad) > 0.5
    assert p_of(spark, model, "this movie was wonderful")[0] < 0.5


def test_scores_follow_the_formula(spark, model):
    """Recompute tf-idf and the margin by hand for a few texts."""
    from tests.test_text import py_char_grams, py_norm, py_word_grams

    table = {(r["block"], r["term"]): r for r in model.features_frame(spark).collect()}
    texts = ["the film was boring and bad bad", "zzz", "", "superb cast"]
    for text, got in zip(texts, p_of(spark, model, *texts)):
        z = model.intercept
        for block, grams in (("word", py_word_grams(py_norm(text))),
                             ("char", py_char_grams(py_norm(text)))):
            raw = {t: (1 + np.log(grams.count(t))) * table[block, t]["idf"]
                   for t in set(grams) if (block, t) in table}
            length = np.sqrt(sum(v * v for v in raw.values()))
            z += sum(v / length * table[block, t]["coef"] for t, v in raw.items())
        assert got == pytest.approx(1 - 1 / (1 + np.exp(-z)), abs=1e-9)


def test_save_and_load(spark, model, tmp_path):
    model.save(spark, str(tmp_path / "m"))
    again = mo.ReviewModel.load(spark, str(tmp_path / "m"))
    texts = ("a boring film", "lovely")
    assert p_of(spark, again, *texts) == pytest.approx(p_of(spark, model, *texts))


def test_load_refuses_other_text_rules(spark, model, tmp_path, monkeypatch):
    model.save(spark, str(tmp_path / "m"))
    monkeypatch.setattr(mo, "rules_fingerprint", lambda: "other")
    with pytest.raises(ValueError, match="text rules"):
        mo.ReviewModel.load(spark, str(tmp_path / "m"))


def test_fit_recovers_a_separable_corpus(corpus, model):
    row = ev.negative_metrics(model.with_p_negative(corpus)).first()
    assert row["f1_negative"] > 0.95 and row["passes_gate"]


def test_weights_have_unit_length(corpus):
    space = mo.fit_space(corpus)
    sums = ft.tfidf(corpus, space).groupBy("review_id", "block").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("s")).collect()
    assert sums and all(abs(r["s"] - 1) < 1e-9 for r in sums)


def test_vocabulary_limits_and_ties(spark):
    df = spark.createDataFrame([(0, "bb aa cc"), (1, "bb aa dd"), (2, "bb ee dd")],
                               "review_id bigint, text string")
    counts = ft.term_counts(df, "word", (1, 1))
    got = {(r["term"], r["tf"], r["df"]) for r in counts.collect()}
    assert got == {("aa", 2, 2), ("bb", 3, 3), ("cc", 1, 1), ("dd", 2, 2), ("ee", 1, 1)}
    top = ft.build_vocab(counts, "word", max_features=2).orderBy("feature_id").collect()
    assert [(r["term"], r["feature_id"]) for r in top] == [("aa", 0), ("bb", 1)]


@pytest.mark.parametrize("max_features, span", [(5, (1, 2)), (12, (1, 3)), (300, (1, 2)), (5, (2, 2))])
def test_pruned_counts_give_the_same_vocabulary(spark, corpus, max_features, span):
    odd = spark.createDataFrame([(None,), ("",), ("x yy",), ("yy yy zz yy yy",)], "text string")
    texts = corpus.select("text").unionByName(odd)
    every, some = ft.term_counts(texts, "word", span), ft.word_counts_for(texts, span, max_features)
    want, got = (sorted(map(tuple, ft.build_vocab(c, "word", max_features).collect())) for c in (every, some))
    assert want == got and len(want) == min(max_features, every.filter("df >= 2").count())
    assert some.count() < every.count() or span == (2, 2)


def test_probes_and_export(spark, model):
    probes = scoring.probe_table(spark, model)
    assert probes.count() == 13
    rows = mo.export_model(model.features_frame(spark), model.intercept).collect()
    assert [r["block_no"] for r in rows] == sorted(r["block_no"] for r in rows)
    assert rows[-1]["block"] == "bias" and rows[-1]["coef"] == pytest.approx(model.intercept, abs=1e-5)
    assert [r["feature_id"] for r in rows[:-1]] == list(range(model.space.size))


def test_sweep_and_robustness(spark, corpus, tmp_path):
    configs = (studies.Config("words", 3000, (1, 1), 1.0), studies.Config("both", 50000, (1, 2), 1.0, True))
    table = studies.sweep(corpus, corpus, configs, runs_path=str(tmp_path / "runs"))
    assert [r["name"] for r in table.orderBy("config_no").collect()] == ["words", "both"]
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2
    report = studies.robustness(corpus, corpus, rate=0.5).collect()
    assert {r["features"] for r in report} == {"word", "word+char"}
    word, both = sorted(report, key=lambda r: len(r["features"]))
    assert both["f1_typo"] >= word["f1_typo"] and word["gain_typo"] == 0.0


def test_batch_score_batches_and_order(reviews):
    def make():
        def score(texts):
            assert 0 < len(texts) <= 4
            return np.array([[len(t) / 100, 0.0] for t in texts])
        return score

    df = reviews(*["x" * n for n in range(30)])
    rows = mo.batch_score(df, make, batch_size=4).collect()
    assert {r["review_id"]: r["p_negative"] for r in rows} == {n: n / 100 for n in range(30)}


def test_agreement_on_reads_once_and_equals_the_join(spark, corpus, model):
    other = mo.ReviewModel(model.space, -model.coef, -model.intercept)
    half = mo.ReviewModel(model.space, model.coef, model.intercept + 1.0)
    for b in (other, half):
        want = mo.agreement(model.with_p_negative(corpus), b.with_p_negative(corpus)).first()
        got = mo.agreement_on(corpus, model, b).first()
        assert got["n"] == want["n"] and got["agreement"] == pytest.approx(want["agreement"])
    with pytest.raises(ValueError, match="common"):
        mo.agreement_on(corpus, model, mo.ReviewModel(mo.fit_space(corpus), model.coef, 0.0))


def test_robustness_of_an_empty_slice_is_null(spark, corpus):
    long = corpus.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 20))
    for row in studies.robustness(corpus, long).collect():
        assert row["n_typo_short"] == 0 and row["f1_typo_short"] is None
        assert row["gain_typo_short"] is None and row["n_clean"] == corpus.count()


def test_shared_counts_give_the_same_space(corpus):
    ready = mo.prepared(corpus)
    counts = studies.shared_counts(ready, {("word", (1, 2)), ("char", (3, 5))})
    a, b = mo.fit_space(corpus), mo.fit_space(ready, counts=counts)
    assert [p.terms for p in a.parts] == [p.terms for p in b.parts]
    assert all(np.allclose(x.idf, y.idf) for x, y in zip(a.parts, b.parts))


ODD_TEXTS = ["A cat, a cat and the catalogue", "", None, "  ", "i \U0001d538\U0001d539 \u00e9", "no\tblank " * 9, "cat"]


def test_character_counts_per_word_equal_those_per_occurrence(spark):
    df = spark.createDataFrame([(t,) for t in ODD_TEXTS * 3], "text string").repartition(2)
    for span in [(3, 5), (4, 5), (5, 5)]:
        want = ft._counted(ft.with_ngrams(df, "char", span).select("grams"))
        got = ft.term_counts(df, "char", span)
        assert "MapInArrow" in got._jdf.queryExecution().toString()  # not one row per occurrence
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("counted, cached", [(5, 200_000), (400_000, 1)])
def test_character_counts_passed_on_early_add_up(monkeypatch, counted, cached):
    def summed():
        batch = pa.RecordBatch.from_arrays([pa.array(ODD_TEXTS * 3)], ["_norm"])
        parts = [b.to_pandas() for b in ft._char_counts((3, 5), iter([batch, batch]))]
        return len(parts), pd.concat(parts).groupby("term").sum().sort_index()

    few, want = summed()
    monkeypatch.setattr(ft, "_COUNTED", counted)
    monkeypatch.setattr(ft, "_CACHE_WORDS", cached)
    monkeypatch.setattr(ft, "_CHUNK_BYTES", 40)
    more, got = summed()
    assert more > few and got.equals(want) and want.loc["cat", "df"] == 12


def test_character_counts_make_numbers_not_strings(monkeypatch):
    monkeypatch.setattr(ft, "_grams_of_word", None)  # was called for every distinct word
    batch = pa.RecordBatch.from_arrays([pa.array(["a cat", "cat cat"])], ["_norm"])
    rows = [r for b in ft._char_counts((3, 5), iter([batch])) for r in b.to_pylist()]
    assert {r["term"]: (r["tf"], r["df"]) for r in rows} == {" a ": (1, 1)} | dict.fromkeys(
        [" ca", "cat", "at ", " cat", "cat ", " cat "], (3, 2)
    )


def test_character_counts_beyond_the_list_of_characters():
    """More characters than 12 bits can number, and NULs at the end of n-grams."""
    many = ["".join(map(chr, range(a, a + 3000))) for a in (0x4E00, 0x6E00)]
    texts = [*many, " ".join(many), "a\0 \0\0\0", "ab"]
    batches = [pa.RecordBatch.from_arrays([pa.array([t])], ["_norm"]) for t in texts]
    tf, df = collections.Counter(), collections.Counter()
    for row in [r for b in ft._char_counts((3, 5), iter(batches)) for r in b.to_pylist()]:
        tf[row["term"]] += row["tf"]
        df[row["term"]] += row["df"]
    want = collections.Counter(g for t in texts for w in t.split(" ") for g in ft._grams_of_word(w, 3, 5))
    assert tf == want and df[" ab"] == 1 and df[many[0][:5]] == 2 and " a\0" in want


def test_text_goes_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        df = spark.createDataFrame([("a cat",), ("a cat",)], "text string")
        vocab = ft.build_vocab(ft.term_counts(df, "word"), "word").withColumn("idf", F.lit(1.0))
        space = ft.FeatureSpace.from_vocab(vocab)
        spark.conf.unset(key)
        space.with_inputs(df)
        assert int(spark.conf.get(key).rstrip("b")) == 4 << 20
    finally:
        spark.conf.set(key, before)


def test_ngrams_are_counted_where_the_review_lies(spark):
    texts = [(1, "bad film bad film"), (2, ""), (3, None), (4, "Good good plot")]
    df = spark.createDataFrame(texts, "review_id bigint, text string")
    counts = ft.ngram_counts(df, "word")
    assert "hashpartitioning" not in counts._jdf.queryExecution().toString()
    assert sorted(map(tuple, counts.collect())) == [
        (1, "bad", 2), (1, "bad film", 2), (1, "film", 2), (1, "film bad", 1),
        (4, "good", 2), (4, "good good", 1), (4, "good plot", 1), (4, "plot", 1),
    ]
    # Reviews that share an id, also none, are counted as one.
    more = df.unionByName(spark.createDataFrame([(1, "bad"), (None, "bad"), (None, "bad plot")], df.schema))
    got = {tuple(r) for r in ft.ngram_counts(more, "word").collect()}
    assert {(1, "bad", 3), (None, "bad", 2), (None, "bad plot", 1), (4, "plot", 1)} <= got
    assert len(got) == 4 + 3 + 4
