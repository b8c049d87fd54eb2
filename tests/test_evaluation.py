import numpy as np
import pytest
from pyspark.sql import functions as F

from voicelane.operators import evaluation as ev
from voicelane.operators import threshold as th
from voicelane.operators import typos as ty


@pytest.fixture(scope="module")
def synthetic(spark):
    rng = np.random.default_rng(42)
    y = rng.integers(0, 2, 10_000)
    p = np.where(y == 0, rng.beta(8, 2, 10_000), rng.beta(2, 8, 10_000))
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return y, p, spark.createDataFrame(rows, "review_id bigint, label int, p_negative double")


def test_break_even():
    assert th.Assumptions().breakeven_precision == pytest.approx(1 / 9)
    assert th.Assumptions().marginal_breakeven == pytest.approx(1 / 2.7)


def test_profit_curve_against_masks(synthetic):
    y, p, df = synthetic
    rows = th.profit_curve(df).orderBy("t").collect()
    assert len(rows) == 99
    for r, t in zip(rows, np.linspace(0.01, 0.99, 99)):
        flagged = p >= t
        assert r["contacted"] == pytest.approx(flagged.sum() * 30)
        assert r["caught"] == pytest.approx((flagged & (y == 0)).sum() * 30)
        want = (y[flagged] == 0).mean() if flagged.any() else 0.0
        assert r["precision"] == pytest.approx(want)
    best = th.optimal(th.profit_curve(df)).first()
    gain = th.threshold_gain(th.profit_curve(df)).first()
    assert 0 < best["t"] < 0.5 and best["profit"] > 0
    assert best["profit"] == max(r["profit"] for r in rows) and gain["gain"] >= 0


def test_scores_on_thresholds_and_edges(spark):
    grid = th.default_grid()
    rows = [(i, 0, t) for i, t in enumerate(grid)]
    df = spark.createDataFrame(rows, "review_id bigint, label int, p_negative double")
    curve = th.profit_curve(df).orderBy("t").collect()
    assert [round(r["contacted"] * 99 / 300_000) for r in curve] == list(range(99, 0, -1))
    low = spark.createDataFrame([(0, 1, 0.0)], "review_id bigint, label int, p_negative double")
    assert all(r["contacted"] == 0 and r["precision"] == 0 for r in th.profit_curve(low).collect())


def test_calibration_edges_belong_to_the_lower_bin(spark):
    df = spark.createDataFrame([(i, 0, i / 10) for i in range(11)],
                               "review_id bigint, label int, p_negative double")
    bins = {r["bin"]: r["n"] for r in ev.calibration(df).collect()}
    edges = np.linspace(0, 1, 11)
    want = np.bincount(np.searchsorted(edges[1:-1], np.arange(11) / 10))
    assert bins == {i: n for i, n in enumerate(want) if n}


def test_metrics_without_any_flag_are_zero(spark):
    df = spark.createDataFrame([(0, 1, 0.1)], "review_id bigint, label int, p_negative double")
    row = ev.negative_metrics(df).first()
    assert (row["f1_negative"], row["recall_negative"], row["precision_negative"]) == (0, 0, 0)
    assert not row["passes_gate"]


def test_precision_at_k(synthetic):
    y, p, df = synthetic
    got = {r["k"]: r["precision_at_k"] for r in ev.precision_at_k(df, (100, 1000, 50_000)).collect()}
    order = np.argsort(-p)
    for k in got:
        assert got[k] == pytest.approx((y[order[:k]] == 0).mean())


def test_length_tables(reviews):
    lengths = [1, 2, 2, 3, 40, 700, 1500, 2000]
    df = reviews(*[" ".join(["w"] * n) for n in lengths])
    got = {r["bin"]: r["n"] for r in ev.length_histogram(df).collect()}
    want, _ = np.histogram(np.clip(lengths, None, 1000), bins=50)
    assert [got[i] for i in range(50)] == want.tolist()
    row = ev.length_summary(df).first()
    assert row["mean"] == round(np.mean(lengths), 1) and row["std"] == round(np.std(lengths, ddof=1), 1)
    assert row["p25"] == round(np.percentile(lengths, 25), 1)


def test_histogram_of_equal_lengths(reviews):
    got = {r["bin"]: r["n"] for r in ev.length_histogram(reviews("a b", "c d")).collect()}
    want, _ = np.histogram([2, 2], bins=50)
    assert [got[i] for i in range(50)] == want.tolist()


def test_winner_takes_the_first_of_a_tie(spark):
    df = spark.createDataFrame([(0, "a", 0.5), (1, "b", 0.7), (2, "c", 0.7)],
                               "config_no int, name string, f1_negative double")
    assert ev.winner(df).first()["name"] == "b"


def test_typos_keep_shape_and_rate(reviews):
    text = " ".join(["word", "cat", "excellent", "don't", "42nd"] * 400)
    df = reviews(text, "ab  cd", "")
    rows = {r["review_id"]: r["text"] for r in ty.corrupt(df, 0.15, 3).collect()}
    assert rows[1] == "ab cd" and rows[2] == ""
    old, new = text.split(), rows[0].split(" ")
    changed = [(a, b) for a, b in zip(old, new) if a != b]
    assert len(new) == len(old) and 0.08 < len(changed) / len(old) < 0.17
    assert all(abs(len(a) - len(b)) <= 1 and a[0] == b[0] and len(a) > 3 for a, b in changed)
    again = {r["review_id"]: r["text"] for r in ty.corrupt(df, 0.15, 3).collect()}
    assert again == rows
    other = ty.corrupt(df, 0.15, 4).filter("review_id = 0").first()["text"]
    assert other != rows[0]


def test_sample_is_fixed(reviews):
    df = reviews(*[str(i) for i in range(100)])
    a = {r["review_id"] for r in ev.fixed_sample(df, 10, 42).collect()}
    b = {r["review_id"] for r in ev.fixed_sample(df.repartition(7), 10, 42).collect()}
    c = {r["review_id"] for r in ev.fixed_sample(df, 10, 43).collect()}
    assert len(a) == 10 and a == b != c
    assert ev.fixed_sample(df, 500).count() == 100


def test_pseudo_scores_overlap(spark):
    df = spark.range(1000).select(
        F.col("id").alias("review_id"), (F.col("id") % 2).cast("int").alias("label"))
    p = ev.pseudo_score(F.col("review_id"), F.col("label"))
    row = df.select(p.alias("p")).agg(F.min("p"), F.max("p")).first()
    assert 0.05 <= row[0] < row[1] < 0.95


def test_first_k_prunes_and_stays_exact(spark):
    from voicelane.operators.topk import first_k

    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("v"), F.col("id"))
    got = first_k(df, 25, (F.col("v") / 100).cast("int"), [F.col("v")]).collect()
    assert [r["v"] for r in got] == list(range(25))
    same = first_k(df, 25, F.lit(1), [F.col("v")]).collect()
    assert [r["v"] for r in same] == list(range(25))
    assert first_k(df, 20_000, F.lit(1), [F.col("v")]).count() == 10_000


def test_scores_that_are_no_numbers_reach_no_threshold(spark):
    rows = [(0, 0.9), (1, 0.2), (0, None), (1, float("nan"))]
    scored = spark.createDataFrame(rows, "label int, p_negative double")
    curve = {round(r["t"], 2): r for r in th.profit_curve(scored, thresholds=[0.1, 0.5]).collect()}
    each = th.Assumptions().reviews_per_month / 4
    assert curve[0.1]["contacted"] == pytest.approx(2 * each)
    assert curve[0.5]["contacted"] == pytest.approx(each) and curve[0.5]["precision"] == 1.0
