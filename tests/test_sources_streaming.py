import datetime as dt

import pytest
from pyspark.sql import functions as F

from voicelane.plans import catalog, scoring
from voicelane.sources import reviews as rv
from voicelane.sources import runs
from voicelane.streaming import triage

TEXTS = ["Charged twice, I want a REFUND, cancelling today!!!", "The pacing dragged.", "fine",
         "", "   ", "x" * 20_001, "want to cancle my subscribtion, charged twice"]


def scorer(df):
    return scoring.score_given(df, F.when(F.col("text").contains("dragged"), 0.7).otherwise(0.3))


def test_validate(reviews):
    rows = [*TEXTS, "y" * 20_000, "　 "]
    df = reviews(*rows).union(reviews(None).select(F.lit(99).cast("bigint"), F.lit(None).cast("string")))
    accepted, rejected = rv.validate(df)
    assert {r["review_id"] for r in accepted.collect()} == {0, 1, 2, 6, 7}
    got = {r["review_id"]: r["reason"] for r in rejected.collect()}
    assert got == {3: "empty", 4: "blank", 5: "too_long", 8: "blank", 99: "missing"}


def test_write_scored_and_fan_out(spark, reviews, tmp_path):
    scored = scorer(reviews(TEXTS[0], TEXTS[1], TEXTS[2]))
    rv.write_scored(scored, str(tmp_path / "all"))
    back = spark.read.parquet(str(tmp_path / "all"))
    assert set(back.columns) == {"review_id", "p_negative", "urgency", "urgency_signals", "route"}
    assert {r["review_id"]: r["route"] for r in back.collect()} == {
        0: "support_urgent", 1: "feedback_backlog", 2: "analytics"}
    sinks = {r: str(tmp_path / r) for r in ("support_urgent", "feedback_backlog", "analytics")}
    rv.fan_out(scored, sinks)
    for no, path in enumerate(sinks.values()):
        rows = spark.read.json(path).collect()
        assert [r["review_id"] for r in rows] == [no]


def write_json(spark, path, rows):
    spark.createDataFrame(rows, "review_id bigint, text string").coalesce(1).write.mode(
        "append").json(path)


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    write_json(spark, src, list(enumerate(TEXTS)))
    stream = rv.read_reviews(spark, src, streaming=True)
    assert stream.isStreaming
    triage.start_scoring(stream, scorer, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    accepted, _ = rv.validate(rv.read_reviews(spark, src))
    want = {r["review_id"]: (r["p_negative"], r["urgency"], r["route"])
            for r in scorer(accepted).collect()}
    got = {r["review_id"]: (r["p_negative"], r["urgency"], r["route"])
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == want and len(got) == 4


def test_routing_restart_and_replay_add_nothing_twice(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    sinks = {n: str(tmp_path / n) for n in ("support_urgent", "feedback_backlog", "analytics", "rejected")}

    def run(checkpoint):
        stream = rv.read_reviews(spark, src, streaming=True, files_per_trigger=1)
        triage.start_routing(stream, scorer, sinks, checkpoint).awaitTermination()

    def stored():
        return {n: sorted(r["review_id"] for r in spark.read.parquet(p).collect())
                for n, p in sinks.items()}

    write_json(spark, src, list(enumerate(TEXTS)))
    run(cp)
    first = stored()
    assert first == {"support_urgent": [0, 6], "feedback_backlog": [1], "analytics": [2],
                     "rejected": [3, 4, 5]}
    run(cp)  # nothing new
    assert stored() == first
    write_json(spark, src, [(10, TEXTS[0])])
    run(cp)
    second = stored()
    assert second["support_urgent"] == [0, 6, 10] and second["analytics"] == [2]
    # A lost checkpoint replays the batches under the same ids: same output.
    run(str(tmp_path / "cp2"))
    assert sum(map(len, stored().values())) == len(TEXTS) + 1


def test_routing_needs_every_sink(spark, tmp_path):
    with pytest.raises(ValueError, match="rejected"):
        triage.start_routing(None, scorer, {"support_urgent": "a", "feedback_backlog": "b",
                                            "analytics": "c"}, "cp")


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    day = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    m = {"f1_negative": 0.12345, "recall_negative": 0.5, "precision_negative": 0.25}
    for exp, shift, f1 in (("base", 0, 0.1), ("base", 2, 0.90285), ("base", 1, 0.3), ("big", 0, 0.7)):
        runs.log_run(spark, path, exp, "n", {"C": 1.0}, {**m, "f1_negative": f1},
                     day + dt.timedelta(days=shift))
    log = spark.read.parquet(path)
    assert log.count() == 4 and log.first()["params"] == {"C": "1.0"}
    got = {r["experiment"]: r["f1_negative"] for r in runs.latest_runs(log).collect()}
    assert got == {"base": pytest.approx(0.9028, abs=1.1e-4), "big": 0.7}


def test_every_batch_of_an_arriving_half_has_a_file_per_core(spark, tmp_path):
    rows = [(k, f"text number {k}") for k in range(2000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "t" / "documents.parquet"))
    base, plans = str(tmp_path / "s"), []

    def start(stream):
        plans.append(stream)
        own = stream.writeStream.format("parquet").option("path", f"{base}/out")
        return own.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()

    catalog._arriving(spark, str(tmp_path / "t"), base, start)
    files = spark.read.parquet(f"{base}/in").select(F.input_file_name()).distinct().count()
    assert len(plans) == 2 and files == 4 * spark.sparkContext.defaultParallelism  # were 4 files, read by a task each
    batches = [p.name for p in (tmp_path / "s" / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 4
    assert sorted(r["review_id"] for r in spark.read.parquet(f"{base}/out").collect()) == list(range(2000))
