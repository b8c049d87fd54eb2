import pytest
from pyspark.sql import functions as F

from tests.test_sources_streaming import TEXTS, scorer, write_json
from voicelane.operators import model as mo
from voicelane.sources import commits as cm
from voicelane.sources import reviews as rv
from voicelane.sources import runs
from voicelane.streaming import triage

LANES = ("support_urgent", "feedback_backlog", "analytics")
SCHEMA = "review_id bigint, route string"


def ids(df):
    return sorted(r["review_id"] for r in df.collect())


def test_keys_are_final_and_checked(spark, tmp_path):
    path = str(tmp_path / "c")
    assert cm.committed(spark, path, "a") is None and cm.latest(spark, path) is None
    cm.commit(spark, path, "a", {"v": 1})
    cm.commit(spark, path, "a", {"v": 2})
    assert cm.committed(spark, path, "a") == {"v": 1} and cm.commits(spark, path).count() == 1
    cm.commit(spark, path, "b", {"v": 3})
    assert cm.latest(spark, path) == {"v": 3}
    with pytest.raises(ValueError, match="key"):
        cm.commit(spark, path, "../x")


def test_a_commit_that_died_can_be_made_again(spark, tmp_path):
    path = str(tmp_path / "c")
    (tmp_path / "c" / "key_of=a" / "_temporary" / "0").mkdir(parents=True)
    assert cm.committed(spark, path, "a") is None
    cm.commit(spark, path, "a", {"v": 1})
    assert cm.committed(spark, path, "a") == {"v": 1}


def test_fan_out_shows_all_lanes_or_none(spark, reviews, tmp_path):
    sinks, path = {r: str(tmp_path / r) for r in LANES}, str(tmp_path / "commits")
    scored = scorer(reviews(TEXTS[0], TEXTS[1], TEXTS[2]))
    lanes = lambda: [ids(rv.lane(spark, s, path, SCHEMA)) for s in sinks.values()]
    # A delivery that died after its second sink.
    for lane in LANES[:2]:
        rv.response(scored.filter(F.col("route") == lane)).write.json(f"{sinks[lane]}/delivery=k1")
    rv.fan_out(scored.limit(0), sinks, commits=path, key="k0")
    assert lanes() == [[], [], []]
    for _ in range(2):
        rv.fan_out(scored, sinks, commits=path, key="k1")
        assert lanes() == [[0], [1], [2]]
    rv.fan_out(scored, sinks, commits=path, key="k2")
    assert lanes() == [[0, 0], [1, 1], [2, 2]]
    with pytest.raises(ValueError, match="together"):
        rv.fan_out(scored, sinks, key="k3")
    with pytest.raises(ValueError, match="no sink"):
        rv.fan_out(scored, {LANES[0]: sinks[LANES[0]]}, commits=path, key="k4")
    assert lanes() == [[0, 0], [1, 1], [2, 2]]


def test_readers_between_the_writes_of_a_save_see_the_old_model(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    train = spark.createDataFrame([(k, t, k % 2) for k, t in enumerate(["bad film", "good film"] * 4)],
                                  "review_id bigint, text string, label int")
    old, new = mo.fit(train), mo.fit(train, C=10.0)
    with pytest.raises(ValueError, match="no model"):
        mo.ReviewModel.load(spark, path)
    old.save(spark, path)
    seen, plain = [], cm.commit

    def read_first(*args):
        seen.append(mo.ReviewModel.load(spark, path))
        plain(*args)

    monkeypatch.setattr(mo.cm, "commit", read_first)
    new.save(spark, path)
    assert seen[0].intercept == old.intercept and list(seen[0].coef) == pytest.approx(list(old.coef))
    again = mo.ReviewModel.load(spark, path)
    assert again.intercept == new.intercept and list(again.coef) == pytest.approx(list(new.coef))
    monkeypatch.setattr(mo.cm, "commit", lambda *args: None)  # a save that died before its commit
    old.save(spark, path)
    assert mo.ReviewModel.load(spark, path).intercept == new.intercept


def test_runs_under_a_key_are_logged_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = runs.log_run(spark, path, "e", "n", {"C": 1}, {"f1": 0.5}, key="k")
    assert runs.log_run(spark, path, "e", "n", {"C": 1}, {"f1": 0.7}, key="k") == first
    other = {runs.log_run(spark, path, "e", "n", {}, {}), runs.log_run(spark, path, "e2", "n", {}, {}, key="k")}
    log = {r["run_id"]: r["metrics"] for r in runs.read_runs(spark, path).collect()}
    assert log[first] == {"f1": 0.5} and set(log) == {first, *other} and len(log) == 3
    # A call that died while it wrote.
    (tmp_path / "runs" / f"run={first}" / "junk").write_text("")
    for file in (tmp_path / "runs" / f"run={first}").glob("*.parquet"):
        file.rename(tmp_path / "gone")
    assert runs.log_run(spark, path, "e", "n", {"C": 1}, {"f1": 0.9}, key="k") == first
    assert {r["run_id"]: r["metrics"] for r in runs.read_runs(spark, path).collect()}[first] == {"f1": 0.9}


@pytest.mark.parametrize("partitions", [None, 3])
def test_scoring_stream_replays_a_batch_without_doubles(spark, tmp_path, partitions):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        stream = rv.read_reviews(spark, src, streaming=True, files_per_trigger=1)
        triage.start_scoring(stream, scorer, out, cp, partitions=partitions).awaitTermination()
        return ids(spark.read.parquet(out))

    write_json(spark, src, list(enumerate(TEXTS)))
    assert run() == [0, 1, 2, 6]
    assert triage.forget_last_commit(spark, cp) == 0
    write_json(spark, src, [(10, TEXTS[0])])
    assert run() == [0, 1, 2, 6, 10]
    assert triage.forget_last_commit(spark, cp) == 1
    assert run() == [0, 1, 2, 6, 10]


def test_a_committed_delivery_is_not_scored_again(reviews, tmp_path):
    sinks, path = {r: str(tmp_path / r) for r in LANES}, str(tmp_path / "commits")
    scored = scorer(reviews(TEXTS[0], TEXTS[1], TEXTS[2]))
    rv.fan_out(scored, sinks, commits=path, key="k1")
    broken = scored.withColumn("urgency", F.raise_error(F.lit("scored again")).cast("double"))
    rv.fan_out(broken, sinks, commits=path, key="k1")
