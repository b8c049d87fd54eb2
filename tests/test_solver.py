import numpy as np
import pytest

from voicelane.operators import model as mo
from voicelane.operators import solver
from voicelane.plans import studies


def sparse_rows(seed, n, size):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        slots = np.sort(rng.choice(size, rng.integers(0, 8), replace=False))
        values = rng.random(len(slots))
        rows.append((float(rng.random() < 0.3 + 0.4 * (0 in slots)), slots.tolist(), values.tolist()))
    return rows


def newton(rows, size, penalty):
    """The optimum by plain Newton steps on a dense matrix."""
    x = np.zeros((len(rows), size + 1))
    x[:, -1] = 1
    for k, (_, slots, values) in enumerate(rows):
        x[k, slots] = values
    y, w, ridge = np.array([r[0] for r in rows]), np.zeros(size + 1), np.full(size + 1, penalty)
    ridge[-1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / len(y) + ridge * w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + np.diag(ridge), slope)
    return w


@pytest.fixture(scope="module")
def made(spark):
    rows = sparse_rows(1, 200, 30)
    return rows, spark.createDataFrame(rows, "label double, indices array<int>, values array<double>").repartition(5)


def test_all_penalties_reach_their_optimum(made):
    rows, frame = made
    penalties = [1e-1, 1e-3, 1e-5]
    for penalty, got in zip(penalties, solver.solve(frame, 30, penalties, tolerance=1e-9)):
        want = newton(rows, 30, penalty)
        assert got.residual <= 1e-9
        assert np.allclose([*got.coef, got.intercept], want, atol=1e-4)


def test_shared_passes_are_those_of_the_slowest(made, monkeypatch):
    passes = []
    plain = solver.evaluate
    monkeypatch.setattr(solver, "evaluate", lambda rows, points: passes.append(len(points)) or plain(rows, points))
    found = solver.solve(made[1], 30, [1e-1, 1e-4])
    assert len(passes) == max(s.passes for s in found) and passes[0] == 2 and passes[-1] == 1


def test_partial_sums_added_by_a_shuffle_are_the_same(made, monkeypatch):
    monkeypatch.setattr(solver, "CHUNK", 7)
    monkeypatch.setattr(solver, "ENTRIES", 20)
    points = np.random.default_rng(2).normal(size=(2, 31))
    near, far = (solver.evaluate(made[1], points, limit) for limit in (1 << 30, 0))
    assert np.allclose(near[0], far[0]) and np.allclose(near[1], far[1])
    step = 1e-6
    for j in (0, 17, 30):
        moved = points.copy()
        moved[:, j] += step
        slope = (solver.evaluate(made[1], moved)[0] - near[0]) / step
        assert np.allclose(slope, near[1][:, j], rtol=1e-3, atol=1e-3)


def test_rows_without_entries_and_no_rows(spark, made):
    same = spark.createDataFrame([(1.0, [], []), (0.0, [], []), (1.0, [], [])], made[1].schema)
    got = solver.solve(same, 3, [0.1])[0]
    assert not got.coef.any() and got.intercept == pytest.approx(np.log(2), abs=1e-5)
    with pytest.raises(ValueError, match="no training rows"):
        solver.solve(same.limit(0), 3, [0.1])


def test_optimality_tells_a_fitted_model_from_a_moved_one(spark):
    texts = ["a bad film", "a good film", "bad bad plot", "good plot", "so so film", "a good bad plot"] * 3
    train = spark.createDataFrame([(k, t, k % 2) for k, t in enumerate(texts)], "review_id bigint, text string, label int")
    configs = (studies.Config("c1", 100, (1, 1), 1.0), studies.Config("c10", 100, (1, 1), 10.0),
               studies.Config("both", 100, (1, 2), 1.0, True))
    ready = mo.prepared(train)
    models = studies.fit_configs(ready, configs)
    assert models[0].space is models[1].space and models[2].space.size > models[0].space.size
    rows = studies.optimality(ready, configs, models).collect()
    assert [(r["config_no"], r["block"]) for r in sorted(rows, key=lambda r: (r["config_no"], r["block"]))] == [
        (0, "bias"), (0, "word"), (1, "bias"), (1, "word"), (2, "bias"), (2, "char"), (2, "word")]
    assert all(r["largest"] <= 1e-6 for r in rows)
    moved = mo.ReviewModel(models[0].space, models[0].coef + 0.01, models[0].intercept)
    worse = {r["block"]: r["largest"] for r in mo.optimality(ready, [(moved, 1.0)]).collect()}
    assert worse["word"] > 1e-4


def test_blocks_hold_all_rows_and_give_the_same_sums(made, monkeypatch):
    monkeypatch.setattr(solver, "ENTRIES", 20)
    blocks = solver.packed(made[1])
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    assert blocks.rdd.getNumPartitions() <= cores
    # More files than cores are still read by a task a core.
    assert solver.packed(made[1].repartition(3 * cores)).rdd.getNumPartitions() <= cores
    points = np.random.default_rng(3).normal(size=(2, 31))
    for want, got in zip(solver.evaluate(made[1], points), solver.evaluate(blocks, points)):
        assert np.allclose(want, got)


def test_the_driver_takes_few_partial_sums_of_a_pass():
    model, tasks, passes = 100_001 * 8, 100, 100
    assert solver.DRIVER_BYTES < tasks * model  # many tasks: summed by a shuffle first
    assert passes * max(solver.DRIVER_BYTES, model) < 1_000 << 20


def test_derivatives_are_added_up_by_the_tasks(spark):
    texts = [("good film", 1), ("bad film", 0), ("good plot", 1), ("bad plot", 0)] * 5
    ready = mo.prepared(spark.createDataFrame(texts, "text string, label int"))
    table = mo.optimality(ready, [(mo.fit(ready), 1.0)])
    plan = table._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "Generate inline(entries" not in plan
    assert all(r["largest"] <= 1e-6 for r in table.collect())


def test_blocks_are_read_one_by_one_and_the_session_keeps_its_settings(spark, made):
    key = "spark.sql.parquet.enableVectorizedReader"
    before = spark.conf.get(key)
    blocks = solver.packed(made[1])
    assert "Batched: false" in blocks._jdf.queryExecution().toString()
    assert spark.conf.get(key) == before
