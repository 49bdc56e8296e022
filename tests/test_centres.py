import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from promolens.operators import centres


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 0.6, (150, 2)) for m in ((0, 0), (6, 0), (0, 7), (5, 6))])
    df = spark.createDataFrame([(f"r{i}", float(a), float(b)) for i, (a, b) in enumerate(x)], "id string, z_a double, z_b double")
    return x, df.repartition(3).cache()


def _plain(x, c, tol=1e-4):
    while True:
        at = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(len(c))])
        if ((new - c) ** 2).sum(1).max() <= tol ** 2:
            return c, ((x - c[at]) ** 2).sum()
        c = new


def test_all_k_equal_separate_fits(spark, table):
    x, df = table
    cols = ["z_a", "z_b"]
    rows = df.select(*cols, F.xxhash64("id").alias("h"))
    seeds = centres.draw_seeds(rows, cols, 5, 2, 42)
    assert seeds.shape == (2, 5, 2) and all(len(np.unique(s, axis=0)) == 5 for s in seeds)
    assert all((np.abs(x - p).sum(1) < 1e-12).any() for s in seeds for p in s)  # seeds are rows
    got = centres.fit_centres(df, "id", cols, [2, 3, 4, 5], seed=42, starts=2)
    for k, fit in got.items():
        want = min((_plain(x, s[:k]) for s in seeds), key=lambda r: r[1])
        assert np.allclose(fit.model.centres, want[0], atol=1e-9) and fit.cost == pytest.approx(want[1])
    assert max(got, key=lambda k: got[k].silhouette) == 4


def test_silhouette_equals_the_evaluator(spark, table):
    _, df = table
    got = centres.fit_centres(df, "id", ["z_a", "z_b"], [2, 4], starts=1)
    vec = VectorAssembler(inputCols=["z_a", "z_b"], outputCol="features").transform(df)
    for fit in got.values():
        placed = vec.withColumn("prediction", F.expr(fit.model.sql()).cast("int"))
        assert ClusteringEvaluator().evaluate(placed) == pytest.approx(fit.silhouette, abs=1e-9)


def test_a_step_is_one_scan(spark, table, caplog):
    _, df = table
    calls = []
    step = centres.lloyd_step
    with pytest.MonkeyPatch.context() as m, caplog.at_level("INFO", logger="promolens.operators.centres"):
        m.setattr(centres, "lloyd_step", lambda rows, cols, sets: calls.append(len(sets)) or step(rows, cols, sets))
        centres.fit_centres(df, "id", ["z_a", "z_b"], range(2, 8), starts=3)
    assert calls[0] == 18 and f"18 sets, {len(calls)} steps" in caplog.text


def test_fewer_points_than_centres(spark):
    df = spark.createDataFrame([(f"r{i}", float(i % 2)) for i in range(20)], "id string, z_a double")
    got = centres.fit_centres(df, "id", ["z_a"], [2, 3], starts=1)
    assert got[2].cost == 0 and got[3].cost == 0 and got[2].silhouette == pytest.approx(1.0)
    same = spark.createDataFrame([(f"r{i}", 1.0) for i in range(5)], "id string, z_a double")
    assert centres.fit_centres(same, "id", ["z_a"], [2], starts=1)[2].silhouette is None


def test_steps_read_equal_rows_as_one_point(spark):
    """Twelve rows an owner, as all proposals of a customer: steps see the owners, seeds, costs and silhouettes the rows."""
    rng = np.random.default_rng(9)
    owners = np.concatenate([rng.normal(m, 0.5, (20, 2)) for m in ((0, 0), (5, 1), (1, 6))])
    x = np.repeat(owners, 12, axis=0)
    df = spark.createDataFrame([(f"r{i}", float(a), float(b)) for i, (a, b) in enumerate(x)], "id string, z_a double, z_b double")
    cols, seen = ["z_a", "z_b"], []
    step = centres.lloyd_step
    with pytest.MonkeyPatch.context() as m:
        m.setattr(centres, "lloyd_step", lambda rows, c, sets: seen.append(rows.count()) or step(rows, c, sets))
        got = centres.fit_centres(df, "id", cols, [2, 3], starts=2)
    assert set(seen) == {len(owners)}
    seeds = centres.draw_seeds(df.select(*cols, F.xxhash64("id").alias("h")), cols, 3, 2, 42)
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    for k, fit in got.items():
        want = min((_plain(x, s[:k]) for s in seeds), key=lambda r: r[1])
        assert np.allclose(fit.model.centres, want[0], atol=1e-9) and fit.cost == pytest.approx(want[1])
        placed = vec.withColumn("prediction", F.expr(fit.model.sql()).cast("int"))
        assert ClusteringEvaluator().evaluate(placed) == pytest.approx(fit.silhouette, abs=1e-9)
