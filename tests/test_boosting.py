"""Leaf-wise boosting against a plain finder of splits."""

import concurrent.futures
import json
import math
import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from promolens.operators import boosting
from promolens.operators.boosting import BoostedTreesModel, BoostParams, Grower, flat_table, score_rows


def _rows(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 4, n), rng.random(n).round(3), rng.integers(0, 2, n)]).astype(float)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 2) ^ (rng.random(n) < 0.1)).astype(float)
    return x, y, rng.choice([0.5, 1.0, 2.0], n), np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def _plain_tree(x, y, w, score, p):
    """Best-first growth by trying every value of every feature."""
    prob = 1 / (1 + np.exp(-score))
    g, h = w * (prob - y), w * prob * (1 - prob)

    def best(rows):
        top = None
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f])[:-1]:
                a, b = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                if min(len(a), len(b)) < p.min_rows:
                    continue
                gain = g[a].sum() ** 2 / h[a].sum() + g[b].sum() ** 2 / h[b].sum() - g[rows].sum() ** 2 / h[rows].sum()
                if gain > 1e-12 and (top is None or gain > top[0] + 1e-9):
                    top = (gain, a, b)
        return top

    leaves = [(np.arange(len(y)), best(np.arange(len(y))))]
    while len(leaves) < p.leaves and any(b for _, b in leaves):
        k = max((i for i, (_, b) in enumerate(leaves) if b), key=lambda i: leaves[i][1][0])
        _, (_, a, b) = leaves.pop(k)
        leaves += [(a, best(a)), (b, best(b))]
    out = score.copy()
    for rows, _ in leaves:
        out[rows] -= p.step * g[rows].sum() / h[rows].sum()
    return out, len(leaves)


def _edges(x):
    return [sorted(set(c))[:-1] for c in x.T]


def test_trees_equal_a_plain_finder():
    x, y, w, key = _rows(180)
    x[:, 0] = x[:, 0].round(0)
    x[:, 2] = (x[:, 2] * 20).round(0)
    p = BoostParams(rounds=4, step=0.3, leaves=9, min_rows=5, row_share=1.0, column_share=1.0)
    grower = Grower(boosting.binned(x, _edges(x)), y, w, key, p)
    score = grower.score.copy()
    for t in range(p.rounds):
        tree = grower.tree(t)
        score, leaves = _plain_tree(x, y, w, score, p)
        assert (len(tree["value"]) + 1) // 2 == leaves
        assert np.allclose(grower.score, score, atol=1e-9)


@pytest.mark.parametrize("cells", [1, 64, 4096])
def test_columns_counted_together_count_alike(cells, monkeypatch):
    monkeypatch.setattr(boosting, "JOINT_CELLS", cells)
    monkeypatch.setattr(boosting, "JOINT_ROWS", 50)
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, n, 700) for n in (64, 2, 2, 12, 1, 64, 2)]).astype(np.uint8)
    y, g, h = rng.integers(0, 2, 700).astype(float), rng.normal(size=700), rng.random(700)
    grower = Grower(x, y, np.ones(700), np.arange(700, dtype=np.uint64), BoostParams())
    columns, nodes = np.array([0, 1, 3, 4, 6]), [np.arange(0, 700, 3), np.arange(0), np.arange(40)]
    got = grower.histograms(nodes, columns, g, h)
    for k, rows in enumerate(nodes):
        for i, c in enumerate(columns):
            for j, v in enumerate((g, h, np.ones(700))):
                assert np.allclose(got[k, j, i], np.bincount(x[rows, c], v[rows], 64), atol=1e-9)


def test_scores_follow_the_trees():
    x, y, w, key = _rows()
    p = BoostParams(rounds=12, leaves=16)
    edges = _edges(np.round(x, 1))
    grower = Grower(boosting.binned(x, edges), y, w, key, p)
    trees = [grower.tree(t) for t in range(p.rounds)]
    assert np.allclose(score_rows(x, grower.start, flat_table(edges, trees)), grower.score, atol=1e-9)


@pytest.fixture(scope="module")
def train(spark):
    x, y, w, _ = _rows(900, 3)
    df = spark.createDataFrame([(f"P{i}", [float(v) for v in r], float(a), float(b)) for i, (r, a, b) in enumerate(zip(x, y, w, strict=True))],
                               "ProposalID string, x array<double>, label double, weight double")
    return df.withColumn("features", array_to_vector("x"))


def test_several_tasks_grow_the_trees_of_one(train):
    p = BoostParams(rounds=2, leaves=6)
    one = boosting.grow(train, "features", "label", "weight", "ProposalID", p)
    two = boosting.grow(train, "features", "label", "weight", "ProposalID", p, rows_per_task=450)
    assert math.isclose(one[0], two[0]) and one[1] == two[1]
    for a, b in zip(one[2], two[2], strict=True):
        assert (a["feature"], a["bin"], a["left"]) == (b["feature"], b["bin"], b["left"])
        assert np.allclose(a["value"], b["value"])


def test_exchange_by_files_and_by_gather_agree(train, monkeypatch):
    p = BoostParams(rounds=1, leaves=4)
    files = boosting.grow(train, "features", "label", "weight", "ProposalID", p, rows_per_task=300)
    monkeypatch.setattr(boosting, "plain_folder", lambda path: None)
    gathered = boosting.grow(train, "features", "label", "weight", "ProposalID", p, rows_per_task=300)
    assert math.isclose(files[0], gathered[0]) and files[1] == gathered[1]
    for a, b in zip(files[2], gathered[2], strict=True):
        assert a["bin"] == b["bin"] and np.allclose(a["value"], b["value"])


def test_edges_are_quantiles_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 300)
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=4000), rng.integers(0, 3, 4000), np.where(rng.random(4000) < 0.3, np.nan, rng.random(4000)), np.full(4000, np.nan)])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3)
    got = boosting.bin_edges(df, 4, 8)
    assert got[1] == [0.0, 1.0, 2.0] and got[3] == []
    for j in (0, 2):
        v = np.sort(x[~np.isnan(x[:, j]), j])
        assert got[j] == [v[math.ceil(i * len(v) / 8) - 1] for i in range(1, 8)]
    v, n = boosting._summary(x[:, 0], 64)  # more values than points: ranks are off by one point's rows at most
    assert len(v) <= 64 and n.sum() == 4000 and n.max() <= 2 * 4000 / 64 and v[-1] == x[:, 0].max()


def test_files_are_read_in_step(tmp_path):
    """Three tasks, one of them slow: every step brings all of that step's bytes, in the order of the tasks."""
    rng = np.random.default_rng(1)

    def run(me):
        gather = boosting._through_files(str(tmp_path), me, 3)
        out = []
        for step in range(40):
            if me == step % 3:
                time.sleep(float(rng.random()) / 500)
            out.append(gather(f"{me}:{step}".encode() * (step + 1)))
        return out

    with concurrent.futures.ThreadPoolExecutor(3) as pool:
        for got in pool.map(run, range(3)):
            assert got == [[f"{k}:{step}".encode() * (step + 1) for k in range(3)] for step in range(40)]
    assert not boosting.plain_folder("hdfs://a/b") and boosting.plain_folder("file:///a/b") == boosting.plain_folder("file:/a/b") == "/a/b"


def test_saved_model_scores_alike(train, tmp_path):
    model = PipelineModel([boosting.BoostedTrees(BoostParams(rounds=30, leaves=8)).fit(train)])
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(again.stages[0], BoostedTreesModel)
    p = vector_to_array(F.col("probability"))[1]
    a, b = ([r[0] for r in m.transform(train).orderBy("ProposalID").select(p).collect()] for m in (model, again))
    assert a == b
    label = [r[0] for r in train.orderBy("ProposalID").select("label").collect()]
    assert np.mean((np.array(a) > 0.5) == np.array(label)) > 0.85


def test_no_training_rows(train):
    with pytest.raises(ValueError, match="no training rows"):
        boosting.grow(train.limit(0), "features", "label", "weight", "ProposalID", BoostParams(rounds=1))


@pytest.mark.parametrize("leaves", [1, 2, 8, 64])
def test_words_score_as_the_walk_does(leaves):
    x, y, w, key = _rows(900)
    edges = [sorted(set(np.quantile(x[:, j], np.arange(1, 64) / 64).tolist())) for j in range(x.shape[1])]
    g = Grower(boosting.binned(x, edges), y, w, key, BoostParams(rounds=7, leaves=leaves, min_rows=2))
    trees = [g.tree(t) for t in range(7)]
    odd = np.vstack([x, [np.nan, 1, np.inf, 0], [-np.inf, np.nan, np.nan, np.nan], [edges[0][3], 9, -1, 1]])
    words = boosting.leaf_words(edges, trees)
    assert np.array_equal(boosting.score_words(odd, g.start, words), score_rows(odd, g.start, flat_table(edges, trees)))


def test_larger_trees_are_walked(spark):
    x, y, w, key = _rows(900)
    edges = [sorted(set(np.quantile(x[:, j], np.arange(1, 64) / 64).tolist())) for j in range(x.shape[1])]
    g = Grower(boosting.binned(x, edges), y, w, key, BoostParams(leaves=100, min_rows=2))
    trees = [g.tree(0)]
    assert trees[0]["left"].count(0) == 0 and len(trees[0]["left"]) > 127 and boosting.leaf_words(edges, trees) is None
    model = BoostedTreesModel(featuresCol="features", trees=json.dumps({"start": g.start, "edges": edges, "trees": trees}))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, a array<double>").select("i", array_to_vector("a").alias("features"))
    got = {r["i"]: r["p"] for r in model.transform(df).select("i", vector_to_array("probability")[1].alias("p")).collect()}
    want = 1 / (1 + np.exp(-score_rows(x, g.start, flat_table(edges, trees))))
    assert all(got[i] == pytest.approx(v, abs=1e-12) for i, v in enumerate(want))
