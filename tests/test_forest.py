"""The forest's counts, splits and votes against plain ones, and against Spark's model."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from promolens.operators import forest
from promolens.operators.forest import Forest


def _rows(n=1500, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 4, n), rng.random(n).round(3), rng.integers(0, 2, n)]).astype(float)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 2) ^ (rng.random(n) < 0.05)).astype(int)
    return x, y


@pytest.fixture(scope="module")
def train(spark):
    x, y = _rows()
    df = spark.createDataFrame([(i, r.tolist(), int(b), 0.7 if b else 1.6) for i, (r, b) in enumerate(zip(x, y, strict=True))],
                               "id int, x array<double>, label int, weight double")
    return df.withColumn("features", array_to_vector("x")).repartition(3)


def _forest(**more):
    return Forest(labelCol="label", featuresCol="features", weightCol="weight", seed=7, featureSubsetStrategy="sqrt", **more)


def test_counts_of_a_level():
    rng = np.random.default_rng(3)
    x, y, drawn = rng.integers(0, 8, (400, 5)).astype(np.uint8), rng.integers(0, 2, 400), rng.poisson(1, 400).astype(np.uint8)
    # the root splits feature 2 at bin 3; its left child is a leaf
    subset = np.array([[0, 4]])
    got = forest.level_counts(2 * x + y[:, None].astype(np.uint8), drawn, 1, np.array([2]), np.array([7], np.uint8), np.array([-1, 0]), subset, 8).reshape(2, 8, 2)
    for j, f in enumerate((0, 4)):
        for b in range(8):
            for label in (0, 1):
                assert got[j, b, label] == drawn[(x[:, 2] > 3) & (x[:, f] == b) & (y == label)].sum()


def test_best_split_is_the_largest_gain():
    counts = np.random.default_rng(6).integers(0, 9, (3, 2, 5, 2))
    counts[:, 1] = 0
    counts[:, 1, :2] = np.stack([counts[:, 0, :2].sum(1), counts[:, 0, 2:].sum(1)], 1)  # each feature counts the same rows
    counts[2] = 0
    counts[2, :, 0] = (4, 0)  # one label only
    w = (0.5, 2.0)
    gini = lambda c: 1 - sum((a * b / (c @ np.array(w))) ** 2 for a, b in zip(c, w, strict=True))
    gain, f, b, left, right = forest.best_splits(counts, w)
    for k in range(2):
        total = counts[k, 0].sum(0)
        tried = {}
        for i in range(2):
            for j in range(4):
                a, c = counts[k, i, :j + 1].sum(0), counts[k, i, j + 1:].sum(0)
                if a.sum() and c.sum():
                    tried[i, j] = gini(total) - (a @ w * gini(a) + c @ w * gini(c)) / (total @ w)
        assert math.isclose(gain[k], max(tried.values())) and math.isclose(tried[int(f[k]), int(b[k])], gain[k])
        assert (left[k] + right[k] == total).all()
    assert gain[2] == -1 and left[2].tolist() == [4, 0] and right[2].tolist() == [0, 0]


def test_draws_are_poisson():
    d = forest.draws(1, 2, 3, 200_000, forest.draws_table())
    assert abs(d.mean() - 1) < 0.02 and abs(d.var() - 1) < 0.03 and abs((d == 0).mean() - math.exp(-1)) < 0.01
    assert (d == forest.draws(1, 2, 3, 200_000, forest.draws_table())).all() and (d != forest.draws(1, 3, 3, 200_000, forest.draws_table())).any()


def test_scores_are_those_of_sparks_model(train, tmp_path):
    """By arrays as by Spark's own walk over the saved trees, bit for bit; and about as good as Spark's own fit."""
    model = PipelineModel([_forest(numTrees=12, maxDepth=5).fit(train)])
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert type(again.stages[0]) is RandomForestClassificationModel and again.stages[0].getNumTrees == 12
    cols = ["id", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p"), "prediction", "label"]
    a, b = ([tuple(r) for r in m.transform(train).select(*cols).orderBy("id").collect()] for m in (model, again))
    assert a == b and len(a) == 1500
    own = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", seed=7, numTrees=12, maxDepth=5).fit(train)
    right = [m.transform(train).where("prediction = label").count() / 1500 for m in (model, own)]
    assert right[0] > 0.85 and abs(right[0] - right[1]) < 0.05


def test_every_row_is_drawn_from(train):
    """A tree's root counts about as many draws as there are rows, by label, however the rows lie in blocks."""
    trees = {}
    for n in (100, 65_536):
        forest.BLOCK_ROWS, kept = n, forest.BLOCK_ROWS
        try:
            x = train.select("x", F.col("label").cast("double").alias("y"))
            edges = forest.bin_edges(x, 4, 32, between=True)
            trees[n] = forest.grow(x, edges, 40, 2, 5, (1.0, 1.0))
        finally:
            forest.BLOCK_ROWS = kept
    _, y = _rows()
    for made in trees.values():
        root = np.mean([t.counts[0] for t in made], 0)
        assert np.allclose(root, [(y == 0).sum(), (y == 1).sum()], rtol=0.05)


def test_other_input_goes_to_sparks_fit(train):
    odd = train.withColumn("weight", F.col("id") % 3 + F.lit(1.0))
    assert type(_forest(numTrees=3, maxDepth=3).fit(odd)) is RandomForestClassificationModel
