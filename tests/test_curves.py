from pyspark.sql import functions as F

from promolens.operators import curves


def _df(spark, pairs):
    return spark.createDataFrame([(f"r{i}", s, y) for i, (s, y) in enumerate(pairs)], "id string, s double, y int")


def test_auc_perfect_reversed_and_ties(spark):
    perfect = _df(spark, [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)])
    assert curves.roc_auc(perfect, "s", "y").first()[0] == 1.0
    reverse = _df(spark, [(0.1, 1), (0.2, 1), (0.8, 0), (0.9, 0)])
    assert curves.roc_auc(reverse, "s", "y").first()[0] == 0.0
    same = _df(spark, [(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)])
    assert curves.roc_auc(same, "s", "y").first()[0] == 0.5
    assert curves.pr_curve(same, "s", "y").count() == 2


def test_auc_invariant_under_monotone_map(spark):
    import random
    rnd = random.Random(5)
    pairs = [(rnd.random(), rnd.randint(0, 1)) for _ in range(500)]
    a = curves.roc_auc(_df(spark, pairs), "s", "y").first()[0]
    b = curves.roc_auc(_df(spark, [(s ** 3, y) for s, y in pairs]), "s", "y").first()[0]
    assert a == b


def test_average_precision_hand_value(spark):
    # scores desc: 0.9(1) 0.8(0) 0.7(1): AP = 0.5*1 + 0.5*(2/3)
    df = _df(spark, [(0.9, 1), (0.8, 0), (0.7, 1)])
    assert abs(curves.average_precision(df, "s", "y").first()[0] - (0.5 + 1 / 3)) < 1e-12
    best = curves.best_f1_threshold(df, "s", "y").first()
    assert best["best_threshold"] == 0.7  # F1 0.8 at the lowest threshold


def test_histogram_and_lift(spark):
    import random
    rnd = random.Random(2)
    pairs = [(round(rnd.random(), 2), rnd.randint(0, 1)) for _ in range(400)]
    df = _df(spark, pairs).withColumn("tie", F.abs(F.hash("id")).cast("bigint"))
    h = curves.score_histogram(df, "s", "y")
    assert h.count() == 80
    assert h.agg(F.sum("count")).first()[0] == 400
    import numpy as np
    acc = np.array([s for s, y in pairs if y == 1])
    want, _ = np.histogram(acc, bins=40)
    got = [r["count"] for r in h.where("class_label = 'Accepted'").orderBy("bin").collect()]
    assert got == list(want)
    lg = curves.lift_gain(df, "id", "s", "y", "tie").orderBy("position").collect()
    assert abs(lg[-1]["gain"] - 100.0) < 1e-6 and abs(lg[-1]["perc_population"] - 100.0) < 1e-9


def test_one_class_only(spark):
    df = _df(spark, [(0.3, 1), (0.6, 1)])
    pr = curves.pr_curve(df, "s", "y").where("threshold is not null").collect()
    assert all(r["precision"] == 1.0 for r in pr)
    rep = {r["label"]: r for r in curves.classification_report(df, "s", "y", 0.5).collect()}
    assert rep["Accepted"]["precision"] == 0.0 and rep["accuracy"]["f1_score"] == 0.5
    assert curves.roc_auc(df, "s", "y").first()[0] is None and curves.average_precision(df, "s", "y").first()[0] == 1.0
    none = _df(spark, [(0.3, 0), (0.6, 0)])
    assert curves.roc_auc(none, "s", "y").first()[0] is None and curves.average_precision(none, "s", "y").first()[0] == 0.0
    assert curves.binary_summary(none, "s", "y")["auc"] is None
