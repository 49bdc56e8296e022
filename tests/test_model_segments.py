import random
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from promolens.config import PipelineConfig
from promolens.operators.forest import Forest
from promolens.plans import model
from promolens.plans.features import add_features
from promolens.plans.model import train_and_score
from promolens.plans.segments import fit_segments, segment_inputs
from promolens.registry import BOOSTED_MODEL


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2000):
        region = rnd.choice(["North", "South", "East", "West"])
        disc = rnd.random() * 0.5
        rejected = (region == "North") or disc > 0.35
        if rnd.random() < 0.05:
            rejected = not rejected
        acc = None if rnd.random() < 0.01 else (0 if rejected else 1)
        amount = rnd.uniform(100, 5000)
        rows.append((f"P{i}", f"{amount:,.2f}", f"{amount * rnd.uniform(0.3, 0.9):.2f}", region,
                     rnd.choice(["Store", "Individual"]), rnd.choice(["Bikes", "Parts", None]),
                     None if acc is None else str(acc), f"{disc:.3f}", f"2013-0{rnd.randint(1, 9)}-15",
                     str(rnd.randint(1, 50)), str(rnd.randint(1, 400))))
    schema = ("ProposalID string, ProposalAmount string, Cost string, Region string, CustomerType string, "
              "ProductCategory string, Accepted string, DiscountRate string, ProposalDate string, "
              "Purchases string, Recency string")
    return add_features(spark.createDataFrame(rows, schema))


def test_planted_signal_gbt(planted):
    r = train_and_score(planted, PipelineConfig(model="gbt", gbt_max_iter=20))
    assert r.auc > 0.8
    s = r.scored
    assert s.count() == 2000
    assert s.where((F.col("accept_prob") < 0) | (F.col("accept_prob") > 1) | F.col("accept_prob").isNull()).count() == 0


def test_planted_signal_rf(planted):
    r = train_and_score(planted, PipelineConfig(model="rf", rf_num_trees=30))
    assert r.auc > 0.8
    rep = {x["label"]: x for x in r.class_report.collect()}
    assert set(rep) == {"Accepted", "Rejected", "accuracy", "macro avg", "weighted avg"}


def test_missing_required_column(spark):
    df = spark.createDataFrame([("a", "1")], "ProposalID string, ProposalAmount string")
    with pytest.raises(ValueError, match="needs columns that the input lacks"):
        train_and_score(df, PipelineConfig())


def test_segment_guards(spark):
    base = [(f"r{i}", float(i), float(i % 3)) for i in range(30)]
    df = spark.createDataFrame(base, "ProposalID string, a double, b double")
    assert segment_inputs(df, ["a", "zzz"], "ProposalID").reason.startswith("missing cols")
    nulls = spark.createDataFrame([(f"r{i}", None) for i in range(30)], "ProposalID string, a double")
    assert segment_inputs(nulls, ["a"]).reason == "no usable rows"
    const = spark.createDataFrame([(f"r{i}", 5.0, float("inf")) for i in range(30)], "ProposalID string, a double, b double")
    assert "zero variance" in segment_inputs(const, ["a", "b"]).reason
    nine = spark.createDataFrame([(f"r{i}", float(i)) for i in range(9)], "ProposalID string, a double")
    assert "too few rows" in segment_inputs(nine, ["a"]).reason


def test_segments_assign_every_row(spark):
    rnd = random.Random(4)
    rows = [(f"r{i}", rnd.gauss(c * 10, 1), rnd.gauss(-c * 10, 1)) for i in range(600) for c in [i % 3]]
    df = spark.createDataFrame(rows, "ProposalID string, a double, b double")
    res = fit_segments(segment_inputs(df, ["a", "b"]))
    assert res.k in range(2, 8)
    seg = res.segments
    assert seg.count() == 600
    assert seg.where(F.col("segment").isNull() | (F.col("segment") >= res.k)).count() == 0
    assert res.k == 3
    # fitted on every row: the centroids are the means of the segments
    z = segment_inputs(df, ["a", "b"]).frame.join(seg, "ProposalID").groupBy("segment").agg(F.avg("z_a"), F.avg("z_b")).collect()
    centres = res.model.clusterCenters()
    for r in z:
        assert all(abs(x - y) < 1e-6 for x, y in zip(centres[r["segment"]], (r[1], r[2])))
    again = {r["ProposalID"]: r["segment"] for r in res.assign(df).collect()}
    assert again == {r["ProposalID"]: r["segment"] for r in seg.collect()}


def test_oversampled_training_runs(planted):
    r = train_and_score(planted, PipelineConfig(model="gbt", gbt_max_iter=5, oversample=True))
    assert r.scored.count() == 2000 and 0.0 <= r.auc <= 1.0


def test_unknown_model_rejected(planted):
    with pytest.raises(ValueError, match="unknown model"):
        train_and_score(planted, PipelineConfig(model="svm"))


def test_forest_in_parts(spark, planted, tmp_path, monkeypatch):
    """Beyond a bound of rows x trees the trees are fitted in parts; all of them vote, each as much as any other."""
    monkeypatch.setattr(model, "ROW_TREES", 20_000)
    cfg = PipelineConfig(model="rf", rf_num_trees=30)
    r = train_and_score(planted, cfg)
    forests = [s for s in r.model.stages if isinstance(s, RandomForestClassificationModel)]
    assert len(forests) > 1 and sum(f.getNumTrees for f in forests) == 30
    assert r.auc > 0.8
    # each part's share of the votes, counted again
    data = r.model.transform(planted.withColumn("weight", F.lit(1.0)))
    votes = sum((vector_to_array(F.col(f.getRawPredictionCol()))[1] for f in forests), F.lit(0.0)) / 30
    assert data.where(F.abs(vector_to_array("probability")[1] - votes) > 1e-9).count() == 0
    r.model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(planted.withColumn("weight", F.lit(1.0)))
    both = again.select("ProposalID", vector_to_array("probability")[1].alias("a")).join(data.select("ProposalID", vector_to_array("probability")[1].alias("b")), "ProposalID")
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0 and both.count() == 2000


def test_small_forests_stay_whole():
    cfg = PipelineConfig(model="rf")
    assert len(model.classifier_stages(cfg, 5_000_000)) == 1 and len(model.classifier_stages(PipelineConfig(), 10 ** 9)) == 1
    parts = model.classifier_stages(cfg, 19_200_000)
    trees = [p.getNumTrees() for p in parts[:-1]]
    assert sum(trees) == 100 and max(trees) * 19_200_000 <= model.ROW_TREES and len({p.getSeed() for p in parts[:-1]}) == len(trees)


def test_boosted_query_is_fitted_on_every_row(spark):
    """No bound on the labelled rows: train and test split together hold all of them, here more than 30 000."""
    n = 36_000
    df = add_features(spark.range(n).select(
        F.concat(F.lit("P"), "id").alias("ProposalID"), (F.col("id") % 997 + 100).cast("string").alias("ProposalAmount"),
        (F.col("id") % 89 + 1).cast("string").alias("Cost"), F.element_at(F.array(F.lit("N"), F.lit("S")), (F.col("id") % 2 + 1).cast("int")).alias("Region"),
        F.lit("Store").alias("CustomerType"), F.lit("Bikes").alias("ProductCategory"), (F.col("id") % 3 > 0).cast("int").cast("string").alias("Accepted")))
    r = train_and_score(df, replace(BOOSTED_MODEL, gbt_max_iter=2))
    support = {x["label"]: x["support"] for x in r.class_report.collect()}
    assert (support["Accepted"], support["Rejected"]) == (n * 2 // 15, n // 15)
    assert r.scored.count() == n


def test_many_rows_are_grown_without_numbers_a_row_and_tree():
    """Spark's own fit up to a bound of rows x trees, beyond it the forest that keeps rows only; its parts share the binned rows."""
    cfg = PipelineConfig(model="rf")
    assert type(model.classifier_stages(cfg, 5_000_000)[0]) is RandomForestClassifier
    (one,) = model.classifier_stages(cfg, 6_000_000)
    assert type(one) is Forest and one.getNumTrees() == 100 and one.share is None
    parts = model.classifier_stages(cfg, 19_200_000)[:-1]
    assert all(type(p) is Forest and p.share is parts[0].share is not None for p in parts) and [p.leads for p in parts] == [True] + [False] * (len(parts) - 1)
