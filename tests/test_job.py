import os
import random

import pytest
from pyspark.sql import functions as F

from promolens.config import PipelineConfig
from promolens.plans.evaluation import evaluation_frame, evaluation_tables, report_text
from promolens.plans.job import run_pipeline
from promolens.sources.csv import read_proposals_csv, write_csv


@pytest.fixture(scope="module")
def raw(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(600):
        region = rnd.choice(["North", "South", "East"])
        rej = region == "North" or rnd.random() < 0.2
        amount = rnd.uniform(100, 3000)
        rows.append((f"P{i}", f"{amount:.2f}", f"{amount * rnd.uniform(0.2, 0.7):.2f}", region,
                     rnd.choice(["Store", "Individual"]), rnd.choice(["Bikes", "Parts"]), "0" if rej else "1",
                     str(rnd.randint(1, 30)), f"{rnd.uniform(50, 900):.2f}", f"{rnd.random():.3f}",
                     str(rnd.randint(1, 300))))
    schema = ("ProposalID string, ProposalAmount string, Cost string, Region string, CustomerType string, "
              "ProductCategory string, Accepted string, Purchases string, AvgOrderValue string, "
              "PromoResponseRate string, Recency string")
    return spark.createDataFrame(rows, schema)


def test_run_pipeline_end_to_end(spark, raw, tmp_path):
    from promolens.__main__ import main

    src = str(tmp_path / "proposals_csv")
    write_csv(raw, src)
    props = read_proposals_csv(spark, src)
    assert props.count() == 600 and all(t == "string" for _, t in props.dtypes)
    out_dir = str(tmp_path / "out")
    cfg = PipelineConfig(model="gbt", gbt_max_iter=10, budget=20_000.0, out_dir=out_dir, kmeans_k=(2, 3))
    out = run_pipeline(props, cfg)
    assert out.scored.count() == 600
    seg = out.segmented
    assert seg.where(F.col("segment").isNull()).count() == 0
    sel = out.selection
    chosen = sel.where("selected = 1").agg(F.sum("Cost")).first()[0] or 0.0
    assert chosen <= 20_000.0 + 1e-6
    for name in ("proposal_accept_scores", "customer_segments", "proposal_selection", "proposal_model",
                 "model_report"):
        assert os.path.exists(os.path.join(out_dir, name)), name
    figures = {r["metric"]: r["value"] for r in out.report.where("section = 'optimization'").collect()}
    sums = sel.where("selected = 1").agg(F.count(F.lit(1)), F.sum("Cost"), F.sum("expected_profit")).first()
    assert figures["selected_count"] == sums[0]
    assert abs(figures["total_selected_cost"] - sums[1]) < 0.02 and abs(figures["total_selected_profit"] - sums[2]) < 0.02
    # the saved model scores and segments like the run that made it, row by row
    main(["score", "--data", src, "--model-dir", os.path.join(out_dir, "proposal_model"), "--out", str(tmp_path / "again")])
    again = {r["ProposalID"]: (r["accept_prob"], r["segment"], r["margin"]) for r in spark.read.parquet(str(tmp_path / "again")).collect()}
    assert again == {r["ProposalID"]: (r["accept_prob"], r["segment"], r["margin"]) for r in seg.collect()}
    text = report_text(out.report)
    assert "AUC:" in text and "Total selected cost" in text

    ev = evaluation_frame(props, spark.read.parquet(os.path.join(out_dir, "proposal_accept_scores")),
                          spark.read.parquet(os.path.join(out_dir, "proposal_selection")))
    tabs = evaluation_tables(ev)
    assert tabs.score_histogram.count() == 80
    assert tabs.selected_deals.count() == sel.where("selected = 1").count()


def test_csv_command_line_round_trip(spark, raw, tmp_path):
    from promolens.__main__ import main

    dirty = raw.withColumns({
        "Purchases": F.when(F.col("ProposalID") == "P1", "NA").when(F.col("ProposalID") == "P2", "abc").otherwise(F.col("Purchases")),
        "Recency": F.when(F.col("ProposalID") == "P3", "").otherwise(F.col("Recency")),
        "Region": F.when(F.col("ProposalID") == "P4", "N/A").otherwise(F.col("Region")),
        "Accepted": F.concat("Accepted", F.lit(".0"))})
    src, out, ev = (str(tmp_path / d) for d in ("in", "out", "eval"))
    write_csv(dirty, src)
    rows = {r["ProposalID"]: r for r in read_proposals_csv(spark, src).collect()}
    assert rows["P1"]["Purchases"] is None and rows["P3"]["Recency"] is None and rows["P4"]["Region"] is None
    main(["pipeline", "--data", src, "--budget", "20000", "--model", "rf", "--out", out, "--format", "csv"])
    main(["evaluate", "--proposals", src, "--scores", f"{out}/proposal_accept_scores", "--selection", f"{out}/proposal_selection", "--outdir", ev])
    assert spark.read.parquet(f"{ev}/score_histogram").agg(F.sum("count")).first()[0] == 600
    scores = read_proposals_csv(spark, f"{out}/proposal_accept_scores").select(F.col("accept_prob").cast("double").alias("p")).distinct().count()
    assert spark.read.parquet(f"{ev}/pr_curve").count() == scores + 1


def test_text_scores_tie_like_numbers(spark):
    props = spark.createDataFrame([("a", "1.0"), ("b", "0"), ("c", "true")], "ProposalID string, Accepted string")
    scores = spark.createDataFrame([("a", "0.5"), ("b", "0.50"), ("c", "0.9")], "ProposalID string, accept_prob string")
    sel = spark.createDataFrame([("a", "1", "2.5", "abc")], "ProposalID string, selected string, expected_profit string, Cost string")
    df = evaluation_frame(props, scores, sel)
    assert dict(df.dtypes)["accept_prob"] == "double" and {r["Accepted"] for r in df.collect()} == {0, 1}
    tabs = evaluation_tables(df)
    assert tabs.pr_curve.count() == 3 and tabs.roc_auc.first()[0] == 0.75


def test_evaluation_needs_labels(spark, raw):
    scores = raw.select("ProposalID", F.lit(0.5).alias("accept_prob"))
    props = raw.withColumn("Accepted", F.when(F.col("ProposalID") == "P3", None).otherwise(F.col("Accepted")))
    sel = raw.select("ProposalID", F.lit(0).alias("selected"), F.lit(1.0).alias("expected_profit"),
                     F.lit(1.0).alias("Cost"))
    with pytest.raises(ValueError, match="Accepted"):
        evaluation_frame(props, scores, sel)


def test_skip_kmeans_flag(spark, raw, tmp_path):
    out_dir = str(tmp_path / "csv_out")
    out = run_pipeline(raw, PipelineConfig(model="rf", rf_num_trees=10, skip_kmeans=True, budget=5_000.0,
                                           out_dir=out_dir, output_format="csv"))
    back = read_proposals_csv(spark, os.path.join(out_dir, "proposal_selection"))
    assert back.count() == out.selection.count()
    assert out.segments.reason == "skipped by flag"
    assert out.segmented.where(F.col("segment").isNotNull()).count() == 0
    assert "Segmentation skipped" in report_text(out.report)


def test_every_row_is_scored_once(spark, raw):
    """Segmentation, selection and sinks read the written scores: their plans hold no step of the model."""
    out = run_pipeline(raw, PipelineConfig(model="gbt", gbt_max_iter=3, budget=20_000.0, kmeans_k=(2,)))
    for df in (out.scored, out.segmented, out.selection):
        assert "ArrowEvalPython" not in df._jdf.queryExecution().executedPlan().toString()
    assert out.scored.count() == 600
