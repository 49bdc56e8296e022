"""The proposal job: features -> classifier -> segments -> selection -> sinks.

``run_pipeline`` is the Spark re-expression of the reference command line
job: every step is a DataFrame or Spark ML operation, outputs are written
by the executors (partitioned folders, not single files) and the run
report is a small ``(section, metric, value)`` table.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame

from promolens.config import PipelineConfig
from promolens.operators import knapsack, optimal
from promolens.plans.features import add_features, require_columns
from promolens.plans.model import TrainResult, train_and_score
from promolens.plans.saved import scoring_model
from promolens.plans.segments import SegmentResult, fit_segments, segment_inputs
from promolens.session import reliable_checkpoint

SELECTION_REQUIRED = ("ProposalID", "ProposalAmount", "Cost", "accept_prob")


@dataclass
class PipelineOutputs:
    scored: DataFrame
    segmented: DataFrame
    selection: DataFrame
    report: DataFrame
    train: TrainResult
    segments: SegmentResult
    selection_result: knapsack.SelectionResult


def run_pipeline(proposals_df: DataFrame, cfg: PipelineConfig = PipelineConfig(), trained: TrainResult | None = None) -> PipelineOutputs:
    """``trained``: a fit of the same proposals and parameters, not fitted again."""
    spark = proposals_df.sparkSession
    tr = trained or train_and_score(add_features(proposals_df), cfg)
    # Every row goes down every tree once: the scored frame is written, and read by segmentation, selection and each sink.
    scored = reliable_checkpoint(tr.scored)

    if cfg.skip_kmeans:
        seg = SegmentResult(None, None, None, "skipped by flag", [])
    else:
        seg = fit_segments(segment_inputs(scored, list(cfg.segment_features)), cfg.kmeans_k, cfg.seed)
    segmented = seg.assign(scored)

    require_columns(segmented, SELECTION_REQUIRED, "optimization")
    if cfg.optimal and cfg.opt_top_n is not None:
        raise ValueError("the optimal selection has no candidate cap: leave opt_top_n unset")
    sel = (optimal.select_optimal(segmented, cfg.budget) if cfg.optimal
           else knapsack.select_within_budget(segmented, cfg.budget, top_n=cfg.opt_top_n))
    tot = sel.totals.first()

    rows = [(r["section"], r["metric"], r["value"]) for r in tr.metrics.collect()]
    rows += [("kmeans", "k", float(seg.k) if seg.k else None),
             ("kmeans", "silhouette", seg.silhouette),
             ("optimization", "selected_count", float(tot["selected_count"])),
             ("optimization", "total_selected_cost", float(tot["total_cost"])),
             ("optimization", "total_selected_profit", float(tot["total_profit"])),
             ("optimization", "lp_bound", float(tot["lp_bound"])),
             ("optimization", "gap", float(tot["gap"]))]
    rows += [("classification_report", f"{r['label']}:{m}", r[m])
             for r in tr.class_report.collect() for m in ("precision", "recall", "f1_score", "support")
             if r[m] is not None]
    report = spark.createDataFrame([(s, m, float(v) if v is not None else None) for s, m, v in rows],
                                   "section string, metric string, value double")
    out = PipelineOutputs(scored, segmented, sel.selection, report, tr, seg, sel)
    if cfg.out_dir:
        save_outputs(out, cfg.out_dir, cfg.output_format)
    return out


def save_outputs(out: PipelineOutputs, out_dir: str, fmt: str = "parquet") -> None:
    """Sinks: three tables, the fitted model (``saved.scoring_model``) and the run report, written
    by the executors (a folder of part files per table)."""
    def write(df: DataFrame, name: str) -> None:
        w = df.write.mode("overwrite")
        path = os.path.join(out_dir, name)
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.parquet(path)

    write(out.scored, "proposal_accept_scores")
    write(out.segmented, "customer_segments")
    write(out.selection, "proposal_selection")
    scoring_model(out.train, out.segments).write().overwrite().save(os.path.join(out_dir, "proposal_model"))
    out.report.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, "model_report"))
