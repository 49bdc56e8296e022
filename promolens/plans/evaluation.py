"""Evaluation of a pipeline run: the data tables behind the score plots.

Inputs are the three outputs of a run (proposals with labels, scores,
selection). Only the needed columns are joined on the proposal key, so no
column of the same name is duplicated; a missing label stops the
evaluation before any curve is computed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.hashing import hash_key
from promolens.functions.numeric import lenient_label, lenient_number
from promolens.operators import curves, knapsack


def evaluation_frame(proposals: DataFrame, scores: DataFrame, selection: DataFrame,
                     id_col: str = "ProposalID") -> DataFrame:
    """scores <- labels <- (selected, expected_profit, Cost), left joins on the
    id. The inputs may be text: scores and money become doubles (so equal
    scores are one threshold), labels and flags 0, 1 or NULL."""
    labels = proposals.select(id_col, lenient_label(F.col("Accepted")).alias("Accepted"))
    sel = selection.select(id_col, lenient_label(F.col("selected")).alias("selected"),
                           *[lenient_number(F.col(c)).alias(c) for c in ("expected_profit", "Cost")])
    df = (scores.select(id_col, lenient_number(F.col("accept_prob")).alias("accept_prob"))
          .join(labels, id_col, "left")
          .join(sel, id_col, "left"))
    if not df.where(F.col("Accepted").isNull()).limit(1).isEmpty():
        raise ValueError("some scored proposals have no label: every one needs Accepted = 0 or 1")
    return df


@dataclass
class EvaluationTables:
    pr_curve: DataFrame
    roc_curve: DataFrame
    average_precision: DataFrame
    roc_auc: DataFrame
    score_histogram: DataFrame
    lift_gain: DataFrame
    selected_deals: DataFrame


def evaluation_tables(df: DataFrame, id_col: str = "ProposalID") -> EvaluationTables:
    """Positive class = accepted, score = accept_prob."""
    keyed = df.withColumn("_tie", hash_key(F.col(id_col), "tie"))
    return EvaluationTables(
        pr_curve=curves.pr_curve(df, "accept_prob", "Accepted", 1),
        roc_curve=curves.roc_curve(df, "accept_prob", "Accepted", 1),
        average_precision=curves.average_precision(df, "accept_prob", "Accepted", 1),
        roc_auc=curves.roc_auc(df, "accept_prob", "Accepted", 1),
        score_histogram=curves.score_histogram(df, "accept_prob", "Accepted"),
        lift_gain=curves.lift_gain(keyed, id_col, "accept_prob", "Accepted", "_tie", 1),
        selected_deals=knapsack.selected_deals(df.where(F.col("selected").isNotNull()), id_col),
    )


def report_text(report: DataFrame) -> str:
    """Plain-text run report from the (section, metric, value) table: one
    small collect of a bounded table (a few dozen metric rows)."""
    rows = {(r["section"], r["metric"]): r["value"] for r in report.collect()}

    def g(s, m):
        return rows.get((s, m))

    def num(x):
        return "undefined" if x is None else f"{x:.4f}"

    # fixed values: the section headings of the text report
    out = ["=== Classifier (positive = Rejected) ==="]
    out.append(f"AUC: {num(g('classifier', 'auc'))}")
    out.append(f"PR-AUC: {num(g('classifier', 'pr_auc'))}")
    out.append(f"Best threshold (F1): {g('classifier', 'best_threshold'):.4f}, "
               f"Best F1: {g('classifier', 'best_f1'):.4f}")
    out.append("")
    for label in ("Accepted", "Rejected", "accuracy", "macro avg", "weighted avg"):
        vals = [g("classification_report", f"{label}:{m}") for m in ("precision", "recall", "f1_score", "support")]
        cells = ["" if v is None else (f"{v:.0f}" if i == 3 else f"{v:.3f}") for i, v in enumerate(vals)]
        out.append(f"{label:>12} " + " ".join(f"{c:>9}" for c in cells))
    out.append("")
    out.append("=== K-Means ===")
    k, sil = g("kmeans", "k"), g("kmeans", "silhouette")
    out.append(f"k: {int(k)}, silhouette: {sil:.4f}" if k else "Segmentation skipped or insufficient data")
    out.append("")
    out.append("=== Optimization ===")
    out.append(f"Total selected cost: {g('optimization', 'total_selected_cost') or 0:,.2f}")
    out.append(f"Total selected expected profit: {g('optimization', 'total_selected_profit') or 0:,.2f}")
    out.append(f"LP bound: {g('optimization', 'lp_bound') or 0:,.2f}, gap: {g('optimization', 'gap') or 0:,.2f}")
    return "\n".join(out) + "\n"
