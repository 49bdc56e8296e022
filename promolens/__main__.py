"""Command line entry for spark-submit.

    spark-submit --py-files promolens.zip promolens/__main__.py pipeline --data proposals.csv --budget 500000 --out /shared/out
    spark-submit --py-files promolens.zip promolens/__main__.py evaluate --proposals p.csv --scores /shared/out/proposal_accept_scores \
        --selection /shared/out/proposal_selection --outdir /shared/eval
    spark-submit --py-files promolens.zip promolens/__main__.py score --data new.csv --model-dir /shared/out/proposal_model --out /shared/new
    spark-submit --py-files promolens.zip promolens/__main__.py extract --tables /shared/sales --as-of 2014-12-31 --out /shared/extract
    spark-submit --py-files promolens.zip promolens/__main__.py reports --tables /shared/sales --out /shared/reports
    spark-submit --py-files promolens.zip promolens/__main__.py sql --tables /shared/sales --out /shared/top \
        --query "SELECT * FROM promo_top_groups(DATE'2013-01-01', DATE'2013-12-31', 3)"

Options mirror the reference command line; outputs go to shared storage.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from promolens.config import PipelineConfig, ReportParams
from promolens.session import build_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="promolens")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("pipeline", help="features -> classifier -> segments -> selection -> outputs")
    p.add_argument("--data", required=True, help="proposals CSV (or Parquet folder)")
    p.add_argument("--budget", type=float, default=500000.0)
    p.add_argument("--out", default="out")
    p.add_argument("--skip-kmeans", action="store_true")
    p.add_argument("--opt-top-n", type=int, default=None, help="optional cap on selection candidates")
    p.add_argument("--optimal", action="store_true", help="optimal selection over all candidates")
    p.add_argument("--model", choices=["rf", "gbt", "lightgbm"], default="gbt")
    p.add_argument("--oversample", action="store_true")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet", help="output table format")

    e = sub.add_parser("evaluate", help="curve, histogram, lift/gain and selection tables")
    e.add_argument("--proposals", required=True)
    e.add_argument("--scores", required=True)
    e.add_argument("--selection", required=True)
    e.add_argument("--outdir", default="out_eval")

    c = sub.add_parser("score", help="scores and segments of new proposals with the model that a pipeline run saved")
    c.add_argument("--data", required=True, help="proposals CSV (or Parquet folder)")
    c.add_argument("--model-dir", required=True, help="the proposal_model folder of a run")
    c.add_argument("--out", default="out_score")

    x = sub.add_parser("extract", help="customer metrics and the labelled proposals from the sales tables")
    x.add_argument("--as-of", default=None, help="day that recency counts to (default: today)")
    x.add_argument("--out", default="out_extract")
    x.add_argument("--format", choices=["parquet", "csv"], default="csv", help="output table format")

    r = sub.add_parser("reports", help="promotion reports over the sales tables")
    q = sub.add_parser("sql", help="one SQL statement over the tables and the report functions (promo_sales(from, to), ...)")
    q.add_argument("--query", required=True)
    q.add_argument("--out", default="out_sql")
    for cmd in (x, r, q):
        cmd.add_argument("--tables", default=None, help="Parquet root with one folder per table (default: catalog)")
        cmd.add_argument("--namespace", default=None)
    r.add_argument("--from-date", default="2011-01-01")
    r.add_argument("--to-date", default="2014-12-31")
    r.add_argument("--store", default=None, help="folder that keeps the report lines by month; only changed months are rebuilt")
    r.add_argument("--top-n", type=int, default=5)
    r.add_argument("--out", default="out_reports")

    args = ap.parse_args(argv)
    spark = build_session()
    from promolens.sources.csv import read_table

    if args.cmd == "pipeline":
        from promolens.plans.evaluation import report_text
        from promolens.plans.job import run_pipeline

        cfg = PipelineConfig(budget=args.budget, skip_kmeans=args.skip_kmeans, opt_top_n=args.opt_top_n, optimal=args.optimal,
                             model=args.model, oversample=args.oversample, out_dir=args.out,
                             output_format=args.format)
        out = run_pipeline(read_table(spark, args.data), cfg)
        print(report_text(out.report))
    elif args.cmd == "evaluate":
        from promolens.plans.evaluation import evaluation_frame, evaluation_tables

        df = evaluation_frame(read_table(spark, args.proposals), read_table(spark, args.scores),
                              read_table(spark, args.selection))
        tabs = evaluation_tables(df)
        for name in ("pr_curve", "roc_curve", "average_precision", "roc_auc", "score_histogram", "lift_gain",
                     "selected_deals"):
            getattr(tabs, name).write.mode("overwrite").parquet(os.path.join(args.outdir, name))
    elif args.cmd == "score":
        from pyspark.ml import PipelineModel

        from promolens.plans.features import add_features
        from promolens.plans.saved import score

        score(add_features(read_table(spark, args.data)), PipelineModel.load(args.model_dir)).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "extract":
        from promolens.plans.proposals import customer_metrics, proposals
        from promolens.sources.tables import SalesTables

        t = SalesTables.from_parquet(spark, args.tables) if args.tables else \
            SalesTables.from_catalog(spark, args.namespace)
        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
        for name, df in (("customer_metrics", customer_metrics(t, as_of)), ("proposals", proposals(t, as_of, extra_columns=True))):
            w = df.write.mode("overwrite").option("header", True)
            (w.csv if args.format == "csv" else w.parquet)(os.path.join(args.out, name))
    elif args.cmd == "sql":
        from promolens.plans import sql_surface
        from promolens.sources.tables import SalesTables

        sql_surface.register(SalesTables.from_parquet(spark, args.tables) if args.tables else SalesTables.from_catalog(spark, args.namespace))
        spark.sql(args.query).write.mode("overwrite").parquet(args.out)
    else:
        from promolens.plans import monthly, monthly_store, reports
        from promolens.sources.tables import SalesTables

        t = SalesTables.from_parquet(spark, args.tables) if args.tables else \
            SalesTables.from_catalog(spark, args.namespace)
        params = ReportParams.for_range(dt.date.fromisoformat(args.from_date), dt.date.fromisoformat(args.to_date),
                                        top_n=args.top_n)
        outs = {
            "promotions_by_year_month": reports.promotions_by_year_month(t),
            "promotions_year_pivot": reports.promotions_year_pivot(t, params),
            "revenue_by_promo_flag": reports.revenue_by_promo_flag(t),
            "profit_by_promo_flag": reports.profit_by_promo_flag(t),
            "margin_pct_by_promo_flag": reports.margin_pct_by_promo_flag(t),
            "top_promo_products": reports.top_promo_products(t),
            "yearly_promo_split": reports.yearly_promo_split(t),
            "product_completeness": reports.product_completeness(t),
            "revenue_by_category": reports.revenue_by_category(t),
            "line_items_by_category": reports.line_items_by_category(t),
            "top_order_lines": reports.top_order_lines(t),
        }
        lb = None
        if args.store:
            monthly_store.refresh(t, params, args.store)
            lb = monthly_store.load(t, params, args.store)
        outs.update(monthly.monthly_reports(t, params, lb))
        for name, df in outs.items():
            df.write.mode("overwrite").parquet(os.path.join(args.out, name))


if __name__ == "__main__":
    main()
