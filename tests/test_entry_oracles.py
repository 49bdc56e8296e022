"""Driver contract and oracle agreement on the smallest scale factor."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def entry_mod():
    import __spark_entry__ as E
    return E


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_runs(spark, entry_mod):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "RevenueShare" in df.columns


def test_every_oracle_has_a_query(entry_mod):
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    if hasattr(a, "isoformat") and hasattr(b, "isoformat"):
        return a.isoformat() == b.isoformat()
    return a == b


FAST = ["promotions_by_year_month", "promotions_year_pivot", "revenue_by_promo_flag", "profit_by_promo_flag",
        "margin_pct_by_promo_flag", "top_promo_products", "yearly_promo_split", "product_completeness",
        "revenue_by_category", "line_items_by_category", "top_order_lines", "line_base", "line_base_by_month", "order_promo_flag",
        "promotions_launched", "active_promotions_by_month", "monthly_promo_sales", "monthly_promo_orders",
        "top_groups_by_month", "customer_metrics", "proposals", "coerced_amounts", "proposal_features",
        "winsorized_features", "roc_auc", "average_precision", "best_f1_threshold", "classification_report",
        "pr_curve", "roc_curve", "score_histogram", "lift_gain", "budget_selection", "selection_totals",
        "balanced_sample", "stratified_split", "oversampled_train", "class_weights", "segment_inputs",
        "table_listing", "coercion_missing_counts", "selected_deals", "top_candidates", "pr_curve_text_scores",
        "catalog_listing"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, entry_mod, con, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    drows = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert len(srows) == len(drows)
    key = lambda r: tuple("" if r[c] is None else str(r[c]) for c in sorted(cols))
    for a, b in zip(sorted(srows, key=key), sorted(drows, key=key)):
        for c in cols:
            assert _close(a[c], b[c]), (name, c, a[c], b[c])
