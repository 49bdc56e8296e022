"""Proposal cleaning and features.

Input columns arrive as text (a CSV read with an all-string schema) or
typed; either way the money columns go through ``coerce_numeric``.
Derived features exist only when their inputs do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.numeric import clip, coerce_numeric, lenient_number, safe_ratio
from promolens.operators.quantiles import exact_quantiles

# Fixed values of the reference job: the date, money and behaviour columns it
# looks for, the clipped columns, the quantiles, the candidate feature list in
# its order, the categorical and the required columns.
DATE_CANDIDATES = ("ProposalDate", "OrderDate", "Date")
DISCOUNT_CANDIDATES = ("DiscountRate", "UnitPriceDiscount")
NUMERIC_INPUTS = ("Purchases", "AvgOrderValue", "PromoResponseRate", "Recency")
CLIP_COLUMNS = ("ProposalAmount", "Cost", "margin", "margin_rate", "cost_rate", "log_amount", "log_cost")
CLIP_PROBS = (0.01, 0.99)
FEATURE_CANDIDATES = (
    "ProposalAmount", "Cost", "margin", "margin_rate", "cost_rate", "log_amount", "log_cost",
    "discount_rate", "month", "quarter", "Purchases", "AvgOrderValue", "PromoResponseRate", "Recency",
    "Region", "CustomerType", "ProductCategory",
)
CATEGORICAL = ("Region", "CustomerType", "ProductCategory")
CLASSIFIER_REQUIRED = ("ProposalID", "ProposalAmount", "Region", "CustomerType", "ProductCategory", "Accepted")


def require_columns(df: DataFrame, required, what: str) -> None:
    """Fail before any job runs when required columns are missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} needs columns that the input lacks: {', '.join(missing)}")


def coerce_amounts(df: DataFrame) -> DataFrame:
    """ProposalAmount and Cost through the dirty-number rule (negative ->
    NULL), and the first discount column there is as ``discount_rate``."""
    out = df
    for c in DISCOUNT_CANDIDATES:
        if c in out.columns:
            out = out.withColumn("discount_rate", coerce_numeric(F.col(c), floor_zero=True))
            break
    for c in ("ProposalAmount", "Cost"):
        if c in out.columns:
            out = out.withColumn(c, coerce_numeric(F.col(c), floor_zero=True))
    return out


def coercion_missing_counts(coerced: DataFrame) -> DataFrame:
    """Rows and missing values per coerced column, in one aggregate pass
    over the coerced frame: (column_name, rows, missing_or_invalid). The
    discount goes by the name of its input column."""
    cols = {c: c for c in ("ProposalAmount", "Cost") if c in coerced.columns}
    discount = [c for c in DISCOUNT_CANDIDATES if c in coerced.columns]
    if discount:
        cols[discount[0]] = "discount_rate"
    agg = coerced.agg(F.count(F.lit(1)).alias("_rows"),
                      *[F.count_if(F.col(at).isNull()).alias(c) for c, at in cols.items()])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("rows"), F.col(c).alias("missing_or_invalid"))
        for c in cols])).alias("s")).select("s.*")


def add_features(df: DataFrame) -> DataFrame:
    """Derived features: margin, ratios, logs, month/quarter of the first
    present date column, discount depth."""
    out = coerce_amounts(df)
    cols = set(out.columns)
    if {"ProposalAmount", "Cost"} <= cols:
        a, c = F.col("ProposalAmount"), F.col("Cost")
        out = out.withColumns({
            "margin": a - c,
            "margin_rate": safe_ratio(a - c, a),
            "cost_rate": safe_ratio(c, a),
            "log_amount": F.log1p(a),
            "log_cost": F.log1p(c),
        })
    for dc in DATE_CANDIDATES:
        if dc in cols:
            field = dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)[dc]
            ts = F.col(dc) if field in ("timestamp", "timestamp_ntz", "date") else F.try_to_timestamp(F.col(dc))
            out = out.withColumns({"month": F.month(ts), "quarter": F.quarter(ts)})
            break
    for c in NUMERIC_INPUTS:
        if c in cols:
            out = out.withColumn(c, lenient_number(F.col(c)))
    return out


def clip_bounds(df: DataFrame, cols=CLIP_COLUMNS, probs=CLIP_PROBS) -> dict[str, tuple[float | None, float | None]]:
    present = [c for c in cols if c in df.columns]
    q = exact_quantiles(df, present, list(probs))
    return {c: (q[c][0], q[c][1]) for c in present}


def winsorize(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Clip each column to its 1 %/99 % bounds; the clipped values flow on
    to scoring and selection. Bounds are literals in the plan."""
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in bounds.items()})


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    feats = [c for c in FEATURE_CANDIDATES if c in df.columns]
    cats = [c for c in CATEGORICAL if c in feats]
    nums = [c for c in feats if c not in cats]
    return cats, nums
