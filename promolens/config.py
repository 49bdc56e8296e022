"""Parameters of the reports and of the proposal pipeline."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class ReportParams:
    """Scalar parameters of the promotion reports.

    ``from_date``/``to_date`` bound the order range (whole last day
    included), ``top_n`` is the per-month group limit, ``years`` the pivot
    columns of the yearly launch table and ``as_of`` replaces the wall clock
    in the recency metric so results are reproducible.
    """

    from_date: dt.date = dt.date(2011, 1, 1)
    to_date: dt.date = dt.date(2014, 12, 31)
    top_n: int = 5
    years: tuple[int, ...] = (2011, 2012, 2013, 2014)
    as_of: dt.date | None = None

    @staticmethod
    def for_range(from_date: dt.date, to_date: dt.date, **kw) -> "ReportParams":
        years = tuple(range(from_date.year, to_date.year + 1))
        return ReportParams(from_date=from_date, to_date=to_date, years=years, **kw)


# Parameters matching the driver test tables (orders span 1995-01 .. 2001-08).
FIXTURE_PARAMS = ReportParams.for_range(dt.date(1995, 1, 1), dt.date(2001, 12, 31),
                                        as_of=dt.date(2001, 12, 31))


@dataclass(frozen=True)
class PipelineConfig:
    """Job parameters of the proposal pipeline.

    Fixed values of the reference job: budget 500 000, 500 boosting rounds
    with learning rate 0.05, 64 leaves, at least 20 rows per leaf, row and
    column subsampling 0.8, seed 42, negatives sampled 1:5, segmentation
    k = 2..7. A classifier is fitted on all rows of the balanced sample,
    segmentation and selection use every row. The cap of the selection's
    candidates that a single machine needs, ``opt_top_n``, is an option and off.
    """

    budget: float = 500_000.0
    skip_kmeans: bool = False
    opt_top_n: int | None = None
    optimal: bool = False  # select by branch and bound (no candidate cap) instead of the ranked walk
    model: str = "gbt"  # "gbt" or "rf"
    oversample: bool = False
    seed: int = 42
    neg_ratio: int = 5
    test_fraction: float = 0.2
    gbt_max_iter: int = 500
    gbt_step_size: float = 0.05
    num_leaves: int = 64
    min_instances_per_node: int = 20
    subsampling_rate: float = 0.8
    column_share: float = 0.8
    rf_num_trees: int = 100
    rf_max_depth: int = 10
    kmeans_k: tuple[int, ...] = (2, 3, 4, 5, 6, 7)
    segment_features: tuple[str, ...] = ("Purchases", "AvgOrderValue", "PromoResponseRate", "Recency")
    out_dir: str | None = None
    output_format: str = "parquet"  # or "csv" (header line, one part file per task)
