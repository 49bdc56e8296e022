"""Customer segmentation with K-Means on behaviour features.

Preparation follows the reference guards, each returning a reason when
segmentation is skipped: missing columns, no usable value, all features
constant, fewer than 10 rows. Imputation (median), the variance filter and
standardisation (population std) are fitted on all rows with aggregates.
K-Means is fitted on all rows for k = 2..7 together (``operators.centres``) and scored by the silhouette of
all rows (first maximum); every row is assigned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.numeric import nan_inf_to_null
from promolens.operators.centres import Centres, fit_centres
from promolens.operators.quantiles import exact_quantiles
from promolens.session import reliable_checkpoint

MIN_ROWS = 10
MIN_VARIANCE = 1e-9  # fixed value of the reference


@dataclass
class SegmentInputs:
    frame: DataFrame | None     # id + z_<feature> columns
    features: list[str]
    n_rows: int
    reason: str | None          # why segmentation is skipped, else None
    z: list[Column] | None = None  # the standardised features as expressions on the raw columns
    z_sql: list[str] | None = None  # the same as SQL, for a saved model


def segment_inputs(df: DataFrame, feature_cols, id_col: str = "ProposalID") -> SegmentInputs:
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        return SegmentInputs(None, [], 0, f"missing cols: {missing}")
    # narrow (id, features) rows feed five aggregate passes and the final
    # assignment: materialise them once instead of re-running the upstream plan
    x = reliable_checkpoint(
        df.select(id_col, *[nan_inf_to_null(F.col(c).cast("double")).alias(c) for c in feature_cols]), spread=True)
    usable = x.agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.coalesce(*[F.col(c).isNotNull() for c in feature_cols], F.lit(False))).alias("u")
                   ).first()
    if not usable["u"]:
        return SegmentInputs(None, [], usable["n"], "no usable rows")
    med = exact_quantiles(x, list(feature_cols), [0.5])
    present = [c for c in feature_cols if med[c][0] is not None]  # all-missing columns are dropped
    filled = {c: F.coalesce(nan_inf_to_null(F.col(c).cast("double")), F.lit(med[c][0])) for c in present}
    imp = x.select(id_col, *[filled[c].alias(c) for c in present])
    stats = imp.agg(*[F.var_pop(c).alias(f"v_{c}") for c in present],
                    *[F.avg(c).alias(f"m_{c}") for c in present],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in present]).first()
    kept = [c for c in present if stats[f"v_{c}"] is not None and stats[f"v_{c}"] > MIN_VARIANCE]
    if not kept:
        return SegmentInputs(None, [], usable["n"], "all segmentation features have zero variance")
    if usable["n"] < MIN_ROWS:
        return SegmentInputs(None, kept, usable["n"], f"too few rows ({usable['n']}) for clustering")
    z = [((filled[c] - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"])).alias(f"z_{c}") for c in kept]
    z_sql = [f"(coalesce(CASE WHEN NOT isnan({d}) AND abs({d}) <> CAST('inf' AS DOUBLE) THEN {d} END, CAST('{med[c][0]!r}' AS DOUBLE))"
             f" - CAST('{stats[f'm_{c}']!r}' AS DOUBLE)) / CAST('{stats[f's_{c}']!r}' AS DOUBLE)"
             for c in kept for d in [f"CAST(`{c}` AS DOUBLE)"]]
    return SegmentInputs(x.select(id_col, *z), kept, usable["n"], None, z, z_sql)


@dataclass
class SegmentResult:
    segments: DataFrame | None   # id + segment
    k: int | None
    silhouette: float | None
    reason: str | None
    scores: list[tuple[int, float]]
    model: Centres | None = None
    inputs: SegmentInputs | None = None

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` (with the raw feature columns) and its ``segment``, NULL when
        segmentation was skipped; a projection, no join."""
        if self.model is None:
            return df.withColumn("segment", F.lit(None).cast("int"))
        return df.select("*", *self.inputs.z).select(*[F.col(f"`{c}`") for c in df.columns], F.expr(self.model.sql()).cast("int").alias("segment"))


def fit_segments(inputs: SegmentInputs, ks=(2, 3, 4, 5, 6, 7), seed: int = 42,
                 id_col: str = "ProposalID") -> SegmentResult:
    if inputs.reason:
        return SegmentResult(None, None, None, inputs.reason, [])
    zc = [f"z_{c}" for c in inputs.features]
    rows = reliable_checkpoint(inputs.frame.select(id_col, *zc), spread=True)  # read by every step
    fits = fit_centres(rows, id_col, zc, ks, seed)
    best = (None, -1.0, None)
    scores = []
    for k, f in fits.items():
        s = -1.0 if f.silhouette is None else f.silhouette
        scores.append((k, s))
        if best[0] is None or s > best[1]:
            best = (k, s, f.model)
    k, s, model = best
    seg = rows.select(id_col, F.expr(model.sql()).cast("int").alias("segment"))
    return SegmentResult(seg, k, s, None, scores, model, inputs)
