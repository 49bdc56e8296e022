"""Classifier evaluation as distributed tables.

Everything starts from ``(score, label)`` rows. Curves first collapse ties
(``groupBy(score)``: partial aggregation, one row per distinct score), then
accumulate true/false positives over the distinct scores in descending
order with ``running_sums``; no step moves the raw rows to one task.
Metrics come back as one-row DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.prefix import running_sums
from promolens.session import reliable_checkpoint

EPS = 1e-9  # fixed value of the reference: F1 and lift/gain denominators


def _pos(label: str, positive) -> Column:
    return F.when(F.col(label) == F.lit(positive), 1).otherwise(0)


def score_points(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """One row per distinct score: positives, negatives at that score and
    cumulated over all scores >= it (tp, fp), with class totals P, N."""
    # One row per distinct score, read by three jobs below: materialise once.
    # A row without a score (NULL or NaN) has no place on a curve.
    scored = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))
    g = reliable_checkpoint(scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(_pos(label, positive)).cast("bigint").alias("pos_at"),
        F.sum(1 - _pos(label, positive)).cast("bigint").alias("neg_at")))
    tot = g.agg(F.sum("pos_at").alias("P"), F.sum("neg_at").alias("N")).first()
    cum = running_sums(g, [F.desc("threshold")], {"tp": F.col("pos_at"), "fp": F.col("neg_at")}, prefix="")
    return cum.withColumns({"P": F.lit(int(tot["P"] or 0)).cast("bigint"),
                            "N": F.lit(int(tot["N"] or 0)).cast("bigint")})


def pr_curve(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """(threshold, precision, recall) for every distinct score, plus the
    end point (NULL, 1.0, 0.0)."""
    return _pr_from_points(score_points(df, score, label, positive))


def _pr_from_points(p: DataFrame) -> DataFrame:
    pts = p.select(
        "threshold",
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp").cast("double") / F.col("P").cast("double"))
        .alias("recall"))
    end = pts.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                           F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def roc_curve(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, plus the origin
    (NULL, 0.0, 0.0). Collinear points are kept."""
    p = score_points(df, score, label, positive)
    pts = p.select("threshold",
                   (F.col("fp").cast("double") / F.nullif(F.col("N"), F.lit(0)).cast("double")).alias("fpr"),
                   (F.col("tp").cast("double") / F.nullif(F.col("P"), F.lit(0)).cast("double")).alias("tpr"))
    origin = pts.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                              F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def roc_auc(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """Area under the ROC curve, ties counted half: sum over scores of
    positives x (2 x negatives below + negatives at), over 2PN, summed in
    exact integers (decimal(38,0)) and divided once; NULL when a class is
    missing, where the curve is not defined."""
    return _auc_from_points(score_points(df, score, label, positive))


def _auc_from_points(p: DataFrame) -> DataFrame:
    term = (F.col("pos_at").cast("decimal(38,0)")
            * (F.lit(2) * (F.col("N") - F.col("fp")) + F.col("neg_at")).cast("decimal(38,0)"))
    both = F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double")
    return p.agg(F.sum(term).alias("num"), F.first("P").alias("P"), F.first("N").alias("N")).select(
        (F.col("num").cast("double") / F.nullif(both, F.lit(0.0))).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """Sum over thresholds of (recall step) x precision, without
    interpolation; 0 without positives."""
    return _ap_from_points(score_points(df, score, label, positive))


def _ap_from_points(p: DataFrame) -> DataFrame:
    term = (F.col("pos_at").cast("double") / F.nullif(F.col("P"), F.lit(0)).cast("double")) * (
        F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double"))
    return p.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("average_precision"))


def f1_points(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    return _f1_from_points(score_points(df, score, label, positive))


def _f1_from_points(p: DataFrame) -> DataFrame:
    pr = _pr_from_points(p).where(F.col("threshold").isNotNull())
    f1 = (F.lit(2.0) * F.col("precision") * F.col("recall")) / (F.col("precision") + F.col("recall") + F.lit(EPS))
    return pr.withColumn("f1", f1)


def best_f1_threshold(df: DataFrame, score: str, label: str, positive=1) -> DataFrame:
    """Threshold with the highest F1 (the end point excluded); the lowest
    threshold wins a tie."""
    return _best_from_f1(_f1_from_points(score_points(df, score, label, positive)))


def _best_from_f1(f: DataFrame) -> DataFrame:
    return (f.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
            .select(F.col("threshold").alias("best_threshold"), F.col("f1").alias("best_f1"),
                    "precision", "recall"))


def binary_summary(df: DataFrame, score: str, label: str, positive=1) -> dict:
    """AUC, average precision and the best-F1 threshold from one pass of
    curve points (materialised once, read three times)."""
    p = reliable_checkpoint(score_points(df, score, label, positive))
    best = _best_from_f1(_f1_from_points(p)).first()
    return {
        "auc": _auc_from_points(p).first()["roc_auc"],
        "pr_auc": _ap_from_points(p).first()["average_precision"],
        "best_threshold": best["best_threshold"] if best else None,
        "best_f1": best["best_f1"] if best else None,
    }


def classification_report(df: DataFrame, score: str, label: str, threshold: Column | float,
                          positive=1, names: tuple[str, str] = ("Accepted", "Rejected")) -> DataFrame:
    """Per-class precision, recall, F1 and support at ``score >=
    threshold``, then accuracy, macro and weighted averages; a zero
    division gives 0. ``names`` = (negative class, positive class)."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    y = _pos(label, positive)
    pred = F.when(F.col(score) >= thr, 1).otherwise(0)
    c = df.agg(
        F.sum(y * pred).cast("bigint").alias("tp"), F.sum((1 - y) * pred).cast("bigint").alias("fp"),
        F.sum(y * (1 - pred)).cast("bigint").alias("fn"), F.sum((1 - y) * (1 - pred)).cast("bigint").alias("tn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))

    def f1(p: Column, r: Column) -> Column:
        return F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))

    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    m = c.select(
        "*",
        ratio(tn, tn + fn).alias("p0"), ratio(tn, tn + fp).alias("r0"),
        ratio(tp, tp + fp).alias("p1"), ratio(tp, tp + fn).alias("r1"),
        (tn + fp).alias("s0"), (tp + fn).alias("s1"), (tp + fp + fn + tn).alias("n"))
    m = m.withColumns({"f0": f1(F.col("p0"), F.col("r0")), "f1": f1(F.col("p1"), F.col("r1"))})
    s0, s1, n = F.col("s0"), F.col("s1"), F.col("n")

    def wavg(a: str, b: str) -> Column:
        return ratio(F.col(a) * s0.cast("double") + F.col(b) * s1.cast("double"), n)

    def row(name: str, p: Column, r: Column, f: Column, sup: Column) -> Column:
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), sup.alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row(names[0], F.col("p0"), F.col("r0"), F.col("f0"), s0),
        row(names[1], F.col("p1"), F.col("r1"), F.col("f1"), s1),
        row("accuracy", none, none, ratio(tp + tn, n), n),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
            (F.col("f0") + F.col("f1")) / 2, n),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), n),
    )
    return m.select(F.inline(rows))


def score_histogram(df: DataFrame, score: str, label: str, bins: int = 40,
                    classes: dict = None) -> DataFrame:
    """Equal-width histogram of the score per class over that class's own
    [min, max] (NumPy's binning: right edge closed in the last bin, the
    same edge fix-ups), every bin emitted, empty ones with 0.

    ``classes`` maps label value -> class name (default 1 -> 'Accepted',
    0 -> 'Rejected')."""
    classes = classes or {1: "Accepted", 0: "Rejected"}
    name = F.create_map(*[x for k, v in classes.items() for x in (F.lit(k), F.lit(v))])
    # narrow (class, score) rows are read twice (ranges, then bins): materialise once
    rows = reliable_checkpoint(df.where(F.col(label).isin(list(classes))).select(
        F.element_at(name, F.col(label)).alias("class_label"), F.col(score).cast("double").alias("x")))
    rng = rows.groupBy("class_label").agg(F.min("x").alias("mn0"), F.max("x").alias("mx0"))
    same = F.col("mn0") == F.col("mx0")
    rng = rng.select("class_label",
                     F.when(same, F.col("mn0") - 0.5).otherwise(F.col("mn0")).alias("first"),
                     F.when(same, F.col("mx0") + 0.5).otherwise(F.col("mx0")).alias("last"))
    rng = rng.withColumn("step", (F.col("last") - F.col("first")) / F.lit(float(bins)))

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.col("last")).otherwise(i.cast("double") * F.col("step") + F.col("first"))

    x = F.col("x")
    f = ((x - F.col("first")) / (F.col("last") - F.col("first"))) * F.lit(float(bins))
    i0 = f.cast("int")
    i1 = F.when(i0 == bins, i0 - 1).otherwise(i0)
    # class ranges: one row per class, a bounded broadcast
    b = rows.join(F.broadcast(rng), "class_label").withColumn("i1", i1)
    b = b.withColumn("i2", F.when(x < edge(F.col("i1")), F.col("i1") - 1).otherwise(F.col("i1")))
    b = b.withColumn("bin", F.when((x >= edge(F.col("i2") + 1)) & (F.col("i2") != bins - 1), F.col("i2") + 1)
                     .otherwise(F.col("i2")))
    counts = b.groupBy("class_label", "bin").agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select("class_label", "first", "last", "step",
                       F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    spine = spine.select("class_label", "bin", edge(F.col("bin")).alias("bin_lower"),
                         edge(F.col("bin") + 1).alias("bin_upper"))
    return (spine.join(counts, ["class_label", "bin"], "left")
            .select("class_label", "bin", "bin_lower", "bin_upper",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def lift_gain(df: DataFrame, id_col: str, score: str, label: str, tiebreak: str, positive=1) -> DataFrame:
    """Per row in descending score order (ties by the uniform ``tiebreak``
    hash): % of population, % of positives captured (gain) and lift."""
    # narrow rows read by the totals, the range bounds and the window
    base = reliable_checkpoint(df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score)))
                               .select(id_col, score, tiebreak, _pos(label, positive).alias("_y")))
    tot = base.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("P"))
    trow = tot.first()
    cum = running_sums(base, [F.desc(score), F.asc(tiebreak), F.asc(id_col)], {"i": F.lit(1), "cum_pos": F.col("_y")}, prefix="")
    n = F.lit(float(trow["n"]))
    P = F.lit(float(trow["P"] or 0))
    i = F.col("i").cast("double")
    cp = F.col("cum_pos").cast("double")
    return cum.select(
        id_col, score, F.col("i").alias("position"),
        ((i / n) * 100.0).alias("perc_population"),
        ((cp / (P + F.lit(EPS))) * 100.0).alias("gain"),
        ((cp / i) / (P / n + F.lit(EPS))).alias("lift"))
