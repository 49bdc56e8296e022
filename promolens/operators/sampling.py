"""Exact-size, reproducible sampling by hash order.

"The q rows of group g with the smallest md5 key" is a sample without
replacement that any engine can re-derive. It is found without sorting a
group in one task: the md5 hex digits are uniform, so counting rows per
(group, first 3 hex digits) splits every group into 4096 even buckets
whatever its size; the bucket that holds the q-th row is refined on the
next 3 digits, and so on, until a bucket is small enough to rank. Each
level is one partial + final aggregation whose output is bounded by
groups x 4096 rows. The result is a per-group threshold key, applied as
a plain filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.hashing import hash_hex

DIGITS = 3
SMALL = 50_000


def _kth_smallest(df: DataFrame, key: str, group: str, quotas: dict) -> dict:
    """Per group, the quota-th smallest value of the 32-hex ``key``."""
    out: dict = {}
    # state per group: (prefix so far, rows before this prefix)
    state = {g: ("", 0) for g, q in quotas.items() if q > 0}
    while state:
        level_groups = list(state.items())
        conds = [(F.col(group) == F.lit(g)) & F.col(key).startswith(p) for g, (p, _) in level_groups]
        depth = {g: len(p) for g, (p, _) in level_groups}
        # all open groups are at the same depth (they advance together)
        d = max(depth.values())
        rows = (df.where(F.coalesce(*[F.when(c, F.lit(True)) for c in conds], F.lit(False)))
                .groupBy(F.col(group).alias("g"), F.substring(F.col(key), d + 1, DIGITS).alias("b"))
                .agg(F.count(F.lit(1)).alias("n")).collect())
        by_group: dict = {}
        for r in rows:
            by_group.setdefault(r["g"], []).append((r["b"], r["n"]))
        nxt = {}
        for g, (p, before) in level_groups:
            q = quotas[g]
            acc = before
            for b, n in sorted(by_group.get(g, [])):
                if acc + n >= q:
                    if len(p + b) >= 32:  # whole key fixed: every row of the bucket has this key
                        out[g] = p + b
                    elif n <= SMALL:
                        keys = sorted(r[0] for r in df.where((F.col(group) == F.lit(g))
                                                              & F.col(key).startswith(p + b))
                                      .select(key).collect())
                        out[g] = keys[q - acc - 1]
                    else:
                        nxt[g] = (p + b, acc)
                    break
                acc += n
        state = nxt
    return out


def smallest_by_hash(df: DataFrame, group: str, quotas: dict, id_col: str, seed, flag: str = "_in") -> DataFrame:
    """Add a boolean ``flag``: the row is among the ``quotas[g]`` smallest
    md5('<seed>|<id>') keys of its group (all rows when the quota covers
    the group). ``quotas`` maps group value -> (quota, group size)."""
    keyed = df.withColumn("_h", hash_hex(F.col(id_col), seed))
    need = {g: q for g, (q, n) in quotas.items() if 0 < q < n}
    thr = _kth_smallest(keyed, "_h", group, need) if need else {}
    cond: Column = F.lit(False)
    for g, (q, n) in quotas.items():
        if q >= n:
            cond = cond | (F.col(group) == F.lit(g))
        elif q > 0:
            cond = cond | ((F.col(group) == F.lit(g)) & (F.col("_h") <= F.lit(thr[g])))
    return keyed.withColumn(flag, cond).drop("_h")


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per label value (a partial + final aggregate, tiny result)."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def balanced_sample(df: DataFrame, label: str, id_col: str, neg_ratio: int = 5, seed=42,
                    cap: int | None = None) -> DataFrame:
    """All positive rows plus min(n_neg, neg_ratio x n_pos) negatives by
    hash order; optional cap on the total, again by hash order. Raises
    when there is no positive row."""
    counts = class_counts(df, label)
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    if n_pos == 0:
        raise ValueError("a rejection model needs at least one rejected proposal")
    quotas = {1: (n_pos, n_pos), 0: (min(n_neg, n_pos * neg_ratio), n_neg)}
    s = smallest_by_hash(df, label, quotas, id_col, seed).where(F.col("_in")).drop("_in")
    if cap is not None and n_pos + quotas[0][0] > cap:
        s = (smallest_by_hash(s.withColumn("_all", F.lit(0)), "_all", {0: (cap, n_pos + quotas[0][0])}, id_col,
                              f"{seed}-cap").where(F.col("_in")).drop("_in", "_all"))
    return s


def test_allocation(counts: dict, test_fraction: float) -> dict:
    """Test rows per class: ceil(fraction x n) in total, split in
    proportion to the classes, remainders to the largest fractions
    (class order breaks ties)."""
    n = sum(counts.values())
    n_test = math.ceil(test_fraction * n)
    cont = {c: n_test * k / n for c, k in counts.items()}
    alloc = {c: math.floor(v) for c, v in cont.items()}
    rest = n_test - sum(alloc.values())
    for c in sorted(cont, key=lambda c: (-(cont[c] - alloc[c]), c))[:rest]:
        alloc[c] += 1
    return alloc


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2, seed="42-split",
                     counts: dict | None = None) -> DataFrame:
    """Exact per-class test quotas chosen by hash order; adds ``split``
    ('train' / 'test')."""
    counts = counts or class_counts(df, label)
    alloc = test_allocation(counts, test_fraction)
    quotas = {c: (alloc[c], counts[c]) for c in counts}
    s = smallest_by_hash(df, label, quotas, id_col, seed)
    return s.withColumn("split", F.when(F.col("_in"), F.lit("test")).otherwise(F.lit("train"))).drop("_in")


def oversample(df: DataFrame, label: str, id_col: str, seed="42-over") -> DataFrame:
    """Replicate the minority class to the majority's size: every minority
    row floor(n_maj / n_min) times, plus one more copy for the first
    (n_maj mod n_min) rows by hash order. Adds ``copy_no`` (1-based)."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df.withColumn("copy_no", F.lit(1))
    min_c, n_min = min(counts.items(), key=lambda kv: (kv[1], kv[0]))
    _, n_maj = max(counts.items(), key=lambda kv: (kv[1], -kv[0]))
    if n_min == n_maj:
        return df.withColumn("copy_no", F.lit(1))
    base, extra = divmod(n_maj, n_min)
    s = smallest_by_hash(df, label, {min_c: (extra, n_min)}, id_col, seed)
    copies = F.when(F.col(label) == F.lit(min_c),
                    F.lit(base) + F.when(F.col("_in"), 1).otherwise(0)).otherwise(F.lit(1))
    return s.withColumn("copy_no", F.explode(F.sequence(F.lit(1), copies))).drop("_in")


def balanced_weights(counts: dict) -> dict:
    """n / (k x n_c) per class."""
    n = sum(counts.values())
    k = len(counts)
    return {c: n / (k * m) for c, m in counts.items()}


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """(label, n_rows, weight) with balanced weights, from one aggregate."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    tot = g.agg(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k")).first()
    return g.withColumn("weight", F.lit(float(tot["n"] or 0)) / (F.lit(int(tot["k"] or 0)) * F.col("n_rows")).cast("double"))


def with_weights(df: DataFrame, label: str, counts: dict, out: str = "weight") -> DataFrame:
    w = balanced_weights(counts)
    m = F.create_map(*[x for c, v in w.items() for x in (F.lit(c), F.lit(float(v)))])
    return df.withColumn(out, F.element_at(m, F.col(label)))
