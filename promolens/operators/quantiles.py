"""Exact, interpolated quantiles with bounded memory.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which is unbounded for a global quantile over a large
table. Here each requested order statistic is found by histogram
refinement: one pass gets count, min and max per column; each further
pass splits the current value interval of every target rank into equal
width bins (``groupBy(target, bin)``, partial + final aggregation, at most
``bins`` rows per target reach the driver) and keeps the bin that holds
the rank. When a bin holds few rows they are brought back and ranked;
when all its rows share one value (a hot value) the answer is that value.
The result is exact whatever the skew, in a handful of scans of a narrow
projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.numeric import nan_inf_to_null
from promolens.session import reliable_checkpoint


def _order_statistics(df: DataFrame, cols: list[str], ranks: dict[str, list[int]],
                      counts: dict[str, int], mins: dict[str, float], maxs: dict[str, float],
                      bins: int, small: int) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank of each column (NULLs excluded)."""
    # target state: (col, rank) -> [lo, hi, below]; the rank lies among values in [lo, hi]
    state = {(c, r): [mins[c], maxs[c], 0] for c in cols for r in ranks[c]}
    found: dict[tuple[str, int], float] = {}
    for key, (lo, hi, _) in state.items():
        if lo == hi:
            found[key] = lo
    passes = 0
    while len(found) < len(state):
        passes += 1
        open_keys = [k for k in state if k not in found]
        # Targets of one column that share an interval share a bin pass.
        groups: dict[tuple[str, float, float], list[tuple[str, int]]] = {}
        for k in open_keys:
            lo, hi, _ = state[k]
            groups.setdefault((k[0], lo, hi), []).append(k)
        exprs = []
        for gi, (c, lo, hi) in enumerate(groups):
            v = F.col(c)
            b = _bin(v, lo, hi, bins)
            exprs.append(F.when((v >= F.lit(lo)) & (v <= F.lit(hi)),
                                F.struct(F.lit(gi).alias("g"), b.alias("b"), v.cast("double").alias("v"))))
        long = df.select(F.explode(F.array(*exprs)).alias("t")).where(F.col("t").isNotNull()).select("t.*")
        hist = {(r["g"], r["b"]): (r["n"], r["mn"], r["mx"]) for r in
                long.groupBy("g", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"),
                                           F.max("v").alias("mx")).collect()}
        need_values: dict[int, list[tuple[tuple[str, int], int]]] = {}
        for gi, (c, lo, hi) in enumerate(groups):
            for k in groups[(c, lo, hi)]:
                below = state[k][2]
                acc = below
                for b in range(bins):
                    n, mn, mx = hist.get((gi, b), (0, None, None))
                    if n and acc + n > k[1]:
                        if mn == mx:
                            found[k] = mn
                        elif n <= small:
                            need_values.setdefault(gi, []).append((k, b, acc))
                        else:
                            state[k] = [mn, mx, acc]
                        break
                    acc += n
        if need_values:
            # Few rows left: bring all small bins back in one job, sort, index.
            gl = list(groups)
            wanted = sorted({(gi, b) for gi, items in need_values.items() for _, b, _ in items})
            picks = []
            for gi, b in wanted:
                c, lo, hi = gl[gi]
                v = F.col(c)
                in_bin = (v >= F.lit(lo)) & (v <= F.lit(hi)) & (_bin(v, lo, hi, bins) == b)
                picks.append(F.when(in_bin, F.struct(F.lit(gi).alias("g"), F.lit(b).alias("b"),
                                                     v.cast("double").alias("v"))))
            got: dict[tuple[int, int], list[float]] = {}
            for r in (df.select(F.explode(F.array(*picks)).alias("t")).where(F.col("t").isNotNull())
                      .select("t.*").collect()):
                got.setdefault((r["g"], r["b"]), []).append(r["v"])
            for gi, items in need_values.items():
                for k, b, acc in items:
                    found[k] = sorted(got[(gi, b)])[k[1] - acc]
        if passes > 64:
            raise RuntimeError("quantile refinement did not converge")
    return found


def _bin(v: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin of v in [lo, hi], by halves so that no range is too wide for a double."""
    width = (hi / 2 - lo / 2) / bins
    if width <= 0:
        return F.lit(0)
    return F.least(F.floor((v / 2 - F.lit(lo / 2)) / F.lit(width)).cast("int"), F.lit(bins - 1))


def linear_positions(n: int, q: float) -> tuple[int, int, float]:
    """0-based ranks and weight of the 'linear' quantile method, with the
    same floating-point steps as the NumPy/pandas implementation."""
    vi = n * q + (1 + q * (-1)) - 1
    lo = math.floor(vi)
    if vi >= n - 1:
        return n - 1, n - 1, vi - lo
    if vi < 0:
        return 0, 0, vi - lo
    return lo, lo + 1, vi - lo


def lerp(a: float, b: float, t: float) -> float:
    """NumPy's monotone interpolation: from the nearer end point."""
    if t == 0:  # also where b - a is too large for a double
        return a
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], bins: int = 2048,
                    small: int = 50_000) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column (pandas' default
    method, bit for bit given the same order statistics), ignoring NULL,
    NaN and infinite values. Returns ``{col: [q(p) for p in probs]}``; None
    for a column without values."""
    # read by every refinement pass
    narrow = reliable_checkpoint(df.select(*[nan_inf_to_null(F.col(c).cast("double")).alias(c) for c in cols]))
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}")]
    row = narrow.agg(*aggs).first()
    counts = {c: row[f"n_{c}"] for c in cols}
    mins = {c: row[f"mn_{c}"] for c in cols}
    maxs = {c: row[f"mx_{c}"] for c in cols}
    ranks: dict[str, list[int]] = {}
    plan: dict[tuple[str, float], tuple[int, int, float]] = {}
    for c in cols:
        n = counts[c]
        rs: set[int] = set()
        for p in probs:
            if n == 0:
                continue
            lo, hi, t = linear_positions(n, p)
            plan[(c, p)] = (lo, hi, t)
            rs.update([lo, hi])
        ranks[c] = sorted(rs)
    stats = _order_statistics(narrow, [c for c in cols if counts[c]], ranks, counts, mins, maxs, bins, small)
    out: dict[str, list[float | None]] = {}
    for c in cols:
        vals: list[float | None] = []
        for p in probs:
            if counts[c] == 0:
                vals.append(None)
                continue
            lo, hi, t = plan[(c, p)]
            vals.append(lerp(stats[(c, lo)], stats[(c, hi)], t))
        out[c] = vals
    return out
