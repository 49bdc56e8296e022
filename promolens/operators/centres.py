"""K-Means for several numbers of centres at once.

All centre sets (every k, from several starts) take their Lloyd step together: a
task sums its rows by (set, nearest centre), Spark adds the sums of the tasks, so a step is
one scan whatever the number of sets. The seeds are shared too: a start draws one sequence of
rows, each with a chance in proportion to its squared distance to those before
(the row with the least -ln(u) / d2, u from a hash of the id), and k centres begin at the first k.
The silhouette (squared Euclidean) of all k is one more scan over the
sizes, sums and squared norms of the segments.

What a task emits is one row per centre; what the driver holds does not grow with the rows.
A batch is kept column by column: distances are added up over whole columns, centre after centre, so
a step costs a few passes over numbers that lie side by side, and nothing is sorted to find a seed.
Steps and silhouettes read points: equal rows as one, with their number (behaviour features are those of the
customer, so all proposals of a customer are one point). Seeds are drawn among the rows, each by its own hash.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.session import reliable_checkpoint

log = logging.getLogger(__name__)


@dataclass
class Centres:
    """Fitted centres over ``columns``; of equally near centres the first one takes a row."""

    columns: list[str]
    centres: np.ndarray

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def sql(self) -> str:
        """The nearest centre of a row, as a SQL expression on the columns."""
        def far(c: np.ndarray) -> str:
            return " + ".join(f"(`{n}` - CAST('{float(v)!r}' AS DOUBLE)) * (`{n}` - CAST('{float(v)!r}' AS DOUBLE))" for n, v in zip(self.columns, c, strict=True))

        return "array_min(array(" + ", ".join(f"named_struct('far', {far(c)}, 'centre', {i})" for i, c in enumerate(self.centres)) + ")).centre"


@dataclass
class CentreFit:
    model: Centres
    cost: float               # summed squared distance to the nearest centre
    silhouette: float | None  # None where only one segment holds rows


def _points(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """(columns, rows)"""
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)])


def _squares(x: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Squared distance of each row to one point (the origin if none is given)."""
    out = np.zeros(x.shape[1])
    for i, column in enumerate(x):
        d = column - at[i] if at is not None else column.copy()
        d *= d
        out += d
    return out


def _far(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(centres, rows): squared distance of each row to each centre."""
    return np.stack([_squares(x, c) for c in centres])


def _nearest(far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row (of equally near ones the first) and its distance."""
    least, at = far[0].copy(), np.zeros(far.shape[1], np.int64)
    for j in range(1, len(far)):
        np.putmask(at, far[j] < least, j)
        np.minimum(least, far[j], out=least)
    return at, least


def _unit(h: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit hashes and a salt (SplitMix64's finaliser, fixed public constants)."""
    with np.errstate(over="ignore"):
        z = h.view(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def draw_seeds(rows: DataFrame, columns: list[str], n: int, starts: int, seed: int) -> np.ndarray:
    """(starts, n, columns): one scan a place in the sequences. ``rows`` holds the columns and a hash ``h``."""
    width, fields = len(columns), ", ".join(f"x{i} double" for i in range(len(columns)))
    found = np.zeros((starts, 0, width))
    for place in range(n):
        def best(batches: Iterator[pa.RecordBatch], have=found, place=place) -> Iterator[pa.RecordBatch]:
            top: dict[int, tuple] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, h = _points(batch, width), batch.column(width).to_numpy()
                for s in range(starts):
                    d2 = _far(x, have[s]).min(axis=0) if place else np.ones(len(h))
                    key = np.full(len(h), np.inf)  # a row on a seed is not drawn while there are others
                    np.divide(-np.log(_unit(h, (seed * starts + s) * n + place)), d2, out=key, where=d2 > 0)
                    least = np.flatnonzero(key == key.min())
                    i = int(least[h[least].argmin()])
                    row = (float(key[i]), int(h[i]), *map(float, x[:, i]))
                    top[s] = min(top.get(s, row), row)
            if top:
                cols = list(zip(*[(s, *row) for s, row in top.items()]))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()),
                                                  *[pa.array(c, pa.float64()) for c in cols[3:]]],
                                                 names=["s", "key", "h", *[f"x{i}" for i in range(width)]])

        xs = [f"x{i}" for i in range(width)]
        got = (rows.mapInArrow(best, f"s int, key double, h long, {fields}")
               .groupBy("s").agg(F.min(F.struct("key", "h", *xs)).alias("r")).select("s", *[f"r.{x}" for x in xs]).collect())  # a row a start
        new = np.array([list(r)[1:] for r in sorted(got)])
        found = np.concatenate([found, new[:, None, :]], axis=1)
    return found


def lloyd_step(rows: DataFrame, columns: list[str], sets: dict[int, np.ndarray]) -> dict[int, tuple]:
    """One scan: per set the (sizes, sums, squared norms, cost) of its centres' rows. ``rows`` holds the columns and
    how many rows are alike, ``w``."""
    width = len(columns)
    sums = [f"x{i}" for i in range(width)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {key: np.zeros((len(c), width + 3)) for key, c in sets.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _points(batch, width), batch.column(width).to_numpy()
            norm = _squares(x)
            for key, c in sets.items():
                at, least = _nearest(_far(x, c))
                for j, v in enumerate([None, norm, least, *x]):
                    held[key][:, j] += np.bincount(at, w if v is None else w * v, len(c))
        for key, h in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), key)), pa.array(np.arange(len(h))), *[pa.array(v) for v in h.T.copy()]],
                                             names=["key", "centre", "n", "sq", "cost", *sums])

    schema = ", ".join(["key long", "centre long", *[f"{c} double" for c in ["n", "sq", "cost", *sums]]])
    got = rows.mapInArrow(assign, schema).groupBy("key", "centre").agg(*[F.sum(c).alias(c) for c in ["n", "sq", "cost", *sums]]).collect()
    out = {key: np.zeros((len(c), width + 3)) for key, c in sets.items()}
    for r in got:  # a row a centre
        out[r["key"]][r["centre"]] = list(r)[2:]
    return {key: (h[:, 0], h[:, 3:], h[:, 1], float(h[:, 2].sum())) for key, h in out.items()}


def silhouettes(rows: DataFrame, columns: list[str], sets: dict[int, np.ndarray], stats: dict[int, tuple]) -> dict[int, float | None]:
    """Mean silhouette by squared Euclidean distance; one scan for all sets. A row alone in its segment counts 0."""
    width = len(columns)
    full = {key: np.flatnonzero(stats[key][0]) for key in sets}  # segments that hold rows
    some = {key: i for key, i in full.items() if len(i) > 1}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = dict.fromkeys(some, 0.0), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _points(batch, width), batch.column(width).to_numpy()
            n += int(w.sum())
            norm, i = _squares(x), np.arange(len(w))
            for key, used in some.items():
                size, sums, sq, _ = (v[used] if isinstance(v, np.ndarray) else v for v in stats[key])
                own = np.searchsorted(used, _nearest(_far(x, sets[key]))[0])
                mean = norm + (sq / size)[:, None] - 2 * ((sums / size[:, None]) @ x)  # to every segment's rows
                here = mean[own, i] * size[own] / np.maximum(size[own] - 1, 1)
                mean[own, i] = np.inf
                there = mean.min(axis=0)
                top = np.maximum(here, there)
                s = np.divide(there - here, top, out=np.zeros(len(w)), where=(size[own] > 1) & (top > 0))
                total[key] += float((s * w).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.float64()),
                                          pa.array([n] * len(total), pa.int64())], names=["key", "s", "n"])

    got = rows.mapInArrow(measure, "key long, s double, n long").groupBy("key").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect() if some else []
    return {key: None for key in sets} | {r["key"]: r["s"] / r["n"] for r in got}


def fit_centres(df: DataFrame, id_col: str, columns: list[str], ks, seed: int = 42, starts: int = 3, max_steps: int = 20,
                tol: float = 1e-4) -> dict[int, CentreFit]:
    """The best of ``starts`` fits for every k (least cost). ``df`` is read once for each of max(ks) seeds, its points
    once a step, once for the silhouettes: write it first. Values must not be NULL. A centre without rows stays where it is."""
    rows = df.select(*columns, F.xxhash64(id_col).alias("h"))
    points = reliable_checkpoint(df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("w")), spread=True)
    ks = list(ks)
    seeds = draw_seeds(rows, columns, max(ks), starts, seed)
    key = {(k, s): i for i, (k, s) in enumerate((k, s) for k in ks for s in range(starts))}
    sets = {i: seeds[s][:k] for (k, s), i in key.items()}
    moving, stats, steps = set(sets), {}, 0
    while moving:
        steps += 1
        got = lloyd_step(points, columns, {i: sets[i] for i in moving})
        for i, (size, sums, sq, cost) in got.items():
            stats[i] = (size, sums, sq, cost)
            new = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], sets[i])
            if ((new - sets[i]) ** 2).sum(axis=1).max() <= tol ** 2 or steps >= max_steps:
                moving.discard(i)  # its stats are those of the centres it keeps
            else:
                sets[i] = new
    log.info("centres: %d sets, %d steps", len(sets), steps)
    best = {k: min((key[k, s] for s in range(starts)), key=lambda i: (stats[i][3], i)) for k in ks}
    sil = silhouettes(points, columns, {i: sets[i] for i in best.values()}, {i: stats[i] for i in best.values()})
    return {k: CentreFit(Centres(list(columns), sets[i]), stats[i][3], sil[i]) for k, i in best.items()}
