"""Near-duplicate vectors by product quantisation.

Vectors of one label that are equal component by component become one
representative with a weight. Unit vectors fall into inverted lists around
coarse centroids; a list entry holds the list, one code byte for each
subspace of its residual, and the residual's quantisation error. A query
vector probes every list whose border with its own list is near enough that
a link may cross it, sums table distances to the entries' codes, and keeps
entries whose distance less their error is within the link's radius: by the
triangle inequality that test loses nothing. The kept pairs get their exact
cosine in double precision.

Only the choice of lists is approximate. A link of radius r moves a vector
towards one border by about r / sqrt(d); borders within ``PROBE`` times that
are crossed, which leaves a miss per border of about 3e-5. Centroids and
codebooks are fitted on at most ``FIT_ROWS`` representatives (smallest hashes);
every vector is indexed and every vector is a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import connected_components, shuffle_partitions, staged
from promolens.llm.jaccard_join import Forest

FIT_ROWS = 32_768
PER_LIST = 256  # of the largest label
PROBE = 4.0
SUBSPACES = 8
CODES = 64
BLOCK = 2048


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's method from distinct rows; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


class Quantiser:
    """Coarse centroids and one codebook for each subspace of the residuals."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 7):
        self.coarse = kmeans(sample, lists, 8, seed)
        rest = sample - self.coarse[self.home(sample)]
        d = sample.shape[1]
        self.cuts = np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int)
        self.books = [kmeans(rest[:, a:b], CODES, 8, seed + 1 + i) for i, (a, b) in enumerate(zip(self.cuts, self.cuts[1:]))]
        gram = self.coarse @ self.coarse.T
        sq = np.diag(gram)
        self.apart = np.sqrt(np.maximum(sq[:, None] + sq[None] - 2 * gram, 1e-12))

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (self.coarse ** 2).sum(1) - 2 * (x @ self.coarse.T) + (x ** 2).sum(1)[:, None]

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.argmin((self.coarse ** 2).sum(1) - 2 * (x @ self.coarse.T), axis=1)

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest, codes = x - self.coarse[own], []
        near = np.empty_like(rest)
        for book, a, b in zip(self.books, self.cuts, self.cuts[1:]):
            code = np.argmin((book ** 2).sum(1) - 2 * (rest[:, a:b] @ book.T), axis=1)
            near[:, a:b] = book[code]
            codes.append(code)
        return np.stack(codes, 1).astype(np.uint8), np.sqrt(((rest - near) ** 2).sum(1))

    def probes(self, x: np.ndarray, radius: float) -> list[np.ndarray]:
        """Own list first, then each list whose border lies within reach."""
        dist, reach = self.distances(x), PROBE * radius / math.sqrt(x.shape[1])
        own = np.argmin(dist, axis=1)
        border = (dist - dist[np.arange(len(x)), own][:, None]) / (2 * self.apart[own])
        return [np.concatenate([[o], np.flatnonzero((b <= reach) & (np.arange(len(b)) != o))]) for o, b in zip(own, border)]

    def tables(self, rest: np.ndarray) -> np.ndarray:
        """Squared distances of residuals to every code: (rows, subspaces, codes)."""
        out = np.full((len(rest), len(self.books), CODES), np.inf)
        for s, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            out[:, s, : len(book)] = ((book ** 2).sum(1) - 2 * (rest[:, a:b] @ book.T) + (rest[:, a:b] ** 2).sum(1)[:, None])
        return np.maximum(out, 0)


def _unit(arr: pa.Array) -> np.ndarray:
    x = np.array(arr.to_pylist(), float)
    return x / np.sqrt((x * x).sum(1))[:, None]


_ENTRY = "label long, cell long, rid long, n long, home long, vec array<double>, codes binary, error double, probes array<long>, query boolean"


def links(reps: DataFrame, model: Quantiser, least: float) -> tuple[DataFrame, DataFrame]:
    """(degrees, edges) among representatives ``rid, label, vec, n``: how many
    vectors each links to (weights counted, found from either side), and
    links that span the components."""
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(model)
    radius = math.sqrt(max(0.0, 2 - 2 * least))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = _unit(part.column("vec"))
                probes = q.probes(x, radius)
                own = np.array([p[0] for p in probes])
                codes, error = q.encode(x, own)
                rows: dict[str, list] = {f.split()[0]: [] for f in _ENTRY.split(", ")}
                for i, (rid, label, n) in enumerate(zip(*(part.column(c).to_pylist() for c in ("rid", "label", "n")))):
                    for cell in [None, *probes[i].tolist()]:
                        entry = cell is None
                        for c, v in (("label", label), ("cell", int(own[i]) if entry else cell), ("rid", rid), ("n", n), ("home", int(own[i])),
                                     ("vec", x[i]), ("codes", codes[i].tobytes() if entry else None), ("error", error[i]),
                                     ("probes", probes[i] if entry else None), ("query", not entry)):
                            rows[c].append(v)
                yield pa.RecordBatch.from_arrays([pa.array(rows["label"], pa.int64()), pa.array(rows["cell"], pa.int64()), pa.array(rows["rid"], pa.int64()),
                                                  pa.array(rows["n"], pa.int64()), pa.array(rows["home"], pa.int64()),
                                                  pa.array(rows["vec"], pa.list_(pa.float64())), pa.array(rows["codes"], pa.binary()), pa.array(rows["error"], pa.float64()),
                                                  pa.array(rows["probes"], pa.list_(pa.int64())), pa.array(rows["query"], pa.bool_())], names=list(rows))

    def scan(table: pa.Table) -> pa.Table:
        q = shared.value
        cols = {c: table.column(c).to_numpy() for c in ("label", "cell", "tile", "side", "rid", "n", "home", "error")}
        query = np.array(table.column("query").to_pylist(), bool)
        vecs = np.stack(table.column("vec").to_numpy())
        found: dict[int, int] = {}
        spanning: list[tuple[int, int]] = []
        order = np.lexsort((cols["side"], cols["tile"], cols["cell"], cols["label"]))
        key = np.stack([cols[c][order] for c in ("label", "cell", "tile", "side")])
        for idx in np.split(order, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1):
            asks, has = idx[query[idx]], idx[~query[idx]]
            if not len(asks) or not len(has):
                continue
            codes = np.frombuffer(b"".join(table.column("codes")[i].as_py() for i in has.tolist()), np.uint8).reshape(len(has), -1)
            probes = [set(table.column("probes")[i].as_py()) for i in has.tolist()]
            ids, at = np.unique(np.concatenate([cols["rid"][asks], cols["rid"][has]]), return_inverse=True)
            forest = Forest(len(ids))
            for lo in range(0, len(asks), 256):
                some = asks[lo: lo + 256]
                tables = q.tables(vecs[some] - q.coarse[cols["cell"][some[0]]])
                dist = np.zeros((len(some), len(has)))
                for s in range(codes.shape[1]):
                    dist += tables[:, s, :][:, codes[:, s]]
                maybe = np.sqrt(dist) <= radius + cols["error"][has][None] + 1e-9
                for i, j in zip(*np.nonzero(maybe)):
                    a, b = some[i], has[j]
                    if cols["rid"][a] == cols["rid"][b] or float(vecs[a] @ vecs[b]) < least:
                        continue
                    found[cols["rid"][a]] = found.get(cols["rid"][a], 0) + int(cols["n"][b])
                    if int(cols["home"][a]) not in probes[j]:  # b does not ask here: count its side too
                        found[cols["rid"][b]] = found.get(cols["rid"][b], 0) + int(cols["n"][a])
                    forest.join(int(at[lo + i]), int(at[len(asks) + j]))
            spanning += [(int(ids[a]), int(ids[b])) for a, b in forest.links]
        rows = [(a, -1, n) for a, n in found.items()] + [(a, b, 0) for a, b in spanning]
        out = np.array(rows, np.int64).reshape(-1, 3)
        return pa.table({"a": out[:, 0], "b": out[:, 1], "n": out[:, 2]})

    rows = staged(reps.select("rid", "label", "vec", "n").mapInArrow(place, _ENTRY), "lists")
    sizes = rows.groupBy("label", "cell").agg(F.count(F.when(~F.col("query"), 1)).alias("entries"), F.count(F.when(F.col("query"), 1)).alias("asks"))
    # a list above BLOCK entries is cut into tiles, its queries into blocks; every block meets every tile
    rows = (rows.join(sizes, ["label", "cell"])
            .withColumn("tiles", F.greatest(F.lit(1), F.ceil(F.col("entries") / BLOCK)).cast("long"))
            .withColumn("sides", F.greatest(F.lit(1), F.ceil(F.col("asks") / BLOCK)).cast("long"))
            .withColumn("mine", F.pmod(F.xxhash64("rid"), F.when(F.col("query"), F.col("sides")).otherwise(F.col("tiles"))))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("query"), F.col("tiles")).otherwise(F.col("sides")) - 1)))
            .withColumn("tile", F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")))
            .withColumn("side", F.when(F.col("query"), F.col("mine")).otherwise(F.col("other")))
            .drop("entries", "asks", "tiles", "sides", "mine", "other"))
    bins = shuffle_partitions(spark) * 4
    out = staged(rows.withColumn("bin", F.pmod(F.xxhash64("label", "cell", "tile", "side"), F.lit(bins)))
                 .groupBy("bin").applyInArrow(scan, "a long, b long, n long"), "found")
    return out.where("b < 0").groupBy("a").agg(F.sum("n").alias("found")), out.where("b >= 0").select("a", "b")


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Per vector: (vec_id, n_links, component_id, kept).

    Vectors link when their labels are equal and not null and the cosine of
    their components in double precision is at least ``least``. Null, empty
    and zero vectors, and vectors with a null or non-finite component, link
    with nothing, and neither do vectors of different lengths; they are kept
    as they are. ``component_id`` is the smallest vec_id reachable. Rows
    that repeat a vec_id link like any other two; a null vec_id links and is
    linked, but names no component."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < F.lit(math.inf)) & ~F.isnan(v)) & F.exists("vec", lambda v: v != 0)
    vectors = vectors.withColumn("fine", F.coalesce(F.col("label").isNotNull() & fine, F.lit(False)))
    good = vectors.where("fine")
    reps = (good.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
            .withColumn("rid", F.monotonically_increasing_id()))
    reps = staged(reps, "vectors")
    members = staged(good.join(reps.select("label", "vec", "rid"), ["label", "vec"]).select("vec_id", "rid"), "members")
    parts = []
    for (width,) in reps.select(F.size("vec")).distinct().collect():  # a model for each length of vector
        own = reps.where(F.size("vec") == width)
        sample = own.orderBy(F.xxhash64("label", "vec"), "rid").limit(FIT_ROWS).select("vec").toArrow()
        # lists are kept by label: enough of them for the largest label
        largest = own.groupBy("label").count().agg(F.max("count")).first()[0]
        x = _unit(sample.column("vec"))
        parts.append(links(own, Quantiser(x, max(1, min(len(x) // 16, largest // PER_LIST))), least))
    if not parts:
        alone = vectors
    else:
        degrees, edges = parts[0]
        for d, e in parts[1:]:
            degrees, edges = degrees.unionByName(d), edges.unionByName(e)
        comp = connected_components(edges).withColumnRenamed("node", "rid")
        named = (reps.select("rid", "n", "first").join(comp, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
                 .join(degrees.withColumnRenamed("a", "rid"), "rid", "left"))
        ids = named.groupBy("component").agg(F.min("first").alias("component_id"))
        named = named.join(ids, "component").select("rid", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
        linked = members.join(named, "rid").select("vec_id", "n_links", "component_id")
        alone = vectors.where(~F.col("fine"))
    rest = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(rest) if parts else rest
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
