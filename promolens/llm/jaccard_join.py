"""Similarity join of documents on the Jaccard index of their word shingles.

1. Texts with one and the same set are one representative.
2. Two sets of index >= t share one of the first ``n - ceil(t n) + 1``
   elements of each, in any order common to all. The order puts shingles of
   crowded cells of a count sketch last, so common passages rarely decide.
3. Representatives that share such an element and whose sizes lie in one
   band (no gap wider than t) form a tile; a tile above ``TILE`` members is
   split into pairs of blocks. In a tile, hashed bitmaps bound the overlap
   from above: every bit of one set that the other lacks is an element less.
   Pairs within the bound make candidate groups.
4. Within a candidate group sorted arrays are intersected exactly, each pair
   until both sides are known to be connected. Pairs are not emitted: a tile
   returns a spanning forest of its links.

Links decide the components, so a link inside a component need not be seen
twice; none between two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import connected_components, discard, numbered, renamed, shuffle_partitions, slices, staged
from promolens.llm.token_index import mix64
from promolens.llm.words import shingle_sets, shingles, words

_U = np.uint64
CELLS = 1 << 20
SPLIT = 1 << 13
TILE = 4096


def crowded_cells(docs: DataFrame, size: int, extra: int = 128) -> np.ndarray:
    """Packed bits of the sketch cells that hold far more shingles than the
    mean (by eight standard deviations and ``extra``). Counts cover every
    text; the result has ``CELLS`` bits whatever the input. It only orders
    elements: any bits give the same links."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size_held = np.zeros(CELLS, np.int64), [], 0
        for part in slices(batches, "text"):
            h, _ = words(part.column("text"), True)
            held.append((shingles(h, size) % _U(CELLS)).astype(np.int32))
            size_held += len(held[-1])
            if size_held > CELLS:
                total += np.bincount(np.concatenate(held), minlength=CELLS)
                held, size_held = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=CELLS)
        if total.any():
            blocks = [total[i: i + SPLIT].tobytes() for i in range(0, CELLS, SPLIT)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "cells"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SPLIT, np.int64)
        for b in table.column("cells"):
            total += np.frombuffer(b.as_buffer(), np.int64)
        return pa.table({"block": [table.column("block")[0].as_py()], "cells": [total.tobytes()]})

    kind = "block long, cells binary"
    rows = docs.mapInArrow(count, kind).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(256)))
    rows = rows.groupBy("block", "salt").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind).collect()  # CELLS counts at most
    total = np.zeros(CELLS, np.int64)
    for r in rows:
        total[r["block"] * SPLIT: (r["block"] + 1) * SPLIT] = np.frombuffer(r["cells"], np.int64)
    mean = total.mean()
    return np.packbits(total > mean + 8 * np.sqrt(mean) + extra)


def least_overlap(n: np.ndarray | int, num: int, den: int):
    """ceil(num n / den): what a set of n shares at least with a similar one."""
    return -(-(num * n) // den)


def bitmap(elements: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, bool)
    out[(mix64(elements) % _U(bits)).astype(np.int64)] = True
    return np.packbits(out)


def bits_for(n: int, per: int = 1) -> int:
    """Bitmap width of a band of sizes, a power of two; sizes that can be
    similar differ by one step at most and are folded to the smaller width."""
    return max(64, 1 << max(0, int(per * n - 1).bit_length()))


class Forest:
    """Links of numbered items with the smallest item as root."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, i: int, j: int) -> None:
        a, b = self.root[i], self.root[j]
        if a != b:
            self.root[self.root == max(a, b)] = min(a, b)
            self.links.append((i, j))


def link_tile(sizes: np.ndarray, maps: list[np.ndarray], num: int, den: int, same=None, sides=None) -> list[tuple[int, int]]:
    """Spanning links of the items (sorted by size) whose bitmaps allow the
    threshold and, with ``same(i, js)``, whose exact overlap reaches it.
    ``sides`` restricts the pairs to those between two different blocks."""
    forest, n = Forest(len(sizes)), len(sizes)
    widths = np.array([len(m) for m in maps])
    rows: dict[int, np.ndarray] = {}
    for w in np.unique(widths).tolist():  # all maps that can be compared at width w, folded to it
        rows[w] = np.zeros((n, w), np.uint8)
        for i in np.flatnonzero(widths >= w).tolist():
            m = maps[i]
            rows[w][i] = m if len(m) == w else np.bitwise_or.reduce(m.reshape(-1, w), axis=0)
    for i in range(n - 1):
        hi = int(np.searchsorted(sizes, sizes[i] * den // num, "right"))
        js = np.arange(i + 1, hi)
        js = js[forest.root[js] != forest.root[i]]
        if sides is not None:
            js = js[sides[js] != sides[i]]
        if not len(js):
            continue
        for chunk in np.array_split(js, -(-len(js) // 8192)):
            w = int(widths[i])
            mine, theirs = rows[w][i], rows[w][chunk]
            # 100 * o >= num * (x + y - o)  <=>  o >= num (x + y) / (den + num)
            need = -(-(num * (sizes[i] + sizes[chunk])) // (den + num))
            most = np.minimum(sizes[i] - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64),
                              sizes[chunk] - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))
            for j in chunk[most >= need].tolist():
                if forest.root[i] != forest.root[j] and (same is None or same(i, j)):
                    forest.join(i, j)
    return forest.links


def _signatures(docs: DataFrame, size: int, num: int, den: int, crowded: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(crowded)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(shared.value).astype(bool)
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), size)
            n, one, two, heads, maps = [], [], [], [], []
            for s in sets:
                n.append(len(s))
                one.append(int(mix64(s).sum(dtype=_U).view(np.int64)) if len(s) else 0)
                two.append(int(mix64(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).view(np.int64)) if len(s) else 0)
                late = last[(s % _U(CELLS)).astype(np.int64)]
                take = len(s) - least_overlap(len(s), num, den) + 1
                head = s[~late][:take]
                if len(head) < take:
                    head = np.concatenate([head, s[late][: take - len(head)]])
                heads.append(head.tobytes())
                maps.append(bitmap(s, bits_for(len(s))).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "k1", "k2")), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(heads, pa.binary()), pa.array(maps, pa.binary())],
                names=["doc_id", "k1", "k2", "n", "s1", "s2", "head", "map"])

    return docs.mapInArrow(sign, "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, head binary, map binary")


def _shared_heads(reps: DataFrame, num: int, den: int) -> DataFrame:
    """(tile, members, rid): size-banded groups that share a head element; a
    group found through several elements is one tile."""
    total = reps.agg(F.sum(F.length("head"))).first()[0] or 0
    buckets = max(shuffle_partitions(reps.sparkSession), -(-total // (8 << 20)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "head"):
            heads = part.column("head")
            counts = np.array([len(h.as_buffer()) // 8 for h in heads])
            elems = np.concatenate([np.frombuffer(h.as_buffer(), _U) for h in heads])
            rid = np.repeat(part.column("rid").to_numpy(), counts)
            n = np.repeat(part.column("n").to_numpy().astype(np.uint32), counts)
            to = (mix64(elems) % _U(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order])) + 1
            rows: list[list] = [[], [], [], []]
            for idx in np.split(order, cuts):
                for c, v in zip(rows, (int(to[idx[0]]), elems[idx].tobytes(), rid[idx].tobytes(), n[idx].tobytes()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *(pa.array(c, pa.binary()) for c in rows[1:])],
                                             names=["bucket", "elems", "rids", "ns"])

    def group(table: pa.Table) -> pa.Table:
        col = lambda c, kind: np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)])
        elems, rid, n = col("elems", _U), col("rids", np.int64), col("ns", np.uint32).astype(np.int64)
        order = np.lexsort((n, elems))
        elems, rid, n = elems[order], rid[order], n[order]
        new = np.ones(len(elems), bool)
        new[1:] = (elems[1:] != elems[:-1]) | (n[:-1] * den < num * n[1:])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(elems)))
        tile = np.add.reduceat(mix64(rid.view(_U)), first)
        keep = np.flatnonzero(count > 1)
        keep = keep[np.unique(tile[keep], return_index=True)[1]]
        at = np.repeat(first[keep] - np.concatenate([[0], np.cumsum(count[keep])[:-1]]).astype(np.int64), count[keep]) + np.arange(count[keep].sum())
        return pa.table({"tile": np.repeat(tile[keep], count[keep]).view(np.int64), "members": np.repeat(count[keep], count[keep]), "rid": rid[at]})

    return (reps.select("rid", "n", "head").mapInArrow(deal, "bucket long, elems binary, rids binary, ns binary")
            .groupBy("bucket").applyInArrow(group, "tile long, members long, rid long").dropDuplicates(["tile", "rid"]))


def _tiles(rows: DataFrame, group: str, members: str) -> DataFrame:
    """Rows dealt to tiles of bounded size: a group above ``TILE`` members is
    cut into blocks, and each pair of blocks is a tile (``near``, ``far``)."""
    blocks = F.ceil(F.col(members) / F.lit(TILE)).cast("long")
    rows = rows.withColumn("_b", blocks).withColumn("side", F.pmod(F.xxhash64("rid"), F.col("_b")))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)))
    return (rows.withColumn("near", F.least("side", "_o")).withColumn("far", F.greatest("side", "_o"))
            .withColumn("bin", F.xxhash64(group, "near", "far")).drop("_b", "_o"))


def _by_tile(table: pa.Table, group: str):
    """Row numbers of each (group, near, far), smallest sets first."""
    cols = [table.column(c).to_numpy() for c in ("n", "far", "near", group)]
    order = np.lexsort(cols)
    key = np.stack([c[order] for c in cols[1:]])
    yield from np.split(order, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1)


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": a[:, 0], "b": a[:, 1]})


def similar_pairs(docs: DataFrame, size: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(members, edges): members = doc_id, k1, k2, n, rid of every document
    (rid null without shingles); edges = links (a, b) of representatives that
    span every component. Input columns: doc_id, text."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"),
                       F.xxhash64("text", "doc_id", F.lit(2)).alias("k2"))
    signed = staged(_signatures(docs, size, num, den, crowded_cells(docs.select("text"), size)), "signed")
    # one row per set, then the payload of that row only
    sets = (signed.where("n > 0").groupBy("s1", "s2").agg(F.min(F.struct("k1", "k2")).alias("k"))
            .select("s1", "s2", "k.k1", "k.k2").withColumn("rid", F.monotonically_increasing_id()))
    sets = staged(sets, "sets")
    reps = signed.drop("doc_id", "s1", "s2").join(sets.drop("s1", "s2"), ["k1", "k2"]).dropDuplicates(["rid"])
    reps = staged(reps.select("rid", "n", "head", "map"), "reps")
    rows = _tiles(_shared_heads(reps, num, den), "tile", "members").join(reps.select("rid", "n", "map"), "rid")

    def candidates(table: pa.Table) -> pa.Table:
        rid, n, maps = table.column("rid").to_numpy(), table.column("n").to_numpy(), table.column("map")
        near, far, side, out = (table.column("near").to_numpy(), table.column("far").to_numpy(), table.column("side").to_numpy(), [])
        for idx in _by_tile(table, "tile"):
            sides = side[idx] if near[idx[0]] != far[idx[0]] else None
            held = [np.frombuffer(maps[i].as_buffer(), np.uint8) for i in idx.tolist()]
            out += [(rid[idx[i]], rid[idx[j]]) for i, j in link_tile(n[idx], held, num, den, sides=sides)]
        return _edges(out)

    bins = shuffle_partitions(spark) * 8
    cand = (rows.withColumn("bin", F.pmod("bin", F.lit(bins))).groupBy("bin").applyInArrow(candidates, "a long, b long"))
    groups = connected_components(cand)
    counts = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    chosen = groups.join(counts, "component").withColumnRenamed("node", "rid").join(sets.select("rid", "k1", "k2"), "rid")
    texts = _tiles(docs.select("k1", "k2", "text").join(chosen, ["k1", "k2"]).dropDuplicates(["rid"]).withColumn("n", F.length("text")),
                   "component", "members")

    def exact(table: pa.Table) -> pa.Table:
        rid = table.column("rid").to_numpy()
        near, far, side, out = (table.column("near").to_numpy(), table.column("far").to_numpy(), table.column("side").to_numpy(), [])
        for idx in _by_tile(table, "component"):
            sets_ = shingle_sets(table.column("text").take(pa.array(idx)).combine_chunks(), size)
            n = np.array([len(s) for s in sets_])
            order = np.argsort(n, kind="stable")
            sets_, n, own = [sets_[i] for i in order.tolist()], n[order], idx[order]

            def same(i: int, j: int) -> bool:
                both = len(np.intersect1d(sets_[i], sets_[j], assume_unique=True))
                return den * both >= num * (n[i] + n[j] - both)

            sides = side[own] if near[own[0]] != far[own[0]] else None
            held = [bitmap(s, bits_for(len(s), 4)) for s in sets_]
            out += [(rid[own[i]], rid[own[j]]) for i, j in link_tile(n, held, num, den, same, sides)]
        return _edges(out)

    bins = shuffle_partitions(spark) * 16
    edges = staged(texts.withColumn("bin", F.pmod("bin", F.lit(bins))).groupBy("bin").applyInArrow(exact, "a long, b long"), "links")
    members = signed.select("doc_id", "k1", "k2", "n", "s1", "s2").join(sets.select("s1", "s2", "rid"), ["s1", "s2"], "left")
    discard(reps)
    return members.withColumn("rid", F.when(F.col("n") > 0, F.col("rid"))), edges


def classes(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per document: (doc_id, n_shingles, component_id, k1, k2, class).

    Documents link when den * |intersection| >= num * |union| of their sets
    of distinct ``size``-word shingles (A-Z folded; fewer words: the sequence
    as one). ``component_id`` is the smallest doc_id reachable, itself
    included; ``class`` numbers the components whatever their ids (null without
    shingles). Null and blank texts have no shingle and stand alone; a null
    doc_id counts as none; repeated rows are rows of their own; (k1, k2) is
    a hash of (doc_id, text) that tells the rows apart."""
    members, edges = similar_pairs(docs, size, num, den)
    members = staged(members, "members")
    comp = connected_components(edges).withColumnRenamed("node", "rid")
    least = members.where("rid is not null").groupBy("rid").agg(F.min("doc_id").alias("least"))
    named = least.join(comp, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("rid", "component_id", F.col("component").alias("class"))
    return (members.join(named, "rid", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "k1", "k2", "class"))


def one_per_class(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the near duplicates: of each class the row with the
    smallest doc_id stays (of its rows with one id the smallest hash, of rows
    alike in both one). Documents without shingles all stay; other columns go
    along as they are."""
    found = staged(classes(docs, size, num, den), "classes")
    best = (found.where("class is not null").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("b"))
            .select("class", F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2")))
    drop = (found.where("class is not null").join(best, "class").where("k1 <> b1 or k2 <> b2").select("k1", "k2").distinct())
    again = (found.where("class is not null").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k1", "k2"))
    doc_id, plain = F.col("doc_id").cast("long"), numbered(docs)
    keyed = plain.withColumns({"__k1": F.xxhash64(F.lit(1), doc_id, "text"), "__k2": F.xxhash64("text", doc_id, F.lit(2))})
    on = ["__k1", "__k2"]
    drop, again = (t.withColumnsRenamed({"k1": "__k1", "k2": "__k2"}) for t in (drop, again))
    keyed = keyed.join(drop, on, "left_anti")
    repeated = keyed.join(again, on, "left_semi").dropDuplicates(["__k1", "__k2"])
    return renamed(keyed.join(again, on, "left_anti").select(plain.columns).unionByName(repeated.select(plain.columns)), docs)
