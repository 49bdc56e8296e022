"""Removal of passages that repeat word for word.

Every window of ``size`` consecutive words has a Rabin-Karp hash (two 64-bit
polynomials in the hashes of its words). A window that starts in two places
takes all its words away in both; overlapping windows merge into maximal
intervals.

Only windows that can repeat are shuffled: the smallest hash among the
8-word runs inside a window is the same in each of its copies, so a window
whose smallest run occurs once is counted as one without leaving its task.
Runs are counted in Spark and the repeated ones come back as a bit map of
fixed size; a bit set by chance only sends a window that did not have to go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import shuffle_partitions, slices
from promolens.llm.token_index import mix64
from promolens.llm.words import inverse, powers, shingles, words

_U = np.uint64
SIZE = 35
RUN = 8
MAP_BITS = 1 << 27
SLICE = 1 << 22
_BASES = (_U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB))


def window_hashes(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two Rabin-Karp hashes of every window over the word hashes ``h``."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, _U)
    out = []
    for base, v in zip(_BASES, (h, mix64(h ^ _U(0x8EBC6AF09C88C6E3))), strict=True):
        run = np.zeros(len(h) + 1, _U)
        np.cumsum(v * powers(len(h), base), out=run[1:])
        out.append(mix64((run[size:] - run[:n]) * powers(n, inverse(base))))
    return out[0], out[1]


def window_starts(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """For each of n windows over all texts on end: does it lie in one text?"""
    ok = np.zeros(max(n, 0), bool)
    first, last = at[:-1], at[1:] - size + 1
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b > a:
            ok[a:b] = True
    return ok


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (doubling, then one overlap)."""
    out, have = v, 1
    while 2 * have <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _smallest(h: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that lie in one text, hash of the smallest run in each window,
    hashes of all runs that are smallest in some window, once per place)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, bool), np.zeros(0, _U), np.zeros(0, _U)
    run = min(RUN, size)
    runs, wide = shingles(h, run), size - run + 1
    ok, low = window_starts(at, size, n), sliding_min(runs, wide)
    edge = np.full(wide - 1, ~_U(0), _U)
    around = np.concatenate([edge, np.where(ok, ~low, ~_U(0)), edge])
    return ok, low, runs[(runs == ~sliding_min(around, wide)) & (runs > 0)]


def _bit(runs: np.ndarray) -> np.ndarray:
    """Place of a run in the bit map (smallest hashes are small: mixed again)."""
    return (mix64(runs ^ _U(0x589965CC75374CC3)) % _U(MAP_BITS)).astype(np.int64)


def repeated_runs(docs: DataFrame, size: int) -> np.ndarray:
    """Packed bit map (``MAP_BITS`` bits, whatever the input) of the smallest
    runs that occur at two places or more, over every text."""
    buckets = 1 << (shuffle_partitions(docs.sparkSession) * 4 - 1).bit_length()
    buckets = min(buckets, MAP_BITS >> 10)
    share = MAP_BITS // buckets

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            runs = np.sort(_smallest(*words(part.column("text")), size)[2])
            third = np.zeros(len(runs), bool)
            third[2:] = (runs[2:] == runs[:-2])  # two places say as much as more
            runs = runs[~third]
            if len(runs):
                to = _bit(runs) // share
                order = np.argsort(to, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(to[order])) + 1)
                yield pa.RecordBatch.from_arrays([pa.array([int(to[x[0]]) for x in parts], pa.int64()),
                                                  pa.array([runs[x].tobytes() for x in parts], pa.binary())], names=["bucket", "runs"])

    def count(table: pa.Table) -> pa.Table:
        runs = np.sort(np.concatenate([np.frombuffer(b.as_buffer(), _U) for b in table.column("runs")]))
        bucket, mine = table.column("bucket")[0].as_py(), np.zeros(share, bool)
        mine[_bit(runs[1:][runs[1:] == runs[:-1]]) - bucket * share] = True
        return pa.table({"bucket": [bucket], "bits": [np.packbits(mine).tobytes()]})

    rows = (docs.select("text").mapInArrow(deal, "bucket long, runs binary").groupBy("bucket")
            .applyInArrow(count, "bucket long, bits binary").collect())  # MAP_BITS bits at most
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for r in rows:
        out[r["bucket"] * share // 8: (r["bucket"] + 1) * share // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


_WINDOWS = "bucket long, one binary, two binary, many binary, doc binary, pos binary, k1 binary, k2 binary"


def repeated_windows(docs: DataFrame, size: int) -> DataFrame:
    """(k1, k2, starts): where in a document repeated windows start, packed
    (uint32); several rows a document. ``docs``: k1, k2, text."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(repeated_runs(docs, size))
    buckets = shuffle_partitions(spark) * 4

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = bits.value
        for part in slices(batches, "text", SLICE):
            h, at = words(part.column("text"))
            ok, low, _ = _smallest(h, at, size)
            b = _bit(low)
            place = np.flatnonzero(ok & ((seen[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1).astype(bool))
            if not len(place):
                continue
            one, two = (x[place] for x in window_hashes(h, size))
            order = np.lexsort((two, one))
            same = np.zeros(len(order), bool)
            same[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            first = order[~same]
            many = np.diff(np.append(np.flatnonzero(~same), len(order))) > 1
            doc = np.searchsorted(at, place, "right") - 1
            pos = (place - at[doc]).astype(np.uint32)
            # copies of a window share its smallest run; neighbours mostly do, and so travel and return together
            to = (mix64(low[place[first]]) % _U(buckets)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            k1, k2 = part.column("k1").to_numpy(), part.column("k2").to_numpy()
            rows: list[list] = [[] for _ in range(8)]
            # known here to repeat: every place in the slice, under a bucket that only passes them on
            known = np.zeros(len(order), bool)
            known[order] = np.repeat(many, np.diff(np.append(np.flatnonzero(~same), len(order))))
            groups = [(int(to[x[0]]), first[x], many[x]) for x in np.split(by, np.flatnonzero(np.diff(to[by])) + 1)]
            groups.append((int(place[0]) % buckets, np.flatnonzero(known), None))
            for bucket, idx, m in groups:
                if not len(idx):
                    continue
                there, local = np.unique(doc[idx], return_inverse=True)
                empty = b"" if m is None else None
                for c, v in zip(rows, (bucket, empty if m is None else one[idx].tobytes(),
                                       empty if m is None else (two[idx] >> _U(32)).astype(np.uint32).tobytes(),
                                       empty if m is None else np.packbits(m).tobytes(), local.astype(np.uint32).tobytes(),
                                       pos[idx].tobytes(), k1[there].tobytes(), k2[there].tobytes()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), *(pa.array(c, pa.binary()) for c in rows[1:])],
                                             names=["bucket", "one", "two", "many", "doc", "pos", "k1", "k2"])

    def count(table: pa.Table) -> pa.Table:
        rows = [{c: np.frombuffer(table.column(c)[i].as_buffer(), kind) for c, kind in
                 (("one", _U), ("two", np.uint32), ("many", np.uint8), ("doc", np.uint32), ("pos", np.uint32), ("k1", np.int64), ("k2", np.int64))}
                for i in range(table.num_rows)]
        asked = [r for r in rows if len(r["one"])]
        out: list[tuple] = []
        if asked:
            one, two = (np.concatenate([r[c] for r in asked]) for c in ("one", "two"))
            many = np.concatenate([np.unpackbits(r["many"], count=len(r["one"])) for r in asked]).astype(bool)
            order = np.lexsort((two, one))
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            group = np.cumsum(new) - 1
            hit = (np.bincount(group) > 1) | (np.bincount(group, weights=many[order]) > 0)
            back = np.zeros(len(order), bool)
            back[order] = hit[group]
            back &= ~many  # those are passed on with all their places
            at = 0
            for r in asked:
                out.append((r, back[at: at + len(r["one"])]))
                at += len(r["one"])
        out += [(r, np.ones(len(r["pos"]), bool)) for r in rows if not len(r["one"])]
        k1, k2, starts = [], [], []
        for r, take in out:
            doc, pos = r["doc"][take], r["pos"][take]
            order = np.argsort(doc, kind="stable")
            for x in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
                if len(x):
                    k1.append(int(r["k1"][doc[x[0]]]))
                    k2.append(int(r["k2"][doc[x[0]]]))
                    starts.append(pos[x].tobytes())
        return pa.table({"k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "starts": pa.array(starts, pa.binary())})

    return docs.mapInArrow(deal, _WINDOWS).groupBy("bucket").applyInArrow(count, "k1 long, k2 long, starts binary")


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per document: (doc_id, n_words, n_removed, kept): its words outside
    every repeated window of ``size`` words, joined by one space.

    Words are runs of anything but ASCII white space; null and blank texts
    have none, a text under ``size`` words has no window. Rows that repeat,
    with one doc_id or with a null one, are documents of their own. Other
    columns are not read."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.lit(1), "doc_id", "text").alias("k1"),
                        F.xxhash64("text", "doc_id", F.lit(2)).alias("k2"))
    found = repeated_windows(keyed.select("k1", "k2", "text"), size).groupBy("k1", "k2").agg(F.collect_list("starts").alias("starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            n, gone, kept = [], [], []
            for text, starts in zip(part.column("text").fill_null(""), part.column("starts"), strict=True):
                parts = text.as_buffer().to_pybytes().split()
                n.append(len(parts))
                if starts.is_valid:
                    step = np.zeros(len(parts) + 1, np.int64)
                    at = np.unique(np.concatenate([np.frombuffer(s.as_buffer(), np.uint32) for s in starts.values])).astype(np.int64)
                    step[at] += 1
                    np.add.at(step, at + size, -1)
                    stay = np.flatnonzero(np.cumsum(step[:-1]) == 0)
                    gone.append(len(parts) - len(stay))
                    parts = [parts[i] for i in stay.tolist()]
                else:
                    gone.append(0)
                kept.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return (keyed.join(found, ["k1", "k2"], "left").select("doc_id", "text", "starts")
            .mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string"))
