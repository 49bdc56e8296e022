"""Harmonic packing of token ids into sequences of bounded length.

A piece of length n belongs to class k = capacity // n, and a sequence of
class k takes exactly k pieces, whichever they are. A document is cut into
full sequences and a rest; the rest gives pieces of exactly capacity // (k+1)
ids until k pieces of what is left fill a sequence up to ``slack`` ids. A
sequence so loses at most ``slack`` ids, and which worker fills it does not
matter. Each class can end with one sequence that is not full; those pieces
(under k for each of the classes, about 10 000 at a capacity of 2048, however
many documents there are) are packed by decreasing length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import shuffle_partitions, slices, staged
from promolens.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1


def cut_lengths(n: int, capacity: int = CAPACITY, slack: int = 24) -> list[int]:
    """Lengths of a document's pieces, in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if capacity - k * rest <= max(slack, capacity % k):
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           slack: int = 24, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): the ids of each whole text
    (null: empty) and ``end_id``, cut; ids are little-endian unsigned 32-bit."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        stop = int(end_id).to_bytes(enc.width, "little")
        for part in slices(batches, "text", 1 << 22):
            cols: list[list] = [[], [], [], [], []]
            coded = enc.encode(part.column("text").fill_null("").to_pylist())
            for doc, raw in zip(part.column("key").to_pylist(), coded, strict=True):
                ids = np.frombuffer(raw + stop, f"<u{enc.width}").astype("<u4").tobytes()
                start, total = 0, len(ids) // 4
                for n in cut_lengths(total, capacity, slack):
                    for c, v in zip(cols, (doc, start, n, total, ids[4 * start: 4 * (start + n)]), strict=True):
                        c.append(v)
                    start += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(cols[4], pa.binary())],
                                             names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
            .mapInArrow(cut, "doc_id long, start long, length long, doc_tokens long, ids binary"))


def _tail(capacity: int):
    """First fit by decreasing length over the pieces that fill no sequence of
    their class."""
    def place(table: pa.Table) -> pa.Table:
        t = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("nth", "ascending")])
        used, bins, offsets = np.zeros(0, np.int64), [], []
        for n in t.column("length").to_pylist():
            fit = np.flatnonzero(used + n <= capacity)
            if not len(fit):
                used, fit = np.append(used, 0), [len(used)]
            bins.append(int(fit[0]))
            offsets.append(int(used[fit[0]]))
            used[fit[0]] += n
        return t.append_column("bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))
    return place


def pack(cut: DataFrame, capacity: int = CAPACITY, carry: list[str | Column] | None = None) -> DataFrame:
    """Places pieces: their ``doc_id, start, length``, what ``carry`` names of
    each (default: its ids), ``sequence_id`` and ``offset``.

    Sequence ids run from 0 without gaps, class by class, the mixed ones
    last; offsets run from 0 without gaps. ``carry`` is evaluated on the
    pieces before they move, so a digest costs no shuffle of the ids.
    Repeated rows and null doc_ids are packed like any others."""
    cut = cut.select("doc_id", "start", "length", *(["ids"] if carry is None else carry))
    base = [*cut.columns]
    cut = staged(cut.withColumn("k", (F.lit(capacity) / F.col("length")).cast("long")), "pieces")
    order = ["k", "doc_id", "start"]
    ranged = staged(cut.repartitionByRange(shuffle_partitions(cut.sparkSession), *order)
                    .withColumn("_range", F.spark_partition_id()), "ranged")
    # a piece's number in its class: the class's pieces in earlier ranges, then its place in its own
    counts = ranged.groupBy("k", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .withColumn("_all", F.sum("_n").over(Window.partitionBy("k"))))
    classes = counts.groupBy("k").agg((F.max("_all") / F.col("k")).cast("long").alias("_full"))
    below = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)  # a row per class
    classes = classes.withColumn("_base", F.coalesce(F.sum("_full").over(below), F.lit(0).cast("long")))
    classes = classes.withColumn("_total", F.sum("_full").over(Window.partitionBy()))
    local = F.row_number().over(Window.partitionBy("_range", "k").orderBy("doc_id", "start"))
    numbered = (ranged.withColumn("_i", local).join(counts.select("k", "_range", "_before"), ["k", "_range"])
                .join(F.broadcast(classes), "k")
                .withColumn("nth", F.col("_before") + F.col("_i") - 1)
                .withColumn("bin", (F.col("nth") / F.col("k")).cast("long")))
    filled = Window.partitionBy("k", "bin").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    full = (numbered.where("bin < _full").withColumn("offset", F.coalesce(F.sum("length").over(filled), F.lit(0)))
            .withColumn("sequence_id", F.col("_base") + F.col("bin")))
    rest = numbered.where("bin >= _full").select(*base, "nth", "_total")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema.fields)
    tail = rest.groupBy("_total").applyInArrow(_tail(capacity), f"{kinds}, bin long, offset long")
    tail = tail.withColumn("sequence_id", F.col("_total") + F.col("bin"))
    cols = [*base, F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset")]
    return full.select(*cols).unionByName(tail.select(*cols))


def pack_digest(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, slack: int = 24) -> DataFrame:
    """All documents packed, with the pieces' checksums instead of their ids:
    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    cut = pieces(docs, tokenizer, capacity=capacity, slack=slack)
    out = pack(cut, capacity, [F.crc32("ids").alias("ids_crc32"), "doc_tokens"])
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
