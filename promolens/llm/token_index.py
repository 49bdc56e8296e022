"""Token ids in raw shard files with a minimal perfect hash index.

File format. A shard holds the ids of up to ``docs_per_shard`` documents, closed
early at ``bytes_per_shard``, on end (2 or 4 bytes an id, little-endian, by the vocabulary's
size), then a zero byte for each document that it is short of ``docs_per_shard`` when closed early (the
writer starts a file by the count of its records), then a
footer: the documents' keys (int64), id counts (uint32), null flags of the
keys (uint8), the number of documents (uint32) and of the zero bytes (uint32). Spark's own file writer
writes the shards, so a retried or duplicate task leaves no half file and any
Hadoop file system will do; every record ends in a zero byte (the end id's
high byte, the footer's last byte), which is the writer's record separator.

Index. Keys fall into segments of about ``keys_per_segment``; a segment is
one row with a cascade of bit arrays (each level keeps the keys that fall
alone on a bit, the others go on), whose rank is the key's slot, and the
slots' fingerprint, shard, offset and count. A lookup hashes the key, tests a
few bits, checks one fingerprint and reads one span.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import shuffle_partitions, slices, staged, with_running
from promolens.llm.tokens import encoder

END_ID = 0
KEEP_CHUNKS = 1_300_000  # the writer's table of known chunks: about 300 MB a worker
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 (fixed public constants)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _level_hash(key: np.ndarray, occ: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(key + mix64(occ + _U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))


def build_levels(key: np.ndarray, occ: np.ndarray, room: float = 2.0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(bits per level, all bits, slot of each key) of distinct (key, occ)."""
    sizes, bits, slot = [], [], np.full(len(key), -1, np.int64)
    left, taken = np.arange(len(key)), 0
    while len(left):
        size = max(8, int(room * len(left)))
        pos = (_level_hash(key[left], occ[left], len(sizes)) % _U(size)).astype(np.int64)
        hits = np.bincount(pos, minlength=size)
        alone = hits[pos] == 1
        level = hits == 1
        rank = np.cumsum(level) - 1
        slot[left[alone]] = taken + rank[pos[alone]]
        taken += int(alone.sum())
        left = left[~alone]
        sizes.append(size)
        bits.append(level)
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def find_slots(key: np.ndarray, occ: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key; -1 where no level holds it (an absent key may also
    get a slot: the fingerprint tells)."""
    slot, rank = np.full(len(key), -1, np.int64), np.cumsum(bits) - 1
    left, base = np.arange(len(key)), 0
    for level, size in enumerate(sizes):
        pos = (_level_hash(key[left], occ[left], level) % _U(size)).astype(np.int64) + base
        hit = bits[pos]
        slot[left[hit]] = rank[pos[hit]]
        left, base = left[~hit], base + size
    return slot


def fingerprint(key: np.ndarray, occ: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(mix64(key) ^ (occ * _U(0xD6E8FEB86659FD93))) >> _U(32)).astype(np.uint32)


def write_shards(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                 docs_per_shard: int = 1024, bytes_per_shard: int = 1 << 30, end_id: int = END_ID) -> None:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes
    the shards in ascending key order (null keys first; equal keys by text inside
    a range).

    A shard closes at ``docs_per_shard`` documents or before ``bytes_per_shard`` bytes of ids (a longer
    document is a shard of its own): it stays under 2 GB, the limit of a binary value in Spark, however
    long the documents are."""
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, KEEP_CHUNKS)
        stop = int(end_id).to_bytes(enc.width, "little")
        keys: list[int] = []
        counts: list[int] = []
        nulls: list[bool] = []
        size = 0

        def footer(short: int = 0) -> bytes:
            end = (np.array(keys, np.int64).tobytes() + np.array(counts, np.uint32).tobytes()
                   + np.array(nulls, np.uint8).tobytes() + len(keys).to_bytes(4, "little") + short.to_bytes(4, "little"))
            for x in (keys, counts, nulls):
                x.clear()
            return end

        for part in slices(batches, "text", 1 << 22):
            out = []
            ids = enc.encode(part.column("text").fill_null("").to_pylist())
            for k, b in zip(part.column("key").to_pylist(), ids, strict=True):
                if keys and size + len(b) + enc.width > bytes_per_shard:
                    short = docs_per_shard - len(keys)
                    out.extend([b"\0"] * short + [footer(short)])
                    size = 0
                out.append(b + stop)
                size += len(b) + enc.width
                keys.append(k or 0)
                nulls.append(k is None)
                counts.append(len(b) // enc.width + 1)
                if len(keys) == docs_per_shard:
                    out.append(footer())
                    size = 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["rec"])
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([footer()], pa.binary())], names=["rec"])

    if docs_per_shard >= 1 << 24:
        raise ValueError("a shard holds fewer than 2^24 documents: the footer's high byte must be zero")
    if end_id >> 8 * (encoder(tokenizer).width - 1):
        raise ValueError("the end id's high byte must be zero: it ends each record")
    # The salt cuts a key with very many rows; the range bounds are sampled without reading a text.
    (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("salt"))
     .repartitionByRange(shuffle_partitions(docs.sparkSession), "key", "salt").sortWithinPartitions("key", F.xxhash64("text"))
     .mapInArrow(records, "rec binary")
     .select(F.expr("cast(substring(rec, 1, length(rec) - 1) as string)").alias("value"))
     .write.option("lineSep", "\0").option("compression", "none").option("maxRecordsPerFile", docs_per_shard + 1)
     .text(path))


_PLACE = "part long, file_no long, row long, key long, byte_offset long, n_ids long"


def read_shards(spark: SparkSession, path: str, width: int, checksum: bool = False) -> DataFrame:
    """One row per stored document, from the files: its place and ``ids``
    (binary), or with ``checksum`` ``ids_crc32``, the unsigned checksum of
    its ids as unsigned 32-bit integers, instead."""
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, raw = batch.column("path")[i].as_py(), batch.column("content")[i].as_buffer()
                size = raw.size
                if not size:
                    continue
                part, no = map(int, re.search(r"part-(\d+)-.*-c(\d+)", name).groups())
                n, short = np.frombuffer(raw, "<u4", 2, size - 8).tolist()
                at = size - 8 - 13 * n
                keys = np.frombuffer(raw, np.int64, n, at)
                counts = np.frombuffer(raw, np.uint32, n, at + 8 * n).astype(np.int64)
                nulls = np.frombuffer(raw, np.uint8, n, at + 12 * n).astype(bool)
                ends = np.cumsum(counts) * width
                if ends[-1] + short != at:
                    raise ValueError(f"{name}: its footer and its size differ")
                cuts = np.concatenate([[0], ends]).astype(np.int64)
                if checksum:
                    wide = memoryview(np.frombuffer(raw, f"<u{width}", int(ends[-1]) // width).astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(wide[x:y]) for x, y in zip((cuts * 4 // width).tolist(), (cuts[1:] * 4 // width).tolist())], pa.int64())
                else:
                    last = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), raw.slice(0, at)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.array(np.full(n, no)), pa.array(np.arange(n)),
                     pa.array(keys, mask=nulls), pa.array(ends - counts * width), pa.array(counts), last],
                    names=["part", "file_no", "row", "key", "byte_offset", "n_ids", "ids_crc32" if checksum else "ids"])

    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
            .mapInArrow(spans, f"{_PLACE}, {'ids_crc32 long' if checksum else 'ids binary'}"))


def catalogue(spark: SparkSession, path: str, width: int) -> DataFrame:
    """The stored documents without their ids: place, order number, number of
    ids stored before, occurrence of the key, checksum of the ids as
    unsigned 32-bit integers."""
    rows = staged(read_shards(spark, path, width, checksum=True), "catalogue")
    shards = with_running(rows.groupBy("part", "file_no").agg(F.sum("n_ids").alias("ids")), ["part", "file_no"], "ids", out="before")
    rows = (rows.join(shards.drop("ids"), ["part", "file_no"])
            .withColumn("start", F.col("before") + (F.col("byte_offset") / width).cast("long")).drop("before"))
    first = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    many = first.where("copies > 1").select("key")
    again = with_running(rows.join(many, "key", "left_semi").select("part", "file_no", "row", "key"),
                         ["part", "file_no", "row"], group=["key"], out="occ", label="occurrences")
    return (rows.join(again.drop("key"), ["part", "file_no", "row"], "left")
            .withColumn("occ", F.coalesce("occ", F.lit(0).cast("long"))))


def _places(keys: DataFrame, segments: int) -> DataFrame:
    return keys.withColumn("hash", F.xxhash64("key")).withColumn("segment", F.pmod(F.xxhash64(F.lit(7), "key", "occ"), F.lit(segments)))


_SEGMENT = "segment long, n_keys long, sizes array<long>, bits binary, prints binary, part binary, file_no binary, byte_offset binary, n_ids binary"


def build_index(stored: DataFrame, keys_per_segment: int = 4096) -> DataFrame:
    """One row per segment of the keys (null keys are not addressable)."""
    def segment(table: pa.Table) -> pa.Table:
        key, occ = (table.column(c).to_numpy().astype(np.int64).view(_U) for c in ("hash", "occ"))
        sizes, bits, slot = build_levels(key, occ)
        order = np.argsort(slot)
        col = lambda c, kind: table.column(c).to_numpy()[order].astype(kind).tobytes()
        return pa.table({"segment": [table.column("segment")[0].as_py()], "n_keys": [len(key)], "sizes": [sizes],
                         "bits": [np.packbits(bits).tobytes()], "prints": [fingerprint(key, occ)[order].tobytes()],
                         "part": [col("part", np.uint32)], "file_no": [col("file_no", np.uint32)],
                         "byte_offset": [col("byte_offset", np.uint64)], "n_ids": [col("n_ids", np.uint32)]},
                        schema=pa.schema([("segment", pa.int64()), ("n_keys", pa.int64()), ("sizes", pa.list_(pa.int64())),
                                          ("bits", pa.binary()), ("prints", pa.binary()), ("part", pa.binary()),
                                          ("file_no", pa.binary()), ("byte_offset", pa.binary()), ("n_ids", pa.binary())]))

    keyed = stored.where("key is not null")
    segments = max(1, -(-keyed.count() // keys_per_segment))
    return (_places(keyed, segments).select("segment", "hash", "occ", "part", "file_no", "byte_offset", "n_ids")
            .groupBy("segment").applyInArrow(segment, _SEGMENT).withColumn("segments", F.lit(segments)))


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(key, occ, part, file_no, byte_offset, n_ids) of the given (key, occ);
    absent keys give no row (a wrong fingerprint match has a chance of 2^-32)."""
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["part", "file_no", "byte_offset", "n_ids"]
        if not right.num_rows or not left.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ["key", "occ", *names]})
        row = {c: right.column(c)[0].as_py() for c in right.column_names}
        key, occ = (left.column(c).to_numpy().astype(np.int64).view(_U) for c in ("hash", "occ"))
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        slot = find_slots(key, occ, row["sizes"], bits)
        good = slot >= 0
        good[good] = np.frombuffer(row["prints"], np.uint32)[slot[good]] == fingerprint(key, occ)[good]
        at = slot[good]
        out = {c: left.column(c).to_numpy()[good] for c in ("key", "occ")}
        for c, kind in zip(names, (np.uint32, np.uint32, np.uint64, np.uint32), strict=True):
            out[c] = np.frombuffer(row[c], kind)[at].astype(np.int64)
        return pa.table(out)

    first = index.select("segments").first()
    asked = _places(keys.where("key is not null"), first["segments"] if first else 1)
    return (asked.select("segment", "key", "occ", "hash").groupBy("segment").cogroup(index.drop("segments").groupBy("segment"))
            .applyInArrow(find, "key long, occ long, part long, file_no long, byte_offset long, n_ids long"))


def read_span(spark: SparkSession, path: str, part: int, file_no: int, byte_offset: int, n_ids: int, width: int) -> np.ndarray:
    """The ids of one document: one seek and one read in its shard."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/part-{part:05d}-*-c{file_no:03d}*")
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(fs.globStatus(hpath)[0].getPath())
    try:
        stream.seek(byte_offset)
        raw = bytes(stream.readNBytes(n_ids * width))
    finally:
        stream.close()
    return np.frombuffer(raw, f"<u{width}")


def get(spark: SparkSession, path: str, index: DataFrame, key: int, width: int, occ: int = 0) -> np.ndarray | None:
    """Ids of one key, None if it is not stored."""
    asked = spark.createDataFrame([(key, occ)], "key long, occ long")
    place = lookup(asked, index).first()
    return None if place is None else read_span(spark, path, place["part"], place["file_no"], place["byte_offset"], place["n_ids"], width)


def op4_digest(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Writes ``docs`` to shards, indexes them and reads every document back
    through the index: (doc_id, start, n_tokens, ids_crc32).

    A null text has only the end id; a null doc_id is stored first and read
    without the index (it has no key); rows with one doc_id are separate
    occurrences of the key, in order of their texts; no rows, no result.
    Other columns are not read."""
    write_shards(docs, path, tokenizer)
    width = encoder(tokenizer).width
    stored = staged(catalogue(spark, path, width), "stored")
    index = staged(build_index(stored), "index")
    wanted = (docs.groupBy(F.col("doc_id").cast("long").alias("key")).count()
              .select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("occ")))
    found = lookup(wanted, index)
    rows = found.join(stored.drop("key", "occ"), ["part", "file_no", "byte_offset", "n_ids"])
    cols = [F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32"]
    return rows.select(*cols).unionByName(stored.where("key is null").select(*cols))
