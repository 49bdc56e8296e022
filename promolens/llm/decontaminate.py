"""Benchmark passages in documents, found by the q-gram lemma.

Texts are lower-cased with white space runs as one space. Each benchmark item
is cut into overlapping segments of ``SEGMENT`` bytes (a shorter item is one
segment). A segment of m bytes that occurs with at most k edits shares at
least m - q + 1 - k q of its q-grams with the text there, and their diagonals
(place in the text less place in the segment) differ by k at most. Shared
q-grams are counted in bands of diagonals, each overlapping the next by half,
so the match lies whole in one band; bands that reach the count are aligned
with the segment inside the band, and those within the budget are matches.

The items are the query set. Equal texts are one, whose item ids are joined to
the matches at the end; texts are cut into blocks by their running bytes, each
broadcast once and held against every document. Equal segments of a block's
texts are looked up and aligned once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import slices, staged, with_running
from promolens.llm.token_index import mix64

_U = np.uint64
Q = 12
SEGMENT = 64
STEP = 16  # so any run of SEGMENT + STEP - 1 bytes of an item holds a whole segment: about 13 words
EDITS_PER = 16  # one edit for so many bytes
TOGETHER = 2048  # bands aligned at a time
BLOCK_BYTES = 4 << 20
HITS = 1 << 21  # shared q-grams laid out at a time
MAP = 1 << 22


def normal(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


def qgrams(raw: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q = 12 bytes from every place."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, _U)
    two = raw[:-1].astype(np.uint16) | (raw[1:].astype(np.uint16) << np.uint16(8))
    four = two[:-2].astype(np.uint32) | (two[2:].astype(np.uint32) << np.uint32(16))
    eight = four[:n].astype(_U) | (four[4: n + 4].astype(_U) << _U(32))
    eight *= _U(0x9E3779B97F4A7C15)
    eight ^= four[8: n + 8].astype(_U) * _U(0xD6E8FEB86659FD93)
    return eight


def _spot(codes: np.ndarray) -> np.ndarray:
    return ((codes * _U(0xBF58476D1CE4E5B9)) >> _U(64 - MAP.bit_length() + 1)).astype(np.int64)


class Items:
    """Distinct segments of a block of items and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        of: dict[bytes, list[int]] = {}  # segment -> its items
        for item, text in items:
            raw = normal(text or "")
            if len(raw) < Q:
                continue  # no q-gram: too short to be told from chance
            for a in sorted({*range(0, max(1, len(raw) - SEGMENT + 1), STEP), max(0, len(raw) - SEGMENT)}):
                held = of.setdefault(raw[a: a + SEGMENT], [])
                if not held or held[-1] != item:
                    held.append(item)
        self.text, self.items = list(of), list(of.values())
        self.edits = [min(len(s) // EDITS_PER, (len(s) - Q) // Q) for s in self.text]
        self.least = [len(s) - Q + 1 - k * Q for s, k in zip(self.text, self.edits, strict=True)]
        grams = [qgrams(np.frombuffer(s, np.uint8)) for s in self.text]
        seg, pos = [np.full(len(g), i) for i, g in enumerate(grams)], [np.arange(len(g)) for g in grams]
        self.band = max(self.edits, default=0) + 1
        self.least_of = np.array(self.least, np.int64)
        gram = np.concatenate(grams) if grams else np.zeros(0, _U)
        order = np.argsort(gram, kind="stable")
        self.gram = gram[order]
        self.seg = (np.concatenate(seg) if seg else np.zeros(0, np.int64))[order]
        self.pos = (np.concatenate(pos) if pos else np.zeros(0, np.int64))[order]
        self.map = np.zeros(MAP, bool)
        self.map[_spot(self.gram)] = True

    def regions(self, raw: np.ndarray) -> list[tuple[int, int]]:
        """(segment, first diagonal) of every band of the texts in ``raw`` that
        reaches its segment's count."""
        codes = qgrams(raw)
        at = np.flatnonzero(self.map[_spot(codes)])
        lo = np.searchsorted(self.gram, codes[at], "left")
        n = np.searchsorted(self.gram, codes[at], "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            return []
        strip, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(n) // HITS)) + 1):
            m = n[part]
            which = np.repeat(lo[part] - np.concatenate([[0], np.cumsum(m)[:-1]]), m) + np.arange(m.sum())
            seg, diagonal = self.seg[which], np.repeat(at[part], m) - self.pos[which] + SEGMENT  # never negative
            new, more = np.unique(seg * (len(raw) + 2 * SEGMENT) + diagonal // self.band, return_counts=True)
            strip, into = np.unique(np.concatenate([strip, new]), return_inverse=True)
            count = np.bincount(into, np.concatenate([count, more]), len(strip)).astype(np.int64)
        # a band takes two neighbouring strips of diagonals: count each strip, then add the next
        both = count.copy()
        both[:-1] += np.where(strip[1:] == strip[:-1] + 1, count[1:], 0)
        size = len(raw) + 2 * SEGMENT
        good = both >= self.least_of[strip // size]
        return [(int(s // size), int(s % size) * self.band - SEGMENT) for s in strip[good]]

    def align(self, bands: list[tuple[int, int, int, int]], joined: bytes) -> list[tuple[int, int, int] | None]:
        """For each (segment, first diagonal, start, end of a text), places in
        ``joined``: (edits, start, end) of the segment's best place in the band
        inside that text; None above its budget. Segments of one length are
        aligned together."""
        out: list[tuple[int, int, int] | None] = [None] * len(bands)
        rest: dict[int, list[int]] = {}
        for i, (seg, diagonal, first, last) in enumerate(bands):
            pattern, k = self.text[seg], self.edits[seg]
            exact = joined.find(pattern, max(first, diagonal - k), max(first, min(last, diagonal + 2 * self.band + k + len(pattern))))
            if exact >= 0:
                out[i] = 0, exact, exact + len(pattern)
            elif k:
                rest.setdefault(len(pattern), []).append(i)
        raw = np.frombuffer(joined, np.uint8)
        for long, those in rest.items():
            for a in range(0, len(those), TOGETHER):
                self._align(long, those[a: a + TOGETHER], bands, raw, out)
        return out

    def _align(self, long: int, those: list[int], bands: list, raw: np.ndarray, out: list) -> None:
        seg, diagonal, first, last = np.array([bands[i] for i in those], np.int64).T
        k = self.edits[int(seg[0])]  # the length gives the budget
        width, lo = 2 * self.band + 2 * k + 1, diagonal - k
        bits = width.bit_length()
        pattern = np.frombuffer(b"".join(self.text[s] for s in seg), np.uint8).reshape(len(seg), long).T
        at = lo + np.arange(long + width)[:, None]
        padded = np.where((at >= first) & (at < last), raw[np.clip(at, 0, len(raw) - 1)], 256).astype(np.int16)
        steps = np.arange(width, dtype=np.int32)[:, None]
        dist, start = np.zeros((width, len(seg)), np.int32), np.repeat(steps, len(seg), 1)
        none = np.full((1, len(seg)), 1 << 20, np.int32)
        for r in range(long):
            straight = dist + (padded[r: r + width] != pattern[r])
            skip = np.concatenate([dist[1:] + 1, none])
            begun = np.where(skip < straight, np.concatenate([start[1:], start[:1]]), start)
            # least of the cells to the left, the nearest of equal ones, in one number
            run = np.minimum.accumulate((np.minimum(straight, skip) - steps) * (1 << bits) - steps, axis=0)
            source = -run & ((1 << bits) - 1)
            dist, start = ((run + source) >> bits) + steps, np.take_along_axis(begun, source, 0)
        best = dist.argmin(0)
        edits, begin = dist[best, np.arange(len(seg))], start[best, np.arange(len(seg))] + lo
        for i, e, b, z in zip(those, edits.tolist(), np.maximum(first, begin).tolist(), np.minimum(last, best + lo + long).tolist(), strict=True):
            if e <= k:
                out[i] = e, b, z


def _original(text: str, raw: bytes, start: int, end: int) -> tuple[int, int]:
    """Span of the words in ``text`` (code points) that a span of its normal form touches."""
    first, last = raw[:start].count(b" "), raw[:max(start, end - 1)].count(b" ")
    spans = [m.span() for m in re.finditer(r"\S+", text)]
    return spans[first][0], spans[min(last, len(spans) - 1)][1]


def _places(known: Items, texts: list[str]) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(text number, item) -> (places, fewest edits, start, end)."""
    raws = [normal(t) for t in texts]
    joined = b"\0".join(raws) + b"\0"
    ends = np.cumsum([len(r) + 1 for r in raws])
    bands, where = [], []
    for seg, diagonal in known.regions(np.frombuffer(joined, np.uint8)):
        far = diagonal + 2 * known.band + len(known.text[seg])
        first, last = (min(int(np.searchsorted(ends, max(0, x), "right")), len(raws) - 1) for x in (diagonal, far))
        for d in range(first, last + 1):  # the band can touch the texts beside the one that filled it
            bands.append((seg, diagonal, int(ends[d]) - len(raws[d]) - 1, int(ends[d]) - 1))
            where.append(d)
    found: dict[tuple[int, int], list] = {}
    for d, (seg, _, begin, _), hit in zip(where, bands, known.align(bands, joined), strict=True):
        for item in known.items[seg] if hit else ():
            found.setdefault((d, item), []).append((hit[0], hit[1] - begin, hit[2] - begin))
    return {(d, item): (len({h[1] for h in hits}), min(h[0] for h in hits),
                        *_original(texts[d], raws[d], min(h[1] for h in hits), max(h[2] for h in hits))) for (d, item), hits in found.items()}


def _texts(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tid, text, block) of the distinct texts, in blocks of about BLOCK_BYTES by
    their running bytes; (item_id, tid) of every item that has a text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    distinct = staged(items.groupBy("text").agg(F.octet_length("text").alias("size")).withColumn("tid", F.monotonically_increasing_id()), "texts")
    texts = with_running(distinct, ["tid"], "size", out="before").withColumn("block", F.floor(F.col("before") / BLOCK_BYTES).cast("long"))
    return staged(texts.select("tid", "text", "block"), "blocks"), items.join(distinct.select("text", "tid"), "text").select("item_id", "tid")


def _blocks(texts: DataFrame) -> Iterator[Items]:
    """The blocks of ``_texts``, one at a time: BLOCK_BYTES and one text at most."""
    last = texts.agg(F.max("block")).first()[0]
    for b in range(-1 if last is None else last + 1):  # a long text may leave blocks empty
        held = texts.where(F.col("block") == b).orderBy("tid").collect()
        if held:
            yield Items([(r["tid"], r["text"]) for r in held])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_matches, edits, start, end): each document and
    benchmark item that share a passage, the number of places, the fewest
    edits, and the span in the document (code points) around all of them.

    A passage is a segment of ``SEGMENT`` bytes, or a whole shorter item, with
    one edit for every ``EDITS_PER`` bytes at most. Null and blank texts match
    nothing, nor do items under ``Q`` bytes; repeated rows match row by row
    (a null doc_id stays null), items with one text each have their row; an
    empty benchmark gives no row. Other columns are not read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = ["doc_id", "tid", "n_matches", "edits", "start", "end"]
    texts, items = _texts(benchmark)

    def scan(items: Items) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                found = _places(shared.value, part.column("text").fill_null("").to_pylist())
                rows = [(part.column("doc_id")[d].as_py(), item, *rest) for (d, item), rest in sorted(found.items())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names=names)

        return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names))

    none = docs.sparkSession.createDataFrame([], ", ".join(f"{c} long" for c in names))
    found = reduce(DataFrame.unionByName, map(scan, _blocks(texts)), none)
    return found.join(items, "tid").select("doc_id", "item_id", *names[2:])


def without_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that share a passage with an item; all columns
    go along, and nothing is shuffled."""
    names, schema = docs.columns, docs.schema
    kinds = ", ".join(f"{'text' if f.name == 'text' else f'c{k}'} {f.dataType.simpleString()}" for k, f in enumerate(schema.fields))
    for items in _blocks(_texts(benchmark)[0]):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], now=shared) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                bad = {d for d, _ in _places(now.value, part.column("text").fill_null("").to_pylist())}
                yield part.filter(pa.array([d not in bad for d in range(part.num_rows)]))

        numbered = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{k}") for k, c in enumerate(names)])
        docs = numbered.mapInArrow(run, kinds).select(*[F.col("text" if c == "text" else f"c{k}").alias(c) for k, c in enumerate(names)])
    return docs
