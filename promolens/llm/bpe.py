"""Byte-level BPE encoding and decoding with a contiguous array of ranks.

A pre-token's bytes are its first parts. Beside the parts stands an array
with the merge rank of every two adjacent parts; the smallest rank (the first of
equals) is looked for by scanning, the boundary it names is deleted, and the ranks
beside the new part are looked up again, until no two neighbours merge. Scanning
is quadratic, so pre-tokens above ``SHORT`` bytes take the same merges from a heap.
A worker encodes each distinct chunk between lone spaces once and keeps it in
a bounded table; what does not fit is encoded again when it comes.

Defined cases: a null text is an empty one, with no ids and an empty decoded text; the
strings of added tokens in a text become their ids; bytes that are not UTF-8
decode to the replacement character.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import slices
from promolens.llm.tokens import _byte_signs as byte_signs

# fixed value: the pre-token pattern of byte-level vocabularies
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
SHORT = 64  # bytes of a pre-token that is scanned
KEEP = 400_000  # chunks in a worker's table
LONGEST = 48  # characters of a chunk that is kept
NONE = 1 << 30
_LONE = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")


class Codec:
    """Encodes and decodes with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, keep: int = KEEP, short: int = SHORT):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path}: only byte-level files without normaliser and prefix space")
        vocab, signs = model["vocab"], byte_signs()
        byte_of = {s: b for b, s in enumerate(signs)}
        self.first = [vocab[s] for s in signs]
        self.rank, self.made = {}, []  # (left, right) -> rank; rank -> merged part
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((vocab[a], vocab[b]), len(self.made))
            self.made.append(vocab[a + b])
        pairs = np.array([(a << 32) | b for a, b in self.rank], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.array(list(self.rank.values()), np.int64)[order]
        self.first_of, self.made_of = np.array(self.first, np.int32), np.array(self.made, np.int32)
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of.update({i: t.encode() for t, i in added.items()})
        self.added = added
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(PRE_TOKEN).findall
        self.keep, self.short, self.chunks, self.pre = keep, short, {}, {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of parts, ``NONE`` for those that do not merge."""
        pair = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, pair)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], NONE)

    def scan(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of short pre-tokens: smallest rank of the array, again and again,
        for all words of one length at a time (they lose one boundary a step)."""
        by_size: dict[int, list[bytes]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        out = {}
        for size, some in by_size.items():
            parts = self.first_of[np.frombuffer(b"".join(some), np.uint8)].reshape(-1, size)
            ranks = self._ranks(parts[:, :-1], parts[:, 1:])
            row = np.arange(len(some))
            while True:
                best = ranks.min(1) if ranks.shape[1] else np.full(len(row), NONE)
                done = best == NONE
                if done.any():
                    raw, wide = parts[done].astype("<u4").tobytes(), 4 * parts.shape[1]
                    for k, r in enumerate(row[done].tolist()):
                        out[some[r]] = raw[k * wide: (k + 1) * wide]
                    live = ~done
                    row, parts, ranks, best = row[live], parts[live], ranks[live], best[live]
                if not len(row):
                    break
                i = ranks.argmin(1)  # the first of equals
                each, last = np.arange(len(row)), ranks.shape[1] - 1
                parts[each, i] = self.made_of[best]
                keep = np.arange(last + 2) != i[:, None] + 1
                parts = parts[keep].reshape(len(row), -1)
                ranks = ranks[keep[:, 1:]].reshape(len(row), -1)
                after = np.flatnonzero(i < last)
                ranks[after, i[after]] = self._ranks(parts[after, i[after]], parts[after, i[after] + 1])
                before = np.flatnonzero(i > 0)
                ranks[before, i[before] - 1] = self._ranks(parts[before, i[before] - 1], parts[before, i[before]])
        return out

    def heap(self, word: bytes) -> bytes:
        """The same merges for a long pre-token: ranks in a heap, parts in a linked list."""
        rank, made = self.rank.get, self.made
        parts, n = [self.first[b] for b in word], len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        todo = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := rank(p, NONE)) != NONE]
        heapq.heapify(todo)
        while todo:
            r, i, (a, b) = heapq.heappop(todo)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged since
            parts[i], parts[j], after[i] = made[r], -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := rank((parts[x], parts[y]), NONE)) != NONE:
                    heapq.heappush(todo, (q, x, (parts[x], parts[y])))
        left = [p for p in parts if p >= 0]
        return struct.pack(f"<{len(left)}I", *left)

    def _learn(self, texts: list[str]) -> list[bytes]:
        """Packed ids of chunks, each new pre-token of theirs encoded once."""
        split = [[t] if self.split is None else self.split.split(t) for t in texts]
        words = [[w for p in parts for w in ([p] if p in self.added else self.words(p))] for parts in split]
        new = {w for some in words for w in some} - self.pre.keys() - self.added.keys()
        raw = {w: w.encode() for w in new}
        short = self.scan([r for r in raw.values() if len(r) <= self.short])
        made = {w: short[r] if len(r) <= self.short else self.heap(r) for w, r in raw.items()}
        if len(self.pre) < self.keep:
            self.pre.update((w, b) for w, b in made.items() if len(w) <= LONGEST)
        made.update((w, struct.pack("<I", i)) for w, i in self.added.items())
        known = self.pre
        return [b"".join([made[w] if w in made else known[w] for w in some]) for some in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers.

        A pre-token never spans a lone space or line break from its left, and no added token
        holds one, so a text is cut there first: a chunk's ids do not depend on its neighbours."""
        if any(" " in t or "\n" in t for t in self.added):
            return self._learn(texts)
        pieces = [_LONE.split(t) if _WIDE.search(t) else t.replace("\n", " \n").split(" ") for t in texts]
        heads = self._learn([p[0] for p in pieces])
        chunks = self.chunks
        words = [w for p in pieces for w in p[1:]]
        got = list(map(chunks.get, words))
        if None in got:
            lost = [i for i, b in enumerate(got) if b is None]
            new = list(dict.fromkeys([words[i] for i in lost]))
            made = dict(zip(new, self._learn([w if w[:1] == "\n" else " " + w for w in new]), strict=True))
            for i in lost:
                got[i] = made[words[i]]
            if len(chunks) < self.keep:
                chunks.update((w, b) for w, b in made.items() if len(w) <= LONGEST)
        out, at = [], 0
        for head, p in zip(heads, pieces, strict=True):
            end = at + len(p) - 1
            out.append(head + b"".join(got[at:end]))
            at = end
        return out

    def decode(self, ids: bytes) -> str:
        """The text of little-endian unsigned 32-bit ids, added tokens included."""
        table = self.bytes_of
        return b"".join([table[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a file; Python workers are reused, and so are its tables."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _mapped(df: DataFrame, source: str, path: str, new: dict[str, pa.DataType], make) -> DataFrame:
    """``df`` with the ``new`` columns that ``make(codec, values)`` gives for ``source``;
    they take the place of columns of their names."""
    if source in new:
        raise ValueError(f"{source} is read: write to a column of another name")
    kept = [c for c in df.columns if c not in new]
    wide = [f"c{i}" for i in range(len(kept))]
    numbered = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, wide, strict=True)])
    column = wide[kept.index(source)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in slices(batches, column):
            made = make(c, b.column(column).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, t) for x, t in zip(made, new.values(), strict=True)]],
                                             names=[*wide, *new])

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema.fields],
                        *[f"`{n}` {'binary' if t == pa.binary() else 'string'}" for n, t in new.items()]])
    return numbered.mapInArrow(run, schema).select(*[F.col(n).alias(c) for c, n in zip(kept, wide, strict=True)], *[F.col(f"`{n}`") for n in new])


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of whole texts, little-endian unsigned 32-bit integers."""
    return _mapped(docs, text, path, {out: pa.binary()}, lambda c, vs: [c.encode([v or "" for v in vs])])


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids."""
    return _mapped(encoded, ids, path, {out: pa.string()}, lambda c, vs: [[c.decode(v or b"") for v in vs]])


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with ``ids`` and ``decoded``."""
    def both(c: Codec, vs: list[str | None]) -> tuple[list[bytes], list[str]]:
        ids = c.encode([v or "" for v in vs])
        return ids, [c.decode(i) for i in ids]

    return _mapped(docs, text, path, {"ids": pa.binary(), "decoded": pa.string()}, both)


def op13_digest(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    done = round_trip(docs.select("doc_id", "text"), path)
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
