"""Token ids, packing and the shard files with their index."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public = pytest.importorskip("public_tokenizers")

from promolens.llm import packing, token_index
from promolens.llm.common import scratch
from promolens.llm.tokens import Encoder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ENCODERS = {f: Encoder(public.path(f)) for f in FILES}
TEXTS = ["", None, " ", "one", "a  b\n c", "Été, où. Über\nstraße", "x" * 300 + " y " * 50, "don't.,!", "same text here", "same text here",
         "<|endoftext|> a", "word " * 900, "\n\nx", "\n", "\ny\n"]


def plain(name, text):
    return ENCODERS[name].tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@given(st.lists(st.lists(st.sampled_from([*"aZ \u00e9\u0130\u00df\u03a3.,\n\t\u00a0\u3000'9<|>\u0301", "<|endoftext|>", "the", " and"]), max_size=40).map("".join), max_size=6))
@settings(max_examples=600, deadline=None)
def test_ids_are_the_library_s(name, texts):
    got = ENCODERS[name].encode(texts)
    assert [np.frombuffer(b, f"<u{ENCODERS[name].width}").tolist() for b in got] == [plain(name, t) for t in texts]


def rows(spark):
    ids = [None if i == 3 else min(i, 8) for i in range(len(TEXTS))]  # a null id, and repeated ids
    return list(zip(ids, TEXTS)), spark.createDataFrame([(i, t, 1, "z") for i, t in zip(ids, TEXTS)], "doc_id long, text string, length int, ids string")


def check_pack(spark, data, df, capacity=64):
    name = "word_bpe_49k.json"
    out = packing.pack(packing.pieces(df, public.path(name), capacity=capacity, slack=3), capacity).collect()
    want = sorted(((i is None, i or 0, tuple([*plain(name, t), 1])) for i, t in data))
    by: dict = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
    for doc_id, got in by.items():
        docs = sorted(w[2] for w in want if (None if w[0] else w[1]) == doc_id)
        assert sum(len(p) for _, p in got) == sum(map(len, docs))
        if len(docs) == 1:
            assert tuple(x for _, p in sorted(got) for x in p) == docs[0]
    sequences: dict = {}
    for r in out:
        assert len(np.frombuffer(r["ids"], "<u4")) == r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= capacity
    return sequences


def test_pack_odd_rows(spark):
    data, df = rows(spark)
    check_pack(spark, data, df)


def test_pack_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_digest(empty, public.path("word_bpe_49k.json")).collect() == []


def test_little_padding(spark):
    data = [(i, "abc def. " * (i % 37)) for i in range(400)]
    seq = check_pack(spark, data, spark.createDataFrame(data, "doc_id long, text string"), 128)
    held = sum(n for s in seq.values() for _, n in s)
    assert held >= 0.93 * 128 * len(seq)


@given(st.integers(0, 5000), st.integers(8, 2048), st.integers(0, 64))
@settings(max_examples=200, deadline=None)
def test_cut_covers(n, capacity, slack):
    cut = packing.cut_lengths(n, capacity, slack)
    assert sum(cut) == n and all(0 < c <= capacity for c in cut)


def test_levels_are_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        key, occ = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 3, n).astype(np.uint64)
        sizes, bits, slot = token_index.build_levels(key, occ)
        assert sorted(slot.tolist()) == list(range(n))
        assert (token_index.find_slots(key, occ, sizes, bits) == slot).all()
        assert bits.sum() == n


def test_index_round_trip(spark):
    data, df = rows(spark)
    name, path = "byte_bpe_50k.json", scratch(spark, "test-ids")
    tok = public.path(name)
    got = token_index.op4_digest(spark, df, path, tok).collect()
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(data)
    crc = lambda t: zlib.crc32(np.array([*plain(name, t), 0], "<u4").tobytes())
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i or -1, len(plain(name, t)) + 1, crc(t)) for i, t in order)
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"] or -1) for r in got)
    assert [s for s, _, _ in starts] == [sum(n for _, n, _ in starts[:k]) for k in range(len(starts))]
    assert [d for _, _, d in starts] == sorted(d for _, _, d in starts)
    width = ENCODERS[name].width
    stored = token_index.catalogue(spark, path, width)
    index = token_index.build_index(stored, keys_per_segment=3).cache()
    assert token_index.get(spark, path, index, 5, width).tolist() == [*plain(name, TEXTS[5]), 0]
    assert token_index.get(spark, path, index, 12345, width) is None
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_index.op4_digest(spark, empty, scratch(spark, "test-ids"), tok).collect() == []


def test_shards_close_by_bytes(spark):
    data, df = rows(spark)
    name, path = "byte_bpe_50k.json", scratch(spark, "test-bytes")
    width = ENCODERS[name].width
    token_index.write_shards(df.coalesce(1), path, public.path(name), docs_per_shard=4, bytes_per_shard=40)
    got = token_index.read_shards(spark, path, width).collect()
    want = [[*plain(name, t), 0] for _, t in data]
    assert sorted(np.frombuffer(r["ids"], f"<u{width}").tolist() for r in got) == sorted(want)
    shards = {}
    for r in got:
        shards.setdefault((r["part"], r["file_no"]), []).append(r["n_ids"] * width)
    assert all(len(s) <= 4 and (sum(s) <= 40 or len(s) == 1) for s in shards.values())
    assert any(len(s) == 1 and s[0] > 40 for s in shards.values()) and any(1 < len(s) < 4 for s in shards.values())
    for (part, no), s in shards.items():
        assert sorted(r["row"] for r in got if (r["part"], r["file_no"]) == (part, no)) == list(range(len(s)))
    one = next(r for r in got if r["n_ids"] > 100)
    assert token_index.read_span(spark, path, one["part"], one["file_no"], one["byte_offset"], one["n_ids"], width).tobytes() == one["ids"]
