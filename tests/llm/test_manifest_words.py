"""Operators 11 to 13 against plain single-process versions."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from promolens.llm import bpe, merkle, spelling
from promolens.llm.queries import tokenizer_path

DOCS = "doc_id long, source string, lang string, n_chars long, text string, g string, idx int"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(r, more: int = 0) -> str:
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _climb(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """(root, for each node the siblings with their side)."""
    ways, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_held = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i: i + 2]
            for j in range(len(pair)):
                for leaf in held[i + j]:
                    ways[leaf].append(("", "") if len(pair) == 1 else (pair[1], "R") if j == 0 else (pair[0], "L"))
            up.append(_h(*pair))
            up_held.append([x for h in held[i: i + 2] for x in h])
        nodes, held = up, up_held
    return nodes[0], ways


def _manifest(rows) -> Counter:
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, below = [], {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
        root, ways = _climb([_leaf(r) for r in groups[g]])
        subs.append(root)
        below[g] = ways
    root, above = _climb(subs)
    out = Counter()
    for k, g in enumerate(order):
        for r, way in zip(groups[g], below[g], strict=True):
            way = [*way, *above[k]]
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = _leaf(r, int(bad))
            for sibling, side in way:
                node = _h(sibling, node) if side == "L" else _h(node, sibling)
            out[(r["doc_id"], _leaf(r), subs[k], root, _h(*[s for s, _ in way]), node, node == root)] += 1
    return out


@pytest.mark.parametrize("n,langs", [(0, 1), (1, 1), (2, 1), (5, 5), (83, 3), (2500, 2)])
def test_manifest_equals_plain_tree(spark, n, langs):
    names = [None, "de", "a.b", "é", ""]
    rows = [(None if i % 41 == 40 else i // 2 if i % 10 == 3 else i, None if i % 5 == 0 else f"s{i}", names[i % langs if i % 3 else 0],
             None if i % 11 == 0 else i * 3, None if i % 13 == 0 else "ü" * (i % 7), "x", 1) for i in range(n)]
    docs = spark.createDataFrame(rows + rows[: n // 20], DOCS)
    got = Counter(tuple(r) for r in merkle.op11_digest(docs).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())
    want = _manifest([r.asDict() for r in docs.collect()]) if n else Counter()
    assert got == want
    if n > 20:
        assert {v[6] for v in got} == {True, False}


def test_manifest_of_the_largest_number(spark):
    docs = spark.createDataFrame([(7, "s", "en", 2 ** 63 - 1, "x" * 200_000, "", 0), (11, "s", "en", 1, "", "", 0)], DOCS)
    assert merkle.op11_digest(docs).count() == 2


def _words(rows) -> Counter:
    n: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return Counter({w: c for w, c in n.items() if len(w) >= 7 and c >= 2})


def _near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(n: dict) -> dict:
    out = {}
    for w in n:
        near = [v for v in n if _near(v, w)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = [form, None, n[w], len(near), n[form] if form else None]
    for w in n:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def _found(df) -> dict:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_variants_equal_all_pairs(spark):
    import random

    rnd = random.Random(5)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(6, 11))) for _ in range(150)]
    texts = [" ".join(rnd.choice(base[:12] if rnd.random() < 0.8 else base) for _ in range(rnd.randrange(60))) for _ in range(200)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    rows += [(1, None), (2, ""), (3, "Straße×x÷aaaaaaa STRASSEN aaaaaaaa aaaaaaa AAAAAAAA " * 30), (4, "1,2;x"), (5, "wortende " * 20_000)]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, key string, n int")
    words = _words(rows)
    got = _found(spelling.op12_variants(docs))
    assert got == _variants(words)
    assert any(v[0] for v in got.values()) and any(v[3] == 0 for v in got.values())


def test_every_single_edit_is_found(spark):
    """Each kind of edit at each place of words of several lengths."""
    n = {}
    for w in ("abcdefg", "hijklmno", "pqrstuvwx", "aaaaaaaaaaaa"):
        n[w] = 5000
        for i in range(len(w) + 1):
            n[w[:i] + "y" + w[i:]] = 3
            if i < len(w):
                n[w[:i] + "z" + w[i + 1:]] = 2
                n.setdefault(w[:i] + w[i + 1:], 2)
    n = {w: c for w, c in n.items() if len(w) >= 7}
    df = spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, key string")
    got = _found(spelling.variants(df))
    assert got == _variants(n)


def test_roots_follow_long_chains(spark):
    words = ["a" * i + "b" * (9 - i) for i in range(8)]
    n = {w: 2 * 10 ** i for i, w in enumerate(words)}
    got = _found(spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == _variants(n) and got[words[0]][1] == words[-1]


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.op12_variants(docs).collect() == []


ODD = ["", "a", " ", "\n", "  two  spaces ", "a\n\nb", "\ta b\r\n c", "it's we'll I'D 'tis", "x<|endoftext|> y <|endoftext|><|endof", "ÀÉ中文 12３ ²½", "\x1c\x85　a b",
       "é � \U0001f600‍", "a" * 3000 + " " + "ab" * 2000, "word. " * 50, "-" * 200, "".join(chr(c) for c in range(1, 0x600)),
       " ".join(chr(c) + "a" + chr(c) for c in range(0x600, 0x3100))]


def _ids(b) -> list[int]:
    return list(struct.unpack(f"<{len(b) // 4}I", b))


def test_ids_and_texts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = [(i, t, "x", i) for i, t in enumerate([None, *ODD, *ODD])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, ids long")
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, path).collect()}
    two = {r["doc_id"]: r["decoded"] for r in bpe.decode(bpe.encode(docs, path), path).collect()}
    assert bpe.encode(docs, path).columns == ["doc_id", "text", "a.b", "ids"]
    digest = {r["doc_id"]: r for r in bpe.op13_digest(docs, path).collect()}
    for i, t, _, _ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        assert _ids(got[i]["ids"]) == ids and got[i]["decoded"] == text == two[i]
        d = digest[i]
        assert (d["n_tokens"], d["ids_sha256"], d["decoded_sha256"]) == (
            len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.op13_digest(docs.where(F.lit(False)), path).collect() == []
    with pytest.raises(ValueError, match="another name"):
        bpe.decode(docs, path, ids="ids", out="ids")


def test_scan_and_heap_make_the_same_merges():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.text(alphabet="aeinst hlé中", min_size=1, max_size=15).map(str.encode), min_size=1))
    def same(words):
        got = codec.scan(words)
        assert all(got[w] == codec.heap(w) for w in words)

    same()


def test_a_full_table_changes_nothing():
    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["the quick brown fox " * 3, *ODD]
    assert bpe.Codec(path, keep=0).encode(texts) == bpe.Codec(path, short=3).encode(texts) == bpe.Codec(path).encode(texts)


def test_ids_that_are_no_text():
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = [220, 188, 127, 447, 50256, 0, 255, 250]
    assert codec.decode(struct.pack(f"<{len(ids)}I", *ids)) == tok.decode(ids, skip_special_tokens=False)
