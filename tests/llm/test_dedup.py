"""Repeated windows, Jaccard join and vector near-duplicates against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from promolens.llm import jaccard_join, pq_dedup, windows
from promolens.llm.common import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def texts(seed, n):
    """Documents with copies, shared passages, near copies and odd ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    out = [None, "", " \t\n ", "one", "one", "one two three", "x " * 120, "ab cd " * 80, "ONE two\x0bthree\x1cfour five six"]
    base = [[word() for _ in range(rng.randint(5, 160))] for _ in range(n)]
    for i, w in enumerate(base):
        kind = i % 6
        if kind == 1:
            w = base[i - 1]
        elif kind == 2:
            w = [x if rng.random() > 0.02 else word() for x in base[i - 2]]
        elif kind == 3:
            cut = rng.randrange(len(w))
            w = w[:cut] + passage + w[cut:]
        out.append(rng.choice([" ", "  ", "\n"]).join(w) if kind != 4 else " ".join(w).upper())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "noise", -1) for i, t in rows], "doc_id long, text string, k1 string, n long").repartition(5)


def removed(rows, size):
    split = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i: i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i: i + size])] > 1:
                gone[i: i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(doc_id), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size", [35, 9, 4])
def test_windows(spark, size):
    rows = list(enumerate(texts(size, 60)))
    rows += [rows[12], rows[12], (None, rows[14][1]), (None, None)]  # repeated rows and null ids
    got = windows.remove_repeats(frame(spark, rows), size).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in got) == removed(rows, size)


def test_windows_empty(spark):
    assert windows.remove_repeats(frame(spark, [(1, "a b")]).where("doc_id < 0")).collect() == []


def fold(t):
    return WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))


def sets_of(rows, k):
    out = []
    for _, t in rows:
        w = fold(t)
        out.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def linked(sets, num, den):
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]


@pytest.mark.parametrize("k,num,tile", [(4, 85, 4096), (5, 80, 4096), (2, 50, 3)])
def test_jaccard(spark, monkeypatch, k, num, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)  # 3: groups are cut into pairs of blocks
    rows = list(enumerate(texts(k + num, 70)))
    rows += [rows[12], (rows[13][0], "other words here now and then")]  # a repeated row, an id with two texts
    sets = sets_of(rows, k)
    root = roots(range(len(rows)), linked(sets, num, 100))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root[i]] = min(d, least.get(root[i], d))
    got = jaccard_join.classes(frame(spark, rows), k, num, 100).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted((d, len(sets[i]), least[root[i]]) for i, (d, _) in enumerate(rows))


def test_jaccard_null_ids_and_empty(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, "a b c d e f"), (8, "")]
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(frame(spark, rows), 4, 85).collect())
    assert got == sorted([("None", 3, 7), ("None", 3, 7), ("None", 0, None), ("7", 3, 7), ("8", 0, 8)], key=lambda r: (r[0], r[1]))
    assert jaccard_join.classes(frame(spark, rows).where("doc_id = 0")).collect() == []


def test_one_per_class(spark):
    rows = list(enumerate(texts(3, 60))) + [(5, "one two three"), (None, "one"), (None, None)]
    sets = sets_of(rows, 5)
    root = roots(range(len(rows)), linked(sets, 80, 100))
    out = jaccard_join.one_per_class(frame(spark, rows), 5, 80)
    assert out.columns == ["doc_id", "text", "k1", "n"]
    want, seen = [], {}
    for i, (d, t) in enumerate(rows):
        if not sets[i]:
            want.append((str(d), t))
        else:
            seen.setdefault(root[i], []).append((d is None, d or 0, str(d), t))
    ids = sorted([w[0] for w in want] + [min(v)[2] for v in seen.values()])
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ids


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in roots({x for e in edges for x in e}, edges).items()}


def vectors(seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(400):
        v = rng.normal(size=16)
        out += [(len(out), v, i % 3)]
        if i % 4 == 0:
            out.append((len(out), v + rng.normal(size=16) * rng.choice([0.03, 0.15, 0.4]), i % 3))
        if i % 9 == 0:
            out += [(len(out) + k, v, (i + k) % 3) for k in range(4)]
    rows = [(i, [float(x) for x in v], c) for i, v, c in out]
    n = len(rows)
    return rows + [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [0.0] * 16, 1), (n + 4, [math.nan] + [1.0] * 15, 0), (n + 5, [math.inf] + [1.0] * 15, 0),
                   (n + 6, [None] + [1.0] * 15, 0), (n + 7, rows[0][1], None), (n + 8, rows[0][1], None), (n + 9, [1.0, 2.0], 0), (n + 10, [2.0, 4.0], 0), rows[4]]


@pytest.mark.parametrize("block", [2048, 4])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(pq_dedup, "BLOCK", block)  # 4: lists are cut into tiles
    rows = vectors(5)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n string").repartition(3)
    good = [v is not None and len(v) and c is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, c in rows]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i], rows[j]
            if good[i] and good[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.93:
                    pairs.append((i, j))
    root = roots(range(len(rows)), pairs)
    least = {}
    for i, r in enumerate(rows):
        least[root[i]] = min(r[0], least.get(root[i], r[0]))
    degree = Counter(x for p in pairs for x in p)
    got = pq_dedup.near_duplicates(df, 0.93).collect()
    want = sorted((r[0], degree[i], least[root[i]]) for i, r in enumerate(rows))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want  # recall 1 here
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_vectors_empty(spark):
    assert pq_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
