"""Personal data, benchmark passages, quality classifier, token counts, shards, pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public = pytest.importorskip("public_tokenizers")

from promolens.llm import cotraining, decontaminate, pii, sharding, unigram

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m[0])]


@given(st.lists(st.sampled_from([*"aZ09.@-+ ()%_\né١", "a@b.c", "1.2.3.4", "255.0.0.256", "4111111111111111", "+1 (555) 010-9999", "4111 1111-1111 1111"]), max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_base_spans(text):
    assert pii.base_spans(text) == base(text)


def test_base_spans_of_long_runs():
    assert pii.base_spans("a" * 300_000 + "@" + "1" * 300_000) == []
    assert pii.base_spans("b" * 5000 + "@c.d") == [("email", 0, 5004)]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1.5) for i, t in rows], "doc_id long, text string, k1 string, start double").repartition(3)


def test_pii_bootstraps(spark):
    rows = [(i, f"note {i} reach me via mail u{i}@host{i}.org, or not") for i in range(60)]
    rows += [(100, "reach me via mail bob@localhost today"), (101, "price 12.50 at 8pm bob2@localhost"), (102, None), (103, ""), rows[0], (None, "ip 10.0.0.1 ok")]
    got = {r["doc_id"]: r for r in pii.find(documents(spark, rows)).collect()}
    text = dict(rows)
    assert got[100]["spans"] == f"email:{text[100].index('bob')}:{text[100].index(' today')}" and got[100]["n_found"] == 1 and got[100]["n_email"] == 0
    assert got[101]["n_found"] == 0 and got[101]["spans"] == "" and got[102]["spans"] == got[103]["spans"] == ""
    for i, t in rows:
        want = base(t or "")
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join("%s:%d:%d" % w for w in want).encode()).hexdigest()
    assert pii.find(documents(spark, rows)).count() == len(rows)
    out = pii.redact(documents(spark, rows))
    assert out.columns == ["doc_id", "text", "k1", "start"]
    clean = {r["doc_id"]: (r["text"], r["k1"], r["start"]) for r in out.collect()}
    assert clean[100] == ("reach me via mail <email> today", "k", 1.5) and clean[102][0] is None and clean[None][0] == "ip <ip> ok"
    assert clean[5][0] == "note 5 reach me via mail <email>, or not"
    assert pii.find(documents(spark, rows).where("doc_id = -1")).collect() == []


def test_pii_spaced_numbers(spark):
    rows = [(i, f"note {i} reach me at +4930{i:07d} soon") for i in range(30)]
    numbers = ["0171 2345678", "(555) 123-4567", "555 123 4567", "0171 / 23 45 67", "030.123 4567", "[030] 1234567"]
    rows += [(100 + i, f"note {i} reach me at {x}, or not. 12 of 1999") for i, x in enumerate(numbers)]
    rows += [(200, "note 1 reach me at 0171 2345678abc"), (201, "reach me at 0171 2345678. 2000 others"), (202, "reach me at (0171 2345678)")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(documents(spark, rows)).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(documents(spark, rows)).collect()}
    for i, x in enumerate(numbers):
        at = rows[30 + i][1].index(x)
        assert got[100 + i] == f"phone:{at}:{at + len(x)}"
        assert clean[100 + i] == f"note {i} reach me at <phone>, or not. 12 of 1999"
    assert clean[201] == "reach me at <phone>. 2000 others" and clean[202] == "reach me at (<phone>)"
    assert pii._runs("1" * 300_000 + "a " * 9 + "1 " * 100_000, []) != []


def test_pii_cues_with_many_unknown_strings(spark):
    rows = [(i, f"note {i} ring +4930{i:07d} soon") for i in range(100)]
    rows += [(1000 + i, f"note {i} ring 0301{i:06d} soon") for i in range(40)]  # 40 to 100: a mean of trust stays below 0.8
    rows += [(2000 + i, f"note {i} dial now +4931{i:07d} soon") for i in range(6)] + [(3000, "note 1 dial now 0309876543 soon")]
    rows += [(4000 + i, f"note {i} has +4932{i:07d} soon") for i in range(5)] + [(4100 + i, f"note {i} has u{i}@h{i}.org soon") for i in range(5)]
    rows += [(4200, "note 1 has 0305555555 soon")]  # two kinds behind one word
    rows += [(5000 + i, f"note {i} order +4933{i:07d} soon") for i in range(10)] + [(5100 + i, f"note {i} order A{i:06d} soon") for i in range(90)]
    got = {r["doc_id"]: r["n_found"] for r in pii.find(documents(spark, rows)).collect()}
    assert {d for d, n in got.items() if n} == {*range(1000, 1040), 3000} and max(got.values()) == 1


def distance_inside(pattern, text):
    """Fewest edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@given(st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_edit_budget(seed):
    rng = random.Random(seed)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n)).strip() or "a"
    item = letters(rng.randint(30, 200))
    known = decontaminate.Items([(1, item)])
    copy = list(item)
    for _ in range(rng.randint(0, 12)):
        at = rng.randrange(len(copy))
        what = rng.random()
        copy[at: at + 1] = [rng.choice("xyz")] if what < 0.4 else [] if what < 0.7 else [copy[at], rng.choice("xyz")]
        copy = copy or ["a"]
    text = letters(rng.randint(0, 150)) + " " + "".join(copy) + " " + letters(rng.randint(0, 150))
    raw = decontaminate.normal(text)
    within = [distance_inside(s, raw) for s in known.text]
    hits = decontaminate._places(known, [letters(80), text, "", letters(50)])
    good = [d for d, k in zip(within, known.edits, strict=True) if d <= k]
    assert ((1, 1) in hits) == bool(good) and set(hits) <= {(1, 1)}
    if good:
        assert hits[1, 1][1] == min(good)


def test_budget_is_four_edits_in_64_bytes():
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    for size, edits in ((12, 0), (23, 0), (24, 1), (36, 2), (48, 3), (64, 4)):
        assert decontaminate.Items([(1, letters(size))]).edits == [edits]
    for size in (64, 95, 400):
        item = letters(size)
        known = decontaminate.Items([(1, item)])
        for places, found in (((6, 22, 38, 54), True), ((6, 19, 32, 45, 58), False)):  # in each 64 bytes
            copy = list(item)
            for at in range(size):
                if at % 64 in places:
                    copy[at] = "X"
            hits = decontaminate._places(known, [letters(80), letters(30) + "".join(copy) + letters(30)])
            assert ((1, 1) in hits) == found and (not found or hits[1, 1][1] == 4)


def test_benchmark(spark):
    item = "The quick Brown fox jumps over the lazy dog while 27 sleepy cats watch from the tall garden wall and yawn in turn"
    rows = [(1, "x " * 50 + item.upper().replace(" ", "\n ") + " y" * 9), (2, item.replace("lazy", "lzy").replace("wall", "wa11")), (3, item[:50]), (4, None), (5, ""),
            (None, item), (1, item), (6, "z " * 30_000 + item)]
    items = spark.createDataFrame([(7, item, 0), (8, None, 0), (9, "short", 0), (None, "another item text that stands nowhere at all, not even once", 0)], "item_id long, text string, doc_id long")
    got = decontaminate.matches(documents(spark, rows), items).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in got) == sorted([("1", 7), ("1", 7), ("2", 7), ("None", 7), ("6", 7)])
    span = next(r for r in got if r["doc_id"] == 6)
    assert rows[7][1][span["start"]: span["end"]] == item and span["edits"] == 0
    assert next(r for r in got if r["doc_id"] == 2)["edits"] > 0
    left = decontaminate.without_matches(documents(spark, rows), items)
    assert left.columns == ["doc_id", "text", "k1", "start"] and sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    assert decontaminate.matches(documents(spark, rows), items.where("item_id = 0")).collect() == []
    assert decontaminate.matches(documents(spark, rows).where("doc_id = 0"), items).collect() == []


def test_benchmark_blocks(spark, monkeypatch):
    rng = random.Random(9)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared = line(14)  # stands in many items
    texts = [f"{line(5)} {shared} {line(4)}" for _ in range(30)] + [line(40) for _ in range(10)]
    items = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[35]) for i in range(25)] + [(200, None)]  # one text holds a third of the items
    rows = [(1, f"{line(20)} {shared} {line(9)}"), (2, texts[35]), (3, line(60)), (4, texts[31] + " " + texts[3]), (1, f"{line(20)} {shared}")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)

    def rows_of():
        return sorted(tuple(r) for r in decontaminate.matches(documents(spark, rows), bench).collect())

    def plain():
        out = []
        for i, t in rows:
            for item, text in items:
                hits = decontaminate._places(decontaminate.Items([(item, text)]), [t])
                out += [(i, item, *h) for h in hits.values()]
        return sorted(out)

    want = rows_of()
    assert want == plain()
    held = list(decontaminate._blocks(decontaminate._texts(bench)[0]))
    assert len(held) == 1 and len(held[0].text) == len(set(held[0].text)) and max(map(len, held[0].items)) >= 10
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 700)
    monkeypatch.setattr(decontaminate, "HITS", 5)
    blocks = [r["n"] for r in decontaminate._texts(bench)[0].selectExpr("block", "octet_length(text) AS n").groupBy("block").agg({"n": "sum"}).toDF("block", "n").collect()]
    assert len(blocks) > 5 and max(blocks) <= 700 + max(len(t) for t in texts)
    assert rows_of() == want
    assert sorted(r["doc_id"] for r in decontaminate.without_matches(documents(spark, rows), bench).collect()) == [3]


def quality_data(n, seed=2):
    rng = random.Random(seed)
    words = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "lnrst"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic, poor = rng.random() < 0.15, rng.random() < 0.15
        if toxic:
            text[rng.randrange(len(text))] = "vilestword"
        text = " ".join(f"{w.upper()}!!" for w in text) if poor else " ".join(text)
        docs.append((i, text, "en", f"s{i % 5}", len(text)))
        labels.append((i, int(not poor), int(toxic)))
    return docs, labels


DOC = "doc_id long, text string, lang string, source string, n_chars long"


def test_classifier_held_out(spark):
    docs, labels = quality_data(1500)
    frame = spark.createDataFrame(docs, DOC).repartition(4)
    model = cotraining.fit(frame, spark.createDataFrame(labels[:900], "doc_id long, quality int, toxic int"))
    odd = spark.createDataFrame([(5000, None, None, None, None), (None, "", "en", "s1", 0), (1, "plain text", "en", "s1", 10), (1, "plain text", "en", "s1", 10)], DOC)
    out = cotraining.classify(frame.unionByName(odd).withColumnRenamed("n_chars", "kept"), model)
    assert out.columns == ["doc_id", "text", "lang", "source", "text_score", "page_score", "score", "kept"]
    rows = out.collect()
    kept = {r["doc_id"]: r["kept"] for r in rows if r["doc_id"] is not None and 900 <= r["doc_id"] < 1500}
    truth = {i: bool(q and not t) for i, q, t in labels[900:]}
    assert len(rows) == 1504 and sum(kept[i] == v for i, v in truth.items()) >= 0.97 * len(truth)
    assert all(0 <= r["score"] <= 1 for r in rows)


def fit_and_taught(docs, labels, monkeypatch):
    """The model, and what each view was taught in each round."""
    seen = {}
    keep = cotraining.mixed_view

    def note(taught, known, y, name, *rest):
        seen.setdefault(name, []).append(taught.collect())
        return keep(taught, known, y, name, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(cotraining, "mixed_view", note)
        model = cotraining.fit(docs, labels)
    return model, seen


def test_exchange_is_a_share_of_the_pool(spark, monkeypatch):
    docs, labels = quality_data(3000)
    labels = spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int")
    totals = []
    for n in (1500, 3000):
        frame = spark.createDataFrame(docs[:n] + docs[700:701] * 40, DOC).repartition(4)
        _, seen = fit_and_taught(frame, labels, monkeypatch)
        assert set(seen) == {"text", "page"}
        for rounds in seen.values():
            assert all(c >= 0.02 * (n - 460) for c in Counter(r["label"] for r in rounds[0]).values())
            turns = [r["turn"] for r in rounds[-1]]
            assert len(turns) == len(set(turns)) >= len(rounds[0])  # nothing given twice
        totals.append({name: len(rounds[0]) for name, rounds in seen.items()})
    assert all(totals[1][name] >= 1.5 * totals[0][name] for name in ("text", "page"))


def test_cut_takes_whole_steps():
    assert cotraining.cut_step({}, 5) is None
    assert cotraining.cut_step({400: 3, 390: 1, 380: 9, 370: 2}, 3) == 400
    assert cotraining.cut_step({400: 3, 390: 1, 380: 9, 370: 2}, 4.5) == 380
    assert cotraining.cut_step({400: 3}, 100) == 400


def test_parts_are_averaged(spark):
    rng = np.random.default_rng(3)
    sets = [np.flatnonzero(rng.random(30) < 0.3).astype(np.uint16).tobytes() for _ in range(120)]
    y = rng.integers(0, 2, 40).astype(float)
    taught = spark.createDataFrame([(bytearray(f), i, float(i % 3 == 0)) for i, f in enumerate(sets[40:])], "text binary, turn long, label double").repartition(3)
    known = pa.table({"text": pa.array(sets[:40], pa.binary())})
    got = cotraining.mixed_view(taught, known, y, "text", 30, 40)
    views = []
    for part in (0, 1):
        own = [i for i in range(80) if i % 2 == part]
        table = pa.table({"text": pa.array(sets[:40] + [sets[40 + i] for i in own], pa.binary())})
        views.append(cotraining.fit_view(*cotraining._rows(table, "text"), np.append(y, [float(i % 3 == 0) for i in own]), 30))
    assert np.allclose(got.weights, (views[0].weights + views[1].weights) / 2) and np.isclose(got.bias, (views[0].bias + views[1].bias) / 2)
    assert cotraining.mixed_view(taught, known, y, "text", 30, 1000).weights.shape == (30,)


def test_classifier_without_labels(spark):
    docs, labels = quality_data(30)
    frame, kind = spark.createDataFrame(docs, DOC), "doc_id long, quality int, toxic int"
    for rows in ([], [(3, None, None), (None, 0, 1)], [(i, 1, 0) for i in range(5)]):
        model = cotraining.fit(frame, spark.createDataFrame(rows, kind))
        assert {(r["score"], r["kept"]) for r in cotraining.classify(frame, model).collect()} == {(1.0, True)}
    assert cotraining.classify(frame.where("doc_id < 0"), cotraining.fit(frame.where("doc_id < 0"), spark.createDataFrame(labels, kind))).collect() == []


def best_split(token, trie):
    state = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        size = len(token[end - 1].encode())
        options = [(-(state[-1][0] + size * trie.byte_score), state[-1][1] + size)]
        options += [(-(state[a][0] + trie.scores[token[a:end]]), state[a][1] + 1) for a in range(end) if token[a:end] in trie.scores]
        score, n = min(options)
        state.append((-score, n))
    return state[-1][1]


def test_token_counts(spark, monkeypatch):
    path = public.path("piece_bpe_32k.model")
    rows = [(1, "the cat and the catalogue"), (2, None), (3, " \n"), (4, "été Ünïcode 漢字 😀 x" + "y" * 500), (1, "the cat"), (None, "cats")]
    trie = unigram.Trie(unigram.zipf_scores(path))
    got = unigram.token_counts(documents(spark, rows), path).collect()
    want = sorted((str(i), len((t or "").split()), sum(best_split("▁" + w, trie) for w in (t or "").split())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_pretokens"], r["n_tokens"]) for r in got) == want
    assert unigram.token_counts(documents(spark, rows).where("doc_id = 0"), path).collect() == []
    monkeypatch.setattr(unigram, "MAX_NODES", 20)  # full at once
    monkeypatch.setattr(unigram, "MAX_ENDS", 5)
    words = [f"w{i % 17}{'ab' * (i % 5)}" for i in range(300)]
    again = unigram.count_texts([" ".join(words[i: i + 7]) for i in range(0, 300, 7)], unigram.Trie(trie.scores))
    assert [n for _, n in again] == [sum(best_split("▁" + w, trie) for w in words[i: i + 7]) for i in range(0, 300, 7)]


def test_shards(spark):
    rng = random.Random(4)
    rows = [(i, f"text {i if rng.random() < 0.7 else rng.randrange(12)}") for i in range(500)]
    rows += [(900 + i, "hot text é") for i in range(300)] + [(None, None), (1, None), (None, ""), rows[3], rows[3]]
    got = sharding.assign(documents(spark, rows), 16).collect()
    load = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and set(load) == set(range(16)) and max(load.values()) - min(load.values()) <= 1
    slots: dict = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    key = lambda i, t: (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(key(i, t) for i, t in rows)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    text, homes = {}, {}
    for i, t in rows:
        text[str(i)] = t
    for r in got:
        homes.setdefault(text[str(r["doc_id"])], []).append(r["shard"])
    small = [v for t, v in homes.items() if t and 1 < len(v) < 40]
    assert sum(len(set(v)) == 1 for v in small) >= 0.8 * len(small)  # small groups stay together
    assert sharding.assign(documents(spark, rows).where("doc_id = -1"), 16).collect() == []
    assert [r["shard"] for r in sharding.assign(documents(spark, rows[:1]), 16).collect()] == [0]


def test_pipeline(spark):
    import corpus_pipeline

    base_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base_dir}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [set(before)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, base_dir).cache()
        assert docs.columns == corpus_pipeline.COLUMNS, name
        ids.append({r["doc_id"] for r in docs.collect()})
        assert ids[-1] <= ids[-2]
    items = decontaminate.Items([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{base_dir}/benchmark.parquet").collect()])
    for r in docs.collect():
        assert not any(s in decontaminate.normal(r["text"]) for s in items.text) and not base(r["text"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, base_dir).collect()
    assert {r["doc_id"] for r in packed} == ids[-1]
    assert sorted(map(tuple, corpus_pipeline.run(spark, base_dir).collect())) == sorted(map(tuple, packed))
