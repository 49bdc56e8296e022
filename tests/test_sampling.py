import hashlib

import pytest
from pyspark.sql import functions as F

from promolens.operators import sampling


def _md5(seed, i):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(f"p{i}", 1 if i % 9 == 0 else 0) for i in range(5000)]
    return spark.createDataFrame(rows, "ProposalID string, label int")


def test_smallest_by_hash_equals_sort(spark, frame, monkeypatch):
    monkeypatch.setattr(sampling, "SMALL", 5)  # force the multi-level refinement
    quotas = {0: (700, 4444), 1: (100, 556)}
    got = {r["ProposalID"] for r in sampling.smallest_by_hash(frame, "label", quotas, "ProposalID", 42)
           .where(F.col("_in")).collect()}
    want = set()
    for lab, q in ((0, 700), (1, 100)):
        ids = [f"p{i}" for i in range(5000) if (1 if i % 9 == 0 else 0) == lab]
        want |= set(sorted(ids, key=lambda x: _md5(42, x))[:q])
    assert got == want


def test_balanced_sample_counts(spark, frame):
    s = sampling.balanced_sample(frame, "label", "ProposalID", neg_ratio=5, seed=42)
    c = sampling.class_counts(s, "label")
    assert c == {1: 556, 0: 2780}
    capped = sampling.balanced_sample(frame, "label", "ProposalID", neg_ratio=5, seed=42, cap=1000)
    assert capped.count() == 1000


def test_no_positive_raises(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "ProposalID string, label int")
    with pytest.raises(ValueError, match="rejected"):
        sampling.balanced_sample(df, "label", "ProposalID")


def test_stratified_split_exact(spark, frame):
    s = sampling.stratified_split(frame, "label", "ProposalID", 0.2)
    c = {(r["label"], r["split"]): r["n"] for r in s.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert c[(0, "test")] + c[(1, "test")] == 1000
    assert c[(1, "test")] == 111 and c[(0, "test")] == 889


def test_oversample_to_parity(spark, frame):
    o = sampling.oversample(frame, "label", "ProposalID")
    c = sampling.class_counts(o, "label")
    assert c[0] == c[1] == 4444
    per_id = o.where("label = 1").groupBy("ProposalID").count().agg(F.min("count"), F.max("count")).first()
    assert (per_id[0], per_id[1]) == (7, 8)


def test_balanced_weights():
    w = sampling.balanced_weights({0: 300, 1: 100})
    assert w == {0: 400 / 600, 1: 400 / 200}


def test_duplicated_ids_terminate(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SMALL", 3)
    rows = [("same", 0)] * 40 + [(f"x{i}", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "ProposalID string, label int")
    s = sampling.smallest_by_hash(df, "label", {0: (35, 70)}, "ProposalID", 42)
    got = s.where("_in").count()
    assert got >= 35  # identical keys are taken together
