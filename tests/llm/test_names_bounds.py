"""Names of columns that an operator also uses, and what lies beyond former bounds."""

import pytest
from pyspark.sql import functions as F

from promolens.llm import cotraining, jaccard_join, pii

ODD = ["__k1", "__k2", "__lang", "__source", "a.b", "k1", "class", "in0", "redacted", "t"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"write to me at user{i}@mail.example.com today, friend number {i % 7} of the many", "en", "src", *[f"{c}{i}" for c in range(len(ODD))])
            for i in range(40)]
    return spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in ODD))


def _kept(df):
    return sorted(tuple(r) for r in df.select("doc_id", *[F.col(f"`{c}`") for c in ODD]).collect())


def test_redact_keeps_all_columns(docs):
    out = pii.redact(docs)
    assert out.columns == docs.columns and _kept(out) == _kept(docs)
    assert all("<email>" in r["text"] for r in out.collect())


def test_one_per_class_keeps_all_columns(docs):
    out = jaccard_join.one_per_class(docs)
    assert out.columns == docs.columns and _kept(out) == sorted(set(_kept(docs)))


def test_classify_keeps_all_columns(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = cotraining.classify(docs, cotraining.fit(docs, labels))
    assert out.columns == [*docs.columns, "text_score", "page_score", "score", "kept"] and _kept(out) == _kept(docs)


def test_cue_far_away_and_long():
    long = "w" * 300
    text = "the code" + " " * 500 + "ab12cd34 then " + long + "x 55667788 then " + long + "y 55667799"
    found = {s: p for _, _, _, s, p in pii.mentions(text)}
    assert found["ab12cd34"] == ["the code", "code"]
    assert found["55667788"][1] != found["55667799"][1]


def test_long_strings_are_told_apart():
    one, two = (s for _, _, _, s, _ in pii.mentions("a " + "1" * 400 + "x b " + "1" * 400 + "y"))
    assert one != two and len(one) <= 256


def test_labelled_ids_that_repeat(spark):
    base = [(i, f"good plain words of text {i}" if i % 2 else f"BUY NOW !!! {i} $$$", "en", "s") for i in range(60)]
    docs = spark.createDataFrame(base + [base[1]] * 500, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    model = cotraining.fit(docs, labels, fit_rows=80)
    assert cotraining.classify(docs, model).where("kept").count() >= 500
