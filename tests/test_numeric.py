import math

from pyspark.sql import functions as F

from promolens.functions.numeric import clip, coerce_numeric, nan_inf_to_null, safe_ratio

# dirty text -> expected value with the floor, and without
CASES = [
    ("1234.5", 1234.5, 1234.5),
    ("$1,234.50", 1234.5, 1234.5),
    ("12,5", 12.5, 12.5),
    ("1,234", 1.234, 1.234),
    ("1.234,50", 1.2345, 1.2345),
    ("1,234,567", None, None),
    ("1e5", 15.0, 15.0),
    ("(5)", 5.0, 5.0),
    ("-5", None, -5.0),
    ("1-05", None, None),
    ("", None, None),
    ("-", None, None),
    (".", None, None),
    (None, None, None),
    ("5.", 5.0, 5.0),
    ("  42 ", 42.0, 42.0),
    ("0.00001", 0.00001, 0.00001),
]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, s string")
    rows = {r["i"]: (r["a"], r["b"]) for r in df.select(
        "i", coerce_numeric(F.col("s"), floor_zero=True).alias("a"),
        coerce_numeric(F.col("s"), floor_zero=False).alias("b")).collect()}
    for i, (text, floored, raw) in enumerate(CASES):
        a, b = rows[i]
        assert (a is None and floored is None) or math.isclose(a, floored), (text, a, floored)
        assert (b is None and raw is None) or math.isclose(b, raw), (text, b, raw)


def test_safe_ratio_and_inf(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (None, 1.0), (float("inf"), 1.0), (float("nan"), 1.0)],
                               "a double, b double")
    out = df.select(safe_ratio(F.col("a"), F.col("b")).alias("r"), nan_inf_to_null(F.col("a")).alias("n")).collect()
    assert [r["r"] for r in out] == [None, 0.5, None, None, None]
    assert [r["n"] for r in out] == [1.0, 1.0, None, None, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5.0, 0.5, 7.0]], "x double")
    out = [r["c"] for r in df.select(clip(F.col("x"), 0.0, 1.0).alias("c")).collect()]
    assert out == [None, 0.0, 0.5, 1.0]


def _rule(text):
    """Plain-Python statement of the dirty-number rule, for comparison."""
    import re
    if text is None:
        return None
    s = re.sub(r"[^0-9,.\-]", "", text.strip())
    if "," in s and "." not in s:
        s = s.replace(",", ".")
    s = s.replace(",", "")
    if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", s):
        return None
    return float(s)


def test_coerce_matches_rule_on_random_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = []

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet="0123456789,.-$ ()eE", max_size=12))
    def collect(t):
        texts.append(t)

    collect()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: r["v"] for r in df.select("i", coerce_numeric(F.col("s")).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = _rule(t)
        assert (got[i] is None and want is None) or (got[i] is not None and want is not None
                                                     and math.isclose(got[i], want)), (t, got[i], want)
