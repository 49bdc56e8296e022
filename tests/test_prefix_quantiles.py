import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from promolens.functions.hashing import hash_key
from promolens.operators.prefix import range_partitioned, running_sums
from promolens.operators.quantiles import exact_quantiles


def _data(spark, n=3000, hot_share=0.34, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0.5 if rnd.random() < hot_share else round(rnd.random(), 3)  # one value holds ~a third
        rows.append((f"id{i}", k, rnd.randint(0, 9)))
    return spark.createDataFrame(rows, "id string, k double, v int").withColumn("tie", hash_key(F.col("id"), "t"))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("parts", [1, 30])
def test_running_sums_equal_plain_window(spark, descending, parts):
    df = _data(spark)
    order = [F.desc("k") if descending else F.asc("k"), F.asc("tie")]
    got = running_sums(df, order, {"s": F.col("v"), "n": F.lit(1)}, parts=parts)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"ws": F.sum("v").over(w), "wn": F.count(F.lit(1)).over(w)})
    j = got.join(want.select("id", "ws", "wn"), "id")
    assert j.count() == 3000
    assert j.where((F.col("cum_s") != F.col("ws")) | (F.col("cum_n") != F.col("wn"))).count() == 0


def test_ranges_stay_small_with_a_hot_value(spark):
    # one value holds 90 % of the rows; the tie-break cuts it like any other
    ranged = range_partitioned(_data(spark, n=4000, hot_share=0.9), [F.asc("k"), F.asc("tie")], parts=20)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 3 * 4000 / 20


def test_running_sums_of_nothing(spark):
    assert running_sums(_data(spark, n=5).where("v < 0"), [F.asc("k")], {"n": F.lit(1)}).count() == 0


def test_exact_quantiles_ignore_infinities_and_span_any_range(spark):
    big = 1.7e308
    rows = [(v, big if i % 2 else -big) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, float("inf"), float("-inf"), float("nan")])]
    got = exact_quantiles(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], [0.0, 0.5, 1.0], bins=4, small=1)
    assert got == {"a": [1.0, 2.5, 4.0], "b": [-big, -big, big]}


def test_exact_quantiles_match_numpy(spark):
    rnd = np.random.default_rng(3)
    vals = np.concatenate([rnd.normal(0, 1, 5000), np.full(3000, 2.5), rnd.exponential(10, 2000)])
    rows = [(float(v), float(v) * 3 if i % 7 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.01, 0.25, 0.5, 0.99]
    got = exact_quantiles(df, ["a", "b"], probs, bins=16, small=50)  # force several refinement passes
    for c, col in (("a", [r[0] for r in rows]), ("b", [r[1] for r in rows if r[1] is not None])):
        want = np.quantile(np.array(col), probs)  # NumPy 'linear', as pandas
        assert got[c] == [float(x) for x in want]


def test_exact_quantiles_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}


def test_running_sums_independent_of_partitioning(spark):
    df = _data(spark, n=1500)
    results = []
    for parts in (1, 7, 23):
        got = running_sums(df.repartition(parts), [F.asc("k"), F.asc("tie")], {"s": F.col("v")}, parts=9)
        results.append(sorted((r["id"], r["cum_s"]) for r in got.collect()))
    assert results[0] == results[1] == results[2]
