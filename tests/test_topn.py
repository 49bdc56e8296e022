from pyspark.sql import functions as F

from promolens.operators.topn import rank_filter, top_k_through_joins


def test_rank_ties_keep_extra_rows(spark):
    rows = [("m1", "g1", 70.0), ("m1", "g2", 60.0), ("m1", "g3", 50.0), ("m1", "g4", 40.0),
            ("m1", "g5", 30.0), ("m1", "g6", 30.0), ("m1", "g7", 30.0), ("m2", "g1", 1.0)]
    df = spark.createDataFrame(rows, "m string, g string, r double")
    got = rank_filter(df, ["m"], [F.desc("r")], 5).where("m = 'm1'").collect()
    assert len(got) == 7  # three groups tie at rank 5
    assert sorted(x["rnk"] for x in got) == [1, 2, 3, 4, 5, 5, 5]


def test_top_k_through_joins_widens(spark):
    fact = spark.createDataFrame([(i, float(i), i % 50) for i in range(2000)], "id long, v double, k long")
    # only keys divisible by 7 survive the join: the first candidate set is too small
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 50, 7)], "k long, name string")
    got = top_k_through_joins(fact, [F.desc("v"), F.asc("id")], 10, lambda c: c.join(dim, "k"), start=16)
    want = fact.join(dim, "k").orderBy(F.desc("v"), F.asc("id")).limit(10)
    assert [r["id"] for r in got.collect()] == [r["id"] for r in want.collect()]
