"""Hot keys: one customer with a third of all orders, one order with many
lines. Results must equal a plain Python computation."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.plans.proposals import customer_metrics, proposals
from promolens.sources.tables import SalesTables


def _tables(spark):
    rnd = random.Random(3)
    headers, lines = [], []
    for o in range(600):
        cust = 7 if o % 3 == 0 else rnd.randint(1, 50)          # customer 7 holds a third of the orders
        status = rnd.choice([1, 4, 5, 6])
        headers.append((o, dt.datetime(2013, 1, 1) + dt.timedelta(days=rnd.randint(0, 700)), cust, 1, status))
        for ln in range(200 if o == 5 else rnd.randint(1, 4)):   # order 5 is a hot order
            qty = rnd.randint(1, 5)
            price = Decimal(rnd.randint(100, 9999)) / 100
            disc = Decimal(rnd.choice([0, 5, 10])) / 100
            lines.append((o, f"{o}-{ln}", rnd.randint(1, 30), rnd.choice([1, 2, 3, None]), qty, price, disc,
                          price * qty * (1 - disc)))
    h = spark.createDataFrame(headers, "SalesOrderID long, OrderDate timestamp_ntz, CustomerID long, "
                                       "TerritoryID int, Status int")
    d = spark.createDataFrame(lines, "SalesOrderID long, SalesOrderDetailID string, ProductID long, "
                                     "SpecialOfferID int, OrderQty int, UnitPrice decimal(19,4), "
                                     "UnitPriceDiscount decimal(4,2), LineTotal decimal(38,6)")
    prod = spark.createDataFrame([(p, f"P{p}", f"N{p}", Decimal("10.0000"), None, None, None, p % 4 + 1)
                                  for p in range(1, 31)],
                                 "ProductID long, Name string, ProductNumber string, StandardCost decimal(19,4), "
                                 "Weight decimal(8,2), Size string, Style string, ProductSubcategoryID int")
    sub = spark.createDataFrame([(i, f"S{i}", 1) for i in range(1, 5)], "ProductSubcategoryID int, Name string, "
                                                                        "ProductCategoryID int")
    cat = spark.createDataFrame([(1, "C1")], "ProductCategoryID int, Name string")
    terr = spark.createDataFrame([(1, "T1")], "TerritoryID int, Name string")
    cust = spark.createDataFrame([(c, c if c % 2 else None) for c in range(1, 51)], "CustomerID long, StoreID long")
    offers = spark.createDataFrame([(1, dt.datetime(2013, 1, 1), None)], "SpecialOfferID long, StartDate timestamp_ntz, "
                                                                         "EndDate timestamp_ntz")
    return SalesTables(h, d, offers, prod, sub, cat, terr, cust), headers, lines


def test_customer_metrics_with_hot_customer(spark):
    t, headers, lines = _tables(spark)
    as_of = dt.date(2016, 1, 1)
    got = {r["CustomerID"]: r for r in customer_metrics(t, as_of).collect()}
    by_order = {h[0]: h for h in headers}
    want = {}
    for ln in lines:
        h = by_order[ln[0]]
        w = want.setdefault(h[2], [0, Decimal(0), 0, None])
        w[0] += 1
        w[1] += ln[7]
        w[2] += 1 if (ln[3] is not None and ln[3] != 1) else 0
        w[3] = h[1] if w[3] is None or h[1] > w[3] else w[3]
    assert set(got) == set(want)
    for c, (n, s, p, last) in want.items():
        r = got[c]
        assert r["Purchases"] == n
        assert abs(r["AvgOrderValue"] - float(s) / n) < 1e-9
        assert abs(r["PromoResponseRate"] - p / n) < 1e-12
        assert r["Recency"] == (as_of - last.date()).days


def test_lines_are_not_shuffled_on_the_customer(spark):
    """Only headers and customers move on CustomerID: no exchange on it carries a line column."""
    t, _, _ = _tables(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = proposals(t, dt.date(2016, 1, 1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    keys = [ln for ln in plan.splitlines() if "Join" in ln]
    assert any("SalesOrderID" in ln for ln in keys) and any("CustomerID" in ln for ln in keys)
    lines = plan.splitlines()
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning(CustomerID" in ln:
            depth = len(ln) - len(ln.lstrip(" :+-"))
            below = []
            for x in lines[i + 1:]:
                if len(x) - len(x.lstrip(" :+-")) <= depth:
                    break
                below.append(x)
            outputs = [x for x in below if "Project [" in x or "HashAggregate(" in x][:1] or below[:1]
            assert "SalesOrderDetailID" not in outputs[0], outputs[0]


def test_proposals_row_count_with_hot_keys(spark):
    t, headers, lines = _tables(spark)
    status = {h[0]: h[4] for h in headers}
    want = sum(1 for ln in lines if status[ln[0]] in (4, 5, 6))
    p = proposals(t, dt.date(2016, 1, 1))
    assert p.count() == want
    assert p.where(F.col("Purchases").isNull()).count() == 0
