import os

from promolens.__main__ import main
from promolens.sources.tables import SalesTables

from conftest import SF_SMALL


def test_reports_command(spark, tmp_path):
    root = str(tmp_path / "sales")
    t = SalesTables.from_testdata(spark, SF_SMALL)
    for name, df in t.items():
        df.write.mode("overwrite").parquet(os.path.join(root, name))
    out = str(tmp_path / "reports")
    main(["reports", "--tables", root, "--from-date", "1995-01-01", "--to-date", "2001-12-31", "--out", out])
    assert spark.read.parquet(os.path.join(out, "monthly_promo_sales")).count() > 0
    assert spark.read.parquet(os.path.join(out, "top_order_lines")).count() == 10
    top = str(tmp_path / "top")
    main(["sql", "--tables", root, "--out", top, "--query", "SELECT * FROM promo_top_groups(DATE'1996-01-01', DATE'1996-12-31', 3) WHERE month < 4"])
    got = spark.read.parquet(top)
    assert {r["month"] for r in got.collect()} == {1, 2, 3} and got.agg({"rnk": "max"}).first()[0] == 3
