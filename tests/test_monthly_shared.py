from conftest import SF_SMALL
from promolens.config import FIXTURE_PARAMS as P
from promolens.plans import monthly
from promolens.sources.tables import SalesTables


def test_shared_line_base_gives_same_reports(spark):
    t = SalesTables.from_testdata(spark, SF_SMALL)
    shared = monthly.monthly_reports(t, P)
    lb = monthly.line_base(t, P)
    alone = {
        "monthly_promo_sales": monthly.monthly_promo_sales(lb),
        "monthly_promo_orders": monthly.monthly_promo_orders(lb),
        "top_groups_by_month": monthly.top_groups_by_month(lb, P),
        "order_promo_flag": monthly.order_promo_flag(lb),
    }
    for name, df in alone.items():
        assert sorted(map(tuple, shared[name].collect())) == sorted(map(tuple, df.collect())), name
