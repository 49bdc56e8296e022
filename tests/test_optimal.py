import random

import pytest
from test_knapsack import _brute, _frame

from promolens.operators.optimal import select_optimal


def _table(items, budget):
    """Best profit by a table over whole costs."""
    best = [0.0] * (int(budget) + 1)
    for _, a, c, p in items:
        v, c = p * a - c, int(c)
        if v > 0 and c <= budget:
            for w in range(int(budget), c - 1, -1):
                best[w] = max(best[w], best[w - c] + v)
    return best[-1]


def _holds(r, budget):
    chosen = [x for x in r.selection.collect() if x["selected"] == 1]
    tot = r.totals.first()
    assert sum(x["Cost"] for x in chosen) <= budget + 1e-6
    assert sum(x["expected_profit"] for x in chosen) == pytest.approx(r.total_profit, abs=1e-4)
    assert sum(x["Cost"] for x in chosen) == pytest.approx(r.total_cost, abs=1e-4)
    assert tot["selected_count"] == len(chosen)
    return tot


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    items = [(f"p{i}", rnd.uniform(50, 500), rnd.uniform(10, 300), rnd.random()) for i in range(15)]
    r = select_optimal(_frame(spark, items), 600.0)
    assert r.proven and r.total_profit == pytest.approx(_brute(items, 600.0), abs=1e-4)
    assert _holds(r, 600.0)["gap"] == pytest.approx(0, abs=0.011)


def test_strongly_correlated(spark):
    """Profit close to a fixed sum above the cost: the greedy choice is not the best one."""
    rnd = random.Random(5)
    items = [(f"p{i:03d}", 2.0 * c + 10, float(c), 1.0) for i in range(60) for c in [rnd.randint(20, 99)]]
    r = select_optimal(_frame(spark, items), 1111.0)
    assert r.proven and r.total_profit == pytest.approx(_table(items, 1111), abs=1e-4)
    _holds(r, 1111.0)


def test_ties_are_bundles(spark):
    """Three kinds of proposal, 200 of each: a few bundles, and whole classes are cut by id."""
    items = [(f"{kind}{i:03d}", a, c, 1.0) for kind, a, c in [("x", 19.0, 7.0), ("y", 29.0, 11.0), ("z", 33.0, 13.0)] for i in range(200)]
    r = select_optimal(_frame(spark, items), 1001.0)
    assert r.core <= 24
    assert r.proven and r.total_profit == pytest.approx(_table(items, 1001), abs=1e-4)
    _holds(r, 1001.0)


def test_stopped_search_reports_its_gap(spark):
    rnd = random.Random(5)
    items = [(f"p{i:03d}", 2.0 * c + 10, float(c), 1.0) for i in range(60) for c in [rnd.randint(20, 99)]]
    best = _table(items, 1111)
    r = select_optimal(_frame(spark, items), 1111.0, max_steps=1)
    tot = _holds(r, 1111.0)
    assert not r.proven and r.total_profit <= best + 1e-6 <= tot["lp_bound"] + 2e-6


def test_edges(spark):
    free = [("free", 10.0, 0.0, 1.0), ("dear", 1e6, 5000.0, 1.0), ("a", 100.0, 40.0, 1.0)]
    r = select_optimal(_frame(spark, free), 100.0)
    assert r.proven and {x["ProposalID"] for x in r.selection.collect() if x["selected"] == 1} == {"free", "a"}
    assert select_optimal(_frame(spark, [("x", 10.0, 50.0, 0.5)]), 100.0).total_profit == 0.0


def test_the_price_is_found_without_another_shuffle(spark, monkeypatch):
    """The candidates lie in ranges of their order already: only the greedy walk and the bundles are dealt anew."""
    from promolens.operators import optimal

    dealt = []
    real = optimal.running_sums
    monkeypatch.setattr(optimal, "running_sums", lambda df, *a, **k: dealt.append(df.columns) or real(df, *a, **k))
    rnd = random.Random(3)
    items = [(f"p{i}", rnd.uniform(50, 500), rnd.uniform(10, 300), rnd.random()) for i in range(15)]
    r = select_optimal(_frame(spark, items), 600.0)
    assert r.proven and r.total_profit == pytest.approx(_brute(items, 600.0), abs=1e-4)
    assert not [c for c in dealt if c == ["_pos", "_c", "_p"]]
