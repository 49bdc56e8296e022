import itertools
import random

import pytest

from promolens.operators.knapsack import select_within_budget


def _frame(spark, items):
    return spark.createDataFrame(items, "ProposalID string, ProposalAmount double, Cost double, accept_prob double")


def _brute(items, budget):
    best = 0.0
    pos = [(i, p * a - c, c) for i, a, c, p in items if p * a - c > 0 and c <= budget]
    for r in range(len(pos) + 1):
        for combo in itertools.combinations(pos, r):
            if sum(c for _, _, c in combo) <= budget:
                best = max(best, sum(v for _, v, _ in combo))
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_selection_properties_and_brute_force(spark, seed):
    rnd = random.Random(seed)
    items = [(f"p{i}", rnd.uniform(50, 500), rnd.uniform(10, 300), rnd.random()) for i in range(14)]
    budget = 600.0
    r = select_within_budget(_frame(spark, items), budget)
    rows = r.selection.collect()
    chosen = [x for x in rows if x["selected"] == 1]
    assert all(x["expected_profit"] > 0 for x in rows)
    assert sum(x["Cost"] for x in chosen) <= budget + 1e-6
    opt = _brute(items, budget)
    tot = r.totals.first()
    assert r.total_profit <= opt + 1e-6  # totals table is in cents
    assert opt <= tot["lp_bound"] + 1e-6          # the bound really bounds
    assert r.total_profit >= opt / 2 - 1e-6   # 1/2-approximation guard


def test_monotone_in_budget(spark):
    rnd = random.Random(9)
    items = [(f"p{i}", rnd.uniform(50, 500), rnd.uniform(10, 300), rnd.random()) for i in range(40)]
    df = _frame(spark, items)
    profits = [select_within_budget(df, b).total_profit for b in (100.0, 500.0, 2000.0, 1e9)]
    assert profits == sorted(profits)


def test_edge_items(spark):
    items = [
        ("free", 100.0, 0.0, 0.5),      # zero cost: always chosen
        ("loss", 100.0, 90.0, 0.1),     # profit <= 0: never a candidate
        ("dear", 1e6, 5000.0, 0.9),     # dearer than the budget
        ("a", 100.0, 40.0, 0.9),
        ("b", 100.0, 40.0, 0.9),        # equal efficiency
    ]
    r = select_within_budget(_frame(spark, items), 100.0)
    sel = {x["ProposalID"]: x["selected"] for x in r.selection.collect()}
    assert "loss" not in sel
    assert sel["free"] == 1 and sel["dear"] == 0 and sel["a"] == 1 and sel["b"] == 1


def test_empty_frame(spark):
    r = select_within_budget(_frame(spark, [("x", 10.0, 50.0, 0.5)]), 100.0)
    assert r.selection.count() == 0
    assert r.total_profit == 0.0 and r.totals.first()["selected_count"] == 0


def test_fills_until_nothing_fits(spark):
    # halves of halves: every round leaves a little less, 34 proposals need more rounds than ten
    items, size, i = [], 1 << 20, 0
    while size >= 16:
        for cost in (size // 2 + 1, size // 2):
            items.append((f"p{i:02d}", cost * (3.0 - 0.01 * i), float(cost), 1.0))
            i += 1
        size //= 2
    budget = float(1 << 20)
    r = select_within_budget(_frame(spark, items), budget)
    rows = r.selection.collect()
    left = budget - sum(x["Cost"] for x in rows if x["selected"] == 1)
    assert left >= 0 and all(x["Cost"] > left for x in rows if x["selected"] == 0)
    order = sorted(rows, key=lambda x: (-x["profit_per_cost"], -x["expected_profit"], x["ProposalID"]))
    want, room = set(), budget
    for x in order:  # the rounds are the plain greedy walk
        if x["Cost"] <= room:
            want.add(x["ProposalID"])
            room -= x["Cost"]
    assert {x["ProposalID"] for x in rows if x["selected"] == 1} == want


def test_fills_after_the_single_best(spark):
    items = [("small", 12.0, 1.0, 1.0), ("big", 200.0, 95.0, 1.0), ("rest", 6.0, 5.0, 1.0), ("more", 5.5, 5.0, 1.0)]
    r = select_within_budget(_frame(spark, items), 100.0)
    # greedy takes small and is left without big; big alone is worth more, and rest still fits beside it
    assert {x["ProposalID"] for x in r.selection.collect() if x["selected"] == 1} >= {"big"}
    left = 100.0 - r.total_cost
    assert all(x["Cost"] > left for x in r.selection.collect() if x["selected"] == 0)


def test_ranking_by_efficiency_profit_id(spark):
    items = [(f"f{i}", 10.0 + i // 2, 0.0, 1.0) for i in range(20)]  # all free: profit decides, then the id
    from promolens.operators.knapsack import top_candidates

    assert [r["ProposalID"] for r in top_candidates(_frame(spark, items), 3).collect()] == ["f18", "f19", "f16"]
    r = select_within_budget(_frame(spark, items), 10.0, top_n=3)
    assert {x["ProposalID"] for x in r.selection.collect()} == {"f16", "f18", "f19"}


def test_ids_must_be_unique(spark):
    with pytest.raises(ValueError, match="unique"):
        select_within_budget(_frame(spark, [("a", 10.0, 1.0, 0.9), ("a", 11.0, 1.0, 0.9)]), 10.0)


def test_candidate_cap_keeps_most_efficient(spark):
    items = [(f"p{i}", 100.0, float(10 + i), 0.9) for i in range(20)]  # efficiency falls with i
    r = select_within_budget(_frame(spark, items), 1e6, top_n=5)
    ids = {x["ProposalID"] for x in r.selection.collect()}
    assert ids == {f"p{i}" for i in range(5)}


def _plain_walk(items, budget):
    """Best first by profit per cost, profit, id; taken while it fits."""
    rows = sorted(((-(p * a - c) / c if c else -float("inf")), -(p * a - c), i, c) for i, a, c, p in items if p * a - c > 0 and c <= budget)
    out, left = set(), budget
    for _, _, i, c in rows:
        if c <= left:
            out.add(i)
            left = round(left - c, 6)
    return out


def _steps(caplog):
    return [int(r.message.split(" steps")[0].split()[-1]) for r in caplog.records if "steps" in r.message]


def test_blockers_cost_no_steps(spark, caplog):
    """Costs 1, L, 1, L - 1, 1, L - 2, ... with falling efficiency: one blocker after every proposal that fits."""
    budget, items = 1000, []
    for i in range(100):
        items.append((f"a{i:03d}", 1.0 * (3000 - 2 * i) / 1000, 1.0, 1.0))
        items.append((f"b{i:03d}", (budget - i) * (2999 - 2 * i) / 1000, float(budget - i), 1.0))
    with caplog.at_level("INFO", logger="promolens.operators.knapsack"):
        r = select_within_budget(_frame(spark, items), float(budget))
    assert _steps(caplog) and max(_steps(caplog)) <= 11
    chosen = {x["ProposalID"] for x in r.selection.collect() if x["selected"] == 1}
    best = max(items, key=lambda x: (x[1] - x[2]))[0]
    rest = _plain_walk([x for x in items if x[0] != best], budget - next(x[2] for x in items if x[0] == best))
    assert chosen in (_plain_walk(items, budget), {best} | rest)


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_choice_equals_a_plain_walk(spark, seed):
    rnd = random.Random(seed)
    items = [(f"p{i:03d}", c * rnd.choice([1.5, 2.0, 2.5]), c, 1.0) for i in range(250) for c in [float(rnd.choice([0, 1, 2, 3, 5, 8, 40, 90, 200, 333, 480]))]]
    budget = float(rnd.choice([777, 1500, 4000]))
    r = select_within_budget(_frame(spark, items), budget)
    assert {x["ProposalID"] for x in r.selection.collect() if x["selected"] == 1} == _plain_walk(items, budget)
