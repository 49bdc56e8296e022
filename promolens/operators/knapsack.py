"""Budgeted proposal selection (0/1 knapsack) as Spark jobs.

Maximise the summed expected profit of the chosen proposals subject to
their summed cost staying within the budget. Instead of a single-machine
integer program over a capped candidate list, every candidate is ranked
by profit per unit of cost (zero cost first), then expected profit, then
id, and taken in this order if it fits what is left. The candidates are
numbered once (ranges, no single-task window); a step then does a stretch of the walk
with one aggregate over running sums, up to the further of two places:

* the first candidate with which the costs pass what is left (all before it fit);
* the first place where half of what was left is spent. Until then candidates
  of at most that half always fit, and the first dearer one that fits spends it at once.

So what is left halves with every step, however many candidates that do not fit
stand between others that do: at most log2(budget / least cost) + 1 steps. If the best single
affordable proposal is worth more than all of that, it is chosen first and
the rest is filled the same way (the classic 1/2-approximation guard). The
LP relaxation bound (prefix plus the fitting fraction of the first proposal
that did not fit) and the gap are reported with the totals.

The steps read (id, place, profit, cost) only. Costs are summed as
decimal(38,6): a double sum depends on the order of addition, which could
flip a ``cum_cost <= budget`` test.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from decimal import ROUND_DOWN, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.operators.prefix import range_partitioned, sums_in_ranges
from promolens.session import reliable_checkpoint

MONEY = T.DecimalType(38, 6)
log = logging.getLogger(__name__)


@dataclass
class SelectionResult:
    selection: DataFrame  # candidates (profit > 0) with a 0/1 ``selected`` column
    totals: DataFrame     # one row: selected_count, total_cost, total_profit, lp_bound, gap
    total_cost: float
    total_profit: float


def expected_values(df: DataFrame, amount: str = "ProposalAmount", cost: str = "Cost",
                    prob: str = "accept_prob") -> DataFrame:
    """expected_revenue = p x amount, expected_profit = revenue - cost."""
    er = F.col(prob) * F.col(amount)
    return df.withColumns({"expected_revenue": er, "expected_profit": er - F.col(cost)})


def _efficiency(cost: str) -> F.Column:
    """Profit per unit of cost; a free proposal ranks first."""
    return F.when(F.col(cost) == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("expected_profit"), F.col(cost)))


def _money_total(c: F.Column) -> F.Column:
    """Exact decimal sum, reported in cents (as the reference prints it)."""
    return F.round(F.coalesce(F.sum(c.cast(MONEY)), F.lit(0).cast(MONEY)), 2).cast("double")


def require_unique(df: DataFrame, id_col: str) -> None:
    """Fail when an id occurs twice: the choice is made by id."""
    twice = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col).first()
    if twice is not None:
        raise ValueError(f"{id_col} must be unique, but {twice[0]!r} occurs more than once")


def candidates(df: DataFrame, id_col: str = "ProposalID", cost: str = "Cost", amount: str = "ProposalAmount",
               prob: str = "accept_prob") -> DataFrame:
    """Proposals with a positive expected profit, with their profit per cost
    (NULL for free ones) and the ranking columns ``_eff, _c, _p``."""
    return (expected_values(df, amount, cost, prob)
            .where(F.col("expected_profit") > 0)
            .withColumns({"profit_per_cost": F.try_divide(F.col("expected_profit"), F.col(cost)), "_eff": _efficiency(cost),
                          "_c": F.col(cost).cast(MONEY), "_p": F.col("expected_profit").cast(MONEY)}))


def ranking(id_col: str = "ProposalID") -> list[F.Column]:
    """Best first: profit per cost, expected profit, id."""
    return [F.desc("_eff"), F.desc("expected_profit"), F.asc(id_col)]


def top_candidates(df: DataFrame, n: int, **columns) -> DataFrame:
    """The ``n`` best candidates (a top-n report)."""
    return candidates(df, **columns).orderBy(*ranking(columns.get("id_col", "ProposalID"))).limit(n).drop("_eff", "_c", "_p")


def _walk(numbered: DataFrame, budget: Decimal) -> tuple[F.Column, Decimal, Decimal, float]:
    """Takes candidates in their order while they fit: (which are taken, as a
    condition on place and cost; cost; profit; the bound of the linear relaxation)."""
    place, cost, profit = F.col("_pos"), F.col("_c"), F.col("_p")
    taken, spent, gained, bound, at, steps = F.lit(False), Decimal(0), Decimal(0), None, 0, 0
    while True:
        left = budget - spent
        half = (left / 2).quantize(Decimal("0.000001"), ROUND_DOWN)
        here = (place > F.lit(at)) & (cost <= F.lit(left))
        small = cost <= F.lit(half)
        sums = sums_in_ranges(numbered.where(here), [F.asc("_pos")], {
            "c": cost, "p": profit, "small_c": F.when(small, cost).otherwise(F.lit(0).cast(MONEY)),
            "small_p": F.when(small, profit).otherwise(F.lit(0).cast(MONEY))}, prefix="_sum_")
        over = F.col("_sum_c") > F.lit(left)
        spends = F.when(small, F.col("_sum_small_c") > F.lit(left - half - Decimal("0.000001"))).otherwise(F.col("_sum_small_c") + cost <= F.lit(left))
        row = F.struct("_pos", "_c", "_p", "_sum_c", "_sum_p", "_sum_small_c", "_sum_small_p", small.alias("small"))
        got = sums.agg(F.min(F.when(over, row)).alias("over"), F.min(F.when(spends, row)).alias("half"),
                       F.max(row).alias("last")).first()
        if got["last"] is None:
            break
        steps += 1
        stop, end = got["over"], got["half"]
        if bound is None and stop is None:
            bound = float(gained + got["last"]["_sum_p"])
        elif bound is None:
            before = left - (stop["_sum_c"] - stop["_c"])
            bound = float(stop["_sum_p"] - stop["_p"]) + float(before / stop["_c"]) * float(stop["_p"])
        if stop is None:
            taken, spent, gained = taken | here, spent + got["last"]["_sum_c"], gained + got["last"]["_sum_p"]
            break
        if end is None:  # nothing dearer fits to the end, and what is cheaper does
            taken, spent, gained = taken | (here & small), spent + got["last"]["_sum_small_c"], gained + got["last"]["_sum_small_p"]
            break
        if end["_pos"] > stop["_pos"]:
            at = end["_pos"]
            taken = taken | (here & small & (place < F.lit(at))) | (place == F.lit(at))
            spent, gained = spent + end["_sum_small_c"], gained + end["_sum_small_p"]
            if not end["small"]:
                spent, gained = spent + end["_c"], gained + end["_p"]
        else:
            at = stop["_pos"]
            taken = taken | (here & (place < F.lit(at)))
            spent, gained = spent + stop["_sum_c"] - stop["_c"], gained + stop["_sum_p"] - stop["_p"]
    log.info("selection: %d steps, %s left", steps, budget - spent)
    return taken, spent, gained, bound or 0.0


@dataclass
class Greedy:
    cand: DataFrame       # candidates with their expected values
    numbered: DataFrame   # id, _range, _pos, _c, _p of those that the budget could pay
    chosen: F.Column      # which of ``numbered`` are taken
    used: Decimal
    profit: Decimal
    bound: float          # the linear relaxation's


def greedy(df: DataFrame, budget: Decimal, id_col: str, cost: str, amount: str, prob: str, top_n: int | None) -> Greedy:
    """The ranked walk with the single-best guard."""
    cand = candidates(df, id_col, cost, amount, prob)
    if top_n is not None:
        cand = cand.orderBy(*ranking(id_col)).limit(top_n)
    narrow = reliable_checkpoint(cand.select(id_col, "_eff", "expected_profit", "_c", "_p"))
    require_unique(narrow, id_col)
    # A proposal dearer than the whole budget can never be chosen.
    items = narrow.where(F.col("_c") <= F.lit(budget))
    ranged = range_partitioned(items, ranking(id_col))
    numbered = reliable_checkpoint(sums_in_ranges(ranged, ranking(id_col), {"_pos": F.lit(1)}, prefix="")
                                   .select(id_col, "_range", "_pos", "_c", "_p"))

    chosen, used, profit, lp_bound = _walk(numbered, budget)
    best = numbered.orderBy(F.desc("_p"), F.asc("_pos")).select("_pos", "_c", "_p").first()
    if best is not None and best["_p"] > profit:
        # one proposal alone is worth more: it goes first, the rest is filled
        others = F.col("_pos") != F.lit(best["_pos"])
        more, used, profit, _ = _walk(numbered.where(others), budget - best["_c"])
        chosen, used, profit = ~others | more, used + best["_c"], profit + best["_p"]
    return Greedy(cand, numbered, chosen, used, profit, max(lp_bound, float(profit)))


def selection_result(cand: DataFrame, picked: DataFrame, used: Decimal, profit: Decimal, bound: float, id_col: str) -> SelectionResult:
    """Flags the picked candidates and sums them up."""
    selection = (cand.drop("_eff", "_c", "_p").join(picked.select(id_col, F.lit(1).alias("selected")), id_col, "left")
                 .withColumn("selected", F.coalesce("selected", F.lit(0))))
    totals = (picked.agg(F.count(F.lit(1)).alias("selected_count"), _money_total(F.col("_c")).alias("total_cost"),
                         _money_total(F.col("_p")).alias("total_profit"))
              .withColumns({"lp_bound": F.greatest(F.lit(bound), F.col("total_profit")),
                            "gap": F.greatest(F.lit(bound), F.col("total_profit")) - F.col("total_profit")}))
    return SelectionResult(selection, totals, float(used), float(profit))


def select_within_budget(df: DataFrame, budget: float, id_col: str = "ProposalID", cost: str = "Cost",
                         amount: str = "ProposalAmount", prob: str = "accept_prob",
                         top_n: int | None = None) -> SelectionResult:
    """Flags the chosen candidates; raises when an id occurs twice.
    ``top_n`` keeps only the best candidates (an option of the job, off by
    default)."""
    b = Decimal(str(budget)).quantize(Decimal("0.000001"))
    g = greedy(df, b, id_col, cost, amount, prob, top_n)
    picked = g.numbered.where(g.chosen).select(id_col, "_c", "_p")
    return selection_result(g.cand, picked, g.used, g.profit, g.bound, id_col)


def selected_deals(selection: DataFrame, id_col: str = "ProposalID", cost: str = "Cost") -> DataFrame:
    """The chosen proposals with their cost and expected profit."""
    return selection.where(F.col("selected") == 1).select(id_col, cost, "expected_profit")
