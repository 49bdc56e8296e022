"""Optimal budgeted selection: reduced-cost fixing, then branch and bound over
the core with nodes as rows.

The greedy walk gives a choice worth ``L``. At the price ``lam`` of a unit of
cost (profit per cost of the first proposal that no longer fits) every
proposal has a reduced profit ``rc = p - lam * c``, and taking just those with
``rc > 0`` gives the bound ``U = P0 + lam * (budget - C0)``. A choice that
deviates from this base loses ``|rc|`` for each deviation, so a proposal with
``|rc| >= U - L`` stays as it is in every better choice: one pass fixes all but a small
core. Equal proposals of the core become bundles of 1, 2, 4, ... copies, so a
crowd of ties is a few bundles.

Nodes are rows (cost and profit against the base, the deviations so far). A step
takes the next bundles, least loss first, lets each node deviate in any subset
of them, and keeps a node if

* no other node has at most its cost and at least its profit (running maximum over cost ranges), and
* its bound beats the best choice so far: the bound less the loss so far and the least loss ahead, and
  what its room (or its overdraft) is worth at the best rate among the bundles ahead.

Every feasible node is a choice, so ``L`` rises and the core shrinks on the way.
When no node or no bundle is left the best choice is proven optimal. A step whose
nodes exceed ``max_nodes``, or more than ``max_steps`` steps, end the
search with the best choice and the bound of the nodes that are left: no
node is dropped unseen, the gap tells what may be missing.

Costs and profits of nodes are exact decimals; bounds are doubles, and a node is only
cut when it misses by more than their rounding.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.operators.knapsack import MONEY, SelectionResult, greedy, selection_result
from promolens.operators.prefix import range_partitioned, running_sums, sums_in_ranges
from promolens.session import reliable_checkpoint

BLOCK = 5         # bundles a step: a node has at most 32 children
PAGE = 1024       # bundles the driver knows at a time
NODES_A_TASK = 200_000
log = logging.getLogger(__name__)


@dataclass
class OptimalSelection(SelectionResult):
    proven: bool   # the choice is optimal
    steps: int
    core: int      # bundles that the fixing left open


def _bundles(numbered: DataFrame, rc: Column, limit: float) -> DataFrame:
    """(c, p, size, inside, loss, rate, place) of the open bundles, least loss first."""
    open_ = numbered.where((F.col("_c") > 0) & (F.abs(rc) < F.lit(limit)))
    classes = open_.groupBy("_c", "_p").agg(F.count(F.lit(1)).alias("m"), F.first(rc).alias("rc"))
    sizes = F.expr("filter(concat(transform(sequence(0, length(bin(m + 1)) - 2), i -> shiftleft(1L, i)),"
                   " array(m + 1 - shiftleft(1L, length(bin(m + 1)) - 1))), x -> x > 0)")
    parts = (classes.select("_c", "_p", "rc", F.explode(sizes).alias("size"))
             .select("_c", "_p", "size", (F.col("rc") > 0).alias("inside"), (F.abs("rc") * F.col("size")).alias("loss"),
                     (F.col("_p").cast("double") / F.col("_c").cast("double")).alias("rate"))
             .where(F.col("loss") < F.lit(limit)))
    order = [F.asc("loss"), F.asc("_c"), F.asc("_p"), F.asc("size"), F.asc("inside")]
    return reliable_checkpoint(running_sums(parts, order, {"place": F.lit(1)}, prefix=""))


def _undominated(ranged: DataFrame) -> DataFrame:
    """Nodes without another of at most their cost and at least their profit
    (of equal ones the first trail stays)."""
    order = [F.asc("dc"), F.desc("dp"), F.asc("trail")]
    tops = ranged.groupBy("_range").agg(F.max("dp").alias("_t"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = tops.select("_range", F.max("_t").over(before).alias("_o"))
    local = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    best = F.greatest(F.max("dp").over(local), F.col("_o"))  # NULL where there is none
    return (ranged.join(F.broadcast(offsets), "_range")  # at most one row per partition
            .withColumn("_b", best).where(F.col("_b").isNull() | (F.col("dp") > F.col("_b"))).select("dc", "dp", "trail"))


def _children(nodes: DataFrame, block: list) -> DataFrame:
    """Every node with every subset of the block's deviations."""
    subsets = []
    for mask in range(1 << len(block)):
        c, p = Decimal(0), Decimal(0)
        for i, x in enumerate(block):
            if mask >> i & 1:
                sign = -x["size"] if x["inside"] else x["size"]
                c, p = c + sign * x["_c"], p + sign * x["_p"]
        subsets.append(F.struct(F.lit(c).cast(MONEY).alias("c"), F.lit(p).cast(MONEY).alias("p"), F.lit(mask).alias("mask")))
    return (nodes.select("*", F.explode(F.array(*subsets)).alias("s"))
            .select((F.col("dc") + F.col("s.c")).cast(MONEY).alias("dc"), (F.col("dp") + F.col("s.p")).cast(MONEY).alias("dp"),
                    F.concat("trail", F.array("s.mask")).alias("trail")))


def select_optimal(df: DataFrame, budget: float, id_col: str = "ProposalID", cost: str = "Cost", amount: str = "ProposalAmount",
                   prob: str = "accept_prob", max_nodes: int = 20_000_000, max_steps: int = 200) -> OptimalSelection:
    """Flags a choice of the greatest summed expected profit within the budget;
    raises when an id occurs twice. ``totals`` holds the proven bound and gap (0 when
    ``proven``). Of several best choices it gives the greedy one, else the one found first."""
    b = Decimal(str(budget)).quantize(Decimal("0.000001"))
    g = greedy(df, b, id_col, cost, amount, prob, None)
    spark, numbered = df.sparkSession, g.numbered
    greedy_pick = numbered.where(g.chosen).select(id_col, "_c", "_p")

    # the first place at which the ranked costs pass the budget sets the price
    # (numbered comes dealt into ranges of this order)
    summed = sums_in_ranges(numbered.select("_range", "_pos", "_c", "_p"), [F.asc("_pos")], {"c": F.col("_c")})
    stop = summed.where(F.col("cum_c") > F.lit(b)).agg(F.min(F.struct("_pos", "_c", "_p")).alias("x")).first()["x"]
    if stop is None:  # all fit
        return OptimalSelection(**vars(selection_result(g.cand, greedy_pick, g.used, g.profit, float(g.profit), id_col)), proven=True, steps=0, core=0)
    lam = float(stop["_p"]) / float(stop["_c"])
    rc = F.col("_p").cast("double") - F.lit(lam) * F.col("_c").cast("double")
    base = numbered.where(rc > 0).agg(F.coalesce(F.sum("_c"), F.lit(Decimal(0))).alias("c"), F.coalesce(F.sum("_p"), F.lit(Decimal(0))).alias("p")).first()
    room, top = b - base["c"], float(base["p"]) + lam * float(b - base["c"])
    slop = 1e-12 * (1 + abs(top) + lam * float(b))
    goal, won = g.profit, None  # the best choice so far: its profit, its deviations (None: the greedy one)

    core = _bundles(numbered, rc, top - float(goal) + slop)
    n_core = core.count()
    nodes = spark.createDataFrame([(Decimal(0), Decimal(0), [])], f"dc {MONEY.simpleString()}, dp {MONEY.simpleString()}, trail array<int>")
    n_nodes, at, steps, page, blocks, bound = 1, 0, 0, [], [], None
    if room >= 0 and base["p"] > goal:
        goal, won = base["p"], []
    while n_nodes:
        limit = top - float(goal) + slop
        if len(page) <= BLOCK:  # the next bundles, and the best rates and least loss beyond them
            ahead = core.where((F.col("place") > at) & (F.col("loss") < limit))
            page = ahead.orderBy("place").limit(PAGE).collect()
            end = page[-1]["place"] if page else at
            beyond = ahead.where(F.col("place") > end).agg(
                F.min("loss").alias("loss"), F.max(F.when(~F.col("inside"), F.col("rate"))).alias("out"),
                F.min(F.when(F.col("inside"), F.col("rate"))).alias("in")).first()
        block, page = [x for x in page[:BLOCK] if x["loss"] < limit], page[BLOCK:]
        if not block:
            n_nodes = 0
            break
        if n_nodes << len(block) > max_nodes or steps == max_steps:
            break
        steps, at = steps + 1, block[-1]["place"]
        loss = F.lit(lam) * F.col("dc").cast("double") - F.col("dp").cast("double")
        children = _children(nodes, block).where(loss < limit)
        blocks.append(block)
        ranged = range_partitioned(children, [F.asc("dc"), F.desc("dp"), F.asc("trail")], parts=1 + (n_nodes << len(block)) // NODES_A_TASK)
        best = ranged.where(F.col("dc") <= F.lit(room)).agg(
            F.max(F.struct("dp", (-F.col("dc")).alias("saved"), "trail")).alias("x")).first()["x"]
        if best is not None and base["p"] + best["dp"] > goal:
            goal, won = base["p"] + best["dp"], list(best["trail"])
        # what a node can still reach: it deviates at least once more, and its room is worth at most the best rate ahead
        least = page[0]["loss"] if page else beyond["loss"]
        outs = [x["rate"] for x in page if not x["inside"]] + [x for x in [beyond["out"]] if x is not None]
        ins = [x["rate"] for x in page if x["inside"]] + [x for x in [beyond["in"]] if x is not None]
        left = F.lit(float(room)) - F.col("dc").cast("double")
        worth = F.when(left >= 0, left * F.lit(max(outs, default=0.0))).otherwise(left * F.lit(min(ins, default=float("inf"))))
        reach = F.least(F.lit(top) - loss - F.lit(least if least is not None else float("inf")),
                        F.lit(float(base["p"])) + F.col("dp").cast("double") + worth)
        nodes = reliable_checkpoint(_undominated(ranged).withColumn("reach", reach)
                                    .where(F.col("reach") + F.lit(slop) >= F.lit(float(goal + Decimal("0.000001")))))
        got = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach")).first()
        n_nodes, bound = got["n"], got["reach"]
        nodes = nodes.drop("reach")
    proven = not n_nodes
    log.info("optimal selection: %d bundles open, %d steps, proven: %s", n_core, steps, proven)
    bound = float(goal) if proven else max(float(goal), top if bound is None else bound)

    if won is None:
        picked, used = greedy_pick, g.used
    else:
        picked = _picked(numbered, rc, blocks, won, id_col)
        used = picked.agg(F.sum("_c")).first()[0] or Decimal(0)
    res = selection_result(g.cand, picked, used, goal, bound, id_col)
    return OptimalSelection(**vars(res), proven=proven, steps=steps, core=n_core)


def _picked(numbered: DataFrame, rc: Column, blocks: list[list], trail: list[int], id_col: str) -> DataFrame:
    """The base with the deviations of one trail: of a class of equal proposals the first ones go in or out."""
    moved: dict[tuple, int] = {}
    for block, mask in zip(blocks, trail):
        for i, x in enumerate(block):
            if mask >> i & 1:
                moved[x["_c"], x["_p"]] = moved.get((x["_c"], x["_p"]), 0) + x["size"]
    cols = [id_col, "_c", "_p"]
    if not moved:
        return reliable_checkpoint(numbered.where(rc > 0).select(cols))
    spark = numbered.sparkSession
    money = MONEY.simpleString()
    moves = F.broadcast(spark.createDataFrame([(c, p, n) for (c, p), n in moved.items()], f"_c {money}, _p {money}, moved long"))  # BLOCK rows a step
    order = [F.asc("_c"), F.asc("_p"), F.asc("_pos")]
    ranks = running_sums(numbered.join(moves, ["_c", "_p"]).select(*cols, "_pos", "moved"), order, {"n": F.lit(1)})
    first = ranks.groupBy("_c", "_p").agg(F.min("cum_n").alias("first"))  # a row per moved class
    rank = F.col("cum_n") - F.col("first") + 1
    touched = ranks.join(F.broadcast(first), ["_c", "_p"]).where(F.when(rc > 0, rank > F.col("moved")).otherwise(rank <= F.col("moved")))
    rest = numbered.join(moves, ["_c", "_p"], "left_anti").where(rc > 0)
    return reliable_checkpoint(rest.select(cols).unionByName(touched.select(cols)))
