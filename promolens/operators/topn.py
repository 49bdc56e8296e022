"""Top-k operators."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from promolens.session import reliable_checkpoint


def top_k_through_joins(fact: DataFrame, order: list[Column], k: int,
                        enrich: Callable[[DataFrame], DataFrame], start: int | None = None) -> DataFrame:
    """Exact ``enrich(fact).orderBy(order).limit(k)``, in the usual case
    without joining the whole fact table.

    ``enrich`` may only drop rows (inner joins), repeat them (duplicate
    dimension keys) or add columns; the order columns must come from
    ``fact`` and end in a unique key. Candidates are the first ``m`` fact
    rows (a per-partition top-m, then one merge of m rows per partition),
    ``m`` a fixed multiple of ``k``; being few they are broadcast, so the
    other sides are not shuffled. Any surviving row of a non-candidate sorts
    after every candidate, so k survivors are the answer. Should joins drop
    so many that fewer are left, the whole fact table is joined and the top
    k taken from that, still without sorting it in one task.
    """
    m = start or max(8 * k, 64)
    cand = reliable_checkpoint(fact.orderBy(*order).limit(m))
    joined = enrich(F.broadcast(cand))  # m rows
    if joined.count() < k and cand.count() == m:
        joined = enrich(fact)
    return joined.orderBy(*order).limit(k)


def rank_filter(df: DataFrame, partition_cols: list[str], order: list[Column], n: int,
                rank_col: str = "rnk") -> DataFrame:
    """RANK() OVER (PARTITION BY … ORDER BY …) <= n. Ties share a rank, so
    a group may return more than n rows. Catalyst turns the filter into a
    partial + final WindowGroupLimit, so only n rows per group and task
    reach the window sort."""
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).where(F.col(rank_col) <= n)
