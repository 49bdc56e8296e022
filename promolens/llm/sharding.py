"""Balanced label propagation: documents dealt to shards of equal size, with
linked documents (equal texts) together where the sizes allow it.

Every document starts in a random shard. In each round a group of linked
documents looks at where its members are and wants the shard that holds most
of them, weighted by the shard's room; a shard takes the share of the wishes
its quota has room for, counted from the round's flows. Links within a group
are a clique, so a member's neighbours are the group's counts by shard: the
joins are on groups, never on pairs. At the end each shard passes on what it
holds above its exact quota, documents without links first.

Only DataFrame operations; the driver sees one number per shard or pair of
shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import discard, staged, with_running


def _pick(values: list[float], shard: Column) -> Column:
    """values[shard], the list a literal of the plan (one entry a shard)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def _loads(rows: DataFrame, shards: int) -> list[int]:
    out = [0] * shards
    for r in rows.groupBy("shard").count().collect():  # a row per shard
        out[r["shard"]] = r["count"]
    return out


def propagate(nodes: DataFrame, shards: int, rounds: int, slack: float = 0.02) -> DataFrame:
    """``nodes`` (rid, g1, g2, n = group size, shard) with the shard of linked
    nodes after ``rounds`` rounds, or once no group is split that could move."""
    alone = nodes.where("n = 1")
    linked = staged(nodes.where("n > 1"), "labels")
    fixed = _loads(alone, shards)
    free = (sum(fixed) + linked.count()) / shards * (1 + slack)
    for r in range(rounds):
        load = [a + b for a, b in zip(fixed, _loads(linked, shards), strict=True)]
        room = [max(0.05, 2 - x / max(free, 1)) for x in load]
        here = linked.groupBy("g1", "g2", "shard").agg(F.count(F.lit(1)).alias("c"))
        wish = here.groupBy("g1", "g2").agg(F.max_by("shard", F.struct(F.col("c") * _pick(room, F.col("shard")), F.xxhash64("g1", "shard"))).alias("target"))
        asked = linked.join(wish, ["g1", "g2"])
        flow = asked.where("shard <> target").groupBy("shard", "target").count().collect()  # a row per pair of shards
        if not flow:
            break
        into = [sum(f["count"] for f in flow if f["target"] == j) for j in range(shards)]
        leave = [sum(f["count"] for f in flow if f["shard"] == j) for j in range(shards)]
        quota = [min(1.0, max(0.0, (free - load[j] + leave[j]) / into[j])) if into[j] else 1.0 for j in range(shards)]
        # a group moves as one; one of a good part of a shard by its members, as far as the quota goes
        draw = F.when(F.col("n") * 4 > free, F.xxhash64("rid", F.lit(r))).otherwise(F.xxhash64("g1", "g2", F.lit(r)))
        takes = F.pmod(draw, F.lit(1 << 20)) < _pick(quota, F.col("target")) * (1 << 20)
        moved = staged(asked.withColumn("shard", F.when(takes, F.col("target")).otherwise(F.col("shard"))).select(*linked.columns), "labels")
        discard(linked)
        linked = moved
    return alone.unionByName(linked)


def assign(docs: DataFrame, shards: int = 16, rounds: int = 4) -> DataFrame:
    """Per document: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Law ``rows``: shard counts differ by one at most, the larger ones first.
    ``slot`` runs from 0 without gaps in each shard; ``grown_shard`` is null
    (it belongs to another law). Null texts are of size 1, have the checksum
    of no bytes and no links; rows that repeat, also with one doc_id or none,
    are documents of their own; an empty table gives no row. Other columns
    are not read."""
    text = F.coalesce(F.col("text"), F.lit(""))
    nodes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("g1"),
                        F.xxhash64(F.lit(1), F.col("text")).alias("g2"), F.col("text").isNotNull().alias("linkable"))
    nodes = staged(nodes.withColumn("rid", F.monotonically_increasing_id()), "nodes")
    groups = nodes.where("linkable").groupBy("g1", "g2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("linkable", F.lit(True))
    labels = (nodes.select("rid", "g1", "g2", "linkable").join(groups, ["g1", "g2", "linkable"], "left")
              .select("rid", "g1", "g2", F.coalesce("n", F.lit(1)).alias("n"), F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard")))
    labels = staged(labels, "start")
    final = staged(propagate(labels, shards, rounds), "final")
    # exact quotas: a shard's first rows stay (linked ones lead), the others fill the shards that lack some
    ordered = with_running(final.select("rid", "g1", "g2", "shard", (F.col("n") == 1).alias("alone")), ["alone", "g1", "g2", "rid"],
                           group=["shard"], out="place", label="places")
    have = _loads(final, shards)
    total = sum(have)
    quota = [total // shards + (j < total % shards) for j in range(shards)]
    over = [max(0, h - q) for h, q in zip(have, quota, strict=True)]
    lack = [max(0, q - h) for h, q in zip(have, quota, strict=True)]
    passed = F.col("place") - _pick(quota, F.col("shard")) + _pick([sum(over[:j]) for j in range(shards)], F.col("shard"))
    to, begin = F.lit(0), [sum(lack[:j]) for j in range(shards)]
    for j in range(shards):
        if lack[j]:
            to = F.when(F.col("passed") >= begin[j], j).otherwise(to)
    stays = F.col("place") < _pick(quota, F.col("shard"))
    placed = (ordered.withColumn("passed", F.when(~stays, passed)).withColumn("to", F.when(F.col("passed").isNotNull(), to))
              .select("rid", F.coalesce("to", "shard").cast("int").alias("shard"),
                      F.when(F.col("to").isNull(), F.col("place"))
                      .otherwise(F.col("passed") - _pick(begin, F.col("to")) + _pick(have, F.col("to"))).cast("long").alias("slot")))
    return (nodes.join(placed, "rid")
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))
