"""Merkle manifest of a table with a proof for every row, by pointer jumping.

A row's leaf is the digest of its fields. The leaves of a group ascend by key;
every two consecutive nodes become one until one is left, the group's
subroot; subroots, ordered by group, become the root in the same way. The tree
is built in strides of ten levels, one task group per 1024 nodes. A proof
is then found without walking the levels one by one: every node holds the
siblings on the way to an ancestor, and each round joins it to what that
ancestor holds, which doubles the distance, until every leaf reaches the root.

Defined cases: a null field is ``-`` in the leaf; rows with one key follow their leaves'
order (rows equal in both have the same digests, whichever comes first); null keys come
first; a null group is a group of its own and comes first; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import discard, staged, with_running

STRIDE = 10  # levels built at once: a task group holds 2 ** STRIDE nodes at most
TOP = "+"  # the tree over the subroots; groups are "" (null) or "=" and their value
STEP_BYTES = 70  # a step of a proof as it travels
ROW_BYTES = 200
NODES = "g string, level int, idx long, h string, step string, n long, rank long, key long, other string"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as UTF-8 byte count, colon and value, ``-`` if null."""
    text = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(node: Column, step: Column) -> Column:
        sibling = F.substring(step, 2, 64)
        return F.sha2(F.when(F.substring(step, 1, 1) == "L", F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(steps, leaf, up)


def siblings(steps: Column) -> Column:
    """The digests of a proof on end, from the leaf's sibling to the one below the root."""
    return F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 64)), "")


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(level: int, last: int):
    """Builds the levels from ``level`` to ``last`` above one block of nodes.

    A node's step names its sibling and the side it stands on (``L``, ``R``); it is
    ``N`` for a node that becomes its parent alone and null for a group's only
    node, which goes up as it is. Nodes of ``last`` have no step yet."""
    def build(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["idx"])
        head, first, n, out = rows[0], rows[0]["idx"], rows[0]["n"], []
        nodes = [(r["h"], r["key"], r["other"]) for r in rows]
        for at in range(level, last + 1):
            up = []
            for i in range(0, len(nodes), 2):
                pair = [h for h, _, _ in nodes[i: i + 2]]
                if at == last or n == 1:
                    steps, parent = [None] * len(pair), pair[0]
                else:
                    steps, parent = (["R" + pair[1], "L" + pair[0]] if len(pair) == 2 else ["N"]), _digest(pair)
                for j, step in enumerate(steps):
                    h, key, other = nodes[i + j]
                    out.append((head["g"], at, first + i + j, h, step, n, head["rank"], key, other))
                up.append((parent, None, None))
            nodes, first, n = up, first // 2, (n + 1) // 2
        fields = [f.split(" ") for f in NODES.split(", ")]
        kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        columns = [pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)]
        return pa.table(columns, names=[f for f, _ in fields])

    return build


def _tree(leaves: DataFrame, level: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """(tables of the nodes of every level below the top, the top nodes) of trees
    of one height; ``leaves`` has NODES' columns but level and step."""
    tables, nodes, at, top = [], leaves, level, level + height
    while at < top:
        last = min(at + STRIDE, top)
        blocks = nodes.withColumn("block", F.shiftright("idx", last - at))
        table = staged(blocks.groupBy("g", "block").applyInArrow(_levels(at, last), NODES), "merkle")
        tables.append(table)
        nodes = table.where(F.col("level") == last).drop("level", "step")
        at = last
    return tables, nodes


def _limit(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").lower().removesuffix("b")
    return int(text[:-1]) << 10 * ("kmgt".index(text[-1]) + 1) if text[-1:] in list("kmgt") else int(text)


def _small(table: DataFrame, rows: int, width: int = ROW_BYTES) -> DataFrame:
    """``table`` marked for broadcast if its known number of rows is within the session's limit."""
    return F.broadcast(table) if rows * width <= _limit(table.sparkSession) else table


def _height(n: int) -> int:
    """Levels between ``n`` nodes and one."""
    return max(n - 1, 0).bit_length()


def _jumped(nodes: DataFrame, middle: int, root: int, most: int, groups: int) -> DataFrame:
    """(key, g, leaf, other, steps): every leaf with all steps to level ``root``.

    Group nodes stand below level ``middle``, nodes over subroots from there on.
    In a round, nodes on every second multiple of the span stay, and take over
    what the node one span above them holds. ``most`` and ``groups`` bound the nodes of a level."""
    cur, span, old = nodes, 1, None
    while span < root:
        end = F.col("level") + span
        below = end < middle
        low = (cur.where(F.col("level") % (2 * span) == 0)
               .withColumns({"up_g": F.when(below, F.col("g")).otherwise(F.lit(TOP)),
                             "up_idx": F.when(below | (F.col("level") >= middle), F.shiftright("idx", min(span, 63)))
                             .otherwise(F.expr(f"shiftright(rank, int(greatest(level + {span} - {middle}, 0)))")),
                             "up_level": end}))
        high = (cur.where(F.col("level") % (2 * span) == span)
                .select(F.col("g").alias("up_g"), F.col("idx").alias("up_idx"), F.col("level").alias("up_level"), F.col("steps").alias("rest")))
        rows = 2 * ((most >> span) + groups + root)
        cur = staged(low.join(_small(high, rows, ROW_BYTES + span * STEP_BYTES), ["up_g", "up_idx", "up_level"], "left")
                     .withColumn("steps", F.concat("steps", F.coalesce("rest", F.array().cast("array<string>"))))
                     .select(nodes.columns), "merkle")
        if old is not None:
            discard(old)
        old, span = cur, 2 * span
    return cur.where("level = 0").select("key", "g", F.col("h").alias("leaf"), "other", "steps")


def proofs(docs: DataFrame, fields: list[str], key: str, group: str, other: Column | None = None) -> DataFrame:
    """(key, group, leaf, other, steps, subroot, root) for every row of ``docs``.

    ``fields`` enter the leaf in their order, ``key`` (an integer) orders a
    group's leaves, ``other`` is a string that travels with the leaf, such as the digest
    of a changed row. ``fold(leaf, steps)`` equals the root of an unchanged row."""
    spark = docs.sparkSession
    quoted = [F.col(f"`{f}`") for f in fields]
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("g"),
                       F.col(f"`{key}`").cast("long").alias("key"), leaf_digest(quoted).alias("h"),
                       (F.lit(None) if other is None else other).cast("string").alias("other"))
    placed = with_running(rows, ["key", "h"], group=["g"], out="idx", label="leaves")
    sizes = staged(placed.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "groups")
    groups, most, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    ranked = staged(with_running(sizes, ["g"], out="rank", label="groups"), "groups")
    middle = max(1, _height(most))
    root = middle + _height(groups)

    tables, tops = _tree(placed.join(_small(ranked, groups), "g"), 0, middle)
    subroots = tops.select("g", F.col("h").alias("subroot"))
    over = tops.select(F.lit(TOP).alias("g"), F.col("rank").alias("idx"), "h", F.lit(groups).cast("long").alias("n"), "rank", "key", "other")
    more, top = _tree(over, middle, root - middle)
    whole = top.select("h").first()

    nodes = None
    for first, last, table in _spans(tables, 0, middle) + _spans(more, middle, root):
        part = table.where((F.col("level") >= first) & (F.col("level") < last)).select(
            "g", "level", "idx", "rank", "key", F.when(F.col("level") == 0, F.col("h")).alias("h"), "other",
            F.when(F.col("step").isNull(), F.array().cast("array<string>")).otherwise(F.array("step")).alias("steps"))
        nodes = part if nodes is None else nodes.unionByName(part)
    out = _jumped(nodes, middle, root, total, groups).join(_small(subroots, groups), "g")
    return out.select(F.col("key").alias(key), F.expr("CASE WHEN g <> '' THEN substring(g, 2) END").alias(group), "leaf", "other", "steps",
                      "subroot", F.lit(whole[0] if whole else None).cast("string").alias("root"))


def _spans(tables: list[DataFrame], first: int, last: int) -> list[tuple[int, int, DataFrame]]:
    """A stride's last level is the next one's first, and taken from there."""
    return [(at, min(at + STRIDE, last), t) for at, t in zip(range(first, last, STRIDE), tables, strict=True)]


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
TAMPERED = 7  # documents whose id's checksum it divides


def op11_digest(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and what they say of documents whose n_chars was raised by one."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    raised = [(F.col(f).cast("decimal(20,0)") + 1).cast("string") if f == "n_chars" else F.col(f) for f in FIELDS]
    p = proofs(docs, FIELDS, "doc_id", "lang", F.when(hit, leaf_digest(raised)))
    return p.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"),
                    fold(F.coalesce("other", "leaf"), F.col("steps")).alias("folded_root")).withColumn(
                        "verified", F.col("folded_root") == F.col("root"))
