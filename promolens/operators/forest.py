"""A random forest for a binary label, grown level by level in Spark jobs.

Spark's own ``RandomForestClassifier`` keeps a number a row and tree for how often the tree drew the row and one for
where the row stands. Here rows are kept once, as one byte a feature (its bin), and both are found again in each pass: a tree's
draws come from a generator seeded by tree and block of rows, the place by walking down what the tree has so far.
One job a level serves all trees: tasks count (node, drawn feature, bin, label), the counts of a node are added up and its best
split found by one task, the driver gets the splits. What a task holds is its rows and the counts of one tree.

Used where Spark's fit would hold too much (``plans.model``). Splits are chosen as Spark chooses them: Gini impurity of weighted counts, square root of the features drawn anew
for each node, Poisson(1) bootstrap, leaves that predict alike merged. The result is Spark's model.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.operators.boosting import bin_edges, binned
from promolens.session import ensure_checkpoint_dir, reliable_checkpoint

BLOCK_ROWS = 65_536
NODES_A_ROW = 64
MODEL_CLASS = "org.apache.spark.ml.classification.RandomForestClassificationModel"
TREE_CLASS = "org.apache.spark.ml.classification.DecisionTreeClassificationModel"


def draws_table() -> np.ndarray:
    """How often a row is drawn, Poisson(1), for each of 65 536 equally likely numbers."""
    upto = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(upto, (np.arange(65_536) + 0.5) / 65_536).astype(np.uint8)


def draws(seed: int, tree: int, block: int, n: int, table: np.ndarray) -> np.ndarray:
    return table[np.random.default_rng([seed, tree, block]).integers(0, 65_536, n, np.uint16)]


class Tree:
    """A tree as a heap: the children of node i are 2 i + 1 and 2 i + 2."""

    def __init__(self, depth: int):
        n = 2 ** (depth + 1) - 1
        self.feature = np.full(n, -1)
        self.bin = np.zeros(n, np.uint8)
        self.gain = np.full(n, -1.0)
        self.counts = np.zeros((n, 2))
        self.open = np.array([0])  # nodes of the level to be split


def walked(flat: np.ndarray, base: np.ndarray, steps: int, feature: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Where rows (their features begin at ``base``) are after so many steps from the root."""
    at = np.zeros(len(base), np.intp)
    for _ in range(steps):
        right = flat[base + feature[at]] > bins[at]
        at += at
        at += right
        at += 1
    return at


def level_counts(x: np.ndarray, drawn: np.ndarray, level: int, feature: np.ndarray, bins: np.ndarray, place: np.ndarray,
                 subset: np.ndarray, n_bins: int) -> np.ndarray:
    """Counts (open node, drawn feature, bin, label) of one block, whose bytes are 2 x bin + label. ``place`` gives the number
    of an open node of the level, -1 of others; ``subset`` the features of each open node."""
    flat, width, k = x.reshape(-1), x.shape[1], subset.shape[1]
    rows = np.flatnonzero(drawn)
    base = rows * width
    node = place[walked(flat, base, level, feature, bins) - (2 ** level - 1)]
    if (node < 0).any():
        live = np.flatnonzero(node >= 0)
        rows, base, node = rows[live], base[live], node[live]
    n_cells = len(subset) * k * n_bins * 2
    cell = np.arange(0, n_cells, n_bins * 2).reshape(-1, k)[node]
    at = subset[node]
    at += base[:, None]
    cell += flat[at]
    return np.bincount(cell.ravel(), np.repeat(drawn[rows].astype(float), k), n_cells)


def best_splits(counts: np.ndarray, weights: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """(gain, drawn feature, bin, counts left, counts right) of each node from its counts (node, drawn feature, bin, label);
    a gain of -1 where no split gains, all rows are left then."""
    w = np.asarray(weights)
    left = counts.cumsum(2)
    total = left[:, :, -1:]
    right = total - left

    def gini(c):
        v = c * w
        s = v.sum(-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1 - ((v / s[..., None]) ** 2).sum(-1), s

    (il, sl), (ir, sr), (i, s) = gini(left), gini(right), gini(total)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((left.sum(-1) >= 1) & (right.sum(-1) >= 1), i - (sl * il + sr * ir) / s, -1.0)
    flat = gain.reshape(len(counts), -1)
    at = flat.argmax(1)
    f, b = np.divmod(at, counts.shape[2])
    k = np.arange(len(counts))
    best = flat[k, at]
    good = best > 0
    return (np.where(good, best, -1.0), f, b, np.where(good[:, None], left[k, f, b], total[k, 0, 0]), np.where(good[:, None], right[k, f, b], 0))


def _blocks(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """(block, n, x): so many rows, 2 x bin + label of each feature row by row; written once."""
    width = len(edges)

    def run(batches) -> Iterator:
        import pyarrow as pa

        def made(some):
            x = np.concatenate(some)
            return pa.RecordBatch.from_pydict({"n": pa.array([len(x)], pa.int32()), "x": pa.array([x.tobytes()], pa.binary())})

        held, n = [], 0
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
                held.append(2 * binned(x, edges) + b.column("y").to_numpy(zero_copy_only=False).astype(np.uint8)[:, None])
                n += b.num_rows
                if n >= BLOCK_ROWS:
                    yield made(held)
                    held, n = [], 0
        if held:
            yield made(held)

    return reliable_checkpoint(rows.mapInArrow(run, "n int, x binary").withColumn("block", F.monotonically_increasing_id()), spread=True)


def _count_level(trees: dict[int, tuple], seed: int, level: int, width: int, n_bins: int):
    """Counts of a level: (tree, first open node, counts of so many open nodes)."""
    table = draws_table()

    def run(batches) -> Iterator:
        import pyarrow as pa

        held = []
        for b in batches:
            held += [(block.as_py(), np.frombuffer(x.as_py(), np.uint8).reshape(-1, width)) for block, x in zip(b.column("block"), b.column("x"), strict=True)]
        for t, (feature, bins, place, subset) in trees.items() if held else ():
            cells = subset.shape[1] * n_bins * 2
            got = np.zeros(len(subset) * cells)
            for block, x in held:
                got += level_counts(x, draws(seed, t, block, len(x), table), level, feature, bins, place, subset, n_bins)
            # a task counts fewer than 2 ** 31 draws
            parts = [got[i * cells: (i + NODES_A_ROW) * cells].astype(np.int32).tobytes() for i in range(0, len(subset), NODES_A_ROW)]
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t] * len(parts), pa.int32()), "first": pa.array(range(0, len(subset), NODES_A_ROW), pa.int32()),
                                              "counts": pa.array(parts, pa.binary())})

    return run


def _split_level(n_drawn: int, n_bins: int, weights: tuple[float, float]):
    def run(table):
        import pyarrow as pa

        counts = np.zeros(len(table.column("counts")[0].as_py()) // 4, np.int64)
        for v in table.column("counts"):
            counts += np.frombuffer(v.as_py(), np.int32)
        gain, f, b, left, right = best_splits(counts.reshape(-1, n_drawn, n_bins, 2), weights)
        n = len(gain)
        return pa.table({"tree": pa.array([table.column("tree")[0].as_py()] * n, pa.int32()),
                         "node": pa.array(np.arange(n) + table.column("first")[0].as_py(), pa.int32()), "gain": pa.array(gain, pa.float64()),
                         "f": pa.array(f, pa.int32()), "b": pa.array(b, pa.int32()),
                         **{c: pa.array(v, pa.int64()) for c, v in (("l0", left[:, 0]), ("l1", left[:, 1]), ("r0", right[:, 0]), ("r1", right[:, 1]))}})

    return run


def grow(rows: DataFrame, edges: list[list[float]], n_trees: int, depth: int, seed: int, weights: tuple[float, float],
         blocks: DataFrame | None = None) -> list[Tree]:
    """Trees on all ``rows`` (x, y); ``blocks``: what ``_blocks`` made of them."""
    width, n_bins = len(edges), max(map(len, edges)) + 1
    n_drawn = max(1, math.ceil(math.sqrt(width)))
    blocks = _blocks(rows, edges) if blocks is None else blocks
    trees = [Tree(depth) for _ in range(n_trees)]
    for level in range(depth):
        first = 2 ** level - 1
        asked, subsets = {}, {}
        for t, tree in enumerate(trees):
            if not len(tree.open):
                continue
            draw = np.random.default_rng([seed, t, level, 1]).random((2 ** level, width)).argsort(1)[:, :n_drawn]
            subsets[t] = np.sort(draw[tree.open - first], 1)
            place = np.full(2 ** level, -1)
            place[tree.open - first] = np.arange(len(tree.open))
            # bytes are 2 x bin + label; rows at a leaf go left to a place that is not open
            asked[t] = (np.maximum(tree.feature[:first], 0), np.where(tree.feature[:first] < 0, 255, 2 * tree.bin[:first].astype(int) + 1).astype(np.uint8), place, subsets[t])
        if not asked:
            break
        counted = blocks.mapInArrow(_count_level(asked, seed, level, width, n_bins), "tree int, first int, counts binary")
        got = counted.groupBy("tree", "first").applyInArrow(
            _split_level(n_drawn, n_bins, weights), "tree int, node int, gain double, f int, b int, l0 long, l1 long, r0 long, r1 long").toPandas()
        for t, s in got.groupby("tree"):
            tree = trees[t]
            k = s["node"].to_numpy()
            node, gain = tree.open[k], s["gain"].to_numpy()
            left, right = s[["l0", "l1"]].to_numpy(float), s[["r0", "r1"]].to_numpy(float)
            tree.counts[node] = left + right
            some = gain > 0
            node, left, right = node[some], left[some], right[some]
            tree.gain[node], tree.bin[node] = gain[some], s["b"].to_numpy()[some]
            tree.feature[node] = subsets[t][k[some], s["f"].to_numpy()[some]]
            tree.counts[2 * node + 1], tree.counts[2 * node + 2] = left, right
            children, both = np.concatenate([2 * node + 1, 2 * node + 2]), np.concatenate([left, right])
            tree.open = np.sort(children[(both > 0).all(1)])  # one with a single label stays a leaf
    return trees


def merge_alike(tree: Tree, weights: tuple[float, float]) -> None:
    """Leaves of one parent that predict the same label become one, from the bottom up."""
    predicted = (tree.counts * np.asarray(weights)).argmax(1)
    for node in range(len(tree.feature) // 2 - 1, -1, -1):
        if tree.feature[node] < 0:
            continue
        a, b = 2 * node + 1, 2 * node + 2
        if tree.feature[a] < 0 and tree.feature[b] < 0 and predicted[a] == predicted[b]:
            tree.feature[node] = -1


def node_table(trees: list[Tree], edges: list[list[float]], weights: tuple[float, float]):
    """The trees' nodes, each tree's in preorder, as Spark saves them."""
    import pyarrow as pa

    out: dict[str, list] = {c: [] for c in ("tree", "id", "prediction", "impurity", "stats", "raw", "gain", "left", "right", "feature", "threshold")}
    for t, tree in enumerate(trees):
        merge_alike(tree, weights)
        stack, n, todo = [], 0, [(0, None)]
        right_of: dict[int, int] = {}
        while todo:
            node, parent = todo.pop()
            if parent is not None:
                right_of[parent] = n
            inner = tree.feature[node] >= 0
            stack.append(node)
            if inner:
                todo += [(2 * node + 2, n), (2 * node + 1, None)]
            n += 1
        for i, node in enumerate(stack):
            inner = tree.feature[node] >= 0
            stats = tree.counts[node] * np.asarray(weights)
            f = int(tree.feature[node])
            for c, v in (("tree", t), ("id", i), ("prediction", float(stats.argmax())), ("impurity", float(1 - ((stats / stats.sum()) ** 2).sum())),
                         ("stats", stats.tolist()), ("raw", int(tree.counts[node].sum())), ("gain", float(tree.gain[node]) if inner else -1.0),
                         ("left", i + 1 if inner else -1), ("right", right_of[i] if inner else -1), ("feature", f),
                         ("threshold", [edges[f][tree.bin[node]]] if inner else [])):
                out[c].append(v)
    split = pa.StructArray.from_arrays([pa.array(out["feature"], pa.int32()), pa.array(out["threshold"], pa.list_(pa.float64())), pa.array([-1] * len(out["id"]), pa.int32())],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays(
        [pa.array(out["id"], pa.int32()), pa.array(out["prediction"], pa.float64()), pa.array(out["impurity"], pa.float64()), pa.array(out["stats"], pa.list_(pa.float64())),
         pa.array(out["raw"], pa.int64()), pa.array(out["gain"], pa.float64()), pa.array(out["left"], pa.int32()), pa.array(out["right"], pa.int32()), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": pa.array(out["tree"], pa.int32()), "nodeData": data})


def shares_table(trees: list[Tree], depth: int, weights: tuple[float, float]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each (merged) tree the features and bins of its inner places, and each label's share at the places of the last
    level; a leaf higher up goes left to that level."""
    out, w = [], np.asarray(weights)
    for tree in trees:
        n = 2 ** depth - 1
        at = np.arange(n, 2 * n + 1)
        for level in range(depth - 1, -1, -1):
            # a place under a leaf stands for that leaf
            above = ((np.arange(n, 2 * n + 1) + 1) >> (depth - level)) - 1
            at = np.where(tree.feature[above] < 0, above, at)
        stats = tree.counts[at] * w
        with np.errstate(divide="ignore", invalid="ignore"):
            share = stats / (stats[:, :1] + stats[:, 1:])
        out.append((np.maximum(tree.feature[:n], 0), np.where(tree.feature[:n] < 0, 255, tree.bin[:n]).astype(np.uint8), share))
    return out


def votes(x: np.ndarray, edges: list[list[float]], tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int) -> np.ndarray:
    """The trees' shares of each label, added tree by tree as Spark adds them."""
    out = np.zeros((len(x), 2))
    for lo in range(0, len(x), 16_384):
        some = binned(x[lo: lo + 16_384], edges)
        flat, base = some.reshape(-1), np.arange(len(some)) * some.shape[1]
        for feature, bins, share in tables:
            out[lo: lo + len(some)] += share[walked(flat, base, depth, feature, bins) - (2 ** depth - 1)]
    return out


class ForestModel(RandomForestClassificationModel):
    """Spark's model, which this session scores by arrays of rows in place of a walk through objects row by row: the same
    votes, added in the same order. It is saved and loaded as Spark's."""

    fitted: tuple | None = None  # bin edges, tables, depth

    def copy(self, extra=None):
        made = super().copy(extra)
        made.fitted = self.fitted
        return made

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw, prob, pred = self.getRawPredictionCol(), self.getProbabilityCol(), self.getPredictionCol()
        if self.fitted is None or not (raw and prob and pred) or self.getOrDefault("leafCol") or self.isDefined("thresholds"):
            return super()._transform(dataset)
        edges, tables, depth = self.fitted

        def counted(xs):
            import pyarrow as pa

            x = xs.flatten().to_numpy(zero_copy_only=False).reshape(len(xs), len(edges))
            v = votes(x, edges, tables, depth)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * 2, pa.int32()), pa.array(v.ravel(), pa.float64()))

        v, tmp = F.arrow_udf(counted, "array<double>"), f"_votes_{uuid.uuid4().hex[:8]}"
        both = F.col(tmp)[0] + F.col(tmp)[1]
        return (dataset.withColumn(tmp, v(vector_to_array(F.col(self.getFeaturesCol()))))
                .withColumns({raw: array_to_vector(F.col(tmp)), prob: array_to_vector(F.array(F.col(tmp)[0] / both, F.col(tmp)[1] / both)),
                              pred: F.when(F.col(tmp)[1] > F.col(tmp)[0], 1.0).otherwise(0.0)}).drop(tmp))


class Forest(RandomForestClassifier):
    """``RandomForestClassifier`` for two labels and one weight a label, grown as above; other input goes to Spark's own fit.

    ``share``: forests over one training set take the rows that the first of them has binned."""

    share: dict | None = None
    leads = True

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        weight = F.col(self.getWeightCol()).cast("double") if self.isDefined(self.weightCol) and self.getWeightCol() else F.lit(1.0)
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"))
        if self.share is None or self.leads:
            rows = reliable_checkpoint(rows, spread=True)  # read for the labels, the bins and the blocks
            labels = {r["y"]: r for r in rows.groupBy("y").agg(F.min("w").alias("a"), F.max("w").alias("b"), F.max(F.size("x")).alias("n")).collect()}
            made = None
            if labels and set(labels) <= {0.0, 1.0} and all(r["a"] == r["b"] and r["a"] > 0 for r in labels.values()) and self._as_here():
                edges = bin_edges(rows, max(r["n"] for r in labels.values()), self.getMaxBins(), between=True)
                made = (edges, tuple(labels[y]["a"] if y in labels else 1.0 for y in (0.0, 1.0)), _blocks(rows, edges))
            if self.share is not None:
                self.share["made"] = made
        else:
            made = self.share["made"]
        if made is None:
            return super()._fit(dataset)
        edges, weights, blocks = made
        trees = grow(rows, edges, self.getNumTrees(), self.getMaxDepth(), self.getSeed() % 2 ** 63, weights, blocks)
        model = self._model(dataset.sparkSession, node_table(trees, edges, weights), len(trees), len(edges))
        model.fitted = (edges, shares_table(trees, self.getMaxDepth(), weights), self.getMaxDepth())
        return model

    def _as_here(self) -> bool:
        """The parameters are those that ``grow`` knows."""
        return (self.getImpurity() == "gini" and self.getFeatureSubsetStrategy() in ("auto", "sqrt") and self.getMaxBins() <= 64 and self.getNumTrees() > 1
                and self.getMinInstancesPerNode() == 1 and self.getMinInfoGain() == 0 and self.getMinWeightFractionPerNode() == 0
                and self.getSubsamplingRate() == 1 and self.getBootstrap() and 0 < self.getMaxDepth() <= 12)

    def _model(self, spark, nodes, n_trees: int, n_features: int) -> ForestModel:
        """Spark's model, by way of its saved form."""
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
        told, assumed = ({p.name: v for p, v in m.items()} for m in (self._paramMap, self._defaultParamMap))

        def about(kind: str, uid: str, told: dict, assumed: dict, **more) -> str:
            return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": told,
                               "defaultParamMap": assumed, **more})

        of_trees = {p.name for p in self.params} - {"numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate"}
        one = [{k: v for k, v in m.items() if k in of_trees} for m in (told, assumed)]
        head = about(MODEL_CLASS, self.uid, told, assumed, numFeatures=n_features, numClasses=2, numTrees=n_trees)
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(t, about(TREE_CLASS, f"dtc_{uuid.uuid4().hex[:12]}", *one), 1.0) for t in range(n_trees)], "_1 int, _2 string, _3 double") \
            .coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(nodes).coalesce(1).write.parquet(f"{path}/data")
        model = RandomForestClassificationModel.load(path)
        model.__class__ = ForestModel  # a second wrapper would lose the Java object with the first
        return model
