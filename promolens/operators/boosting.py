"""Leaf-wise boosted trees for a binary label, grown in one Spark job.

The training rows are dealt to barrier tasks, so many rows a task. Each task keeps
its rows as bin numbers, one byte a feature, and sums gradients by node, feature and
bin. Tasks exchange these histograms (through files of the shared checkpoint folder where every task can open
them, else by ``allGather``), so that all find the same splits, and the leaf with the largest gain is split first until a tree has its leaves. The
driver starts one job for all rounds and gets the trees. A training set within ``rows_per_task``
is one task, which has nothing to exchange.

Nodes are expanded ahead: what is known of the gains says which leaves would be split next, and
these get their histograms together; the tree keeps those that best-first order takes in the end.
A tree therefore takes about as many exchanges as it has levels. The smaller child is summed, the other is
the difference to its parent.

Rows and features are sampled per tree (by hash of the row id and by a generator that all
tasks seed alike), so a fit does not depend on how rows are dealt but for the order of additions.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import os
import shutil
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.session import ensure_checkpoint_dir, reliable_checkpoint

BINS = 64
MIN_HESSIAN = 1e-3
ROWS_PER_TASK = 1_000_000
ROWS_PER_TASK_FILES = 250_000  # where tasks exchange through files, some milliseconds a time
# Columns are counted together as long as their bins multiply to so many cells; fewer rows than this are counted column by column.
JOINT_CELLS = 4096
JOINT_ROWS = 12_000


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 500
    step: float = 0.05
    leaves: int = 64
    min_rows: int = 20
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def joint_codes(columns: np.ndarray, cells: int) -> list[tuple[list[int], list[int], np.ndarray]]:
    """Columns dealt to groups of at most ``cells`` bins together: (columns, their bins, a row's cell). One count of a
    group's cells gives, summed along the other columns, the counts of each of them."""
    sizes = [int(c.max(initial=0)) + 1 for c in columns]
    groups: list[list[int]] = []
    for c in sorted(range(len(sizes)), key=lambda c: -sizes[c]):
        room = next((m for m in groups if math.prod(sizes[i] for i in m) * sizes[c] <= cells), None)
        if room is None:
            groups.append([c])
        else:
            room.append(c)
    out = []
    for m in groups:
        code = np.zeros(columns.shape[1], np.uint16)
        for c in m:
            code = code * np.uint16(sizes[c]) + columns[c]
        out.append((m, [sizes[c] for c in m], code))
    return out


class Grower:
    """The rows of one task, and trees grown on the sums of all tasks."""

    def __init__(self, binned: np.ndarray, label: np.ndarray, weight: np.ndarray, key: np.ndarray, p: BoostParams, gather=None):
        self.binned, self.columns, self.y, self.w, self.key, self.p = binned, np.ascontiguousarray(binned.T), label, weight, key, p
        self.gather = gather or (lambda a: a)
        self.groups = joint_codes(self.columns, JOINT_CELLS) if len(label) >= JOINT_ROWS else []
        pos, all_ = self.gather(np.array([(weight * label).sum(), weight.sum()]))
        share = min(max(pos / all_ if all_ else 0.5, 1e-6), 1 - 1e-6)
        self.start = math.log(share / (1 - share))
        self.score = np.full(len(label), self.start)

    def histograms(self, nodes: list[np.ndarray], columns: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(node, 3, column, bin): gradients, hessians and counts of the nodes' rows, over all tasks."""
        place = {c: i for i, c in enumerate(columns.tolist())}
        out = np.zeros((len(nodes), 3, len(columns), BINS))
        lay = np.arange(len(columns)) * BINS
        for k, rows in enumerate(nodes):
            gr, hr = g[rows], h[rows]
            if len(rows) < JOINT_ROWS:
                at = (self.binned[np.ix_(rows, columns)] + lay).ravel()
                for j, v in enumerate((gr, hr, None)):
                    out[k, j] = np.bincount(at, None if v is None else np.repeat(v, len(columns)), len(columns) * BINS).reshape(-1, BINS)
                continue
            for some, sizes, codes in self.groups:
                if not any(c in place for c in some):
                    continue
                at = codes[rows].astype(np.intp)
                n = math.prod(sizes)
                table = np.stack([np.bincount(at, gr, n), np.bincount(at, hr, n), np.bincount(at, minlength=n)])
                for c, size in zip(reversed(some), reversed(sizes), strict=True):  # the last column's digit is the lowest
                    table = table.reshape(3, -1, size)
                    if c in place:
                        out[k, :, place[c], :size] = table.sum(1)
                    table = table.sum(2)
        return self.gather(out)

    def best_splits(self, hist: np.ndarray) -> list[tuple | None]:
        """(gain, column, bin, rows left, rows right) of each node's best split; None if none gains."""
        left = hist.cumsum(-1)
        total = left[..., -1:]
        (gl, hl, nl), (g, h, n) = (left[:, i] for i in range(3)), (total[:, i] for i in range(3))
        gr, hr, nr = g - gl, h - hl, n - nl
        good = (nl >= self.p.min_rows) & (nr >= self.p.min_rows) & (hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(good, gl ** 2 / hl + gr ** 2 / hr - g ** 2 / h, -np.inf)
        flat = gain.reshape(len(hist), -1)
        out = []
        for k, at in enumerate(flat.argmax(1).tolist()):
            c, b = divmod(at, BINS)
            out.append((float(flat[k, at]), c, b, int(nl[k, c, b]), int(nr[k, c, b])) if flat[k, at] > 1e-12 else None)
        return out

    def tree(self, t: int) -> dict:
        """One tree; adds its values to the scores of all rows, sampled or not."""
        p, prob = self.p, 1 / (1 + np.exp(-self.score))
        g, h = self.w * (prob - self.y), np.maximum(self.w * prob * (1 - prob), 1e-16)
        n_columns = len(self.columns)
        rng = np.random.default_rng([p.seed, t])
        columns = np.sort(rng.choice(n_columns, max(1, round(p.column_share * n_columns)), replace=False))
        seen = _mixed(self.key ^ np.uint64(rng.integers(1 << 63))) < np.uint64(min(p.row_share, 1 - 1e-9) * 2 ** 64) if p.row_share < 1 else np.ones(len(self.y), bool)

        rows, hist = {1: np.arange(len(self.y))}, {1: self.histograms([np.flatnonzero(seen)], columns, g, h)[0]}
        split = {1: self.best_splits(hist[1][None])[0]}
        while True:
            todo = [(-split[1][0], 1)] if split[1] else []
            chosen, ask = [], []
            while todo and len(chosen) < p.leaves - 1:
                _, node = heapq.heappop(todo)
                chosen.append(node)
                if 2 * node not in split:
                    ask.append(node)
                    continue
                for child in (2 * node, 2 * node + 1):
                    if split[child]:
                        heapq.heappush(todo, (-split[child][0], child))
            if not ask:
                break
            small = []
            for node in ask:
                _, c, b, nl, nr = split[node]
                below = self.columns[columns[c]][rows[node]] <= b
                rows[2 * node], rows[2 * node + 1] = rows[node][below], rows[node][~below]
                small.append(2 * node + (nl > nr))
            some = self.histograms([rows[s][seen[rows[s]]] for s in small], columns, g, h)
            for node, s, table in zip(ask, small, some, strict=True):
                hist[s], hist[s ^ 1] = table, hist[node] - table
            found = [c for node in ask for c in (2 * node, 2 * node + 1)]
            split.update(zip(found, self.best_splits(np.stack([hist[c] for c in found])), strict=True))

        inner = set(chosen)
        nodes = sorted({1} | {c for n in chosen for c in (2 * n, 2 * n + 1)})
        place = {n: i for i, n in enumerate(nodes)}
        out: dict = {"feature": [], "bin": [], "left": [], "right": [], "value": []}
        for n in nodes:
            value = 0.0
            if n in inner:
                _, c, b, _, _ = split[n]
            else:
                sums = hist[n][:, 0].sum(-1)
                value = float(-p.step * sums[0] / sums[1]) if sums[1] > 0 else 0.0
                self.score[rows[n]] += value
            out["feature"].append(int(columns[c]) if n in inner else 0)
            out["bin"].append(b if n in inner else 0)
            out["left"].append(place[2 * n] if n in inner else place[n])
            out["right"].append(place[2 * n + 1] if n in inner else place[n])
            out["value"].append(value)
        return out


CHUNK_ROWS = 400_000
POINTS = 8192


def _summary(x: np.ndarray, n_points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and how many rows are up to each and above the one before; beyond ``n_points`` values neighbours are
    one, so that a rank is off by at most one ``n_points``-th of the rows."""
    v, n = np.unique(x[~np.isnan(x)], return_counts=True)
    if len(v) <= n_points:
        return v, n
    upto = n.cumsum()
    last = np.unique(np.searchsorted(upto, np.arange(1, n_points + 1) * (upto[-1] / n_points)).clip(max=len(v) - 1))
    return v[last], np.diff(upto[last], prepend=0)


def _edges_of(v: np.ndarray, n: np.ndarray, bins: int, between: bool = False) -> list[float]:
    """Distinct quantiles of values with their numbers of rows. ``between``: each half way to the next value, and one
    between any two values if there are so few."""
    if not len(v):
        return []
    order = np.argsort(v, kind="stable")
    v, upto = v[order], n[order].cumsum()
    at = np.searchsorted(upto, np.ceil(np.arange(1, bins) * (upto[-1] / bins)).clip(1))
    found = np.unique(v[at.clip(max=len(v) - 1)])
    if not between:
        return found.tolist()
    known = np.unique(v)
    at = np.arange(len(known) - 1) if len(known) <= bins else np.searchsorted(known, found[found < known[-1]])
    half = known[at] / 2 + known[at + 1] / 2
    return np.where((half >= known[at]) & (half < known[at + 1]), half, known[at]).tolist()


def bin_edges(rows: DataFrame, n_features: int, bins: int = BINS, between: bool = False) -> list[list[float]]:
    """Upper bounds of each feature's bins but the last: distinct quantiles of all training rows, from summaries of
    ``CHUNK_ROWS`` rows each."""
    def summaries(batches) -> Iterator:
        import pyarrow as pa

        def told(some: list[np.ndarray]):
            x = np.concatenate(some)
            made = [_summary(x[:, j]) for j in range(n_features)]
            return pa.RecordBatch.from_pydict({
                "feature": pa.array(range(n_features), pa.int32()), "v": pa.array([v.astype(float).tobytes() for v, _ in made], pa.binary()),
                "n": pa.array([n.astype(np.int64).tobytes() for _, n in made], pa.binary())})

        held: list[np.ndarray] = []
        for b in batches:
            if b.num_rows:
                held.append(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n_features))
                if sum(map(len, held)) >= CHUNK_ROWS:
                    yield told(held)
                    held = []
        if held:
            yield told(held)

    def merged(table):
        import pyarrow as pa

        v, n = (np.frombuffer(b"".join(x.as_py() for x in table.column(c)), k) for c, k in (("v", np.float64), ("n", np.int64)))
        return pa.table({"feature": table.column("feature").slice(0, 1).cast(pa.int32()), "edges": pa.array([_edges_of(v, n, bins, between)], pa.list_(pa.float64()))})

    got = (rows.select("x").mapInArrow(summaries, "feature int, v binary, n binary").groupBy("feature")
           .applyInArrow(merged, "feature int, edges array<double>").collect())
    found = {r["feature"]: list(r["edges"]) for r in got}
    return [found[j] for j in range(n_features)]


def binned(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.asarray(e), x[:, j])
    return out


def to_blocks(edges: list[list[float]], width: int):
    """Rows (x, y, w, key) as blocks of bytes: bins row by row, labels, weights, keys."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width)
                made = {"x": binned(x, edges), **{c: b.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "key")}}
                yield pa.RecordBatch.from_pydict({c: pa.array([v.tobytes()], pa.binary()) for c, v in made.items()})

    return run


BLOCK = "x binary, y binary, w binary, key binary"


def of_blocks(batches, width: int) -> list[np.ndarray]:
    """The arrays of all blocks of a task: bins (rows, features), labels, weights, keys."""
    parts: dict[str, list] = {"x": [], "y": [], "w": [], "key": []}
    for b in batches:
        for c, made in parts.items():
            made += [v.as_py() for v in b.column(c)]
    kinds = {"x": np.uint8, "y": np.float64, "w": np.float64, "key": np.uint64}
    x, y, w, key = (np.frombuffer(b"".join(parts.pop(c)), k) for c, k in kinds.items())
    return [x.reshape(-1, width), y, w, key]


def plain_folder(path: str) -> str | None:
    """A folder that tasks open as files, if ``path`` names one."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return path
    return "/" + rest.lstrip("/") if scheme == "file" else None


def _gathered(context):
    """All tasks' bytes, in the order of the tasks, by ``allGather`` (about a second a time)."""
    def gather(mine: bytes) -> list[bytes]:
        return [base64.b64decode(m) for m in context.allGather(base64.b64encode(mine).decode())]

    return gather


def _through_files(folder: str, me: int, tasks: int):
    """The same by files in a folder that all tasks share. A task writes its n-th file over its last but one: it has read all
    tasks' files n - 1 by then, so that these have read all of n - 2."""
    step = 0

    def gather(mine: bytes) -> list[bytes]:
        nonlocal step
        step += 1
        head = step.to_bytes(8, "little")
        at = f"{folder}/{me}.{step % 2}"
        with open(f"{at}.new", "wb") as f:
            f.write(head + len(mine).to_bytes(8, "little") + mine)
        os.replace(f"{at}.new", at)
        out = []
        for k in range(tasks):
            wait = 0.0005
            while True:
                try:
                    with open(f"{folder}/{k}.{step % 2}", "rb") as f:
                        got = f.read()
                except OSError:
                    got = b""
                if got[:8] == head and len(got) == 16 + int.from_bytes(got[8:16], "little"):
                    break
                time.sleep(wait)
                wait = min(2 * wait, 0.01)
            out.append(got[16:])
        return out

    return gather


def _summed(context, folder: str | None, tasks: int):
    """Adds an array over all tasks of the barrier stage: through ``folder`` if every task sees what the driver put there."""
    shared = _gathered(context)
    seen = folder is not None and os.path.exists(f"{folder}/here")
    told = [json.loads(m) for m in shared(json.dumps([seen, uuid.uuid4().hex]).encode())]
    if all(t[0] for t in told):
        mine = f"{folder}/{told[0][1]}"  # a stage that is run again uses a new one
        os.makedirs(mine, exist_ok=True)
        shared = _through_files(mine, context.partitionId(), tasks)

    def gather(a: np.ndarray) -> np.ndarray:
        return np.sum([np.frombuffer(m, a.dtype) for m in shared(np.ascontiguousarray(a).tobytes())], 0).reshape(a.shape)

    return gather


def grow(train: DataFrame, features: str, label: str, weight: str, key: str, p: BoostParams,
         rows_per_task: int | None = None) -> tuple[float, list[list[float]], list[dict]]:
    """(starting score, bin edges, trees) fitted on all rows of ``train``."""
    spark = train.sparkSession
    # written once: read for the size, the bins and the blocks
    rows = reliable_checkpoint(train.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"),
                                            F.col(weight).cast("double").alias("w"), F.xxhash64(key).alias("key")), spread=True)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        raise ValueError("no training rows")
    edges = bin_edges(rows, width)
    shared = plain_folder(ensure_checkpoint_dir(spark))
    tasks = min(spark.sparkContext.defaultParallelism, math.ceil(n / (rows_per_task or (ROWS_PER_TASK if shared is None else ROWS_PER_TASK_FILES))))
    folder = None
    if shared is not None and tasks > 1:
        folder = f"{shared.rstrip('/')}/exchange-{uuid.uuid4().hex}"
        os.makedirs(folder)
        open(f"{folder}/here", "w").close()

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        held = of_blocks(batches, width)
        context = BarrierTaskContext.get()
        grower = Grower(*held, p, _summed(context, folder, tasks) if tasks > 1 else None)
        trees = [grower.tree(t) for t in range(p.rounds)]
        mine = context.partitionId() == 0
        yield pa.RecordBatch.from_pydict({"start": pa.array([grower.start][:mine], pa.float64()), "trees": pa.array([json.dumps(trees)][:mine], pa.string())})

    try:
        # a barrier stage begins behind a shuffle, and has as many tasks as that one deals to
        blocks = rows.mapInArrow(to_blocks(edges, width), BLOCK).repartition(tasks)
        got = blocks.mapInArrow(run, "start double, trees string", barrier=True).collect()[0]
    finally:
        if folder:
            shutil.rmtree(folder, ignore_errors=True)
    return got["start"], edges, json.loads(got["trees"])


def score_rows(x: np.ndarray, start: float, table: dict[str, np.ndarray]) -> np.ndarray:
    """Raw scores: every row goes down every tree, those that are not at a leaf a level a step."""
    out, roots = np.empty(len(x)), table["root"]
    for lo in range(0, len(x), 2000):
        some = x[lo: lo + 2000]
        at = np.tile(roots, len(some))
        row = np.repeat(np.arange(len(some)), len(roots))
        live = np.flatnonzero(table["left"][at] != at)
        while len(live):
            node = at[live]
            below = some[row[live], table["feature"][node]] <= table["bound"][node]
            node = np.where(below, table["left"][node], table["right"][node])
            at[live] = node
            live = live[table["left"][node] != node]
        out[lo: lo + 2000] = start + table["value"][at].reshape(len(some), -1).sum(1)
    return out


def flat_table(edges: list[list[float]], trees: list[dict]) -> dict[str, np.ndarray]:
    """All trees on end; a leaf points to itself."""
    out: dict[str, list] = {k: [] for k in ("root", "feature", "bound", "left", "right", "value")}
    for t in trees:
        base = len(out["left"])
        out["root"].append(base)
        for f, b, left, right, v in zip(t["feature"], t["bin"], t["left"], t["right"], t["value"], strict=True):
            out["feature"].append(f)
            out["bound"].append(edges[f][b] if b < len(edges[f]) else math.inf)
            out["left"].append(base + left)
            out["right"].append(base + right)
            out["value"].append(v)
    return {k: np.array(v, float if k in ("bound", "value") else np.int64) for k, v in out.items()}


LEAVES_A_WORD = 64
ROWS_A_BLOCK = 128


@dataclass
class LeafWords:
    """Trees of at most 64 leaves as words: bit i of a tree's word says that its leaf i, from left, can still be reached.
    ``words[f][bin]`` holds for each tree what the value of feature f leaves open (the last bin is NaN, which goes right
    everywhere). A row's leaf is the lowest bit of all its features' words together: a look-up a feature, no walk."""

    edges: list[list[float]]
    words: dict[int, np.ndarray]  # feature: (bins, trees)
    values: np.ndarray            # tree * 64 + leaf
    n_trees: int


def leaf_words(edges: list[list[float]], trees: list[dict]) -> LeafWords | None:
    """None if a tree has too many leaves for a word."""
    full, n = np.uint64(2 ** 64 - 1), len(trees)
    words: dict[int, np.ndarray] = {}
    values = np.zeros(n * LEAVES_A_WORD)
    for t, tree in enumerate(trees):
        todo, leaves, inner = [(0, False)], 0, []  # depth first, left to right
        first: dict[int, int] = {}
        while todo:
            node, left_done = todo.pop()
            if tree["left"][node] == node:
                if leaves == LEAVES_A_WORD:
                    return None
                values[t * LEAVES_A_WORD + leaves] = tree["value"][node]
                leaves += 1
            elif left_done:
                inner.append((node, first[node], leaves))
                todo.append((tree["right"][node], False))
            else:
                first[node] = leaves
                todo += [(node, True), (tree["left"][node], False)]
        for node, lo, hi in inner:
            f, b = tree["feature"][node], tree["bin"][node]
            table = words.setdefault(f, np.full((len(edges[f]) + 2, n), full))
            closed = np.uint64((1 << hi) - (1 << lo))
            table[min(b + 1, len(edges[f]) + 1):, t] &= ~closed
    return LeafWords(edges, words, values, n)


def score_words(x: np.ndarray, start: float, w: LeafWords) -> np.ndarray:
    """What ``score_rows`` gives, by the words of the trees."""
    places = {f: np.where(np.isnan(x[:, f]), len(w.edges[f]) + 1, np.searchsorted(np.asarray(w.edges[f]), x[:, f])) for f in w.words}
    base = np.arange(w.n_trees) * LEAVES_A_WORD
    out = np.empty(len(x))
    open_, part = np.empty((2, ROWS_A_BLOCK, w.n_trees), np.uint64)
    for lo in range(0, len(x), ROWS_A_BLOCK):
        m = min(ROWS_A_BLOCK, len(x) - lo)
        a, b = open_[:m], part[:m]
        a.fill(2 ** 64 - 1)
        for f, table in w.words.items():
            np.take(table, places[f][lo: lo + m], axis=0, out=b, mode="clip")
            np.bitwise_and(a, b, out=a)
        np.negative(a, out=b)
        np.bitwise_and(a, b, out=b)  # the lowest bit
        leaf = (b.astype(float).view(np.int64) >> 52) - 1023  # a power of two: its exponent
        leaf += base
        out[lo: lo + m] = start + w.values[leaf].sum(1)
    return out


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees; adds ``probability`` (a vector: class 0, class 1). Saved as JSON with its parameters."""

    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "start, bin edges and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", trees: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = json.loads(self.getOrDefault(self.trees))
        start, words = fitted["start"], leaf_words(fitted["edges"], fitted["trees"])
        table = flat_table(fitted["edges"], fitted["trees"]) if words is None else None

        def chance(xs: pd.Series) -> pd.Series:
            if not len(xs):
                return pd.Series(np.zeros(0))
            x = np.stack(xs.to_numpy())
            raw = score_rows(x, start, table) if words is None else score_words(x, start, words)
            return pd.Series(1 / (1 + np.exp(-raw)))

        one = F.pandas_udf(chance, "double")(vector_to_array(F.col(self.getOrDefault(self.featuresCol))))
        return (df.withColumn("_chance", one)
                .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_chance"), F.col("_chance")))).drop("_chance"))


class BoostedTrees(Estimator):
    """Estimator of ``BoostedTreesModel`` for a pipeline; ``idCol`` tells training rows apart for their sampling."""

    def __init__(self, params: BoostParams, featuresCol: str = "features", labelCol: str = "label", weightCol: str = "weight",
                 idCol: str = "ProposalID"):
        super().__init__()
        self.boost, self.columns = params, (featuresCol, labelCol, weightCol, idCol)

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        start, edges, trees = grow(df, *self.columns, self.boost)
        return BoostedTreesModel(featuresCol=self.columns[0], trees=json.dumps({"start": start, "edges": edges, "trees": trees}))
