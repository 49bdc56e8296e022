"""Quality classifier by co-training.

Two views of a document: its words and their stems, and what its page record and layout say
(language, source, length, lines, shares of capitals, digits, signs, spaces,
distinct words). Each has its own logistic classifier on one-hot features.
Both start from labelled documents; in each round every document is scored
and each view hands its surest pseudo-labels of either class, a share
``exchange`` of all unlabelled documents, to the other. Pseudo-labels stay in
Spark: they are dealt to parts of about ``PART_ROWS``, a view is fitted on the
labelled documents with each part, and the parts' weights are averaged.
Scores are calibrated on labelled documents held back from the fit, and a
last logistic step over both calibrated views scores every document.

The fit uses at most ``fit_rows`` labelled documents (those with the smallest
hashes of doc_id); pseudo-labels grow with the input, and scoring, in the
rounds and at the end, covers every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import discard, slices, staged, text_bytes
from promolens.llm.words import SPACE, word_hashes, word_spans

_U = np.uint64
FIT_ROWS = 20_000
VOCABULARY = 2048
LEAST_G2 = 18.0
EXCHANGE = 0.02
PART_ROWS = 10_000
SURE = 0.97
SURE_LOGIT = float(np.log(SURE / (1 - SURE)))
GRAIN = 0.01  # logits are ranked in steps of this, up to TOP
TOP = 40.0
BINS = 16
STEMS = (4, 5)  # bytes
NAMED = 64  # hashed places for each of language and source
NUMBERS = 8
_KIND = np.zeros(256, np.int8)  # 1 capital, 2 digit, 3 sign, 4 white space
_KIND[65:91] = 1
_KIND[48:58] = 2
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _KIND[_a:_b] = 3
_KIND[SPACE] = 4


def _trimmed_words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(hashes of the words without signs at the ends, text of each word,
    bytes, offsets, hashes and texts of all terms: the words, and the first
    STEMS bytes of longer ones)."""
    raw, off = text_bytes(arr)
    starts, ends = word_spans(raw, off)
    doc = np.searchsorted(off, starts, "right") - 1
    for _ in range(3):
        starts = starts + ((ends - starts > 1) & (_KIND[raw[starts]] == 3)) if len(starts) else starts
        ends = ends - ((ends - starts > 1) & (_KIND[raw[ends - 1]] == 3)) if len(ends) else ends
    h = word_hashes(raw, starts, ends, True)
    terms, docs = [h], [doc]
    for n in STEMS:
        long = ends - starts > n
        terms.append(word_hashes(raw, starts[long], starts[long] + n, True) ^ _U(0xA24BAED4963EE407 + n))
        docs.append(doc[long])
    return h, doc, raw, off, (np.concatenate(terms), np.concatenate(docs))


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    d, v = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return d[new], v[new]


def _layout(h: np.ndarray, doc: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """NUMBERS values of each text."""
    n, size = len(off) - 1, np.maximum(1, np.diff(off))
    kind = _KIND[raw]
    share = []
    for k in (1, 2, 3, 4):
        run = np.concatenate([[0], np.cumsum(kind == k)])
        share.append((run[off[1:]] - run[off[:-1]]) / size)
    lines = np.concatenate([[0], np.cumsum(raw == 10)])
    lines = lines[off[1:]] - lines[off[:-1]]
    words = np.bincount(doc, minlength=n)
    distinct = np.bincount(_distinct(doc, h)[0], minlength=n)
    return np.stack([np.log1p(np.diff(off)), *share, lines / np.maximum(1, words), size / np.maximum(1, words), distinct / np.maximum(1, words)], 1)


@dataclass
class View:
    """Logistic classifier over sets of features, with its calibration."""

    weights: np.ndarray
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, row: np.ndarray, col: np.ndarray, n: int) -> np.ndarray:
        return self.scale * (np.bincount(row, self.weights[col], n) + self.bias) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_view(row: np.ndarray, col: np.ndarray, y: np.ndarray, width: int, rounds: int = 120, l2: float = 1.0) -> View:
    """Ridge-penalised logistic fit by Adam from the features' log odds."""
    n, p = len(y), np.clip(y.mean(), 1e-3, 1 - 1e-3)
    pos, neg = np.bincount(col, y[row], width), np.bincount(col, 1 - y[row], width)
    w = np.log((pos + 1) / (neg + (1 - p) / p)) * 0.5
    b, m, v = float(np.log(p / (1 - p))), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        miss = _sigmoid(np.bincount(row, w[col], n) + b) - y
        g = np.append((np.bincount(col, miss[row], width) + l2 * w) / n, miss.mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w, b = w - step[:-1], b - float(step[-1])
    return View(w, b)


def fit_line(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and constant of a small logistic regression (Newton steps, light ridge)."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    w[:-1] = 1.0 / max(1, a.shape[1] - 1)
    for _ in range(25):
        p = _sigmoid(a @ w)
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, a.T @ (p - y) + 1e-2 * w), -3, 3)
    return w


def both_views(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the last step sees: either view's logit and the worse of the two,
    as a fault that one view shows is a fault."""
    return np.stack([a, b, np.maximum(a, b)], 1)


@dataclass
class Model:
    """Vocabulary, bins and both views; ``base`` alone when nothing can be fitted."""

    base: float
    vocabulary: np.ndarray = field(default_factory=lambda: np.zeros(0, _U))
    edges: np.ndarray = field(default_factory=lambda: np.zeros((NUMBERS, BINS - 1)))
    text: View | None = None
    page: View | None = None
    mix: np.ndarray = field(default_factory=lambda: np.zeros(4))

    @property
    def page_width(self) -> int:
        return NUMBERS * BINS + 2 * NAMED

    def features(self, part: pa.RecordBatch) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(text, feature) pairs of both views."""
        *layout, (h, doc) = _trimmed_words(part.column("text"))
        at = np.minimum(np.searchsorted(self.vocabulary, h), max(0, len(self.vocabulary) - 1))
        known = self.vocabulary[at] == h if len(self.vocabulary) else np.zeros(len(h), bool)
        text = _distinct(doc[known], at[known])
        return text, self.page_features(_layout(*layout), part)

    def page_features(self, numbers: np.ndarray, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        n = len(numbers)
        cols = [np.searchsorted(self.edges[k], numbers[:, k]) + k * BINS for k in range(NUMBERS)]
        cols += [part.column(c).to_numpy() + NUMBERS * BINS + k * NAMED for k, c in enumerate(("__lang", "__source"))]
        return np.tile(np.arange(n), len(cols)), np.concatenate(cols).astype(np.int64)

    def logits(self, text: tuple, page: tuple, n: int) -> tuple[np.ndarray, np.ndarray]:
        return self.text.logit(*text, n), self.page.logit(*page, n)

    def score(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chance to be good by the text, by the page, and by both."""
        n = part.num_rows
        if self.text is None:
            return (np.full(n, 1 - self.base),) * 3
        a, b = self.logits(*self.features(part), n)
        return 1 - _sigmoid(a), 1 - _sigmoid(b), 1 - _sigmoid(np.column_stack([both_views(a, b), np.ones(n)]) @ self.mix)


def _places(docs: DataFrame) -> list[F.Column]:
    """Hashed places of language and source, as ``__lang`` and ``__source``."""
    place = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(NAMED)) if c in docs.columns else F.lit(0).cast("long")
    return [place("lang").alias("__lang"), place("source").alias("__source")]


def _wanted(labels: DataFrame, fit_rows: int) -> DataFrame:
    """(doc_id, bad): at most fit_rows labelled ids, worst label of each."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad")).where("doc_id is not null and bad is not null")
    return one.groupBy("doc_id").agg(F.max("bad").alias("bad")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def _vocabulary(labelled: DataFrame) -> np.ndarray:
    """Hashes of the terms most telling of the class (likelihood ratio)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            h, doc = _trimmed_words(part.column("text"))[4]
            d, v = _distinct(doc, h)
            word, at = np.unique(v, return_inverse=True)
            bad = np.bincount(at, part.column("bad").to_numpy()[d], len(word)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(word)).astype(np.int64))],
                                             names=["word", "bad", "n"])

    totals = labelled.agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n")).first()
    counts = (labelled.select("text", "bad").mapInArrow(count, "word long, bad long, n long")
              .groupBy("word").agg(F.sum("bad").alias("a"), F.sum("n").alias("m")).where("m >= 5"))
    b, n = float(totals["b"]), float(totals["n"])
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
    a, m = F.col("a").cast("double"), F.col("m").cast("double")
    g2 = 2 * (term(a, m * b / n) + term(m - a, m * (n - b) / n) + term(b - a, (n - m) * b / n) + term(n - m - b + a, (n - m) * (n - b) / n))
    top = counts.withColumn("g2", g2).where(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "word").limit(VOCABULARY)
    return np.sort(np.array([r["word"] for r in top.collect()], np.int64).view(_U))


def _rows(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.frombuffer(b.as_buffer(), np.uint16) for b in table.column(name)]
    return np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([*sets, np.zeros(0, np.uint16)]).astype(np.int64)


def step_of(logit: F.Column) -> F.Column:
    """Rank step of a logit: the same for all logits of TOP and more."""
    return F.floor(F.least(logit, F.lit(TOP)) / F.lit(GRAIN)).cast("long")


def cut_step(counts: dict[int, int], most: float) -> int | None:
    """Smallest step such that the steps above it hold fewer than ``most``
    documents; a step is taken whole. None if there is nothing to take."""
    cut, above = None, 0
    for step in sorted(counts, reverse=True):
        if above >= most:
            break
        cut, above = step, above + counts[step]
    return cut


def mixed_view(taught: DataFrame, known: pa.Table, y: np.ndarray, name: str, width: int, part_rows: int) -> View:
    """The mean of the views fitted on the labelled documents with each part of
    the pseudo-labelled ones (``name``, label, turn). Parts are dealt by turn,
    so that copies of one document spread; a part's weights come back added up."""
    spark = taught.sparkSession
    parts = max(1, -(-taught.count() // part_rows))
    shared = spark.sparkContext.broadcast((known.column(name).combine_chunks(), y))  # fit_rows labelled rows at most

    def run(table: pa.Table) -> pa.Table:
        features, truth = shared.value
        both = pa.table({name: pa.chunked_array([features.cast(pa.binary()), *table.column(name).chunks], pa.binary())})
        view = fit_view(*_rows(both, name), np.concatenate([truth, table.column("label").to_numpy()]), width)
        return pa.table({"place": np.arange(width + 1), "value": np.append(view.weights, view.bias)})

    dealt = taught.select(name, "label", F.pmod("turn", F.lit(parts)).alias("part"))
    rows = dealt.groupBy("part").applyInArrow(run, "place long, value double").groupBy("place").agg(F.avg("value").alias("v")).collect()
    w = np.zeros(width + 1)
    for r in rows:
        w[r["place"]] = r["v"]
    return View(w[:-1], float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, rounds: int = 2, fit_rows: int = FIT_ROWS, exchange: float = EXCHANGE,
        part_rows: int = PART_ROWS) -> Model:
    """Co-trains both views on ``docs`` (doc_id, text; lang and source if there)
    and ``labels`` (doc_id, quality, toxic; bad: quality 0 or toxic 1). In a round
    a view gives the other its surest documents of each class, ``exchange`` of all
    unlabelled ones (documents whose logits are one step apart at the border all
    go, fewer where fewer are sure); none is given to a view twice."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_places(docs))
    wanted = staged(_wanted(labels, fit_rows), "labelled")
    labelled = docs.join(F.broadcast(wanted), "doc_id")  # fit_rows rows at most
    seen = labelled.agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not seen["n"] or seen["b"] in (0, seen["n"]):
        return Model((seen["b"] or 0) / max(1, seen["n"]))
    model = Model(seen["b"] / seen["n"], _vocabulary(labelled))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            values = _layout(*_trimmed_words(part.column("text"))[:4])
            yield pa.RecordBatch.from_arrays([pa.array(values[:, k]) for k in range(NUMBERS)], names=[f"v{k}" for k in range(NUMBERS)])

    kinds = ", ".join(f"v{k} double" for k in range(NUMBERS))
    most = fit_rows + fit_rows // 4  # a labelled id may have several rows
    values = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("text").mapInArrow(numbers, kinds).toArrow()
    model.edges = np.stack([np.quantile(values.column(k).to_numpy(), np.linspace(0, 1, BINS + 1)[1:-1]) for k in range(NUMBERS)])
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = []
            for row, col in shared.value.features(part):
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(1, part.num_rows))
                sets.append(pa.array([x.astype(np.uint16).tobytes() for x in np.split(col[order], cuts)], pa.binary()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *sets], names=["doc_id", "text", "page"])

    every = staged(docs.mapInArrow(features, "doc_id long, text binary, page binary"), "features")
    known = every.join(F.broadcast(wanted), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toArrow()
    y = known.column("bad").to_numpy().astype(float)
    held = np.arange(len(y)) % 4 == 0 if len(y) >= 40 else np.zeros(len(y), bool)
    sets, width = {"text": _rows(known, "text"), "page": _rows(known, "page")}, {"text": max(1, len(model.vocabulary)), "page": model.page_width}
    taught: dict[str, list[DataFrame]] = {"text": [], "page": []}
    labelled_rows, number = known.filter(pa.array(~held)), np.cumsum(~held) - 1

    def refit() -> None:
        test = held if held.any() else ~held
        calibrated = []
        for name in ("text", "page"):
            row, col = sets[name]
            use = ~held[row]
            if taught[name]:
                view = mixed_view(reduce(DataFrame.unionByName, taught[name]), labelled_rows, y[~held], name, width[name], part_rows)
            else:
                view = fit_view(number[row[use]], col[use], y[~held], width[name])
            view.scale, view.shift = fit_line(view.logit(row, col, len(y))[test][:, None], y[test])
            setattr(model, name, view)
            calibrated.append(view.logit(row, col, len(y))[test])
        model.mix = fit_line(both_views(*calibrated), y[test])

    refit()
    pool = every.join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_anti")
    size = pool.count()
    past: list[tuple[View, View, dict]] = []  # the views of the rounds before and what they gave
    tables = [every]
    for _ in range(rounds):
        now = spark.sparkContext.broadcast((model.text, model.page, past))

        def sure(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            text_view, page_view, before = now.value
            turn = TaskContext.get().partitionId() * 7919
            for batch in batches:
                table, n = pa.Table.from_batches([batch]), batch.num_rows
                words, page = _rows(table, "text"), _rows(table, "page")
                a, b = text_view.logit(*words, n), page_view.logit(*page, n)
                given = {"page": np.zeros(n, bool), "text": np.zeros(n, bool)}
                for v, w, cuts in before:
                    for pupil, logit in (("page", v.logit(*words, n)), ("text", w.logit(*page, n))):
                        for sign in (1, -1):
                            if (cut := cuts[pupil, sign]) is not None:
                                step = np.floor(np.minimum(sign * logit, TOP) / GRAIN)
                                given[pupil] |= (sign * logit >= SURE_LOGIT) & (step >= cut)
                keep = np.flatnonzero(np.maximum(np.abs(a), np.abs(b)) >= SURE_LOGIT)
                rest = [a, b, given["page"], given["text"], np.arange(turn, turn + n)]
                turn += n
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(keep)) for c in ("text", "page")), *(pa.array(x[keep]) for x in rest)],
                                                 names=["text", "page", "text_logit", "page_logit", "page_has", "text_has", "turn"])

        scored = staged(pool.mapInArrow(sure, "text binary, page binary, text_logit double, page_logit double, page_has boolean, text_has boolean, turn long"),
                        "sure")
        tables.append(scored)
        cuts = {}
        for teacher, pupil in (("text_logit", "page"), ("page_logit", "text")):
            for sign in (1, -1):
                logit = sign * F.col(teacher)
                new = scored.where((logit >= SURE_LOGIT) & ~F.col(f"{pupil}_has"))
                counts = {r["step"]: r["count"] for r in new.groupBy(step_of(logit).alias("step")).count().collect()}  # TOP / GRAIN rows at most
                cut = cuts[pupil, sign] = cut_step(counts, exchange * size)
                if cut is not None:
                    taught[pupil].append(new.where(step_of(logit) >= cut).select(pupil, "turn", F.lit(max(0.0, float(sign))).alias("label")))
        past.append((model.text, model.page, cuts))
        refit()
    discard(wanted, *tables)
    return model


def classify(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` with text_score, page_score, score (chance to be good) and kept
    (score >= least), in one pass over every row. Columns of ``docs`` with
    these names are replaced; other columns stay.

    A null text has no words. Without labelled documents of both classes every
    score is the share of good ones among those there are (1 if none)."""
    new = ["text_score", "page_score", "score", "kept"]
    shared, names = docs.sparkSession.sparkContext.broadcast(model), [c for c in docs.columns if c not in new]
    kinds = dict(docs.dtypes)
    # by number: a column's own name may be anything
    ready = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"in_{k}") for k, c in enumerate(names)], *_places(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            a, b, s = shared.value.score(part)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(a), pa.array(b), pa.array(s), pa.array(s >= least)],
                                             names=[*part.schema.names[: len(names)], *[f"out_{c}" for c in new]])

    given = [f"{'text' if c == 'text' else f'in_{k}'} {kinds[c]}" for k, c in enumerate(names)]
    out = ready.mapInArrow(run, ", ".join([*given, "out_text_score double", "out_page_score double", "out_score double", "out_kept boolean"]))
    return out.select(*[F.col("text" if c == "text" else f"in_{k}").alias(c) for k, c in enumerate(names)], *[F.col(f"out_{c}").alias(c) for c in new])
