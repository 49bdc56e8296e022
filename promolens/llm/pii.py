"""Personal data by bootstrapped contextual extraction.

Base: e-mail addresses, IP addresses, card and phone numbers by fixed
patterns and checks. They are the seeds. One pass over the texts also lists
every identifier-like string (a word with a digit or an at sign, or
neighbouring groups of digits, not part of a seed). A pattern is what stands before a string: the last two words, or the
last word. Patterns and instances (the strings
themselves) form a bipartite graph that Spark scores in rounds: a pattern is
worth the share of one kind among the trust of its distinct instances, times
the logarithm of that kind's trust; strings nobody knows yet weigh little. An
instance is trusted as much as its best pattern. Seeds keep full trust in their kind. Strings under patterns of high confidence in one
kind are new spans of that kind; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import discard, numbered, renamed, slices, staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENT = 0.8
ENOUGH = 7  # seeds of a kind behind a pattern that count in full; fewer by their logarithm
SHORTEST = 4  # code points of a string that may be found; a base span may be shorter
UNKNOWN = 0.1  # what a string without trust weighs against a pattern, a seed of another kind being 1
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_DIGITS = re.compile(r"(?<![\w@])[(\[]?[0-9]++(?![\w@])(?:(?:(?!  |\. )[ .()\[\]/-]){1,3}[0-9]++(?![\w@]))+")
_EDGE = ".,;:!?\"'()[]{}<>"


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        lo = max(end, at - 64)
        local = _LOCAL.search(text, lo, at)
        while local and local.start() == lo > end:  # the name is longer: look further back
            lo = max(end, at - 4 * (at - lo))
            local = _LOCAL.search(text, lo, at)
        domain = _DOMAIN.match(text, at) if local else None
        if domain:
            out.append((local.start(), domain.end()))
            end = domain.end()
        at = text.find("@", max(end, at + 1))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; leftmost matches that do not
    overlap, those that fail their check dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    digits = _HINT.search(text) is not None
    if digits:
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            number = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(number) <= 19 and _luhn(number):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def _whole(word: str, most: int) -> str:
    """A word as it is, or a long one's beginning with its digest: as a whole it is still told apart."""
    return word if len(word) <= most else f"{word[:most - 33]}~{hashlib.md5(word.encode()).hexdigest()}"


def _before(text: str, start: int) -> list[str]:
    """The two whole words before a place, however far away."""
    size = 80
    while True:
        lo = max(0, start - size)
        words = text[lo: start].rstrip("([").lower().split()  # a bracket around it is no word
        if lo == 0 or len(words) > 2:  # the first may be cut
            return [_whole(w, 64) for w in words[-2:]]
        size *= 8


def _runs(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Groups of digits over several words, joined by single spaces, dots,
    hyphens, slashes or brackets, between the seeds."""
    out, lo = [], 0
    for a, b in [*taken, (len(text), len(text))]:
        for m in _DIGITS.finditer(text, lo, max(lo, a)):
            start, end = m.span()
            if text[start] in "([" and ")]"["([".index(text[start])] not in m[0]:
                start += 1  # a bracket around more than the number
            if " " in m[0] and end - start >= SHORTEST:
                out.append((start, end))
        lo = max(lo, b)
    return out


def mentions(text: str) -> list[tuple[int, int, int, str, list[str]]]:
    """(kind or -1, start, end, string, patterns) of seeds and of other
    identifier-like strings."""
    seeds = base_spans(text)
    out, taken = [], sorted((a, b) for _, a, b in seeds)
    found = [(KINDS.index(k), a, b) for k, a, b in seeds]
    at, runs = 0, _runs(text, taken)
    found += [(-1, a, b) for a, b in runs]
    taken = sorted(taken + runs)
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _EDGE:
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if b - a >= SHORTEST and not (at < len(taken) and taken[at][0] < b):
            found.append((-1, a, b))
    for kind, a, b in found:
        left = _before(text, a)
        patterns = [" ".join(left), left[-1]] if len(left) == 2 else left
        out.append((kind, a, b, _whole(text[a:b].lower(), 256), patterns))
    return out


def _extract(docs: DataFrame) -> DataFrame:
    """A row per mention of each document: (k1, k2, kind, start, end, instance, patterns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows: list[list] = [[] for _ in range(7)]
            for k1, k2, text in zip(*(part.column(c).to_pylist() for c in ("k1", "k2", "text")), strict=True):
                if text and ("@" in text or _HINT.search(text)):
                    for kind, a, b, word, patterns in mentions(text):
                        for c, v in zip(rows, (k1, k2, kind, a, b, word, patterns), strict=True):
                            c.append(v)
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)],
                                             names=["k1", "k2", "kind", "start", "end", "instance", "patterns"])

    return docs.mapInArrow(run, "k1 long, k2 long, kind long, start long, end long, instance string, patterns array<string>")


def confident_patterns(found: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENT) -> DataFrame:
    """(pattern, kind, worth) of the patterns to trust, at most one kind each.

    The graph has one edge for each distinct (pattern, instance), so a string
    that repeats counts once and a hot pattern costs its distinct strings."""
    edges = staged(found.select(F.explode("patterns").alias("pattern"), F.xxhash64("instance").alias("instance"), "kind")
                   .groupBy("pattern", "instance").agg(F.max("kind").alias("seed")), "edges")
    trust = edges.where("seed >= 0").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("trust")).distinct()
    degree = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("degree"))
    worth = None
    for _ in range(rounds):
        known = edges.join(trust, "instance").groupBy("pattern", "kind").agg(F.sum("trust").alias("sum"), F.count(F.lit(1)).alias("n"))
        every = known.groupBy("pattern").agg(F.sum("sum").alias("all"), F.sum("n").alias("n")).join(degree, "pattern")
        weight = F.col("all") + UNKNOWN * F.greatest(F.lit(0), F.col("degree") - F.col("n"))
        per = known.drop("n").join(every, "pattern").withColumn("worth", F.col("sum") / weight * F.least(F.lit(1.0), F.log2(F.col("sum") + 1) / F.log2(F.lit(ENOUGH + 1.0))))
        new = staged(per.select("pattern", "kind", "worth"), "patterns")
        if worth is not None:
            discard(worth)
        worth = new
        spread = (edges.where("seed < 0").join(worth.where(F.col("worth") >= least), "pattern")
                  .groupBy("instance").agg(F.max(F.struct("worth", "kind")).alias("b")))
        seeds = edges.where("seed >= 0").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("trust")).distinct()
        trust = seeds.unionByName(spread.select("instance", "b.kind", F.col("b.worth").alias("trust")))
    best = worth.where(F.col("worth") >= least).groupBy("pattern").agg(F.max(F.struct("worth", "kind")).alias("b"))
    return best.select("pattern", "b.kind", "b.worth")


def spans(docs: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENT) -> tuple[DataFrame, DataFrame]:
    """(keyed, found): ``keyed`` are the documents with (__k1, __k2), a hash of
    (doc_id, text); ``found`` has a row per span: (k1, k2, kind, start, end, base)."""
    keyed = docs.withColumns({"__k1": F.xxhash64(F.lit(1), "doc_id", "text"), "__k2": F.xxhash64("text", "doc_id", F.lit(2))})
    # rows that repeat with doc_id and text have the same spans: one of them is enough
    all_found = staged(_extract(keyed.select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "text")).dropDuplicates(["k1", "k2", "kind", "start"]), "mentions")
    trusted = confident_patterns(all_found, rounds, least)
    new = (all_found.where("kind < 0").select("k1", "k2", "start", "end", F.explode("patterns").alias("pattern"))
           .join(trusted, "pattern").groupBy("k1", "k2", "start", "end").agg(F.max(F.struct("worth", "kind")).alias("b"))
           .select("k1", "k2", "b.kind", "start", "end", F.lit(False).alias("base")))
    return keyed, all_found.where("kind >= 0").select("k1", "k2", "kind", "start", "end", F.lit(True).alias("base")).unionByName(new)


def _joined(rows: str) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(rows), lambda s: F.concat_ws(
        ":", F.element_at(names, (s["kind"] + 1).cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENT) -> DataFrame:
    """Per document: (doc_id, n_email, n_ip, n_card, n_phone, base_sha256,
    spans, n_found): counts and digest of the base spans, all spans as
    ``kind:start:end``, the number that the method added.

    Offsets are code points, ends exclusive. Null and blank texts have no
    span; rows that repeat, or whose doc_id is null, have their own row each;
    other columns are not read."""
    keyed, found = spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rounds, least)
    span = F.struct("kind", "start", "end")
    per = found.groupBy("k1", "k2").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == i), 1)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("every"),
        F.count(F.when(~F.col("base"), 1)).alias("n_found"))
    none = F.lit(0).cast("long")
    per = per.withColumnsRenamed({"k1": "__k1", "k2": "__k2"})
    return (keyed.select("doc_id", "__k1", "__k2").join(per, ["__k1", "__k2"], "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", none).alias(f"n_{k}") for k in KINDS],
                    F.sha2(F.coalesce(_joined("base"), F.lit("")), 256).alias("base_sha256"),
                    F.coalesce(_joined("every"), F.lit("")).alias("spans"), F.coalesce("n_found", none).alias("n_found")))


def redact(docs: DataFrame, rounds: int = ROUNDS, least: float = CONFIDENT) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle
    brackets (the earlier span where two overlap); other columns as they are."""
    docs_ = numbered(docs)
    names = docs_.columns
    keyed, found = spans(docs_, rounds, least)
    per = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("found_spans")).withColumnsRenamed({"k1": "__k1", "k2": "__k2"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            out = []
            for text, marks in zip(part.column("t").to_pylist(), part.column("s").to_pylist(), strict=True):
                if text is not None and marks:
                    pieces, at = [], 0
                    for m in marks:
                        if m["start"] >= at:
                            pieces += [text[at: m["start"]], f"<{KINDS[m['kind']]}>"]
                            at = m["end"]
                    text = "".join([*pieces, text[at:]])
                out.append(text)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(out, pa.string())], names=[*[f"c{k}" for k in range(len(names))], "redacted"])

    rows = keyed.join(per, ["__k1", "__k2"], "left").select(*[F.col(c).alias(f"c{k}") if c != "text" else F.lit(None).cast("string").alias(f"c{k}")
                                                          for k, c in enumerate(names)], F.col("text").alias("t"), F.col("found_spans").alias("s"))
    kinds = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs_.schema.fields))
    out = rows.mapInArrow(run, f"{kinds}, redacted string")
    out = out.select(*[F.col("redacted").alias(c) if c == "text" else F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
    return renamed(out, docs)
