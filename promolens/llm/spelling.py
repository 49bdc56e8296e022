"""Spelling variants of words by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. The longer word (either of two of one length) gives two disjoint chunks, its
halves; the other gives its positional grams that can lie on them. One edit preserves a chunk:
the first half at its place, or the second shifted by the difference of the lengths,
which is at most one. Halves such as a common ending would bring a large part of the vocabulary
together, so the half that holds the edit is cut in two by the same rule, and the piece that the edit spares
joins the key: of each word's four quarters three meet. Candidates are verified by edit distance in
the join itself; a pair counts at the first of the four keys it has in common.

Defined cases: a null text has no words; a null id is the empty string before the colon;
a word without near words has no form and is its own root; of equal counts the smaller
word is the form; an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import discard, slices, staged

LEAST = 7  # code points of a word
OCCURS = 2
TIMES = 10  # a form occurs so many times as often
DROP = 31  # runs whose checksum it divides lose a code point
HELD = 200_000  # words a task counts before it hands them on
_RUN = re.compile("[a-zÀ-ÿ]+")


def _count(least: int, drop: int):
    """(word, n) of a slice after slice, summed in the task until many words are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for b in slices(batches, "text"):
            for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{key}:".encode())
                # bytes.lower() lowers A to Z only
                for word, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                    if len(word) < least:
                        continue
                    h = zlib.crc32(word.encode(), start)
                    if h % drop == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    return run


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, occurs: int = OCCURS, drop: int = DROP) -> DataFrame:
    """(word, n): the words of whole texts that are long and frequent enough."""
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text}`").alias("text"))
    counted = rows.mapInArrow(_count(least, drop), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurs)


def _quarters(size: Column) -> list[tuple[Column, Column]]:
    """For each key the code points it takes from the front and from the end of a word
    of ``size``: all but the fourth, third, second and first quarter."""
    half = F.floor((size + 1) / 2)
    rest = size - half
    front, back = F.floor((half + 1) / 2), F.floor((rest + 1) / 2)
    return [(half + back, F.lit(0)), (half, rest - back), (front, rest), (F.lit(0), size - front)]


def _ends(word: Column, front: Column, back: Column) -> tuple[Column, Column]:
    return F.substring(word, F.lit(1), front.cast("int")), F.when(back > 0, F.right(word, back.cast("int"))).otherwise(F.lit(""))


def _keys(words: DataFrame, size: Column) -> DataFrame:
    """(k, key, size, word, n): the keys of a word beside a longer word of ``size`` code points."""
    keys = [F.struct(F.lit(i).alias("k"), F.concat_ws(" ", *_ends(F.col("word"), f, b)).alias("key"), size.cast("int").alias("size"))
            for i, (f, b) in enumerate(_quarters(size))]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("x")).select("x.*", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every two words that differ by one edit, once."""
    size = F.char_length("word")
    longer = _keys(words, size).select("k", "key", "size", F.col("word").alias("a"), F.col("n").alias("n_a"))
    shorter = (_keys(words, size).unionByName(_keys(words, size + 1))
               .select("k", "key", "size", F.col("word").alias("b"), F.col("n").alias("n_b")))
    a, b = F.col("a"), F.col("b")
    agree = []
    for f, e in _quarters(F.col("size")):
        (a1, a2), (b1, b2) = _ends(a, f, e), _ends(b, f, e)
        agree.append((a1 == b1) & (a2 == b2))
    earlier = (F.when(F.col("k") > 0, agree[0]).otherwise(False) | F.when(F.col("k") > 1, agree[1]).otherwise(False)
               | F.when(F.col("k") > 2, agree[2]).otherwise(False))
    same = F.char_length(b) == F.col("size")
    pairs = longer.join(shorter, ["k", "key", "size"]).where((~same | (a < b)) & (F.levenshtein(a, b, 1) == 1) & ~earlier)
    return pairs.select("a", "n_a", "b", "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, the distance doubled a round."""
    cur = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = staged(cur.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        discard(cur)
        cur = new
        if cur.where("moved").isEmpty():
            return cur.select("word", "root")
        cur = cur.select("word", "root")
        cur._staged_path = new._staged_path


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n; each word once).

    The form is the most frequent near word if it occurs ``times`` as often."""
    words = staged(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.lit(None).cast("long").alias("n"), F.struct((-F.col("n_b")).alias("m"), F.col("b").alias("w")).alias("near")),
        F.struct(F.col("b").alias("word"), F.lit(None).cast("long").alias("n"), F.struct((-F.col("n_a")).alias("m"), F.col("a").alias("w")).alias("near"))))
        .alias("x")).select("x.*")
    none = words.select("word", "n", F.lit(None).cast("struct<m: bigint, w: string>").alias("near"))
    best = (none.unionByName(ways).groupBy("word")
            .agg(F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("near").alias("near"))
            .withColumn("is_form", F.coalesce(-F.col("near.m") >= times * F.col("n"), F.lit(False))))
    best = staged(best.select("word", "n", "n_near", F.when(F.col("is_form"), F.col("near.w")).alias("form"),
                              F.when(F.col("is_form"), -F.col("near.m")).alias("form_n")), "forms")
    roots = _roots(best.where(F.col("form").isNotNull()))
    return best.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_variants(docs: DataFrame) -> DataFrame:
    """Words of all documents with their forms and roots."""
    return variants(vocabulary(docs))
