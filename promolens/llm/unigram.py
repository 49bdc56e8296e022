"""Token counts under a unigram model, with shared prefixes scored once.

A text's pre-tokens are its white-space separated words, each behind the word
sign. The model's pieces have scores; a pre-token's tokens are the best
scoring split into pieces (a character without a piece costs its UTF-8 bytes
as byte tokens). The best split of a prefix does not depend on what follows,
so distinct pre-tokens go into a trie whose nodes hold the forward state of
their prefix: the best score and its number of tokens. A new pre-token only
scores the characters past its longest known prefix; its end node keeps the
count, and every occurrence anywhere reads it there.

Each worker keeps one trie of bounded size across its tasks; what comes first,
and so is frequent, stays, and the bound changes no count. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import slices

SIGN = "▁"
MAX_NODES = 500_000
MAX_ENDS = 500_000
LONGEST = 64  # characters of a pre-token that is kept


def zipf_scores(path: str) -> dict[str, float]:
    """Piece -> log of a Zipf weight by the piece's rank in a SentencePiece
    file; byte, control and unknown pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    total = math.log(sum(1 / (r + 2.7) for r in range(len(ranked))))
    return {sp.id_to_piece(i): -math.log(r + 2.7) - total for r, i in enumerate(ranked)}


class Trie:
    """Forward scores of the prefixes met so far.

    ``best[v]`` and ``count[v]`` are those of node v's prefix; equal scores
    go to the split with fewer tokens. ``pieces`` holds the vocabulary read
    backwards (nested by character, a piece's score under ``""``), so the
    pieces that end at a character are found in one walk."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.byte_score = min(scores.values(), default=0.0) - 10.0
        self.pieces: dict = {}
        for piece, score in scores.items():
            node = self.pieces
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score
        self.children: list[dict[str, int]] = [{}]
        self.best, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}  # pre-token (without its sign) -> tokens

    def insert(self, token: str) -> int:
        """Token count of a pre-token, scoring only its new characters; a full
        trie scores them without keeping their nodes."""
        node, best, count = 0, [0.0], [0]  # forward states along the path
        for c in token:
            step = self.children[node].get(c)
            if step is None:
                break
            node = step
            best.append(self.best[node])
            count.append(self.count[node])
        keep = len(self.best) + len(token) < MAX_NODES and len(token) <= LONGEST
        for end in range(len(best), len(token) + 1):
            c = token[end - 1]
            size = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
            top, n = best[end - 1] + size * self.byte_score, count[end - 1] + size
            piece = self.pieces
            for start in range(end - 1, -1, -1):
                piece = piece.get(token[start])
                if piece is None:
                    break
                score = piece.get("")
                if score is not None:
                    total, tokens = best[start] + score, count[start] + 1
                    if total > top or total == top and tokens < n:
                        top, n = total, tokens
            best.append(top)
            count.append(n)
            if keep:
                self.children[node][c] = node = len(self.best)
                self.children.append({})
                self.best.append(top)
                self.count.append(n)
        return count[-1]


_TRIES: dict[str, Trie] = {}


def _trie(path: str) -> Trie:
    if path not in _TRIES:
        _TRIES[path] = Trie(zipf_scores(path))
    return _TRIES[path]


def count_texts(texts: list[str], trie: Trie) -> list[tuple[int, int]]:
    """(pre-tokens, tokens) of each text."""
    out, known = [], trie.terminal
    for text in texts:
        words = text.split()
        got = list(map(known.get, words))
        if None in got:
            for i, n in enumerate(got):
                if n is None:
                    w = words[i]
                    got[i] = n = trie.insert(SIGN + w)
                    if len(known) < MAX_ENDS and len(w) <= LONGEST:
                        known[w] = n
        out.append((len(words), sum(got)))
    return out


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per document: (doc_id, n_pretokens, n_tokens) of the whole text.

    Null and blank texts count nothing; repeated rows and null doc_ids have
    their own row each; other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for part in slices(batches, "text"):
            got = count_texts(part.column("text").fill_null("").to_pylist(), trie)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([a for a, _ in got], pa.int64()), pa.array([b for _, b in got], pa.int64())],
                                             names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
