"""Token ids of whole texts with a public tokenizer file.

Both vocabularies cut a text before a lone space or line break that stands
between two other characters, and between letters and a tail of full stops
and commas, whatever is around them. A text's ids are therefore the ids of
such chunks on end; a worker encodes each distinct chunk once and keeps it
in a bounded table. All ids come from the tokenizers library.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

_CUT = re.compile(r"(?<=\S) (?=\S)")
_RARE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
_ADJACENT = ("  ", "\n ", " \n", "\n\n", "\t", "\r", "\x0b", "\x0c")
KEEP = 900_000  # chunks in a worker's table, about 240 bytes each
LONGEST = 48


_LATIN = "\u0250"  # letters below it are composed, and are lowered one by one


def _byte_signs() -> list[str]:
    """Byte-level spelling: visible Latin-1 bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


_SIGNS = dict(enumerate(_byte_signs()))


def _spelt(word: str) -> str:
    return word.encode().decode("latin-1").translate(_SIGNS)


def _word(core: str) -> bool:
    """Letters that neither composing nor lowering turns into other than letters."""
    return core.isalpha() and max(core) < _LATIN and "\u0130" not in core


def _plain(text: str) -> bool:
    """No white space but single spaces and line breaks, each between other characters or at an end."""
    return not (any(a in text for a in _ADJACENT) or _RARE.search(text))


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian bytes,
    ``width`` bytes an id."""

    def __init__(self, path: str, keep: int = KEEP):
        self.keep = keep
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.code = "H" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.lower = self.tok.encode("A", add_special_tokens=False).ids == self.tok.encode("a", add_special_tokens=False).ids
        self.stop_id, self.stop = next((i, t.content) for i, t in self.tok.get_added_tokens_decoder().items()
                                       if not (t.single_word or t.lstrip or t.rstrip))
        self.chunks: dict[str, bytes] = {}  # of chunks after a text's first, with their space
        self.atoms: dict[str, bytes] = {}  # of strings as they are
        self.passing: list[str] = []
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        names = [self.tok.id_to_token(i) or "" for i in range(size)]
        self.begins = np.array([t.startswith("\u0120") for t in names])  # the byte-level sign of a space
        self.ends = np.array([t.endswith("</w>") for t in names])
        self.spaced = not self.ends.any()
        self.sign = "\u0120" if self.spaced else ""

    def _ids(self, text: str) -> bytes:
        return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, atoms: set[str]) -> None:
        """Encode new atoms many at a time, an added token behind each."""
        new = list(atoms - self.atoms.keys())
        if len(self.atoms) + len(new) > self.keep // 2:
            self.passing += new  # forgotten after this call: what came first is frequent
        table, w8 = self.atoms, self.width
        # Latin words need neither an added token between them (their ids show where one begins or ends) nor the
        # normaliser: the model takes them as they are, in their byte-level spelling
        words = [a for a in new if a[:1] == " " and a[1:].isalpha() and (a.isascii() or _word(a[1:]))]
        for lo in range(0, len(words), 4096):
            some = words[lo: lo + 4096]
            line = " ".join([self.sign + (a[1:] if a.isascii() else _spelt(a[1:])) for a in some])
            ids = np.array(self.bare.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.code)
            if self.spaced:
                cuts = [*(np.flatnonzero(self.begins[ids]) * w8).tolist(), len(ids) * w8]
            else:
                cuts = [0, *((np.flatnonzero(self.ends[ids]) + 1) * w8).tolist()]
            if len(cuts) == len(some) + 1:
                raw = ids.tobytes()
                for a, x, y in zip(some, cuts, cuts[1:], strict=False):
                    table[a] = raw[x:y]
        plain = [a for a in new if "<|" not in a and a not in table]
        for lo in range(0, len(plain), 4096):
            some = plain[lo: lo + 4096]
            line = self.stop.join(some) + self.stop
            ids = array(self.code, self.tok.encode_batch_fast([line], add_special_tokens=False)[0].ids)
            raw, find, at = ids.tobytes(), ids.index, 0
            for a in some:
                end = find(self.stop_id, at)
                table[a] = raw[at * w8: end * w8]
                at = end + 1
        for a in new:
            if "<|" in a:
                table[a] = self._ids(a)

    def _parts(self, chunk: str, lead: str) -> list[str]:
        """Atoms of a chunk; a chunk from a line break on has no space before it."""
        parts = []
        if lead and chunk[:1] == "\n":
            parts, chunk, lead = ["\n"], chunk[1:], ""
        core = chunk.rstrip(".,")
        if _word(core):
            tail = chunk[len(core):]
            core = core.lower() if self.lower else core
            return [*parts, lead + core, tail] if tail else [*parts, lead + core]
        return [*parts, lead + chunk] if lead or chunk else parts

    def _fill(self, words: list[str]) -> dict[str, bytes]:
        """Ids of chunks that the table lacks; most are a word and a tail."""
        known, lower, made = self.atoms, self.lower, {}
        keys, cores, tails, odd = [], [], [], {}
        for w in dict.fromkeys(words):
            core = w.rstrip(".,")
            if core.isalpha() and (core.isascii() or _word(core)):
                keys.append(w)
                tails.append(w[len(core):])
                cores.append(" " + (core.lower() if lower else core))
            else:
                odd[w] = self._parts(w, " ")
        need = set(cores)
        need.update(tails)
        for p in odd.values():
            need.update(p)
        need.discard("")
        self._learn(need)
        for w, core, tail in zip(keys, cores, tails, strict=True):
            made[w] = known[core] + known[tail] if tail else known[core]
        for w, p in odd.items():
            made[w] = b"".join([known[a] for a in p])
        if len(self.chunks) < self.keep:
            self.chunks.update((w, b) for w, b in made.items() if len(w) <= LONGEST)
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " \n").split(" ") if _plain(t) else _CUT.split(t) for t in texts]
        heads = [self._parts(p[0], "") for p in split]
        words = [w for p in split for w in p[1:]]
        got = list(map(self.chunks.get, words))
        if None in got:
            lost = [i for i, b in enumerate(got) if b is None]
            made = self._fill([words[i] for i in lost])
            for i in lost:
                got[i] = made[words[i]]
        self._learn({a for p in heads for a in p})
        out, at = [], 0
        for p, h in zip(split, heads, strict=True):
            end = at + len(p) - 1
            out.append(b"".join([self.atoms[a] for a in h]) + b"".join(got[at:end]))
            at = end
        for a in self.passing:
            del self.atoms[a]
        self.passing = []
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """The worker's encoder for a file; Python workers are reused, and so are
    its tables."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, keep)
    return _ENCODERS[path]
