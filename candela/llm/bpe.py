"""Operator 4: byte-pair encoding and decoding with a segment tree of pair ranks.

The leaves of a word's tree are the ranks of its adjacent pairs; the root is the lowest rank
and, among equal ranks, the leftmost place.  A merge changes three leaves, each in
logarithmic time, until the root says that no pair can be merged.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from candela.llm.common import map_rows

#: Words that a Python worker remembers; the memory is emptied when it is full.
CACHE_WORDS = 250_000
#: Longer words are encoded each time, so that the memory stays small.
CACHE_WORD_CHARS = 64
#: Texts without characters from here on (all of Latin comes before) take the quicker pattern.
NEAR = 0x250
#: Signs that Unicode 3.2 does not know: what they are, how they compose and which case they have depends on the release that a
#: library holds.  Texts with such a sign are normalised and cut into words by the tokenizers library itself.
def _unsure() -> re.Pattern:
    known = unicodedata.ucd_3_2_0.category
    new = [c for c in range(NEAR, sys.maxunicode + 1) if known(chr(c)) in ("Cn", "Cs")]
    ranges, start = [], new[0]
    for a, b in zip(new, [*new[1:], -1]):
        if b != a + 1:
            ranges.append(f"\\U{start:08x}-\\U{a:08x}")
            start = b
    return re.compile(f"[{''.join(ranges)}]")


_NONE = 1 << 62
_PLACE = 32


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in shown else extra))
        extra += b not in shown
    return letters


def near_pattern(pattern: str) -> str:
    """The pattern for texts of characters below ``NEAR``, its classes written out for the quicker ``re``."""
    import regex

    def listed(kind: str) -> str:
        found = regex.compile(kind)
        return "".join(re.escape(chr(c)) for c in range(NEAR) if found.match(chr(c)))

    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(kind, listed(kind))
    return pattern


class WordBpe:
    """A lower-casing byte-level BPE with word ends, read from a ``tokenizers`` JSON file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names: dict[int, str] = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self.base = max(self.names) + 1
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] * self.base + vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.near = re.compile(near_pattern(pattern)).findall
        self.far = re.compile(f"[{chr(NEAR)}-{chr(0x10FFFF)}]").search
        self.unsure = _unsure().search
        self.library = Tokenizer.from_file(path)
        self.letters = {c: i for i, c in enumerate(letters)}
        self.cache: dict[str, bytes] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merges symbols as the ranks say; ``ids`` is used up."""
        n, base, ranks, merged = len(ids), self.base, self.ranks, self.merged
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks.get(ids[i] * base + ids[i + 1])
            if rank is not None:
                tree[size + i] = rank << _PLACE | i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            i = size + leaf
            if tree[i] == value:
                return
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                low = a if a < b else b
                if tree[i] == low:
                    return
                tree[i] = low
                i >>= 1

        while (root := tree[1]) != _NONE:
            i = root & ((1 << _PLACE) - 1)
            j = after[i]
            k = after[j]
            ids[i] = new = merged[root >> _PLACE]
            after[i] = k
            if j < n - 1:
                put(j, _NONE)
            ids[j] = -1
            if k < n:
                before[k] = i
                rank = ranks.get(new * base + ids[k])
                put(i, _NONE if rank is None else rank << _PLACE | i)
            else:
                put(i, _NONE)
            if (h := before[i]) >= 0:
                rank = ranks.get(ids[h] * base + new)
                put(h, _NONE if rank is None else rank << _PLACE | h)
        return [x for x in ids if x >= 0]

    def _merged(self, raw: bytes) -> bytes:
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return np.array(self.merge(ids), "<u4").tobytes()

    def word(self, word: str) -> bytes:
        out = self._merged(word.encode())
        if len(word) <= CACHE_WORD_CHARS:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = out
        return out

    def plain(self, text: str) -> bytes:
        if self.far(text) and self.unsure(text):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join(self._merged(bytes(map(self.letters.__getitem__, piece))) for piece, _ in cut)
        if not text.isascii():
            # Lower-casing goes letter by letter: no special form of sigma at a word's end.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        words = self.words(text) if self.far(text) else self.near(text)
        known = list(map(self.cache.get, words))
        if None in known:
            word, cache = self.word, self.cache
            known = [k if k is not None else cache.get(w) or word(w) for k, w in zip(known, words)]
        return b"".join(known)

    def encode(self, text: str | None) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers; special tokens in a text are found."""
        if not text:
            return b""
        if not self.split_special.search(text):
            return self.plain(text)
        return b"".join(np.uint32(self.special[x]).astype("<u4").tobytes() if x in self.special else self.plain(x)
                        for x in self.split_special.split(text) if x)

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between: the file names no decoder that would join them otherwise."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One model per Python worker and file; a reused worker keeps what it knows."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (string) to every row.

    A map without a shuffle: each task loads the vocabulary from ``path``, which must exist on
    every executor.  Null and empty texts give empty ids and an empty string.  Texts of any length are encoded whole;
    repeated rows each get their result.  Clashing column names get an underscore appended.
    """
    def make():
        model = load(path)

        def work(texts):
            ids = [model.encode(t) for t in texts]
            return ids, [model.decode(x) for x in ids]
        return work

    return map_rows(docs, text, make, [("ids", T.BinaryType()), ("decoded", T.StringType())])
