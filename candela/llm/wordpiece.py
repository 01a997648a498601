"""Operator 9: token counts with a linear longest-match automaton.

The vocabulary is a trie.  Where no child fits, a node's failure link leads to the node that
holds the rest after its longest pieces have been popped, and the number of popped pieces is
stored with the link.  One pass over a word's letters therefore counts its greedy word pieces
without building any.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from candela.llm.common import map_rows

#: Words are cut into runs of letters and digits and single other characters.
PIECES = r"\w+|[^\w\s]"
CACHE_WORDS = 300_000
CACHE_WORD_CHARS = 64


class LongestMatch:
    """Counts greedy word pieces: ``heads`` begin a word, ``tails`` go on inside one.

    A word that cannot be cut into pieces, or has more than ``most_chars`` letters where that is given, counts as
    one unknown token.
    """

    def __init__(self, heads: Iterable[str], tails: Iterable[str], most_chars: int | None = None):
        self.most_chars = most_chars
        # Node 0 is the root of the word's beginning, node 1 that of the pieces inside.
        self.next: list[dict[str, int]] = [{}, {}]
        self.ends = [False, False]
        for root, pieces in ((0, heads), (1, tails)):
            for piece in pieces:
                if piece:
                    self._add(root, piece)
        self._link()
        self.cache: dict[str, int] = {}

    def _add(self, root: int, piece: str) -> None:
        node = root
        for c in piece:
            if c not in self.next[node]:
                self.next[node][c] = len(self.next)
                self.next.append({})
                self.ends.append(False)
            node = self.next[node][c]
        self.ends[node] = True

    def _link(self) -> None:
        """Breadth first: a node's link comes from its parent's, as far up the chain as needed."""
        n = len(self.next)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [0, 1]
        while level:
            below = []
            for node in level:
                for c, child in self.next[node].items():
                    below.append(child)
                    if self.ends[child]:
                        self.fail[child], self.popped[child] = 1, 1
                        continue
                    z, count = self.fail[node], self.popped[node]
                    while z >= 0 and c not in self.next[z]:
                        z, count = self.fail[z], count + self.popped[z]
                    if z >= 0:
                        self.fail[child], self.popped[child] = self.next[z][c], count
            level = below

    def count(self, word: str) -> int:
        """Pieces of one word; 1 if it is unknown."""
        if self.most_chars is not None and len(word) > self.most_chars:
            return 1
        node, tokens = 0, 0
        for c in word:
            while c not in self.next[node]:
                if self.fail[node] < 0:
                    return 1
                tokens += self.popped[node]
                node = self.fail[node]
            node = self.next[node][c]
        # The end of a word fits no child: pop until nothing is left.
        while node != 1:
            if self.fail[node] < 0:
                return 1
            tokens += self.popped[node]
            node = self.fail[node]
        return tokens

    def counts(self, words: list[str]) -> list[int]:
        known = list(map(self.cache.get, words))
        if None not in known:
            return known
        for i, k in enumerate(known):
            if k is None:
                word = words[i]
                if (k := self.cache.get(word)) is None:
                    k = self.count(word)
                    if len(word) <= CACHE_WORD_CHARS:
                        if len(self.cache) >= CACHE_WORDS:
                            self.cache.clear()
                        self.cache[word] = k
                known[i] = k
        return known


def from_sentencepiece(path: str, mark: str = "▁", most_chars: int | None = None) -> LongestMatch:
    """Heads are the pieces with a word-start mark, tails those without; control and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    heads, tails = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        (heads if piece.startswith(mark) else tails).append(piece.removeprefix(mark))
    return LongestMatch(heads, tails, most_chars)


_LOADED: dict[str, LongestMatch] = {}


def load(path: str) -> LongestMatch:
    """One automaton per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = from_sentencepiece(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``n_words`` and ``n_tokens`` (long) to every row.

    A map without a shuffle; ``path`` must exist on every executor.  Null and empty texts have
    no words and no tokens; texts of any length are counted whole; repeated rows are counted alike; an empty
    table gives no rows.  Clashing column names get an underscore appended.
    """
    def make():
        import re
        automaton, words_of = load(path), re.compile(PIECES).findall

        def work(texts):
            n_words, n_tokens = [], []
            for t in texts:
                words = words_of(t or "")
                n_words.append(len(words))
                n_tokens.append(sum(automaton.counts(words)))
            return n_words, n_tokens
        return work

    return map_rows(docs, text, make, [("n_words", T.LongType()), ("n_tokens", T.LongType())])
