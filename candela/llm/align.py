"""Operator 11: alignment of two tokenizers by pointer jumping.

The tokens of both tokenizers tile the same bytes.  Every token points to the token that overlaps it
and reaches farthest to the right (a token of B that no token of A outreaches points to itself).
Following the pointers, with the distance doubled in every round and all tokens of a batch in one
vector, ends at the last token of B before the next common cut: that token names the group.

The links (pairs of overlapping tokens) are written once; their counts over the corpus are an
aggregate that starts in each task.  The most frequent pairs, a bounded table, go to every
task, the rest are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm.bpe import byte_letters
from candela.llm.common import materialize, slices, spare_name
from candela.llm.remember import Remembered

#: UTF-8 bytes of text that are aligned at once (one longer text still passes whole).
BATCH_BYTES = 1 << 19
#: Pairs that every task gets as a table (13 bytes each); all others are joined.
HOT_PAIRS = 1 << 18
#: Links that a task counts before it passes its counts on.
COUNTED_LINKS = 1 << 21
#: Where texts are cut into pieces: before a space or newline between two characters that no whitespace
#: class holds.  Both tokenizers always cut there (checked for B on its vocabulary).
CUT = re.compile("(?<![\\s\u180e])(?=[ \n][^\\s\u180e])")
#: Texts without any of this are cut at every space and newline.
ODD = re.compile("[\\s\u180e][\\s\u180e]|^\\s|\\s\\Z|[^\\S \n]|\u180e")

#: The split that byte-level vocabularies of this kind use (a fixed value of the format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, numbers and spaces below this sign are the same in every Unicode release that a library may hold.
FAR = re.compile("[\u0250-\U0010ffff]")

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def piece_bytes(piece: str) -> bytes:
    """Bytes of a SentencePiece piece."""
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers, their token bytes and what they gave for pieces of text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        value = {c: i for i, c in enumerate(byte_letters())}
        spec = json.load(open(a_path, encoding="utf-8"))
        names = dict(spec["model"]["vocab"])
        special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        a_bytes = {i: special.get(i) or bytes(value[c] for c in t) for t, i in names.items()} | special
        self.n_a, self.n_b = max(a_bytes) + 1, self.b.get_piece_size()
        self.a_length = np.array([len(a_bytes.get(i, b"")) for i in range(self.n_a)], np.int64)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [piece_bytes(p) for p in pieces]
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.kind = np.dtype("<u4" if self.n_a * self.n_b <= 1 << 32 else "<u8")
        self.names = [str(i).encode() + end for end in (b",", b"|", b";") for i in range(max(self.n_a, self.n_b))]
        self.quick = self._quick(spec, a_bytes, special)
        self.pieces = Remembered(lambda pieces: list(zip(self._encode_a(pieces), self._encode_b(pieces))))

    def _quick(self, spec: dict, a_bytes: dict[int, bytes], special: dict[int, bytes]):
        """The same vocabulary in ``tiktoken``, where the merges stand in the order of the ids; else None."""
        ranks = {x: i for i, x in a_bytes.items() if i not in special}
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        if [spec["model"]["vocab"][t] for t in made] != sorted(ranks.values())[256:] or not spec["pre_tokenizer"].get("use_regex"):
            return None
        import tiktoken
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _encode_a(self, pieces: list[str]) -> list[bytes]:
        pieces = [p if p[0] == "\n" else " " + p for p in pieces]
        out = [None if self.quick is None or FAR.search(p) else array("I", self.quick(p)).tobytes() for p in pieces]
        slow = [p for p, x in zip(pieces, out) if x is None]
        found = iter(self.a.encode_batch(slow, add_special_tokens=False))
        return [array("I", next(found).ids).tobytes() if x is None else x for x in out]

    def _encode_b(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of B, which sets a space before each piece (taken off again before a newline); None if it changes the piece."""
        out = []
        for piece, ids in zip(pieces, self.b.encode(pieces, num_threads=1)):
            line = piece[0] == "\n"
            if line:
                ids = ids[1:]
            keeps = b"".join(map(self.b_bytes.__getitem__, ids)) == (piece if line else " " + piece).encode()
            out.append(array("I", ids).tobytes() if keeps else None)
        return out

    def split(self, text: str | None) -> list[str]:
        """Pieces of a space and the text; the space that begins a piece is left out, a newline is kept."""
        if not text:
            return []
        if not self.cuts:
            return [text]
        if not ODD.search(text):
            return text.replace("\n", " \n").split(" ")
        return [p[1:] if p[0] == " " else p for p in CUT.split(" " + text) if p]

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of every text in A and in B; both empty where there is no text or B changes it."""
        # a text that begins with a newline would look like a line of another: it is taken apart from the rest
        apart = {i for i, t in enumerate(texts) if t and t[0] == "\n"}
        split = [self.split(None if i in apart else t) for i, t in enumerate(texts)]
        known = self.pieces.table(set().union(*split)).__getitem__
        a, b = [], []
        for i, mine in enumerate(split):
            ids = (b"", b"")
            if i in apart:
                ids = self._whole(texts[i])
            elif mine:
                both = tuple(zip(*map(known, mine)))
                if None not in both[1]:
                    ids = tuple(map(b"".join, both))
            a.append(ids[0])
            b.append(ids[1])
        return a, b

    def _whole(self, text: str) -> tuple[bytes, bytes]:
        ids = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, ids)) != (" " + text).encode():
            return b"", b""
        return array("I", self.a.encode(" " + text, add_special_tokens=False).ids).tobytes(), array("I", ids).tobytes()


def groups(ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every token of A and of B, from the byte ends of both (which tile the same bytes)."""
    na, nb = len(ea), len(eb)
    a_at = np.repeat(np.arange(na), np.diff(ea, prepend=0))
    b_at = np.repeat(np.arange(nb), np.diff(eb, prepend=0))
    reach = a_at[eb - 1]
    succ = np.concatenate([na + b_at[ea - 1], np.where(ea[reach] > eb, reach, na + np.arange(nb))])
    last = succ[na:] == np.arange(na, na + nb)
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            break
        succ = farther
    number = np.cumsum(last) - 1
    return number[succ[:na] - na], number[succ[na:] - na]


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.pair = Pair(a_path, b_path)

    def __call__(self, texts: list[str | None]):
        """Per text: tokens of A, tokens of B, groups, links, digest of the groups, and the links as pair numbers."""
        p = self.pair
        a_texts, b_texts = p.encode(texts)
        na, nb = (np.array([len(x) // 4 for x in side], np.int64) for side in (a_texts, b_texts))
        a, b = (np.frombuffer(b"".join(side), "<u4").astype(np.int64) for side in (a_texts, b_texts))
        if not len(a):
            none = [0] * len(texts)
            return none, none, none, none, [""] * len(texts), [b""] * len(texts)
        ea, eb = np.cumsum(p.a_length[a]), np.cumsum(p.b_length[b])
        ga, gb = groups(ea, eb)
        # links: token i of A meets the tokens of B from that at its first byte to that at its last
        b_at = np.repeat(np.arange(len(b)), p.b_length[b])
        low, high = b_at[ea - p.a_length[a]], b_at[ea - 1]
        many = high - low + 1
        first = np.cumsum(many) - many
        other = np.arange(many.sum()) - np.repeat(first - low, many)
        pairs = (np.repeat(a, many) * p.n_b + b[other]).astype(p.kind)
        # the groups as text: each token's name ends in the sign that follows it
        per_a, per_b = np.bincount(ga), np.bincount(gb)
        place_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[ga]
        place_b = np.arange(len(b)) + np.cumsum(per_a)[gb]
        names = np.empty(len(a) + len(b), np.int64)
        size = len(p.names) // 3
        names[place_a] = a + size * (np.diff(ga, append=-1) != 0)
        names[place_b] = b + 2 * size * (np.diff(gb, append=-1) != 0)
        ends = np.cumsum(na + nb)
        a_end, b_end = np.cumsum(na), np.cumsum(nb)
        n_groups = np.where(nb > 0, gb[b_end - 1] - gb[np.minimum(b_end - nb, len(b) - 1)] + 1, 0)
        n_links = np.where(na > 0, np.append(first, len(pairs))[a_end] - first[np.minimum(a_end - na, len(a) - 1)], 0)
        digests, links, at, link = [], [], 0, 0
        for end, n in zip(ends.tolist(), n_links.tolist()):
            shown = b"".join(map(p.names.__getitem__, names[at:end].tolist()))
            digests.append(hashlib.sha256(shown[:-1]).hexdigest() if shown else "")
            links.append(pairs[link:link + n].tobytes())
            at, link = end, link + n
        return na, nb, n_groups, n_links, digests, links


_LOADED: dict[tuple[str, str], Aligner] = {}


def load(a_path: str, b_path: str) -> Aligner:
    """One aligner per Python worker and pair of files; a reused worker keeps what it knows."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark spreads the work
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def linked(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The alignment of every row without corpus counts: ``row``, the other columns, the numbers, digest and links."""
    rest = [c for c in docs.columns if c != text]
    names, taken = [], list(rest)
    for name in ("row", *NUMBERS, "groups_sha256", "links"):
        names.append(spare_name(taken, name))
        taken.append(names[-1])
    kinds = [T.LongType(), *[T.LongType()] * 4, T.StringType(), T.BinaryType()]
    arrow = [*[pa.int64()] * 5, pa.string(), pa.binary()]
    made = [T.StructField(n, k) for n, k in zip(names, kinds)]
    out = T.StructType([*(docs.schema[c] for c in rest), *made])
    numbered = docs.select(*(F.col(f"`{c}`") for c in rest), F.monotonically_increasing_id().alias(names[0]), F.col(f"`{text}`"))
    at = len(rest) + 1

    def run(batches):
        work = load(a_path, b_path)
        for batch in batches:
            for part in slices(batch, at, BATCH_BYTES):
                found = work(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], *(pa.array(v, type=t) for v, t in zip(found, arrow[1:]))], names=[*rest, *names])

    return numbered.mapInArrow(run, out)


def pair_counts(links: DataFrame, column: str, kind: np.dtype, n_b: int) -> DataFrame:
    """``pair``, ``n`` (links that hold it) and ``best`` (no pair with its B id has more)."""
    def count(batches):
        def emitted(parts):
            pair, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, at, np.concatenate([c for _, c in parts]))
            return pair, n

        def batch_of(pair, n):
            return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], names=["pair", "n"])

        held, size = [], 0
        for batch in batches:
            for part in slices(batch, 0, COUNTED_LINKS):
                values = np.frombuffer(b"".join(part.column(0).to_pylist()), kind)
                held.append(np.unique(values, return_counts=True))
                size += len(held[-1][0])
                if size > COUNTED_LINKS:
                    held = [emitted(held)]
                    size = len(held[0][0])
                    if size > COUNTED_LINKS // 2:
                        yield batch_of(*held[0])
                        held, size = [], 0
        if held:
            yield batch_of(*emitted(held))

    n = links.select(F.col(column)).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = materialize(n, "pair-counts")
    b = F.col("pair") % n_b
    most = n.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return materialize(n.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def _hot(counts: DataFrame, most: int) -> tuple[list, bool]:
    """The pairs above a count that at most ``most`` pairs reach, and whether there are others."""
    step = F.floor(F.log2("n") * 16)
    steps = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()     # 64 * 16 steps at most
    cut, total = None, 0
    for r in steps:
        if total + r["count"] > most:
            break
        cut, total = r["step"], total + r["count"]
    rows = counts.where(step >= cut).collect() if cut is not None else []
    return rows, total < sum(r["count"] for r in steps)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Aligns a byte-level BPE (A, on a space and the text) with a SentencePiece BPE (B) on every row.

    Returns the other columns of ``docs`` with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256`` (names that are taken get an underscore appended).  Null and empty
    texts, and texts whose bytes B does not keep, have no tokens: zeros and an empty digest.  Texts of any
    length are aligned whole; repeated rows each count and each get their result; of pairs with
    the same count all are best.  An empty table gives an empty table.
    """
    rest = [c for c in docs.columns if c != text]
    made = materialize(linked(docs, a_path, b_path, text), "aligned")
    row, *numbers, digest, links = made.columns[len(rest):]
    pair = Pair(a_path, b_path)
    kind, n_b = pair.kind, pair.n_b
    counts = pair_counts(made, links, kind, n_b)
    rows, more = _hot(counts, hot_pairs)
    rows.sort(key=lambda r: r["pair"])
    table = made.sparkSession.sparkContext.broadcast((
        np.array([r["pair"] for r in rows], kind), np.array([r["n"] for r in rows], np.int64),
        np.array([r["best"] for r in rows], bool)))

    def placed(values):
        hot, n, best = table.value
        if not len(hot):
            return np.zeros(len(values), bool), None, n, best
        at = np.minimum(np.searchsorted(hot, values), len(hot) - 1)
        return hot[at] == values, at, n, best

    names = [spare_name(rest, "n_best"), spare_name(rest, "count_sum")]
    fields = [f for f in made.schema.fields if f.name != links]
    out = T.StructType([*fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType())])
    place = made.columns.index(links)

    def hot_sums(batches):
        for batch in batches:
            for part in slices(batch, place, COUNTED_LINKS):
                raw = part.column(place).to_pylist()
                values = np.frombuffer(b"".join(raw), kind)
                found, at, n, best = placed(values)
                sums, bests = np.zeros(len(values) + 1, np.int64), np.zeros(len(values) + 1, np.int64)
                if at is not None:
                    np.cumsum(np.where(found, n[at], 0), out=sums[1:])
                    np.cumsum(found & best[at], out=bests[1:])
                ends = np.cumsum([len(x) // kind.itemsize for x in raw])
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(part.columns) if i != place]
                    + [pa.array(bests[ends] - bests[starts]), pa.array(sums[ends] - sums[starts])], schema=None,
                    names=out.names)

    def tail_links(batches):
        for batch in batches:
            for part in slices(batch, 1, COUNTED_LINKS):
                for number, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    values = np.frombuffer(raw, kind)
                    rare, times = np.unique(values[~placed(values)[0]], return_counts=True)
                    if len(rare):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rare), number)), pa.array(rare.astype(np.int64)), pa.array(times)], names=["row", "pair", "times"])

    scored = made.mapInArrow(hot_sums, out)
    if more:
        tail = made.select(F.col(row), F.col(links)).mapInArrow(tail_links, "row long, pair long, times long")
        tail = tail.join(counts, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("tail_best"),
            F.sum(F.col("times") * F.col("n")).alias("tail_sum"))
        best, total = spare_name(scored.columns, "tail_best"), spare_name(scored.columns, "tail_sum")
        tail = tail.select(F.col("row").alias(row), F.col("tail_best").alias(best), F.col("tail_sum").alias(total))
        scored = scored.join(tail, row, "left") \
            .withColumn(names[0], F.col(names[0]) + F.coalesce(best, F.lit(0))) \
            .withColumn(names[1], F.col(names[1]) + F.coalesce(total, F.lit(0)))
    return scored.select(*(F.col(f"`{c}`") for c in (*rest, *numbers, *names, digest)))
