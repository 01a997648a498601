"""Operator 13: token ids as files of range asymmetric numeral system (rANS) blocks.

One table of symbol frequencies, taken over the whole corpus, is shared by all blocks.  A block holds
whole documents; its ids are dealt to ``LANES`` interleaved coders (id i goes to lane i mod LANES)
that write to one stream of 32-bit words.  Every ``STEPS`` rounds the block records a checkpoint: the
states of its lanes and the place in the stream.  Checkpoints are independent starts, so a reader decodes
all stretches of all blocks of a batch as one vector; a CRC of the ids is checked for each block.

The files are Parquet (one row for each block), so that Spark's commit protocol keeps them whole
when a task is repeated, on any file system that Spark can write to.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.llm.bpe import NEAR, near_pattern
from candela.llm.common import materialize, slices
from candela.llm.remember import Remembered
from candela.session import scratch_path

LANES = 256
#: Rounds of all lanes between two checkpoints: 16,384 ids.
STEPS = 64
#: A block ends with the document that brings it to this many ids.
BLOCK_IDS = 1 << 16
#: Blocks that are coded at once have about this many ids.
BATCH_IDS = 1 << 20
#: Sum of the frequencies in the shared table (2 to this power; more where the table has more symbols).
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Bytes of text that are encoded at once (one longer text still passes whole).
TEXT_BYTES = 1 << 22
#: The id that ends a document.
END_ID = 1
FAR = re.compile("[ɐ-\U0010ffff]")
#: What a pattern ends with whose words are short forms ('s), runs of letters, single digits and runs of other signs.
RUNS = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE, LETTER, DIGIT, SIGN = range(4)
#: What a normalizer does that leaves lower-case words of signs below ``NEAR`` as they are.
LOWERED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]


# ---------------------------------------------------------------- ids
def id_kind(path: str, end_id: int = END_ID) -> np.dtype:
    """The smallest little-endian unsigned kind that holds every id of a vocabulary file."""
    import json
    spec = json.load(open(path, encoding="utf-8"))
    return np.dtype("<u2" if max(end_id, *spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])) < 1 << 16 else "<u4")


class Encoder:
    """Ids of the ``tokenizers`` library, remembered for words.

    Texts of letters whose classes are the same in every Unicode release are cut into words as the file's own
    pattern does, many texts as one array; their distinct words are looked up, and only words not yet known go to
    the library, many in one text.  No token crosses a space, so other texts are cut at spaces, and their pieces with
    other letters go to the library as they are.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        import json

        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.kind, suffix = id_kind(path, end_id), spec["model"].get("end_of_word_suffix")
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.near = re.compile(near_pattern(pattern)).findall
        self.short = pattern.removesuffix(RUNS).split("|")[:-1]
        self.runs = "|".join([*self.short, RUNS]) == pattern and all(re.fullmatch("'[a-z]+", x) for x in self.short)
        self.classes = np.full(NEAR, SIGN, np.uint8)
        for c, kind in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
            self.classes[[ord(x) for x in re.findall(f"[{near_pattern(kind)}]", "".join(map(chr, range(NEAR))))]] = c
        self.plain = self.library
        normal, cuts = (spec["normalizer"] or {}).get("normalizers"), spec["pre_tokenizer"]["pretokenizers"]
        if self.runs and normal == LOWERED and [c["type"] for c in cuts] == ["Split", "ByteLevel"]:
            # words are lower-case and cut already: a space between them is all that is left to find
            split = {"type": "CharDelimiterSplit", "delimiter": " "}
            self.plain = Tokenizer.from_str(json.dumps(spec | {
                "normalizer": None, "pre_tokenizer": spec["pre_tokenizer"] | {"pretokenizers": [split, cuts[1]]}, "truncation": None, "padding": None}))
        self.words, self.pieces = Remembered(self._words), Remembered(self._pieces)
        self.end = np.array([end_id], self.kind).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words: many in one text, cut after the tokens that end a word."""
        out = []
        for i in range(0, len(words), 1000):
            some = words[i:i + 1000]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize).tolist()
            if len(ends) == len(some):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip([0, *ends], ends)]
            else:
                out += self._ids(some)
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        split = [None if FAR.search(low := p.lower()) else self.near(low) for p in pieces]
        known = self.words.table(set().union(*(w for w in split if w))).__getitem__
        far = iter(self._ids([p for p, w in zip(pieces, split) if w is None]))
        return [next(far) if w is None else b"".join(map(known, w)) for w in split]

    def cut(self, texts: list[str]) -> tuple[pa.Array, str, np.ndarray]:
        """Words of lower-case texts without ``FAR`` signs, their encoding, and the number of words up to the end of each."""
        if not self.runs:
            words = [self.near(t) for t in texts]
            return (pa.array([w.encode("utf-16-le") for some in words for w in some], pa.large_binary()), "utf-16-le",
                    np.cumsum([len(w) for w in words], dtype=np.int64))
        joined = " ".join(texts) + " " * max(map(len, self.short), default=1)
        try:
            encoding, signs = "latin-1", np.frombuffer(raw := joined.encode("latin-1"), np.uint8)
            kinds = np.frombuffer(raw.translate(self.classes[:256].tobytes()), np.uint8)
        except UnicodeEncodeError:
            encoding, signs = "utf-16-le", np.frombuffer(joined.encode("utf-16-le"), "<u2")
            kinds = self.classes[signs]
        begins = np.ones(len(signs), bool)
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins |= kinds == DIGIT
        inside = kinds != SPACE
        begins &= inside
        # a short form's apostrophe begins a match, so no other sign stands before it
        quotes = np.flatnonzero(signs == ord("'"))
        quotes = quotes[begins[quotes]]
        for form in self.short:
            fits = np.ones(len(quotes), bool)
            for k, c in enumerate(form):
                fits &= signs[quotes + k] == ord(c)
            at, quotes = quotes[fits], quotes[~fits]
            begins[at + 1] = False
            begins[at + len(form)] |= kinds[at + len(form)] == LETTER
        packed = signs[inside]
        offsets = np.append(np.flatnonzero(begins[inside]), len(packed)) * packed.itemsize
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return words, encoding, np.searchsorted(np.flatnonzero(begins), ends)

    def _near(self, texts: list[str]) -> list[bytes]:
        """Ids of lower-case texts without ``FAR`` signs."""
        words, encoding, upto = self.cut(texts)
        if not len(words):
            return [b""] * len(texts)
        coded = words.dictionary_encode()
        _, offsets, letters = coded.dictionary.buffers()
        letters = str(letters, encoding)
        at = (np.frombuffer(offsets, np.int64)[:len(coded.dictionary) + 1] // len(" ".encode(encoding))).tolist()
        known = self.words.results([letters[a:b] for a, b in zip(at, at[1:])])
        flat, sizes = np.frombuffer(b"".join(known), self.kind), np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        which = coded.indices.to_numpy()
        many = sizes[which]
        ends = np.cumsum(many)
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - ends + many, many)
        places += np.arange(len(places))
        ids = flat[places].tobytes()
        cuts = (np.append(0, ends)[np.append(0, upto)] * self.kind.itemsize).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned integers of ``kind``, the end id last."""
        near: dict[int, str] = {}
        far: dict[int, list[str]] = {}
        whole = []
        for i, t in enumerate(texts):
            if t and self.special.search(t):
                whole.append(i)
            elif t and FAR.search(low := t.lower()):
                far[i] = t.replace("\n", " ").split(" ")
            elif t:
                near[i] = low
        out = [b""] * len(texts)
        known = self.pieces.table(set().union(*far.values())).__getitem__
        for i, parts in far.items():
            out[i] = b"".join(map(known, parts))
        for i, ids in zip(near, self._near(list(near.values()))):
            out[i] = ids
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        return [ids + self.end for ids in out]


_LOADED: dict[tuple[str, int], Encoder] = {}


def load(path: str, end_id: int) -> Encoder:
    """One encoder per Python worker and file; a reused worker keeps what it knows."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # Spark spreads the work
    if (path, end_id) not in _LOADED:
        _LOADED[path, end_id] = Encoder(path, end_id)
    return _LOADED[path, end_id]


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned of the vocabulary's kind, the end id last) and ``crc`` (of
    these bytes) of every row."""
    def run(batches):
        encode = load(path, end_id)
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                ids = encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, type=pa.binary()), pa.array(map(zlib.crc32, ids), type=pa.int64())],
                    names=["doc_id", "ids", "crc"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`"))
    return rows.mapInArrow(run, "doc_id long, ids binary, crc long")


# ---------------------------------------------------------------- the shared table
class Table:
    """Frequencies of all symbols, scaled to a power of two, each at least 1."""

    def __init__(self, symbols: np.ndarray, counts: np.ndarray):
        order = np.argsort(symbols)
        self.symbols, counts = symbols[order].astype(np.int64), counts[order].astype(np.float64)
        self.bits = max(SCALE_BITS, int(2 * len(symbols)).bit_length())
        total = 1 << self.bits
        if len(counts):
            freq = np.maximum(1, np.floor(counts / counts.sum() * total)).astype(np.int64)
            most = np.argsort(-freq, kind="stable")
            left = total - int(freq.sum())
            if left > 0:
                freq[most[0]] += left
            for i in most if left < 0 else ():
                taken = min(-left, int(freq[i]) // 2)
                freq[i] -= taken
                left += taken
                if not left:
                    break
        else:
            freq = np.zeros(0, np.int64)
        self.freq, self.start = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = self.number = None

    def numbers(self) -> np.ndarray:
        """Symbol number of each symbol, as a table by symbol."""
        if self.number is None:
            self.number = np.zeros(int(self.symbols.max(initial=0)) + 1, np.int32)
            self.number[self.symbols] = np.arange(len(self.symbols))
        return self.number

    def slots(self) -> np.ndarray:
        """Symbol number of each slot."""
        if self.slot is None:
            kind = np.uint16 if len(self.symbols) <= 1 << 16 else np.uint32
            self.slot = np.repeat(np.arange(len(self.symbols), dtype=kind), self.freq.astype(np.int64))
        return self.slot


def frequencies(tokens: DataFrame, kind: np.dtype) -> DataFrame:
    """``id`` and ``n`` over all rows: counted in each task first."""
    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                ids = np.frombuffer(b"".join(part.column(0).to_pylist()), kind)
                if len(ids):
                    more = np.bincount(ids, minlength=len(counts))
                    more[:len(counts)] += counts
                    counts = more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- coding
def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[tuple[bytes, bytes]]:
    """Words and checkpoints of each block of ids; blocks do not depend on one another.

    A checkpoint is the word place and the states of the lanes before a round; the first is that of round 0.
    """
    order = np.argsort([-len(b) for b in blocks], kind="stable")        # longest first: those with a round t are a prefix
    sizes = np.array([len(blocks[i]) for i in order], np.int64)
    rounds = -(-sizes // LANES)
    offset = np.cumsum(rounds) - rounds
    numbers = np.zeros((int(rounds.sum()), LANES), np.int32)
    flat, lookup = numbers.reshape(-1), table.numbers()
    for o, i in zip(offset.tolist(), order.tolist()):
        flat[o * LANES:o * LANES + len(blocks[i])] = lookup[blocks[i]]
    lane, bits, total = np.arange(LANES), np.uint64(table.bits), np.uint64(1 << table.bits)
    limit = (LOW >> bits) << WORD
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    most = int(rounds[0]) if len(rounds) else 0
    running = np.searchsorted(-rounds, -np.arange(most), "left")
    taken = np.zeros((most, len(blocks)), np.int64)                      # words of each round and block
    marks, words = [], []
    for t in range(most - 1, -1, -1):
        n = int(running[t])
        active = None if (t + 1) * LANES <= sizes[n - 1] else (t * LANES + lane)[None, :] < sizes[:n, None]
        s, x = numbers[offset[:n] + t], state[:n]
        freq = table.freq[s]
        over = x >= limit * freq
        if active is not None:
            over &= active
        taken[t, :n] = over.sum(axis=1)
        flat, at = x.reshape(-1), np.flatnonzero(over)
        full = flat[at]
        words.append(full.astype("<u4"))                                 # the low half
        flat[at] = full >> WORD
        more = x // freq * (total - freq) + table.start[s]               # share << bits | place in the symbol's slots
        x += more if active is None else np.where(active, more, 0)
        if t % STEPS == 0:
            marks.append((t, state[:n].copy()))
    stream = np.concatenate([*words[::-1], np.zeros(0, "<u4")])
    owner = np.repeat(np.tile(np.arange(len(blocks)), most), taken.ravel())
    stream = stream[np.argsort(owner, kind="stable")]
    before = np.cumsum(taken, axis=0) - taken
    ends = np.cumsum(taken.sum(axis=0))
    out: list = [None] * len(blocks)
    for i, to in enumerate(order.tolist()):
        mine = [np.concatenate([before[t, i:i + 1].astype("<u8"), st[i]]).astype("<u8").tobytes() for t, st in marks[::-1] if t < rounds[i]]
        out[to] = (stream[ends[i - 1] if i else 0:ends[i]].tobytes(), b"".join(mine))
    return out


def decode_blocks(blocks: list[tuple[int, bytes, bytes]], table: Table) -> list[np.ndarray]:
    """Ids of blocks given as (number of ids, words, checkpoints): all stretches at once."""
    width = 1 + LANES
    stream = np.frombuffer(b"".join(w for _, w, _ in blocks) + b"\0" * 4, "<u4")
    base, places, states, sizes = 0, [], [], []
    for n, words, marks in blocks:
        m = np.frombuffer(marks, "<u8").reshape(-1, width)
        places.append(m[:, 0].astype(np.int64) + base)
        states.append(m[:, 1:])
        sizes.append(np.minimum(STEPS * LANES, n - np.arange(len(m)) * STEPS * LANES))
        base += len(words) // 4
    if not sum(map(len, sizes)):
        return [np.zeros(0, np.int64) for _ in blocks]
    place, state, size = np.concatenate(places), np.concatenate(states), np.concatenate(sizes)
    # longest stretches first: those still running are always a prefix
    order = np.argsort(-size, kind="stable")
    place, state, size = place[order], state[order].copy(), size[order]
    slots, bits = table.slots(), np.uint64(table.bits)
    found = np.zeros((len(size), STEPS, LANES), slots.dtype)
    mask, lane = np.uint64((1 << table.bits) - 1), np.arange(LANES)
    for t in range(-(-int(size[0]) // LANES)):
        n = int(np.searchsorted(-size, -t * LANES, "left"))
        active = None if (t + 1) * LANES <= size[n - 1] else (t * LANES + lane)[None, :] < size[:n, None]
        x = state[:n]
        slot = x & mask
        s = slots[slot.astype(np.int64)]
        found[:n, t] = s
        y = table.freq[s] * (x >> bits) + slot - table.start[s]
        low = y < LOW
        if active is not None:
            y, low = np.where(active, y, x), low & active
        # lanes that read a word, block by block: each block's words follow one another
        read = low.sum(axis=1)
        word = stream[np.repeat(place[:n] + read - np.cumsum(read), read) + np.arange(read.sum())]
        flat = y.reshape(-1)
        at = np.flatnonzero(low)
        flat[at] = flat[at] << WORD | word
        state[:n] = y
        place[:n] += read
    flat, back = found.reshape(len(size), -1), np.empty(len(size), np.int64)
    back[order] = np.arange(len(size))
    out, at = [], 0
    for s in sizes:
        parts = [flat[back[at + i], :k] for i, k in enumerate(s.tolist())]
        at += len(s)
        out.append(table.symbols[np.concatenate(parts)] if parts else np.zeros(0, np.int64))
    return out


# ---------------------------------------------------------------- files
BLOCK = ("part long, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, words binary, checkpoints binary, crc32 long")


def _blocks(ordered: DataFrame, table: Table, kind: np.dtype) -> DataFrame:
    """Rows of ``doc_id`` and ``ids``, in their order, as blocks."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64()]

    def run(batches):
        from pyspark import TaskContext
        part, first, ready, docs, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block():
            nonlocal docs, held
            ids = np.frombuffer(b"".join(x for _, x in docs), kind)
            ready.append(([d for d, _ in docs], [len(x) // kind.itemsize for _, x in docs], ids))
            docs, held = [], 0

        def written():
            nonlocal first, ready
            made = encode_blocks([ids for _, _, ids in ready], table)
            rows = []
            for (names, lengths, ids), (words, marks) in zip(ready, made):
                rows.append((part, first, len(ids), names, lengths, words, marks, zlib.crc32(ids.astype("<u4"))))
                first += len(ids)
            ready = []
            return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(zip(*rows), kinds)], names=names_)

        names_ = [f.split(" ")[0] for f in BLOCK.split(", ")]
        waiting = 0
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                docs.append((name, raw))
                held += len(raw) // kind.itemsize
                if held >= BLOCK_IDS:
                    waiting += held
                    block()
                    if waiting >= BATCH_IDS:
                        yield written()
                        waiting = 0
        if docs:
            block()
        if ready:
            yield written()

    return ordered.select("doc_id", "ids").mapInArrow(run, BLOCK)


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> None:
    """Encodes every row and writes the ids in ascending order of ``key`` as rANS blocks to ``folder``.

    ``folder/table`` is the shared frequency table, ``folder/blocks`` the blocks, in files whose names are
    in order, and ``folder/parts`` the ids before each file.  Rows without a key come first; rows with
    the same key stand in the order of their ids' checksum.  Null and empty texts have the end id alone.  Texts of any
    length are encoded whole; a document is never divided between blocks.  An empty table gives an
    empty folder of blocks.
    """
    spark = docs.sparkSession
    kind = id_kind(path, end_id)
    tokens = materialize(token_ids(docs, path, end_id, text, key), "ids")
    frequencies(tokens, kind).write.parquet(f"{folder}/table")
    table = read_frequencies(spark, folder)
    # the row's number comes last, so that rows that are alike can go to different tasks
    ordered = tokens.withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), "crc", "row"]
    _blocks(ordered.repartitionByRange(*order).sortWithinPartitions(*order), table, kind).write.parquet(f"{folder}/blocks")
    parts = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)       # one row for each file
    parts.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("ids_before")).write.parquet(f"{folder}/parts")


def read_frequencies(spark: SparkSession, folder: str) -> Table:
    """The shared table: at most one row for each entry of the vocabulary."""
    rows = spark.read.schema("id long, n long").parquet(f"{folder}/table").collect()
    return Table(np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    and, if asked for, ``ids``.  A block whose ids do not have its checksum is an error."""
    table = read_frequencies(spark, folder)
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "part long, doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    wanted = ["part", "first_id", "n_ids", "doc_ids", "lengths", "words", "checkpoints", "crc32"]

    def some(batches):
        """Blocks of about ``BATCH_IDS`` ids together."""
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append({c: batch.column(k)[i].as_py() for k, c in enumerate(wanted)})
                size += held[-1]["n_ids"]
                if size >= BATCH_IDS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(batches):
        for blocks in some(batches):
            decoded = decode_blocks([(b["n_ids"], b["words"], b["checkpoints"]) for b in blocks], table)
            for b, ids in zip(blocks, decoded):
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != b["crc32"]:
                    raise ValueError(f"block at id {b['first_id']} of part {b['part']} does not have its checksum")
                ends = np.cumsum(b["lengths"])
                starts = ends - b["lengths"]
                pieces = [raw[4 * s:4 * e] for s, e in zip(starts.tolist(), ends.tolist())]
                n = len(pieces)
                columns = [pa.array(np.full(n, b["part"])), pa.array(b["doc_ids"], type=pa.int64()), pa.array(starts + b["first_id"]),
                           pa.array(np.array(b["lengths"], np.int64)), pa.array([zlib.crc32(p) for p in pieces], type=pa.int64())]
                if with_ids:
                    columns.append(pa.array(pieces, type=pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = spark.read.parquet(f"{folder}/blocks").select(*wanted).mapInArrow(run, schema)
    parts = spark.read.schema("part long, ids_before long").parquet(f"{folder}/parts")
    return found.join(parts, "part").withColumn("start", F.col("start") + F.col("ids_before")).select(*names[1:])


def ids_round_trip(docs: DataFrame, path: str, end_id: int = END_ID, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes the ids of all rows to a folder beside the checkpoints and reads the documents back from it."""
    folder = scratch_path(docs.sparkSession, "rans")
    write_ids(docs, path, folder, end_id, text, key)
    return read_ids(docs.sparkSession, folder)
