"""Operator 3: quality classifier on random-indexing word vectors.

Every word bucket has a fixed sparse random vector.  Over the whole corpus a bucket gathers
the random vectors of its neighbours; the sums of all tasks are added in a shuffle by bucket
range.  A document is the mean and the spread of its words' vectors, and a two-layer network
in numpy turns them into a probability, whose temperature is fitted on rows kept apart.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.llm.common import map_rows, slices

#: Word buckets, width of their vectors, non-zero entries of a random vector, neighbours on each side.
BUCKETS, WIDTH, NONZERO, REACH = 1 << 15, 32, 4, 2
INPUTS = 2 * WIDTH + 3
#: Bytes of text that a task turns into words at once.
PIECE_BYTES = 1 << 20
#: Bucket ranges in which the sums travel.
CHUNKS = 64
#: Labelled rows that the network is fitted on, at most (those with the smallest hash of the id).
MOST_LABELLED = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
THRESHOLD = 0.7
# Bytes of UTF-8: white space and controls, letters (all that is not ASCII counts as one), digits, marks.
_KIND = np.full(256, 3, np.uint8)
_KIND[:33], _KIND[127], _KIND[128:], _KIND[48:58] = 0, 0, 1, 2
_KIND[65:91] = _KIND[97:123] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(11)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)[_LOWER]
_PLACE = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Buckets of capitals and numbers by their length, up to nine.
_SHAPES = _rng.integers(0, BUCKETS, (2, 10))


def bucket_ids(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word buckets of all texts in a row, and the text that each word is from.

    Words are runs of letters, of digits or of marks.  Words fall into buckets by a hash of
    their lower-case bytes; words all in capitals, and numbers, by their length.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _KIND[data]
    first = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1])
    size = np.diff(first, append=len(data))
    place = np.arange(len(data)) - np.repeat(first, size)
    hashes = np.add.reduceat(_BYTE[data] * _PLACE[place & 255], first)
    hashes ^= hashes >> np.uint64(32)
    ids = (hashes * _SPREAD >> np.uint64(49)).astype(np.int64)
    capitals = np.add.reduceat((data >= 65) & (data <= 90), first, dtype=np.int64)
    small = np.add.reduceat((data >= 97) & (data <= 122), first, dtype=np.int64)
    of, length = kind[first], np.minimum(size, 9)
    ids = np.where((of == 1) & (capitals > 1) & (small == 0), _SHAPES[0][length], ids)
    ids = np.where(of == 2, _SHAPES[1][length], ids)
    word = of > 0
    starts = np.cumsum([0, *(len(x) + 1 for x in raw[:-1])])
    return ids[word], np.searchsorted(starts, first[word], "right") - 1


def random_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's non-zero entries; the extra last bucket stands between documents."""
    rng = np.random.default_rng(20)
    places = np.argsort(rng.random((BUCKETS + 1, WIDTH)), axis=1)[:, :NONZERO].astype(np.int64)
    signs = rng.choice((-1.0, 1.0), (BUCKETS + 1, NONZERO))
    signs[-1] = 0
    return np.ascontiguousarray(places.T), np.ascontiguousarray(signs.T)


def gather(ids: np.ndarray, of: np.ndarray, places: np.ndarray, signs: np.ndarray, into: np.ndarray) -> None:
    """Adds the random vectors of each word's neighbours in its text to its bucket in ``into`` (flat)."""
    if not len(ids):
        return
    line = np.full(len(ids) + REACH * int(of[-1] + 1), BUCKETS, np.int64)
    line[np.arange(len(ids)) + REACH * of] = ids
    for step in range(1, REACH + 1):
        word = np.concatenate([line[:-step], line[step:]])
        near = np.concatenate([line[step:], line[:-step]])
        word *= WIDTH
        for k in range(NONZERO):
            into += np.bincount(word + places[k][near], weights=signs[k][near], minlength=len(into))


def word_vectors(docs: DataFrame, text: str) -> np.ndarray:
    """Unit vectors of all buckets, gathered over every document (4 MB at any size of the corpus)."""
    rows_of = BUCKETS // CHUNKS

    def count(batches):
        places, signs = random_vectors()
        into = np.zeros((BUCKETS + 1) * WIDTH)
        for batch in batches:
            for piece in slices(batch, 0, PIECE_BYTES):
                gather(*bucket_ids(piece.column(0).to_pylist()), places, signs, into)
        table = into[:BUCKETS * WIDTH].astype("<i8").reshape(CHUNKS, -1)
        some = [i for i in range(CHUNKS) if table[i].any()]
        # Sums of one task fit 32 bits; the sums of all tasks travel as 64 bits.
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(some, pa.int32()),
                                          "sums": pa.array([table[i].astype("<i4").tobytes() for i in some], pa.binary())})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.frombuffer(data.as_buffer(), "<i4")
                if chunk in sums:
                    sums[chunk] += got
                else:
                    sums[chunk] = got.astype("<i8")
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int32()),
                                          "sums": pa.array([x.tobytes() for x in sums.values()], pa.binary())})

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(count, "chunk int, sums binary")
    table = np.zeros((CHUNKS, rows_of * WIDTH))
    for r in parts.repartition(CHUNKS, "chunk").mapInArrow(add, "chunk int, sums binary").collect():
        table[r["chunk"]] = np.frombuffer(r["sums"], "<i8")
    table = table.reshape(BUCKETS, WIDTH)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, logarithm of the length, shares of distinct buckets and of repeats of the word before."""
    out = np.zeros((len(texts), INPUTS), np.float32)
    ids, of = bucket_ids(texts)
    if not len(ids):
        return out
    some, starts, n = np.unique(of, return_index=True, return_counts=True)
    found = vectors[ids]
    mean = np.add.reduceat(found, starts, axis=0) / n[:, None]
    found *= found
    spread = np.sqrt(np.maximum(np.add.reduceat(found, starts, axis=0) / n[:, None] - mean ** 2, 0))
    out[some, :WIDTH] = mean
    out[some, WIDTH:2 * WIDTH] = spread
    out[some, -3] = np.log1p(n) / 10
    again = (ids[1:] == ids[:-1]) & (of[1:] == of[:-1])
    out[some, -2] = np.bincount(of[1:], weights=again, minlength=len(texts))[some] / n
    distinct = np.unique(of * BUCKETS + ids) // BUCKETS
    out[some, -1] = np.bincount(distinct, minlength=len(texts))[some] / n
    return out


class Network(NamedTuple):
    """Standardised inputs, a tanh layer, a logistic output divided by the temperature."""
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> Network:
    """Adam on the rows not kept apart; the temperature minimises the log loss of those kept apart."""
    rng = np.random.default_rng(3)
    train = np.flatnonzero(~apart)
    centre = x[train].mean(axis=0) if len(train) else np.zeros(x.shape[1])
    scale = x[train].std(axis=0) + 1e-3 if len(train) else np.ones(x.shape[1])
    weights = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    if len(train) == 0 or len(np.unique(y[train])) < 2:
        # Nothing to tell apart: the share of label 1, for all.
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(centre, scale, weights[0] * 0, weights[1], weights[2], np.array([np.log(share / (1 - share))]), 1.0)
    z = (x - centre) / scale
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(train)
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            w1, b1, w2, b2 = weights
            h = np.tanh(z[rows] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -60, 60))) - y[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - h * h)
            slopes = [z[rows].T @ back + DECAY * w1, back.sum(axis=0), h.T @ error + DECAY * w2, error.sum(keepdims=True)]
            t += 1
            for j, g in enumerate(slopes):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                weights[j] = weights[j] - rate * first[j] / (1 - 0.9 ** t) / (np.sqrt(second[j] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(centre, scale, *weights, 1.0)
    if apart.any():
        logit, sign = net.logits(x[apart]), 2 * y[apart] - 1
        net = net._replace(temperature=float(min(
            np.geomspace(0.25, 8, 61), key=lambda c: np.logaddexp(0, -sign * logit / c).mean())))
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          label_id: str = "doc_id", most_labelled: int = MOST_LABELLED) -> DataFrame:
    """Adds ``score`` (probability of label 1) to every row.

    Word vectors come from all texts; the network from at most ``most_labelled`` labelled rows
    outside the held-out quarter, of which one in five (by id) fits the temperature.  Labels
    are looked up by id only to train; the score is a function of the text.  Null and empty
    texts have zero features and get a score; null ids and null labels train nothing; without
    labels of both kinds every row gets the share of label 1; repeated rows score alike; an empty table gives no
    rows; clashing column names get an underscore appended.
    """
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text))
    known = labels.select(F.col(f"`{label_id}`").alias("_i"), F.col(f"`{label}`").cast("int").alias("_y")).where(
        F.col("_i").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_i")))
    known = known.groupBy("_i").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_i"), "_i").limit(most_labelled)

    def featured():
        table = vectors.value
        return lambda texts: [[r.astype("<f4").tobytes() for r in features(texts, table)]]

    # At most ``most_labelled`` rows of two numbers: a proven bound for the broadcast.
    sample = docs.select(F.col(f"`{doc_id}`").alias("_i"), F.col(f"`{text}`").alias("_t")).join(F.broadcast(known), "_i")
    sample = map_rows(sample.select("_t", "_i", "_y"), "_t", featured, [("_x", T.BinaryType())], PIECE_BYTES).select("_i", "_y", "_x")
    rows = sorted(map(tuple, sample.groupBy("_i").agg(F.max("_y").alias("_y"), F.max("_x").alias("_x")).collect()))
    x = np.array([np.frombuffer(r[2], "<f4") for r in rows], float).reshape(len(rows), INPUTS)
    apart = np.array([zlib.crc32(str(r[0]).encode()) // 4 % 5 == 0 for r in rows], bool)
    network = fit(x, np.array([r[1] for r in rows], float), apart)

    def scored():
        table = vectors.value
        return lambda texts: [network.probability(features(texts, table).astype(float)).tolist()]

    return map_rows(docs, text, scored, [("score", T.DoubleType())], PIECE_BYTES)
