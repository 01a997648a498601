"""Operator 2: exact top-k search on a bit-sliced index.

Rows are dealt into blocks.  In a block every attribute (a quantised component) is cut into
bit slices: one bitmap over the rows for each binary digit.  A query adds the slices of all
attributes, weighted by its own components, with bitmap logic (three bitmaps of one place
become a sum and a carry) into the slices of the score.  The best rows are then selected from
the most significant slice downward, and rows that tie at the boundary are resolved by id.
Every row is indexed and every block asked, so the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block, and queries that meet a block in one task.
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
#: Components from here on (after scaling) would not leave room for a sum of products in a long.
MOST = 1 << 26


class BitSlices:
    """Index of one block: ``values`` is rows x attributes, ids ascending."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        n, d = values.shape
        self.words = -(-n // 64)
        self.rows = self._pack(np.ones((1, n), bool))[0]
        self.low = values.min(axis=0) if n and d else np.zeros(d, np.int64)
        above = (values - self.low).T
        self.bits = np.array([int(x).bit_length() for x in above.max(axis=1)], int) if n and d else np.zeros(d, int)
        #: slices[b][d]: bitmap of digit b of attribute d, with as many digits as the attribute needs
        self.slices = [self._pack((above >> b) & 1) for b in range(int(self.bits.max(initial=0)))]

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        packed = np.packbits(bits.astype(bool), axis=1, bitorder="little")
        return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, self.words * 8 - packed.shape[1])))).view(np.uint64)

    def score(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the score, least significant first, shifted so that no score is negative.

        A negative weight adds the attribute's complement, which differs by a constant.
        """
        weight = np.abs(query)
        flip = np.where(query < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        due: list[list[np.ndarray]] = []
        for b, plane in enumerate(self.slices):
            has = np.flatnonzero((self.bits > b) & (weight > 0))
            if not len(has):
                continue
            digit = plane[has] ^ flip[has, None]
            for c in range(int(weight[has].max()).bit_length()):
                one = (weight[has] >> c) & 1 == 1
                if one.any():
                    while len(due) <= b + c:
                        due.append([])
                    due[b + c].append(digit[one])
        out, place = [], 0
        while place < len(due):
            maps = np.concatenate(due[place]) if due[place] else np.zeros((1, self.words), np.uint64)
            carries = []
            while len(maps) > 1:
                third = len(maps) // 3
                if third:
                    x, y, z = maps[:third], maps[third:2 * third], maps[2 * third:3 * third]
                    half = x ^ y
                    carries.append((x & y) | (half & z))
                    maps = np.concatenate([half ^ z, maps[3 * third:]])
                else:
                    carries.append(maps[:1] & maps[1:2])
                    maps = maps[:1] ^ maps[1:2]
            if carries:
                if place + 1 == len(due):
                    due.append([])
                due[place + 1] += carries
            out.append(maps[0])
            due[place] = []
            place += 1
        return out

    def top(self, query: np.ndarray, k: int, own=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but ``own``; the smallest ids among rows that tie."""
        maybe = self.rows.copy()
        if own is not None and len(self.ids):
            at = int(np.searchsorted(self.ids, own))
            if at < len(self.ids) and self.ids[at] == own:
                maybe[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        sure = np.zeros_like(maybe)
        for plane in reversed(self.score(query)):
            ones = maybe & plane
            n = int(np.bitwise_count(sure | ones).sum())
            if n > k:
                maybe = ones
            else:
                sure |= ones
                maybe &= ~plane
                if n == k:
                    break
        rows = self._places(sure)
        boundary = self._places(maybe)[:max(0, k - len(rows))]
        rows = np.concatenate([rows, boundary])
        scores = self.values[rows] @ query
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]

    def _places(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:len(self.ids)])


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """``id``, ``v`` (array of long) and ``d`` (length) of the rows that take part."""
    x = F.col(f"`{vector}`")
    fine = F.forall(x, lambda c: F.coalesce((F.abs(c.cast("double")) * scale < float(MOST)) & ~F.isnan(c.cast("double")), F.lit(False)))
    return vectors.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & fine).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v"), F.size(x).alias("d"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector: str = "embedding",
          scale: int = 256, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's k best other rows.

    Queries are the rows whose id is divisible by ``every``; scores are inner products of the
    floors of ``scale`` times the components.  Block and query group sizes are fixed, so a
    task's memory is too; each block keeps k rows per query, and a window ranks these few.
    Rows with a null id, a null vector or a null, non-finite or outsized (2**26 after scaling) component take no part;
    vectors are compared with vectors of their length.  Of rows that share an id the vector that sorts first
    counts, once.  An empty table gives no rows.
    """
    rows = quantised(vectors, id_col, vector, scale)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).first()
    blocks, groups = (max(1, math.ceil(x / of)) for x, of in ((sizes["n"], block_rows), (sizes["q"], query_rows)))
    place = F.xxhash64("id")
    index = rows.withColumn("block", F.pmod(place, F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = rows.where(F.col("id") % every == 0).withColumn("part", F.pmod(place, F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def unique(frame) -> tuple[np.ndarray, np.ndarray]:
        ids = frame["id"].to_numpy(dtype=np.int64)
        values = np.array(frame["v"].tolist(), np.int64).reshape(len(ids), -1)
        order = np.lexsort((*values.T[::-1], ids))
        ids, values = ids[order], values[order]
        first = np.ones(len(ids), bool)
        first[1:] = ids[1:] != ids[:-1]
        return ids[first], values[first]

    def search(left, right):
        import pandas as pd
        found = []
        if len(left) and len(right):
            slices = BitSlices(*unique(left))
            for own, query in zip(*unique(right)):
                ids, scores = slices.top(query, k, own)
                found += [(own, i, s) for i, s in zip(ids.tolist(), scores.tolist())]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("d", "block", "part")
    best = index.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
