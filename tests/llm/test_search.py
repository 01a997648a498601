"""Bit-sliced top-k against a full sort."""

import math
import random

import numpy as np
import pytest

from candela.llm.bitslice import BitSlices, top_k


@pytest.mark.parametrize("n, d, low, high, k", [(1, 3, -5, 5, 2), (64, 4, -8, 8, 5), (200, 6, -300, 300, 5), (130, 2, 0, 2, 7), (90, 0, 0, 1, 3)])
def test_block_equals_a_sort(n, d, low, high, k):
    rng = np.random.default_rng(n)
    ids, values = np.sort(rng.choice(10 * n, n, replace=False)), rng.integers(low, high, (n, d))
    index = BitSlices(ids, values)
    for row in range(0, n, 7):
        query = rng.integers(low, high + 1, d)
        scores = values @ query
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != ids[row])[:k]
        got_ids, got_scores = index.top(query, k, ids[row])
        assert list(zip((-got_scores).tolist(), got_ids.tolist())) == want


def rows_of(seed, n, d=8):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.51]) for _ in range(d)]) for i in range(n)]
    rows += [(1000, None), (1001, [None] * d), (1002, [math.nan] * d), (1003, [math.inf] * d), (None, [1.0] * d),
             (1050, [0.1, 0.2]), (1051, [0.3, 0.4]), (1100, []), (1101, [])]
    return rows + rows[:20]


def brute(rows, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, [math.floor(256 * np.float32(x).astype(float)) for x in v])
    out = set()
    for q in vectors:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best[:k], 1)}
    return out


@pytest.mark.parametrize("blocks", [(8192, 2048), (40, 2)])
def test_top_k_with_ties_nulls_and_repeats(spark, blocks):
    rows = rows_of(3, 260)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(vectors, block_rows=blocks[0], query_rows=blocks[1]).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == brute(rows, 5)
    assert top_k(vectors.limit(0)).collect() == []
