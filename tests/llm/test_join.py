"""Jaccard join and components against all pairs."""

import random

import pytest

from candela.llm import jaccard
from candela.llm.components import components
from tests.llm.helpers import brute_components, corpus, near_copy, prose


def joined(spark, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs, **options).collect()}


def test_join_equals_all_pairs(spark):
    texts = corpus() + [None, "", " \n ", "one two", "ONE two", "one two three four", "a b c d e f g h i", "a b c d e f g h i j"]
    assert joined(spark, texts) == dict(enumerate(brute_components(texts)))


def test_frequent_shingles_and_large_groups(spark):
    rng = random.Random(2)
    base, line = prose(rng, 90), prose(rng, 30)
    texts = [near_copy(rng, base, rng.randint(0, 6)) for _ in range(120)]
    texts += [prose(rng, 40) + " " + line for _ in range(60)] + [line] * 5 + [line + " more"] * 2
    assert joined(spark, texts) == dict(enumerate(brute_components(texts)))


def test_prefixes_share_what_they_must():
    """Whatever prefix lengths two similar sets choose, they share the stated number of shingles."""
    import numpy as np
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(6, 200))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.06], rng.integers(0, 1 << 62, int(rng.integers(0, 8))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < 85 * (len(x) + len(y) - both):
            continue
        some = np.unique(np.concatenate([x, y]))[::3]
        heavy = (some, rng.integers(16, 500, len(some)))
        (a, ca, _), (b, cb, _) = (jaccard.prefix(s, heavy, 0, 85) for s in (x, y))
        overlap = ((len(x) + len(y)) * 85 + 184) // 185
        first = (len(x), len(a)) if (ca[-1], a[-1]) <= (cb[-1], b[-1]) else (len(y), len(b))
        assert len(np.intersect1d(a, b)) >= overlap - (first[0] - first[1])


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = prose(random.Random(1), 50)
    docs = spark.createDataFrame([(5, text, 1), (5, text, 1), (7, text, 2), (None, text, 3), (None, "alone in the world", 4), (9, None, 5)],
                                 "doc_id long, text string, component_id int")
    rows = jaccard.join(docs).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 5), (9, 9)]
    assert jaccard.join(docs.limit(0)).collect() == []


def test_near_copy_without_an_id_is_a_bridge(spark):
    words = [f"w{i}" for i in range(300)]
    edit = lambda places: " ".join("edit" + w if i in places else w for i, w in enumerate(words))
    texts = [edit({20, 50, 80, 110}), edit(set()), edit({140, 170, 200, 230}), edit({140, 170, 200, 230, 260, 280})]
    assert [c for _, c in brute_components(texts)] == [0] * 4 and brute_components([texts[0], texts[2]])[1][1] == 1
    rows = [(10, texts[0]), (None, texts[1]), (30, texts[2]), (None, texts[3]), (None, "alone in this wide world of words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in jaccard.join(docs).collect())
    assert got == [(0, 0), (0, 10), (0, 10), (10, 10), (30, 10)]


@pytest.mark.parametrize("links, want", [
    ([], {}),
    ([(1, 1)], {}),
    ([(i, i + 1) for i in range(1, 40)], {i: 1 for i in range(1, 41)}),
    ([(50, i) for i in range(10, 30)] + [(3, 29), (7, 8), (8, 7)], {**{i: 3 for i in (*range(10, 30), 50, 3)}, 7: 7, 8: 7}),
])
def test_components(spark, links, want):
    table = spark.createDataFrame(links, "a long, b long")
    assert {r["node"]: r["component"] for r in components(table).collect()} == want


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    parent = list(range(300))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for pair in links if pair[0] != pair[1] for x in pair}
