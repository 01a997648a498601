"""Operator 12 against a trie that is built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from candela.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def rebuild(rows):
    """Turn lists of every conversation after the contract's exchange of beginnings."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda r: r[0])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(paths):
    nodes = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes[tuple(paths[c][:d])].append(c)
    children = defaultdict(list)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(nodes[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in members if len(paths[c]) == len(k))
        out.append((members[0], len(k), nodes[k[:-1]][0] if k else None, len(members), len(children[k]), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    found = trie.conversation_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rebuild(rows))


def conversations(seed, n, words, longest, step=1):
    """Conversations over few texts, so that they share long beginnings; some are copies, some go on where others end."""
    rng = random.Random(seed)
    rows, lists = [], []
    for i in range(n):
        turns = [(rng.choice(["user", "bot"]), rng.choice(words)) for _ in range(rng.randrange(1, longest))]
        if lists and rng.random() < 0.5:
            base = rng.choice(lists)
            turns = base[:rng.randrange(1, len(base) + 1)] + (turns if rng.random() < 0.5 else [])
        lists.append(turns)
        rows += [(i * step, t, role, text) for t, (role, text) in enumerate(turns)]
    return rows


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(trie, "SHARD", 8)
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "MANY_CHILDREN", 2)


def test_shared_beginnings(spark):
    check(spark, conversations(1, 60, ["a", "bé", "", "long text here"], 12))


def test_many_shards_blocks_and_busy_parents(spark, small_shards):
    check(spark, conversations(2, 90, ["a", "b", "ç"], 14, step=3), parts=7)


def test_copies_and_a_very_long_conversation(spark, small_shards):
    copies = [(c, t, "user", f"turn {t}") for c in range(0, 200, 2) for t in range(10)]
    longest = [(1001, t, "user", f"turn {t}" if t < 12 else "x" * (t % 7)) for t in range(700)]
    check(spark, copies + longest)


def test_nulls_gaps_and_clashing_columns(spark):
    rows = [(5, None, "user", "first"), (5, 7, None, None), (5, 3, "", "mid"), (6, 1, "user", None), (7, None, None, None),
            (None, 0, "user", "no conversation"), (9, 2, "user", "first"), (-3, 0, "user", "first"), (2**40, 1, "a", "b"), (2**40 + 1, 1, "ab", "")]
    check(spark, rows)


def test_repeated_turns_keep_their_number(spark):
    rows = [(0, 1, "user", "same")] * 5 + [(1, 1, "user", "same")] * 3
    check(spark, rows)


def test_conversations_without_turns_left(spark):
    # a conversation shorter than its h whose base is absent has no turns: it is a member of the root alone
    alone = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:4]
    check(spark, [(c, t, "user", f"{c}") for c in alone for t in range(2)])


def test_empty_table(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_texts(spark):
    check(spark, [(c, t, "user", "w" * (300_000 + t)) for c in (0, 1, 2) for t in range(9)])
