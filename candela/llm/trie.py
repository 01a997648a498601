"""Operator 12: the prefix trie of conversations from vertical bitmaps.

A conversation is an ordered list of turns; a node of the trie is a distinct beginning of such lists.
Conversations are dealt to shards of ``SHARD`` consecutive ids, and long ones are cut into blocks of
``BLOCK`` turns, so a shard is bounded whatever the data.  In a shard, every (position, turn) has the
bitset of the conversations that hold it.  A walk from the conversations that begin alike intersects the
parent's bitset with the postings at the next position: each result is a child, its bits are the
members, the members whose last turn this is are its ends.

Nodes of different shards meet by a name that depends on the turns alone: the exclusive or of a
128-bit hash of every (position, turn), which blocks can build apart from one another.  What
concerns a subtree follows from its members alone.  Every conversation m owns the nodes whose smallest
member it is, a tail of its path; ``S(m)`` are the bytes of its path before that tail.  A node u costs
``bytes(u)`` for each member but its owner, so below a node v with the bytes ``C`` before it, the sum is that of
``S(m) - C`` over the members of v but its owner; and a leaf is owned by exactly one conversation.
Both sums are taken by a second walk over the bitmaps.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import materialize

#: Consecutive conversation ids of a shard.
SHARD = 1024
#: Turns of a conversation that a shard holds.
BLOCK = 128
#: Nodes with more children are joined to their children apart from the others.
MANY_CHILDREN = 64


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``pos`` (from 1, in the order of turns, null first), hashes ``h1`` and ``h2`` of role and text, ``bytes``.

    Turns with the same number are ordered by role and text hash.  A range sort deals a very long conversation to
    many tasks (``part``): the place within a conversation is the place in the table less that of its first row.
    Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(text, F.lit(2), role).alias("h2"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "h1", "h2", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "h1", "h2", "bytes", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"))
    placed = materialize(placed, "turns")
    # rows of each part, and the part and place where each conversation begins: a conversation's parts adjoin
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)          # one row for each part
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    spans = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"))
    first = spans.join(parts, "part").groupBy("conv_id").agg(F.min(F.col("before") + F.col("first")).alias("origin"))
    spans = spans.select("conv_id", "part").join(parts, "part").join(first, "conv_id").select(
        "conv_id", "part", (F.col("before") - F.col("origin") + 1).alias("shift"))
    return placed.join(spans, ["conv_id", "part"]).select(
        "conv_id", "part", (F.col("place") + F.col("shift")).alias("pos"), "h1", "h2", "bytes")


def shared_beginnings(turns: DataFrame) -> DataFrame:
    """The turns of every conversation c rebuilt: the first h turns of conversation c - c % 5 (h = crc32 of c, % 9), then c's
    own turns after its first h.  A row with ``pos`` 0 stands for every conversation, so that one without turns is there, too.
    """
    c = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (c - c % 5).alias("base"), (F.crc32(c.cast("string").cast("binary")) % 9).alias("h"))
    convs = materialize(convs, "conversations")
    heads = turns.where("pos <= 8").withColumnRenamed("conv_id", "base").join(
        convs.select("conv_id", "base", "h"), "base").where("pos <= h").select("conv_id", "pos", "h1", "h2", "bytes")
    # how many turns the head really has: the base may be shorter than h, or absent
    length = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    shift = convs.join(length, "base", "left").select(
        "conv_id", "h", (F.least(F.coalesce("base_n", F.lit(0)), "h") - F.col("h")).alias("shift"))
    shift = turns.select("conv_id", "part").distinct().join(shift, "conv_id")       # a long conversation has many parts
    own = turns.join(shift, ["conv_id", "part"]).where("pos > h").select(
        "conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "h1", "h2", "bytes")
    zero = F.lit(0).cast("long")
    start = convs.select("conv_id", zero.alias("pos"), zero.alias("h1"), zero.alias("h2"), zero.alias("bytes"))
    return start.unionByName(heads).unionByName(own)


def _walk(rows: dict, heads: dict, visit) -> None:
    """Depth-first walk of one shard.

    ``rows``: arrays ``conv``, ``pos``, ``h1``, ``h2`` of its turns; ``heads``: the conversations of the shard in
    ascending order with the name ``k1``, ``k2`` of what goes before the block.  ``visit(depth, bits, row)`` is
    called for every node, with the row of its smallest member's turn.
    """
    convs = heads["conv"]
    local = np.searchsorted(convs, rows["conv"])
    place = {}
    turn_of: dict[tuple[int, int], tuple[int, int]] = {}
    posting: dict[tuple[int, int, int], int] = {}
    for i, (m, p, a, b) in enumerate(zip(local.tolist(), rows["pos"].tolist(), rows["h1"].tolist(), rows["h2"].tolist())):
        place[m, p] = i
        turn_of[m, p] = (a, b)
        key = (p, a, b)
        posting[key] = posting.get(key, 0) | 1 << m
    first = int(rows["pos"].min())
    starts: dict[tuple[int, int], int] = {}
    for m, k in enumerate(zip(heads["k1"].tolist(), heads["k2"].tolist())):
        starts[k] = starts.get(k, 0) | 1 << m
    has: dict[int, int] = {}
    for (p, _, _), bits in posting.items():
        has[p] = has.get(p, 0) | bits
    stack = [(first, bits) for bits in starts.values()]
    while stack:
        depth, parent = stack.pop()
        left = parent & has.get(depth, 0)
        while left:
            m = (left & -left).bit_length() - 1
            child = left & posting[(depth, *turn_of[m, depth])]
            left ^= child
            visit(depth, child, place[m, depth])
            stack.append((depth + 1, child))


def _arrays(table: pa.Table, names) -> dict[str, np.ndarray]:
    return {n: table.column(n).to_numpy() for n in names}


def _members(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def _prefixes(rows: dict, heads: dict) -> tuple[np.ndarray, ...]:
    """For every row (sorted by conversation and position): the name of the path up to it and before it, and the bytes of the path."""
    local = np.searchsorted(heads["conv"], rows["conv"])
    opens = np.flatnonzero(np.diff(local, prepend=-1))
    of = np.cumsum(np.diff(local, prepend=-1) != 0) - 1
    out = []
    for z, k in (("z1", "k1"), ("z2", "k2")):
        run = np.bitwise_xor.accumulate(rows[z])
        before = np.concatenate([[0], run])[opens]
        name = run ^ before[of] ^ heads[k][local]
        out.append((name, name ^ rows[z]))
    run = np.cumsum(rows["bytes"])
    cum = run - np.concatenate([[0], run])[opens][of] + heads["cum"][local]
    return *out[0], *out[1], cum, local


NODE = ("k1 long, k2 long, p1 long, p2 long, depth long, bytes long, cum long, conv_id long, n long, ends array<long>")
ROW_COLUMNS = ("conv_id", "pos", "h1", "h2", "z1", "z2", "bytes")


def _shard_rows(turns: pa.Table, heads: pa.Table) -> tuple[dict, dict]:
    turns, heads = turns.sort_by([("conv_id", "ascending"), ("pos", "ascending")]), heads.sort_by("conv_id")
    rows = _arrays(turns, ROW_COLUMNS)
    rows["conv"] = rows.pop("conv_id")
    head = _arrays(heads, [c for c in heads.column_names if c not in ("shard", "block")])
    head["conv"] = head.pop("conv_id")
    return rows, head


def _shard_nodes(turns: pa.Table, heads: pa.Table) -> pa.Table:
    """The nodes of one shard: names, depth, bytes, smallest member, members and the members that end there."""
    rows, head = _shard_rows(turns, heads)
    k1, p1, k2, p2, cum, local = _prefixes(rows, head)
    ended: dict[int, int] = {}
    for m, n in enumerate(head["n"].tolist()):
        ended[n] = ended.get(n, 0) | 1 << m
    at, count, ends = [], [], []

    def visit(depth, bits, i):
        at.append(i)
        count.append(bits.bit_count())
        over = bits & ended.get(depth, 0)
        ends.append(head["conv"][_members(over)].tolist() if over else None)

    _walk(rows, head, visit)
    i = np.array(at, np.int64)
    columns = [k1[i], k2[i], p1[i], p2[i], rows["pos"][i], rows["bytes"][i], cum[i], rows["conv"][i], np.array(count, np.int64)]
    return pa.Table.from_arrays([*map(pa.array, columns), pa.array(ends, type=pa.list_(pa.int64()))],
                                names=[f.split(" ")[0] for f in NODE.split(", ")])


def _shard_sums(turns: pa.Table, heads: pa.Table) -> pa.Table:
    """For the nodes of one shard with other members here or elsewhere: the sum of ``S`` over the members that do not own
    the node, and the leaves that members own."""
    rows, head = _shard_rows(turns, heads)
    k1, _, k2, _, _, _ = _prefixes(rows, head)
    # bitsets of the conversations by the last depth that they do not own
    last: dict[int, int] = {}
    for m, d in enumerate(head["shared"].tolist()):
        last[d] = last.get(d, 0) | 1 << m
    shared, some = {}, 0
    low, high = int(rows["pos"].min()), int(rows["pos"].max())
    for d in sorted(last, reverse=True):
        if d > high:
            some |= last[d]
    for d in range(high, low - 1, -1):
        some |= last.get(d, 0)
        shared[d] = some
    at, sums, leaves, seen, alone = [], [], [], {}, head["alone"].tolist()

    def visit(depth, bits, i):
        if not bits & (bits - 1) and depth >= alone[bits.bit_length() - 1]:
            return
        key = (bits, bits & shared[depth])
        if key not in seen:
            seen[key] = (int(head["before"][_members(key[1])].sum()), int(head["leaf"][_members(bits)].sum()))
        at.append(i)
        sums.append(seen[key][0])
        leaves.append(seen[key][1])

    _walk(rows, head, visit)
    i = np.array(at, np.int64)
    return pa.Table.from_arrays([pa.array(k1[i]), pa.array(k2[i]), pa.array(np.array(sums, np.int64)), pa.array(np.array(leaves, np.int64))],
                                names=["k1", "k2", "sum_before", "leaves"])


def _end_digests(chunks: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node: its chunks, in ascending order of shards, are read as a stream."""
    def run(batches):
        names, rows, current, digest = ["k1", "k2", "ends_sha256"], [], None, None
        for batch in batches:
            for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = ",".join(map(str, ids.as_py())).encode()
                if (a, b) == current:
                    digest.update(b"," + text)
                    continue
                if current:
                    rows.append((*current, digest.hexdigest()))
                current, digest = (a, b), hashlib.sha256(text)
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)
                rows = []
        if current:
            rows.append((*current, digest.hexdigest()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)

    ordered = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return ordered.select("k1", "k2", "ends").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """One row for every node of the trie of ``turns`` (``conv_id``, ``pos`` without gaps from 0 or 1, ``h1``, ``h2``, ``bytes``).

    Position 0 stands for a conversation as such: its node is the root.  Returns ``conv_id`` (the smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    Copies of a conversation are members of the same nodes; an empty table has no nodes.
    """
    rows = materialize(turns.select(
        F.expr(f"conv_id div {SHARD}").alias("shard"), F.expr(f"pos div {BLOCK}").alias("block"), "conv_id", "pos", "h1", "h2", "bytes",
        F.xxhash64("pos", "h1", "h2").alias("z1"), F.xxhash64("h2", "pos", "h1", F.lit(3)).alias("z2")), "trie-turns")
    blocks = rows.groupBy("conv_id", "shard", "block").agg(
        F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"), F.sum("bytes").alias("b"), F.max("pos").alias("last"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")                     # a row for each block of a conversation
    none = F.lit(0)
    heads = materialize(blocks.select(
        "shard", "block", "conv_id", F.coalesce(F.bit_xor("z1").over(before), none).alias("k1"),
        F.coalesce(F.bit_xor("z2").over(before), none).alias("k2"), F.coalesce(F.sum("b").over(before), none).alias("cum"),
        F.max("last").over(whole).alias("n"), F.sum("b").over(whole).alias("total")), "trie-heads")
    by_shard = rows.groupBy("shard", "block")
    found = by_shard.cogroup(heads.drop("total").groupBy("shard", "block")).applyInArrow(_shard_nodes, NODE)
    found = materialize(found, "trie-shards")
    merged = found.groupBy("k1", "k2").agg(
        *(F.min(x).alias(x) for x in ("p1", "p2", "depth", "bytes", "cum", "conv_id")), F.sum("n").alias("n_convs"))
    children = merged.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialize(merged.join(children, ["k1", "k2"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")
    # what each conversation owns: from which depth, the bytes before it, whether its end is a leaf, and where it is alone
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.min(F.col("cum") - F.col("bytes")).alias("owned_after"),
        F.max(F.col("n_children") == 0).alias("leaf"), F.min(F.when(F.col("n_convs") == 1, F.col("depth"))).alias("alone"))
    facts = heads.join(owned, "conv_id", "left").select(
        "shard", "block", "conv_id", "k1", "k2", "cum", F.coalesce(F.col("top") - 1, "n").alias("shared"),
        F.coalesce("owned_after", "total").alias("before"), F.coalesce("leaf", F.lit(False)).cast("long").alias("leaf"),
        F.coalesce("alone", F.col("n") + 1).alias("alone"))
    sums = by_shard.cogroup(facts.groupBy("shard", "block")).applyInArrow(
        _shard_sums, "k1 long, k2 long, sum_before long, leaves long")
    sums = sums.groupBy("k1", "k2").agg(F.sum("sum_before").alias("sum_before"), F.sum("leaves").alias("leaves"))
    digests = _end_digests(found.where("ends is not null").select("k1", "k2", F.col("ends")[0].alias("first"), "ends"))
    tops = owned.select("conv_id", F.col("top").alias("depth"), F.lit(True).alias("is_top"))
    full = nodes.join(sums, ["k1", "k2"], "left").join(digests, ["k1", "k2"], "left").join(tops, ["conv_id", "depth"], "left")
    full = materialize(full.select(
        "p1", "p2", "conv_id", "depth", F.coalesce("is_top", F.lit(False)).alias("is_top"), "n_convs", "n_children",
        F.when(F.col("n_convs") == 1, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.coalesce("sum_before", none) - (F.col("n_convs") - 1) * (F.col("cum") - F.col("bytes"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")), "trie-full")
    # only a conversation's first own node has a parent of another conversation; parents with very many children apart
    columns = [x for x in full.columns if x not in ("p1", "p2", "is_top")]
    inner = full.where("not is_top").select("*", F.col("conv_id").alias("parent_conv_id"))
    tops = full.where("is_top")
    parents = nodes.where("n_children > 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                   F.col("conv_id").alias("parent_conv_id"), "n_children")
    busy = parents.where(F.col("n_children") > MANY_CHILDREN).select("p1", "p2", "parent_conv_id")
    few = parents.where(F.col("n_children") <= MANY_CHILDREN).select("p1", "p2", "parent_conv_id")
    root = tops.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    upper = tops.where("depth > 0").join(busy, ["p1", "p2"], "left")
    out = inner.unionByName(root).unionByName(upper.where("parent_conv_id is not null")).unionByName(
        upper.where("parent_conv_id is null").drop("parent_conv_id").join(few, ["p1", "p2"]))
    return out.select(*columns[:2], "parent_conv_id", *columns[2:])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, rebuilt by :func:`shared_beginnings`."""
    return trie(shared_beginnings(ordered_turns(conversations)))
