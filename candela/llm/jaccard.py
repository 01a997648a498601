"""Operator 6: n-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of shingle hashes.  All sets are put in one order: shingles that are
not frequent by hash, then the frequent ones by their count.  Two sets that reach the
similarity must share shingles in their prefixes.  The prefix is lengthened by ``extra``
shingles where the estimated cost of its candidates falls by that, and a pair must then share
correspondingly more before it is verified: with the sizes ``x`` and ``y``, the smallest
overlap ``o`` and the prefix length ``p`` of the set whose prefix ends first, ``o - (x - p)``.

Equal sets are one node from the start.  Lists of frequent shingles are first joined to a few
hubs only, which merges large groups; then all pairs of a list that are still in different
components are counted, pruned and verified on the texts, so no link between components is
lost while members of one group are never paired with each other.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import Scratch, materialize, slices, spare_name
from candela.llm.components import components

WORDS, PERCENT = 4, 85
#: A shingle that stands in so many documents is frequent.
FREQUENT = 16
#: Entries of the table of frequent shingles (it only sets the order; the join is exact with any).
MOST_FREQUENT = 1 << 20
#: Shingles that a task counts before it passes the counts on; buckets of one range of counts.
COUNTED, RANGE = 2_000_000, 1 << 20
#: Lengthenings of the prefix to choose from, and the cost of verifying a candidate in list entries.
EXTRA, VERIFY = (1, 2, 4, 8, 16), 8
#: Bytes of text that a task turns into shingles at once.
PIECE_BYTES = 1 << 19
#: Residue classes of the nodes; each gives a list of a frequent shingle one hub.
HUBS = 6
#: Hubs that a node is verified against (those that share most).
BEST_HUBS = 4
#: Candidates of each node that a round verifies; the last round verifies all that are left.
ROUNDS = (2, 8, None)
#: Shingles of verified sets that a task keeps.
HELD = 3_000_000
#: Up to this size the ids of the documents to verify go to every executor; more are joined in a shuffle.
BROADCAST_BYTES = 8 << 20

_SIGN = np.uint64(1 << 63)
_K = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(64)
#: A random number for each byte (upper-case letters as lower-case ones, white space nothing) and for each place.
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BYTE[_SPACE] = 0
_PLACE = _rng.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= _K[0]
    h ^= h >> np.uint64(29)
    return h


def _joined(hashes: list[np.ndarray], words: int) -> np.ndarray:
    """Hashes of word sequences: ``hashes`` has the first words of all, then the second ones, and so on."""
    out = hashes[0] * _K[0] + np.uint64(words)
    for h in hashes[1:]:
        out ^= out >> np.uint64(29)
        out *= _K[1]
        out ^= h * _K[2] + _K[3]
    return _mix(out)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    A text of fewer words is one shingle, an empty one none.  The words of all texts are hashed
    at once: a word's hash is the sum of its bytes' numbers times its places' numbers.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw), np.uint8)
    none = np.empty(0, np.uint64)
    space = _SPACE[data]
    first = np.flatnonzero(~space & np.concatenate([[True], space])[:-1])
    if not len(first):
        return [none] * len(texts)
    last = np.flatnonzero(~space & np.concatenate([space, [True]])[1:]) + 1
    place = np.arange(first[0], len(data)) - np.repeat(first, np.diff(first, append=len(data)))
    hashes = np.add.reduceat(_BYTE[data[first[0]:]] * _PLACE[place & 255], first - first[0])
    hashes = _mix(hashes + (last - first).astype(np.uint64) * _K[1])
    for i in np.flatnonzero(last - first > 256).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[first[i]:last[i]].tobytes().lower())
    starts = np.cumsum([0, *(len(x) + 1 for x in raw)])
    cuts = np.searchsorted(first, starts).tolist()
    n = len(hashes) - words + 1
    whole = _joined([hashes[i:i + n] for i in range(words)], words) if n > 0 else none
    out = []
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= words:
            out.append(np.unique(whole[a:b - words + 1]))
        else:
            out.append(_joined([hashes[i:i + 1] for i in range(a, b)], b - a) if b > a else none)
    return out


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The shingle hashes of one text."""
    return shingle_sets([text], words)[0]


def least_shared(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares at least with any similar one."""
    return (percent * n + 99) // 100


def signature(found: np.ndarray) -> int:
    """64-bit name of a set, signed."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def prefix(found: np.ndarray, heavy: tuple[np.ndarray, np.ndarray], shift: int, percent: int):
    """Shingles of the chosen prefix in order, their counts (0: not frequent), and the frequent ones of the whole set."""
    n = len(found)
    buckets, counts = heavy
    count = np.zeros(n, np.int64)
    if len(buckets):
        own = found >> np.uint64(shift)
        at = np.minimum(np.searchsorted(buckets, own), len(buckets) - 1)
        count = np.where(buckets[at] == own, counts[at], 0)
        if count.any():
            order = np.argsort(count, kind="stable")
            found, count = found[order], count[order]
    shortest, longest = n - least_shared(n, percent) + 1, n
    lists = np.cumsum(np.maximum(count, 1))
    cost = [(lists[p - 1] + VERIFY * (lists[p - 1] - p) / extra, p)
            for extra in EXTRA if (p := min(shortest + extra - 1, longest))]
    p = min(cost)[1]
    return found[:p], count[:p], int(np.count_nonzero(count))


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id``, ``alias`` and ``text``: a row without an id is found again by ``alias``, a hash of its text."""
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return named.select("id", F.when(F.col("id").isNull(), F.xxhash64("text")).alias("alias"), "text")


def _documents(docs: DataFrame, doc_id: str, text: str, words: int, shift: int) -> tuple[DataFrame, DataFrame]:
    """Every document's (id, alias, n, node), and the counts of shingle buckets in packed ranges."""
    def run(batches):
        held, size, seen = [], 0, set()

        def packed():
            buckets, n = np.unique(np.concatenate(held), return_counts=True)
            ranges = (buckets // RANGE).astype(np.int64)
            cuts = np.flatnonzero(np.diff(ranges)) + 1
            for part, many in zip(np.split(buckets, cuts), np.split(n, cuts)):
                first = int(part[0]) // RANGE
                steps = np.diff(part - np.uint64(first * RANGE), prepend=np.uint64(0)).astype("<u4")
                yield first, zlib.compress(steps.tobytes() + np.minimum(many, 2 ** 32 - 1).astype("<u4").tobytes(), 1)

        def batch_of(ids, aliases, n, nodes, ranges, data):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(aliases, pa.int64()), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(ranges, pa.int64()), pa.array(data, pa.binary())], names=["id", "alias", "n", "node", "range", "data"])

        def flush():
            some = list(packed()) if held else []
            for i in range(0, len(some), 64):
                part = some[i:i + 64]
                none = [None] * len(part)
                yield batch_of(none, none, none, none, [x[0] for x in part], [x[1] for x in part])

        for batch in batches:
            for piece in slices(batch, 2, PIECE_BYTES):
                n, nodes = [], []
                for found in shingle_sets(piece.column(2).to_pylist(), words):
                    n.append(len(found))
                    nodes.append(signature(found) if len(found) else None)
                    if len(found) and nodes[-1] not in seen:
                        # Copies within a task count once.
                        seen.add(nodes[-1])
                        held.append(found >> np.uint64(shift))
                        size += len(found)
                none = [None] * len(n)
                yield batch_of(piece.column(0).to_pylist(), piece.column(1).to_pylist(), n, nodes, none, none)
                if size >= COUNTED:
                    yield from flush()
                    held, size, seen = [], 0, set()
        yield from flush()

    rows = materialize(_named(docs, doc_id, text).mapInArrow(
        run, "id long, alias long, n long, node long, range long, data binary"), "shingle_sets")
    return rows.where("range is null").select("id", "alias", "n", "node"), rows.where("range is not null").select("range", "data")


def _frequent(counts: DataFrame, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of frequent shingles and their counts, at most ``MOST_FREQUENT``, the most frequent first."""
    def run(batches):
        at, table = None, None

        def found():
            often = np.flatnonzero(table >= FREQUENT)
            return pa.RecordBatch.from_arrays([pa.array(often + at * RANGE, pa.int64()), pa.array(table[often], pa.int64())],
                                              names=["bucket", "n"])

        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if first != at:
                    if at is not None:
                        yield found()
                    at, table = first, np.zeros(RANGE, np.int64)
                steps, many = np.frombuffer(zlib.decompress(data), "<u4").reshape(2, -1)
                table[np.cumsum(steps, dtype=np.int64)] += many
        if at is not None:
            yield found()

    often = counts.repartition(ranges, "range").sortWithinPartitions("range").mapInArrow(run, "bucket long, n long")
    table = often.orderBy(F.col("n").desc(), "bucket").limit(MOST_FREQUENT).toArrow()
    buckets, n = table["bucket"].to_numpy().astype(np.uint64), table["n"].to_numpy().astype(np.int64)
    order = np.argsort(buckets)
    return buckets[order], n[order]


def _prefixes(docs: DataFrame, text: str, words: int, percent: int, shift: int, heavy) -> DataFrame:
    """A row for each shingle of a prefix, and one with a null shingle for each set that tells where its prefix ends."""
    least = next(n for n in range(1, 10_000) if 100 * n >= percent * (n + 1))  # smaller sets are only similar to equal ones
    table = docs.sparkSession.sparkContext.broadcast(heavy)  # at most MOST_FREQUENT pairs of numbers

    def run(batches):
        known = table.value
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, 0, PIECE_BYTES):
                parts = []
                for found in shingle_sets(piece.column(0).to_pylist(), words):
                    if len(found) < least:
                        continue
                    node = signature(found)
                    if node in seen:
                        continue
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(node)
                    first, count, often = prefix(found, known, shift, percent)
                    first = (first ^ _SIGN).view(np.int64)
                    parts.append((first, count, node, len(found), 1000 * often // len(found)))
                if not parts:
                    continue
                sizes = [len(x[0]) for x in parts]
                of = lambda i: np.array([x[i] for x in parts], np.int64)
                nodes, n, centre = of(2), of(3), of(4)
                ends = [pa.array([int(x[0][-1]) for x in parts], pa.int64()), pa.array([int(x[1][-1]) for x in parts], pa.int64())]
                names = ["shingle", "count", "node", "n", "centre", "p", "last"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x[0] for x in parts])), pa.array(np.concatenate([x[1] for x in parts])),
                     pa.array(np.repeat(nodes, sizes)), pa.array(np.repeat(n, sizes)), pa.array(np.repeat(centre, sizes)),
                     pa.nulls(sum(sizes), pa.int64()), pa.nulls(sum(sizes), pa.int64())], names=names)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(parts), pa.int64()), ends[1], pa.array(nodes), pa.array(n), pa.array(centre),
                     pa.array(sizes, pa.int64()), ends[0]],
                    names=names)

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "shingle long, count long, node long, n long, centre long, p long, last long")


def _similar_sizes(x: Column, y: Column, percent: int) -> Column:
    return (F.least(x, y) * 100 >= F.greatest(x, y) * percent)


def _texts(pairs: DataFrame, docs: DataFrame, sets: DataFrame, doc_id: str, text: str, words: int, tables: Scratch) -> DataFrame:
    """``node`` and ``text`` of the nodes in ``pairs``, written once for all rounds that verify them."""
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    chosen = tables.put(sets.join(involved, "node").groupBy("node").agg(
        F.coalesce(F.min("id"), F.min("alias")).alias("key")), "to_verify")
    small = chosen.count() * 16 <= BROADCAST_BYTES
    # Repeated keys may bring other texts along: the node is computed again from the text that came.
    found = _named(docs, doc_id, text).select(F.coalesce("id", "alias").alias("key"), "text").join(
        F.broadcast(chosen) if small else chosen, "key")

    def checked(batches):
        for batch in batches:
            for piece in slices(batch, 1, PIECE_BYTES):
                same = [signature(found) == node for found, node in zip(
                    shingle_sets(piece.column(1).to_pylist(), words), piece.column(2).to_pylist())]
                yield piece.filter(pa.array(same, pa.bool_())).select([2, 1])

    texts = found.select("key", "text", "node").mapInArrow(checked, "node long, text string")
    return tables.put(texts.dropDuplicates(["node"]), "verify_texts")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, tables: Scratch) -> DataFrame:
    """The pairs of nodes (``a``, ``b``) whose texts are similar, counted shingle by shingle."""
    joined = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        sets_of: dict[int, np.ndarray] = {}
        held = 0

        def of(node, t):
            nonlocal held
            if node not in sets_of:
                found = shingles(t.as_py(), words)
                if held + len(found) > HELD:
                    sets_of.clear()
                    held = 0
                held += len(found)
                sets_of[node] = found
            return sets_of[node]

        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                x, y = of(a, ta), of(b, tb)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return tables.put(joined.mapInArrow(run, "a long, b long"), "links")


def _labelled(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """``pairs`` with the components ``ca`` and ``cb`` of their ends (a node without one is its own)."""
    label = {x: groups.select(F.col("node").alias(x), F.col("component").alias(f"_{x}")) for x in "ab"}
    return pairs.join(label["a"], "a", "left").join(label["b"], "b", "left").withColumns(
        {"ca": F.coalesce("_a", "a"), "cb": F.coalesce("_b", "b")}).drop("_a", "_b")


def _merged(groups: DataFrame, links: DataFrame, tables: Scratch) -> DataFrame:
    """``groups`` after new links: only the components that these join are contracted."""
    new = tables.put(_labelled(links, groups).where("ca <> cb").select("a", "b", "ca", "cb"), "new_links")
    if new.isEmpty():
        return groups
    top = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")), tables.put)
    ends = new.select(F.col("a").alias("node")).union(new.select(F.col("b").alias("node"))).distinct()
    known = groups.union(ends.join(groups, "node", "left_anti").select("node", F.col("node").alias("component")))
    return tables.put(known.join(top.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left").select(
        "node", F.coalesce("top", "component").alias("component")), "groups")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """A row for each document: its integer id, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest id reachable by links; a link joins two documents whose
    shingle sets have a Jaccard similarity of ``percent`` per cent or more.  Shingles and sets
    are told apart by 64-bit hashes.  Null and empty texts have no shingles and are linked with nothing; a
    text shorter than a shingle is one shingle; copies, repeated rows and ties share a component; documents
    with a null id take part and get the smallest id of the others, if any; an empty table gives no rows.
    Other columns are not carried; a result's name that is also that of the id gets an underscore appended.
    """
    # As many buckets as there are shingles, or up to twice that: a bucket's count is then its shingle's.
    letters = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`"))).alias("n")).first()["n"] or 0
    bits = max(20, min(48, int(letters // 5).bit_length()))
    shift = 64 - bits
    tables = Scratch(docs.sparkSession)
    sets, counts = _documents(docs, doc_id, text, words, shift)
    heavy = _frequent(counts, max(1, min((1 << bits) // RANGE, 4096)))

    rows = tables.put(_prefixes(docs, text, words, percent, shift, heavy), "prefixes")
    nodes = tables.put(rows.where("shingle is null").select("node", "n", "p", F.col("count").alias("last_count"), "last").distinct(), "nodes")
    parts = rows.where("shingle is not null")
    # A shingle that is not frequent has a short list: a window finds the lists of two nodes or more.
    whole = Window.partitionBy("shingle")
    rare = parts.where("count = 0").select("shingle", "node", "n", F.min("node").over(whole).alias("lo"), F.max("node").over(whole).alias("hi"))
    lists = tables.put(rare.where("lo <> hi").select("shingle", "node", "n").union(
        parts.where("count > 0").select("shingle", "node", "n")).distinct(), "lists")
    frequent = tables.put(parts.where("count > 0").select("shingle", "node", "n", "centre").distinct(), "frequent")

    # Round 1: frequent shingles, each node against the hubs of its lists.  The set that consists most of frequent
    # shingles is the hub: among near copies that is the text they were made from, or the one least changed.
    hubs = frequent.groupBy("shingle", F.pmod("node", F.lit(HUBS)).alias("slot")).agg(
        F.max_by("node", "centre").alias("hub"), F.max("centre").alias("centre")).drop("slot")
    star = frequent.drop("centre").join(hubs, "shingle").where("node <> hub").groupBy("hub", "node").agg(
        F.count("*").alias("c"), F.max("centre").alias("centre"))
    best = Window.partitionBy("node").orderBy(F.col("centre").desc(), F.col("c").desc(), "hub")
    star = star.withColumn("nr", F.row_number().over(best)).where(F.col("nr") <= BEST_HUBS).select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    sizes = {x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab"}
    star = star.join(sizes["a"], "a").join(sizes["b"], "b").where(_similar_sizes(F.col("n_a"), F.col("n_b"), percent))
    star = tables.put(star.select("a", "b"), "star")
    groups = components(
        _verified(star, _texts(star, docs, sets, doc_id, text, words, tables), words, percent, tables), tables.put)

    # Round 2: all pairs of a list that are not in one component yet.
    labelled = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = tables.put(labelled, "labelled")
    mixed = labelled.groupBy("shingle").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("k")).where("lo <> hi").select("shingle", "k")
    # ``own`` shingles of a set are in these lists: all that it can share with one of another component.  Of two sets
    # that share ``needed`` of them, the first that they share, short lists first, is followed by the others in both.
    place = Window.partitionBy("node").orderBy("k", "shingle")
    left = labelled.join(mixed, "shingle").withColumn("place", F.row_number().over(place))
    left = tables.put(left, "open_lists")
    facts = nodes.join(left.groupBy("node").agg(F.collect_list("shingle").alias("held")), "node").select(
        "node", "n", "last_count", "last", (F.col("n") - F.col("p")).alias("rest"), F.size("held").cast("long").alias("own"), "held")
    facts = tables.put(facts, "open_sets")
    left = left.drop("k").join(facts.drop("n", "held"), "node")
    side = {x: left.select("shingle", *(F.col(c).alias(f"{c}_{x}") for c in left.columns if c != "shingle")) for x in "ab"}
    overlap = F.expr(f"((n_a + n_b) * {percent} + {99 + percent}) div {100 + percent}")
    a_ends = (F.col("last_count_a") < F.col("last_count_b")) | (
        (F.col("last_count_a") == F.col("last_count_b")) & (F.col("last_a") <= F.col("last_b")))
    needed = overlap - F.when(a_ends, F.col("rest_a")).otherwise(F.col("rest_b"))
    early = [(F.col(f"place_{x}") <= F.col(f"own_{x}") - needed + 1) & (F.col(f"own_{x}") + F.col(f"rest_{x}") >= overlap) for x in "ab"]
    pairs = side["a"].join(side["b"], "shingle").where(
        (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
        & _similar_sizes(F.col("n_a"), F.col("n_b"), percent) & early[0] & early[1])
    pairs = pairs.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.first(needed).alias("needed"))
    held = {x: facts.select(F.col("node").alias(x), F.col("held").alias(f"held_{x}")) for x in "ab"}
    pairs = pairs.join(held["a"], "a").join(held["b"], "b")
    shared = F.size(F.array_intersect("held_a", "held_b"))
    pairs = pairs.withColumn("over", shared - F.col("needed")).where("over >= 0").select("a", "b", "over")
    pairs = tables.put(pairs, "candidates")
    texts = _texts(pairs, docs, sets, doc_id, text, words, tables)
    # First the pairs that share most: a node that joins a group by one of them needs no other of the group.
    for most in ROUNDS:
        if pairs.isEmpty():
            break
        picked, rest = pairs, None
        if most:
            nearest = [F.row_number().over(Window.partitionBy(x).orderBy(F.col("over").desc(), *"ab")) for x in "ab"]
            ranked = tables.put(pairs.withColumn("nr", F.least(*nearest)), "ranked")
            picked, rest = ranked.where(F.col("nr") <= most), ranked.where(F.col("nr") > most)
        groups = _merged(groups, _verified(picked, texts, words, percent, tables), tables)
        if rest is None:
            break
        pairs = tables.put(_labelled(rest, groups).where("ca <> cb").select("a", "b", "over"), "candidates")

    smallest = sets.where("node is not null").groupBy("node").agg(F.min("id").alias("id")).join(groups, "node", "left")
    smallest = smallest.withColumn("component", F.coalesce("component", "node"))
    smallest = tables.put(smallest, "nodes_of_components")
    least = smallest.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = materialize(smallest.join(least, "component").select("node", "component_id"), "classes")
    tables.drop()
    found = sets.join(classes, "node", "left").select("id", "n", F.coalesce("component_id", "id").alias("component_id"))
    taken = [doc_id]
    names = [taken.append(spare_name(taken, c)) or taken[-1] for c in ("n_shingles", "component_id")]
    return found.toDF(doc_id, *names)
