"""Operator 8: quality rules as learned decision lists.

Statistics of each text are column expressions.  From the labelled rows a decision list is
learned by sequential covering: a rule grows by the threshold test that gains most on the rows
it still covers, is pruned on rows kept apart, and the rows it covers are set aside before the
next rule.  All counts are Spark aggregates over the labelled statistics; only one row of
counts comes back for each step.  The list is then one ordered ``CASE WHEN`` expression.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import WORD, materialize, spare_name

SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8

#: Ratios that rules may test, from the statistics of a text.
FEATURES = {
    "words": "double(n_words)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "distinct_words": "n_distinct / greatest(n_words, 1)",
}


class Test(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def holds(self, value: Column) -> Column:
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def on_ratio(self) -> Column:
        return self.holds(F.col(self.feature))

    def column(self) -> Column:
        return self.holds(F.expr(FEATURES[self.feature]))


class Rule(NamedTuple):
    tests: tuple[Test, ...]
    bad: int
    covered: int

    def column(self) -> Column:
        """On the statistics."""
        return reduce(and_, (t.column() for t in self.tests))

    def on_ratios(self) -> Column:
        """On the ratios, which the learner has written out."""
        return reduce(and_, (t.on_ratio() for t in self.tests))

    def __str__(self) -> str:
        return " AND ".join(f"{t.feature} {'>=' if t.above else '<'} {t.threshold:g}" for t in self.tests)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once in the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words inside a window of eight words that stands twice or more in the text.

    Window hashes are built by doubling (1, 2, 4, 8 words).  Only where some window repeats are
    the places sorted; each then adds the words up to the next place, eight at most.
    """
    def doubled(h: Column, step: int) -> Column:
        n = F.greatest(F.size(h) - step, F.lit(0))
        return F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda a, b: F.xxhash64(a, b))

    def places(w8: Column) -> Column:
        pairs = F.array_sort(F.transform(w8, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        n = F.size(pairs)
        # Neighbours in hash order that share a hash are both places of a repeated window.
        same = F.zip_with(F.slice(pairs, 1, n - 1), F.slice(pairs, 2, n - 1),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        at = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
        return let(at, lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda s, x: s + x))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    w8 = let(let(hashes, lambda h: doubled(h, 1)), lambda h: let(doubled(h, 2), lambda g: doubled(g, 4)))
    counted = let(w8, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), places(w)).otherwise(F.lit(0)))
    return F.when(F.size(words) > WINDOW, counted).otherwise(F.lit(0))


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_lines", "n_capitals", "n_marks", "n_distinct")


def statistics(text: Column) -> Column:
    """A struct of the ``STATISTICS`` of a text, all long; a null text counts as empty."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"), repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).alias("n_distinct"))

    def joined(w: Column, li: Column) -> Column:
        made = {
            "n_words": w["n_words"],
            "word_chars": F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")),
            "n_symbols": F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")),
            "n_dup_lines": F.size(li) - F.size(F.array_distinct(li)),
            "n_repeat_words": w["n_repeat_words"],
            "n_lines": F.size(li),
            "n_capitals": F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
            "n_marks": F.length(F.regexp_replace(body, r"[^!?]+", "")),
            "n_distinct": w["n_distinct"],
        }
        return F.struct(*(made[c].cast("long").alias(c) for c in STATISTICS))

    return let(let(F.regexp_extract_all(body, F.lit(WORD), 0), of_words),
               lambda w: let(lines, lambda li: joined(w, li)))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < LEAST_WORDS) | (100 * stats["n_repeat_words"] > MOST_REPEATED_PERCENT * stats["n_words"])


def gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """FOIL's gain of a test: rows of the class kept, times the growth of the information."""
    if bad == 0:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def learn(labelled: DataFrame, label: str = "quality", most_rules: int = 8, most_tests: int = 3,
          steps: int = 64, precision: float = 0.98, least_share: float = 0.002, least_rows: int = 5) -> list[Rule]:
    """Decision list for label 0 from rows with the ``STATISTICS`` columns, a 0/1 label and ``held`` (boolean).

    Thresholds are ``steps`` quantiles of each ratio among the bad and among the good rows.
    Each row's ratios are placed among them once; a step then counts rows by ratio, place and
    class, and running sums of these few counts value every test.  A rule stays if at least
    ``precision`` of the rows that it covers in each part are bad, so that clean documents
    are kept.  Rows without a label take no part; without both classes the list is empty.
    """
    ratios = list(FEATURES)
    rows = materialize(labelled.where(F.col(label).isin(0, 1)).select(
        (F.col(label) == 0).alias("bad"), F.col("held"), *(F.expr(FEATURES[f]).alias(f) for f in ratios)), "rules")
    at = [i / steps for i in range(steps + 1)]
    picked = rows.groupBy("bad").agg(*(F.percentile_approx(f, at, 1000).alias(f) for f in ratios)).collect()
    if len(picked) < 2:
        return []
    cuts = {f: sorted({x for r in picked for x in r[f] or []}) for f in ratios}

    def place(f: str) -> Column:
        below = F.filter(F.array(*map(F.lit, cuts[f])), lambda c: c <= F.col(f))
        return F.struct(F.lit(f).alias("ratio"), F.size(below).alias("place"))

    places = F.array(*map(place, ratios))
    rows = materialize(rows.withColumn("places", places), "rules_places")
    rules: list[Rule] = []
    open_rows, total, barred = F.lit(True), 0, set()

    def tests_of(of: DataFrame) -> tuple[int, int, list[tuple[Test, int, int]]]:
        """Bad and good rows; every test with the bad and good rows that pass it."""
        found = of.where(~F.col("held")).select("bad", F.explode("places").alias("x")).groupBy(
            "x.ratio", "x.place", "bad").count().collect()
        n = {(r["ratio"], r["place"], r["bad"]): r["count"] for r in found}
        bad, good = (sum(v for (f, _, kind), v in n.items() if f == ratios[0] and kind == want) for want in (True, False))
        out = []
        for f in ratios:
            below = [0, 0]
            for k, cut in enumerate(cuts[f]):
                below = [below[i] + n.get((f, k, kind), 0) for i, kind in enumerate((True, False))]
                out.append((Test(f, False, cut), *below))
                out.append((Test(f, True, cut), bad - below[0], good - below[1]))
        return bad, good, out

    while len(rules) < most_rules:
        left = inside = rows.where(open_rows)
        grown: list[Test] = []
        while len(grown) < most_tests:
            bad, good, found = tests_of(inside)
            total = total or bad
            if not bad or not good or not grown and bad < max(least_rows, least_share * total):
                break
            found = [x for x in found if grown or x[0].feature not in barred]
            test, b, g = max(found, key=lambda x: gain(x[1], x[2], bad, good), default=(None, 0, 0))
            if gain(b, g, bad, good) <= 0:
                break
            grown.append(test)
            inside = inside.where(test.on_ratio())
            if g == 0:
                break
        if not grown:
            break
        # Prune: of the rule and its shorter beginnings the one that covers most, if it is precise in both parts.
        short = [Rule(tuple(grown[:n]), 0, 0) for n in range(1, len(grown) + 1)]
        seen = left.groupBy("held").agg(*(
            F.count_if(rule.on_ratios() & (F.col("bad") == kind)).alias(f"{kind}{i}")
            for i, rule in enumerate(short) for kind in (True, False))).collect()
        whole = [(sum(r[f"True{i}"] for r in seen), sum(r[f"False{i}"] for r in seen)) for i in range(len(short))]
        fine = [i for i, (b, _) in enumerate(whole) if b >= max(least_rows, least_share * total) and all(
            r[f"True{i}"] >= precision * (r[f"True{i}"] + r[f"False{i}"]) for r in seen)]
        if not fine:
            # Not precise: the next attempt begins with another ratio.
            barred.add(grown[0].feature)
            continue
        barred = set()
        best = max(fine, key=lambda i: (whole[i][0], -i))
        rules.append(short[best]._replace(bad=whole[best][0], covered=sum(whole[best])))
        open_rows = open_rows & ~rules[-1].on_ratios()
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional: false for what a rule covers, else true."""
    out = F.when(F.lit(False), F.lit(False))
    for r in rules:
        out = out.when(r.column(), F.lit(False))
    return out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          label_id: str = "doc_id", keep_text: bool = False, **options) -> tuple[DataFrame, list[Rule]]:
    """Every document with its ``STATISTICS``, ``base_failed`` and ``kept``; and the learned list.

    The statistics of all documents are written once, without the texts unless ``keep_text``.  A third of the
    labelled rows (by a hash of the id) is kept apart for pruning.  Null and empty texts have zero statistics and
    fail the base rule; rows with a null id get a verdict but no label; repeated rows are
    judged alike; an empty table gives no rows, and without labels only the base rules decide.
    Clashing column names get an underscore appended.
    """
    kept = [c for c in docs.columns if keep_text or c != text]
    small = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col(f"`{doc_id}`").alias("_id"),
                        statistics(F.col(f"`{text}`")).alias("_s"))
    small = materialize(small.select("_row", "_id", "_s.*"), "quality_statistics")
    marks = labels.select(F.col(f"`{label_id}`").alias("_id"), F.col(f"`{label}`").alias("_label"))
    marks = marks.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
    learnt = small.join(marks, "_id").withColumn("held", F.pmod(F.xxhash64("_id"), F.lit(3)) == 0)
    rules = learn(learnt, "_label", **options)
    failed = base_failed({c: F.col(c) for c in STATISTICS})
    out, taken = [F.col(f"_row.`{c}`").alias(c) for c in kept], list(kept)
    for name, value in [*((c, F.col(c)) for c in STATISTICS), ("base_failed", failed), ("kept", ~failed & verdict(rules))]:
        taken.append(spare_name(taken, name))
        out.append(value.alias(taken[-1]))
    return small.select(*out), rules
