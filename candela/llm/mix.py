"""Operator 5: mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is exponential, ``-ln(u) / weight`` with ``u`` from a hash of its id and its
quality as weight; the smallest keys of a source come first.  A source's target is met by
complete epochs of all its documents, then by the first documents in key order up to the
remaining budget.  The prefix sums run in two levels so that a hot source is never one task:
sums for narrow key bands (a hash aggregate), and the order inside the one band of each
source in which the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import WORD, materialize, spare_name

#: Documents of a source that one key band holds on average.
BAND_DOCS = 4096
#: A target stops at so many times its source.
MOST_EPOCHS = 3
#: Weights of the sources in their order, repeating.
WEIGHTS = (1, 2, 3)
#: Quality falls with the symbols to this; grades of quality that the key bands tell apart.
LEAST_QUALITY, QUALITIES = 0.25, 8
SYMBOLS = r"[^#*$%&|<>!]+"


def uniform(key: Column, seed: int = 0) -> Column:
    """A fixed number inside (0, 1) from the md5 of a key."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    All targets together are the total size.  A source's share by weight stops at ``most``
    times its size; what is left goes to the others by weight.  Sources are few (they carry
    the weights), so their order is one window over one row each.  Filling up in the order of
    size per weight is the fixed point of resharing the excess.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.row_number().over(order)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((nth - 1) % len(weights) + 1).cast("int"))
    weighed = sources.select("*", w.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("most"))
    fill = Window.orderBy((F.col("most") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = weighed.select("*", (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))).alias("left"),
                          (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("w_left"))
    level = left.select("*", F.max(F.when(F.col("most") * F.col("w_left") > F.col("left") * F.col("w"),
                                          F.col("left") / F.col("w_left"))).over(whole).alias("level"))
    share = F.col("level") * F.col("w")
    return level.select("source", "source_size", F.coalesce(F.least("most", share), F.col("most")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, seed: int = 0, keep_text: bool = False) -> DataFrame:
    """Every document, without its text unless ``keep_text``, with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    ``taken`` counts the words that the mix takes, ``copies`` the times it takes the document.
    A document is taken in the last, fractional epoch where that brings its source nearer to
    the target.  Quality, the sampling weight, falls from 1 to 1/4 with the symbols per word.
    Null and empty texts have size 0 and are taken with 0 words; a null source is a source of its own, last; ties
    of the key go by id, then size; repeated rows count each time; an empty table gives no rows.
    Clashing column names get an underscore appended.
    """
    columns = docs.columns
    size, own, target, taken, copies = (spare_name(columns, c) for c in ("size", "source_size", "target", "taken", "copies"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.regexp_count(body, F.lit(WORD)).cast("long")
    symbols = F.length(F.regexp_replace(body, SYMBOLS, ""))
    kept = [c for c in columns if keep_text or c != text]
    small = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"),
        words.alias("_size"), symbols.alias("_symbols"), F.col(f"`{source}`").alias("_source"), F.col(f"`{doc_id}`").alias("_id"),
        # documents without an id are told apart by their texts
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.concat(F.lit("null "), F.xxhash64(body))).alias("_name"))
    quality = F.greatest(F.lit(LEAST_QUALITY), F.lit(1.0) - F.col("_symbols") / F.greatest(F.col("_size"), F.lit(1)) / 4)
    small = materialize(small.select("*", quality.alias("_quality"), (-F.log(uniform(F.col("_name"), seed)) / quality).alias("_key")).drop("_name"), "mix")

    step = (1 - LEAST_QUALITY) / QUALITIES
    grade = F.least(F.floor((F.col("_quality") - LEAST_QUALITY) / step), F.lit(QUALITIES - 1))
    of = small.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.count("*").alias("n"),
        F.array(*(F.count_if(grade == i) / F.count("*") for i in range(QUALITIES))).alias("grades"))
    aims = targets(of.select("source", "source_size"), weights).join(
        of.select(F.col("source").alias("s2"), "n", "grades"), F.col("source").eqNullSafe(F.col("s2"))).select(
        "source", "source_size", "target", "n", "grades",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).alias("epochs"))
    aims = materialize(aims.select("*", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
                                   F.greatest(F.lit(1), F.ceil(F.col("n") / BAND_DOCS)).alias("bands")), "mix_targets")
    # One row per source, as many as there are weights to give; Spark measures the written table before it broadcasts it.
    # The share of a source's keys below a key, from the shares of its grades of quality: it rises with the key, so bands keep
    # the order, and hold about as many documents each, however quality is spread.
    below = sum((F.get("grades", F.lit(i)) * (F.lit(1.0) - F.exp(F.col("_key") * F.lit(-(LEAST_QUALITY + (i + 0.5) * step))))
                 for i in range(QUALITIES)), F.lit(0.0))
    banded = small.join(aims, F.col("_source").eqNullSafe(F.col("source"))).withColumn(
        "_band", F.floor(below * F.col("bands"))).drop("grades", "_quality")
    sums = banded.groupBy("_source", "_band").agg(F.sum("_size").alias("in_band"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("_source").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("in_band").over(upto), F.lit(0))).where(
        (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("in_band") > F.col("rest")))
    ends = materialize(ends.select(F.col("_source").alias("_s"), F.col("_band").alias("_end"), F.col("before").alias("_before")), "mix_bands")
    placed = banded.join(ends, F.col("_source").eqNullSafe(F.col("_s")), "left")
    inside = F.coalesce(F.col("_band") == F.col("_end"), F.lit(False))
    order = Window.partitionBy("_source").orderBy("_key", F.col("_id").asc_nulls_last(), "_size").rowsBetween(Window.unboundedPreceding, -1)
    keep = [*(F.col(f"_row.`{c}`").alias(c) for c in kept), F.col("_size").alias(size), F.col("source_size").alias(own),
            F.col("target").alias(target)]

    def told(df: DataFrame, chosen: Column) -> DataFrame:
        n = (F.col("epochs") + chosen.cast("int")).cast("long")
        return df.select(*keep, (n * F.col("_size")).alias(taken), n.alias(copies))

    last = placed.where(inside).withColumn("_sum", F.col("_before") + F.coalesce(F.sum("_size").over(order), F.lit(0)))
    at_end = told(last, (F.col("rest") > 0) & (F.col("_sum") + F.col("_size") / 2 <= F.col("rest")))
    others = told(placed.where(~inside), (F.col("rest") > 0) & F.coalesce(F.col("_band") < F.col("_end"), F.lit(True)))
    return others.unionByName(at_end)
