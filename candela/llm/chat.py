"""Operator 7: chat formatting by quotation linking.

Each message is cut into passages, runs of lines with one quote level.  A quoted passage,
normalised and hashed, is joined to the first message of its conversation that says the same
(all of it, a paragraph or a line).  The message answers the latest message that it quotes at
its lowest level; following these links gives the thread.  The result are messages without the
quotes that are linked, in reply order: by conversation, thread and turn.  What looks like a quote and is
linked with nothing (words of someone else, the prompt of a shell) stays as it was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.llm.common import materialize, spare_name

QUOTE = r"^((?:[ \t]*>)+)[ \t]?"
#: Lines that announce a quote.
INTRODUCTION = r"(?i)(wrote|writes|said|schrieb|écrit|escribió)\s*:\s*$"
#: Doublings of a reply chain: more than enough for 2**40 replies to replies.
MOST_DOUBLINGS = 40


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once in the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def passages(text: Column) -> Column:
    """Array of (level, text, raw): runs of lines that share a quote level, in order; ``raw`` has the quote marks."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, QUOTE, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(x, QUOTE, "").alias("line"), x.alias("raw")))

    def cut(ls: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ls) - 1),
                          lambda i: (i == 0) | (F.get(ls, i)["level"] != F.get(ls, i - 1)["level"]))
        return let(starts, lambda s: F.transform(s, lambda a, k: F.struct(
            F.get(ls, a)["level"].alias("level"),
            *(F.array_join(F.transform(F.slice(ls, a + 1, F.coalesce(F.get(s, k + 1), F.size(ls)) - a),
                                       lambda x: x[of]), "\n").alias(name) for name, of in (("text", "line"), ("raw", "raw"))))))

    return let(lines, cut)


def own_text(parts: Column, linked: Column | None = None) -> Column:
    """The passages without quotes or, once the places of ``linked`` quotes are known, without these.

    A line that only announces the quote after it goes with that quote.
    """
    gone = (lambda i: F.array_contains(linked, i)) if linked is not None else (lambda i: F.get(parts, i)["level"] > 0)
    announced = r"(^|\n)[^\n]*" + INTRODUCTION.replace("(?i)", "(?i:") + ")"
    said = F.transform(parts, lambda p, i: F.when(gone(i), F.lit("")).otherwise(
        F.when(F.coalesce(gone(i + 1), F.lit(False)) & (p["level"] == 0) & (i + 1 < F.size(parts)),
               F.regexp_replace(F.regexp_replace(p["text"], r"\s+$", ""), announced, ""))
        .when(p["level"] > 0, p["raw"]).otherwise(p["text"])))
    return stripped(F.array_join(F.filter(said, lambda t: stripped(t) != ""), "\n"))


def keys_of(text: Column) -> Column:
    """Hashes under which a message can be found: the whole, its paragraphs and its lines."""
    units = F.concat(F.array(text), F.split(text, r"\n\s*\n"), F.split(text, r"\n"))
    return F.transform(F.array_distinct(F.filter(F.transform(units, normalised), lambda u: u != "")), lambda u: F.md5(u))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every message without its linked quotes, with ``reply_to``, ``thread``, ``depth``, ``n_quotes``, ``n_linked`` and ``formatted``.

    ``reply_to`` is the turn answered (null: none is quoted), ``thread`` the turn where the
    chain of replies begins, ``depth`` its length.  Rows come ordered by conversation, thread
    and turn.  A passage's original is the earliest turn that holds it, found with one hash aggregate, so
    that neither a long conversation nor a frequent sentence is gathered in one task.  Null and
    empty texts have no passages; messages with a null conversation or turn are kept but not
    linked; repeated rows are linked alike; of turns that occur twice the earliest reply counts; an
    empty table gives no rows.  Clashing column names get an underscore appended.
    """
    kept = [c for c in messages.columns if c != text]
    parsed = messages.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col(f"`{conv}`").alias("_conv"),
        F.col(f"`{turn}`").alias("_turn"), F.col(f"`{role}`").alias("_role"), passages(F.col(f"`{text}`")).alias("_parts"))
    parsed = materialize(parsed, "chat")
    is_placed = F.col("_conv").isNotNull() & F.col("_turn").isNotNull()
    placed = parsed.where(is_placed)

    numbered = F.filter(F.transform("_parts", lambda p, i: F.struct(i.alias("q"), p["level"].alias("level"), p["text"].alias("text"))),
                        lambda p: (p["level"] > 0) & (stripped(p["text"]) != ""))
    quotes = placed.select("_conv", "_turn", F.explode(numbered).alias("_p")).select(
        "_conv", "_turn", F.col("_p.q").alias("_q"), F.col("_p.level").alias("_level"),
        F.explode(keys_of(F.col("_p.text"))).alias("_key")).distinct()
    # Only passages that someone quotes are looked up among the originals.
    wanted = quotes.select("_conv", "_key").distinct()
    originals = placed.select("_conv", "_turn", F.explode(keys_of(own_text(F.col("_parts")))).alias("_key")).join(
        wanted, ["_conv", "_key"], "left_semi").groupBy("_conv", "_key").agg(F.min("_turn").alias("_from"))
    found = quotes.join(originals, ["_conv", "_key"]).where(F.col("_from") < F.col("_turn"))
    passage = found.groupBy("_conv", "_turn", "_q").agg(F.min("_level").alias("_level"), F.max("_from").alias("_from"))
    links = materialize(passage.groupBy("_conv", "_turn").agg(
        F.min(F.struct("_level", (-F.col("_from")).alias("_back"))).alias("_best"), F.collect_set("_q").alias("_gone")).select(
        "_conv", "_turn", (-F.col("_best._back")).alias("_reply"), "_gone"), "chat_links")       # the passages of one message

    # Pointer doubling along the links alone: each step joins unique keys.
    chains = links.select("_conv", "_turn", F.col("_reply").alias("_root"), F.lit(1).cast("long").alias("_depth"))
    for _ in range(MOST_DOUBLINGS):
        further = chains.select("_conv", F.col("_turn").alias("_root"), F.col("_root").alias("_next"), F.col("_depth").alias("_more"))
        stepped = chains.join(further, ["_conv", "_root"], "left")
        if stepped.where(F.col("_next").isNotNull()).isEmpty():
            break
        chains = materialize(stepped.select("_conv", "_turn", F.coalesce("_next", "_root").alias("_root"),
                                            (F.col("_depth") + F.coalesce("_more", F.lit(0))).alias("_depth")), "chat_chains")
    # rows without a conversation or turn have no links: they stay out of the joins, where they would share one key
    out = placed.join(links, ["_conv", "_turn"], "left").join(chains, ["_conv", "_turn"], "left").unionByName(
        parsed.where(~is_placed), allowMissingColumns=True)
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    out = out.select("*", own_text(F.col("_parts"), gone).alias("_own"), F.size(gone).cast("long").alias("_linked"),
                     F.size(numbered).cast("long").alias("_quotes"))
    taken, columns = list(kept), [F.col(f"_row.`{c}`").alias(c) for c in kept]
    formatted = F.concat(F.lit("<|"), F.coalesce("_role", F.lit("user")), F.lit("|>\n"), F.col("_own"), F.lit("\n"))
    for name, value in (("text", F.col("_own")), ("reply_to", F.col("_reply")), ("thread", F.coalesce("_root", "_turn")),
                        ("depth", F.coalesce("_depth", F.lit(0).cast("long"))), ("n_quotes", F.col("_quotes")),
                        ("n_linked", F.col("_linked")), ("formatted", formatted)):
        taken.append(spare_name(taken, name))
        columns.append(value.alias(taken[-1]))
    return out.orderBy("_conv", F.coalesce("_root", "_turn"), "_turn").select(*columns)
