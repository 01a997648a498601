"""The corpus pipeline: documents in, encoded training mix out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept.  Every stage but the last
returns the columns of its input, whatever their names; an empty table gives an empty table; a text of any length is
judged whole.  What a stage does with nulls, ties and repeated rows is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, classifier, jaccard, mix, rules
from candela.llm.common import materialize, spare_name, tokenizer_path
from candela.sources.tables import read_table

#: Rows of a batch that Spark hands to Python.  All stages share the executors, whose heap the SQL stages
#: fill, so the Python side gets batches of a few megabytes instead of up to 64.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: The near-duplicate stage: shingles of five words, similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set(_BATCH, str(BATCH_ROWS))


def _columns(df: DataFrame, names) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in names))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier scores at its threshold or above.

    A null text is scored as an empty one; equal texts get equal scores, so repeated rows stay or go together; a
    null id has no label and is scored like any other.
    """
    _small_batches(spark)
    scored = classifier.score(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    score = spare_name(docs.columns, "score")
    return _columns(scored.where(F.col(score) >= classifier.THRESHOLD), docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that neither the base rules nor the learned list reject.

    A null or empty text has fewer words than the base rules ask for and goes; repeated rows stay or go
    together; a null id has no label to learn from and is judged like any other.
    """
    judged, _ = rules.judge(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]), keep_text=True)
    return _columns(judged.where(F.col(judged.columns[-1])), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group that the Jaccard join links (5 words, 0.8).

    The join knows a row by its id and text, so that different texts with one id are judged apart; a document
    without an id is kept only where its group has none with an id.  A null or empty text is linked with
    nothing, so such rows stay, one for each id.  Of rows with the same id and text one stays, that with the smallest hash of all
    its columns; which rows stay is settled on ids and hashes, texts are only filtered.
    """
    _small_batches(spark)
    key, group, row = (spare_name(docs.columns, c) for c in ("key", "group", "row"))
    named = docs.withColumns({key: F.xxhash64("doc_id", "text"), row: F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))})
    joined = jaccard.join(named.select(F.col(key).alias("doc_id"), "text"), words=WORDS, percent=PERCENT)
    joined = joined.select(F.col("doc_id").alias(key), F.col("component_id").alias(group)).distinct()
    rows = named.groupBy(key, "doc_id", row).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key).alias("key"), F.col(row).alias("row"), F.col("n"))
    first = rows.join(joined, key).groupBy(group).agg(F.min(order).alias("first"))
    first = materialize(first.select(F.col("first.key").alias(key), F.col("first.row").alias(row), F.col("first.n").alias("n")), "kept")
    single = named.join(first.where("n = 1"), [key, row], "left_semi")
    repeated = named.join(first.where("n > 1"), [key, row], "left_semi").dropDuplicates([key, row])
    return _columns(single.unionByName(repeated), docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as many times as the mix takes it.

    A null source is a source of its own; a null or empty text has size 0 and fills no target; repeated rows are
    taken like different documents, and equal ids are in a fixed order, so that reruns agree.
    """
    mixed = mix.mix(docs, keep_text=True)
    return _columns(mixed.withColumn(spare_name(mixed.columns, "copy"), F.explode(F.array_repeat(
        F.lit(True), F.col(mixed.columns[-1]).cast("int")))), docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as tokens: count and digests of the ids and of the text that they decode to.

    A null or empty text has no tokens and the digests of nothing; every repeated row has its own result row.
    """
    _small_batches(spark)
    named = docs.select("doc_id", "text", "source")
    return bpe.encode_decode(named, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", encoding),
]

#: A trained network and learned rules are not SQL: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs, batch = read_table(spark, sf_dir, "documents"), spark.conf.get(_BATCH)
    try:
        for i, (_, stage) in enumerate(STAGES):
            docs = materialize(stage(spark, docs, sf_dir), f"stage_{i + 1}")
    finally:
        spark.conf.set(_BATCH, batch)
    return docs
