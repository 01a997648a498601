"""The pipeline stage by stage, each against its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candela.llm import classifier
from candela.sources.tables import read_table
from tests.conftest import SF01
from tests.llm.helpers import brute_components
from tests.llm.test_quality import brute_statistics


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = read_table(spark, SF01, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(i))
        stage(spark, docs, SF01).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_columns_and_order(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_classifier_stage(spark, stages):
    before, after = stages[0]
    scored = classifier.score(before, read_table(spark, SF01, "labels", ["doc_id", "quality"]))
    want = {r["doc_id"] for r in scored.where(F.col("score") >= 0.7).collect()}
    assert {r["doc_id"] for r in after.collect()} == want and len(want) < before.count()


def test_rules_stage(stages):
    before, after = stages[1]
    kept = {r["doc_id"]: r["text"] for r in after.collect()}
    for r in before.collect():
        n, _, _, _, repeat = brute_statistics(r["text"])
        if n < 20 or 100 * repeat > 30 * n:
            assert r["doc_id"] not in kept
        elif r["doc_id"] in kept:
            assert kept[r["doc_id"]] == r["text"]


def test_join_stage(stages):
    before, after = stages[2]
    rows = sorted(before.collect(), key=lambda r: r["doc_id"])
    want = {rows[i]["doc_id"] for i, (_, first) in enumerate(brute_components([r["text"] for r in rows], 80, 5)) if i == first}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(want)


def test_join_stage_judges_texts_with_one_id_apart(spark):
    one, two, three, four = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, one), (5, one), (5, two), (5, two), (7, two + " more"), (9, three), (9, four), (None, three), (None, four + " more"),
            (None, "only this text has no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF01).collect()}
    assert got == {(1, one), (5, two), (9, three), (9, four), (None, "only this text has no id at all")}


def test_join_stage_takes_a_copy_with_a_fifth_added(spark):
    base = [f"w{i}" for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join([*base, *(f"new{i}" for i in range(20))])),
                                  (3, " ".join([*base, *(f"other{i}" for i in range(40))]))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF01).collect()) == [1, 3]


def test_join_stage_keeps_one_of_rows_that_differ_elsewhere(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text, "c"), (3, None, "d"), (3, None, "d"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs.repartition(n), SF01).collect()), key=str) for n in (1, 4)]
    assert got[0] == got[1] and len(got[0]) == 3
    assert [r[0] for r in got[0]] == [1, 3, 4] and got[0][0] in {(1, text, "a"), (1, text, "b")}


CLASHES = "doc_id long, text string, lang string, source string, score double, kept string, key string, `group` string, row int, copy int, taken long"


@pytest.mark.parametrize("nr", range(5))
def test_stages_with_odd_rows(spark, nr):
    """Nulls, empty and very long texts, repeated rows and columns with the names that stages use."""
    good = read_table(spark, SF01, "documents").where("length(text) > 1500").limit(3).collect()
    texts = [None, "", " ", "word", "#" * 5000, "long words in a row " * 40_000, *(r["text"] for r in good)]
    rows = [(i, t, "en", None if i % 2 else "web", 0.5, "k", "key", "g", 1, 2, 3) for i, t in enumerate(texts)]
    rows += [(None, t, *rows[0][2:]) for t in texts[-2:]] + rows[-2:]
    docs = spark.createDataFrame(rows, CLASHES)
    name, stage = corpus_pipeline.STAGES[nr]
    out = stage(spark, docs, SF01)
    found = out.collect()
    empty = stage(spark, docs.where("doc_id > 99"), SF01)
    assert empty.count() == 0 and empty.columns == out.columns
    if nr == 4:
        assert len(found) == len(rows) and {r["n_tokens"] for r in found if r["doc_id"] in (0, 1, 2)} == {0}
        return
    assert out.columns == docs.columns and {tuple(r) for r in found} <= set(rows)
    if nr == 1:
        assert not {r["doc_id"] for r in found} & {0, 1, 2, 3}
    if nr == 2:
        assert len(found) == len(set(found)) == len(texts)
    if nr == 3:
        assert max(found.count(r) for r in found) <= 3 * 2          # a row of a repeated pair stands for both


def test_run_gives_the_batch_size_back(spark, monkeypatch):
    before = spark.conf.get(corpus_pipeline._BATCH)
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[4:])
    assert corpus_pipeline.run(spark, SF01).count() == read_table(spark, SF01, "documents").count()
    assert spark.conf.get(corpus_pipeline._BATCH) == before


def test_mix_and_encoding_stages(stages):
    before, after = stages[3]
    known = {r["doc_id"]: r for r in before.collect()}
    assert all(known[r["doc_id"]] == r for r in after.collect())
    size = sum(brute_statistics(r["text"])[0] for r in before.collect())
    assert abs(sum(brute_statistics(r["text"])[0] for r in after.collect()) - size) < 0.2 * size
    assert stages[4][1].count() == after.count()
