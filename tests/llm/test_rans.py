"""Operator 13: exact round trips, and the query against the library."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from candela.llm import rans
from candela.llm.common import tokenizer_path
from candela.llm.remember import Remembered
from candela.sources.tables import read_table
from tests.conftest import SF001
from tests.llm.test_align import ODD

PATH = tokenizer_path("word_bpe_49k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for x in texts]


def table_of(blocks):
    symbols, counts = np.unique(np.concatenate([*blocks, np.zeros(0, np.int64)]), return_counts=True)
    return rans.Table(symbols, counts)


def check_blocks(blocks):
    table = table_of(blocks)
    coded = rans.encode_blocks(blocks, table)
    back = rans.decode_blocks([(len(b), w, m) for b, (w, m) in zip(blocks, coded)], table)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, back)) and len(blocks) == len(back)
    return table, coded


def test_block_lengths_around_lanes_and_checkpoints():
    rng = np.random.default_rng(3)
    span = rans.LANES * rans.STEPS
    sizes = [0, 1, rans.LANES - 1, rans.LANES, rans.LANES + 1, span - 1, span, span + 1, 3 * span + 7, 100_000]
    check_blocks([np.minimum(rng.zipf(1.3, n), 49_407) for n in sizes])
    check_blocks([np.full(n, 7) for n in sizes])                     # one symbol has the whole scale
    check_blocks([rng.permutation(49_408), np.zeros(0, np.int64)])    # every symbol once
    check_blocks([])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=200), max_size=6))
def test_any_blocks(blocks):
    check_blocks([np.array(b, np.int64) for b in blocks])


def test_size_is_near_the_entropy_and_blocks_are_independent():
    rng = np.random.default_rng(4)
    blocks = [np.minimum(rng.zipf(1.5, 50_000), 5000) for _ in range(4)]
    table, coded = check_blocks(blocks)
    p = np.bincount(np.concatenate(blocks)) / 200_000
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * 200_000
    assert sum(len(w) for w, _ in coded) * 8 < bits * 1.03 + 4 * 64 * rans.LANES
    w, m = coded[2]
    assert np.array_equal(rans.decode_blocks([(50_000, w, m)], table)[0], blocks[2])
    # one stretch alone, from its own checkpoint
    span, width = rans.LANES * rans.STEPS, 8 * (rans.LANES + 1)
    assert np.array_equal(rans.decode_blocks([(span, w, m[width:2 * width])], table)[0], blocks[2][span:2 * span])


def test_scaled_frequencies_with_a_hot_symbol():
    t = rans.Table(np.arange(60_000), np.concatenate([[10**12], np.ones(59_999)]))
    assert t.freq.min() == 1 and int(t.freq.sum()) == 1 << t.bits


def test_encoder_equals_the_library():
    rng = random.Random(6)
    signs = [*"aB éÉ日🙂\n\t'1,<İΣς", "  ", " the", "\nThe", "TION", "'LL", "\x85", "\xa0", "́", " ", "|>", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(400)]
    encode = rans.Encoder(PATH)
    for _ in range(2):
        assert [np.frombuffer(x, encode.kind).astype("<u4").tobytes() for x in encode(texts)] == library(texts)


def test_every_sign_between_spaces_and_letters():
    # signs that the file's pattern decides go through the cut; all others are the library's own
    texts = ["".join(f"a{chr(c)}1 {chr(c)} " for c in range(lo, lo + 16)) for lo in range(0, 0x300, 16)]
    assert [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in rans.Encoder(PATH)(texts)] == library(texts)


def test_words_are_cut_many_texts_at_once():
    rng = random.Random(7)
    for signs in ([*"ab \n'1,<stmdrevl", "'s", "'ll", "''", "'re"], [*"aéßÿǅŁ \x85\xa0\x1c'1²½ª!", "'s", "'vé", "ŉ"]):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))).lower() for _ in range(300)] + ["", "'", "'s", "x'l"]
        encode = rans.Encoder(PATH)
        words, encoding, upto = encode.cut(texts)
        cut = [encode.near(t) for t in texts]
        assert [w.decode(encoding) for w in words.to_pylist()] == [w for some in cut for w in some]
        assert upto.tolist() == np.cumsum([len(some) for some in cut]).tolist()
        encode.near = None                                              # no text is cut on its own
        assert [np.frombuffer(x, encode.kind).astype("<u4").tobytes() for x in encode(texts)] == library(texts)
    assert rans.Encoder(PATH)([]) == [] and rans.Encoder(PATH)([None, "", " "]) == [np.array([1], "<u2").tobytes()] * 3


@pytest.mark.parametrize("pattern", [
    rans.RUNS, "'s|'nt|" + rans.RUNS, r"'s|[\p{L}]+|[\p{N}]+|[^\s\p{L}\p{N}]+", r"b[a]|" + rans.RUNS, r"b" + rans.RUNS])
def test_files_with_another_pattern(tmp_path, pattern):
    import json
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = pattern
    path = str(tmp_path / "other.json")
    json.dump(spec, open(path, "w", encoding="utf-8"))
    texts = ["ban 's it's isn'nt 12 b3, ''s 'nté Éa", "x", "", "ba'snt!'s"]
    encode, whole = rans.Encoder(path), Tokenizer.from_file(path)
    assert [np.frombuffer(x, encode.kind).tolist() for x in encode(texts)] == [[*whole.encode(t).ids, 1] for t in texts]


def test_remembered_results_in_order():
    asked = []
    known = Remembered(lambda pieces: asked.append(pieces) or [p.upper() for p in pieces], 2)
    assert known.results(["b", "a"]) == ["B", "A"] and known.results(["c", "a"]) == ["C", "A"]
    assert known.results(["d", "b", "e"]) == ["D", "B", "E"] and known.results([]) == []
    assert asked[:3] == [["b", "a"], ["c"], ["d", "e"]]


def expected(rows):
    """(doc_id, start, n_tokens, crc) of rows sorted by id, nulls first."""
    ids = sorted(zip([r[0] for r in rows], library([r[1] for r in rows])), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for name, raw in ids:
        out.append((name, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    return out


def test_query(spark):
    from candela.llm.queries import QUERIES
    got = QUERIES["op13_rans_ids"](spark, SF001)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, SF001, "documents").collect()]
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_many_files_long_texts_and_odd_rows(spark, tmp_path):
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(100, "long word " * 60_000, 0), (-5, None, 0), (101, "x" * 20_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    folder = str(tmp_path / "ids")
    rans.write_ids(docs, PATH, folder)
    got = sorted(rans.read_ids(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    assert [tuple(r)[:4] for r in got] == expected(rows)
    assert [r["ids"] for r in got] == [raw for _, raw in sorted(zip([r[0] for r in rows], library([r[1] for r in rows])))]


def test_null_and_repeated_ids_and_an_empty_table(spark, tmp_path):
    rows = [(None, "two words"), (None, "two words"), (4, "a"), (4, "a"), (4, "other text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, rans.ids_round_trip(docs, PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 4, 4, 4]
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == sorted((str(r[0]), len(x) // 4, zlib.crc32(x)) for r, x in zip(rows, library([t for _, t in rows])))
    assert rans.ids_round_trip(docs.where("doc_id = 99"), PATH).count() == 0


def test_a_damaged_block_is_an_error(spark, tmp_path):
    from pyspark.sql import functions as F
    folder = str(tmp_path / "ids")
    rans.write_ids(spark.createDataFrame([(1, "some words " * 50)], "doc_id long, text string"), PATH, folder)
    blocks = spark.read.parquet(f"{folder}/blocks").withColumn("crc32", F.col("crc32") + 1).collect()
    spark.createDataFrame(blocks, rans.BLOCK).write.mode("append").parquet(f"{folder}/blocks")
    with pytest.raises(PythonException, match="checksum"):
        rans.read_ids(spark, folder).collect()
