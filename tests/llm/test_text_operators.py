"""BPE, word-piece counts and the licence scan against a library, brute force and SQL."""

import hashlib
import random
import re
import sys

import numpy as np
import pytest

from candela.llm import bpe, license, wordpiece
from candela.llm.common import tokenizer_path
from candela.sources.tables import read_table
from tests.conftest import SF001

ODD = [None, "", "  \n\t ", "a<|endoftext|>B <|startoftext|>c", "it's I'LL we'Ve", "ΟΔΟΣ ΣΑΣ", "İstanbul ǅ ﬁ", "x" * 3000,
       "1234 5² ½", "é é", "🙂🙂 mixed 漢字 text", "\x1c a\x85b​c"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(spark, tokenizer):
    rows = [(i, t, "clash", "clash") for i, t in enumerate(ODD + ["the same text"] * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string")
    out = bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"))
    assert out.columns == ["doc_id", "text", "ids", "decoded", "ids_", "decoded_"]
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t, *_ in rows:
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids_"], "<u4").tolist() == want, t
        assert got[i]["decoded_"] == tokenizer.decode(want, skip_special_tokens=False), t
        assert got[i]["ids"] == "clash"


def test_bpe_equals_the_library_for_every_code_point(tokenizer):
    model = bpe.load(tokenizer_path("word_bpe_49k.json"))
    signs = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    sure, unsure = [x for x in signs if not model.unsure(x)], [x for x in signs if model.unsure(x)]
    assert len(sure) > 90_000            # Python's own rules decide these, the library the others
    texts = [" ".join(f"a{x}1 {x}" for x in part[i:i + 256]) for part in (sure, unsure) for i in range(0, len(part), 256)]
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(model.encode(text), "<u4").tolist() == want.ids, hex(ord(text[1]))


def test_bpe_query_on_documents(spark, tokenizer):
    from candela.llm.queries import op4_bpe
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF001, "documents").collect()}
    rows = op4_bpe(spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_segment_tree_merges_the_leftmost_lowest_rank_first():
    model = bpe.load(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(4)

    def plain(ids):
        while True:
            best = min(((r, i) for i in range(len(ids) - 1)
                        if (r := model.ranks.get(ids[i] * model.base + ids[i + 1])) is not None), default=None)
            if best is None:
                return ids
            ids[best[1]:best[1] + 2] = [model.merged[best[0]]]

    for _ in range(300):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 40)))
        ids = [model.inner[ord(c)] for c in word[:-1]] + [model.last[ord(word[-1])]]
        assert model.merge(list(ids)) == plain(list(ids)), word


def greedy(word, heads, tails):
    at, n = 0, 0
    while at < len(word):
        pieces = heads if at == 0 else tails
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_longest_match_automaton_counts_greedy_pieces():
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abc") for _ in range(rng.randint(1, n)))
    for _ in range(400):
        heads, tails = {word(4) for _ in range(6)}, {word(4) for _ in range(rng.randint(0, 6))}
        automaton = wordpiece.LongestMatch(heads, tails)
        for _ in range(12):
            w = word(10)
            assert automaton.count(w) == greedy(w, heads, tails), (w, heads, tails)
    assert wordpiece.LongestMatch(["ab"], ["c"], most_chars=3).count("abcc") == 1


def test_token_counts_equal_the_library(spark):
    import sentencepiece
    from tokenizers.models import WordPiece
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    vocab = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i)
            name = piece[1:] if piece.startswith("▁") else "##" + piece
            if name not in ("", "##"):
                vocab.setdefault(name, len(vocab))
    library = WordPiece({**vocab, "[UNK]": len(vocab)}, unk_token="[UNK]", max_input_chars_per_word=10 ** 9)
    docs = read_table(spark, SF001, "documents", ["doc_id", "text"]).union(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    for r in wordpiece.token_counts(docs, tokenizer_path("piece_bpe_32k.model")).collect():
        words = re.findall(wordpiece.PIECES, r["text"] or "")
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(len(library.tokenize(w)) for w in words))


def brute_licences(text):
    words = re.findall(license.LICENCE_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for t in license.TEMPLATES:
        own, key, at = t.words(), t.key.split(), t.key_at()
        for i in range(len(words)):
            if words[i:i + len(key)] == key:
                same = sum(0 <= i - at + j < len(words) and words[i - at + j] == w for j, w in enumerate(own))
                if same / len(own) >= license.LEAST_COVERAGE:
                    found.append((t.label, i, same / len(own), t.base))
    return len(words), sorted(found)


def test_licence_scan_against_every_place(spark):
    texts = [None, "", "Under the MIT License. under-the_mit license!", "Apache License, Version 2.0 (cc by-nc)",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software now",
             "cc by nc cc by nc cc-by-sa", "no licence here but MIT and apache and nc", "GNU General Public License, version 3",
             "mit license under the apache license", "filler " * 5000 + "under the mit license", "any person obtaining a copy of this software"]
    texts += [texts[2]] * 3
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    rows = license.scan(docs).collect()
    assert license.scan(docs).columns == ["doc_id", "text", "n_words", "n_words_", "licences"]
    for r in rows:
        n, found = brute_licences(r["text"])
        assert r["n_words_"] == n
        assert sorted((x["label"], x["start"], x["coverage"], x["base"]) for x in r["licences"]) == found
    assert license.scan(docs.limit(0)).collect() == []


def test_licence_postings_take_the_rarest_key_word():
    t = license.Template("x", "some words cc by nc here", "cc by nc")
    assert license.postings([t], {"cc": 50, "by": 9000, "nc": 3}) == [("nc", 4)]


def test_map_operators_on_empty_tables_and_clashing_names(spark):
    rows = [(1, None, "n", 5), (2, "", "n", 5), (2, "", "n", 5), (3, "two words " * 50_000, "n", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_tokens int")
    got = wordpiece.token_counts(docs, tokenizer_path("piece_bpe_32k.model"))
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens", "n_words_", "n_tokens_"]
    assert sorted((r["doc_id"], r["n_words_"]) for r in got.collect()) == [(1, 0), (2, 0), (2, 0), (3, 100_000)]
    for out in (wordpiece.token_counts(docs.limit(0), tokenizer_path("piece_bpe_32k.model")),
                bpe.encode_decode(docs.limit(0), tokenizer_path("word_bpe_49k.json"))):
        assert out.collect() == []
