"""Operator 11 against a plain alignment, token by token."""

import hashlib
import random
import re
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candela.llm import align
from candela.llm.common import tokenizer_path
from candela.sources.tables import read_table
from tests.conftest import SF001

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def brute(texts):
    """The contract's columns of each text, from whole texts and all overlapping pairs."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: bytes([i]) for i, c in enumerate(align.byte_letters())}
    special = {a.token_to_id("<|endoftext|>"): b"<|endoftext|>"}
    done, counts = [], Counter()
    for t in texts:
        ids_a = a.encode(" " + (t or ""), add_special_tokens=False).ids
        ids_b = b.encode(t or "")
        bytes_a = [special.get(i) or b"".join(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
                   for p in map(b.id_to_piece, ids_b)]
        raw = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            done.append(None)
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            at, found = 0, []
            for p in parts:
                found.append((at, at + len(p)))
                at += len(p)
            spans.append(found)
        links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e] \
            if len(raw) < 3000 else overlapping(*spans)
        counts.update((ids_a[i], ids_b[j]) for i, j in links)
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        text, low = [], 0
        for cut in cuts:
            text.append("|".join(",".join(str(ids[i]) for i, (s, e) in enumerate(sp) if low <= s and e <= cut)
                                 for ids, sp in zip((ids_a, ids_b), spans)) if len(raw) < 3000 else
                        "|".join(",".join(str(ids[i]) for i in inside(sp, low, cut)) for ids, sp in zip((ids_a, ids_b), spans)))
            low = cut
        done.append((ids_a, ids_b, [(ids_a[i], ids_b[j]) for i, j in links], text))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for d in done:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ids_b, links, text = d
        out.append((len(ids_a), len(ids_b), len(text), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(";".join(text).encode()).hexdigest()))
    return out


def overlapping(a, b):
    j, out = 0, []
    for i, (s, e) in enumerate(a):
        while b[j][1] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][0] < e:
            out.append((i, k))
            k += 1
    return out


def inside(spans, low, high):
    from bisect import bisect_left
    i = bisect_left(spans, (low, low))
    while i < len(spans) and spans[i][1] <= high:
        yield i
        i += 1


def check(spark, texts, **kw):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    got = {r["doc_id"]: r for r in align.align(docs, A, B, **kw).collect()}
    assert len(got) == len(texts)
    names = ["n_a_", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for i, want in enumerate(brute(texts)):
        assert tuple(got[i][c] for c in names) == want, (i, texts[i][:80] if texts[i] else None)
        assert got[i]["n_a"] == "x"


ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\nb", "\na", "a\n\nb", "a \n b", " \n", "\t\tx", "x\r\ny", "a᠎ b ᠎c", "▁", "a ▁b",
       "<|endoftext|> x<|endoftext|>", "<s> </s><unk>", "<0x41> <0x0A>", "naïve café Übergröße", "日本語のテキスト です", "🙂🙃 🙂", "a b 　c",
       "é ́x", "\x00 \x1c\x1d y", "it's we're 'll I'd", "1234567 12 3,4.5", "((([[[###", "x" * 300, "a b", "tie tie", "tie tie"]


def test_every_sign_of_the_quick_path_as_the_libraries_cut_it():
    import numpy as np
    texts = ["".join(f"a{chr(c)}1 {chr(c)}b {chr(c)} " for c in range(lo, lo + 16)).strip() or "x" for lo in range(0, 0x300, 16)]
    texts += [f"{a}{chr(c)}{b}" for c in range(0x300) for a, b in (("a", "b"), ("a ", "b"), ("a\n", " b"), ("1", "'s"))]
    pair = align.Pair(A, B)
    assert pair.quick is not None and pair.cuts
    a_ids, b_ids = pair.encode(texts)
    for t, x, y, want in zip(texts, a_ids, b_ids, pair.a.encode_batch([" " + t for t in texts], add_special_tokens=False)):
        ids = pair.b.encode(t)
        if b"".join(map(pair.b_bytes.__getitem__, ids)) == (" " + t).encode():
            assert (np.frombuffer(x, "<u4").tolist(), np.frombuffer(y, "<u4").tolist()) == (want.ids, ids), t
        else:
            assert x == y == b""


def test_odd_texts_and_the_joined_tail(spark):
    rng = random.Random(5)
    signs = [*"ab é日🙂\n\t ▁'1,<", "  ", " the", "\nThe", "tion", "᠎", " ", "s>"]
    mixed = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(150)]
    check(spark, ODD + mixed)
    check(spark, ODD + mixed, hot_pairs=40)
    check(spark, ODD[:6] + mixed[:20], hot_pairs=0)


def test_given_texts_and_a_very_long_one(spark):
    texts = [r["text"] for r in read_table(spark, SF001, "documents").collect()]
    check(spark, texts + [" ".join(t for t in texts if t), "ab" * 30_000], hot_pairs=2000)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "one text"), (None, "one text"), (3, None)], "doc_id long, text string")
    rows = sorted(align.align(docs, A, B).collect(), key=str)
    assert len(rows) == 3 and rows[1] == rows[2] and rows[1]["n_links"] > 0 and rows[0]["groups_sha256"] == ""
    assert align.align(docs.where("doc_id = 9"), A, B).count() == 0


@pytest.mark.parametrize("ends", [([3], [3]), ([1, 2, 3], [3]), ([2, 4, 6, 9], [3, 5, 6, 7, 9]), (list(range(2, 99, 2)) + [99], list(range(1, 99, 2)) + [99])])
def test_groups_end_where_both_end(ends):
    import numpy as np
    a, b = (np.array(x) for x in ends)
    ga, gb = align.groups(a, b)
    cuts = np.array(sorted(set(ends[0]) & set(ends[1])))
    assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()


def test_query(spark):
    from candela.llm.queries import QUERIES
    got = QUERIES["op11_token_alignment"](spark, SF001)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF001, "documents").collect()]
    want = {i: w for (i, _), w in zip(docs, brute([t for _, t in docs]))}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert got.where(F.col("n_links") < F.col("n_groups")).isEmpty()
