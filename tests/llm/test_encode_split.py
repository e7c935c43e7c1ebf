import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle import compare
from vigilake.llm import encode as E
from vigilake.llm import queries as Q
from vigilake.llm import split as S

TEXTS = [
    "", " ", "  ", "   ", "a   b", "a  ", "a \n b", "\n\n a", "x \r\n\r\n y", "<|endoftext|> is text", "it's we'll 'tis", "naïve café ☕ 👩‍⚕️ 日本語。次の文。", "a\0b", "tab\tand\x1cfile\x85next \xa0 nbsp", "﻿bom",
    "12345 6 78", "é" * 300, "no_space_" * 4000, "word " * 3000, "línea.\n\nPárrafo nuevo! " * 300, "x​ y",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(E.BYTE_BPE)
    t.encode_special_tokens = True
    return t


def random_texts(n):
    rng = random.Random(2)
    alphabet = [" ", " ", " ", "\n", "\t", "a", "b", "the", "'s", "1", ".", "é", "日", "👍", "\xa0", "\r\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_ids_are_the_librarys(library):
    texts = TEXTS + random_texts(2000) + TEXTS
    e = E.Encoder(E.BYTE_BPE)
    ids, cuts = e.encode([*texts, None])
    for i, t in enumerate(texts):
        own = ids[cuts[i] : cuts[i + 1]].tolist()
        assert own == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert e.decode(own) == t
    assert cuts[-1] == cuts[-2]


def test_ids_when_the_worker_starts_anew(library, monkeypatch):
    monkeypatch.setattr(E, "KEPT_UNITS", 5)
    e = E.Encoder(E.BYTE_BPE)
    for t in TEXTS:
        assert e.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_operator_offsets_and_decoding(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None, "日本"])], "doc_id bigint, text string, ids string")
    out = {r.doc_id: r for r in E.encode(df, offsets=True).collect()}
    assert out[len(TEXTS)].ids == [] and out[0].ids == []
    for i, t in enumerate(TEXTS):
        assert out[i].ids == library.encode(t, add_special_tokens=False).ids
        assert (out[i].ends[-1] if out[i].ends else 0) == len(t)
        assert out[i].ends == sorted(out[i].ends)
    lists = spark.createDataFrame([([40, None, 99999999],), (None,), ([],)], "ids array<int>")
    assert [r[0] for r in lists.select(E.decode(F.col("ids"))).collect()] == ["I�", None, ""]
    assert E.encode(df.limit(0)).count() == 0
    assert all(r.n_changed == 0 for r in Q.QUERIES["p7_roundtrip"](spark, "/root/testdata/sf0.001").collect())


@pytest.mark.parametrize(("limit", "overlap"), [(512, 64), (16, 4), (7, 0), (5, 4), (2, 1)])
def test_pieces_cover_fit_and_overlap(library, limit, overlap):
    e = E.Encoder(E.BYTE_BPE)
    for t in TEXTS + random_texts(150):
        ids, _ = e.encode([t])
        if len(ids) <= limit:
            continue
        found = S.pieces(e, t, ids, limit, overlap, 0.5)
        assert found[0][0] == 0 and found[-1][1] == len(t)
        for a, b, n, shared in found:
            assert n == len(library.encode(t[a:b], add_special_tokens=False).ids)
            assert n <= max(limit, 4)  # characters of up to four tokens
            assert 0 <= shared <= overlap
        for (_, b, *_), (a2, b2, *_) in zip(found, found[1:]):
            assert a2 <= b < b2


def test_cuts_stand_at_the_strongest_boundary():
    e = E.Encoder(E.BYTE_BPE)
    text = ("word " * 30).strip() + ".\n\n" + ("more " * 30).strip() + ". " + ("last " * 30).strip()
    ids, _ = e.encode([text])
    assert text[: S.pieces(e, text, ids, 50, 8, 0.5)[0][1]].endswith(".\n\n")
    assert text[: S.pieces(e, text, ids, 70, 8, 0.9)[0][1]].endswith(".")


@pytest.mark.parametrize(
    "sentence",
    ["съешь же ещё этих мягких французских булок да выпей чаю", "ο κόσμος γράφει ελληνικά κείμενα χωρίς τέλος", "café éblouï santé été déjà vu là", "यह हिन्दी में लिखा हुआ एक लंबा वाक्य है", "naïve “café” – résumé…", "plain english words here"],
)
def test_no_cut_within_a_word_of_any_script(library, sentence):
    e = E.Encoder(E.BYTE_BPE)
    text = " ".join([sentence] * 40)
    ids, _ = e.encode([text])
    for a, b, n, _ in S.pieces(e, text, ids, 96, 32, 0.5):  # a blank is within reach
        assert n == len(library.encode(text[a:b], add_special_tokens=False).ids) <= 96
        assert b == len(text) or text[b - 1].isspace() or text[b].isspace(), text[b - 5 : b + 5]
        assert a == 0 or text[a - 1].isspace() or text[a].isspace(), text[a - 5 : a + 5]


def test_sentence_marks_of_other_scripts_and_closing_quotes():
    e = E.Encoder(E.BYTE_BPE)
    for head, tail in (("日本語" * 20 + "です。」", "次の文" * 30), ("दिन " * 30 + "है।", " शाम" * 40), ("word " * 30 + 'said "stop."', " next" * 60), ("مرحبا " * 30 + "كيف؟", " بخير" * 60), ("你好。", "再见吧" * 30)):
        text = head + tail
        ids, _ = e.encode([text])
        most = len(e.encode([head])[0]) + 6
        assert S.pieces(e, text, ids, most, 0, 0.1)[0][1] == len(head), text[: S.pieces(e, text, ids, most, 0, 0.1)[0][1]][-12:]


def test_coverage_query_same_as_sql(spark, small):
    compare(spark, small, Q.QUERIES, Q.SQL, "p9_coverage")


def test_split_rows(spark):
    df = spark.createDataFrame([(1, "word " * 600, 0), (1, "word " * 600, 0), (2, "short", 0), (3, None, 0), (None, "x " * 900, 0)], "doc_id bigint, text string, piece int")
    out = S.split(df).collect()
    assert {r.doc_id for r in out} == {1, None} and len([r for r in out if r.doc_id == 1 and r.piece == 0]) == 2
    assert {r.doc_id for r in S.split(df, all_texts=True).collect()} == {1, 2, None}
    assert S.split(df.limit(0)).count() == 0


def test_oversized_documents_are_those_over_the_limit(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    expected = {r.doc_id for r in docs if r.text and len(library.encode(r.text, add_special_tokens=False).ids) > 512}
    assert {r.doc_id for r in Q.QUERIES["p9_found"](spark, small).collect()} == expected
