import random

import pytest

from vigilake.llm import leak as L
from vigilake.llm import queries as Q

QUESTION = "Which of the following best explains the finding?"


def vocabulary(rng, n=3000):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n)]


def make(seed=1, items=60, docs=300):
    rng = random.Random(seed)
    voc = vocabulary(rng)
    texts = {i: " ".join(rng.choice(voc) for _ in range(rng.randrange(40, 120))) + ". " + QUESTION for i in range(items)}
    corpus, truth = {}, set()
    for d in range(docs):
        words = [rng.choice(voc) for _ in range(rng.randrange(0, 400))]
        if rng.random() < 0.6:
            i = rng.randrange(items)
            w = L.words(texts[i])
            n = rng.choice([8, 12, 15, 24, 40, len(w)])
            n = min(n, len(w))
            at = rng.randrange(len(w) - n + 1)
            part, edits = w[at : at + n], 0
            for k in range(6, n - 6, 10):
                if rng.random() < 0.8 and n >= 24:
                    part[k] = rng.choice(["changed", None, part[k] + " added"])
                    edits += 1
            part = [x for x in part if x]
            if n >= 24:
                truth.add((d, i))
            cut = rng.randrange(len(words) + 1)
            words[cut:cut] = [rng.choice([x, x.upper(), f"<b>{x}</b>", x + ",", f"**{x}**"]) for x in " ".join(part).split()]
        corpus[d] = rng.choice([" ", "\n", "  "]).join(words)
    return texts, corpus, truth


def test_recall_and_precision_against_planted_passages(spark):
    texts, corpus, truth = make()
    items = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "item_id bigint, text string, doc_id int")
    docs = spark.createDataFrame([(d, t, 1) for d, t in corpus.items()], "doc_id bigint, text string, n_words int")
    found = {(r.doc_id, r.item_id) for r in L.leaks(docs, items).collect()}
    assert len(truth - found) <= 0.01 * len(truth) and len(found - truth) <= 0.01 * len(truth)


def exact(texts, corpus):
    """All pairs of a text and an item by alignment alone."""
    memo, out = L._Words(), set()
    hashed = {i: L.item_hashes(t, memo) for i, t in texts.items()}
    for d, text in corpus.items():
        h = L.item_hashes(text or "", memo)
        if len(h) >= 18:
            out |= {(d, i) for i, w in hashed.items() if len(w) >= 20 and L.aligned(w, L.shingles(w), h, L.shingles(h), 20, 8)}
    return out


def found(spark, texts, corpus, monkeypatch):
    """The pairs found by a broadcast index; by a joined one, the rows are the same."""
    items = spark.createDataFrame(list(texts.items()), "item_id bigint, text string")
    docs = spark.createDataFrame(list(corpus.items()), "doc_id bigint, text string")
    rows = sorted(map(tuple, L.leaks(docs, items).collect()))
    monkeypatch.setattr(L, "LOCAL_ROWS", 0)
    assert sorted(map(tuple, L.leaks(docs, items).collect())) == rows
    return {r[:2] for r in rows}


def test_same_as_aligning_everything(spark, monkeypatch):
    """The search finds what the exact alignment of every pair finds."""
    texts, corpus, _ = make(seed=4, items=12, docs=80)
    assert found(spark, texts, corpus, monkeypatch) == exact(texts, corpus)


def test_items_that_share_closings_and_short_items(spark, monkeypatch):
    """Stock questions are told over all items, in small shares as well; items little longer than a passage are found."""
    rng = random.Random(8)
    voc = vocabulary(rng)
    question = "Which one of all these many answers that stand below is the one that explains the finding best?"
    texts = {i: " ".join(rng.choice(voc) for _ in range(rng.randrange(4, 40))) + ". " + (question if i % 2 else QUESTION) for i in range(200)}
    corpus = {i: " ".join(rng.choice(voc) for _ in range(60)) + " " + texts[i] + " " + " ".join(rng.choice(voc) for _ in range(60)) for i in range(0, 200, 3)}
    corpus[500] = " ".join([question, QUESTION] * 9)
    expected = exact(texts, corpus)
    # pairs that agree in little but a closing question are no candidates
    got = found(spark, texts, corpus, monkeypatch)
    assert {(i, i) for i in corpus if i < 500 and len(L.words(texts[i])) >= 20} <= got <= expected and len(expected - got) < 9
    assert not any(d == 500 for d, _ in expected)


def test_numbers_of_agreements_by_size():
    plan = L.Plan()
    assert plan.set_class([27, 23, 22, 18, 17, 10]).tolist() == [0, 0, 1, 1, 2, 3]
    for u in range(plan.set_classes):
        assert plan.needed(u, 0) <= (plan.needed(u + 1, 0) if u + 1 < plan.set_classes else L.HASHES)  # smaller sets must agree more
    assert plan.query_class(18) == plan.query_class(90) == 0 and plan.query_class(17) == 1 and plan.query_class(1) == 3


def test_filter_holds_every_value(spark):
    texts, _, _ = make(items=30, docs=1)
    items = spark.createDataFrame([(i, t) for i, t in texts.items()], "item bigint, t string")
    plan = L.Plan()
    index = L._index(items, set(), plan)
    rows = index.collect()
    flt = L._filter(index, len(rows), plan)
    local = L._local(items.selectExpr("item", "item i", "t"), index, plan)
    import numpy as np

    same = L._filter_of(local, len(rows), plan)
    assert (same.table == flt.table).all() and (same.least == flt.least).all()
    for k in range(L.HASHES):
        v = np.array([r.v for r in rows if r.k == k], np.uint32)
        assert len(flt.may_hold(k, v)) == len(v) > 0
        assert len(flt.may_hold(k, np.arange(5000, dtype=np.uint32) * 77_777)) < 100


@pytest.mark.parametrize("rows", [4_000_000, 0])
def test_edges(spark, monkeypatch, rows):
    monkeypatch.setattr(L, "LOCAL_ROWS", rows)
    texts, _, _ = make(items=5, docs=1)
    one = L.words(texts[0])
    docs = [(1, texts[0]), (2, texts[0].upper().replace(" ", "\n")), (3, " ".join(one[:19])), (4, " ".join(one[:20])), (5, None), (6, ""), (7, "  "), (8, QUESTION * 5), (9, ("x " * 50_000) + " ".join(one[5:40])), (None, texts[0]), (1, texts[0])]
    rows = [*texts.items(), (0, texts[0]), (None, texts[1]), (9, "too short"), (10, None)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(rows, "item_id bigint, text string")
    expected = [(None, 0), (1, 0), (1, 0), (2, 0), (4, 0), (9, 0)]
    run = lambda: sorted(((r.doc_id, r.item_id) for r in L.leaks(d, i).collect()), key=str)
    assert run() == sorted(expected, key=str)
    assert L.leaks(d.limit(0), i).count() == 0 and L.leaks(d, i.limit(0)).count() == 0


def test_extension_counts_edits():
    a = list("abcdefghij")
    assert L._extend(a, list("abcdefghij"), 2)[0] == 10
    assert L._extend(a, list("abXdefghij"), 1) == [2, 10]
    assert L._extend(a, list("abdefghij"), 1) == [2, 10]
    assert L._extend(a, list("abXcdefghij"), 1) == [2, 10]


def test_query(spark, small):
    assert Q.QUERIES["p8_found"](spark, small).count() > 0


def test_long_tags_and_comments_are_markup():
    link = '<a href="https://example.org/' + "part/" * 30 + '" class=\'x y\' download title="a > b">'
    assert L.words(f"one {link}two</a> three <img src=x{'y' * 100} hidden/>four") == ["one", "two", "three", "four"]
    assert L.words("one<!-- two\n<b> " + "x " * 99 + "--> three <!-- four") == ["one", "three", "four"]
    prose = "if a <b then " + "so it goes on and on " * 9 + "until c> d"
    assert len(L.words(prose)) == len(prose.replace("<", " ").replace(">", " ").split())
    assert len(L.words('<a b="' * 20_000)) == 40_000 and len(L.words("<!-- x " * 20_000 + "y")) == 20_001
