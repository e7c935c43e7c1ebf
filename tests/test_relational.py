from pyspark.sql import functions as F

from vigilake.operators import linkage as L
from vigilake.operators import relational as R


def test_first_rows_and_values_are_the_same_however_partitioned(spark):
    rows = [(k, v, w) for k in range(20) for v, w in ((None, 3), (2, 3), (1, 4))]
    df = spark.createDataFrame(rows, "k int, v int, w int")
    one = R.first_rows(df.repartition(5), ["k"], [F.col("w")])
    two = R.first_rows(df.repartition(2, "w"), ["k"], [F.col("w")])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) == [(k, None, 3) for k in range(20)]
    assert {r.v for r in R.first_values(df, ["k"], ["v"], ["w"]).collect()} == {2}


def test_count_back_counts_null_keys_together(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    out = {(r.id, r.source_record_count) for r in R.count_back(df, [F.col("k")], ["id"]).collect()}
    assert out == {(1, 2), (3, 1)}


def test_numbered_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i,) for i in range(997, 0, -1)], "i int").repartition(7)
    assert sorted((r.i, r.n) for r in R.numbered(df, ["i"], "n").collect()) == [(i, i) for i in range(1, 998)]


def test_tables(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "a", 1), (3, None, None)], "id int, c string, f int")
    assert R.key_audit(df, ["id"]).first().asDict() == {"n_groups": 3, "n_repeated": 1, "n_extra_rows": 1}
    assert {r.item: r.n for r in R.one_or_several(df, "id", "c").collect()} == {"One": 1, "Multiple": 1}
    assert R.flag_rows(df, ["f"]).first().asDict() == {"item": "f", "n": 2, "total": 4, "percent": 50.0}
    assert [(r.c, r["rank"]) for r in R.top(df, [], "c", 1).collect()] == [("a", 1)]
    assert R.coverage(df, ["c"]).first().percent_present == 75.0
    assert R.union_all([df.select("id"), df.select("c")]).count() == 8
    assert R.with_column_if_absent(df, "z", F.lit(1)).columns[-1] == "z" and R.select_existing(df, ["f", "q", "id"]).columns == ["f", "id"]


def test_cascade_takes_the_first_hit(spark):
    rows = [
        ("FOO", ["X"]), ("BAR", ["NOPE", "X"]), ("SYN", []), ("NONE", ["?", "syn"]), ("BAZ TABLET", []), ("BRAND", None), ("MY BRAND IV", []), ("TWOWORDS", []), ("FOOOZ", []), ("POLLENS", []), ("QQQ", []), ("KEGGY", []), ("KEGX", []),
        ("KEGGZZ", []), ("", ["x"]), (None, ["x"]), ("A BRA", []),
    ]
    names = spark.createDataFrame(rows, "basename string, ingredients array<string>")
    table = lambda rows, s: spark.createDataFrame(rows, s)
    exact = table([("foo", "1"), ("FOO", "0"), ("x", "2"), ("baz", "3"), ("title", "4"), ("pollens", "5"), ("human", "6"), ("foooo", "7"), (None, "8")], "name string, rxcui string")
    titles = lambda *rows: table(rows, "name string, title string")
    kegg = table([("keggy", "D1", "title"), ("kegx", "D2", "title"), ("KEGGZZ", "D3", "Ttitle")], "name string, kegg_id string, title string")
    out = {r.basename: (r.rxcui, r.lookup_hit, r.source) for r in L.cascade(names, exact, titles(("syn", "Title")), titles(("brand", "Title"), ("TWOWORDS", "Human globulin"), ("BRA", "Title")), exact, kegg).collect()}
    none = (None, "not_found", "not_found")
    assert out == {
        "FOO": ("0", "basename", "rxnav_basename"), "BAR": ("2", "ingredients", "rxnav_ingredients"), "SYN": ("4", "Title", "local_cid_fallback"), "NONE": ("4", "Title", "local_cid_fallback"), "BAZ TABLET": ("3", "suffix_strip:BAZ", "suffix_strip"),
        "BRAND": ("4", "Title", "chembl_brand"), "MY BRAND IV": ("4", "Title", "chembl_brand"), "TWOWORDS": ("6", "Human globulin", "chembl_brand"), "FOOOZ": ("7", "approx:foooo", "approx_match"), "POLLENS": (None, "not_found", "skipped_non_drug"),
        "QQQ": none, "KEGGY": ("4", "kegg:D1:title", "kegg_inn"), "KEGX": none, "KEGGZZ": ("4", "kegg:D3:Ttitle", "kegg_inn"), "": ("2", "ingredients", "rxnav_ingredients"), None: none, "A BRA": none,
    }
    assert {r.source for r in L.cascade(names, exact.limit(0), approximate=exact.limit(0)).collect()} == {"not_found", "skipped_non_drug"}


def test_quarantine_loses_no_row(spark):
    df = spark.createDataFrame([("A", "1"), ("A", None), ("DRUG UNKNOWN", "1"), ("DRUG UNKNOWN", None)], "medicinal_product string, rxcui string")
    main, out = L.split_quarantine(df)
    assert main.count() == 1 and {r.quarantine_reason for r in out.collect()} == {"no_rxcui", "suspicious_name", "no_rxcui_and_suspicious"}


def test_nearest_blocks_only_single_words_by_their_first_letter(spark):
    from difflib import SequenceMatcher
    from random import Random

    table = [("brizcarifam", "1"), ("sulconazole", "2"), ("", "3")]
    ask = [("GENERIC BRIZCARIFAM",), ("FULCONAZOLE",), ("x SULCONAZOLE",), ("SULCONASOLE",), ("",)]
    sets = lambda a, b: (spark.createDataFrame(a, "n string"), spark.createDataFrame(b, "name string, rxcui string"))
    names, listed = sets(ask, table)
    assert {r.n: r._hit for r in L.nearest(names, "n", "n", listed).collect()} == {"GENERIC BRIZCARIFAM": "1", "FULCONAZOLE": None, "x SULCONAZOLE": "2", "SULCONASOLE": "2", "": None}
    assert {r._as for r in L.nearest(names, "n", "n", listed).collect()} == {"brizcarifam", "sulconazole", None}

    any_ = Random(5)
    word = lambda: "".join(any_.choices("abcdeéß1", k=any_.randint(1, 6)))
    text = lambda: " ".join(word() for _ in range(any_.randint(1, 3)))
    ask, table = sorted({text() for _ in range(150)}), {t: str(i) for i, t in enumerate(sorted({text() for _ in range(150)}))}
    grams = lambda t: {f"  {t} "[i : i + 3] for i in range(len(t) + 1)}
    best = {}
    for a in ask:
        # names that share a fifth of the trigrams are compared
        near = [(-r, b) for b in table if 5 * len(grams(a) & grams(b)) >= len(grams(a)) and (len(a.split()) > 1 or a[0] == b[0]) and (r := SequenceMatcher(None, a, b).ratio()) >= 0.7]
        best[a] = table[min(near)[1]] if near else None
    names, listed = sets([(a,) for a in ask], list(table.items()))
    assert {r.n: r._hit for r in L.nearest(names, "n", "n", listed).collect()} == best and 10 < sum(h is not None for h in best.values())
