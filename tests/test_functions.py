from pyspark.sql import functions as F

from vigilake.functions import names as N
from vigilake.functions import values as V
from vigilake.functions.text import null_tokens, plain_number_id, squeeze_upper, strip


def each(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("c")).alias("o")).collect()]


def test_text(spark):
    assert each(spark, strip, ["\t a b　", "\xa0", None]) == ["a b", "", None]
    assert each(spark, null_tokens, [" NULL ", "Null", "", "x "]) == [None, "Null", None, "x"]
    assert each(spark, squeeze_upper, [" a\t\n b "]) == ["A B"]
    ids = ["\t00105.0", " 7 ", "5.", "10.50", "12-3", "", " ", None, "1e2", "-0", "+4", ".5", "x"]
    assert each(spark, plain_number_id, ids) == ["105", "7", "5", "10.5", "12-3", None, None, None, "100", "0", "4", "0.5", "x"]


def test_names(spark):
    assert each(spark, N.title_case, ["drug-induced liver", "ÉCOLE d'azur", ""]) == ["Drug-Induced Liver", "École D'Azur", ""]
    assert each(spark, N.clean_name, [" ＡＢ^C ", "FILM?COATED", "X.ALPHA.TOCO", "CLONAZEPAM.", "1.4 MG", None, "..."]) == ["AB C", "FILM-COATED", "Xalpha-TOCO", "CLONAZEPAM", "1.4 MG", "", "."]
    assert each(spark, N.base_name, ["ASPIRIN 10 MG TABLET", "TAB (IBUPROFEN)", "HCL", "Paracetamol Pfizer oral"]) == ["ASPIRIN", "IBUPROFEN", "HCL", "PARACETAMOL"]
    assert each(spark, N.strip_to_name, ["Drug-X (Y) 10 mg tab, 5/10."]) == ["DRUG-X"]
    assert each(spark, N.clean_ingredient, [".ALPHA. TOCO-PHEROL 3 2H B12"]) == ["ALPHA TOCO PHEROL"]
    assert each(spark, N.substances, ["A\\B; none | C"]) == [["A", "B", "C"]]
    assert each(spark, N.bracket_ingredients, ["X (UNKNOWN) (A + B; 10 MG)"]) == [["A", "B"]]
    assert each(spark, N.without_noise, ["a TABLET a b HCL"]) == ["A B"]
    assert each(spark, N.any_pattern, ["drug unknown", "ok", None, "an unknown thing"]) == [True, False, False, True]
    assert each(spark, N.text_or_null, [" None ", "x"]) == [None, "x"]
    i, s = N.ingredients_and_salts(F.col("c"))
    df = spark.createDataFrame([(["Foo", "hcl", "water", None],), (None,)], "c array<string>")
    assert [tuple(r) for r in df.select(i, s).collect()] == [(["FOO"], ["HCL"]), (None, None)]
    two = spark.createDataFrame([("FLUCANOZOLE", "FLUCONAZOLE")], "a string, b string")
    assert round(two.select(N.similar(F.col("a"), F.col("b"))).first()[0], 3) == 0.818


def test_values(spark):
    assert [str(x) for x in each(spark, V.any_date, ["20200131", "2020-02-30", "2020-01-02", "x", "20201301", None])] == ["2020-01-31", "None", "2020-01-02", "None", "None", "None"]
    assert each(spark, V.age_band, [0.5, 1.0, 21.0, 21.5, None], "double") == ["infancy", "toddler", "late_adolescence", None, None]
    assert each(spark, V.cohort, [0.0, 21.0, 21.5, 121.0, -1.0], "double") == ["pediatric", "pediatric", "adult", None, None]
    assert each(spark, V.flag, ["1", "1.0", "2", None, "x"]) == [1, 1, 0, 0, 0]
    assert each(spark, V.serious, ["1", "2", "It resulted in death", "The event did not result in any of the above", None]) == [1, 0, 1, 0, 0]
    assert each(spark, V.yes, [" Y ", "no", None]) == [1, 0, 0]
    assert each(spark, lambda c: V.decode(c, {"001": "a"}, 3), ["1", "1.0", "-1", "x", "2"]) == ["a", "a", None, None, None]
    assert each(spark, lambda c: V.count_percent(c, F.lit(2000)), [1234, 0], "bigint") == ["1,234 (61.7%)", "0 (0.0%)"]
    assert each(spark, lambda c: V.parse_count_percent(c)[0], ["1,234 (61.7%)", "x"]) == [1234, None]
    assert each(spark, V.joined_substances, ['{"activesubstancename": "A"}', '[{"activesubstancename": "A"}, {"activesubstancename": "B"}]', " C ", "[]"]) == ["A", "A|B", "C", None]
    assert each(spark, V.substance_in_text, ["{'activesubstancename': 'A  B'}", "x"]) == ["A B", None]
    assert each(spark, V.distinct_list, [["b", None, "a", "b"], [], None], "array<string>") == [["a", "b"], None, None]
    assert each(spark, V.worst_status, [["exact"], ["exact", "not_found"], ["approx", "exact"], []], "array<string>") == ["exact", "partial", "approx", None]
    assert each(spark, V.url_quoted, ["a b/c"]) == ["a%20b%2Fc"]


def test_base_names_of_all_products(spark, tmp_path):
    from vigilake.plans.reference import QUERIES

    names = {"TAB (IBUPROFEN)": "IBUPROFEN", "ASPIRIN, 10 MG (FOO)": "ASPIRIN", "TAB (HCL) (FOO)": "FOO", "CAFÉINE?ZINC": "CAF INE ZINC", "ＡＢＣ": "", "FOO\tBAR": "FOO BAR", "(TAB)": "TAB", "PLAIN": "PLAIN", "": ""}
    spark.createDataFrame([(n,) for n in (*names, "PLAIN", None)], "medicinal_product string").write.parquet(f"{tmp_path}/drugcharacteristics_extended.parquet")
    out = [tuple(r) for r in QUERIES["r18_base_name"](spark, str(tmp_path)).collect()]
    assert len(out) == len(names) and dict(out) == names


def test_no_row_is_left_out_for_its_signs(spark, tmp_path):
    from vigilake.plans.reference import QUERIES

    spark.createDataFrame([("a b", "A\\B;none"), ("a&b/é~*", None)], "medicinal_product string, active_substance_name string").write.parquet(f"{tmp_path}/drugcharacteristics_extended.parquet")
    assert {r[0]: r.parts for r in QUERIES["r61_substance_parts"](spark, str(tmp_path)).collect()} == {"a b": ["A", "B"], "a&b/é~*": None}
    assert {r[0]: r.quoted for r in QUERIES["r57_url_quote"](spark, str(tmp_path)).collect()} == {"a b": "a%20b", "a&b/é~*": "a%26b%2F%C3%A9~%2A"}


def test_ratio_and_its_bound(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(4)
    text = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(0, 9)))
    pairs = [(text(), text()) for _ in range(300)] + [(None, "a"), ("a", None)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", N.similar(F.col("a"), F.col("b")).alias("r"), N.similar(F.col("a"), F.col("b"), 0.7).alias("q")).collect():
        exact = None if r.a is None or r.b is None else SequenceMatcher(None, r.a, r.b).ratio()
        assert r.r == exact and (r.q == exact if exact is not None and exact >= 0.7 else r.q is None or r.q == exact)
