import datetime

from vigilake.operators import wide as W


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, safetyreportid string, entry bigint, e string, x int")


def row(key, value, i="1", n=0):
    return (key, value, i, n, "clash", 7)


def test_cells_are_typed_and_repeats_resolved(spark):
    rows = [
        row("rxcui", " 12 "), row("OpenFDA.RXCUI", "12.0"), row("Rxcui", "12O45"), row("rxcui", "7"), row("rxcui", "99999999999999999999"),
        row("brand name", "B"), row("BrandName", "A"), row("brand_name", "NaN"), row("brand_name", None), row("brand", "nope"),
        row("effective-time", "26 Jan 2015"), row("effective_time", "2015/01/26"), row("effective_time", "20150230"), row("effective_time", "2015-02-03"),
        row("is original packager", "N"), row("is_original_packager", "yes", "2"), row("is_original_packager", "0", "2"),
        row("strength_mg", "0,25"), row("strength_mg", "2.500000e-01"), row("strength_mg", "+5"), row("strength_mg", "12.5.1"), row("strength_mg", "1e999"),
    ]
    out = {r.safetyreportid: r for r in W.widen(frame(spark, rows)).collect()}
    assert out["1"].rxcui == [7, 12]
    assert out["1"].brand_name == ["A", "B"]
    assert out["1"].effective_time == [datetime.date(2015, 1, 26), datetime.date(2015, 2, 3)]
    assert out["1"].is_original_packager is False and out["2"].is_original_packager is True
    assert out["1"].strength_mg == [0.25, 5.0]
    assert out["1"].route is None
    assert set(out) == {"1", "2"}


def test_null_entry_null_id_and_unreadable_entities(spark):
    rows = [row("route", "ORAL", "1", None), row("route", "NASAL", "1", 0), row("route", "X", None, 3), row("rxcui", "bad", "9", 1), row(None, "v"), ("", "v", "1", 0, "", 0)]
    out = {(r.safetyreportid, r.entry): r.route for r in W.widen(frame(spark, rows)).collect()}
    assert out == {("1", 0): ["NASAL", "ORAL"], (None, 3): ["X"]}


def test_empty_table_and_long_values(spark):
    assert W.widen(frame(spark, [])).count() == 0
    assert len(W.widen(frame(spark, [])).columns) == 22
    long = "x" * 300_000
    assert W.widen(frame(spark, [row("route", long)])).first().route == [long]


def test_one_entity_with_most_rows(spark):
    rows = [row("route", str(i % 50), "hot") for i in range(20_000)] + [row("route", "A", str(i)) for i in range(100)]
    out = {r.safetyreportid: r.route for r in W.widen(frame(spark, rows).repartition(8)).collect()}
    assert out["hot"] == sorted(map(str, range(50))) and len(out) == 101


def test_filled(spark):
    out = {tuple(r) for r in W.filled(W.widen(frame(spark, [row("route", "A"), row("rxcui", "1")]))).collect()}
    assert out == {("1", 0, "route"), ("1", 0, "rxcui")}
