import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from vigilake.operators import orphans as O
from vigilake.operators import skew as K


def test_key_counts_with_hot_key_nulls_and_repeats(spark):
    rows = [("hot", i % 300) for i in range(5000)] + [("a", 1), ("a", 1), ("a", None), (None, 5)]
    df = spark.createDataFrame([(k, None if v is None else str(v), 0) for k, v in rows], "k string, v string, weight int").repartition(6)
    out = {r.key_value: r for r in K.key_counts(df, {"k": F.col("k")}, F.col("v")).collect()}
    assert (out["hot"].n_rows, out["hot"].n_reports) == (5000, 300)
    assert (out["a"].n_rows, out["a"].n_reports, out["a"].share) == (3, 1, 3 / 5004)
    assert None not in out
    assert {r.key_value for r in K.heavy(K.key_counts(df, {"k": F.col("k")}, F.col("v")), 0.02).collect()} == {"hot"}


def test_profile_against_counting(spark):
    values = [3, 3, 1, 1, 7, None, 9]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v int")
    r = K.profile(K.compress(df, {"k": F.col("k")}, F.col("v")), (0.5,)).first()
    assert (r.n_rows, r.n_values, r.mode_value, r.mode_weight, r.p50) == (7, 4, 1, 2, 3.0)
    text = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None)], "k string, v string")
    assert K.profile(K.compress(text, {"k": F.col("k")}, F.col("v"))).first().mode_value == "x"
    tied = spark.createDataFrame([("a", v) for v in ("ab", "a", "b", "ä", "")] + [("b", "ab"), ("b", "a"), ("b", "ab"), ("c", None)], "k string, v string")
    out = {r.key_value: (r.mode_value, r.mode_weight) for r in K.profile(K.compress(tied, {"k": F.col("k")}, F.col("v"))).collect()}
    assert out == {"a": ("", 1), "b": ("ab", 2), "c": (None, None)}
    assert K.key_counts(df.limit(0), {"k": F.col("k")}, F.col("v")).count() == 0
    assert Counter(values)[3] == 2


def at(day):
    return dt.datetime(2020, 1, day)


def test_kinds_of_orphans(spark):
    refs = spark.createDataFrame([("1", at(5)), ("1", at(20)), ("2", at(5)), ("3", at(5)), ("4", at(5)), ("4", at(5)), ("", at(5)), (None, at(5)), ("5", at(5)), ("6", None)], "id string, t timestamp_ntz")
    parents = spark.createDataFrame([("1", at(10)), ("1", at(12)), ("2", at(1)), ("5", at(9))], "id string, t timestamp_ntz")
    gone = spark.createDataFrame([("3",), ("5",), ("2",)], "id string")
    iv = O.intervals(parents, F.col("id"), F.col("t"), gone, F.col("id"))
    out = {(r.key, r.period): r.kind for r in O.orphans(O.references(refs, "t", F.col("id"), F.col("t")), iv).collect()}
    assert out == {("1", "2020-01"): "late", ("3", "2020-01"): "deleted", ("4", "2020-01"): "missing", ("5", "2020-01"): "late", ("6", None): "missing"}
    products = O.intervals(parents, F.col("id"), None, gone, F.col("id"))
    assert {r.key: r.kind for r in O.orphans(O.references(refs, "t", F.col("id"), F.col("t")), products).collect()} == {"3": "deleted", "4": "missing", "6": "missing"}


def test_intervals_end_by_deletions_after_the_last_load(spark):
    refs = spark.createDataFrame([("1", at(5)), ("2", at(5)), ("2", at(20)), ("3", at(20)), ("4", at(20)), ("5", at(20)), ("6", None), ("7", at(1))], "id string, t timestamp_ntz")
    parents = spark.createDataFrame([("1", at(1)), ("2", at(1)), ("3", at(1)), ("3", at(12)), ("4", at(1)), ("6", at(1)), ("7", at(3))], "id string, t timestamp_ntz")
    gone = spark.createDataFrame([("1", at(10)), ("2", at(10)), ("3", at(10)), ("4", None), ("5", at(30)), ("6", at(10)), ("7", at(4))], "id string, t timestamp_ntz")
    iv = O.intervals(parents, F.col("id"), F.col("t"), gone, F.col("id"), F.col("t"))
    kinds = lambda **more: {r.key: r.kind for r in O.orphans(O.references(refs, "t", F.col("id"), F.col("t")), iv, **more).collect()}
    # withdrawn after the reference; before it; before, but loaded again; at an unknown time; never loaded; late
    assert kinds() == {"2": "deleted", "5": "deleted", "7": "late"}
    assert kinds(ends=False) == {"5": "deleted", "7": "late"}


def test_orphans_of_empty_tables(spark):
    none = spark.createDataFrame([], "id string, t timestamp_ntz")
    some = spark.createDataFrame([("1", at(1))], "id string, t timestamp_ntz")
    iv = O.intervals(none, F.col("id"), F.col("t"), none, F.col("id"))
    assert [r.kind for r in O.orphans(O.references(some, "t", F.col("id"), F.col("t")), iv).collect()] == ["missing"]
    assert O.orphans(O.references(none, "t", F.col("id"), F.col("t")), iv).count() == 0
