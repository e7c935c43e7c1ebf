from collections import Counter
from itertools import combinations

import pytest
from oracle import compare
from pyspark.sql import functions as F

from vigilake.llm import pairs as P
from vigilake.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_as_sql(spark, small, name):
    compare(spark, small, Q.QUERIES, Q.SQL, name)


def brute(rows):
    sets = {}
    for b, x, y in rows:
        if b is not None:
            sets.setdefault(b, set()).update(v for v in (x, y) if v is not None)
    singles, pairs = Counter(), Counter()
    for s in sets.values():
        singles.update(s)
        pairs.update(combinations(sorted(s), 2))
    return len(sets), singles, pairs


def test_against_counting_with_nulls_repeats_and_a_hot_basket(spark):
    rows = [("hot", f"D{i % 30}", f"R{i % 40}") for i in range(3000)]
    rows += [(str(i), f"D{i % 3}", f"R{i % 2}") for i in range(60)] * 2
    rows += [("e", None, None), (None, "D1", "R1"), ("f", "D1", None), ("g", "same", "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "b string, x string, y string, items int").repartition(5)
    n, singles, pairs = brute(rows)
    collapsed = P.baskets(df, F.col("b"), F.col("x"), F.col("y"))
    out = {(r.item_a, r.item_b): r for r in P.pairs(collapsed).collect()}
    assert {k: r.n_ab for k, r in out.items()} == dict(pairs)
    assert all((r.n_a, r.n_b, r.n) == (singles[a], singles[b], n) for (a, b), r in out.items())
    kept = {(r.item_a, r.item_b) for r in P.pairs(collapsed, 5, (3, 1000), 3).collect()}
    assert kept == {k for k, c in pairs.items() if c >= 5 and 1000 * c >= 3 * n and c * n >= 3 * singles[k[0]] * singles[k[1]]}
    r = out["D0", "R0"]
    assert r.lift == pytest.approx(r.n_ab * n / (r.n_a * r.n_b))


def test_large_baskets_are_split(spark):
    rows = [(b, f"i{i:05d}") for b, n in (("x", 700), ("y", 700), ("z", 301), ("w", 5)) for i in range(n)]
    collapsed = P.baskets(spark.createDataFrame(rows, "b string, i string"), F.col("b"), F.col("i"))
    _, _, pairs = brute([(b, i, None) for b, i in rows])
    for small, span in ((256, 128), (4, 7), (10_000, 128)):
        assert {(r.item_a, r.item_b): r.n_ab for r in P.pair_counts(collapsed, small, span).collect()} == dict(pairs)
    huge = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.format_string("i%05d", i)).alias("items"), F.lit(1).alias("weight"))
    split = P.range_pairs(huge).select(F.size("a").alias("n"), F.size("b").alias("m"), F.spark_partition_id().alias("p")).collect()
    assert len(split) == 157 * 158 // 2 and max(r.n * r.m for r in split) <= 128 * 128
    by_task = Counter(r.p for r in split)
    assert len(by_task) > 2 and max(by_task.values()) < 0.6 * len(split)


def test_empty(spark):
    df = spark.createDataFrame([], "b string, x string")
    assert P.pairs(P.baskets(df, F.col("b"), F.col("x"))).count() == 0
