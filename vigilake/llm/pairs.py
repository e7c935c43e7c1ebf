"""Items that appear together: pair counts and how far they exceed chance, by basket collapsing.

Each basket becomes its sorted set of distinct items; the sets are built by partial aggregation, so a basket that owns a
third of all rows is only ever a set. Identical sets collapse into one with a weight. Item counts and, once per distinct
basket, pairs are then enumerated with that weight and summed, combining before the shuffle. A support asked for prunes
items first: a pair can't be more frequent than its items, so nothing is lost, and after pruning the baskets collapse
again. A basket of up to ``SMALL`` items gives its pairs in place, item by item. A larger one is split into ranges of its
sorted items; every two ranges, and each with itself, are a row of their own, spread over all tasks before pairs are formed,
so no task holds more than the pairs of two ranges at a time.

Scores, with N the number of baskets: lift n(a,b) N / (n(a) n(b)); conviction of a => b (1 - n(b)/N) / (1 - n(a,b)/n(a)),
null where every basket with a holds b.

Defined results: null items are no items, a null basket id is no basket, a basket without items counts in N; repeated
rows count once; a pair is given once, the smaller item (as text) first; empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.runtime import cut

SMALL, SPAN = 256, 128  # items of a basket whose pairs are formed in place; items of a range of larger ones


def baskets(df: DataFrame, basket: Column, *items: Column) -> DataFrame:
    """(items, weight): the distinct baskets and how many ids have them. Written once, as three later steps read it."""
    rows = df.select(basket.alias("basket"), *(c.alias(f"i{k}") for k, c in enumerate(items))).filter(F.col("basket").isNotNull())
    sets = rows.groupBy("basket").agg(*(F.collect_set(f"i{k}").alias(f"s{k}") for k in range(len(items))))
    # columns may share items
    whole = F.array_sort(F.array_distinct(F.concat(*(F.col(f"s{k}") for k in range(len(items))))))
    return cut(sets.groupBy(whole.alias("items")).agg(F.count(F.lit(1)).alias("weight")))


def item_counts(collapsed: DataFrame) -> DataFrame:
    return collapsed.select(F.explode("items").alias("item"), "weight").groupBy("item").agg(F.sum("weight").alias("n"))


def pruned(collapsed: DataFrame, frequent: DataFrame) -> DataFrame:
    """The baskets with frequent items only, collapsed again."""
    rows = collapsed.withColumn("b", F.monotonically_increasing_id()).select("b", "weight", F.explode("items").alias("item"))
    kept = rows.join(frequent.select("item"), "item").groupBy("b").agg(F.array_sort(F.collect_list("item")).alias("items"), F.first("weight").alias("weight"))
    return kept.filter(F.size("items") > 1).groupBy("items").agg(F.sum("weight").alias("weight"))


def range_pairs(collapsed: DataFrame, span: int = SPAN) -> DataFrame:
    """(weight, a, b): every two ranges of a basket's items, the second at or after the first, spread over all tasks."""
    ranges = F.transform(F.sequence(F.lit(0), F.floor((F.size("items") - 1) / span).cast("int")), lambda i: F.slice("items", i * span + 1, span))
    one = collapsed.select("weight", ranges.alias("ranges")).select("weight", "ranges", F.posexplode("ranges").alias("at", "a"))
    two = one.select("weight", "a", F.explode(F.slice(F.col("ranges"), F.col("at") + 1, F.size("ranges") - F.col("at"))).alias("b"))
    return two.repartition(F.xxhash64(F.get("a", F.lit(0)), F.get("b", F.lit(0))))


def pair_counts(collapsed: DataFrame, small: int = SMALL, span: int = SPAN) -> DataFrame:
    """(item_a, item_b, n_ab), item_a < item_b."""
    few = collapsed.filter(F.size("items") <= small)
    first = few.select("items", "weight", F.posexplode("items").alias("at", "item_a"))
    rest = F.slice(F.col("items"), F.col("at") + 2, F.greatest(F.size("items") - F.col("at") - 1, F.lit(0)))
    within = first.select("item_a", "weight", F.explode(rest).alias("item_b"))
    many = range_pairs(collapsed.filter(F.size("items") > small), span)
    across = many.select("weight", "b", F.explode("a").alias("item_a")).select("item_a", "weight", F.explode("b").alias("item_b")).filter(F.col("item_a") < F.col("item_b"))
    return within.unionByName(across).groupBy("item_a", "item_b").agg(F.sum("weight").alias("n_ab"))


def pairs(collapsed: DataFrame, min_count: int = 1, min_share: tuple[int, int] = (0, 1), min_lift: int = 0) -> DataFrame:
    """(item_a, item_b, n_ab, n_a, n_b, n, lift, conviction) of pairs in at least ``min_count`` baskets, at least the
    share ``min_share`` (a fraction of whole numbers) of all, and at least ``min_lift`` times as often as by chance."""
    n = collapsed.agg(F.sum("weight").alias("n")).scalar()
    counts = item_counts(collapsed)
    over, under = min_share
    enough = lambda c: (F.col(c) >= min_count) & (F.col(c) * under >= n * over)
    source = collapsed
    if min_count > 1 or over:
        counts = counts.filter(enough("n"))
        source = pruned(collapsed, counts)
    found = pair_counts(source).filter(enough("n_ab"))
    a, b = (counts.select(F.col("item").alias(f"item_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    scored = found.join(a, "item_a").join(b, "item_b").withColumn("n", n)
    wide = lambda x, y: F.col(x).cast("decimal(19,0)") * F.col(y).cast("decimal(19,0)")
    scored = scored.filter(wide("n_ab", "n") >= wide("n_a", "n_b") * min_lift)
    lift = F.col("n_ab") / F.col("n_a") * (F.col("n") / F.col("n_b"))
    conviction = F.when(F.col("n_ab") < F.col("n_a"), (1 - F.col("n_b") / F.col("n")) / (1 - F.col("n_ab") / F.col("n_a")))
    return scored.select("item_a", "item_b", "n_ab", "n_a", "n_b", "n", lift.alias("lift"), conviction.alias("conviction"))
