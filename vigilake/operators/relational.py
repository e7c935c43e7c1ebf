"""Relational building blocks: first-of-group with a total order, duplicate audits, lists, tables, top lists, hierarchies.

Every "first" takes an order that decides ties, so results don't depend on partitioning. A first row is a rank of one:
Spark limits each group to it before the shuffle too, so a hot key sends one row per task. First values of single
columns are ``min_by`` aggregates, which combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X
from vigilake.functions.values import count_percent, distinct_list, percent
from vigilake.runtime import cut


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first in ``order``; the other columns decide what is left of ties."""
    rest = [c for c, kind in df.dtypes if c not in keys and not kind.startswith("map")]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each column's first value that isn't null, in ``order``."""
    return df.groupBy(*keys).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(c) for c in columns))


def count_back(df: DataFrame, keys: Sequence[Column], order: Sequence[str], count: str = "source_record_count") -> DataFrame:
    """The first row of each content profile, with the profile's number of rows; null keys are equal to each other."""
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *(k.alias(n) for k, n in zip(keys, names)))
    row = F.struct(*df.columns)
    best = keyed.groupBy(*names).agg(F.min_by(row, F.struct(*order, row)).alias("_row"), F.count(F.lit(1)).alias(count))
    return best.select(*(F.col("_row")[c].alias(c) for c in df.columns), count)


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Running numbers from 1 in ``order``, without one task for all rows: ranges are counted, then offset. The ranges are
    written once, as sampling their bounds anew could move rows."""
    parts = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    local = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    offsets = sizes.withColumn("_o", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_o")
    return local.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_o") + F.col("_n")).drop("_p", "_n", "_o")


def key_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups, groups that repeat, and rows beyond one per group."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("n") > 1).alias("n_repeated"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_extra_rows"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of each column, values that aren't null and their percentage, in one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(c) for c in columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_present"), F.col("n").alias("n_rows")) for c in columns))
    out = counted.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("percent_present", percent(F.col("n_present"), F.col("n_rows")))


def pivot_lists(df: DataFrame, keys: Sequence[str], key: str, value: str, names: Sequence[str]) -> DataFrame:
    """A column of distinct sorted values per key name; null, not an empty list, where a name is absent."""
    cols = []
    for n in names:
        found = F.array_sort(F.collect_set(F.when(F.col(key) == n, F.col(value))))
        cols.append(F.when(F.size(found) > 0, found).alias(n))
    return df.filter(F.col(key).isin(*names)).groupBy(*keys).agg(*cols)


def merged_lists(df: DataFrame, keys: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """Lists of a group joined, distinct and sorted: exploding first lets repeats disappear before the shuffle."""
    long = df.select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in lists))).alias("x")).select(*keys, "x.c", F.explode_outer("x.v").alias("v"))
    return long.groupBy(*keys).agg(*(F.array_sort(F.collect_set(F.when(F.col("c") == c, F.col("v")))).alias(c) for c in lists))


def category_counts(df: DataFrame, column: str, categories: DataFrame, id_column: str, total: Column | None = None) -> DataFrame:
    """Distinct ids per category of a given list, zero where there are none, with their share of all."""
    counts = df.groupBy(column).agg(F.count_distinct(id_column).alias("n"))
    full = categories.join(counts, column, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = total if total is not None else F.sum("n").over(Window.partitionBy(F.lit(1)))
    return full.withColumn("text", count_percent(F.col("n"), share))


def one_or_several(df: DataFrame, id_column: str, value: str) -> DataFrame:
    """Ids with one, and with several, distinct values."""
    per_id = df.groupBy(id_column).agg(F.count_distinct(value).alias("k"))
    return per_id.filter(F.col("k") > 0).groupBy(F.when(F.col("k") == 1, "One").otherwise("Multiple").alias("item")).agg(F.count(F.lit(1)).alias("n"))


def flag_rows(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """A row per flag: rows that have it, of how many, and the percentage; one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(f) == 1).alias(f) for f in flags))
    rows = F.array(*(F.struct(F.lit(f).alias("item"), F.col(f).alias("n"), F.col("total")) for f in flags))
    return counted.select(F.explode(rows).alias("r")).select("r.*").withColumn("percent", percent(F.col("n"), F.col("total"), 1))


def top(df: DataFrame, groups: Sequence[str], item: str, n: int, count: Column | None = None) -> DataFrame:
    """The ``n`` most frequent items of each group; ties: the smaller item. Counts first, so ranks see few rows."""
    counts = df.filter(F.col(item).isNotNull()).groupBy(*groups, item).agg((count if count is not None else F.count(F.lit(1))).alias("n"))
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("n"), item))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_common(a: DataFrame, b: DataFrame, item: str, n: int) -> DataFrame:
    """Items of both counts (item, n), ranked by the smaller of the two."""
    both = a.withColumnRenamed("n", "n_a").join(b.withColumnRenamed("n", "n_b"), item)
    return both.withColumn("n_min", F.least("n_a", "n_b")).orderBy(F.desc("n_min"), item).limit(n)


def forward_fill(df: DataFrame, column: str, groups: Sequence[str], order: Sequence[str]) -> Column:
    return F.last(column, ignorenulls=True).over(Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def blank_repeats(column: str, groups: Sequence[str], order: Sequence[str]) -> Column:
    return F.when(F.row_number().over(Window.partitionBy(*groups, column).orderBy(*order)) == 1, F.col(column)).otherwise("")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """By name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_column_if_absent(df: DataFrame, name: str, default: Column) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, default)


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select([n for n in names if n in df.columns])


def hierarchy(concepts: DataFrame, relations: DataFrame, levels: Sequence[str], excluded: Sequence[str] = X.EXCLUDED_CLASSES) -> DataFrame:
    """Paths from the lowest level up: concepts (concept_id, concept_code, concept_name, concept_class), relations (from_id,
    to_id). Paths that end in one of the excluded names of the highest level are left out.

    Edges are told apart by the classes of their ends only. Each level is one left join; the tables are vocabularies,
    and Spark broadcasts them where their size allows.
    """
    parts = ("id", "code", "name")
    of = lambda lv, p: concepts.filter(F.col("concept_class") == lv).select(*(F.col(f"concept_{x}").alias(f"{p}_{x}") for x in parts))
    out = of(levels[0], levels[0].lower())
    for low, high in zip(levels, levels[1:]):
        lo, hi = low.lower(), high.lower()
        edges = relations.join(of(low, lo).select(f"{lo}_id"), relations.from_id == F.col(f"{lo}_id")).join(of(high, hi), relations.to_id == F.col(f"{hi}_id")).select(f"{lo}_id", *(f"{hi}_{x}" for x in parts)).distinct()
        out = out.join(edges, f"{lo}_id", "left")
    top = F.col(f"{levels[-1].lower()}_name")
    return out.filter(top.isNull() | ~top.isin(*excluded)).select(*(f"{lv.lower()}_{x}" for lv in levels for x in parts))


def hierarchy_lists(paths: DataFrame, levels: Sequence[str]) -> DataFrame:
    """One row per concept of the lowest level, with the sorted distinct ids, codes and names of each level above."""
    parts, low = ("id", "code", "name"), levels[0].lower()
    lists = [distinct_list(F.collect_set(f"{lv.lower()}_{x}")).alias(f"{lv.lower()}_{x}s") for lv in levels[1:] for x in parts]
    return paths.groupBy(*(f"{low}_{x}" for x in parts)).agg(*lists)
