"""References to records that are missing, deleted or arrive later.

Parents are reduced to one validity interval per key: from their first load to a deletion after their last load, if there
is one; a key that is deleted and loaded again stays valid. References are reduced before any shuffle to one row per
(table, period, key), with their earliest and latest load: a key held by a third of all rows shrinks to one row per period
and map task. Both sides are then partitioned by key, sorted and merged in one linear pass (a sort-merge join; adaptive
execution splits a skewed partition).

Kinds: ``late`` if the parent's first load is after the reference's, ``deleted`` if there is no parent but a deletion, or
the reference is loaded at or after the end of the parent's interval, else ``missing``. Where deletions only tell of
parents that were never loaded, intervals are left open (``ends=False``).

Defined results: null and blank keys are no references; a reference without load time has a null period and can be neither
late nor after an end; a parent without any load time is valid always; a deletion without time ends nothing; repeated rows
give one reference, ``late`` before ``deleted``; empty tables are allowed on either side. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def references(df: DataFrame, table: str, key: Column, at: Column, *also: Column) -> DataFrame:
    """(child_table, period, key, also..., first_ref, last_ref): one row per distinct reference."""
    named = [F.lit(table).alias("child_table"), F.date_format(at, "yyyy-MM").alias("period"), key.alias("key"), *also]
    rows = df.select(*named, at.alias("at")).filter(F.col("key").isNotNull() & (F.col("key") != ""))
    return rows.groupBy(*rows.columns[:-1]).agg(F.min("at").alias("first_ref"), F.max("at").alias("last_ref"))


def intervals(parents: DataFrame, key: Column, at: Column | None, deletions: DataFrame, deleted_key: Column, deleted_at: Column | None = None) -> DataFrame:
    """(key, loaded, valid_from, valid_to): one row per key that was ever loaded or deleted."""
    time = lambda c: (c if c is not None else F.lit(None)).cast("timestamp_ntz")
    loads = parents.select(key.alias("key"), time(at).alias("load"), time(None).alias("gone"), F.lit(True).alias("loaded"))
    gone = deletions.select(deleted_key.alias("key"), time(None).alias("load"), time(deleted_at).alias("gone"), F.lit(False).alias("loaded"))
    both = loads.unionByName(gone).filter(F.col("key").isNotNull() & (F.col("key") != ""))
    ends = both.groupBy("key").agg(F.max("loaded").alias("loaded"), F.min("load").alias("valid_from"), F.max("load").alias("last_load"), F.max("gone").alias("gone"))
    return ends.select("key", "loaded", "valid_from", F.when(F.col("loaded") & (F.col("gone") >= F.col("last_load")), F.col("gone")).alias("valid_to"))


def orphans(refs: DataFrame, parents: DataFrame, ends: bool = True) -> DataFrame:
    """The references without a valid parent at their time, with their kind."""
    merged = refs.join(parents.hint("merge"), "key", "left")
    ended = F.col("last_ref").cast("timestamp_ntz") >= F.col("valid_to") if ends else F.lit(False)
    kind = (
        F.when(F.col("loaded") & (F.col("valid_from") > F.col("first_ref").cast("timestamp_ntz")), "late")
        .when(F.col("loaded") & ended, "deleted")
        .when(F.col("loaded"), None)
        .when(F.col("loaded").isNotNull(), "deleted")
        .otherwise("missing")
    )
    return merged.withColumn("kind", kind).filter(F.col("kind").isNotNull()).drop("loaded", "valid_from", "valid_to")


def by_period(found: DataFrame) -> DataFrame:
    """The report: distinct orphan references per table, period and kind."""
    return found.groupBy("child_table", "period", "kind").agg(F.count(F.lit(1)).alias("n_references"), F.count_distinct("key").alias("n_keys"))
