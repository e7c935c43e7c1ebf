"""Per-key results where a few keys hold most rows, by value-frequency compression.

Rows are first counted by (key, value): both the map-side partial counts and the first shuffle spread a hot key over
as many groups as it has values, so no task gets the key as a whole. What is left is one weighted row per distinct
(key, value). Each later statistic is derived from those weights: rows are their sum, exact distinct counts are their
number, the mode is the heaviest value (ties: the smallest), a percentile is read off the cumulated weights. The second
aggregation, by key, again combines partially before its shuffle and sends one row per key and task.

Defined results: a null key gives no row but counts in the total; a null value counts as a row of its key but not as a
distinct value, mode or percentile; empty input gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compress(df: DataFrame, keys: dict[str, Column], value: Column) -> DataFrame:
    """(key_field, key_value, value, weight): rows of ``df`` by key and value, null keys included, for each key field."""
    fields = F.array(*(F.struct(F.lit(name).alias("f"), c.cast("string").alias("k")) for name, c in keys.items()))
    rows = df.select(F.explode(fields).alias("x"), value.alias("value"))
    return rows.groupBy(F.col("x.f").alias("key_field"), F.col("x.k").alias("key_value"), "value").agg(F.count(F.lit(1)).alias("weight"))


def profile(weighted: DataFrame, bounded_percentiles: tuple[float, ...] = ()) -> DataFrame:
    """One row per key: rows, distinct values, mode with its weight, and the share of all rows of the key's field.

    ``bounded_percentiles`` asks for exact percentiles of a numeric value. They need the distinct values of a key in
    one place and are meant for values of a bounded domain (ages, counts), not for ids.
    """
    present = F.col("value").isNotNull()
    aggs = [F.sum("weight").alias("n_rows"), F.count("value").alias("n_values"), F.max(F.when(present, F.col("weight"))).alias("mode_weight")]
    for p in bounded_percentiles:
        aggs.append(F.percentile(F.col("value").cast("double"), p, F.col("weight")).alias(f"p{round(100 * p)}"))
    # The mode in two steps: the heaviest weight, as negated number, then the smallest value that has it.
    mode = F.min(F.when(present, F.struct(-F.col("weight"), "value")))["value"].alias("mode_value")
    out = weighted.groupBy("key_field", "key_value").agg(*aggs, mode)
    return out.select("key_field", "key_value", "n_rows", "n_values", "mode_weight", "mode_value", *out.columns[5:-1])


def key_counts(df: DataFrame, keys: dict[str, Column], value: Column) -> DataFrame:
    """(key_field, key_value, n_rows, n_reports, share) for every key, heavy or light; null keys count in the share only."""
    by_key = compress(df, keys, value).groupBy("key_field", "key_value").agg(F.sum("weight").alias("n_rows"), F.count("value").alias("n_reports"))
    total = df.agg(F.count(F.lit(1))).scalar()  # from the file footers
    return by_key.filter(F.col("key_value").isNotNull()).withColumn("share", F.col("n_rows") / total)


def heavy(counts: DataFrame, share: float) -> DataFrame:
    return counts.filter(F.col("share") >= share).select("key_field", "key_value")
