"""Writing results: parquet and compressed text, with row counts taken on the way, resuming and manifests."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished output is there: Spark's commit leaves ``_SUCCESS`` last."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def landed(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write(df: DataFrame, path: str, kind: str = "parquet", partition_by: tuple[str, ...] = (), resume: bool = False) -> int | None:
    """Writes and returns the number of rows, observed while writing; None if ``resume`` finds it done. The output appears
    only when it is whole."""
    if resume and exists(df.sparkSession, path):
        return None
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "csv":
        writer.options(header=True, compression="gzip", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    else:
        writer.option("compression", "zstd").parquet(path)
    return seen.get["rows"]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file by the cluster's file system, put in place by renaming."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part = fs_path(path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    # Puts the new file in place of the old in one step.
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(fs_path(path)), options)


def manifest(spark: SparkSession, path: str, stage: str, outputs: dict[str, int | None], **more: object) -> dict:
    content = {"stage": stage, "written": datetime.now(UTC).strftime("%Y%m%dT%H%M%S"), "outputs": outputs, **more}
    write_text(spark, path, json.dumps(content, indent=2, default=str))
    return content


def quality_summary(title: str, before: int, after: int, metrics: dict[str, object]) -> str:
    """Markdown of rows before and after a stage, their difference and percentage, and other metrics."""
    kept = 100 * after / before if before else 0.0
    rows = [("rows before", before), ("rows after", after), ("difference", after - before), ("percent", f"{kept:.2f}"), *metrics.items()]
    return f"# {title}\n\n| metric | value |\n| --- | --- |\n" + "".join(f"| {k} | {v} |\n" for k, v in rows)


def quality_report(df: DataFrame, table: str, keys: Sequence[str], columns: Sequence[str]) -> dict:
    """Rows, distinct keys, repeats and coverage of a table, and whether its keys are unique."""
    from vigilake.operators.relational import coverage, key_audit

    audit = key_audit(df, keys).first()
    present = {r.column_name: r.percent_present for r in coverage(df, columns).collect()}  # a row for each column
    rows = audit.n_groups + audit.n_extra_rows
    return {"table": table, "total_rows": rows, "unique_keys": audit.n_groups, "duplicate_rows": audit.n_extra_rows, "coverage": present, "pass": audit.n_extra_rows == 0}


def dataset_readme(title: str, columns: dict[str, str], rows: dict[str, int], run: str) -> str:
    """Markdown about a data set: its key columns and its rows by part."""
    about = "".join(f"- `{c}`: {text}\n" for c, text in columns.items())
    counts = "".join(f"- {name.capitalize()} rows: {n:,}\n" for name, n in rows.items())
    return f"# {title}\n\n## Key columns\n{about}\n## Summary\n{counts}- Generated by run `{run}`\n"


def summary(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows, columns and, null counting as a value, distinct values of the keys; one scan."""
    from vigilake.functions.values import n_unique

    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), *(n_unique(F.col(k)).alias(f"n_unique_{k}") for k in keys if k in df.columns))


def merge_batches(spark: SparkSession, paths: list[str], order: str) -> DataFrame:
    """Batches written apart, read as one, in the order of a numeric column."""
    return spark.read.parquet(*paths).orderBy(order)
