"""Reading landed files: delimited text with differing headers, damaged gzip files, vocabularies, parquet, JSON."""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
import re
import shutil
import tempfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.functions.text import NULL_TOKENS

SUFFIXES = ("*.csv", "*.csv.gz", "*.csv.gzip")


def list_files(spark: SparkSession, folder: str, patterns: Sequence[str] = SUFFIXES) -> list[str]:
    """The folder's files of any of the patterns, sorted, by the cluster's own file systems; an error if there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found: set[str] = set()
    for p in patterns:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{p}")
        for status in path.getFileSystem(conf).globStatus(path) or []:
            found.add(status.getPath().toString())
    if not found:
        raise FileNotFoundError(f"{folder}: no file of {', '.join(patterns)}")
    return sorted(found)


def _stream(name: str):  # noqa: ANN202
    """A file's bytes as a stream, unpacked on the way, by the executors' own file systems."""
    import pyarrow.fs as pafs

    if name.startswith("file:/") and not name.startswith("file://"):
        name = "file://" + name[5:]
    fs, path = pafs.FileSystem.from_uri(name) if "://" in name else (pafs.LocalFileSystem(), name)
    raw = fs.open_input_stream(path, compression=None)
    return gzip.GzipFile(fileobj=raw) if name.endswith((".gz", ".gzip")) else raw


def _over_files(spark: SparkSession, files: Sequence[str], work, schema: str) -> DataFrame:  # noqa: ANN001
    """``work`` over each file's name, which gives batches; the files are spread over all tasks."""

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from work(name)

    tasks = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.sparkContext.parallelize([(f,) for f in files], tasks)  # file names, one task for a few of them
    return spark.createDataFrame(rows, "file string").mapInArrow(run, schema)


def headers(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Each file's first line: an executor opens the file, reads one line and closes it."""

    def first(name: str):  # noqa: ANN202
        import pyarrow as pa

        with _stream(name) as f:
            line = io.TextIOWrapper(f, "utf-8", "replace").readline()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([line.rstrip("\r\n")])], names=["f", "h"])

    return {r.f: r.h for r in _over_files(spark, files, first, "f string, h string").collect()}


def read_delimited(spark: SparkSession, folder: str, columns: Sequence[str], types: dict[str, str] | None = None, null_tokens: Sequence[str] = NULL_TOKENS, skip: Sequence[str] = ()) -> DataFrame:
    """The wanted columns of all files of a folder, by name.

    Files are grouped by their header and each group is read by its own, as one read over differing headers would assign
    columns by place. Missing columns are null, null tokens become null, and casts are lenient.
    """
    files = [f for f in list_files(spark, folder) if f not in set(skip)]
    groups: dict[str, list[str]] = {}
    for f, h in headers(spark, files).items():
        groups.setdefault(h, []).append(f)
    parts = []
    for header, own in sorted(groups.items()):
        names = [n.strip().strip('"').lstrip("﻿") for n in header.split(",")]
        schema = T.StructType([T.StructField(f"{i}_{n}", T.StringType()) for i, n in enumerate(names)])
        raw = spark.read.csv(sorted(own), schema=schema, header=True, mode="PERMISSIVE", enforceSchema=True, multiLine=False, escape='"')
        at = {n: f"{i}_{n}" for i, n in reversed(list(enumerate(names)))}
        parts.append(raw.select(*((F.col(f"`{at[c]}`") if c in at else F.lit(None).cast("string")).alias(c) for c in columns)))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    cleaned = [F.when(~F.col(f"`{c}`").isin(*null_tokens), F.col(f"`{c}`")).try_cast((types or {}).get(c, "string")).alias(c) for c in columns]
    return out.select(*cleaned)


def diagnose(spark: SparkSession, folder: str, needed: Sequence[str], keep: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """(file, reason): why a file would be skipped: damaged or cut gzip, empty, missing columns, nothing left after the
    filter ``keep`` (column, values), unreadable; null: it is sound. Executors stream each file; a packed one is read to
    its end, as damage may stand there, a plain one as far as its first row that counts."""

    def reason(name: str) -> str | None:
        import csv

        packed = name.endswith((".gz", ".gzip"))
        try:
            with _stream(name) as f:
                rows = csv.DictReader(io.TextIOWrapper(f, "utf-8-sig", newline=""))
                first = next(rows, None)
                if first is None:
                    return "empty_csv"
                if not set(needed) <= set(rows.fieldnames or ()):
                    return "missing_cols"
                found = not keep
                for r in itertools.chain([first], rows):
                    found = found or r.get(keep[0]) in keep[1]
                    if found and not packed:
                        break
                return None if found else "empty_after_filter"
        except (OSError, EOFError, zlib.error):
            return "gzip_corrupt_or_truncated"
        except (ValueError, csv.Error):
            return "read_error"

    def work(name: str):  # noqa: ANN202
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([reason(name)], pa.string())], names=["file", "reason"])

    return _over_files(spark, list_files(spark, folder), work, "file string, reason string")


def read_vocabulary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated vocabulary: no quoting, empty is null, text cast leniently to ``schema``."""
    wanted = T._parse_datatype_string(schema)
    raw = spark.read.csv(path, sep="\t", quote="", nullValue="", header=True)
    return raw.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted.fields))


def read_first_of(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = ()) -> DataFrame:
    """The first path that exists, parquet or delimited by its ending; an error names all paths tried."""
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            df = spark.read.parquet(p) if ".parquet" in p else spark.read.csv(p, header=True)
            return df.select(*columns) if columns else df
    raise FileNotFoundError("none of: " + ", ".join(paths))


_MARKS = re.compile(r'["\\{}\[\]]')
CHUNK, BATCH_BYTES = 1 << 20, 8 << 20  # characters read at a time; of the payloads handed on at a time


def split_results(chunks: Iterable[str]) -> Iterator[str]:
    """The elements of the top-level ``results`` array of a JSON text that comes in pieces, as texts, one at a time; a text
    without such an array as a whole. What is broken is handed on as it stands."""
    held, at, begin = "", 0, 0  # text not handed on; where to read on; where the element, or the last name, begins
    depth, quoted, inside = 0, False, False
    for chunk in chunks:
        held += chunk
        while (m := _MARKS.search(held, at)) is not None:
            at, ch = m.end(), m.group()
            if quoted:
                if ch == "\\":
                    if at >= len(held):  # the escaped character comes with the next piece
                        at = m.start()
                        break
                    at += 1
                elif ch == '"':
                    quoted = False
            elif ch == '"':
                quoted = True
                if not inside and depth == 1:
                    begin = m.start()
            elif ch in "{[":
                if not inside and depth == 1 and ch == "[" and begin is not None and re.fullmatch(r'"results"\s*:\s*', held[begin : m.start()]):
                    inside, held, at, begin, depth = True, held[at:], 0, None, 2
                    continue
                depth += 1
                if inside and depth == 3:
                    begin = m.start()
            elif ch in "}]":
                depth -= 1
                if inside and depth == 2 and begin is not None:
                    yield held[begin:at]
                    held, at, begin = held[at:], 0, None
                elif inside and depth == 1:
                    return
        else:
            at = len(held)
            if inside and begin is None and not quoted:
                held, at = "", 0
    if held.strip() and not inside:
        yield held
    elif inside and begin is not None:
        yield held[begin:]  # cut off


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, payload) of JSON files, one row a report, ready to be shredded: files are streamed and their ``results``
    handed on element by element, so no file is held whole; zip and gzip files are unpacked on the way. record_id is the
    hash of the file's name and the report's number in it."""

    def work(name: str):  # noqa: ANN202
        import zipfile

        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def texts():  # noqa: ANN202
            with _stream(name) as f:
                if name.endswith(".zip"):
                    with tempfile.TemporaryFile() as own:  # a zip file's index stands at its end
                        shutil.copyfileobj(f, own)
                        z = zipfile.ZipFile(own)
                        for n in sorted(z.namelist()):
                            with z.open(n) as part:
                                yield from split_results(pieces(part))
                else:
                    yield from split_results(pieces(f))

        def pieces(f):  # noqa: ANN001, ANN202
            t = io.TextIOWrapper(f, "utf-8", "replace")
            while x := t.read(CHUNK):
                yield x

        rows, size = [], 0
        for n, text in enumerate(texts()):
            rows.append((xxh64_intdigest(f"{name}\0{n}") - 2**63, text))
            size += len(text)
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string()))], names=["record_id", "payload"])
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string()))], names=["record_id", "payload"])

    return _over_files(spark, list_files(spark, path, ("*.json", "*.json.gz", "*.json.gzip", "*.zip")), work, "record_id bigint, payload string")


def synonyms(spark: SparkSession, synonym_path: str, title_path: str, names: DataFrame) -> DataFrame:
    """(name, title): a name's synonym entry, the smallest id, and that entry's title. Both files have two columns,
    id and text; only the wanted names and ids survive the joins."""
    wanted = names.select(F.lower(F.trim(names.columns[0])).alias("k")).distinct()
    two = lambda p: spark.read.csv(p, sep="\t", quote="", schema="id bigint, text string")
    ids = two(synonym_path).withColumn("k", F.lower(F.trim("text"))).join(wanted, "k").groupBy("k").agg(F.min("id").alias("id"))
    return ids.join(two(title_path).withColumnRenamed("text", "title"), "id").select(F.col("k").alias("name"), "title")


def all_synonyms(table: DataFrame, names: DataFrame) -> DataFrame:
    """Every synonym (id, text) that shares an id with one of the names."""
    wanted = names.select(F.lower(F.trim(names.columns[0])).alias("k")).distinct()
    ids = table.join(wanted, F.lower(F.trim("text")) == F.col("k"), "left_semi").select("id").distinct()
    return table.join(ids, "id", "left_semi")


def request_key(method: str, url: str, params: str = "", data: str = "") -> str:
    """The key of a cached answer of an outer service, as dictionaries of such answers are kept."""
    return hashlib.sha256("\n".join((method, url, params, data)).encode()).hexdigest()
