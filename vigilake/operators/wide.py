"""Attribute-value rows into one wide, typed row per entity.

Keys are matched to attributes and values are read into their types by column expressions, inside the scan stage. The
cells then go through ``combineByKey``. Its keys are buckets of entities, its combiners register files: the entities'
slot registers as columns of (entity, entry, slot, cell), a register's slot holding the distinct values in one notation.
Merging is set union slot by slot, hence associative and commutative. Files are merged on the map side before anything is
shuffled and whenever one has grown to twice its size, so an entity that owns a third of all rows sends only its distinct
cells. Typed encoders, one per kind, write the registers out as full rows. All of it works on Arrow columns: no row ever
becomes a Python object. Buckets follow the size of the input.

Defined results: a null entry counts as 0; a null report id is a key of its own; unknown keys, null tokens and values
that cannot be read as their attribute's type are dropped; an entity with no readable cell gives no row; list cells are
sorted and free of repeats, an absent cell is null, never an empty list; contradicting booleans give true. Other
columns of the input, whatever their names, are ignored. An empty table gives an empty table of the full schema.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.functions.text import NULL_TOKENS, strip
from vigilake.runtime import shuffle_partitions


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str = "string"

    @property
    def type(self) -> T.DataType:
        return {
            "string": T.ArrayType(T.StringType()),
            "long": T.ArrayType(T.LongType()),
            "date": T.ArrayType(T.DateType()),
            "double": T.ArrayType(T.DoubleType()),
            "flag": T.BooleanType(),
        }[self.kind]


# The attributes of a drug's openFDA block, with their types.
OPENFDA = (
    Attribute("rxcui", "long"),
    Attribute("generic_name"),
    Attribute("brand_name"),
    Attribute("substance_name"),
    Attribute("product_ndc"),
    Attribute("package_ndc"),
    Attribute("application_number"),
    Attribute("manufacturer_name"),
    Attribute("route"),
    Attribute("spl_set_id"),
    Attribute("nui"),
    Attribute("pharm_class_cs"),
    Attribute("pharm_class_epc"),
    Attribute("pharm_class_moa"),
    Attribute("pharm_class_pe"),
    Attribute("product_type"),
    Attribute("unii"),
    Attribute("effective_time", "date"),
    Attribute("is_original_packager", "flag"),
    Attribute("strength_mg", "double"),
)

# English month abbreviations.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _squash(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch not in " .-_").removeprefix("openfda")


def _slot(key: Column, attributes: tuple[Attribute, ...]) -> Column:
    squashed = F.regexp_replace(F.regexp_replace(F.lower(key), r"(?U)[\s.\-_]+", ""), "^openfda", "")
    direct = F.create_map(*(F.lit(x) for i, a in enumerate(attributes) for x in (a.name, i)))
    slots = F.create_map(*(F.lit(x) for i, a in enumerate(attributes) for x in (_squash(a.name), i)))
    return F.coalesce(F.try_element_at(direct, key), F.try_element_at(slots, squashed))


def _canonical(kind: str, v: Column) -> Column:
    """The value as text in one notation per type, null where it cannot be read."""
    if kind == "long":
        return F.when(v.rlike(r"^[+-]?\d+(\.0+)?$"), F.regexp_replace(v, r"\..*$", "").try_cast("bigint").cast("string"))
    if kind == "double":
        plain = F.when(v.rlike(r"^[+-]?(\d+([.,]\d*)?|[.,]\d+)([eE][+-]?\d+)?$"), F.regexp_replace(v, ",", ".").try_cast("double"))
        return F.when(F.abs(plain) < float("inf"), plain + F.lit(0.0)).cast("string")
    if kind == "flag":
        low = F.lower(v)
        return F.when(low.isin("true", "yes", "y", "1"), "1").when(low.isin("false", "no", "n", "0"), "0")
    if kind == "date":
        part = lambda p, i: F.regexp_extract(v, p, i)
        packed, apart = r"^(\d{4})(\d{2})(\d{2})$", r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$"
        named = r"^(\d{1,2})[\s,./-]*([A-Za-z]{3})[\s,./-]*(\d{4})$"
        month = F.try_element_at(F.create_map(*(F.lit(x) for i, m in enumerate(MONTHS) for x in (m, f"{i + 1:02d}"))), F.lower(part(named, 2)))
        iso = (
            F.when(v.rlike(packed), F.concat_ws("-", part(packed, 1), part(packed, 2), part(packed, 3)))
            .when(v.rlike(apart), F.concat_ws("-", part(apart, 1), F.lpad(part(apart, 3), 2, "0"), F.lpad(part(apart, 4), 2, "0")))
            .when(v.rlike(named) & month.isNotNull(), F.concat_ws("-", part(named, 3), month, F.lpad(part(named, 1), 2, "0")))
        )
        return iso.try_cast("date").cast("string")
    return v


def cells(df: DataFrame, attributes: tuple[Attribute, ...] = OPENFDA, entity: str = "safetyreportid", entry: str = "entry", key: str = "key", value: str = "value") -> DataFrame:
    """(e, n, s, c): entity, entry, slot and cell of each attribute-value row, by column expressions only. Slot or cell is
    null where the row has none; such rows are dropped where the rows are read next, as a filter here would be pushed below
    and work each out twice."""
    flat = df.select(F.col(entity).cast("string").alias("e"), F.coalesce(F.col(entry).cast("bigint"), F.lit(0)).alias("n"), _slot(F.col(key), attributes).alias("s"), strip(F.col(value)).alias("v"))
    cell = None
    for kind in sorted({a.kind for a in attributes}):
        of = F.col("s").isin(*(i for i, a in enumerate(attributes) if a.kind == kind)) & ~F.col("v").isin(*NULL_TOKENS)
        cell = F.when(of, _canonical(kind, F.col("v"))) if cell is None else cell.when(of, _canonical(kind, F.col("v")))
    return flat.select("e", "n", "s", cell.alias("c"))


# A register file: record batches of (entity, entry, slot, cell), and its size when it was last merged.
REGISTERS = pa.schema([("e", pa.string()), ("n", pa.int64()), ("s", pa.int32()), ("c", pa.string())])
FLUSH_ROWS, FLUSH_BYTES = 1_000_000, 64 << 20  # cells that a map task holds before it hands on its files
MERGE_BYTES = 32 << 20
BUCKET_BYTES = 64 << 20  # of the input
ROWS_OUT = 20_000  # wide rows in one batch
File = tuple[list[bytes], int]


def _merged(t: pa.Table) -> pa.Table:
    """Each cell of a register once: the associative merger."""
    return t.group_by(REGISTERS.names, use_threads=False).aggregate([]).select(REGISTERS.names).cast(REGISTERS)


CODEC = pa.Codec("zstd")


def _table(parts: Iterable[bytes]) -> pa.Table:
    whole = (CODEC.decompress(p[8:], int.from_bytes(p[:8])) for p in parts)
    return pa.Table.from_batches([pa.ipc.read_record_batch(x, REGISTERS) for x in whole], REGISTERS)


def _bytes(t: pa.Table) -> list[bytes]:
    """Compressed batches, each after its size."""
    whole = (b.serialize() for b in t.combine_chunks().to_batches())
    return [x.size.to_bytes(8) + CODEC.compress(x, asbytes=True) for x in whole]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells, each with its bucket, as one register file a bucket."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        t = t.group_by(t.column_names, use_threads=False).aggregate([]).combine_chunks()
        bucket = t["bucket"].to_numpy()
        order = np.argsort(bucket, kind="stable")
        t, bucket = t.select(REGISTERS.names).cast(REGISTERS).take(order), bucket[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        files = [b for i, j in zip(first, [*first[1:], len(bucket)]) for b in _bytes(t.slice(i, j - i))]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), pa.array(files, pa.binary())], names=["bucket", "file"])

    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        batch = batch.filter(pc.and_(batch["s"].is_valid(), batch["c"].is_valid()))
        if batch.num_rows:
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= FLUSH_ROWS or size >= FLUSH_BYTES:
            yield flush(held)
            held, rows, size = [], 0, 0
    if held:
        yield flush(held)


# Module level, so that the functions travel by name.
def _open(part: bytes) -> File:
    return [part], max(MERGE_BYTES, len(part))


def _put(file: File, part: bytes) -> File:
    return _union(file, ([part], 0))


def _union(a: File, b: File) -> File:
    parts, known = a[0] + b[0], max(a[1], b[1])
    if sum(map(len, parts)) > 2 * known:
        parts = _bytes(_merged(_table(parts)))
        known = max(MERGE_BYTES, sum(map(len, parts)))
    return parts, known


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    """A list of sorted values per entity; null for none."""
    t = pa.table({"o": owner, "v": values})
    t = t.take(pc.sort_indices(t, [("o", "ascending"), ("v", "ascending")]))
    count = np.bincount(owner, minlength=n)
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), t["v"].combine_chunks(), mask=pa.array(count == 0))


# Typed encoders, one per kind: (cells of a slot, whose they are, number of entities) into a column.
ENCODERS: dict[str, Callable[[pa.Array, np.ndarray, int], pa.Array]] = {
    "string": _lists,
    "long": lambda c, o, n: _lists(c.cast(pa.int64()), o, n),
    "double": lambda c, o, n: _lists(c.cast(pa.float64()), o, n),
    "date": lambda c, o, n: _lists(c.cast(pa.date32()), o, n),
    "flag": lambda c, o, n: _flags(c, o, n),
}


def _flags(cells: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    out = np.zeros(n, bool)
    out[owner[np.asarray(pc.equal(cells, "1"))]] = True
    return pa.array(out, mask=np.bincount(owner, minlength=n) == 0)


def _encode(file: File, attributes: tuple[Attribute, ...]) -> Iterator[pa.RecordBatch]:
    """The full rows of a register file's entities."""
    t = _merged(_table(file[0])).combine_chunks()
    e, n, s, c = (t[x].combine_chunks() if t.num_rows else pa.array([], REGISTERS.field(x).type) for x in REGISTERS.names)
    code = e.dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int64)
    entries, of = np.unique(n.to_numpy(), return_inverse=True)
    _, first, owner = np.unique(code * max(1, len(entries)) + of, return_index=True, return_inverse=True)
    columns, slots = [e.take(pa.array(first)), n.take(pa.array(first))], s.to_numpy()
    for i, a in enumerate(attributes):
        own = slots == i
        columns.append(ENCODERS[a.kind](c.filter(pa.array(own)), owner[own], len(first)))
    yield from pa.Table.from_arrays(columns, names=["e", "n", *(a.name for a in attributes)]).to_batches(max_chunksize=ROWS_OUT)


def _input_bytes(df: DataFrame) -> int:
    """What the optimizer knows of the size of the input, a bound without one."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def widen(df: DataFrame, attributes: tuple[Attribute, ...] = OPENFDA, entity: str = "safetyreportid", entry: str = "entry", key: str = "key", value: str = "value") -> DataFrame:
    """One row per (entity, entry) with a typed column per attribute."""
    spark = df.sparkSession
    schema = T.StructType([T.StructField(entity, T.StringType()), T.StructField(entry, T.LongType()), *(T.StructField(a.name, a.type) for a in attributes)])
    partitions = max(shuffle_partitions(spark), -(-_input_bytes(df) // BUCKET_BYTES))
    source = cells(df, attributes, entity, entry, key, value).withColumn("bucket", F.pmod(F.xxhash64("e", "n"), F.lit(partitions)).cast("int"))
    packed = source.mapInArrow(_pack, "bucket int, file binary")
    # An RDD's stages show no query plan: the name says what they read.
    named = packed.rdd.setName("cells of " + ", ".join(sorted({re.sub(r"(\.parquet)/.*", r"\1", f) for f in df.inputFiles()})[:3]))
    files = named.map(lambda r: (r[0], bytes(r[1]))).combineByKey(_open, _put, _union, numPartitions=partitions)
    wide = spark.createDataFrame(files.flatMap(lambda f: [(_ipc(b),) for b in _encode(f[1], attributes)]), T.StructType([T.StructField("rows", T.BinaryType())]), verifySchema=False)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0).to_pylist():
                with pa.ipc.open_stream(b) as r:
                    yield from (x.rename_columns(schema.names) for x in r)

    return wide.mapInArrow(rows, schema)


def _ipc(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def filled(wide: DataFrame, attributes: tuple[Attribute, ...] = OPENFDA, entity: str = "safetyreportid", entry: str = "entry") -> DataFrame:
    """(entity, entry, attribute): each cell of the wide table that is not null."""
    names = F.array_compact(F.array(*(F.when(F.col(a.name).isNotNull(), a.name) for a in attributes)))
    return wide.select(entity, entry, F.explode(names).alias("attribute"))
