"""Batched inference by a model that is handed in: texts go to it in fixed batches, answers come back as JSON texts.

The model is any function from a list of texts to a list of answers; it is made once per task by ``make``. An answer that
is no JSON object gives nulls. Distinct texts are asked once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = 64
FIELDS = ("ingredients", "strength", "dosage_form", "qualifier", "qualifier_type")


def _field(answer: str, name: str) -> object:
    try:
        x = json.loads(answer)
    except (TypeError, ValueError):
        return None
    x = x[0] if isinstance(x, list) and x else x
    v = x.get(name) if isinstance(x, dict) else None
    if name == "ingredients":
        return [str(i) for i in v if i is not None] if isinstance(v, list) else None
    return None if v is None else str(v)


def infer(df: DataFrame, text: str, make: Callable[[], Callable[[Sequence[str]], Sequence[str]]], batch: int = BATCH) -> DataFrame:
    """(text, FIELDS...): the answers for each distinct text that isn't null."""
    schema = T.StructType([T.StructField(text, T.StringType())] + [T.StructField(f, T.ArrayType(T.StringType()) if f == "ingredients" else T.StringType()) for f in FIELDS])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for part in parts:
            for at in range(0, part.num_rows, batch):
                texts = part.slice(at, batch).column(0)
                answers = list(model(texts.to_pylist()))
                columns = [pa.array([_field(a, f) for a in answers], pa.list_(pa.string()) if f == "ingredients" else pa.string()) for f in FIELDS]
                yield pa.RecordBatch.from_arrays([texts, *columns], names=schema.names)

    return df.select(F.col(text).cast("string")).filter(F.col(text).isNotNull()).distinct().mapInArrow(run, schema)
