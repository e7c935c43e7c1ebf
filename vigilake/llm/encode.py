"""Token ids of whole texts by a public byte-level BPE tokenizer, over Arrow batches, and the way back.

All ids come from the tokenizers library. It is asked only once per worker for each distinct *unit*: a text is cut
before every blank that surely begins a new pre-token, the units' ids are kept, and a text's ids are gathered from its
units' by numpy. The cut is exact: the pre-tokenizer's pattern looks back at nothing, and a blank begins a pre-token
unless white space stands on both its sides (or on its left, at the end of the text). Texts with such a blank go to the
library as a whole.

The byte table of byte-level BPE gives each token's bytes: offsets are prefix sums of byte lengths, turned into
character positions by counting the bytes that begin a character. A character split over several tokens belongs to the
token that ends it. Decoding joins the tokens' bytes; incomplete characters give U+FFFD.

Defined results: empty and null texts give an empty list; strings that look like special tokens are ordinary text;
white space and every other character count as they stand; a null in a decoded list is skipped, an id outside the
vocabulary gives U+FFFD. Rows are kept as they are, repeats and null ids included; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"

# A blank between white spaces, or after one at the end. The class holds all that any version may call white space.
_SPACES = "\\s\x1c-\x1f\x85\xa0\u180e\u200b\ufeff"
_UNSURE = re.compile(f"[{_SPACES}] (?=[{_SPACES}]|\\Z)")
KEPT_UNITS, KEPT_CHARS = 300_000, 16_000_000  # kept in a worker before it starts anew
SLICE = 512  # texts encoded at a time


def byte_table() -> dict[str, int]:
    """Byte-level BPE's character for each byte: printable ones stand for themselves, others for 256, 257, ..."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class _Units(dict):
    """Unit -> slot; unknown units get the next one and wait for their ids."""

    def __init__(self) -> None:
        self.waiting: list[str] = []
        self.chars = 0

    def __missing__(self, unit: str) -> int:
        self[unit] = slot = len(self)
        self.chars += len(unit)
        self.waiting.append(unit)
        return slot


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        table, vocab = byte_table(), json.loads(open(path, encoding="utf-8").read())["model"]["vocab"]
        self.bytes = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.bytes[i] = bytes(table[ch] for ch in token)
        self.lengths = np.array([len(b) for b in self.bytes], np.int32)
        self._reset()

    def _reset(self) -> None:
        self.counts: dict[str, int] = {}
        self.units = _Units()
        self.units[""] = 0
        self.first, self.count = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        waiting, self.units.waiting = self.units.waiting, []
        if waiting:
            new = self._library(waiting)
            count = np.array([len(x) for x in new], np.int64)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.flat = np.concatenate([self.flat, *new])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin and end (one more than texts)."""
        if len(self.units) > KEPT_UNITS or self.units.chars > KEPT_CHARS:
            self._reset()
        slots: list[int] = []  # of all texts; below 0: a text of its own
        ends: list[int] = []
        own: list[str] = []
        get = self.units.__getitem__
        for text in texts:
            if text:
                if "\0" in text or _UNSURE.search(text):
                    own.append(text)
                    slots.append(-len(own))
                else:
                    slots.extend(map(get, text.replace(" ", "\0 ").split("\0")))
            ends.append(len(slots))
        self._learn()
        at = np.array(slots, np.int64)
        mine = at < 0
        first, count = self.first[np.where(mine, 0, at)], self.count[np.where(mine, 0, at)]
        flat = self.flat
        if own:
            ids = self._library(own)
            lengths = np.array([len(x) for x in ids], np.int64)
            starts = len(flat) + np.cumsum(lengths) - lengths
            flat = np.concatenate([flat, *ids])
            first[mine], count[mine] = starts[-1 - at[mine]], lengths[-1 - at[mine]]
        cum = np.concatenate([[0], np.cumsum(count)])
        gathered = flat[np.arange(cum[-1]) + np.repeat(first - cum[:-1], count)]
        return gathered, cum[np.concatenate([[0], ends]).astype(np.int64)]

    def count_of(self, unit: str) -> int:
        """The number of tokens of one short text by itself; kept."""
        if unit not in self.counts:
            if len(self.counts) > KEPT_UNITS:
                self.counts.clear()
            self.counts[unit] = len(self._library([unit])[0])
        return self.counts[unit]

    def byte_ends(self, ids: np.ndarray) -> np.ndarray:
        """The byte position where each token ends."""
        return np.cumsum(self.lengths[ids], dtype=np.int64)

    def decode(self, ids) -> str:  # noqa: ANN001
        n, known = len(self.bytes), [int(i) for i in ids if i is not None and i == i]
        return b"".join(self.bytes[i] or b"\xff" if 0 <= i < n else b"\xff" for i in known).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def ship(spark: SparkSession, path: str) -> str:
    """Sends the tokenizer's file along with the job, so that only the driver needs it at its path."""
    spark.sparkContext.addFile(path)
    return path


def encoder(path: str) -> Encoder:
    """The worker's encoder, from the file sent along if there is one; kept from task to task."""
    if path not in _ENCODERS:
        sent = SparkFiles.get(os.path.basename(path))
        _ENCODERS[path] = Encoder(sent if os.path.exists(sent) else path)
    return _ENCODERS[path]


def char_positions(data: bytes) -> np.ndarray | None:
    """The character position of each byte position (one more than bytes); None if they are the same."""
    if data.isascii():
        return None
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = BYTE_BPE, offsets: bool = False) -> DataFrame:
    """(key, ids) of each row, with ``offsets`` also ``ends``: the character position where each token ends."""
    fields = [df.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("ends", T.ArrayType(T.IntegerType()))] * offsets
    schema, path = T.StructType(fields), ship(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = part.column(1).to_pylist()
                ids, cuts = e.encode(texts)
                columns = [part.column(0), pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(ids))]
                if offsets:
                    ends = np.empty(len(ids), np.int32)
                    for i, t in enumerate(texts):
                        own, data = slice(cuts[i], cuts[i + 1]), (t or "").encode("utf-8", "replace")
                        by_byte, positions = e.byte_ends(ids[own]), char_positions(data)
                        ends[own] = by_byte if positions is None else positions[by_byte]
                    columns.append(pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(ends)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, schema)


def decode(ids: Column, path: str = BYTE_BPE) -> Column:
    """The text of a list of ids; null for a null list."""
    if spark := SparkSession.getActiveSession():
        ship(spark, path)

    @F.pandas_udf(T.StringType())
    def run(lists):  # noqa: ANN001, ANN202
        e = encoder(path)
        return lists.map(lambda x: None if x is None else e.decode(x))

    return run(ids)
