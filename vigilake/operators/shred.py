"""Deeply nested records into flat tables, by columnar shredding with repetition and definition levels.

A tree of repeated ancestors (report > drug > active substance ...) is declared once. Each batch of JSON texts is
parsed and shredded into columns, one per leaf path: a value list plus, for each value or gap, a repetition level (at
which repeated ancestor a new element begins; 0 begins a new record) and a definition level (how much of the path is
there). A table is then reconstructed for each repeated ancestor from the level sequences alone, with numpy: positions
are running counts of entries since the last entry of a smaller repetition level, the link to the parent is the running
count of entries at or above the parent's level. Batches are independent, so nothing is shuffled.

Defined results: text that is not well-formed JSON, or is no object, gives no rows; nor does null. A payload is a report
or an object whose ``results`` holds reports. An object stands for an array of one where an array is expected; so does
a plain string for a node that allows it; a string for a node with JSON text is read as JSON. Anything else in place of
an array counts as absent. Positions count from 0 in the array as it stands; null elements take a position but give no
row. Ids are given as text, also if written as numbers; an absent id is null. Unknown fields are ignored, repeated
names in an object: the last wins, nested values of a leaf are given as compact JSON text (null if nested deeper than the
interpreter goes), unpaired surrogates as U+FFFD. Depth beside the leaves doesn't matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.runtime import cut


@dataclass(frozen=True)
class Node:
    """A repeated ancestor: its path below its parent, its leaf paths, its repeated children."""

    name: str
    path: tuple[str, ...]
    leaves: tuple[tuple[str, ...], ...] = ()
    children: tuple[Node, ...] = ()
    text_is_element: str | None = None  # a plain string stands for an element with this leaf
    text_is_json: bool = False


# The fields of the source schema.
RECURRENCE = Node("drugrecurrence", ("drugrecurrence",), (("drugrecuraction",), ("drugrecuractionmeddraversion",)))
SUBSTANCE = Node("activesubstance", ("activesubstance",), (("activesubstancename",),), text_is_element="activesubstancename")
DRUG = Node(
    "drug",
    ("patient", "drug"),
    (("medicinalproduct",), ("drugcharacterization",), ("drugadministrationroute",), ("drugindication",), ("drugdosageform",), ("drugauthorizationnumb",), ("drugbatchnumb",), ("drugstructuredosagenumb",), ("drugstructuredosageunit",), ("actiondrug",), ("openfda",)),
    (SUBSTANCE, RECURRENCE),
)
REACTION = Node("reaction", ("patient", "reaction"), (("reactionmeddrapt",), ("reactionoutcome",), ("reactionmeddraversionpt",)), text_is_json=True)
REPORT = Node(
    "report",
    (),
    (("safetyreportid",), ("receivedate",), ("receiptdate",), ("serious",), ("companynumb",), ("primarysource", "qualification"), ("primarysource", "reportercountry"), ("patient", "patientsex"), ("patient", "patientonsetage"), ("patient", "patientonsetageunit")),
    (DRUG, REACTION),
)


class _Real(float):
    """A number with a fraction or exponent, that keeps its text."""

    def __new__(cls, text: str) -> _Real:
        x = super().__new__(cls, text)
        x.text = text
        return x


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _whole(text: str) -> object:
    return int(text) if len(text) < 4000 else text


_SCAN = re.compile(r'[ \t\n\r]*(?:([{}\[\]:,])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null))')


def _loads(text: str) -> object:
    """JSON text of any depth; ValueError if it is broken."""
    try:
        return json.loads(text, parse_constant=_no_constant, parse_float=_Real, parse_int=_whole)
    except RecursionError:
        return _loads_deep(text)


def _loads_deep(text: str) -> object:
    """As ``_loads`` without recursion: a stack of open arrays and objects, each with the name its next value gets."""
    stack: list[list] = []
    at, expected, value = 0, "value", None
    while True:
        m = _SCAN.match(text, at)
        if m is None:
            raise ValueError(at)
        at, (sign, string, scalar) = m.end(), m.groups()
        done = False
        if expected in ("value", "value or ]") and (string or scalar):
            value = json.loads(string or scalar, parse_float=_Real, parse_int=_whole)
            done = True
        elif expected in ("name", "name or }") and string:
            stack[-1][1], expected = json.loads(string), ":"
        elif sign == ":" and expected == ":":
            expected = "value"
        elif sign in ("[", "{") and expected.startswith("value"):
            stack.append([[] if sign == "[" else {}, None])
            expected = "value or ]" if sign == "[" else "name or }"
        elif sign == "," and expected == "end":
            expected = "value" if isinstance(stack[-1][0], list) else "name"
        elif sign == "]" and (expected == "value or ]" or (expected == "end" and isinstance(stack[-1][0], list))):
            value, done = stack.pop()[0], True
        elif sign == "}" and (expected == "name or }" or (expected == "end" and isinstance(stack[-1][0], dict))):
            value, done = stack.pop()[0], True
        else:
            raise ValueError(at)
        if done:
            if not stack:
                if text[at:].strip(" \t\n\r"):
                    raise ValueError(at)
                return value
            held, name = stack[-1]
            if isinstance(held, list):
                held.append(value)
            else:
                held[name] = value
            expected = "end"


def parse(payload: str | None) -> list:
    """The reports of a payload, nulls included; empty if it is broken or no object."""
    if payload is None:
        return []
    try:
        x = _loads(payload)
    except ValueError:
        return []
    if not isinstance(x, dict):
        return []
    if isinstance(x.get("results"), list):
        return [r if isinstance(r, dict) else None for r in x["results"]]
    return [x["results"] if isinstance(x.get("results"), dict) else x]


def _elements(node: Node, parent: dict) -> list:
    x: object = parent
    for step in node.path:
        x = x.get(step) if isinstance(x, dict) else None
    if isinstance(x, str):
        if node.text_is_json:
            try:
                x = _loads(x)
            except ValueError:
                return []
        elif node.text_is_element:
            return [x]
    if isinstance(x, dict):
        return [x]
    return x if isinstance(x, list) else []


def _leaf(x: object, path: tuple[str, ...]) -> str | None:
    for step in path:
        if not isinstance(x, dict):
            return None
        x = x.get(step)
    if x is None or isinstance(x, str):
        return x
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, _Real):
        return x.text
    if isinstance(x, int):
        return str(x)
    try:
        return json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    except RecursionError:
        return None


@dataclass
class Column:
    """A leaf path's column: levels for each entry, values for the entries that have one."""

    reps: list[int] = field(default_factory=list)
    defs: list[int] = field(default_factory=list)
    values: list[str] = field(default_factory=list)

    def gap(self, r: int, d: int) -> None:
        self.reps.append(r)
        self.defs.append(d)


class Shredder:
    """Shreds records below ``root`` into one column per leaf path.

    Definition levels of a node at depth k (root 1): 2k-1 if an element takes a position, 2k if it isn't null; a leaf
    that is there has one more. Its repetition level is k.
    """

    def __init__(self, root: Node, leaves: dict[str, tuple[tuple[str, ...], ...]] | None = None):
        self.root, self.nodes, self.parent, self.depth = root, [], {}, {}
        self.leaves: dict[str, tuple[tuple[str, ...], ...]] = {}
        self._enter(root, None, 1, leaves)
        self.columns = {(n.name, p): Column() for n in self.nodes for p in self.leaves[n.name]}
        self.below = {n.name: [self.columns[m.name, p] for m in self._subtree(n) for p in self.leaves[m.name]] for n in self.nodes}

    def _enter(self, node: Node, parent: Node | None, depth: int, leaves: dict | None) -> None:
        self.nodes.append(node)
        self.parent[node.name], self.depth[node.name] = parent, depth
        # every node keeps one leaf at least: it carries the node's level sequence
        self.leaves[node.name] = node.leaves if leaves is None else leaves.get(node.name, ()) or node.leaves[:1]
        for child in node.children:
            self._enter(child, node, depth + 1, leaves)

    def _subtree(self, node: Node) -> list[Node]:
        return [node, *(m for c in node.children for m in self._subtree(c))]

    def add(self, reports: list) -> None:
        self._write(self.root, reports, 0, 0)

    def _write(self, node: Node, elements: list, r: int, d: int) -> None:
        if not elements:
            for c in self.below[node.name]:
                c.gap(r, d)
            return
        k = self.depth[node.name]
        for x in elements:
            if x is None:
                for c in self.below[node.name]:
                    c.gap(r, 2 * k - 1)
            else:
                if isinstance(x, str) and node.text_is_element:
                    x = {node.text_is_element: x}
                for p in self.leaves[node.name]:
                    c, v = self.columns[node.name, p], _leaf(x, p)
                    c.gap(r, 2 * k + (v is not None))
                    if v is not None:
                        c.values.append(v)
                for child in node.children:
                    self._write(child, _elements(child, x) if isinstance(x, dict) else [], r, 2 * k)
            r = k

    def table(self, name: str) -> dict[str, np.ndarray]:
        """Reconstructs the table of a repeated ancestor from its columns' levels: ``record``, a position for the node
        and each ancestor, ``report`` (running number of the root element), and the leaves' values."""
        k = self.depth[name]
        first = self.columns[name, self.leaves[name][0]]
        reps, defs = np.asarray(first.reps, np.int16), np.asarray(first.defs, np.int16)
        here = defs >= 2 * k  # an element that isn't null
        entry = np.arange(len(reps))
        out = {"record": (np.cumsum(reps == 0) - 1)[here], "report": (np.cumsum(reps <= 1) - 1)[here]}
        for level in range(1, k + 1):
            begins = np.cumsum(reps <= level)
            parent_at = np.maximum.accumulate(np.where(reps < level, entry, 0)) if len(entry) else entry
            out[f"position{level}"] = (begins - begins[parent_at])[here]
        for p in self.leaves[name]:
            c = self.columns[name, p]
            there = np.asarray(c.defs, np.int16) == 2 * k + 1
            values = np.full(len(reps), None, object)
            values[there] = c.values
            out["/".join(p)] = values[here]
        return out

    def root_values(self, path: tuple[str, ...]) -> np.ndarray:
        """A root leaf's value for each root entry, gaps included: indexed by a table's ``report``."""
        c = self.columns[self.root.name, path]
        values = np.full(len(c.reps), None, object)
        values[np.asarray(c.defs, np.int16) == 3] = c.values
        return values


SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("report_pos", T.LongType()),
        T.StructField("safetyreportid", T.StringType()),
        T.StructField("entry", T.LongType()),
        T.StructField("sub_entry", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)
SLICE = 256  # records shredded at a time


def _clean(values: np.ndarray) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except (UnicodeEncodeError, pa.ArrowInvalid):
        return pa.array([None if v is None else v.encode("utf-16", "surrogatepass").decode("utf-16", "replace") for v in values], pa.string())


def _rows(shredder: Shredder, record_ids: np.ndarray, only: str | None) -> Iterator[pa.RecordBatch]:
    ids = shredder.root_values(("safetyreportid",))
    for node in shredder.nodes if only is None else [n for n in shredder.nodes if n.name == only]:
        t, k = shredder.table(node.name), shredder.depth[node.name]
        n = len(t["record"])
        if not n:
            continue
        none = np.full(n, -1, np.int64)
        paths = ["/".join(p) for p in shredder.leaves[node.name]]
        values = _clean(np.stack([t[p] for p in paths], axis=1).ravel())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([node.name] * n, pa.string()),
                pa.array(record_ids[t["record"]], pa.int64(), from_pandas=True),
                pa.array(t["position1"], pa.int64()),
                _clean(ids[t["report"]]),
                pa.array(t["position2"] if k > 1 else none, pa.int64()),
                pa.array(t["position3"] if k > 2 else none, pa.int64()),
                pa.MapArray.from_arrays(np.arange(n + 1, dtype=np.int32) * len(paths), pa.array(paths * n, pa.string()), values),
            ],
            names=SCHEMA.names,
        )


def shred(df: DataFrame, root: Node = REPORT, record: str = "record_id", payload: str = "payload", only: Node | None = None) -> DataFrame:
    """All tables of ``df``'s payloads in one frame of (table, record_id, report_pos, safetyreportid, entry, sub_entry,
    fields): entry and sub_entry are -1 where the table has none; fields holds the leaves as text. ``only`` gives one
    table and reads its columns alone, beside the one of each path that carries its levels."""
    leaves = None if only is None else {only.name: only.leaves}
    name = None if only is None else only.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                shredder = Shredder(root, leaves)
                for text in part.column(1).to_pylist():
                    shredder.add(parse(text))
                yield from _rows(shredder, np.asarray(part.column(0).to_pylist(), object), name)

    return df.select(F.col(record).cast("bigint"), F.col(payload).cast("string")).mapInArrow(run, SCHEMA)


def tables(df: DataFrame, root: Node = REPORT) -> dict[str, DataFrame]:
    """Every flat table by name, from one parse of all payloads that is written once."""
    once, out, nodes = cut(shred(df, root)), {}, [root]
    while nodes:
        node = nodes.pop()
        out[node.name] = table(once, node)
        nodes += node.children
    return out


def openfda_rows(drugs: DataFrame) -> DataFrame:
    """(key, value, safetyreportid, entry) of the drug table: the openFDA block's lists and plain values as attribute rows."""
    block = F.explode(F.from_json("openfda", "map<string,string>")).alias("key", "text")
    rows = drugs.select("safetyreportid", "entry", block).filter(F.col("text").isNotNull())
    values = F.when(F.col("text").startswith("["), F.from_json("text", "array<string>")).otherwise(F.array("text"))
    return rows.select("key", F.explode(values).alias("value"), "safetyreportid", "entry").filter(F.col("value").isNotNull())


def table(shredded: DataFrame, node: Node) -> DataFrame:
    """The flat table of one node out of a shredded frame: keys, then a column per leaf."""
    keys = ["record_id", "report_pos", "safetyreportid"]
    if node.name != "report":
        keys.append("entry")
    if node in (SUBSTANCE, RECURRENCE):
        keys.append("sub_entry")
    leaves = [F.col("fields")["/".join(p)].alias(p[-1]) for p in node.leaves if p != ("safetyreportid",)]
    return shredded.filter(F.col("table") == node.name).select(*keys, *leaves)


def children(shredded: DataFrame) -> DataFrame:
    """(record_id, safetyreportid, child, entry, sub_entry): every child row with its link."""
    return shredded.filter(F.col("table") != "report").select("record_id", "safetyreportid", F.col("table").alias("child"), "entry", "sub_entry")
