"""Passages of held-out items inside long documents, by size-partitioned MinHash containment search.

Texts become words (letter case, punctuation, spacing, line ends and markup dropped) and word shingles. An item's
queries are all its windows of ``passage`` words; the distinct MinHash values of those windows, for each of K hash
functions, are the index, a table of (function, value, item, size). Items whose evidence is shorter than a window have one
query of their own size. Documents are cut into blocks of as many shingles as a window has, and one; each pair of
neighbouring blocks is a candidate set, so every passage lies whole in one of them.

Queries and sets are partitioned by size. For each pair of partitions the containment asked for is turned into a Jaccard
similarity by the sizes' bounds, and that into the number of hash functions that must agree, so that a passage is missed
with less than one chance in a thousand. Each pair of a document and an item that agrees often enough is then verified
exactly: by shingles shared, and by aligning words around the exact runs, so that a passage counts if at most one word in
eight is changed, added or dropped.

The corpus is read once, whatever the number of items. A bit filter of the index's (function, value) pairs, of bounded
size, tells which sets may agree often enough; it drops nothing that agrees. An index of up to ``LOCAL_ROWS`` rows is
broadcast, and the other steps follow in the same task, without shuffle. A larger one isn't: documents with a set that may
agree are written once with their values, these join the index by (function, value), agreements are counted by document,
set and item, and only the texts of documents and items that agree meet for verification. Both ways give the same rows.

Defined results: null, empty and blank texts give nothing, nor do items shorter than a passage; repeated documents are
each reported; an item id with several texts is reported once per document, with its best passage. Closing questions that
many of all items share aren't used as evidence for candidates, and being shorter than a passage can't be one. Extra
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vigilake.runtime import cut

SHINGLE = 3  # words
HASHES = 64
SLICE = 1024  # documents searched at a time
LOCAL_ROWS, LOCAL_CHARS = 4_000_000, 50_000_000  # of the index and of all items, at most, to be broadcast
MOST_BITS, CHUNK = 28, 20  # powers of two: bits of the filter at most, and of one piece of it
KEPT_WORDS = 500_000  # words kept in a worker before it starts anew

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
# A sign of less before a blank or number is no tag. Beyond 80 characters a tag must read as one, by its attributes: signs
# of less and more far apart in prose are none.
_TAG = re.compile(
    r"""<[/!|?]?[A-Za-z][^<>]{0,80}>|<[A-Za-z][\w:.-]*(?:\s+(?:[\w:@.-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)"""
    r"""|(?:allowfullscreen|async|autoplay|checked|controls|defer|disabled|download|hidden|loop|multiple|muted|open|readonly|required|selected)(?=[\s/>])))*\s*/?>"""
)
_COMMENT = re.compile(r"<!--.*?-->", re.DOTALL)
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    if not text:
        return []
    if "<" in text:
        if (end := text.rfind("-->") + 3) > 2:  # what begins after the last end is no comment, nor searched
            text = _COMMENT.sub(" ", text[:end]) + text[end:]
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return _WORD.findall(text.lower())


class _Words(dict):
    def __init__(self) -> None:
        self.hashes: list[int] = []

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        self[word] = slot = len(self)
        self.hashes.append(xxh3_64_intdigest(word))
        return slot


_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(h: np.ndarray) -> np.ndarray:
    """The hash of each run of SHINGLE words, from the words' hashes; runs over text ends are for the caller to drop."""
    s = h[: len(h) - SHINGLE + 1] * _C[0]
    for k in range(1, SHINGLE):
        s = (s ^ (s >> np.uint64(29))) * _C[k] + h[k : len(h) - SHINGLE + 1 + k]
    return s ^ (s >> np.uint64(32))


def _narrow(s: np.ndarray) -> np.ndarray:
    """Shingles in the 32 bits that the hash functions, odd multipliers, permute."""
    return (s >> np.uint64(32)).astype(np.uint32)


_A = np.random.default_rng(7).integers(2**20, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def agreements(jaccard: float, recall: float = 0.999) -> int:
    """The most hash functions that can be asked to agree, for sets this similar to be found this surely."""
    below, r = 0.0, 0
    while r < HASHES:
        below += math.comb(HASHES, r) * jaccard**r * (1 - jaccard) ** (HASHES - r)
        if below > 1 - recall:
            break
        r += 1
    return max(1, r)


@dataclass(frozen=True)
class Plan:
    """Sizes and numbers that follow from what counts as a passage."""

    passage: int = 20
    damage: int = 8

    @property
    def window(self) -> int:
        return self.passage - SHINGLE + 1

    @property
    def block(self) -> int:
        return self.window // 2

    @property
    def most(self) -> int:
        """Shingles of a candidate set."""
        return 3 * self.block

    @property
    def least_shared(self) -> int:
        """Shingles that a passage shares with a set that holds it."""
        return self.window // 2 - 1

    def query_class(self, span: int) -> int:
        """The size partition of a query: 0 for whole windows, else by its size."""
        return 0 if span >= self.window else 1 + (self.window - 1 - span) // 6

    def set_class(self, size: np.ndarray) -> np.ndarray:
        """The size partition of sets."""
        return np.maximum(0, -(-(self.most - np.asarray(size) - 4) // 5))

    def needed(self, set_class: int, query_class: int) -> int:
        """Agreements asked for between two size partitions."""
        most = self.most - 5 * set_class
        low, high = (self.window, self.window) if query_class == 0 else (max(1, self.window - 6 * query_class), self.window - 1 - 6 * (query_class - 1))
        # at worst, two damaged words in a window spoil this many of its shingles; two and a half on average over longer passages
        shared = max(1, low - math.ceil(2.25 * SHINGLE * self.passage / self.damage / 2.5))
        return agreements(min(1.0, shared / max(shared, most + high - shared)))

    @property
    def set_classes(self) -> int:
        return int(self.set_class(np.array([1]))[0]) + 1


def closing(text: str) -> str:
    """The words of the last sentence."""
    return " ".join(words(re.split(r"(?<=[.!?])\s+", text.strip())[-1]))


def item_hashes(text: str, memo: _Words) -> np.ndarray:
    slots = [memo[x] for x in words(text)]
    return np.array(memo.hashes, np.uint64)[slots] if slots else np.zeros(0, np.uint64)


def queries_of(text: str, stock: set[str], plan: Plan, memo: _Words) -> tuple[int, list[np.ndarray]] | None:
    """(size partition, the distinct MinHash values by hash function) of an item's windows; None if it has none."""
    w = words(text)
    if len(w) < plan.passage:
        return None
    last = closing(text)
    n = len(last.split())
    s = shingles(item_hashes(text, memo))
    # shingles that touch the closing question come last
    evidence = len(s) - (n if last in stock and n < plan.passage and w[len(w) - n :] == last.split() else 0)
    if evidence < 1:
        return None
    span, narrow = min(plan.window, evidence), _narrow(s[:evidence])
    return plan.query_class(span), [np.unique(np.lib.stride_tricks.sliding_window_view(narrow * _A[k], span).min(axis=1)) for k in range(HASHES)]


_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def places(k: int | np.ndarray, v: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of the filter that stand for a function's value."""
    x = (v.astype(np.uint64) << np.uint64(8)) | np.asarray(k).astype(np.uint64)
    out = []
    for p in _P:
        y = x * p
        out.append(((y ^ (y >> np.uint64(29))) * _C[1]) >> np.uint64(64 - bits))
    return out


def _extend(a: list[int], b: list[int], edits: int) -> list[int]:
    """How many words of ``a`` can be matched from its start with 0, 1, ... edits against ``b``, ending in a match."""
    n, m = len(a), len(b)
    reach, best, out = {0: 0}, 0, []
    for e in range(edits + 1):
        if e:
            grown: dict[int, int] = {}
            for d, i in reach.items():  # diagonal d: b's position minus a's
                for dd, ii in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):  # changed, dropped, added
                    if ii <= n and 0 <= ii + dd <= m and grown.get(dd, -1) < ii:
                        grown[dd] = ii
            reach = grown
        for d, i in reach.items():
            at = i
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            reach[d] = i
            if i > at and i > best:
                best = i
        out.append(best)
    return out


def aligned(item: np.ndarray, item_shingles: np.ndarray, doc: np.ndarray, doc_shingles: np.ndarray, passage: int, damage: int) -> tuple[int, int, int] | None:
    """(words of the item, edits, first word in ``doc``) of a passage in ``doc``; the one with most words to spare."""
    order = np.argsort(item_shingles, kind="stable")
    ranked = item_shingles[order]
    lo, hi = np.searchsorted(ranked, doc_shingles, "left"), np.searchsorted(ranked, doc_shingles, "right")
    count = hi - lo
    if not count.any():
        return None
    j = np.repeat(np.arange(len(doc_shingles)), count)
    i = order[np.arange(len(j)) + np.repeat(lo - (np.cumsum(count) - count), count)]
    d = j - i
    o = np.lexsort((i, d))
    i, j, d = i[o], j[o], d[o]
    breaks = np.flatnonzero((np.diff(d) != 0) | (np.diff(i) != 1)) + 1
    starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(i)]])
    # among passages that are damaged this much at most, the longest exact run has this many words
    edits = math.ceil(2 * passage / damage) - 1
    least = min(-(-(n - e) // (e + 1)) for e in range(edits + 1) for n in [max(passage, damage * e)])
    best = None
    a = b = None
    for s, e in zip(starts.tolist(), ends.tolist()):
        run = e - s + SHINGLE - 1
        if run < least:
            continue
        if a is None:
            a, b = item.tolist(), doc.tolist()
        i0, j0 = int(i[s]), int(j[s])
        right = _extend(a[i0 + run :], b[j0 + run : j0 + run + len(a) + edits], edits)
        left = _extend(a[:i0][::-1], b[max(0, j0 - len(a) - edits) : j0][::-1], edits)
        for x in range(edits + 1):
            for y in range(edits + 1 - x):
                n = run + right[x] + left[y]
                if n >= max(passage, damage * (x + y)) and (best is None or n - damage * (x + y) > best[0] - damage * best[1]):
                    best = (n, x + y, max(0, j0 - left[y]))
    return best


_MEMO = _Words()


@dataclass
class Filter:
    """Which (function, value) pairs the index may hold, and the fewest agreements asked for by sets' size partition."""

    bits: int
    table: np.ndarray
    least: np.ndarray

    def may_hold(self, k: int, v: np.ndarray) -> np.ndarray:
        """Positions of the values that may be held."""
        found = np.arange(len(v))
        for p in places(k, v, self.bits):
            at = p[found]
            found = found[(self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1]
        return found


@dataclass
class Sets:
    """Of some texts: hashes of all words and shingles, and the values of each set of which enough may be held, sorted by
    text. A set's place is that of its first shingle in its text."""

    hashes: np.ndarray
    every: np.ndarray
    first: np.ndarray  # by text: its first word,
    end: np.ndarray  # and the one after its last
    text: np.ndarray
    place: np.ndarray
    size: np.ndarray  # partition
    k: np.ndarray
    v: np.ndarray


def sets_of(texts: list[str | None], flt: Filter, plan: Plan) -> Sets | None:
    global _MEMO
    if len(_MEMO) > KEPT_WORDS:
        _MEMO = _Words()
    memo, block, fewest = _MEMO, plan.block, plan.passage - plan.passage // plan.damage
    slots: list[int] = []
    cuts, docs = [0], []
    get = memo.__getitem__
    for t, text in enumerate(texts):
        w = words(text)
        if len(w) >= fewest:
            slots.extend(map(get, w))
            cuts.append(len(slots))
            docs.append(t)
    if not docs:
        return None
    hashes = np.array(memo.hashes, np.uint64)[np.array(slots, np.int64)]
    every = shingles(hashes)
    cut = np.array(cuts)
    n_shingles = np.diff(cut) - SHINGLE + 1
    n_blocks = -(-n_shingles // block)
    owner = np.repeat(np.arange(len(docs)), n_blocks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    starts = cut[owner] + within * block
    # one row per place in a block, one column per block; places past a text's end repeat its last shingle
    blocks = _narrow(every)[np.minimum(starts[None, :] + np.arange(block)[:, None], (cut[owner + 1] - SHINGLE)[None, :])]
    # every three neighbours, or all blocks of a short text
    own = n_blocks[owner]
    lefts = np.flatnonzero((within < own - 2) | (within == 0))
    middles, rights = lefts + (own[lefts] > 1), lefts + np.minimum(2, own[lefts] - 1)
    sizes = plan.set_class(np.minimum(plan.most, n_shingles[owner[lefts]] - within[lefts] * block))
    scratch, hits = np.empty_like(blocks), []
    times = np.zeros(len(lefts), np.int16)
    for k in range(HASHES):
        low = np.multiply(blocks, _A[k], out=scratch).min(axis=0)
        m = np.minimum(np.minimum(low[lefts], low[middles]), low[rights])
        found = flt.may_hold(k, m)
        times[found] += 1
        hits.append((found, np.full(len(found), k), m[found]))
    found, k, v = (np.concatenate(x) for x in zip(*hits))
    kept = (times >= flt.least[sizes])[found]
    found, k, v = found[kept], k[kept], v[kept]
    order = np.argsort(found, kind="stable")
    found, k, v = found[order], k[order], v[order]
    left = lefts[found]
    first, end = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    first[docs], end[docs] = cut[:-1], cut[1:]
    return Sets(hashes, every, first, end, np.array(docs)[owner[left]], within[left] * block, sizes[found], k, v.astype(np.int64))


@dataclass
class Local:
    """A whole index that was small enough to be broadcast."""

    keys: np.ndarray  # (function, value) as one number, sorted
    first: np.ndarray  # by key: its items
    items: np.ndarray
    sizes: np.ndarray  # by item: its size partition
    ids: list
    words: list[np.ndarray]
    needed: np.ndarray  # by size partitions

    def __post_init__(self) -> None:
        self.salt = np.random.default_rng(11).integers(1, 2**63, len(self.words), dtype=np.uint64)
        self.held = np.unique(np.concatenate([shingles(w) ^ x for w, x in zip(self.words, self.salt)] or [np.zeros(0, np.uint64)]))


def search(texts: list[str | None], local: Local, flt: Filter, plan: Plan) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, words, edits, first word) of each leak in ``texts``."""
    found = sets_of(texts, flt, plan) if len(local.keys) else None
    if found is None or not len(found.text):
        return
    key = (found.k.astype(np.int64) << 32) | found.v
    at = np.minimum(np.searchsorted(local.keys, key), len(local.keys) - 1)
    same = np.flatnonzero(local.keys[at] == key)
    at = at[same]
    first, count = local.first[at], local.first[at + 1] - local.first[at]
    items = local.items[np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)]
    # sets as numbers: a text's values of one set come together, by place
    n, places_ = len(local.ids), found.first[found.text] + found.place
    sets, number = np.unique(places_, return_inverse=True)
    pairs, times = np.unique(np.repeat(number[same], count) * n + items, return_counts=True)
    some = np.zeros(len(sets), np.int64)
    some[number] = np.arange(len(number))  # a value of each set
    s, i = some[pairs // n], pairs % n
    kept = times >= local.needed[found.size[s], local.sizes[i]]
    s, i = s[kept], i[kept]
    # exact containment: how many of a set's shingles its item holds
    place = places_[s][:, None] + np.arange(plan.most)[None, :]
    keys = found.every[np.minimum(place, len(found.every) - 1)] ^ local.salt[i][:, None]
    shared = (local.held[np.minimum(np.searchsorted(local.held, keys), len(local.held) - 1)] == keys).sum(axis=1)
    s, i = s[shared >= plan.least_shared], i[shared >= plan.least_shared]
    by: dict[tuple[int, int], list[int]] = {}
    for t, p, x in zip(found.text[s].tolist(), found.place[s].tolist(), i.tolist()):
        by.setdefault((t, x), []).append(p)
    for (t, x), own in by.items():
        h = found.hashes[found.first[t] : found.end[t]]
        if y := verified(h, found.every[found.first[t] : found.end[t] - SHINGLE + 1], local.words[x], own, plan):
            yield t, x, *y


def verified(h: np.ndarray, every: np.ndarray, item: np.ndarray, own: list[int], plan: Plan) -> tuple[int, int, int] | None:
    """(words, edits, first word) of the best passage of an item around a text's candidate sets ``own``, if there is one."""
    item_shingles, size = shingles(item), plan.most
    ranked = np.sort(item_shingles)
    held = lambda s: np.count_nonzero(ranked[np.minimum(np.searchsorted(ranked, s), len(ranked) - 1)] == s)
    at = [x for x in sorted(own) if held(every[x : x + size]) >= plan.least_shared]
    if not at:
        return None
    reach = len(item) + len(item) // plan.damage + SHINGLE
    # runs of neighbouring sets, each with the item's length around it
    parts, lo, hi = [], at[0], at[0] + size
    for x in at[1:]:
        if x > hi + 2 * reach:
            parts.append((lo, hi))
            lo = x
        hi = x + size
    parts.append((lo, hi))
    best = None
    for lo, hi in parts:
        lo, hi = max(0, lo - reach), min(len(h), hi + reach)
        x = aligned(item, item_shingles, h[lo:hi], every[lo : hi - SHINGLE + 1], plan.passage, plan.damage)
        if x and (best is None or x[0] - plan.damage * x[1] > best[0] - plan.damage * best[1]):
            best = (x[0], x[1], lo + x[2])
    return best


FIELDS = ("n_words", "n_edits", "first_word")
_VALUES = T.ArrayType(T.StructType([*(T.StructField(n, T.IntegerType()) for n in ("place", "size", "k")), T.StructField("v", T.LongType())]))


def _stock(items: DataFrame, least: int = 3, share: float = 0.01) -> set[str]:
    """Last sentences that many of all items share; no more than the reciprocal of the share, or a third of few items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([closing(t) for t in batch.column(0).to_pylist()], pa.string())], names=["c"])

    n = items.count()
    counts = items.select("t").mapInArrow(run, "c string").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return {r[0] for r in counts.filter(F.col("n") >= max(least, share * n)).collect()}


def _index(items: DataFrame, stock: set[str], plan: Plan) -> DataFrame:
    """(k, v, item, size): the index, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if found := queries_of(text, stock, plan, memo):
                    size, values = found
                    n = np.array([len(v) for v in values])
                    columns = [np.repeat(np.arange(HASHES, dtype=np.int32), n), np.concatenate(values).astype(np.int64), np.full(n.sum(), item, np.int64), np.full(n.sum(), size, np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "v", "item", "size"])

    return cut(items.select("item", "t").mapInArrow(run, "k int, v bigint, item bigint, size int"))


def _bits(rows: int) -> int:
    """Some 32 bits for each row of the index, up to the most."""
    return min(MOST_BITS, max(CHUNK, (32 * max(1, rows)).bit_length()))


def _least(sizes: Iterable[int], plan: Plan) -> np.ndarray:
    return np.array([min((plan.needed(u, q) for q in sizes), default=HASHES + 1) for u in range(plan.set_classes)])


def _filter_of(local: Local, rows: int, plan: Plan) -> Filter:
    held = np.zeros(2 ** _bits(rows), bool)
    for at in places((local.keys >> 32).astype(np.uint64), local.keys & 0xFFFFFFFF, _bits(rows)):
        held[at] = True
    return Filter(_bits(rows), np.packbits(held, bitorder="little"), _least({int(x) for x in local.sizes[local.items]}, plan))


def _filter(index: DataFrame, rows: int, plan: Plan) -> Filter:
    """The bit filter, built in pieces by the executors."""
    bits, sizes = _bits(rows), index.agg(F.collect_set("size")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(places(np.asarray(batch.column(0)), np.asarray(batch.column(1)), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(CHUNK)).astype(np.int32)), pa.array((at & np.uint64(2**CHUNK - 1)).astype(np.int32))], names=["piece", "at"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            piece, at = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for p in np.unique(piece).tolist():
                pieces.setdefault(p, np.zeros(2**CHUNK, bool))[at[piece == p]] = True
        for p, x in pieces.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([np.packbits(x, bitorder="little").tobytes()])], names=["piece", "bits"])

    table = np.zeros(2 ** (bits - 3), np.uint8)
    for p, x in index.select("k", "v").mapInArrow(run, "piece int, at int").repartition("piece").mapInArrow(pack, "piece int, bits binary").collect():  # one row for each piece
        table[p * 2 ** (CHUNK - 3) : (p + 1) * 2 ** (CHUNK - 3)] = np.frombuffer(x, np.uint8)
    return Filter(bits, table, _least(sizes, plan))


def _local(asked: DataFrame, index: DataFrame, plan: Plan) -> Local:
    """An index of bounded size, with the words of its items, as arrays."""
    import pandas as pd

    memo, rows = _Words(), asked.select("item", "i", "t").collect()
    at = pd.DataFrame({"item": np.array([r.item for r in rows], np.int64), "at": np.arange(len(rows))})
    table = pd.DataFrame({c: np.asarray(x) for c, x in zip(index.columns, index.toArrow().columns)}).merge(at, on="item")
    sizes = np.zeros(len(rows), np.int64)
    sizes[table["at"]] = table["size"]
    table = table.sort_values(["k", "v", "at"])
    keys, first = np.unique((table["k"].to_numpy(np.int64) << 32) | table["v"].to_numpy(np.int64), return_index=True)
    needed = np.array([[plan.needed(u, q) for q in range(plan.query_class(1) + 1)] for u in range(plan.set_classes)])
    return Local(keys, np.append(first, len(table)), table["at"].to_numpy(np.int64), sizes, [r.i for r in rows], [item_hashes(r.t, memo) for r in rows], needed)


def _searched(texts: DataFrame, key: str, item_key: str, item_field: T.StructField, local: Local, flt: Filter, plan: Plan) -> DataFrame:
    """All leaks by a broadcast index, in one scan without shuffle."""
    schema = T.StructType([T.StructField(key, texts.schema["d"].dataType), T.StructField(item_key, item_field.dataType), *(T.StructField(n, T.IntegerType()) for n in FIELDS)])
    item_type, shipped = to_arrow_type(item_field.dataType), texts.sparkSession.sparkContext.broadcast((local, flt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local, flt = shipped.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found: dict[tuple, tuple] = {}  # an id that several texts have gives one row, of the best passage
                for t, i, n, edits, first in search(part.column(1).to_pylist(), local, flt, plan):
                    pair, score = (t, local.ids[i]), (n - plan.damage * edits, n, -first)
                    if pair not in found or score > found[pair][0]:
                        found[pair] = (score, (n, edits, first))
                if found:
                    t, i = zip(*found)
                    columns = [part.column(0).take(pa.array(t)), pa.array(i, item_type), *(pa.array(c, pa.int32()) for c in zip(*(x for _, x in found.values())))]
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(run, schema)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", passage: int = 20, damage: int = 8) -> DataFrame:
    """(key, item_key, n_words, n_edits, first_word): documents that hold a passage of at least ``passage`` consecutive
    words of an item with at most one word in ``damage`` changed, added or dropped."""
    plan = Plan(passage, damage)
    asked = items.select(F.col(item_key).alias("i"), F.col(item_text).cast("string").alias("t")).filter(F.col("t").isNotNull()).distinct()
    asked = asked.withColumn("item", F.xxhash64("i", "t"))  # two items of one number would both be verified
    index = _index(asked, _stock(asked), plan)
    rows, key_type = index.count(), docs.schema[key].dataType
    chars = asked.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    texts = docs.select(F.col(key).alias("d"), F.col(text).cast("string").alias("t"))
    if rows <= LOCAL_ROWS and chars <= LOCAL_CHARS:
        local = _local(asked, index, plan)
        return _searched(texts, key, item_key, items.schema[item_key], local, _filter_of(local, rows, plan), plan)
    shipped = docs.sparkSession.sparkContext.broadcast(_filter(index, rows, plan))
    schema = T.StructType([T.StructField("d", key_type), T.StructField("t", T.StringType()), T.StructField("sets", _VALUES)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                x = sets_of(part.column(1).to_pylist(), shipped.value, plan)
                if x is not None and len(x.text):
                    rows, first = np.unique(x.text, return_index=True)
                    values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in ((x.place, pa.int32()), (x.size, pa.int32()), (x.k, pa.int32()), (x.v, pa.int64()))], names=["place", "size", "k", "v"])
                    sets = pa.ListArray.from_arrays(pa.array([*first, len(x.text)], pa.int32()), values)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), part.column(1).take(pa.array(rows)), sets], names=schema.names)

    kept = cut(texts.mapInArrow(scan, schema)).withColumn("row", F.monotonically_increasing_id())
    values = kept.select("row", F.explode("sets").alias("x")).select("row", "x.place", F.col("x.size").alias("u"), "x.k", "x.v")
    agreed = values.join(index, ["k", "v"]).groupBy("row", "item", "place", "u", "size").agg(F.count(F.lit(1)).alias("n"))
    needed = F.create_map(*(F.lit(x) for u in range(plan.set_classes) for q in range(plan.query_class(1) + 1) for x in (100 * u + q, plan.needed(u, q))))
    pairs = agreed.filter(F.col("n") >= needed[100 * F.col("u") + F.col("size")]).groupBy("row", "item").agg(F.collect_set("place").alias("places"))
    meet = pairs.join(asked.select("item", "i", F.col("t").alias("it")), "item").join(kept.select("row", "d", "t"), "row")
    found = T.StructType([T.StructField("row", T.LongType()), T.StructField("d", key_type), T.StructField("i", items.schema[item_key].dataType), *(T.StructField(n, T.IntegerType()) for n in FIELDS)])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, last, h, every = _Words(), None, None, None
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            rows, texts, numbers, item_texts, places_ = (batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6))
            out, at = [], []
            for n, (row, number, its, own) in enumerate(zip(rows, numbers, item_texts, places_)):
                if len(memo) > KEPT_WORDS or len(known) > 10_000:
                    memo, last, known = _Words(), None, {}
                if row != last:  # rows of a document come together
                    h = item_hashes(texts[n], memo)
                    every, last = shingles(h), row
                if number not in known or len(known[number]) == 0:
                    known[number] = item_hashes(its, memo)
                if x := verified(h, every, known[number], own, plan):
                    out.append(x)
                    at.append(n)
            if out:
                same = [batch.column(i).take(pa.array(at)) for i in (0, 1, 2)]
                yield pa.RecordBatch.from_arrays([*same, *(pa.array(c, pa.int32()) for c in zip(*out))], names=found.names)

    meet = meet.select("row", "d", "i", "t", "item", "it", "places").sortWithinPartitions("row", "item")
    passages = meet.mapInArrow(verify, found)
    score = F.struct(F.col("n_words") - damage * F.col("n_edits"), F.col("n_words"), -F.col("first_word"))
    best = passages.groupBy("row", "d", "i").agg(F.max_by(F.struct(*FIELDS), score).alias("x"))
    return best.select(F.col("d").alias(key), F.col("i").alias(item_key), *(F.col(f"x.{n}").alias(n) for n in FIELDS))
