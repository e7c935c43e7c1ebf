"""Freely typed values mapped to the entries of a reference list, with what is unmatched reported.

Every entry has a name, aliases and component words. Texts are folded (compatibility forms, letter case, accents,
invisible characters, digits standing for letters). A multi-pattern automaton over folded names, aliases, components and
additions (words that change nothing: forms, routes, salts, qualifiers, and their abbreviations) finds mentions in the
text written without gaps; mentions begin and end where words do, the longest non-overlapping ones win. Words that no
mention covers are corrected: single words, and up to three neighbouring ones joined, to the one nearest component or
addition by spelling or sound, within one edit from four letters on and two from six. A word made of several components
run together is taken apart if components cover it whole, one corrected part between exact ones included.

The remaining values go to token-set similarity: of the set of components found, those of an entry, and the words not
understood, the share that is common to both. ``strict`` lists (products) count words not understood, so a component
beside an unknown partner or word isn't taken for the single product; others (terms) leave them out as remarks. The
share asked for is the whole: a combination needs all its components, and none of another entry. Where that gives no
entry, a single whole name mentioned counts on lists that aren't strict, then the text without gaps if it is within the
edits of exactly one name, in natural order or, up to three components, any order.

The list may have any size: its patterns are indexed in blocks of bounded memory. Blocks only give evidence (mentions, and
candidates with their distance); evidence of all blocks is put together before anything is decided, so results don't
depend on the number of blocks. With one block, as here, evidence and decision run in one task without shuffle.

Defined results: null values and null tokens are no cases, nor are exact list names; two entries equally near, and two
entries with the same components, give no match; words of one or two letters and plain numbers mean nothing by
themselves; a value is matched alike in every row; empty tables give no rows; texts of any length are read whole.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Callable, Container, Iterable, Iterator, Sequence
from itertools import combinations, permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.runtime import shuffle_partitions

BLOCK_KEYS = 3_000_000  # index keys of one block, some 100 bytes each
KEPT_ANSWERS = 200_000  # corrections kept in a worker
HALVES_FROM = 12  # letters from which a word is indexed by its halves

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_GAP = re.compile(r"[^A-Z0-9]+")
_QUANTITY = re.compile(r"(?<![A-Z0-9])\d+(?:[.,]\d+)?\s*(?:MG/ML|MCG/ML|MCG|MG|ML|UG|IU|G|%)(?![A-Z])")
_CODE = re.compile(r"/\d{4,}/")
# Digits typed for letters; I and L are alike then.
_LIKE = str.maketrans("013458L", "OIEASBI")
_OTHER_LETTERS = str.maketrans({"Ø": "O", "Đ": "D", "Ł": "L", "Æ": "AE", "Œ": "OE", "Þ": "TH", "ß": "SS"})
_SOUND = [(re.compile(p), r) for p, r in ((r"PH", "F"), (r"QU|KW", "KV"), (r"CK", "K"), (r"X", "KS"), (r"C", "K"), (r"Z", "S"), (r"W", "V"), (r"[YJ]", "I"), (r"TH", "T"), (r"(.)\1+", r"\1"))]


def upper(text: str) -> str:
    """Compatibility forms, no invisible characters, no accents, upper case."""
    if text.isascii():
        return text.upper()
    text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).upper().translate(_OTHER_LETTERS)
    if not text.isascii():
        text = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))
    return text


def fold(word: str) -> str:
    return word.translate(_LIKE)


def sound(folded: str) -> str:
    for p, r in _SOUND:
        folded = p.sub(r, folded)
    return folded


def words(value: str) -> list[str]:
    """The folded words of a value, without quantities, codes between slashes and plain numbers."""
    text = _QUANTITY.sub(" ", _CODE.sub(" ", upper(value)))
    return [fold(w) for w in _GAP.split(text) if w and not w.isdigit()]


def edits_allowed(n: int) -> int:
    return 0 if n < 4 else 1 if n < 6 else 2


def distance(a: str, b: str, most: int) -> int:
    """Edits from a to b, a swap of neighbours counting as one; ``most`` + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    first, end = 0, min(len(a), len(b))
    while first < end and a[first] == b[first]:
        first += 1
    last, end = 0, end - first
    while last < end and a[-1 - last] == b[-1 - last]:
        last += 1
    a, b = a[first : len(a) - last], b[first : len(b) - last]
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def deletions(word: str, most: int) -> list[str]:
    """The word, and what is left of it with up to ``most`` letters, two at most, dropped."""
    n, out = len(word), [word]
    if most > 0 and n > 1:
        out += [word[:i] + word[i + 1 :] for i in range(n)]
    if most > 1 and n > 2:
        out += [word[:i] + word[i + 1 : j] + word[j + 1 :] for i in range(n) for j in range(i + 1, n)]
    return out


def _own_keys(word: str) -> set[str]:
    """The index keys of a known word: its deletions, or, if it is long, one-letter deletions of its halves: of two edits
    at most, one half has one at most. Keys of halves carry a mark."""
    if len(word) < HALVES_FROM:
        return set(deletions(word, edits_allowed(len(word))))
    h = len(word) // 2
    return {*(x for x in deletions("<" + word[:h], 1) if x[:1] == "<"), *(x for x in deletions(">" + word[h:], 1) if x[:1] == ">")}


def _asked_keys(word: str) -> set[str]:
    """The keys under which known words within the edits may stand."""
    n, most, out = len(word), edits_allowed(len(word)), set()
    if n - most < HALVES_FROM:
        out.update(deletions(word, most))
    if n + most >= HALVES_FROM:
        known = range(max(HALVES_FROM, n - most), n + most + 1)
        for k in {k for m in known for k in range(m // 2 - 1, m // 2 + 2) if k <= n}:
            out.update(deletions("<" + word[:k], 1))
        for k in {k for m in known for k in range(m - m // 2 - 1, m - m // 2 + 2) if k <= n}:
            out.update(deletions(">" + word[n - k :], 1))
    return out


class Nearest:
    """All known words within the edits allowed for a word's length, by an index of deletions."""

    def __init__(self, known: Iterable[str]):
        self.index: dict[str, str | list[str]] = {}
        for w in set(known):
            for x in _own_keys(w):
                held = self.index.get(x)
                if held is None:
                    self.index[x] = w
                elif held.__class__ is str:
                    self.index[x] = [held, w]
                else:
                    held.append(w)

    def find(self, word: str) -> list[tuple[int, str]]:
        most, near, index = edits_allowed(len(word)), set(), self.index
        for x in index.keys() & _asked_keys(word):
            held = index[x]
            near.add(held) if held.__class__ is str else near.update(held)
        found = ((distance(word, w, k := min(most, edits_allowed(len(w)))), w, k) for w in near)
        return sorted((d, w) for d, w, k in found if d <= k)


# Kinds of patterns. ORDER: components without gaps in another order, for whole texts only; a word's key is empty.
NAME, PART, WORD, ORDER = "name", "part", "word", "order"
Pattern = tuple[str, str, str]  # pattern, kind, key: the components it stands for, sorted, between blanks
Hit = tuple[int, int, str, str]  # first letter, letter after the last, kind, key
Answers = list[tuple[int, str]]  # (cost, key): even costs by spelling, odd ones by sound


def parts_of(components: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(p for c in components if c and (p := fold(_GAP.sub("", upper(c))))))


def spelled(name: str, aliases: Sequence[str], components: Sequence[str]) -> Iterator[Pattern]:
    """The patterns of an entry."""
    parts = parts_of(components)
    key = " ".join(sorted(parts))
    for p in parts:
        yield p, PART, p
    for n in (name, *aliases) if parts else ():
        if n and (whole := "".join(words(n))):
            yield whole, NAME, key
    if len(parts) > 1:
        for order in permutations(parts) if len(parts) <= 3 else (parts,):
            yield "".join(order), ORDER, key


def additions(phrase: str) -> Iterator[Pattern]:
    """The patterns of an addition's words: each and its plural; of words of five letters and more also prefixes of three to
    five letters, and the first letter with two later consonants."""
    for w in words(phrase):
        consonants = [ch for ch in w[1:] if ch not in "AEIOUY"]
        short = {w[:3], w[:4], *(w[0] + a + b for a, b in combinations(consonants, 2))} if len(w) > 4 else set()
        for x in {w, w + "S", w[:5], *short, *(x + "S" for x in short)}:
            yield x, WORD, ""


class Index:
    """Of one block of patterns: gives evidence, decides nothing."""

    def __init__(self, patterns: Iterable[Pattern]):
        import ahocorasick

        self.kinds: dict[str, set[tuple[str, str]]] = {}
        for p, kind, key in patterns:
            self.kinds.setdefault(p, set()).add((kind, key))
        # corrections lead to components and longer additions; whole texts to names
        corrected = [p for p, k in self.kinds.items() if any(kind == PART or (kind == WORD and len(p) > 5) for kind, _ in k)]
        self.heard: dict[str, list[str]] = {}
        for p in corrected:
            self.heard.setdefault(sound(p), []).append(p)
        self.by_spelling, self.by_sound = Nearest(corrected), Nearest(self.heard)
        self.by_whole = Nearest(p for p, k in self.kinds.items() if any(kind != WORD for kind, _ in k))
        self.automaton = ahocorasick.Automaton()
        for p, k in self.kinds.items():
            if any(kind != ORDER for kind, _ in k):
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.kept: tuple[dict[str, tuple[int, str] | None], ...] = ({}, {})

    def hits(self, text: list[str]) -> list[Hit]:
        """Mentions between word borders, and components of four letters or more inside a word."""
        if not text or not len(self.automaton):
            return []
        starts, ends, owner, at = {}, {}, [], 0
        for k, w in enumerate(text):
            starts[at] = k
            at += len(w)
            ends[at] = k
            owner += [k] * len(w)
        out = []
        for last, p in self.automaton.iter("".join(text)):
            end = last + 1
            first = end - len(p)
            whole = first in starts and end in ends
            for kind, key in self.kinds[p]:
                if kind != ORDER and whole and (kind != WORD or len(p) > 4 or starts[first] == ends[end]):
                    out.append((first, end, kind, key))
                elif kind == PART and len(p) >= 4 and owner[first] == owner[last]:
                    out.append((first, end, "inner", key))
        return out

    def answers(self, word: str, whole: bool) -> Answers:
        """What a word may be corrected to, or (``whole``) which names a text without gaps may be."""
        return self._whole(word) if whole else self._word(word)

    def best(self, word: str, whole: bool) -> tuple[int, str] | None:
        """The best of the block's answers; kept, as values share their words."""
        kept = self.kept[whole]
        try:
            return kept[word]
        except KeyError:
            if len(kept) >= KEPT_ANSWERS:
                kept.clear()
            kept[word] = x = best(self.answers(word, whole))
            return x

    def _keys(self, p: str, *kinds: str) -> set[str]:
        return {key for kind, key in self.kinds[p] if kind in kinds}

    def _word(self, word: str) -> Answers:
        out = {(2 * d, key) for d, p in self.by_spelling.find(word) for key in self._keys(p, PART, WORD)}
        if not out or min(out)[0] > 2:
            out |= {(2 * d + 1, key) for d, s in self.by_sound.find(sound(word)) for p in self.heard[s] for key in self._keys(p, PART, WORD)}
        return sorted(out)

    def _whole(self, text: str) -> Answers:
        return sorted({(2 * d, key) for d, p in self.by_whole.find(text) for key in self._keys(p, NAME, PART, ORDER)})


def best(answers: Answers) -> tuple[int, str] | None:
    """The one nearest of all blocks' answers; none if two are equally near. Sound counts if spelling gives nothing within
    one edit."""
    by_spelling = [a for a in answers if a[0] % 2 == 0]
    if by_spelling and min(by_spelling)[0] <= 2:
        answers = by_spelling
    if not answers:
        return None
    least = min(answers)[0]
    keys = {key for cost, key in answers if cost == least}
    return (least, keys.pop()) if len(keys) == 1 else None


Ask = Callable[[str, bool], "tuple[int, str] | None"]


def _apart(first: int, end: int, letters: str, inner: list[Hit], ask: Ask) -> list[str] | None:
    """The components that cover a word whole: exact ones, the longest first, and corrected ones between them."""
    own = sorted((h for h in inner if first <= h[0] and h[1] <= end), key=lambda h: (h[0] - h[1], h[0]))
    taken: list[Hit] = []
    for h in own:
        if all(h[1] <= t[0] or t[1] <= h[0] for t in taken):
            taken.append(h)
    if not taken:
        return None
    found, at = [t[3] for t in taken], first
    for a, b in [*((t[0], t[1]) for t in sorted(taken)), (end, end)]:
        if at < a:
            near = ask(letters[at:a], False) if a - at >= 4 else None
            if near is None:
                return None
            found.append(near[1])
        at = b
    return [x for x in found if x]


def decide(text: list[str], hits: list[Hit], ask: Ask, strict: bool, known: Container[str] = ()) -> list[str]:
    """The component sets that the value may stand for, in the order of preference. ``known``: those of which the list has
    one entry, if they are at hand; nothing is then looked for beyond the first of them."""
    first, at = [], 0
    for w in text:
        first.append(at)
        at += len(w)
    ends = {f + len(w): k for k, (f, w) in enumerate(zip(first, text))}
    starts = {f: k for k, f in enumerate(first)}
    covered, found, names = [False] * len(text), set(), set()
    rank = {NAME: 0, PART: 1, WORD: 2}
    spans: dict[tuple[int, int], dict[str, set[str]]] = {}
    for a, b, kind, key in hits:
        if kind != "inner":
            spans.setdefault((a, b), {}).setdefault(kind, set()).add(key)
    for (a, b), kinds in sorted(spans.items(), key=lambda s: (s[0][0] - s[0][1], s[0][0])):
        i, j = starts[a], ends[b]
        if any(covered[i : j + 1]):
            continue
        keys = kinds[min(kinds, key=rank.get)]
        if len(keys) > 1:  # a name of several entries: its parts may still tell
            continue
        covered[i : j + 1] = [True] * (j + 1 - i)
        key = next(iter(keys))
        found.update(key.split())
        if NAME in kinds:
            names.add(key)
    alone = [not c and len(w) >= 4 and ask(w, False) is not None for w, c in zip(text, covered)]
    near = []
    for i in range(len(text)):
        for j in range(i, min(i + 3, len(text))):
            if covered[j]:
                break
            if j > i and all(alone[i : j + 1]):  # each word means something by itself
                continue
            joined = "".join(text[i : j + 1])
            if len(joined) >= 4 and (x := ask(joined, False)):
                near.append((x[0], -len(joined), i, j, x[1]))
    for d, _, i, j, key in sorted(near):
        if not any(covered[i : j + 1]):
            covered[i : j + 1] = [True] * (j + 1 - i)
            found.update(key.split())
    letters, inner = "".join(text), [h for h in hits if h[2] == "inner"]
    for k, w in enumerate(text):
        if not covered[k] and len(w) >= 8 and (parts := _apart(first[k], first[k] + len(w), letters, inner, ask)):
            covered[k] = True
            found.update(parts)
    unknown = [w for w, c in zip(text, covered) if not c and len(w) > 2]
    keys = []
    if found and not (strict and unknown):
        keys.append(" ".join(sorted(found)))
        if keys[0] in known:
            return keys
    if len(names) == 1 and not strict:
        keys.append(next(iter(names)))
    bare = "".join(w for w, (a, b) in zip(text, zip(first, [*first[1:], at])) if WORD not in spans.get((a, b), {}) or {NAME, PART} & set(spans[a, b]))
    if x := ask(bare, True):
        keys.append(x[1])
    return keys


HITS = "array<struct<first:int,end:int,kind:string,key:string>>"
ANSWERS = "array<struct<cost:int,key:string>>"
_INDEXES: dict[str, Index] = {}


def _index(name: str, shipped) -> Index:  # noqa: ANN001
    """The worker's index of a block; kept from task to task."""
    if name not in _INDEXES:
        if len(_INDEXES) >= 4:
            _INDEXES.clear()
        _INDEXES[name] = Index(shipped.value)
    return _INDEXES[name]


def _patterns(entries: DataFrame, extra: DataFrame | None) -> DataFrame:
    """(pattern, kind, key) of the list's entries (target, name, aliases, components) and of additions (phrase)."""

    def of_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([p for n, a, c in zip(*(batch.column(i).to_pylist() for i in range(3))) for p in spelled(n, a or (), c or ())], "pattern kind key")

    def of_additions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([p for x in batch.column(0).to_pylist() if x for p in additions(x)], "pattern kind key")

    schema = "pattern string, kind string, key string"
    out = entries.select("name", "aliases", "components").mapInArrow(of_entries, schema)
    if extra is not None:
        out = out.unionByName(extra.mapInArrow(of_additions, schema))
    return out.distinct()


def _rows(rows: list[tuple], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(rows[0]) if rows else len(names.split()))], names=names.split())


def _batches(schema: str, types: Sequence[pa.DataType], work: Callable[[pa.RecordBatch], list[tuple]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = work(batch)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return run


_KEYS = "raw_value string, key1 string, key2 string, key3 string"
_HITS_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("key", pa.string())]))
_ANSWERS_TYPE = pa.list_(pa.struct([("cost", pa.int32()), ("key", pa.string())]))
_S = pa.string()


def _three(value: str, keys: list[str]) -> tuple:
    return value, *(keys + [None] * 3)[:3]


def _decided(values: DataFrame, blocks: list[tuple[str, object]], meant: DataFrame, strict: bool) -> DataFrame:
    """(raw_value, key1, key2, key3) of distinct values."""
    if len(blocks) == 1:
        name, shipped = blocks[0]
        keys = values.sparkSession.sparkContext.broadcast({r[0] for r in meant.select("k").collect()})  # no more than patterns

        def one(batch: pa.RecordBatch) -> list[tuple]:
            ix, out = _index(name, shipped), []
            for v in batch.column(0).to_pylist():
                text = words(v)
                out.append(_three(v, decide(text, ix.hits(text), ix.best, strict, keys.value)))
            return out

        return values.mapInArrow(_batches(_KEYS, [_S] * 4, one), _KEYS)

    def over_blocks(df: DataFrame, schema: str, types: list[pa.DataType], work, list_column: str) -> DataFrame:  # noqa: ANN001
        """``work`` over every block, its lists put together."""
        out = None
        for name, shipped in blocks:
            part = df.mapInArrow(_batches(schema, types, lambda batch, n=name, s=shipped: work(_index(n, s), batch)), schema)
            out = part if out is None else out.unionByName(part)
        rest = [c for c in out.columns if c != list_column]
        return out.groupBy(*rest).agg(F.flatten(F.collect_list(list_column)).alias(list_column))

    def mentions(ix: Index, batch: pa.RecordBatch) -> list[tuple]:
        return [(v, [dict(zip(("first", "end", "kind", "key"), h)) for h in ix.hits(words(v))]) for v in batch.column(0).to_pylist()]

    def questions(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for v, hits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            asked: set[tuple[str, bool]] = set()
            decide(words(v), [tuple(h.values()) for h in hits], lambda w, whole: asked.add((w, whole)), strict)  # noqa: B023
            out += [(v, *q) for q in asked]
        return out

    def answered(ix: Index, batch: pa.RecordBatch) -> list[tuple]:
        return [(w, whole, [{"cost": c, "key": k} for c, k in ix.answers(w, whole)]) for w, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]

    def decisions(batch: pa.RecordBatch) -> list[tuple]:
        out = []
        for v, hits, answers in zip(*(batch.column(i).to_pylist() for i in range(3))):
            known = {(a["word"], a["whole"]): best([(x["cost"], x["key"]) for x in a["answers"]]) for a in answers or ()}
            out.append(_three(v, decide(words(v), [tuple(h.values()) for h in hits], lambda w, whole: known.get((w, whole)), strict)))  # noqa: B023
        return out

    found = over_blocks(values, f"raw_value string, hits {HITS}", [_S, _HITS_TYPE], mentions, "hits")
    asked = found.mapInArrow(_batches("raw_value string, word string, whole boolean", [_S, _S, pa.bool_()], questions), "raw_value string, word string, whole boolean")
    answers = over_blocks(asked.select("word", "whole").distinct(), f"word string, whole boolean, answers {ANSWERS}", [_S, pa.bool_(), _ANSWERS_TYPE], answered, "answers")
    own = asked.join(answers, ["word", "whole"]).groupBy("raw_value").agg(F.collect_list(F.struct("word", "whole", "answers")).alias("answers"))
    whole = found.join(own, "raw_value", "left").select("raw_value", "hits", "answers")
    return whole.mapInArrow(_batches(_KEYS, [_S] * 4, decisions), _KEYS)


def match_values(df: DataFrame, field: str, value: str, key: str, entries: DataFrame, tokens: tuple[str, ...], extra: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """(field, key, raw_value, target_id) of each case in ``df``.

    ``entries``: (target, name, aliases, components); ``extra``: (phrase), words that change nothing about what is meant.
    """
    spark = df.sparkSession
    listed = entries.filter(F.col("target").isNotNull() & F.col("name").isNotNull()).select(F.col("target").cast("string"), "name", "aliases", "components").distinct()
    cases = df.select(F.col(key).alias("safetyreportid"), F.col(value).alias("raw_value")).filter(F.col("raw_value").isNotNull() & ~F.col("raw_value").isin(*tokens))
    cases = cases.join(listed.select(F.col("name").alias("raw_value")).distinct(), "raw_value", "left_anti").select("safetyreportid", "raw_value").distinct()
    patterns = _patterns(listed, extra)
    n = F.length("pattern")
    size = patterns.agg(F.coalesce(F.sum(F.when(n < HALVES_FROM, n * n / 2 + 2).otherwise(n + 4)), F.lit(0))).first()[0]
    n_blocks = max(1, -(-3 * int(size) // BLOCK_KEYS))  # indexed by spelling, sound and as a whole
    blocks = []
    for b in range(n_blocks):
        own = patterns if n_blocks == 1 else patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(n_blocks)) == b)
        blocks.append((uuid.uuid4().hex, spark.sparkContext.broadcast([tuple(r) for r in own.collect()])))
    # Each distinct value is matched once, in tasks of their own number: the values are few bytes and much work.
    values = cases.select("raw_value").distinct().repartition(shuffle_partitions(spark), F.xxhash64("raw_value"))
    def entry_keys(batch: pa.RecordBatch) -> list[tuple]:
        return [(" ".join(sorted(parts_of(c or ()))), t) for t, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]

    meant = listed.select("target", "components").mapInArrow(_batches("k string, target string", [_S] * 2, entry_keys), "k string, target string")
    meant = meant.filter(F.col("k") != "").groupBy("k").agg(F.min("target").alias("t"), F.max("target").alias("u"))
    meant = meant.filter(F.col("t") == F.col("u")).select("k", "t")
    decided = _decided(values, blocks, meant, strict)
    for i in (1, 2, 3):
        decided = decided.join(meant.select(F.col("k").alias(f"key{i}"), F.col("t").alias(f"t{i}")), f"key{i}", "left")
    target = F.coalesce("t1", "t2", "t3", F.lit("UNMATCHED")).alias("target_id")
    return cases.join(decided.select("raw_value", target), "raw_value").select(F.lit(field).alias("field"), "safetyreportid", "raw_value", "target_id")
