"""Drug-name and term expressions: cleaning, base names, ingredients and salts. All built-in functions, except NFKC."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.functions import lexicons as X
from vigilake.functions.text import strip


@F.pandas_udf(T.StringType())
def nfkc(s):  # noqa: ANN001, ANN201
    """Unicode compatibility composition; no built-in does it. Arrow-batched; ASCII texts are passed on as they are."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def without(tokens: Column, *lists: Iterable[str]) -> Column:
    drop = sorted({w for x in lists for w in x})
    return F.filter(tokens, lambda w: ~w.isin(*drop))


def empty_to_null(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def title_case(c: Column) -> Column:
    """Upper case after every character that is no letter or digit, lower case elsewhere."""
    parts = F.split(F.lower(c), r"(?<=[^\p{IsAlphabetic}\p{IsDigit}])")
    return F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 1_000_000))), "")


def clean_name(c: Column, compat: bool = True) -> Column:
    """A drug name for look-ups; null gives an empty text, and a name that cleaning empties stays as it was."""
    original = strip(c)
    s = nfkc(original) if compat else original
    s = F.regexp_replace(F.regexp_replace(s, "[‘’]", "'"), "[“”]", '"')
    s = F.translate(s, "^", " ")
    for g in X.GREEK:
        s = F.regexp_replace(s, rf"(?i)\.{g}\.", g.lower() + "-")
    s = F.regexp_replace(s, r"(?<=[A-Za-z0-9])\?(?=[A-Za-z0-9])", "-")
    s = strip(F.regexp_replace(F.regexp_replace(s, "-{2,}", "-"), r"\s+", " "))
    s = strip(F.regexp_replace(s, r"(?<=\S)\.+$", ""))
    return F.coalesce(F.when(s != "", s), original, F.lit(""))


def base_name(c: Column) -> Column:
    """The words of a name that are no salt, form, route, company or filler and have three letters or more; else those
    of a bracket; else all words."""
    up = F.upper(c)
    letters = lambda x: F.regexp_replace(x, "[^A-Z ]", " ")
    keep = lambda x: F.filter(without(words(letters(x)), X.SALTS, X.DOSAGE_FORMS, X.ROUTES, X.NAME_NOISE, X.COMPANIES), lambda w: F.length(w) > 2)
    outside = F.array_join(keep(F.regexp_replace(up, r"\(.*?\)", " ")), " ")
    brackets = F.filter(F.transform(F.regexp_extract_all(up, F.lit(r"\(([^)]+)\)"), 1), lambda b: F.array_join(keep(b), " ")), lambda b: b != "")
    everything = F.array_join(keep(up), " ")
    raw = F.array_join(words(letters(up)), " ")
    return F.coalesce(F.nullif(outside, F.lit("")), F.get(brackets, F.lit(0)), F.nullif(everything, F.lit("")), raw)


def strip_to_name(c: Column) -> Column:
    """The upper-case name without brackets, punctuation, doses, ratios, salts, routes, forms, companies and numbers."""
    s = F.regexp_replace(strip(F.upper(c)), r"\.+$", "")
    s = F.regexp_replace(F.regexp_replace(s, r"\(.*?\)", " "), r"[^\w\s\-/]", " ")
    s = F.regexp_replace(F.regexp_replace(s, r"\b\d+(\.\d+)?\s?(MG|ML|MCG|G|IU|%)\b", " "), r"\b\d+/\d+\b", " ")
    return F.array_join(F.filter(without(words(s), X.SALTS, X.ROUTES, X.DOSAGE_FORMS, X.COMPANIES), lambda w: ~w.rlike(r"^\d")), " ")


def brackets(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"\((.*?)\)"), 1)


def clean_ingredient(c: Column) -> Column:
    """An ingredient word list in upper case, without dots around words, symbols, numbers and position marks."""
    t = F.regexp_replace(F.regexp_replace(F.upper(strip(c)), r"\.([A-Z]+)\.", "$1"), "[^A-Z0-9 ]", " ")
    kept = F.filter(words(t), lambda w: (F.length(w) > 1) & ~w.rlike(r"^(\d+|\d+[A-Z]{1,2}|[A-Z]{1,2}\d+)$"))
    return F.array_join(kept, " ")


def ingredients_and_salts(parsed: Column) -> tuple[Column, Column]:
    """A parsed list into ingredients and salts; null where there are none."""
    clean = F.filter(F.transform(F.array_compact(parsed), clean_ingredient), lambda t: (t != "") & ~t.isin(*X.NON_INGREDIENTS))
    return empty_to_null(F.filter(clean, lambda t: ~t.isin(*X.SALTS))), empty_to_null(F.filter(clean, lambda t: t.isin(*X.SALTS)))


def substances(c: Column) -> Column:
    r"""A text of substances split at a backslash, a semicolon or a bar between blanks, without "none" and "null"."""
    parts = F.transform(F.split(c, r"\\|;| \| "), strip)
    return F.filter(parts, lambda p: (p != "") & ~F.lower(p).isin("none", "null"))


def bracket_ingredients(c: Column) -> Column:
    """The parts of the first bracket that lists several with + or ;, without units and qualifiers."""
    listed = F.filter(brackets(F.upper(c)), lambda b: b.rlike("[+;]"))
    parts = F.transform(F.split(F.get(listed, F.lit(0)), "[+;]"), strip)
    return F.filter(parts, lambda p: (p != "") & ~p.isin(*X.BRACKET_QUALIFIERS) & ~p.rlike(r"^\d"))


def without_noise(c: Column, noise: Iterable[str] = X.NOISE) -> Column:
    """The words of a text, upper case, without noise words and repeats, in order."""
    return F.array_join(F.array_distinct(without(words(F.upper(c)), noise)), " ")


def any_pattern(c: Column, patterns: Iterable[str] = X.SUSPICIOUS, literal: bool = False) -> Column:
    """Whether the upper-case text holds one of the patterns (regular expressions unless ``literal``); null: no."""
    up = F.upper(F.coalesce(c, F.lit("")))
    return reduce(lambda a, b: a | b, [up.contains(p) if literal else up.rlike(p) for p in patterns])


def text_or_null(c: Column) -> Column:
    t = strip(c)
    return F.when(~F.lower(t).isin("", "none", "null"), t)


def common_subsequence(a: str, masks: dict[str, int], n: int) -> int:
    """The length of the longest common subsequence of ``a`` and a text of ``n`` characters, by bits: ``masks`` has each of
    its characters' places."""
    full = (1 << n) - 1
    v = full
    for ch in a:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def similar(a: Column, b: Column, least: float = 0.0) -> Column:
    """The matching-blocks ratio of two texts, case ignored; no built-in has it, so it runs on what blocking leaves. Null if
    the longest common subsequence, which matching blocks are at most, shows that it is below ``least``."""

    @F.pandas_udf(T.DoubleType())
    def ratio(x, y):  # noqa: ANN001, ANN202
        from difflib import SequenceMatcher

        import pandas as pd

        known: dict[str, dict[str, int]] = {}
        out = []
        for p, q in zip(x, y):
            r = None
            if p is not None and q is not None:
                p, q = p.lower(), q.lower()
                if least and p and q:
                    if (masks := known.get(q)) is None:
                        masks = known[q] = {}
                        for i, ch in enumerate(q):
                            masks[ch] = masks.get(ch, 0) | 1 << i
                    possible = 2 * common_subsequence(p, masks, len(q)) >= least * (len(p) + len(q)) - 1e-9
                else:
                    possible = True
                if possible:
                    r = SequenceMatcher(None, p, q).ratio()
            out.append(r)
        return pd.Series(out, dtype="float64")

    return ratio(a, b)


def first_name(block: Column) -> Column:
    """The first name of a record's NAME block: up to the line's end, without brackets and the semicolon at its end."""
    line = F.regexp_extract(block, r"(?m)^NAME\s+(.+)$", 1)
    return F.nullif(strip(F.regexp_replace(F.regexp_replace(line, r"\s*\([^)]*\)", ""), r";\s*$", "")), F.lit(""))
