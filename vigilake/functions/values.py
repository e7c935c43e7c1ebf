"""Dates, numbers, flags, codes, lists and JSON texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilake.functions import lexicons as X


def any_date(c: Column) -> Column:
    """A date from text: ISO, or year, month and day packed; null if it is neither."""
    t = c.cast("string")
    packed = F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date"))
    return F.coalesce(packed, F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(t, F.lit(10)).try_cast("date")))


def age_in_years(age: Column, unit: Column) -> Column:
    """Whole years; decades times ten; null for an unknown unit."""
    whole = age.try_cast("int")
    out = F.when(unit == "Decade", (whole * 10).cast("double"))
    for name, per_year in X.AGE_UNITS.items():
        out = out.when(unit == name, F.floor(whole / per_year).cast("double"))
    return out


def age_band(age: Column) -> Column:
    out = None
    for name, lo, hi in X.AGE_BANDS:
        test = (age >= lo) & (age < hi)
        out = F.when(test, name) if out is None else out.when(test, name)
    name, lo, hi = X.LAST_BAND
    return out.when((age >= lo) & (age <= hi), name)


def cohort(age: Column, cut: int = 21, most: int = 120) -> Column:
    """The side of the cut an age falls on; null beyond the range."""
    return F.when((age >= 0) & (age <= cut), "pediatric").when((age > cut) & (age <= most), "adult")


def flag(c: Column) -> Column:
    """1 if the value is the number one, else 0."""
    return F.when(c.try_cast("double").try_cast("bigint") == 1, 1).otherwise(0)


def serious(c: Column, *flags: Column) -> Column:
    """1 for code 1 or a text of a serious result, 0 for code 2 and all else; at least any of the flags."""
    code, text = c.try_cast("bigint"), F.lower(c.cast("string"))
    own = F.when(code == 1, 1).when(code == 2, 0).when(text.contains("did not result in any of the above"), 0).when(text.rlike("resulted in"), 1).otherwise(0)
    return F.greatest(own, *map(flag, flags)) if flags else own


def yes(c: Column) -> Column:
    return F.when(F.lower(F.trim(c.cast("string"))).isin("1", "y", "yes", "true", "t"), 1).otherwise(0)


def decode(c: Column, codebook: dict[str, str], width: int = 0) -> Column:
    """A code's meaning: whole numbers from 0, padded with zeros to ``width``; else null."""
    n = c.try_cast("double")
    key = F.when(n >= 0, n.try_cast("bigint").cast("string"))
    key = F.when(F.length(key) < width, F.lpad(key, width, "0")).otherwise(key) if width else key
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in codebook.items() for x in kv)), key)


def country(c: Column, variants: tuple[str, ...] = ("US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA")) -> Column:
    up = F.upper(F.trim(c))
    return F.when(up.isin(*variants), "US").when(F.coalesce(up, F.lit("")) == "", "Unknown").otherwise("Other")


def sex(c: Column) -> Column:
    up = F.upper(F.trim(c))
    return F.when(up.isin("M", "MALE", "1"), "Male").when(up.isin("F", "FEMALE", "2"), "Female").otherwise("Unknown")


# How qualifications are named.
QUALIFICATIONS = {
    "PHYSICIAN": "Physician", "PHARMACIST": "Pharmacist", "OTHER HEALTH-PROFESSIONAL": "Other health professional", "OTHER HEALTH PROFESSIONAL": "Other health professional", "LAWYER": "Lawyer",
    "CONSUMER": "Consumer or non-health professional", "NON-HEALTH PROFESSIONAL": "Consumer or non-health professional",
}


def qualification(c: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in QUALIFICATIONS.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.upper(F.trim(c))), F.trim(c), F.lit("Null/unknown"))


def count_percent(n: Column, total: Column) -> Column:
    """``1,234 (5.6%)``; a total of nothing gives 0.0%."""
    percent = F.when(total > 0, 100.0 * n / total).otherwise(F.lit(0.0))
    return F.concat(F.format_number(n, 0), F.lit(" ("), F.format_string("%.1f", F.round(percent, 1)), F.lit("%)"))


def parse_count_percent(c: Column) -> tuple[Column, Column]:
    n = F.translate(F.nullif(F.regexp_extract(c, r"^([\d,]+)", 1), F.lit("")), ",", "").try_cast("bigint")
    return n, F.nullif(F.regexp_extract(c, r"\(([\d.]+)%\)", 1), F.lit("")).try_cast("double")


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.when(total > 0, 100.0 * part / total).otherwise(F.lit(0.0)), digits)


def distinct_list(c: Column) -> Column:
    """Distinct values, nulls dropped, sorted; null for none."""
    kept = F.array_sort(F.array_distinct(F.array_compact(c)))
    return F.when(F.size(kept) > 0, kept)


def n_unique(c: Column) -> Column:
    """Distinct values, null being one of them."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def list_or_one(c: Column, element: str) -> Column:
    """JSON text of an array of ``element``, or of one, as an array; null if it is neither."""
    t = F.ltrim(c)
    return F.when(t.startswith("["), F.from_json(c, f"array<{element}>")).when(t.startswith("{"), F.array(F.from_json(c, element)))


def joined_substances(c: Column) -> Column:
    """The substance names in a JSON text of an object or array, or the plain text, joined by bars."""
    listed = list_or_one(c, "struct<activesubstancename:string>")
    names = F.filter(F.transform(listed, lambda x: x["activesubstancename"]), lambda n: n.isNotNull() & (n != ""))
    return F.when(listed.isNotNull(), F.nullif(F.array_join(names, "|"), F.lit(""))).when(~F.ltrim(c).rlike(r"^[\[{]"), F.nullif(F.trim(c), F.lit("")))


def substance_in_text(c: Column) -> Column:
    """The substance name pulled out of the text of a record, however it was quoted."""
    found = F.regexp_extract(c, r"""['"]activesubstancename['"]\s*:\s*['"]([^'"]+)['"]""", 1)
    return F.nullif(F.regexp_replace(F.trim(found), r"\s{2,}", " "), F.lit(""))


def url_quoted(c: Column) -> Column:
    """Percent signs for all but letters, digits and ``-._~``."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def worst_status(statuses: Column, order: tuple[str, ...] = ("not_found", "approx", "exact")) -> Column:
    """One status of a list's: the only one there is, ``partial`` if some are not found, else the worst."""
    has = lambda s: F.exists(statuses, lambda x: x == s)
    missing, rest = has(order[0]), reduce(lambda a, b: a | b, [has(s) for s in order[1:]])
    return F.when(missing & rest, "partial").when(missing, order[0]).when(has(order[1]), order[1]).when(has(order[2]), order[2])
