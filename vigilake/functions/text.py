"""Text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ("", "NA", "NaN", "null", "NULL")

# Every kind of white space, the zero-width space and the byte order mark.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\u200b\ufeff"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(c, F.lit(WHITE))


def null_tokens(c: Column) -> Column:
    """Trimmed text, null where it only stands for a missing value."""
    t = strip(c)
    return F.when(~t.isin(*NULL_TOKENS), t)


def squeeze_upper(c: Column) -> Column:
    """Upper case, trimmed, inner white space made one blank."""
    return F.when(~c.rlike("[^!-~ ]|  |^ | $"), F.upper(c)).otherwise(F.upper(strip(F.regexp_replace(c, r"(?U)\s+", " "))))


def plain_number_id(c: Column) -> Column:
    """An id as plain number if it is numeric (leading zeros and a zero fraction dropped), else as trimmed text.

    Null and blank ids give null. Text with an exponent counts as a number too if it fits 38 digits.
    """
    t = strip(c)
    plain = F.regexp_replace(F.regexp_replace(t, r"^\+", ""), r"^(-?)0+(?=\d)", "$1")
    plain = F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0*$", "")).otherwise(plain)
    plain = F.when(plain.isin("", "-", "-0"), F.lit("0")).otherwise(F.regexp_replace(plain, r"^(-?)\.", "$10."))
    wide = F.regexp_replace(t.try_cast("decimal(38,8)").cast("string"), r"\.?0+$", "")
    return (
        F.when(c.rlike("^[1-9][0-9]*$"), c)  # as most ids are
        .when(t == "", None)
        .when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), plain)
        .when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d{1,2}$"), F.coalesce(wide, t))
        .otherwise(t)
    )
