"""Displayed amounts: units, scales, exact decimals and their way back to text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Currency marks, and words for scales with their multipliers.
CURRENCY_MARKS = {"£": "GBP", "$": "USD", "€": "EUR"}
SCALES = {"THOUSANDS": 1_000, "MILLIONS": 1_000_000}
UNKNOWN = "UNKNOWN"
#: Fixed value: what any number is made of; a cast of other text fails by an exception, which takes longer than all else.
NUMERIC = r"^[+\-.eE]*\p{Nd}[\p{Nd}+\-.eE]*$"


def unit(text: Column) -> Column:
    """GBP, GBP_THOUSANDS, GBP_MILLIONS and the like from a displayed unit, else UNKNOWN."""
    t = F.upper(F.trim(F.coalesce(text, F.lit(""))))
    for mark, code in CURRENCY_MARKS.items():
        t = F.replace(t, F.lit(mark), F.lit(code))
    t = F.regexp_replace(t, r"[\s_'’]+", "_")
    code = F.regexp_extract(t, "^([A-Z]{3})", 1)
    rest = F.regexp_replace(t, "^[A-Z]{3}_?", "")
    scale = F.when(rest.isin("", "POUNDS", "UNITS"), "").when(rest.isin("000", "000S", "K", "THOUSAND", "THOUSANDS"), "_THOUSANDS").when(rest.isin("M", "MN", "MILLION", "MILLIONS"), "_MILLIONS")
    return F.when((code != "") & scale.isNotNull(), F.concat(code, scale)).otherwise(UNKNOWN)


def currency(unit_: Column) -> Column:
    return F.when(unit_ != UNKNOWN, F.substring(unit_, 1, 3))


def multiplier(unit_: Column) -> Column:
    return F.when(unit_.endswith("_THOUSANDS"), 1_000).when(unit_.endswith("_MILLIONS"), 1_000_000).when(unit_ != UNKNOWN, 1)


def with_currency(unit_: Column, code: Column) -> Column:
    """The unit in another currency at the same scale; unchanged where either is unknown."""
    return F.when((unit_ != UNKNOWN) & code.isNotNull(), F.concat(code, F.substring(unit_, 4, 100))).otherwise(unit_)


def display_decimal(text: Column) -> Column:
    """A displayed amount as decimal(38,6): dashes are zero, parentheses negative, anything else but a number null."""
    t = F.regexp_replace(F.trim(text), r"[£$€,\s]", "")
    negative = t.rlike(r"^\(.*\)$")
    bare = F.regexp_replace(t, r"[()]", "")
    number = F.when(bare.rlike(NUMERIC), bare.try_cast("decimal(38,6)"))
    return F.when(t.rlike("^[-–—]+$"), F.lit(0).cast("decimal(38,6)")).when(negative, -number).otherwise(number)


def reported_value(text: Column, unit_: Column) -> Column:
    """The displayed amount at its unit's scale, or null for an unknown unit."""
    return (display_decimal(text) * multiplier(unit_).cast("decimal(10,0)")).cast("decimal(38,6)")


def pence(text: Column, unit_: Column) -> Column:
    """Whole pence of a displayed sterling amount, else null."""
    return pence_of(reported_value(text, unit_), unit_)


def pence_of(value: Column, unit_: Column) -> Column:
    """Whole pence of a reported value in sterling, else null."""
    return F.when(currency(unit_) == "GBP", F.bround(value * 100, 0).cast("bigint"))


def count_value(text: Column) -> Column:
    """A displayed head-count that is a whole number; dashes are zero."""
    value = display_decimal(text)
    return F.when(value == F.floor(value), value.cast("bigint"))


def display_text(value: Column) -> Column:
    """1,234 or (1,234)."""
    plain = F.format_number(F.abs(value).cast("decimal(38,0)"), 0)
    return F.when(value < 0, F.concat(F.lit("("), plain, F.lit(")"))).otherwise(plain)
