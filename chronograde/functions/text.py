"""Text and number expressions of the workbook format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronograde import fixed_values as fv

_NUMERIC = r"^-?[0-9]+(\.[0-9]+)?$"


def trimmed(value: Column) -> Column:
    """Strip Unicode white space at both ends; text without any keeps the cheap path."""
    white = list(fv.WHITESPACE)
    padded = F.substring(value, 1, 1).isin(white) | F.substring(value, -1, 1).isin(white)
    return F.when(padded, F.btrim(value, F.lit(fv.WHITESPACE))).otherwise(value)


def clean_text(value: Column) -> Column:
    """A text cell: trimmed; empty text and blank markers become null."""
    text = trimmed(value)
    longest = max(map(len, fv.BLANK_MARKERS))
    blank = (F.length(text) <= longest) & ((text == "") | F.lower(text).isin(fv.BLANK_MARKERS))
    return F.when(~blank, text)


def clean_number(value: Column) -> Column:
    """A numeric cell as text: integral numbers without a fraction, others rounded to two digits.

    Numbers beyond 36 digits, infinity included, keep the text of the double; only NaN is a blank.
    """
    fixed = F.regexp_replace(F.round(value, 2).try_cast("decimal(38,2)").cast("string"), r"\.?0+$", "")
    return F.when(~F.isnan(value), F.coalesce(fixed, value.cast("string")))


def plain_number(value: Column) -> Column:
    """Shortest fixed-point text of a number with at most twelve decimals (``100``, ``12.5``, ``33.33333``).

    Hash inputs use this form because engines print doubles differently. Numbers too large for it keep the text of the
    double, so no change goes unseen.
    """
    fixed = F.regexp_replace(value.try_cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.coalesce(fixed, value.cast("string"))


#: What JSON writes otherwise than it stands: quotes, backslashes and control characters; U+FFFD stands for bytes that are no text.
_ESCAPED = r'["\\\x00-\x1f\ufffd]'


def json_text(value: Column) -> Column:
    """A string as a quoted, escaped JSON string; null as ``null``. Text without anything to escape is only put in quotes."""
    boxed = F.to_json(F.array(value))
    escaped = F.substring(boxed, F.lit(2), F.length(boxed) - 2)
    return F.when(~F.rlike(value, F.lit(_ESCAPED)), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(escaped)


def format_weight(weight: Column) -> Column:
    """Weight label: numbers up to 1 are fractions, larger ones are cut to whole per cents, text stays."""
    number = F.when(F.rlike(weight, F.lit(_NUMERIC)), weight.try_cast("double"))
    whole = lambda n: F.concat(n.try_cast("bigint").cast("string"), F.lit("%"))
    return (
        F.when(weight.isNull() | (weight == ""), F.lit("0%"))
        .when(number <= 1, whole(F.bround(number * 100, 0)))
        .when(number > 1, whole(number))
        .otherwise(weight)
    )


def weight_number(label: Column) -> Column:
    """Number behind a weight label for the allocation sum; null if it cannot be read."""
    return trimmed(F.replace(label, F.lit("%"), F.lit(""))).try_cast("double")


def parse_weight(label: Column) -> Column:
    """Stored weight: everything but digits and dots is dropped, null counts as 0."""
    return F.regexp_replace(F.coalesce(label, F.lit("0")), "[^0-9.]", "").try_cast("double")


def calendar_year(label: Column) -> Column:
    return F.regexp_replace(label, "[^0-9]", "").try_cast("int")


def is_forecast(label: Column) -> Column:
    return F.endswith(label, F.lit("E"))


def safe_numeric(text: Column) -> Column:
    """Plain decimal notation only; anything else (words, exponents, blanks) is null."""
    return F.when(F.rlike(text, F.lit(_NUMERIC)), text.try_cast("decimal(18,4)"))


def beyond_numeric(text: Column) -> Column:
    """A number in plain notation that the stored type cannot hold."""
    return F.coalesce(F.rlike(text, F.lit(_NUMERIC)) & text.try_cast("decimal(18,4)").isNull(), F.lit(False))


def format_metric(text: Column) -> Column:
    """Thousands separators and two decimals, half away from zero."""
    number = F.when(F.rlike(text, F.lit(_NUMERIC)), text.try_cast("decimal(30,10)"))
    return F.format_number(F.round(number, 2), 2)
