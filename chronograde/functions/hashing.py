"""Change-detection hashes. Only text and fixed-point numbers are hashed, so values are portable."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronograde.functions.text import plain_number


def joined_hash(columns: Iterable[Column | str]) -> Column:
    """md5 of the '|'-joined values; nulls are skipped."""
    return F.md5(F.concat_ws("|", *columns))


def industry_hash(sector: Column, weight: Column, score: Column) -> Column:
    return joined_hash([sector, plain_number(weight), score])


def industry_vector_hash(industries: Column) -> Column:
    """Hash of an ordered ``array<struct<sector,weight,score>>``; null for a missing or empty vector.

    An array expression keeps the vector's own order and needs no shuffle.
    """
    def item(x: Column) -> Column:
        parts = [x["sector"], plain_number(x["weight"]), x["score"]]
        blank = F.lit("")
        a, b, c = [F.coalesce(p, blank) for p in parts]
        return F.concat(a, F.lit("|"), b, F.lit("|"), c)

    return F.when(F.size(industries) > 0, F.md5(F.array_join(F.transform(industries, item), ",")))
