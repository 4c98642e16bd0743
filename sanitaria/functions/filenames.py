"""State and period out of a source file name.

Every parser maps a name column to ``struct<uf, year, month, revision>`` and to
NULL where the name does not follow the system's pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.(dbc|DBC)", "")


def _digits(text: Column, start: int, length: int) -> Column:
    part = F.substring(text, start, length)
    return F.when(part.rlike("^[0-9]+$"), part.try_cast("int"))


def _period(uf: Column, year: Column, month: Column, revision: Column) -> Column:
    return F.struct(
        uf.alias("uf"),
        year.cast("int").alias("year"),
        month.cast("int").alias("month"),
        revision.cast("string").alias("revision"),
    )


def monthly_period(name: Column, prefix: str, pivot: int) -> Column:
    """``PREFIX`` + state + YY + MM, where a YY from ``pivot`` on belongs to the 1900s."""
    stem = _stem(name)
    at = len(prefix)
    yy, month = _digits(stem, at + 3, 2), _digits(stem, at + 5, 2)
    valid = stem.startswith(prefix) & (F.length(stem) >= at + 6) & yy.isNotNull() & month.between(1, 12)
    year = yy + F.when(yy >= pivot, 1900).otherwise(2000)
    return F.when(valid, _period(F.substring(stem, at + 1, 2), year, month, F.lit(None)))


def default_period(name: Column, prefix: str) -> Column:
    return monthly_period(name, prefix, pivot=50)


def hospital_period(name: Column) -> Column:
    return monthly_period(name, "RD", pivot=92)


def death_period(name: Column) -> Column:
    """Yearly files: ``DO`` + state + YYYY, before 1996 ``DOR`` + state + YY.

    The length decides before the prefix does, since ``DORJ2023`` starts with
    the older prefix too.
    """
    stem = F.upper(_stem(name))
    size = F.length(stem)
    year = _digits(stem, 5, 4)
    old_year = _digits(stem, 6, 2) + 1900
    month = F.lit(None)
    recent = (size == 8) & stem.startswith("DO") & year.between(1996, 2100)
    older = (size == 7) & stem.startswith("DOR") & old_year.between(1979, 1995)
    return F.when(recent, _period(F.substring(stem, 3, 2), year, month, F.lit("CID10"))).when(
        older, _period(F.substring(stem, 4, 2), old_year, month, F.lit("CID9"))
    )


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``; a yearly file counts as January."""
    return F.when(year.isNotNull(), F.format_string("%04d-%02d", year, F.coalesce(month, F.lit(1))))


def period_index(year: Column, month: Column, yearly: bool) -> Column:
    """Consecutive number of the period: years for yearly systems, else months."""
    return year.cast("int") if yearly else (year * 12 + month - 1).cast("int")
