"""Which landing files a request covers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sanitaria.systems import System, get_system


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder as ``folder, name, size_bytes``; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.regexp_replace("path", "[^/]+$", "").alias("folder"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size_bytes"),
    )


def with_period(files: DataFrame, system: str | System, name: str = "name") -> DataFrame:
    """Adds ``uf``, ``year`` and ``month`` read from the file name; NULL for foreign names."""
    period = get_system(system).period(F.col(name))
    return files.withColumns({"uf": period["uf"], "year": period["year"], "month": period["month"]})


def _covers(system: System, start: date, end: date) -> Column:
    """Yearly files by year overlap, monthly files by the first day of their month."""
    if system.yearly:
        return F.col("year").between(start.year, end.year)
    first = F.make_date("year", "month", F.lit(1))
    return first.between(F.lit(start), F.lit(end))


def _in_window(system: System, by_folder: bool) -> Column:
    """The year lies in a source window; with a folder column, in that folder's own window."""

    def fits(window) -> Column:
        years = F.col("year").between(window.first_year, window.last_year)
        return years & F.col("folder").contains(window.folder) if by_folder else years

    return reduce(lambda a, b: a | b, map(fits, system.windows), F.lit(not system.windows))


def select_landing_files(
    files: DataFrame,
    system: str | System,
    start: date,
    end: date,
    ufs: Iterable[str] | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Files of a listing (``name`` and optionally ``folder``) that a request covers.

    ``only`` restricts to the names of another table, whatever their case.
    """
    spec = get_system(system)
    if end < start:
        raise ValueError("end must not be before start")
    named = with_period(files.where(F.lower("name").endswith(".dbc")), spec).where(F.col("year").isNotNull())
    chosen = named.where(_covers(spec, start, end) & _in_window(spec, "folder" in files.columns))
    if ufs is not None:
        chosen = chosen.where(F.col("uf").isin(*ufs))
    if only is not None:
        wanted = only.select(F.upper("name").alias("_wanted")).distinct()
        chosen = chosen.join(wanted, F.upper("name") == F.col("_wanted"), "left_semi")
    return chosen
