"""What is there and what is missing: files, periods, gaps, updates and estimates.

Inputs are file tables with ``name``, ``size_bytes`` and the ``uf``, ``year`` and
``month`` read from the name.  They have one row per file, so every group is
small whatever the size of the data behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sanitaria.functions.filenames import period_index, period_label
from sanitaria.systems import System, get_system

# Size factors of the estimates.
STORE_FACTOR = 0.6
CSV_FACTOR = 3.0
STORE_FACTOR_UNSIZED = 0.5
MEGABYTE = 1024 * 1024


def _label() -> Column:
    return period_label(F.col("year"), F.col("month"))


def _bytes() -> Column:
    return F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint")


def storage_stats(files: DataFrame) -> DataFrame:
    """Files and bytes per state."""
    return files.groupBy("uf").agg(F.count(F.lit(1)).alias("files"), _bytes().alias("size_bytes"))


def storage_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and number of states in all."""
    return files.agg(
        F.count(F.lit(1)).alias("files"), _bytes().alias("size_bytes"), F.countDistinct("uf").alias("states")
    )


def overview(files: DataFrame, system: str | System, rows: DataFrame | None = None) -> DataFrame:
    """One line per system: files, bytes, states, rows, first and last period, last update."""
    updated = F.max("modified_at") if "modified_at" in files.columns else F.lit(None).cast("timestamp")
    line = files.agg(
        F.count(F.lit(1)).alias("files"),
        _bytes().alias("size_bytes"),
        F.countDistinct("uf").alias("states"),
        F.min(_label()).alias("first_period"),
        F.max(_label()).alias("last_period"),
        updated.alias("last_updated"),
    )
    count = F.lit(None).cast("bigint") if rows is None else rows.agg(F.count(F.lit(1))).scalar()
    return line.select(F.lit(get_system(system).name).alias("system"), "*", count.alias("row_count"))


def _missing(system: System) -> Column:
    """Periods absent between the first and the last one."""
    index = period_index(F.col("year"), F.col("month"), system.yearly)
    return F.coalesce(F.max(index) - F.min(index) + 1 - F.countDistinct(index), F.lit(0)).cast("bigint")


def coverage_by_uf(files: DataFrame, system: str | System) -> DataFrame:
    """Per state: files, bytes, first and last period, missing periods."""
    return files.groupBy("uf").agg(
        F.count(F.lit(1)).alias("files"),
        _bytes().alias("size_bytes"),
        F.min(_label()).alias("first_period"),
        F.max(_label()).alias("last_period"),
        _missing(get_system(system)).alias("missing_periods"),
    )


def missing_periods(files: DataFrame, system: str | System, by: str | None = "uf") -> DataFrame:
    """Number of periods absent between the first and last one, per state or in all."""
    grouped = files.groupBy(by) if by else files.groupBy()
    return grouped.agg(_missing(get_system(system)).alias("missing_periods"))


def missing_period_list(files: DataFrame, system: str | System) -> DataFrame:
    """The absent periods themselves, per state."""
    spec = get_system(system)
    known = files.select("uf", period_index(F.col("year"), F.col("month"), spec.yearly).alias("index")).where(
        "index is not null"
    )
    spans = known.groupBy("uf").agg(F.min("index").alias("first"), F.max("index").alias("last"))
    expected = spans.select("uf", F.explode(F.sequence("first", "last")).alias("index"))
    absent = expected.join(known, ["uf", "index"], "left_anti")
    if spec.yearly:
        return absent.select("uf", F.col("index").alias("year"), F.lit(None).cast("int").alias("month"))
    return absent.select(
        "uf", F.floor(F.col("index") / 12).cast("int").alias("year"), (F.col("index") % 12 + 1).alias("month")
    )


def timeline(files: DataFrame) -> DataFrame:
    """Files and bytes per period over all states."""
    return (
        files.where("year is not null")
        .groupBy(_label().alias("period"))
        .agg(F.count(F.lit(1)).alias("files"), _bytes().alias("size_bytes"))
        .orderBy("period")
    )


def new_files(available: DataFrame, processed: DataFrame, column: str = "name") -> DataFrame:
    """Upper-case names that are available but not processed."""
    upper = F.upper(F.col(column)).alias("name")
    return available.select(upper).subtract(processed.select(upper))


def update_summary(available: DataFrame, processed: DataFrame, column: str = "name") -> DataFrame:
    """Processed, available and new names as counts, and whether the store is up to date."""
    upper = F.upper(F.col(column)).alias("name")
    theirs = available.select(upper, F.lit(1).alias("there"))
    ours = processed.select(upper, F.lit(1).alias("here"))
    names = (
        theirs.unionByName(ours, allowMissingColumns=True)
        .groupBy("name")
        .agg(F.max("there").alias("there"), F.max("here").alias("here"))
    )
    fresh = F.col("there").isNotNull() & F.col("here").isNull()
    return names.agg(
        F.count("here").alias("processed_count"),
        F.count("there").alias("available_count"),
        F.count_if(fresh).alias("new_count"),
        (F.count_if(fresh) == 0).alias("is_up_to_date"),
    )


def estimate_scope(files: DataFrame) -> DataFrame:
    """Totals of a selection: files, bytes, expected store and CSV bytes."""
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        total.cast("bigint").alias("download_bytes"),
        F.floor(total * STORE_FACTOR).cast("bigint").alias("store_bytes"),
        F.floor(total * CSV_FACTOR).cast("bigint").alias("csv_bytes"),
    )


def estimate_by_uf(files: DataFrame) -> DataFrame:
    """Per state: files, bytes, its share of the expected store, first and last period."""
    per_state = files.groupBy("uf").agg(
        F.count(F.lit(1)).alias("file_count"),
        _bytes().alias("download_bytes"),
        F.min(_label()).alias("first_period"),
        F.max(_label()).alias("last_period"),
    )
    total = per_state.agg(F.sum("download_bytes")).scalar()
    share = F.coalesce(F.try_divide("download_bytes", total), F.lit(0.0))
    store = F.floor(share * F.floor(total * STORE_FACTOR))
    return per_state.select("*", F.coalesce(store, F.lit(0)).cast("bigint").alias("store_bytes"))


def estimate_unsized(files: DataFrame, system: str | System) -> DataFrame:
    """The estimate for a listing without sizes: files times the system's mean file size."""
    mean = get_system(system).mean_file_mb * MEGABYTE
    count = F.count(F.lit(1))
    return files.agg(
        count.alias("file_count"),
        (count * mean).cast("bigint").alias("download_bytes"),
        F.floor(count * mean * STORE_FACTOR_UNSIZED).cast("bigint").alias("store_bytes"),
    )

