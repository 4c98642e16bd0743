"""Column statistics kept next to a store until its files or the rules change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanitaria.operators.profile import STATS_VERSION
from sanitaria.operators.sketches import merged_stats, refresh_sketches
from sanitaria.sources.store import data_files, read_or_none
from sanitaria.systems import System, get_system


def stats_path(root: str) -> str:
    return f"{root.rstrip('/')}/catalog/column_stats"


def _state(spark: SparkSession, root: str, system: System) -> tuple[int, str]:
    """Number of data files and the time of the newest one."""
    newest = data_files(spark, root, system).agg(F.count(F.lit(1)), F.max("modified_at").cast("string")).first()
    return newest[0], newest[1] or ""


def _saved(spark: SparkSession, root: str, system: System) -> DataFrame | None:
    saved = read_or_none(spark, stats_path(root))
    return None if saved is None else saved.where(F.col("system") == system.name)


def fresh_stats(spark: SparkSession, root: str, system: str | System) -> DataFrame | None:
    """Saved statistics of this version over exactly the present files, or None."""
    spec = get_system(system)
    saved = _saved(spark, root, spec)
    if saved is None:
        return None
    files, newest = _state(spark, root, spec)
    valid = saved.where(
        (F.col("version") == STATS_VERSION) & (F.col("files") == files) & (F.col("newest") == newest)
    ).drop("system", "version", "files", "newest")
    return None if valid.isEmpty() else valid


def cached_stats(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Saved statistics when fresh, else merged from the sketches of the store's files, of which only new ones are read, and saved."""
    spec = get_system(system)
    fresh = fresh_stats(spark, root, spec)
    if fresh is not None:
        return fresh
    files, newest = _state(spark, root, spec)
    refresh_sketches(spark, root, spec)
    merged_stats(spark, root, spec).select(
        "column", "row_count", "null_pct", "fill_pct", "distinct_count",
        F.lit(spec.name).alias("system"),
        F.lit(STATS_VERSION).alias("version"),
        F.lit(files).cast("bigint").alias("files"),
        F.lit(newest).alias("newest"),
    ).coalesce(1).write.mode("append").parquet(stats_path(root))
    return fresh_stats(spark, root, spec)


def saved_versions(spark: SparkSession, root: str, system: str | System) -> int:
    """How many states of the store have saved statistics."""
    saved = _saved(spark, root, get_system(system))
    return 0 if saved is None else saved.select("version", "files", "newest").distinct().count()
