"""Sketches of every data file of a store, kept beside it and merged when statistics are asked for."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.profile import distinct_sketch, is_empty
from sanitaria.session import remove_folder
from sanitaria.sources.store import data_files, read_or_none, scan_store, store_path
from sanitaria.systems import System, get_system

#: Raised when what a sketch holds changes; sketches of other versions are made anew.
SKETCH_VERSION = 1
SCHEMA = (
    "file string, size_bytes bigint, modified string, version int, column string, rows bigint, empties bigint, "
    "distinct binary, quantiles binary"
)
_KEY = ["file", "size_bytes", "modified"]


def sketches_path(root: str, system: str | System) -> str:
    return f"{root.rstrip('/')}/catalog/file_sketches/{get_system(system).name}"


def _relative(path: Column, system: System) -> Column:
    return F.regexp_replace(path, f"^.*/{system.name}/(?=uf=)", "")


def _present(spark: SparkSession, root: str, system: System) -> DataFrame:
    return data_files(spark, root, system).select(
        _relative(F.col("path"), system).alias("file"), "size_bytes", F.col("modified_at").cast("string").alias("modified"), "path"
    )


def _kept(spark: SparkSession, root: str, system: System) -> DataFrame:
    log = read_or_none(spark, f"{sketches_path(root, system)}/*", T._parse_datatype_string(SCHEMA))
    log = spark.createDataFrame([], SCHEMA) if log is None else log
    return log.where(F.col("version") == SKETCH_VERSION)


def live_sketches(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Sketches of files as they are now; those of files that are gone or were written again do not count."""
    spec = get_system(system)
    present = _present(spark, root, spec).drop("path")
    # A crash between writing a compacted log and deleting the old one leaves rows twice.
    return _kept(spark, root, spec).join(present, _KEY, "left_semi").dropDuplicates([*_KEY, "column"])


def unsketched(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Present files without sketches: ``file, size_bytes, modified, path``."""
    spec = get_system(system)
    return _present(spark, root, spec).join(_kept(spark, root, spec).select(*_KEY).distinct(), _KEY, "left_anti")


def _sketched(rows: DataFrame, system: System) -> DataFrame:
    """One row of each file and column of ``rows``, which have their ``file``: counts, and sketches of values and numbers."""
    aggregates, entries = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(system.schema.fields):
        number = isinstance(f.dataType, T.NumericType)
        aggregates += [F.count_if(is_empty(f.name, f.dataType)).alias(f"e{i}"), distinct_sketch(f.name).alias(f"d{i}")]
        if number:
            aggregates.append(F.kll_sketch_agg_double(C.quoted(f.name).cast("double")).alias(f"q{i}"))
        entries.append(F.struct(
            F.lit(f.name).alias("column"), F.col("n").alias("rows"), F.col(f"e{i}").alias("empties"),
            F.col(f"d{i}").alias("distinct"), (F.col(f"q{i}") if number else F.lit(None).cast("binary")).alias("quantiles"),
        ))
    return rows.groupBy("file").agg(*aggregates).select("file", F.inline(F.array(*entries)))


def refresh_sketches(spark: SparkSession, root: str, system: str | System) -> int:
    """Sketch the files that have no sketches yet, and only them; gives their number.

    The driver holds the names of the new files, as it does for the load that wrote them; if all files are
    new, the store is read as a whole.  The log is rewritten without dead sketches once these are the greater part.
    """
    spec = get_system(system)
    if read_or_none(spark, store_path(root, spec), spec.schema) is None:
        return 0
    new = unsketched(spark, root, spec)
    files = new.collect()
    if files:
        if len(files) == _present(spark, root, spec).count():
            rows = scan_store(spark, root, spec, filename=False).select("*", F.col("_metadata.file_path").alias("file"))
        else:
            reader = spark.read.schema(spec.schema).option("basePath", store_path(root, spec))
            rows = reader.parquet(*(row["path"] for row in files)).select("*", F.col("_metadata.file_path").alias("file"))
        path = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
        listed = spark.createDataFrame([tuple(row[k] for k in _KEY) for row in files], "file string, size_bytes bigint, modified string")
        decoded = rows.withColumn("file", _relative(F.col("file"), spec))
        named = listed.withColumn("plain", F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))))
        made = _sketched(decoded, spec).withColumn("plain", path).drop("file").join(named, "plain").select(
            *_KEY, F.lit(SKETCH_VERSION).alias("version"), "column", "rows", "empties", "distinct", "quantiles"
        )
        _append(made, root, spec)
    kept = _kept(spark, root, spec).select(*_KEY).distinct().count()
    live = live_sketches(spark, root, spec).select(*_KEY).distinct().count()
    if kept - live > max(live, 16):
        compact_sketches(spark, root, spec)
    return len(files)


def _append(rows: DataFrame, root: str, system: System) -> str:
    folder = f"{sketches_path(root, system)}/{uuid.uuid4().hex}"
    rows.hint("rebalance").write.parquet(folder)
    return folder


def compact_sketches(spark: SparkSession, root: str, system: str | System) -> None:
    """One folder with the live sketches in place of all folders so far."""
    spec = get_system(system)
    log = read_or_none(spark, f"{sketches_path(root, spec)}/*", T._parse_datatype_string(SCHEMA))
    if log is None:
        return
    folders = [r[0] for r in log.select(F.regexp_replace("_metadata.file_path", "/[^/]+$", "")).distinct().collect()]
    _append(live_sketches(spark, root, spec), root, spec)
    for folder in folders:
        remove_folder(spark, folder)


def merged_stats(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Statistics of the whole store from its files' sketches: no row of the store is read.

    ``column, row_count, null_pct, fill_pct, distinct_count, q25, q50, q75``; quartiles are NULL for columns that are
    not numeric.  A file more or less changes the sketches of that file alone; ``refresh_sketches`` comes first.
    """
    live = live_sketches(spark, root, system)
    quartile = lambda q: F.when(F.col("rows") > F.col("empties"), F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))
    merged = live.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("empties").alias("empties"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_count"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.count("quantiles").alias("numbers"),
    )
    null_pct = F.round(F.try_divide(F.col("empties") * 100.0, F.col("rows")), 2)
    number = F.col("numbers") > 0
    return merged.where("rows > 0").select(
        "column", F.col("rows").alias("row_count"), null_pct.alias("null_pct"), F.round(100 - null_pct, 2).alias("fill_pct"),
        "distinct_count", *(F.when(number, quartile(q)).alias(n) for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))),
    )
