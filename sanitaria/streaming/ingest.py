"""Pick up new landing files, type them and write them to the store, file by file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.stats_cache import cached_stats
from sanitaria.operators.transform import canonicalize, clean_columns, typed_column
from sanitaria.session import remove_folder, scratch_dir
from sanitaria.sinks import manifest
from sanitaria.sinks.store import WHOLE, drop_pieces, observed, write_store
from sanitaria.sources.landing import REJECT_SCHEMA, Landing, scan_checked, scan_landing, with_origin
from sanitaria.sources.store import PIECE, read_or_none, stored_files
from sanitaria.systems import System, get_system

REPORT_SCHEMA = (
    "system string, batch bigint, files bigint, rows bigint, rejected bigint, failed bigint, lost_values bigint, "
    "unplaced bigint, bytes bigint, finished_at timestamp"
)


def report_path(root: str) -> str:
    return f"{root.rstrip('/')}/catalog/load_report"


def rejects_path(root: str, system: str | System) -> str:
    return f"{root.rstrip('/')}/catalog/rejects/{get_system(system).name}"


def failures_path(root: str) -> str:
    return f"{root.rstrip('/')}/catalog/failed_files"


def _landed(landing: DataFrame, system: System, files: Sequence[str] | None) -> DataFrame:
    """``source_file, piece`` of all landing files: from their paths if given, else from the rows."""
    if files is not None:
        paths = landing.sparkSession.createDataFrame([(path,) for path in files], "path string")
        landing = with_origin(paths, system, F.col("path"))
    return landing.select("source_file", PIECE).distinct()


def load_batch(
    landing: DataFrame,
    root: str,
    system: str | System,
    batch: int = 0,
    raw: bool = False,
    rebalance: bool = False,
    audit: bool = False,
    reload: bool = False,
    statistics: bool = False,
    files: Sequence[str] | None = None,
    rejected: DataFrame | None = None,
    failed: Sequence[tuple[str, str]] = (),
) -> int:
    """One load: landing files that the manifest does not list, typed, written, then listed and reported.

    Each landing file is a folder of the store, ``uf / source_file / piece``, and writing replaces it.
    Data first, manifest second: a run that dies in between leaves folders that are not
    listed, whole or in part, and the next load writes them again; nothing is lost or
    doubled.  Two landing files with the same published name are two pieces, in one load or in
    several, and both are kept.  ``reload`` loads what is listed as well and replaces
    all that the store has of these files.  No row of the store is read in a load.

    ``raw`` stores clean text instead of typed values, in a store of its own below
    ``root/raw``.  ``audit`` also counts, within the load, values that typing turned to NULL;
    ``statistics`` renews the store's column statistics afterwards.  ``files``, the paths that the
    rows were scanned from (``landing_files``), spares reading the rows once more for the names.
    ``rejected`` and ``failed`` (of ``scan_checked``) are kept beside the store, those lines by landing file, so a file
    that is loaded again replaces its own, and counted in the report.
    """
    spec, spark = get_system(system), landing.sparkSession
    root = f"{root.rstrip('/')}/raw" if raw else root
    if PIECE not in landing.columns:
        landing = landing.withColumn(PIECE, F.lit(WHOLE))
    if "source_file" not in landing.columns:
        raise ValueError("landing rows need a source_file")
    aside = scratch_dir(spark, "names", root)
    names, keys = _landed(landing, spec, files), ["source_file", PIECE]
    if not reload:
        names = names.join(manifest.listed_pieces(spark, root, spec).select(*keys), keys, "left_anti")
    names.coalesce(1).write.parquet(aside)
    fresh = spark.read.schema(f"source_file string, {PIECE} string").parquet(aside)
    if not fresh.where("source_file is null").isEmpty():
        raise ValueError("landing rows without a source_file")
    bad_lines = 0 if rejected is None else _keep_rejects(rejected.join(F.broadcast(fresh), keys, "left_semi"), fresh, root, spec)
    if failed:
        lost = spark.createDataFrame([(spec.name, batch, *f) for f in failed], "system string, batch bigint, path string, reason string")
        lost.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(failures_path(root))
    cleaned, losses = clean_columns(landing.join(F.broadcast(fresh), keys, "left_semi")), Observation()
    if audit:
        lost = [
            F.count_if(C.quoted(n).isNotNull() & typed_column(spec, n).isNull())
            for n in spec.fields
            if n in cleaned.columns
        ]
        cleaned = cleaned.observe(losses, reduce(lambda a, b: a + b, lost).alias("lost"))
    typed = canonicalize(cleaned, spec, raw, keep=[PIECE], fill=False)
    rows = write_store(typed, root, spec, "replace", rebalance=rebalance, by_file=True, fill=True)
    if reload:
        drop_pieces(spark, root, spec, fresh, fresh)
        manifest.remove_files(fresh.select("source_file"), root, spec)
    files = stored_files(spark, root, spec)
    stored = 0 if files is None else files.join(fresh, keys, "left_semi").agg(F.sum("size_bytes")).first()[0] or 0
    counted = fresh.withColumn("placed", spec.period(F.col("source_file"))["uf"].isNotNull())
    counted.agg(F.count("source_file").alias("files"), F.count_if(~F.col("placed")).alias("unplaced")).select(
        F.lit(spec.name).alias("system"),
        F.lit(batch).cast("bigint").alias("batch"),
        "files",
        F.lit(rows).cast("bigint").alias("rows"),
        F.lit(None if rejected is None else bad_lines).cast("bigint").alias("rejected"),
        F.lit(len(failed)).cast("bigint").alias("failed"),
        F.lit(observed(losses, "lost") if audit else None).cast("bigint").alias("lost_values"),
        "unplaced",
        F.lit(stored).cast("bigint").alias("bytes"),
        F.current_timestamp().alias("finished_at"),
    ).coalesce(1).write.mode("append").parquet(report_path(root))
    manifest.add_files(fresh, root, spec)
    remove_folder(spark, aside)
    if statistics:
        cached_stats(spark, root, spec)
    return rows


def _keep_rejects(rejected: DataFrame, files: DataFrame, root: str, system: System) -> int:
    """Write the rejected lines of ``files`` in place of what was kept of these files before; gives their number."""
    spark, path = rejected.sparkSession, rejects_path(root, system)
    earlier = read_or_none(spark, path, T._parse_datatype_string(REJECT_SCHEMA))
    if earlier is not None:
        old = earlier.select("source_file", PIECE).distinct().join(F.broadcast(files), ["source_file", PIECE], "left_semi")
        for row in old.collect():  # folders of files at hand
            remove_folder(spark, f"{path}/source_file={row['source_file']}/{PIECE}={row[PIECE]}")
    rejected.hint("rebalance", "source_file", PIECE).write.mode("append").partitionBy("source_file", PIECE).parquet(path)
    return rejected_lines(spark, root, system).join(F.broadcast(files), ["source_file", PIECE], "left_semi").count()


def rejected_lines(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """``source_file, piece, path, line, reason, text`` of all lines that loads have turned away."""
    schema = T._parse_datatype_string(REJECT_SCHEMA)
    kept = read_or_none(spark, rejects_path(root, system), schema)
    return spark.createDataFrame([], schema) if kept is None else kept.select(*schema.names)


def load_files(
    spark: SparkSession, root: str, system: str | System, paths: Sequence[str], sep: str = ";", encoding: str = "UTF-8",
    **options,
) -> int:
    """Load delimited landing files whole: rows to the store, lines that are none and unreadable files to tables of their own."""
    found: Landing = scan_checked(spark, system, paths, sep, encoding)
    return load_batch(
        found.rows, root, system, files=found.files, rejected=found.rejected, failed=found.failed, **options
    )


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """Loads so far, newest first: files, rows, lines turned away, files not read, values lost in typing, files whose
    name says no state, bytes stored."""
    return spark.read.schema(REPORT_SCHEMA).parquet(report_path(root)).orderBy(F.desc("finished_at"))


def start_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    system: str | System,
    checkpoint: str,
    file_format: str = "csv",
    sep: str = ";",
    encoding: str = "UTF-8",
    max_files: int = 1_000,
):
    """Stream every landing file not seen before, then stop.

    The stream is one of file names, at most ``max_files`` a batch; each batch reads its files as
    ``scan_landing`` does, every one by its own header, so columns may move, come and go.
    The checkpoint remembers the names of finished batches, and a batch that is replayed after a
    failure writes the same folders again.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
    )

    def load(batch: DataFrame, number: int) -> None:
        paths = [row["path"] for row in batch.collect()]  # at most max_files names
        if paths:
            if file_format == "csv":
                load_files(spark, root, system, paths, sep, encoding, batch=number)
            else:
                load_batch(scan_landing(spark, system, paths, file_format, sep, encoding), root, system, number, files=paths)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
