"""Writing canonical rows into the store: by state, or by source file."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.sources.store import PIECE, read_or_none, store_layout, store_path, stored_files
from sanitaria.systems import System, get_system

MODES = {"append": "append", "replace": "overwrite"}
CODECS = ("zstd", "snappy", "gzip")
#: Folder levels of the two layouts.
LEVELS = {"state": ["uf"], "file": ["uf", "source_file", PIECE]}
#: The piece of rows that do not say which landing file they come from.
WHOLE = "0"
#: The folder of rows without a value of a level.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_store(
    df: DataFrame,
    root: str,
    system: str | System,
    mode: str = "append",
    compression: str = "zstd",
    rebalance: bool = False,
    by_file: bool = False,
    fill: bool = False,
) -> int:
    """Write rows into the store of a system; gives the number of rows written.

    By state, ``uf=XX``, for bulk writes; by file, ``uf=XX/source_file=NAME/piece=P``, for
    loads, so that one published file can be written again by itself.  A store has one
    layout.  ``replace`` swaps exactly the folders at hand: states, or pieces of files.

    Landing files already belong to one state, and rows are written where they are.
    ``rebalance`` shuffles rows that do not: it gathers each folder into files of AQE's advisory
    size and splits one that outgrows it, so the largest state does not end in a single task.

    ``fill`` adds the columns of the system's schema that the rows lack, typed NULLs, after rows were moved and sorted:
    most sources have few of them, and sorting is what takes the memory of a writing task.
    """
    spec, layout = get_system(system), "file" if by_file else "state"
    if mode not in MODES:
        raise ValueError(f"write mode must be one of {sorted(MODES)}")
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    there = store_layout(df.sparkSession, root, spec)
    if there not in (None, layout):
        raise ValueError(f"the store of {spec.name} is laid out by {there}")
    if by_file and PIECE not in df.columns:
        df = df.withColumn(PIECE, F.lit(WHOLE))
    levels, written = LEVELS[layout], Observation()
    rows = (df if by_file else df.drop(PIECE)).observe(written, F.count(F.lit(1)).alias("rows"))
    # Levels without NULL, which are the same folders, spare the writer a sort of its own above the one below.
    folder = lambda name: F.coalesce(F.nullif(C.quoted(name).cast("string"), F.lit("")), F.lit(NO_VALUE))
    rows = rows.withColumns({name: folder(name) for name in levels})
    if rebalance:
        rows = rows.hint("rebalance", *levels)
    last = [C.quoted(spec.order_by).asc_nulls_last()] if spec.order_by in df.columns else []
    rows = rows.sortWithinPartitions(*levels, *last)
    if fill:
        there = {f.name: f for f in rows.schema.fields}
        fields = [there.pop(f.name, f) for f in spec.schema.fields]
        rows = rows.to(T.StructType([*fields, *there.values()]))
    (
        rows.write.mode(MODES[mode])
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*levels)
        .parquet(store_path(root, spec))
    )
    return observed(written, "rows")


def observed(metrics: Observation, name: str) -> int:
    """A metric of a finished write; a plan found empty while running has none and counts 0."""
    try:
        return metrics.get[name]
    except KeyError:
        return 0
    except Py4JJavaError as error:
        if "NoSuchElementException" not in error.java_exception.getClass().getName():
            raise
        return 0


def not_loaded(df: DataFrame, target: DataFrame | None, key: str = "source_file") -> DataFrame:
    """Rows whose source file, whatever its case, is not in ``target`` yet."""
    if target is None:
        return df
    loaded = target.select(F.upper(C.quoted(key)).alias("_loaded")).distinct()
    return df.join(loaded, F.upper(C.quoted(key)) == F.col("_loaded"), "left_anti")


def insert_new_files(
    df: DataFrame, root: str, system: str | System, key: str = "source_file", **options
) -> int:
    """Write the rows of files the store does not hold; running it again inserts 0.

    Which files it holds is read from the names of its folders, not from its rows.
    Another ``key`` than the file name is looked up in the rows.
    """
    spec, spark = get_system(system), df.sparkSession
    target = stored_files(spark, root, spec) if key == "source_file" else read_or_none(spark, store_path(root, spec))
    return write_store(not_loaded(df, target, key), root, spec, "replace", by_file=True, **options)


def drop_pieces(spark, root: str, system: str | System, names: DataFrame, kept: DataFrame) -> int:
    """Remove what the store holds of the files ``names`` besides the pieces ``kept``; gives the folders removed."""
    files = stored_files(spark, root, system)
    if files is None:
        return 0
    same = F.upper(F.col("source_file"))
    gone = (
        files.join(names.select(same.alias("_n")).distinct(), same == F.col("_n"), "left_semi")
        .join(kept.select("source_file", PIECE), ["source_file", PIECE], "left_anti")
        .select("folder").distinct().collect()
    )
    for row in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(row["folder"])
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(gone)
