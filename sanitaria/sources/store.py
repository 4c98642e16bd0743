"""Reading the state-partitioned store and registering its views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.enrich import with_labels, with_municipality
from sanitaria.systems import REGISTRY, System, get_system

MUNICIPALITY_VIEW = "ibge_locais"
#: Folder level below a source file: which of several landing files with its name the rows are from.
PIECE = "piece"


def store_path(root: str, system: str | System) -> str:
    return f"{root.rstrip('/')}/{get_system(system).name}"


def municipality_path(root: str) -> str:
    return f"{root.rstrip('/')}/ibge/{MUNICIPALITY_VIEW}"


def read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None, **options: str
) -> DataFrame | None:
    """A Parquet folder, or None when it does not exist or holds no data file."""
    reader = spark.read.options(**options)
    try:
        return (reader if schema is None else reader.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan_store(
    spark: SparkSession,
    root: str,
    system: str | System,
    ufs: Iterable[str] | None = None,
    merge_schema: bool = False,
    filename: bool = True,
) -> DataFrame:
    """All rows of a system's store with the virtual ``filename``; ``ufs`` prunes partitions.

    A store of typed rows written by this package has the canonical schema throughout and is
    read under it without opening a single footer first.  ``merge_schema`` is for stores with other
    columns: these are united by name over all files.
    """
    spec = get_system(system)
    if merge_schema:
        rows = read_or_none(spark, store_path(root, spec), mergeSchema="true")
    else:
        rows = read_or_none(spark, store_path(root, spec), spec.schema)
    if rows is None:
        raise ValueError(f"no data files for {spec.name} below {root}")
    if filename:
        rows = rows.withColumn("filename", F.col("_metadata.file_path"))
    names = rows.columns if merge_schema else [*spec.schema.names, *(["filename"] if filename else [])]
    texts = ("uf", "source_file")
    rows = rows.select(
        [C.quoted(n).cast("string").alias(n) if n in texts else C.quoted(n) for n in names if n != PIECE]
    )
    return rows if ufs is None else rows.where(F.col("uf").isin(*[uf.upper() for uf in ufs]))


def data_files(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Data files of a store: path, name, state, size and modification time; contents stay unread."""
    spec = get_system(system)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(store_path(root, spec))
    )
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.regexp_extract("path", "/uf=([^/]+)/", 1).alias("uf"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def _level(name: str) -> Column:
    """A folder level of a data file's path, without the escapes of folder names."""
    found = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))).alias(name)


def stored_files(spark: SparkSession, root: str, system: str | System) -> DataFrame | None:
    """``source_file, piece, folder, size_bytes`` of the data files of a store by file; None without a store."""
    try:
        files = data_files(spark, root, system)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return files.select(
        _level("source_file"), _level(PIECE), F.regexp_replace("path", "/[^/]+$", "").alias("folder"), "size_bytes"
    )


def store_layout(spark: SparkSession, root: str, system: str | System) -> str | None:
    """``state`` or ``file``, from the name of the first data file found; None without any.  Other files are not listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(store_path(root, system))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    open_folders = [place] if files.exists(place) else []
    while open_folders:
        entries = [e for e in files.listStatus(open_folders.pop()) if e.getPath().getName()[0] not in "_."]
        for entry in entries:
            path = entry.getPath()
            if entry.isDirectory():
                open_folders.append(path)
            elif path.getName().endswith(".parquet"):
                return "file" if "/source_file=" in path.toString() else "state"
    return None


def enriched(rows: DataFrame, system: str | System, municipalities: DataFrame | None) -> DataFrame:
    """What users query: the raw rows with residence columns and code labels."""
    spec = get_system(system)
    return with_labels(with_municipality(rows, municipalities, spec.residence), spec)


def register_views(spark: SparkSession, root: str, merge_schema: bool = False) -> list[str]:
    """Temp views ``<system>_all`` (raw) and ``<system>`` (enriched) for every system with data.

    All live in one session, so a query may join or union systems.
    """
    made = []
    municipalities = read_or_none(spark, municipality_path(root))
    if municipalities is not None:
        municipalities.createOrReplaceTempView(MUNICIPALITY_VIEW)
        made.append(MUNICIPALITY_VIEW)
    for name, spec in REGISTRY.items():
        try:
            rows = scan_store(spark, root, spec, merge_schema=merge_schema)
        except ValueError:
            continue
        rows.createOrReplaceTempView(f"{name}_all")
        enriched(rows, spec, municipalities).createOrReplaceTempView(name)
        made += [f"{name}_all", name]
    return made
