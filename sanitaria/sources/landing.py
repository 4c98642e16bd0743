"""Landing files: rows of text plus the state and file they came from."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.sources.store import PIECE
from sanitaria.systems import System, get_system


def header_name(name: str) -> str:
    """A source header without NUL, tab and line characters, stripped, in lower case."""
    return name.translate(str.maketrans("", "", "\x00\t\n\r")).strip().lower()


def as_text(rows: DataFrame) -> DataFrame:
    """Every column as text under its tidy header name; blanks become NULL."""
    return rows.select(
        [
            F.when(F.trim(C.quoted(name).cast("string")) != "", C.quoted(name).cast("string")).alias(header_name(name))
            for name in rows.columns
        ]
    )


def with_origin(rows: DataFrame, system: str | System, path: Column) -> DataFrame:
    """Adds ``source_file``, the name of the published file, the ``uf`` parsed from it, and ``piece``.

    ``piece`` tells landing files apart that carry the same published name: it is a hash of the path.
    """
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?i)\.(csv|parquet|txt|dbf)$", ".dbc")
    piece = F.lower(F.hex(F.xxhash64(F.regexp_replace(path, "^[a-z]+:/*", ""))))
    placed = rows.withColumns({"source_file": name, PIECE: piece})
    return placed.withColumn("uf", get_system(system).period(F.col("source_file"))["uf"])


def landing_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files below folders, patterns and paths; their contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    return sorted(row["path"] for row in files.collect())


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine() or ""
    finally:
        stream.close()


def by_header(
    spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8", failed: list[tuple[str, str]] | None = None
) -> list[list[str]]:
    """Files grouped by their first line; the lines are fetched by the driver, several at a time.

    A folder as Spark writes it has one header, and a load has hundreds of files: this is the same kind of
    work as listing them.  Files without a line have no rows either and are left out.  With ``failed``, a file that
    cannot be opened is noted there with the reason, and so is one without a header; otherwise the first raises.
    """

    def first(path: str) -> str | tuple[str, str]:
        try:
            return _first_line(spark, path, encoding)
        except Py4JJavaError as error:
            if failed is None:
                raise
            return path, str(error.java_exception)

    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(first, files))
    groups: dict[str, list[str]] = {}
    for path, line in zip(files, lines, strict=True):
        if isinstance(line, tuple):
            failed.append(line)
        elif line.strip():
            groups.setdefault(line.strip("\ufeff\r"), []).append(path)
        elif failed is not None:
            failed.append((path, "no header"))
    return list(groups.values())


#: Column of the reader that holds a line whose fields do not fit its header.
_CORRUPT = "__corrupt"
#: What undecodable bytes become when a file is read.
_NO_LETTER = "\ufffd"
REJECT_SCHEMA = "source_file string, piece string, path string, line bigint, reason string, text string"


@dataclass(frozen=True)
class Landing:
    """Landing rows that fit their headers, the lines that do not, and the files that cannot be read."""

    rows: DataFrame
    rejected: DataFrame
    files: list[str]
    failed: list[tuple[str, str]] = field(default_factory=list)


def _csv_rows(spark: SparkSession, group: list[str], sep: str, encoding: str) -> DataFrame:
    """All lines of files with one header as text columns, those that do not fit it with ``_CORRUPT``."""
    options = {"header": "true", "sep": sep, "encoding": encoding}
    names = spark.read.options(**options).csv(group).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    # Without pruning every line is split whole, so that fields are counted whatever columns are asked for.
    checked = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": "false", "enforceSchema": "true"}
    return spark.read.schema(schema).options(**options, **checked).csv(group)


def _undecoded(rows: DataFrame) -> Column:
    named = [C.quoted(n) for n in rows.columns if n != _CORRUPT]
    return F.contains(F.concat_ws("", *named), F.lit(_NO_LETTER))


def _lines(spark: SparkSession, group: list[str], encoding: str) -> DataFrame:
    """``path, line, text`` of all lines that are not blank, numbered from the header's 1, file by file.

    A file is read in blocks by many tasks; lines are numbered within each block, and blocks are counted on.  Rows are
    numbered as they are read and a block's first number is taken off, so no text is moved.
    """
    options = {"header": "false", "sep": "\x01", "quote": "", "encoding": encoding, "lineSep": "\n"}
    text = spark.read.schema("text string").options(**options).csv(group).select(
        "text", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
    )
    text = text.where(F.trim(F.rtrim(F.col("text"), F.lit("\r"))) != "").withColumn("row", F.monotonically_increasing_id())
    blocks = text.groupBy("path", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return text.join(F.broadcast(blocks), ["path", "block"]).select(
        "path", (F.col("row") + F.col("shift") + 1).cast("bigint").alias("line"), F.rtrim(F.col("text"), F.lit("\r")).alias("text")
    )


def _rejected(spark: SparkSession, system: str | System, group: list[str], sep: str, encoding: str) -> DataFrame:
    rows = _csv_rows(spark, group, sep, encoding)
    path = F.col("_metadata.file_path")
    # The reader gives that column only along with another one.
    unfit = rows.select(F.rtrim(F.col(_CORRUPT), F.lit("\r")).alias("text"), path.alias("path"), C.quoted(rows.columns[0]).alias("first"))
    unfit = unfit.where("text IS NOT NULL").distinct()
    lines = _lines(spark, group, encoding).where("line > 1")
    found = lines.join(unfit.withColumn("reason", F.lit("fields")), ["path", "text"], "left")
    letters = F.when(F.contains("text", F.lit(_NO_LETTER)), F.lit("bytes"))
    found = found.withColumn("reason", F.coalesce("reason", letters)).where("reason IS NOT NULL")
    return with_origin(found, system, F.col("path")).select("source_file", PIECE, "path", "line", "reason", "text")


def scan_checked(
    spark: SparkSession, system: str | System, paths: Sequence[str], sep: str = ";", encoding: str = "UTF-8"
) -> Landing:
    """Delimited landing files as ``scan_landing`` reads them, and with them what could not be read.

    Every line below a header is either a row or rejected: ``fields`` where it has more or fewer fields than the
    header, ``bytes`` where bytes are none of the encoding.  Rejected lines keep file, number (blank lines do not
    count) and text.  Files that cannot be opened or have no header are listed with the reason; the others are read.
    """
    files, failed = landing_files(spark, [paths] if isinstance(paths, str) else paths), []
    groups = by_header(spark, files, encoding, failed)
    bad = {path for path, _ in failed}
    files = [f for f in files if f not in bad]
    none = spark.createDataFrame([], REJECT_SCHEMA)
    rejected = reduce(DataFrame.unionByName, [_rejected(spark, system, g, sep, encoding) for g in groups], none)
    if not groups:
        rows = spark.createDataFrame([], f"source_file string, {PIECE} string, uf string")
        return Landing(rows, rejected, files, failed)
    return Landing(scan_landing(spark, system, groups, "csv", sep, encoding), rejected, files, failed)


def scan_landing(
    spark: SparkSession,
    system: str | System,
    paths: Sequence[str] | Sequence[Sequence[str]],
    file_format: str = "csv",
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Rows of all landing files as text, with ``uf``, ``source_file`` and ``piece``.

    Every file is read by its own header: CSV files are grouped by their first line, and the groups,
    one scan each, are united by name, so columns may come in any order and may come and go.
    Parquet files may differ freely as well.  Fixed-width files (``dbf``) bring their own field table.
    Lines of CSV files that have more or fewer fields than their header, or bytes that are none of the encoding, are no
    rows; ``scan_checked`` gives them as well.
    """
    from sanitaria.sources.fixed_width import scan_fixed_width

    flat = [paths] if isinstance(paths, str) else [q for p in paths for q in ([p] if isinstance(p, str) else p)]
    if file_format == "csv":
        groups = by_header(spark, landing_files(spark, flat), encoding)
        if not groups:
            raise ValueError("no landing file with a header")
    else:
        groups = [flat]

    def scan(group: list[str]) -> DataFrame:
        if file_format == "dbf":
            return scan_fixed_width(spark, system, group)
        if file_format == "csv":
            lines = _csv_rows(spark, group, sep, encoding)
            rows = lines.where(C.quoted(_CORRUPT).isNull() & ~_undecoded(lines))
        else:
            reader = spark.read.format(file_format)
            rows = (reader.option("mergeSchema", "true") if file_format == "parquet" else reader).load(group)
        text = as_text(rows.select(*(C.quoted(n) for n in rows.columns if n != _CORRUPT), F.col("_metadata.file_path").alias("__file")))
        return with_origin(text, system, F.col("__file")).drop("__file")

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(scan, groups))
