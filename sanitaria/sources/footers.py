"""Facts that Parquet footers hold about a store's columns, read by tasks; no row is read."""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files whose footers one task opens, about.
FILES_PER_TASK = 64
#: Folder name that stands for a missing value of a partition column. Fixed value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
SCHEMA = (
    "path string, column string, rows bigint, nulls bigint, repeated boolean, low_int bigint, high_int bigint, "
    "low_real double, high_real double, low_text string, high_text string, bounded boolean, bytes bigint"
)


def _open(path: str):
    """A Parquet file's metadata, through Arrow's file systems; plain and ``file:`` paths are local ones."""
    from pyarrow.fs import FileSystem, LocalFileSystem
    from pyarrow.parquet import ParquetFile

    local = re.sub(r"^file:/+", "/", path)
    system, place = (LocalFileSystem(), local) if local.startswith("/") else FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        return ParquetFile(file).metadata


def _bounds(low, high) -> tuple:
    """Bounds in the pair of columns for their kind: whole numbers, other numbers, or text that sorts as the values do."""
    if isinstance(low, bool) or isinstance(low, int):
        return int(low), int(high), None, None, None, None, True
    if isinstance(low, float):
        return None, None, low, high, None, None, True
    if isinstance(low, (datetime.date, datetime.datetime, str)):
        return None, None, None, None, str(low), str(high), True
    return None, None, None, None, None, None, False


def file_facts(path: str) -> list[tuple]:
    """One row of each top-level column of a file, and one without a column for the file itself."""
    meta = _open(path)
    found: dict[str, list] = {}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            chunk = group.column(c)
            own = found.setdefault(chunk.path_in_schema.split(".")[0], [0, "." in chunk.path_in_schema, [], True, 0])
            stats = chunk.statistics
            if own[0] is not None:
                own[0] = own[0] + stats.null_count if stats is not None and stats.has_null_count else None
            if stats is not None and stats.has_min_max:
                own[2].append((stats.min, stats.max))
            elif stats is None or stats.null_count != group.num_rows:
                own[3] = False  # rows without bounds that are not all missing
            own[4] += chunk.total_compressed_size
    rows = []
    for name, (nulls, repeated, pairs, bounded, size) in found.items():
        kept = bounded and not repeated
        each = _bounds(min(a for a, _ in pairs), max(b for _, b in pairs)) if pairs and kept else (*[None] * 6, kept)
        rows.append((path, name, meta.num_rows, nulls, repeated, *each, size))
    return [(path, None, meta.num_rows, None, None, *[None] * 7, None), *rows]


def footer_facts(files: DataFrame) -> DataFrame:
    """``file_facts`` of all ``files`` (rows with a ``path``), a bundle of files a task.

    An unreadable file fails the job; an empty listing gives no rows; a path listed twice counts once.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [row for path in batch["path"] for row in file_facts(path)]
            table = pd.DataFrame(rows, columns=names)
            whole = {n: "Int64" for n in ("rows", "nulls", "low_int", "high_int", "bytes")}
            yield table.astype(whole | {"repeated": "boolean", "bounded": "boolean"})

    paths = files.select("path").distinct()
    tasks = max(1, -(-paths.count() // FILES_PER_TASK))
    return paths.repartition(tasks).mapInPandas(run, SCHEMA)


def column_facts(files: DataFrame, partitions: list[str]) -> list:
    """The facts summed by column, on the driver: one row of each column of the store, its partition columns included.

    ``rows`` are those of the files that have the column, ``nulls`` is None if some chunk does not say; the row
    without a column holds the rows of all files.
    """
    facts = footer_facts(files)
    sums = [
        F.sum("rows").alias("rows"), F.when(F.count_if(F.col("nulls").isNull()) == 0, F.sum("nulls")).alias("nulls"),
        F.bool_or("repeated").alias("repeated"), F.bool_and("bounded").alias("bounded"), F.sum("bytes").alias("bytes"),
        *(pick(f"{side}_{kind}").alias(f"{side}_{kind}") for side, pick in (("low", F.min), ("high", F.max)) for kind in ("int", "real", "text")),
    ]
    # A partition column is a folder name: filled in all rows of a file, or in none.
    levels = F.array(*(
        F.struct(F.lit(p).alias("column"), F.regexp_extract("path", f"/{p}=([^/]+)/", 1).alias("value")) for p in partitions
    ))
    named = facts.filter("column IS NULL").select("path", "rows", F.inline(levels)) if partitions else None
    if named is not None:
        value = F.when(F.col("value") != NO_VALUE, F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B"))))
        folders = named.select(
            "path", "column", "rows", F.when(value.isNull(), F.col("rows")).otherwise(F.lit(0)).alias("nulls"),
            F.lit(False).alias("repeated"), F.lit(None).cast("bigint").alias("low_int"), F.lit(None).cast("bigint").alias("high_int"),
            F.lit(None).cast("double").alias("low_real"), F.lit(None).cast("double").alias("high_real"),
            value.alias("low_text"), value.alias("high_text"), F.lit(True).alias("bounded"), F.lit(0).cast("bigint").alias("bytes"),
        )
        facts = facts.unionByName(folders)
    return facts.groupBy("column").agg(*sums).collect()
