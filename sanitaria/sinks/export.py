"""Exports: delimited text, JSON, INSERT statements, capped files and copies."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.functions import columns as C
from sanitaria.operators.ask import DEFAULT_ROWS, checked_limit, sample_rows
from sanitaria.operators.predicates import date_range
from sanitaria.operators.profile import summarize
from sanitaria.session import scratch_dir
from sanitaria.sinks.store import observed
from sanitaria.systems import System, get_system

CAP_ROWS = 1_000_000
CAP_BYTES = 1_000_000_000
CAP_BATCH = 100


def resolve(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A DataFrame as it is, a query text, or a table name."""
    if isinstance(source, DataFrame):
        return source
    return spark.sql(source) if len(source.split()) > 1 else spark.table(source)


def _scalar(f: T.StructField) -> Column:
    """A field for a delimited file; an array becomes ``[a, b]`` text."""
    if not isinstance(f.dataType, T.ArrayType):
        return C.quoted(f.name)
    items = F.array_join(C.quoted(f.name).cast("array<string>"), ", ")
    return F.concat(F.lit("["), items, F.lit("]")).alias(f.name)


def _scalars(df: DataFrame) -> DataFrame:
    return df.select([_scalar(f) for f in df.schema.fields])


def export_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    _scalars(df).write.mode("overwrite").csv(path, sep=sep, header=header)


def export_json(df: DataFrame, path: str) -> None:
    """One object per row."""
    df.write.mode("overwrite").json(path)


def export_sample(df: DataFrame, path: str, n: int = 1000, seed: int | None = None) -> None:
    export_csv(sample_rows(df, n, seed), path)


def export_summary(df: DataFrame, path: str) -> None:
    export_csv(summarize(df), path)


def _insert_statement(fields: list[T.StructField], table: str) -> Column:
    """``INSERT`` text of a row; quotes doubled, missing values ``NULL``."""

    def literal(f: T.StructField) -> Column:
        text = _scalar(f).cast("string")
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            text = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    head = f"INSERT INTO {table} ({', '.join(f.name for f in fields)}) VALUES ("
    return F.concat(F.lit(head), F.concat_ws(", ", *map(literal, fields)), F.lit(");"))


def insert_statements(df: DataFrame, table: str) -> DataFrame:
    return df.select(_insert_statement(df.schema.fields, table).alias("statement"))


def export_inserts(df: DataFrame, table: str, path: str) -> None:
    insert_statements(df, table).write.mode("overwrite").text(path)


def export_by_partition(
    df: DataFrame,
    system: str | System,
    start: date | str,
    end: date | str,
    path: str,
    partition_column: str = "source_file",
    file_format: str = "csv",
) -> None:
    """Rows of a date range, one folder ``by_<column>=<value>`` per value, in one pass.

    The rows keep all their columns.  AQE splits a value that holds many rows
    over several files.
    """
    spec = get_system(system)
    for needed in (partition_column, spec.event_date):
        if needed not in df.columns:
            raise ValueError(f"unknown column: {needed}")
    key = f"by_{partition_column}"
    keyed = (
        df.where(date_range(spec, start, end))
        .where(C.quoted(partition_column).isNotNull())
        .withColumn(key, C.quoted(partition_column))
    )
    if file_format == "csv":
        rows = _scalars(keyed)
    elif file_format == "parquet":
        rows = keyed
    elif file_format == "sql":
        rows = keyed.select(C.quoted(key), _insert_statement(df.schema.fields, spec.name).alias("value"))
    else:
        raise ValueError("file_format must be csv, parquet or sql")
    writer = rows.hint("rebalance", key).write.mode("overwrite").partitionBy(key)
    if file_format == "csv":
        writer.csv(path, sep=";", header=True)
    else:
        writer.format("text" if file_format == "sql" else "parquet").save(path)


def copy_range(
    df: DataFrame,
    system: str | System,
    start: date | str,
    end: date | str,
    target: str,
    overwrite: bool = False,
    path: str | None = None,
) -> None:
    """Rows of a date range as a new table, at ``path`` if given; an existing target is an error unless ``overwrite``."""
    writer = df.where(date_range(system, start, end)).write.mode("overwrite" if overwrite else "errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(target)


def capped_rows(
    df: DataFrame, max_rows: int = CAP_ROWS, max_bytes: int = CAP_BYTES, batch: int = CAP_BATCH
) -> DataFrame:
    """The first ``max_rows`` rows, ending with the batch of rows that reaches ``max_bytes`` of CSV.

    The caps are the feature.  Rows are first written aside with their partition and their place in it, so both
    steps below see the same ones.  Rows and bytes are summed by block of ``batch`` rows within
    each partition; partitions follow each other, and only these sums, one for each partition, meet in one
    task.  A running sum is then taken within partitions, each by itself.
    """
    spark = df.sparkSession
    lines = _scalars(df)
    numbered = lines.withColumn("_line", F.octet_length(F.to_csv(F.struct(*map(C.quoted, lines.columns)))) + 2).select(
        "*", F.monotonically_increasing_id().alias("_id")
    )
    path = scratch_dir(spark, "capped")
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_part", F.shiftright("_id", 33))
    place = Window.partitionBy("_part").orderBy("_id")
    sums = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("_line").alias("_bytes"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0)
    starts = sums.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), nothing).alias("_rows_before"),
        F.coalesce(F.sum("_bytes").over(before), nothing).alias("_bytes_before"),
    ).where((F.col("_rows_before") < max_rows) & (F.col("_bytes_before") < max_bytes))
    header = len(",".join(df.columns)) + 2
    at = F.col("_rows_before") + F.row_number().over(place) - 1
    sent = F.col("_bytes_before") + F.sum("_line").over(place) - F.col("_line") + header
    counted = rows.join(F.broadcast(starts), "_part").withColumns({"_at": at, "_sent": sent})
    # A row belongs to a batch of rows; what was sent before the batch decides about all of it.
    block = Window.partitionBy("_batch")
    kept = (
        counted.where(F.col("_at") < max_rows)
        .withColumn("_batch", F.floor(F.col("_at") / batch))
        .withColumn("_first", F.min("_sent").over(block))
        .where(F.col("_first") < max_bytes)
    )
    return kept.orderBy("_at").select([C.quoted(n) for n in lines.columns])


@dataclass(frozen=True)
class Capped:
    """What a capped export has written, and whether it left rows out."""

    rows: int
    total: int

    @property
    def cut(self) -> bool:
        return self.rows < self.total


def export_capped(
    spark: SparkSession,
    source: DataFrame | str,
    path: str,
    max_rows: int = CAP_ROWS,
    max_bytes: int = CAP_BYTES,
) -> Capped:
    """A query result as CSV within the row and byte caps; says how many of its rows that are."""
    rows, total, kept = resolve(spark, source), Observation(), Observation()
    counted = rows.observe(total, F.count(F.lit(1)).alias("n"))
    capped = capped_rows(counted, max_rows, max_bytes).observe(kept, F.count(F.lit(1)).alias("n"))
    capped.coalesce(1).write.mode("overwrite").csv(path, header=True)  # one file, which the caps bound
    return Capped(observed(kept, "n"), observed(total, "n"))


def export_limited(spark: SparkSession, source: DataFrame | str, path: str, limit: int = DEFAULT_ROWS) -> None:
    """The ordinary small export: ``limit`` rows; more than the general maximum are refused."""
    rows = resolve(spark, source).limit(checked_limit(limit))
    _scalars(rows).write.mode("overwrite").csv(path, header=True)
