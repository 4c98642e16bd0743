"""Which source files were loaded: an append-only log of numbered events.

Adding, removing and clearing append rows and never rewrite any.  Every writer first claims a
number by creating a file of that name, which fails if another writer has it, and then writes its events
into a folder of that number, so loads that run at once neither share a number nor a folder.  Numbers have no
gaps: who holds one knows that all smaller ones are taken.  The current state is the event of the highest number per
file, whatever the clocks say.

From time to time a writer sums the log up: one row for each file and action, the highest number
covered, and the numbers below it whose events were not written yet.  Readers open the newest sum and
the folders that it does not cover.  Nothing is deleted, so a sum that dies half-way, or two at once, do no harm.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sanitaria.sources.inventory import with_period
from sanitaria.sources.store import read_or_none, scan_store, store_layout, stored_files
from sanitaria.systems import System, get_system

SCHEMA = "system string, source_file string, piece string, action string, at timestamp, number bigint"
#: Event folders beyond the newest sum at which the log is summed up again.
SUM_EVERY = 20


def manifest_path(root: str) -> str:
    """Events of older logs: one folder for all."""
    return f"{root.rstrip('/')}/catalog/manifest"


def events_path(root: str) -> str:
    return f"{manifest_path(root)}_events"


def sums_path(root: str) -> str:
    return f"{manifest_path(root)}_sums"


def claims_path(root: str) -> str:
    return f"{manifest_path(root)}_claims"


def _numbers(spark: SparkSession, folder: str, complete: bool = False) -> list[int]:
    """Names in a folder that are numbers, ascending; with ``complete`` those of folders that a job has committed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    names = sorted(int(f.getPath().getName()) for f in system.listStatus(place) if f.getPath().getName().isdigit())
    done = lambda n: system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))
    return [n for n in names if done(n)] if complete else names


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one of that name.

    Stores that can create only what is absent do so in one step.  The local file system of the driver is
    asked directly, since Hadoop's looks first and creates then.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    uri = system.makeQualified(place).toUri()
    if uri.getScheme() == "file":
        try:
            os.close(os.open(uri.getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        system.create(place, False).close()
    except Exception:  # whatever the store calls it: taken, if it is there now
        if system.exists(place):
            return False
        raise
    return True


def claim(spark: SparkSession, root: str) -> int:
    """The next number, which no other writer has or gets."""
    folder = claims_path(root)
    taken = _numbers(spark, folder)
    if taken:
        number = taken[-1] + 1
    else:
        old = read_or_none(spark, manifest_path(root), T._parse_datatype_string(SCHEMA))
        number = 1 if old is None else (_numbered(old).agg(F.max("number")).first()[0] or 0) + 1
    while not create_new(spark, f"{folder}/{number}"):
        number += 1
    return number


def _numbered(old: DataFrame) -> DataFrame:
    """Events of the oldest logs are numbered by their time."""
    return old.withColumn("number", F.coalesce("number", F.unix_micros("at")))


def _sum_folder(spark: SparkSession, root: str) -> str | None:
    done = _numbers(spark, sums_path(root), complete=True)
    return f"{sums_path(root)}/{done[-1]}" if done else None


def _uncovered(spark: SparkSession, root: str, newest: str | None) -> list[int]:
    """Numbers of event folders that a sum does not hold."""
    names = _numbers(spark, events_path(root))
    if newest is None:
        return names
    facts = spark.read.schema(SCHEMA).parquet(newest).where("action in ('covered', 'pending')")
    found = facts.select("action", "number").collect()  # one row, and one for each load that died or was under way
    top = max(r.number for r in found if r.action == "covered")
    pending = {r.number for r in found if r.action == "pending"}
    return [n for n in names if n > top or n in pending]


def _events(spark: SparkSession, root: str, newest: str | None, numbers: list[int]) -> DataFrame:
    """The events of a sum, or else of an older log, and those of some event folders."""
    log = spark.createDataFrame([], SCHEMA)
    if newest is not None:
        log = spark.read.schema(SCHEMA).parquet(newest).where("action not in ('covered', 'pending')")
    else:
        old = read_or_none(spark, manifest_path(root), T._parse_datatype_string(SCHEMA))
        log = log if old is None else _numbered(old)
    if numbers:
        log = log.unionAll(spark.read.schema(SCHEMA).parquet(*(f"{events_path(root)}/{n}" for n in numbers)))
    return log


def _read(spark: SparkSession, root: str, system: System) -> DataFrame:
    """Events of a system that still matter."""
    newest = _sum_folder(spark, root)
    return _events(spark, root, newest, _uncovered(spark, root, newest)).where(F.col("system") == system.name)


def sum_up(spark: SparkSession, root: str) -> None:
    """Sum the log up, from the newest sum and the committed event folders that it does not cover."""
    newest = _sum_folder(spark, root)
    committed = set(_numbers(spark, events_path(root), complete=True))
    ready = [n for n in _uncovered(spark, root, newest) if n in committed]
    if not ready:
        return
    top = max(committed)
    # Below a committed number all are claimed: what is not committed was given up or may still come.
    pending = [n for n in _numbers(spark, claims_path(root)) if n < top and n not in committed]
    held = _events(spark, root, newest, ready).groupBy("system", "source_file", "piece", "action").agg(
        F.max("at").alias("at"), F.max("number").alias("number")
    )
    facts = [(None, None, None, "covered", None, top), *((None, None, None, "pending", None, n) for n in pending)]
    number = claim(spark, root)
    held.select(*T._parse_datatype_string(SCHEMA).names).unionAll(spark.createDataFrame(facts, SCHEMA)).write.parquet(
        f"{sums_path(root)}/{number}"
    )


def _log(files: DataFrame, root: str, system: str | System, action: str) -> None:
    spec, spark = get_system(system), files.sparkSession
    piece = F.col("piece") if "piece" in files.columns else F.lit(None)
    number = claim(spark, root)
    events = files.select("source_file", piece.cast("string").alias("piece")).distinct().select(
        F.lit(spec.name).alias("system"), "source_file", "piece", F.lit(action).alias("action"),
        F.current_timestamp().alias("at"), F.lit(number).cast("long").alias("number"),
    )
    events.coalesce(1).write.parquet(f"{events_path(root)}/{number}")
    if len(_uncovered(spark, root, _sum_folder(spark, root))) >= SUM_EVERY:
        sum_up(spark, root)


def add_files(files: DataFrame, root: str, system: str | System) -> None:
    """Mark the ``source_file`` values of a table as loaded."""
    _log(files, root, system, "add")


def remove_files(files: DataFrame, root: str, system: str | System) -> None:
    _log(files, root, system, "remove")


def clear(spark: SparkSession, root: str, system: str | System) -> None:
    """Forget all files of a system."""
    _log(spark.createDataFrame([(None,)], "source_file string"), root, system, "clear")


def migrate_list(spark: SparkSession, names: list[str], root: str, system: str | System) -> None:
    """Take over the flat name list of an older manifest."""
    add_files(spark.createDataFrame([(n,) for n in names], "source_file string"), root, system)


def listed_files(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Loaded files now: ``uf, position, source_file, year, month``, oldest first within a state.

    Names that do not parse come last, under the state of their third and
    fourth character.
    """
    spec = get_system(system)
    return with_positions(listed_pieces(spark, root, spec).select("source_file").distinct(), spec)


def listed_pieces(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """``source_file, piece`` of all loaded landing files; a removal by name takes all pieces of the file."""
    log = _read(spark, root, get_system(system))
    cleared = log.where(F.col("action") == "clear").agg(F.max("number")).scalar()
    added = log.where(F.col("action") == "add").groupBy("source_file", "piece").agg(F.max("number").alias("added"))
    removed = log.where(F.col("action") == "remove").groupBy("source_file").agg(F.max("number").alias("removed"))
    last = F.greatest(F.coalesce("removed", F.lit(-1)), F.coalesce(cleared, F.lit(-1)))
    return added.join(removed, "source_file", "left").where(F.col("added") > last).select("source_file", "piece")


def with_positions(files: DataFrame, system: str | System) -> DataFrame:
    """Distinct file names numbered per state by period; names that do not parse come last."""
    placed = with_period(files, system, "source_file").withColumn(
        "uf", F.coalesce("uf", F.upper(F.substring("source_file", 3, 2)))
    )
    order = Window.partitionBy("uf").orderBy(
        F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last(), "source_file"
    )
    return placed.select("uf", F.row_number().over(order).alias("position"), "source_file", "year", "month")


def processed_files(spark: SparkSession, root: str, system: str | System) -> DataFrame:
    """Names of loaded files: the manifest if it lists any, else the store's own column."""
    listed = listed_files(spark, root, system).select("source_file")
    if not listed.isEmpty():
        return listed
    if store_layout(spark, root, system) == "file":
        return stored_files(spark, root, system).select("source_file").distinct()
    try:
        rows = scan_store(spark, root, system, filename=False)
    except ValueError:
        return listed
    return rows.select("source_file").where("source_file is not null").distinct()
