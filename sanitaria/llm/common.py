"""What the operators share: table access, written intermediate tables, ASCII words and word counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sanitaria.llm.bytewords import slices
from sanitaria.session import remove_folder, scratch_dir

#: Entries of a task's partial word counts before they are sent on.
FLUSH_WORDS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, and it survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes of a batch that goes to a Python worker, for jobs whose rows hold long texts.  Spark's own batches are ten
#: thousand rows, held by the JVM and by the worker at once, twice while they grow.
TEXT_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a ``with`` block; what was set before is set again."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def text_batches(spark: SparkSession) -> None:
    """``TEXT_BATCHES`` for all later jobs of a session, but for what was set before.

    For queries, whose result is computed after they return; batch sizes change no results.
    """
    for name, value in TEXT_BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


class Scratch:
    """Tables that one operator writes and reads again, deleted as soon as nothing reads them any more.

    ``drop`` deletes some of them, the end of a ``with`` block all that are left.  Whoever returns a DataFrame that
    still reads one leaves that table to its caller's ``Scratch``, or lets it stay.  With ``sweep`` the driver's
    garbage is collected after each write, upon which Spark deletes the shuffle files of finished jobs; by itself
    it does so when the driver's memory fills, which a small driver of large jobs may never see.
    """

    def __init__(self, sweep: bool = False) -> None:
        self._held: list[tuple[DataFrame, str]] = []
        self._sweep = sweep

    def written(self, df: DataFrame, purpose: str) -> DataFrame:
        path = scratch_dir(df.sparkSession, purpose)
        df.write.parquet(path)
        table = df.sparkSession.read.schema(df.schema).parquet(path)
        self._held.append((table, path))
        if self._sweep:
            df.sparkSession._jvm.System.gc()
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table, path in self._held:
            if any(table is t for t in tables):
                remove_folder(table.sparkSession, path)
        self._held = [(t, path) for t, path in self._held if not any(t is x for x in tables)]

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*(t for t, _ in self._held))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: ``bytes.split`` splits at exactly these six bytes."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_words_of(text: str | None) -> list[bytes]:
    """The same after A-Z became a-z; ``bytes.lower`` touches no other letters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, lower: bool = True, text: str = "text") -> DataFrame:
    """``word`` (binary) and ``n``: how often each word occurs in all texts.

    Tasks count what they read before anything is shuffled and send their counts on
    whenever they hold ``FLUSH_WORDS`` words, so memory stays bounded.
    """
    split = lower_words_of if lower else words_of

    def sent(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.binary(), size=len(counts)), pa.array(counts.values(), pa.int64(), size=len(counts))],
            names=["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for own in (part for batch in batches for part in slices(batch, 0)):
            for value in own.column(0).to_pylist():
                counts.update(split(value))
                if len(counts) >= FLUSH_WORDS:
                    yield sent(counts)
                    counts.clear()
        yield sent(counts)

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _step(n: Column) -> Column:
    """Counts in steps: each small count by itself, larger ones by about a hundredth."""
    return F.floor(F.log2(n) * 64).cast("int")


def count_floor(counts: DataFrame, limit: int) -> int:
    """The lowest step with which at most ``limit`` rows of ``counts`` have it or a higher one.

    The driver gets one row for each step, some four thousand at most, and no rows are sorted.
    """
    rows = sorted(counts.groupBy(_step(F.col("n")).alias("step")).agg(F.count("*")).collect(), reverse=True)
    held, floor = 0, 1 << 30
    for step, n in rows:
        held += n
        if held > limit:
            break
        floor = step
    return floor


def at_least(counts: DataFrame, floor: int, below: bool = False) -> DataFrame:
    """Rows of that step and higher, or those below it."""
    return counts.filter((_step(F.col("n")) < floor) if below else (_step(F.col("n")) >= floor))


def head_words(counts: DataFrame, limit: int, longest: int = 64) -> pd.DataFrame:
    """The most frequent words of at most ``longest`` bytes, ``limit`` of them at most, on the driver by falling count.

    Both bounds make the result safe to send to every executor: at most ``limit * (longest + 8)`` bytes.
    Words of one step of counts are taken or left together.
    """
    short = counts.filter(F.octet_length("word") <= longest)
    found = at_least(short, count_floor(short, limit)).toPandas()
    return found.sort_values(["n", "word"], ascending=[False, True]).reset_index(drop=True)
