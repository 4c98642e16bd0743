"""Fixed-width record files (DBF) as a splittable Spark data source.

Records have one length, so a file is cut at record boundaries and every task
reads its own records.  The driver lists files and cuts them by their sizes alone; headers are
opened by the tasks.  Files are opened through Arrow file systems: a shared
mount or any storage Arrow has a driver for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from sanitaria.sources.landing import as_text, with_origin
from sanitaria.systems import System

FORMAT = "fixed_width_records"
FILE_COLUMN = "__file"
# Layout of the file header and its field descriptors, end of header, mark of a deleted record.
HEADER_SIZE = 32
DESCRIPTOR_SIZE = 32
HEADER_END = 0x0D
DELETED = ord("*")


@dataclass(frozen=True)
class Layout:
    records: int
    header: int
    width: int
    fields: tuple[tuple[str, int, int], ...]


def _file_system(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def record_files(path: str) -> list[tuple[str, int]]:
    """Path and size of the file itself, or of all record files below a folder; several paths stand on lines of their own."""
    from pyarrow.fs import FileSelector, FileType

    if "\n" in path:
        return sorted({found for one in path.split("\n") for found in record_files(one)})
    system, location = _file_system(path)
    info = system.get_file_info(location)
    if info.type == FileType.File:
        return [(path, info.size)]
    scheme = path[: len(path) - len(location)] if path.endswith(location) else ""
    found = system.get_file_info(FileSelector(location, recursive=True))
    return sorted((scheme + f.path, f.size) for f in found if f.is_file and f.path.lower().endswith(".dbf"))


def read_layout(path: str) -> Layout:
    """Record count, header and record length, and ``(name, offset, length)`` per field."""
    system, location = _file_system(path)
    with system.open_input_file(location) as file:
        records, header, width = struct.unpack("<IHH", file.read(HEADER_SIZE)[4:12])
        descriptors = file.read(header - HEADER_SIZE)
        present = max(0, file.size() - header) // width
    fields, offset = [], 1
    for at in range(0, len(descriptors) - DESCRIPTOR_SIZE + 1, DESCRIPTOR_SIZE):
        entry = descriptors[at : at + DESCRIPTOR_SIZE]
        if entry[0] == HEADER_END:
            break
        fields.append((entry[:11].split(b"\x00")[0].decode("latin-1").strip().lower(), offset, entry[16]))
        offset += entry[16]
    return Layout(min(records, present), header, width, tuple(fields))


@dataclass(frozen=True)
class RecordRange:
    """Share ``part`` of ``parts`` nearly equal ones of a file's records; which these are its header tells the task."""

    path: str
    part: int = 0
    parts: int = 1

    def records(self, layout: Layout) -> range:
        return range(layout.records * self.part // self.parts, layout.records * (self.part + 1) // self.parts)


@dataclass
class RecordRanges(InputPartition):
    ranges: list[RecordRange]


class RecordReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.path = options["path"]
        self.encoding = options.get("encoding", "latin-1")
        self.split_bytes = int(options.get("splitbytes", 64 << 20))
        self.batch = int(options.get("batchrecords", 65_536))

    def partitions(self) -> list[RecordRanges]:
        """Large files are cut, small ones packed together, by their sizes; no file is opened."""
        tasks: list[RecordRanges] = []
        room = 0
        for path, size in record_files(self.path):
            if size > self.split_bytes:
                parts = -(-size // self.split_bytes)
                tasks += [RecordRanges([RecordRange(path, part, parts)]) for part in range(parts)]
                room = 0
            elif size > room:
                tasks.append(RecordRanges([RecordRange(path)]))
                room = self.split_bytes - size
            else:
                tasks[-1].ranges.append(RecordRange(path))
                room -= size
        return tasks

    def read(self, partition: RecordRanges | None) -> Iterator:
        """Without any file Spark runs one task, which has no ranges."""
        for part in partition.ranges if partition else ():
            yield from self._records(part)

    def _records(self, part: RecordRange) -> Iterator:
        import numpy as np
        import pyarrow as pa

        layout = read_layout(part.path)
        own = part.records(layout)
        place = {name: (offset, length) for name, offset, length in layout.fields}
        system, location = _file_system(part.path)
        with system.open_input_file(location) as file:
            file.seek(layout.header + own.start * layout.width)
            for start in range(0, len(own), self.batch):
                n = min(self.batch, len(own) - start)
                records = np.frombuffer(file.read(n * layout.width), dtype=np.uint8).reshape(-1, layout.width)
                records = records[records[:, 0] != DELETED]
                columns = [
                    pa.array([part.path] * len(records), pa.string())
                    if name == FILE_COLUMN
                    else self._text(records, *place[name])
                    if name in place
                    else pa.nulls(len(records), pa.string())
                    for name in self.names
                ]
                yield pa.RecordBatch.from_arrays(columns, names=self.names)

    def _text(self, records, offset: int, length: int):
        """One field of all records; plain ASCII, the usual case, is not copied value by value."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        field = np.ascontiguousarray(records[:, offset : offset + length])
        if field.size and field.max() < 128:
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(field), [None, pa.py_buffer(field)])
            text = raw.cast(pa.binary()).cast(pa.string())
        else:
            text = pa.array(np.char.decode(field.view(f"S{length}").ravel(), self.encoding).tolist(), pa.string())
        return pc.utf8_trim(text, characters=" \x00")


def field_names(path: str) -> list[str]:
    return [name for name, _, _ in read_layout(path).fields]


def record_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in [*dict.fromkeys(names), FILE_COLUMN]])


def layouts(spark: SparkSession, path: str) -> DataFrame:
    """``names, first, files``: the distinct field lists of all files, the first file of each and how many have it.

    Headers are opened by tasks, some hundred files each; files are told apart only by their names in order.
    """
    files = [(found,) for found, _ in record_files(path)]
    tasks = max(1, min(len(files), spark.sparkContext.defaultParallelism, -(-len(files) // 100)))

    def opened(batches):
        for batch in batches:
            yield batch.assign(names=[field_names(p) for p in batch["path"]])

    listed = spark.createDataFrame(files, "path string").repartition(tasks)
    found = listed.mapInPandas(opened, "path string, names array<string>")
    return found.groupBy("names").agg(F.min("path").alias("first"), F.count("*").alias("files"))


class FixedWidthRecords(DataSource):
    """``spark.read.format("fixed_width_records").load(path)``; all columns are text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        """Field names of all files, in order of first appearance; ``scan_fixed_width`` has tasks read the headers."""
        return record_schema(name for path, _ in record_files(self.options["path"]) for name in field_names(path))

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(schema, dict(self.options))


def scan_fixed_width(
    spark: SparkSession, system: str | System, path: str | Sequence[str], schema: StructType | None = None, **options
) -> DataFrame:
    """Record files as landing rows: text columns plus ``uf``, ``source_file`` and ``piece``.

    Without ``schema`` a job reads the headers for the field names; the driver gets one row for each distinct
    layout, of which a published series has a few.  Files themselves are opened by tasks only.
    """
    spark.dataSource.register(FixedWidthRecords)
    where = path if isinstance(path, str) else "\n".join(path)
    if schema is None:
        known = sorted(layouts(spark, where).collect(), key=lambda r: r["first"])
        schema = record_schema(name for layout in known for name in layout["names"])
    rows = spark.read.format(FORMAT).options(**options).schema(schema).load(where)
    return with_origin(as_text(rows), system, F.col(FILE_COLUMN)).drop(FILE_COLUMN)
