"""Writes derived raw rows as source files under their published names.

Spark names its own output files, while the landing scans read state and period
from names such as ``DOSP2015.csv``, so the tasks write these files themselves.
A file name may occur in several folders: a source with many rows is split over
tasks, never gathered into one.
"""

from __future__ import annotations

import struct

from pyspark import TaskContext
from pyspark.sql import DataFrame


def _csv_bytes(rows) -> bytes:
    return rows.to_csv(sep=";", index=False).encode()


def _ragged_bytes(rows) -> bytes:
    """Delimited text in which some lines, told by the last digit of ``idade``, do not fit the header or are no UTF-8."""
    head, *lines = rows.to_csv(sep=";", index=False).encode().splitlines()
    unfit = {"3": lambda x: x + b";MORE", "7": lambda x: x.split(b";")[0], "9": lambda x: b"\xff" + x}
    marked = [unfit.get(str(mark)[-1:], bytes)(line) for line, mark in zip(lines, rows["idade"], strict=True)]
    return b"\n".join([head, *marked, b""])


def _dbf_bytes(rows) -> bytes:
    """Header, one text field per column, fixed-length records, end mark."""
    columns = list(rows.columns)
    values = [[v.encode("latin-1") for v in rows[c].fillna("").tolist()] for c in columns]
    widths = [max(1, *map(len, column)) for column in values]
    header = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), 33 + 32 * len(columns), 1 + sum(widths))
    fields = b"".join(struct.pack("<11sc4xBB14x", c.encode(), b"C", w, 0) for c, w in zip(columns, widths))
    records = b"".join(b" " + b"".join(v.ljust(w) for v, w in zip(row, widths)) for row in zip(*values))
    return header + fields + b"\r" + records + b"\x1a"


def write_named_files(df: DataFrame, folder: str, kind: str) -> str:
    """One ``<stem>.<kind>`` per source file and task below ``folder``; gives the folder.

    ``ragged`` writes ``csv`` files with lines that are no rows.  Rows of a task come file by file, so a delimited file is
    written batch after batch; records of fixed width need the widths first, so each batch has files of its own.
    """
    encode, kind = {"csv": (_csv_bytes, "csv"), "dbf": (_dbf_bytes, "dbf"), "ragged": (_ragged_bytes, "csv")}[kind]

    def write(batches):
        import pandas as pd
        from pyarrow.fs import FileSystem

        system, location = FileSystem.from_uri(folder)
        task, current, file = TaskContext.get().partitionId(), None, None
        for number, batch in enumerate(batches):
            place = f"{location}/t{task:05d}" + (f"-{number:05d}" if kind == "dbf" else "")
            system.create_dir(place, recursive=True)
            for name, rows in batch.groupby("source_file"):
                content, path = encode(rows.drop(columns=["uf", "source_file"])), f"{place}/{name.replace('.dbc', '.' + kind)}"
                if path == current:
                    file.write(content.split(b"\n", 1)[1])  # has its header
                    continue
                if file:
                    file.close()
                current, file = path, system.open_output_stream(path)
                file.write(content)
            yield pd.DataFrame({"n": [len(batch)]})
        if file:
            file.close()

    rows = df.hint("rebalance", "source_file").sortWithinPartitions("source_file")
    rows.mapInPandas(write, "n bigint").agg({"n": "sum"}).collect()
    return folder
