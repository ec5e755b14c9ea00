"""The first lines of many text files, read by tasks.

This is the one place of the order analytics that starts Python workers: a scan of built-in
functions cannot stop after the first line of a file, a worker can. A task gets one part of one
file and ends soon after the first rows, whatever the size of the file. A worker that leaves rows
unread is lost for later tasks, so what is small is read to its end.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

FIRST_LINES = "file string, header array<string>"

_PART_BYTES = str(128 << 20)
# Parts are never packed together when opening one counts as much as the most a task may read.
_ONE_PART_A_TASK = {
    "spark.sql.files.openCostInBytes": _PART_BYTES,
    "spark.sql.files.maxPartitionBytes": _PART_BYTES,
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}
_READ_ON = 32  # batches that are cheaper to read than a new worker is to start


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The fields of the first line that is not blank, by file, of files that have one.

    There is an entry per file, as there is a path per file in every scan of them.
    """
    if not paths:
        return {}
    shape = pa.schema([("file", pa.string()), ("header", pa.list_(pa.string()))])

    # Nested, so that it is sent to workers as it is and they need not have this package.
    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, read_on = False, 0
        for part in parts:
            found = found or bool(part.num_rows and part.column(1)[0].as_py())
            if found:
                read_on += 1
                if read_on > _READ_ON:
                    return
                continue
            for file, line in zip(part.column(0), part.column(2)):
                text = line.as_py().lstrip("﻿")
                if text.strip():
                    names = [name.strip() for name in next(csv.reader([text]))]
                    yield pa.RecordBatch.from_pydict({"file": [file.as_py()], "header": [names]}, schema=shape)
                    found = True
                    break

    # Settings of a session of its own, over the same application.
    own = spark.newSession()
    for key, value in _ONE_PART_A_TASK.items():
        own.conf.set(key, value)
    places = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    rows = own.read.text(paths).select(*places, "value").mapInArrow(first, FIRST_LINES).collect()
    return {row["file"]: tuple(row["header"]) for row in rows}
