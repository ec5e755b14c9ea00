"""Helpers shared by the operators: Arrow passes, id residues, shipping the package to workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import orderloom

_SHIPPED: set[str] = set()

BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "2m"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers on other machines need not have it installed. Unless the session has a bound of its
    own, its Arrow batches are bounded by bytes: a batch of long texts lies in the JVM's and in
    the worker's memory, there in several forms at once.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(orderloom.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="orderloom-"), "orderloom_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def batches(
    df: DataFrame,
    schema: str | StructType,
    prepare: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
) -> DataFrame:
    """Each Arrow batch of `df` through a task's work, which returns the columns of `schema`.

    `prepare` runs once in each task and returns the work.
    """
    ship(df.sparkSession)
    result = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    shape = to_arrow_schema(result)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in parts:
            columns = work(batch)
            yield pa.RecordBatch.from_arrays(
                [as_array(columns[field.name], field.type) for field in shape], schema=shape
            )

    return df.mapInArrow(run, result)


def as_array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def id_residue(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)


def is_residue(column: Column, modulus: int, residue: int) -> Column:
    """Whether the id falls on `residue`; false for a null id."""
    return F.coalesce(id_residue(column, modulus) == residue, F.lit(False))


def learnable(column: Column, modulus: int, residue: int) -> Column:
    """Whether an operator may learn from the row: a null id is never learned from."""
    return F.coalesce(id_residue(column, modulus) != residue, F.lit(False))



def texts(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [text or "" for text in column.to_pylist()]
