"""Daily order files: where they lie and how they are read, whole or as they arrive."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.contracts import CORRUPT, CRITICAL, FILE, RAW_ORDERS, RUN_DATE
from orderloom.sources.headers import FIRST_LINES, first_lines

SCAN_SCHEMA = T.StructType(
    [
        *RAW_ORDERS.fields,
        T.StructField(CORRUPT, T.StringType()),
        T.StructField(RUN_DATE, T.DateType()),
        T.StructField(FILE, T.StringType(), nullable=False),
    ]
)
LISTED = "path string, file string, length long, modified timestamp"

# Fixed value: the name of a day's file.
_NAME = "ecommerce_orders_{:%Y-%m-%d}.csv"

_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # A scan that skips a column cannot tell a short line from a whole one and would leave
    # the corrupt-record column empty without a word.
    "columnPruning": "false",
}


class HeaderError(ValueError):
    """Raised when files lack a column that no line can do without."""


def day_file(root: str, day: dt.date) -> str:
    """The file of one day: <root>/<yyyymmdd>/ecommerce_orders_<yyyy-mm-dd>.csv."""
    return f"{root.rstrip('/')}/{day:%Y%m%d}/{_NAME.format(day)}"


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, file, length, modified) of all files under `path`, at any depth, or of the given
    ones. Names that begin with _ or . are left out, and so are files of no bytes, as if they
    were not there. Nothing is opened.

    `path` is what a scan takes; `file` is the name that rows of a scan know their file by.
    """
    if not path:
        return spark.createDataFrame([], LISTED)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.selectExpr(*_LISTED)


_LISTED = ["path", f"_metadata.file_path AS {FILE}", "length", "modificationTime AS modified"]


def paths_of(files: DataFrame) -> list[str]:
    """The paths of listed files, which a scan of them has to hold in the driver anyway."""
    return [row["path"] for row in files.select("path").orderBy("path").collect()]


def by_header(spark: SparkSession, files: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """The paths of each header among listed files; files without lines have none."""
    listed = sorted((row["path"], row[FILE]) for row in files.select("path", FILE).collect())
    found = first_lines(spark, [path for path, _ in listed])
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, file in listed:
        if file in found:
            groups[found[file]].append(path)
    return dict(groups)


def read_orders(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All order lines under `path`, or of the given files, as text under the order model's names.

    The header decides which field is which; files of one header are one scan. Further columns
    are dropped, a missing discount or category is null, and a header without a critical
    column fails with its files named. Malformed lines are marked in _corrupt_record, run_date
    is the day of the folder a file lies in, null elsewhere, and file is the file.

    Types are given, never inferred: inference costs a pass over the data and turns the id
    007 into 7.
    """
    return read_files(spark, listed_files(spark, path))


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The lines of listed files, as `read_orders` has them."""
    groups = by_header(spark, files)
    lacking = {header: set(CRITICAL) - set(header) for header in groups}
    if any(lacking.values()):
        named = [f"{groups[header][0]}: {', '.join(sorted(gone))}" for header, gone in lacking.items() if gone]
        raise HeaderError("files without a critical column: " + "; ".join(sorted(named)))
    parts = [_scan(spark, header, groups[header]) for header in sorted(groups)]
    if not parts:
        return spark.createDataFrame([], SCAN_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def _scan(spark: SparkSession, header: tuple[str, ...], files: list[str]) -> DataFrame:
    # A name that stands twice, or for our own column, is told apart by its place.
    names = [
        name if name in RAW_ORDERS.names and name not in header[:k] else f"_column_{k}"
        for k, name in enumerate(header)
    ]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    lines = spark.read.schema(schema).options(**_OPTIONS).csv(files)
    file = F.col("_metadata.file_path")
    found = {name: F.col(name) for name in [*names, CORRUPT]}
    found[RUN_DATE] = F.try_to_date(F.regexp_extract(file, r"^.*/(\d{8})/", 1), "yyyyMMdd")
    found[FILE] = file
    absent = F.lit(None).cast("string")
    return lines.select(*[found.get(name, absent).alias(name) for name in SCAN_SCHEMA.names])


def schema_audit(spark: SparkSession, path: str) -> DataFrame:
    """How each group of files differs from the order model: a row per column that is missing,
    extra or at another place, with the group's files, the folders these lie in, and their lines
    without headers and blank lines. The group is named by its header.

    Lines are counted in one scan that passes on a row per file.
    """
    paths = paths_of(listed_files(spark, path))
    if not paths:
        return spark.createDataFrame([], "file_group string, files long, folders long, lines long, column string, finding string")
    filled = F.count_if(F.length(F.trim(F.col("value"))) > 0) - 1
    lines = spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias(FILE)).agg(filled.alias("lines"))
    found = spark.createDataFrame(list(first_lines(spark, paths).items()), FIRST_LINES)
    groups = found.join(lines, FILE).groupBy("header").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct(F.regexp_replace(FILE, "/[^/]*$", "")).alias("folders"),
        F.sum("lines").alias("lines"),
    )
    model = F.array(*[F.lit(name) for name in RAW_ORDERS.names])
    given = F.array_distinct("header")
    expected = F.filter(model, lambda name: F.array_contains("header", name))
    found = F.filter(given, lambda name: F.array_contains(model, name))
    differs = F.filter(
        F.arrays_zip(expected.alias("name"), found.alias("there")), lambda pair: pair["name"] != pair["there"]
    )
    findings = {
        "missing": F.array_except(model, "header"),
        "extra": F.array_except(given, model),
        "moved": F.transform(differs, lambda pair: pair["name"]),
    }
    rows = [F.transform(names, _as_row(finding)) for finding, names in findings.items()]
    listed = groups.select(F.array_join("header", ",").alias("file_group"), "files", "folders", "lines", F.explode(F.concat(*rows)).alias("row"))
    return listed.select("file_group", "files", "folders", "lines", "row.column", "row.finding")


def _as_row(finding: str) -> Callable[[Column], Column]:
    return lambda name: F.struct(name.alias("column"), F.lit(finding).alias("finding"))


def stream_files(spark: SparkSession, path: str) -> DataFrame:
    """Newly arrived files as a stream, listed as by `listed_files`. Contents are not read."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    schema = "path string, modificationTime timestamp, length long, content binary"
    return reader.schema(schema).load(path).selectExpr(*_LISTED)
