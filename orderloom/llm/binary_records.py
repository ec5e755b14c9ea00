"""Token ids as length-delimited binary records, with an index of their places.

A record is framed as: length of the payload (8 bytes), masked checksum of these 8 bytes
(4 bytes), payload, masked checksum of the payload (4 bytes), one line feed. All integers are
little-endian. The payload is a flag byte (1: has an id; 2: ids of 2 bytes, else of 4), the
document's id (8 bytes) and the token ids.

Files are written by Spark's own text sink, which commits whole tasks: a lost executor leaves
no half file, and any file system that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import batches
from orderloom.llm.token_ids import default_file, encoder
from orderloom.operators.lookups import sized
from orderloom.session import fresh_path, staged

END_ID = 2
FILE_BYTES = 16 << 20  # text that goes to one file, so that a file fits a task
FILES_IN_BLOCK = 4096  # files that are summed up before the sums are
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<Bq")
_CRC = struct.Struct("<I")


def masked(crc: int) -> int:
    """A checksum rotated and shifted, so that checksums of data with checksums stay apart."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, narrow: bool) -> bytes:
    """The record of ids given as 32-bit integers, without the line feed after it."""
    if narrow:
        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    payload = _BODY.pack((doc_id is not None) | 2 * narrow, doc_id or 0) + ids
    size = struct.pack("<Q", len(payload))
    return size + _CRC.pack(masked(zlib.crc32(size))) + payload + _CRC.pack(masked(zlib.crc32(payload)))


def unframe(content: bytes, at: int) -> tuple[int | None, bytes, int]:
    """The id and token ids (32-bit) of the record at a place, and the place of the next."""
    if len(content) < at + _HEAD.size:
        raise ValueError(f"record at {at}: the file ends in its length")
    size, check = _HEAD.unpack_from(content, at)
    if masked(zlib.crc32(content[at : at + 8])) != check:
        raise ValueError(f"record at {at}: its length is damaged")
    start = at + _HEAD.size
    end = start + size
    if len(content) < end + _CRC.size + 1:
        raise ValueError(f"record at {at}: the file ends inside it")
    payload = content[start:end]
    if masked(zlib.crc32(payload)) != _CRC.unpack_from(content, end)[0]:
        raise ValueError(f"record at {at}: its payload is damaged")
    if content[end + _CRC.size] != 0x0A:
        raise ValueError(f"record at {at}: no line feed after it")
    flags, doc_id = _BODY.unpack_from(payload)
    ids = payload[_BODY.size :]
    if flags & 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return doc_id if flags & 1 else None, ids, end + _CRC.size + 1


def records(content: bytes) -> Iterator[tuple[int, int | None, bytes]]:
    """Place, id and token ids of every record of a file."""
    at = 0
    while at < len(content):
        doc_id, ids, after = unframe(content, at)
        yield at, doc_id, ids
        at = after


def write_records(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
    added: bool = False,
) -> None:
    """Write the encoded documents to `path`, in ascending doc_id over the files by number.

    Each text is followed by `end_id`. A null text counts as empty; rows without id come
    first; rows of one id are ordered by text; other columns are ignored; an empty table
    gives files without records. `added` is that of the encoder.
    """
    tokenizer = tokenizer or default_file()
    narrow = encoder(tokenizer).vocabulary <= 1 << 16
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 32).alias("n")).first()["n"] or 0
    # The hash splits the rows of an id that many rows share.
    ordered = rows.repartitionByRange(max(1, -(-size // file_bytes)), "doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    end = struct.pack("<I", end_id)

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        encode = encoder(tokenizer, added).encode_all

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            rows = zip(batch.column(0).to_pylist(), encode(batch.column(1)))
            return {"frame": [frame(doc_id, ids + end, narrow) for doc_id, ids in rows]}

        return work

    frames = batches(ordered, "frame binary", prepare)
    frames.select(F.col("frame").cast("string").alias("value")).write.option("compression", "none").text(path)


INDEX = "file string, place long, doc_id long, n_tokens long, before long, ids_crc32 long"


def write_index(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Read all records, checking them, and write a row for each: its file and place there,
    its id, its length, the ids before it in the file, and the crc32 of its ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, list] = {name.split()[0]: [] for name in INDEX.split(", ")}
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                before = 0
                for place, doc_id, ids in records(content.as_py()):
                    row = (file, place, doc_id, len(ids) // 4, before, zlib.crc32(ids))
                    for values, value in zip(out.values(), row):
                        values.append(value)
                    before += len(ids) // 4
            return out

        return work

    batches(files, INDEX, prepare).write.parquet(target)
    return spark.read.schema(INDEX).parquet(target)


def starts(index: DataFrame, block: int = FILES_IN_BLOCK) -> DataFrame:
    """The index with `start`: the ids of all records before, over all files in order.

    Files are in order of the number in their names, which has five digits or as many as it
    takes. Files are summed up inside blocks of so many numbers, blocks in one task.
    """
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("all")).withColumn("number", number)
    totals = totals.withColumn("block", F.floor(F.col("number") / F.lit(block)))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("block").orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("all").alias("whole"))
    bases = blocks.select("block", F.coalesce(F.sum("whole").over(so_far.orderBy("block")), F.lit(0)).alias("base"))
    files = totals.withColumn("inside", F.coalesce(F.sum("all").over(within), F.lit(0))).join(bases, "block")
    files = files.select("file", (F.col("base") + F.col("inside")).alias("base"))
    return index.join(files, "file").withColumn("start", F.col("base") + F.col("before"))


def fetch(spark: SparkSession, path: str, index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents whose id is in `wanted`, by their places in the index.

    Only files that hold one of them are listed and opened; their paths are handed to the scan
    by the driver. Each id of `wanted` counts once, and all documents of an id are given; a null
    id names no document. `index` should be a written table.
    """
    chosen = index.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    places = staged(chosen.groupBy("file").agg(F.collect_list("place").alias("places")), "record-places")
    paths = [row["file"] for row in places.select("file").collect()]
    if not paths:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    files = spark.read.format("binaryFile").load(paths)
    both = files.join(sized(places), files["path"] == places["file"]).select("content", "places")

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            doc_ids, found = [], []
            for content, at in zip(batch.column(0), batch.column(1).to_pylist()):
                whole = content.as_py()
                for place in at:
                    doc_id, ids, _ = unframe(whole, place)
                    doc_ids.append(doc_id)
                    found.append(np.frombuffer(ids, "<u4").astype(np.int64).tolist())
            return {"doc_id": doc_ids, "ids": found}

        return work

    return batches(both, "doc_id long, ids array<long>", prepare)


def round_trip(docs: DataFrame, tokenizer: str | None = None, added: bool = True) -> DataFrame:
    """Write the documents' records, read them back, and return what was read per document."""
    spark = docs.sparkSession
    path = fresh_path(spark, "records")
    write_records(docs, path, tokenizer, added=added)
    index = write_index(spark, path, fresh_path(spark, "record-index"))
    return starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
