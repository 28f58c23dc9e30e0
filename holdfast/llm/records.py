"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A file is a run of records, each
    length    8 bytes, little endian: bytes of the body
    check     4 bytes: masked CRC-32 of the length field
    body      doc_id (8 bytes, signed), flags (1 byte: 1 = doc_id is null), width of an id in
              bytes (1 byte: 2 or 4), then the ids, little endian
    check     4 bytes: masked CRC-32 of the body
    end       the byte 0x0A
A masked checksum is the checksum rotated right by 15 bits plus 0xA282EAD8, so that a checksum over
data that holds checksums stays sound.

Spark's text writer puts the bytes down (one row a record, 0x0A as its line end), so files are
committed with the job, survive lost executors and may lie in any store that Spark reaches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.encoder import encoder
from holdfast.sources.tables import scratch_path

_LENGTH, _CHECK, _HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB")
END = b"\n"
#: Files are closed after so many records, which bounds what a reader holds.
RECORDS_PER_FILE = 2048

INDEX = (
    "doc_id long, file string, offset long, length long, start_in_file long, n_tokens long, "
    "ids_crc32 long"
)


def masked(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One record without its end byte, which the writer adds."""
    body = _HEAD.pack(doc_id or 0, doc_id is None, ids.dtype.itemsize) + ids.tobytes()
    length = _LENGTH.pack(len(body))
    return b"".join((length, _CHECK.pack(masked(length)), body, _CHECK.pack(masked(body))))


def parse(content: bytes | memoryview, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """The record at an offset: its doc_id, ids, and the offset of the next one."""
    view = memoryview(content)
    try:
        length = _LENGTH.unpack_from(view, offset)[0]
        if _CHECK.unpack_from(view, offset + 8)[0] != masked(view[offset : offset + 8]):
            raise ValueError(f"record at {offset}: the length fails its checksum")
        body = view[offset + 12 : offset + 12 + length]
        stop = offset + 12 + length
        if len(body) < length or _CHECK.unpack_from(view, stop)[0] != masked(body):
            raise ValueError(f"record at {offset}: the body fails its checksum")
        if view[stop + 4 : stop + 5] != END:
            raise ValueError(f"record at {offset}: no end byte")
    except struct.error as error:
        raise ValueError(f"record at {offset}: the file ends within it") from error
    number, null, width = _HEAD.unpack_from(body)
    ids = np.frombuffer(body, f"<u{width}", offset=_HEAD.size)
    return (None if null else number), ids, stop + 5


def _encode(tokenizer: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([end_id], own.ids)
        for batch in batches:
            for part, ids in own.batch(batch, "text"):
                numbers = part.column("doc_id").to_pylist()
                rows = [frame(n, np.concatenate([x, end])) for n, x in zip(numbers, ids, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["record"])

    return run


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every text and write the records in ascending doc_id order over files in name order.

    Rows without a doc_id come first; a null text has the end id alone; rows that share a doc_id
    are each a record, in order of their texts.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    records = keyed.orderBy("doc_id", F.xxhash64("text")).mapInArrow(_encode(tokenizer, end_id), "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
            view, name = memoryview(content.as_buffer()), file.as_py()
            rows, offset, before = [], 0, 0
            while offset < len(view):
                number, ids, after = parse(view, offset)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((number, name, offset, after - offset, before, len(ids), crc))
                offset, before = after, before + len(ids)
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.string()] + [pa.int64()] * 5
            names = [field.split()[0] for field in INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def write_index(spark: SparkSession, path: str, index: str) -> DataFrame:
    """Read all files once, check every record, and write where each lies and what it holds."""
    _files(spark, path).select("path", "content").mapInArrow(_scan, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def with_starts(index: DataFrame) -> DataFrame:
    """`start`: ids of all records before this one. Files follow each other by the numbers of the task and of
    its file, which names show padded to a fixed width only up to a point. Sums by file and by task first,
    so the running sum over everything sees one row a task."""
    number = lambda pattern: F.regexp_extract("file", pattern, 1).cast("long")
    sizes = index.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    sizes = sizes.select("file", "size", number(r"/part-(\d+)-[^/]*$").alias("task"), number(r"-c(\d+)[^/]*$").alias("nth"))
    upto = lambda window: F.coalesce(F.sum("size").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = sizes.groupBy("task").agg(F.sum("size").alias("size")).select("task", upto(Window.orderBy("task")).alias("first"))
    inside = sizes.select("file", "task", upto(Window.partitionBy("task").orderBy("nth")).alias("inside"))
    bases = inside.join(tasks, "task").select("file", (F.col("first") + F.col("inside")).alias("base"))
    return index.join(bases, "file").withColumn("start", F.col("base") + F.col("start_in_file")).drop("base")


def _pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for content, offsets in zip(batch.column("content"), batch.column("offsets"), strict=True):
            view = memoryview(content.as_buffer())
            for offset in offsets.as_py():
                number, ids, _ = parse(view, offset)
                rows.append((number, ids.astype(np.int64)))
        columns = list(zip(*rows, strict=True)) or [[], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64()))], ["doc_id", "ids"]
        )


def read_records(path: str, rows: DataFrame) -> DataFrame:
    """(doc_id, ids) of chosen index rows, found by their offsets without parsing the rest."""
    spark = rows.sparkSession
    wanted = rows.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    held = _files(spark, path).select(F.col("path").alias("file"), "content").join(wanted, "file")
    return held.select("content", "offsets").mapInArrow(_pick, "doc_id long, ids array<long>")


def token_records(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write all documents as records, index them, and return one row per record as read back:
    doc_id, start, n_tokens, ids_crc32, and where the record lies (file, offset, length).

    Takes doc_id (any integer) and text; other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    folder = path or scratch_path(spark, "records")
    write_records(docs, f"{folder}/data", tokenizer, end_id)
    index = with_starts(write_index(spark, f"{folder}/data", f"{folder}/index"))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
