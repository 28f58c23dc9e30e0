"""WARC archives through a chunked record table.

Payloads become rows of (record, chunk number, at most CHUNK bytes). A chunk row is written as one
WARC record: small payloads as a single `response`, larger ones as a segmented record, a `response`
followed by `continuation` records (WARC 1.1, section 7). Nothing from there on holds a payload of
many chunks whole: the writer and the reader carry a SHA-1 state from chunk to chunk.

Every WARC record is a gzip member of its own, so a reader can start at any of them and holds one record
at a time. Spark's text writer puts the members down, one a row; its line end is an empty gzip member,
which adds nothing to the stream. So archives are committed with the job and may lie in any store.

Record ids come from page_id, payload digest and, where a page stands there more than once, its number: a
task that is run again writes the same ids, and WARC-Refers-To names the id of the archived response.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.sources.tables import scratch_path, stage

END = "\r\n\r\n"
#: Bytes of a chunk, and chunks of an archive file.
CHUNK, CHUNKS_PER_FILE = 1 << 18, 512
#: A payload of more rows than this, and than a thousandth of all, is hot: at most 1,000 are.
HOT_ROWS = 1000
#: Most bytes of a record around its block.
HEAD = 1 << 20
#: The gzip member of no bytes that ends each line of an archive.
EMPTY = gzip.compress(b"", mtime=0)

_DATE = "1970-01-01T00:00:00Z"  # the table has no capture time
_CHUNK_ROWS = (
    "record string, page_id long, record_type string, refers_to long, chunk int, is_last boolean, "
    "bytes long, digest string, data binary"
)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Payload, digest and the page that archives it, for every page.

    Of pages with equal payloads (SHA-1 and length) of at least `min_bytes`, those with the smallest
    page_id are responses and the rest revisit it. Rows that repeat that page_id are responses too;
    a null page_id is larger than any other. `copy` numbers the rows that share page_id and payload (in
    one sort, which spills). Payloads are shuffled once, those of hot groups only with their responses.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    ).withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    key = ["sha1", "size", "spread"]
    sums = rows.groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    payloads = stage(sums, "warc_payloads")
    total = payloads.agg(F.sum("n")).first()[0] or 0
    hot = payloads.where(F.col("n") > max(HOT_ROWS, total // 1000))
    # Rows of hot payloads learn their decision before the shuffle, leave the payload behind if they
    # revisit, and are dealt by page.
    known = rows.join(F.broadcast(hot.select("sha1", "size", F.struct("first").alias("hot"))), ["sha1", "size"], "left")
    revisits = F.col("hot").isNotNull() & (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("hot.first"))
    dealt = known.withColumns(
        {
            "payload": F.when(~revisits, F.col("payload")).otherwise(F.lit(b"")),
            "spread": F.when(F.col("hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("page_id"), F.lit(1 << 20))),
        }
    )
    firsts = payloads.select("sha1", "size", F.lit(0).cast("long").alias("spread"), F.col("first").alias("found"))
    joined = dealt.join(firsts, key, "left").withColumn(
        "first", F.when(F.col("hot").isNull(), F.col("found")).otherwise(F.col("hot.first"))
    )
    response = (F.col("size") < min_bytes) | F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumns(
        {
            "response": response,
            "payload": F.when(response, F.col("payload")).otherwise(F.lit(b"")),
            "copy": F.row_number().over(Window.partitionBy(*key, "page_id").orderBy("url")),
        }
    )


def chunk_rows(decided: DataFrame) -> DataFrame:
    """One row per page and chunk, chunks of a page in order and next to each other."""
    stored = F.when(F.col("response"), F.col("size")).otherwise(F.lit(0))
    last = (F.greatest(stored - 1, F.lit(0)) / CHUNK).cast("int")
    return (
        decided.withColumn("last", last)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("data", F.substring("payload", F.col("chunk") * CHUNK + 1, F.lit(CHUNK)))
        .select("page_id", "url", "sha1", "size", "first", "copy", "response", "chunk", "last", "data")
    )


def _name(page_id: int | None) -> str:
    return "none" if page_id is None else str(page_id)


def record_id(page_id: int | None, sha1: str, copy: int = 1) -> str:
    """The id of a page's record, of its first segment if it has several."""
    return f"urn:page:{_name(page_id)}:{sha1}" + (f":{copy}" if copy > 1 else "")


def _render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running = hashlib.sha1()
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            chunk, last, data = row["chunk"], row["last"], row["data"]
            if chunk == 0:
                running = hashlib.sha1()
            own = record_id(row["page_id"], row["sha1"], row["copy"])
            running.update(data)
            full = bytes.fromhex(row["sha1"])
            if row["response"] and chunk == last and running.digest() != full:
                raise ValueError(f"{own}: the chunks don't make up the payload")
            head = [
                "WARC/1.1",
                f"WARC-Type: {'revisit' if not row['response'] else 'continuation' if chunk else 'response'}",
                f"WARC-Record-ID: <{own}{f'/{chunk}' if chunk else ''}>",
                f"WARC-Date: {_DATE}",
                f"WARC-Payload-Digest: sha1:{_base32(full)}",
                f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(data).digest())}",
                f"Page-ID: {_name(row['page_id'])}",
                f"Content-Length: {len(data)}",
            ]
            if not chunk:
                # A line end or a control character in an address would end the field.
                address = "".join(c if c > " " else "%20" for c in row["url"])
                head += [f"WARC-Target-URI: {address}", "Content-Type: text/html"]
            if not row["response"]:
                head += [
                    "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                    f"WARC-Refers-To: <{record_id(row['first'], row['sha1'])}>",
                    f"Payload-Length: {row['size']}",
                ]
            if last:
                head.append(f"WARC-Segment-Number: {chunk + 1}")
                if chunk:
                    head.append(f"WARC-Segment-Origin-ID: <{own}>")
                if chunk == last:
                    head.append(f"WARC-Segment-Total-Length: {row['size']}")
            record = b"".join(("\r\n".join(head).encode(), END.encode(), data, END.encode()))
            rows.append(gzip.compress(record, 6, mtime=0))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["record"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a WARC record (or a segmented one) for every page; no pages give empty archives."""
    records = chunk_rows(decide(pages, min_bytes)).mapInArrow(_render, "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")  # of the line end; the rows are bytes already
        .option("lineSep", EMPTY.decode("latin-1"))
        .option("maxRecordsPerFile", CHUNKS_PER_FILE)
        .text(path)
    )


def _record(view: memoryview, at: int) -> tuple[dict[str, str], memoryview, int]:
    """Header fields, block, and the offset of the next record."""
    head = bytes(view[at : at + 4096])
    for size in (65536, len(view)):
        if END.encode() in head:
            break
        head = bytes(view[at : at + size])
    stop = head.find(END.encode())
    lines = head[:stop].decode().split("\r\n")
    if stop < 0 or not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at byte {at}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    begin = at + stop + len(END)
    upto = begin + int(fields["Content-Length"])
    block = view[begin:upto]
    if bytes(view[upto : upto + len(END)]) != END.encode():
        raise ValueError(f"the record at byte {at} isn't closed")
    if fields["WARC-Block-Digest"] != "sha1:" + _base32(hashlib.sha1(block).digest()):
        raise ValueError(f"the record at byte {at} fails its digest")
    return fields, block, upto + len(END)


def _members(data: memoryview) -> Iterator[bytes]:
    """What each gzip member holds, one at a time, with empty ones left out."""
    at = 0
    while at < len(data):
        if data[at : at + len(EMPTY)] == EMPTY:
            at += len(EMPTY)
            continue
        start, held, inflate = at, bytearray(), zlib.decompressobj(31)
        while not inflate.eof:
            piece = data[at : at + 8192]
            if not len(piece):
                raise ValueError(f"the gzip member at byte {start} is cut off")
            at += len(piece)
            held += inflate.decompress(piece, CHUNK + HEAD - len(held) + 1)
            if len(held) > CHUNK + HEAD:
                raise ValueError(f"the gzip member at byte {start} holds more than a chunk")
            if inflate.unconsumed_tail:
                at -= len(inflate.unconsumed_tail)
        at -= len(inflate.unused_data)
        if held:
            yield bytes(held)


def _page(name: str) -> int | None:
    return None if name == "none" else int(name)


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in _CHUNK_ROWS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for member in _members(memoryview(content.as_buffer())):
                fields, block, upto = _record(memoryview(member), 0)
                if upto != len(member):
                    raise ValueError(f"{fields['WARC-Record-ID']} isn't alone in its gzip member")
                origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
                revisit, segment = fields["WARC-Type"] == "revisit", int(fields.get("WARC-Segment-Number", 0))
                # Only parts of a segmented payload travel on; of others the digest is known here.
                rows.append(
                    (
                        origin,
                        _page(fields["Page-ID"]),
                        "revisit" if revisit else "response",
                        _page(fields["WARC-Refers-To"].split(":")[2]) if revisit else None,
                        segment,
                        not segment or "WARC-Segment-Total-Length" in fields,
                        int(fields["Payload-Length"]) if revisit else len(block),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if revisit
                        else _base32(hashlib.sha1(block).digest()),
                        bytes(block) if segment else None,
                    )
                )
                held += len(block) if segment else 0
                if held > 1 << 23 or len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _join_segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks by record and number: total size and the digest carried through them."""
    record, running, size, expected = None, hashlib.sha1(), 0, 1
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["record"] != record:
                record, running, size, expected = row["record"], hashlib.sha1(), 0, 1
            if row["chunk"] != expected:
                raise ValueError(f"{record}: segment {expected} is missing")
            running.update(row["data"])
            size, expected = size + len(row["data"]), expected + 1
            if row["is_last"]:
                rows.append((row["page_id"], size, _base32(running.digest()), row["record_type"], row["refers_to"]))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives: one row per WARC record."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_parse, _CHUNK_ROWS)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every archived page."""
    chunks = stage(read_chunks(spark, path), "warc_chunks")
    whole = chunks.where("chunk = 0").select(
        "page_id",
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
    parts = chunks.where("chunk > 0").repartition("record").sortWithinPartitions("record", "chunk")
    return whole.unionByName(
        parts.mapInArrow(
            _join_segments,
            "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long",
        )
    )


def archive_pages(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Archive all pages and return what `read_pages` finds in the archives.

    Takes page_id (any integer), url and html; a null html is an empty payload, a null url an empty
    address, and other columns are ignored.
    """
    folder = path or scratch_path(pages.sparkSession, "warc")
    write_archives(pages, folder, min_bytes)
    return read_pages(pages.sparkSession, folder)
