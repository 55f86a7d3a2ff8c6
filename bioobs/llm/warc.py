"""WARC archives of pages, compressed record by record with a shared dictionary.

Every task writes one archive: first a skippable frame that holds a Zstandard
dictionary built from the archive's own records, then each record as a frame of its
own, so that one record can be read without the others. Between records stands an
empty skippable frame, which readers pass over. Spark's text writer puts the frames
into files, so archives reach any file system that Spark writes to, and a task that
is run again leaves no half-written archive.

A payload that occurs several times is stored once, as the response with the largest
page_id; the others become revisit records that name it.

Defined cases: a missing html is an empty payload, and empty payloads equal each
other; a missing page_id counts as the smallest and stays missing; of rows that agree
in payload and page_id one is the response, the rest revisit it; a missing url leaves
the target out; line breaks in a url are percent-encoded; columns other than page_id,
url and html are not read; an empty table gives an empty archive and no rows. A page
is held whole by the task that writes or reads it, whatever its length.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from bioobs.llm.common import arrow_schema, batch_of, stored
from bioobs.operators.joins import broadcast_if_small
from bioobs.session import shared_folder

# fixed values: frame magics, profile and media types of the format
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

LEVEL = 3
# a dictionary learns from at most so many pieces of so many bytes of an archive's first batch of records
DICTIONARY_BYTES, SAMPLES, SAMPLE_BYTES = 64 * 1024, 400, 4096
# rows that are turned into Python objects at a time; bytes a frame's end is looked for in at once
CHUNK, WINDOW = 256, 1 << 16
RECORDS = "record_id string, record_type string, page_id long, target string, payload_digest string, payload_bytes long, refers_to string"


def base32_digest(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_id(collection: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{collection}/{row}')}>"


def _header(name: str, value: str | None) -> str:
    if value is None:
        return ""
    return f"{name}: {value.replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def record(
    collection: str, date: str, row: int, page_id: int | None, url: str | None, payload: bytes | None, size: int,
    digest: str, first_row: int | None, first_url: str | None,
) -> bytes:
    """One record: a response with its payload, or a revisit of the row ``first_row``."""
    revisit = first_row is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = "WARC/1.1\r\n" + _header("WARC-Type", "revisit" if revisit else "response")
    head += _header("WARC-Record-ID", record_id(collection, row)) + _header("WARC-Date", date)
    head += _header("WARC-Target-URI", url) + _header("X-Page-ID", None if page_id is None else str(page_id))
    head += _header("Content-Type", HTTP_TYPE) + _header("WARC-Payload-Digest", f"sha1:{base32_digest(digest)}")
    if revisit:
        head += _header("WARC-Profile", REVISIT_PROFILE) + _header("WARC-Refers-To", record_id(collection, first_row))
        head += _header("WARC-Refers-To-Target-URI", first_url) + _header("WARC-Refers-To-Date", date)
    return (head + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes | None:
    """A dictionary from pieces of records, spread evenly over them; None if there are too few to learn from."""
    pieces = [r[i : i + SAMPLE_BYTES] for r in records[:: max(1, len(records) // SAMPLES)] for i in range(0, len(r), SAMPLE_BYTES)]
    pieces = pieces[:: max(1, len(pieces) // SAMPLES)][:SAMPLES]
    size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 4)
    try:
        return zstandard.train_dictionary(size, pieces, k=512, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return None


def _frames(collection: str, date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, compressor = arrow_schema("frame binary"), None
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            rows = [record(collection, date, *r) for r in zip(*(c.to_pylist() for c in batch.slice(at, CHUNK).columns))]
            frames = []
            if compressor is None:
                spread = batch.take(pa.array(range(0, batch.num_rows, max(1, batch.num_rows // SAMPLES))))
                learned = build_dictionary([record(collection, date, *r) for r in zip(*(c.to_pylist() for c in spread.columns))])
                if learned is not None:
                    packed = zstandard.ZstdCompressor(level=LEVEL).compress(learned)
                    frames.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
                    learned = zstandard.ZstdCompressionDict(learned, dict_type=zstandard.DICT_TYPE_FULLDICT)
                    learned.precompute_compress(level=LEVEL)
                compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_checksum=True)
            frames += map(compressor.compress, rows)
            yield batch_of([(f,) for f in frames], schema)


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", collection: str | None = None) -> None:
    """Write ``page_id, url, html`` as archives, one per task, into a new folder.

    ``date`` is the time of capture that every record states. ``collection`` seeds the
    record ids, which differ between collections.

    The pages are numbered and stored first, so that equal rows stay apart and a page
    keeps its number if a task runs again. Only digests are shuffled; the response of a
    repeated payload comes back by a join that leaves pages where they are as long as
    the repeated digests are few, and that splits hot digests otherwise.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    numbered = stored(
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
        .withColumns({"row": F.monotonically_increasing_id(), "digest": F.sha1("payload")}),
        "numbered-pages",
    )
    largest = F.max(F.struct("page_id", "row", "url")).alias("first")
    repeated = numbered.groupBy("digest").agg(F.count("*").alias("times"), largest).where("times > 1").drop("times")
    marked = numbered.join(broadcast_if_small(stored(repeated, "repeated-payloads")), "digest", "left")
    revisits = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    frames = marked.select(
        "row", "page_id", "url",
        F.when(~revisits, F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("size"),
        "digest",
        F.when(revisits, F.col("first.row")).alias("first_row"),
        F.when(revisits, F.col("first.url")).alias("first_url"),
    ).mapInArrow(partial(_frames, collection or uuid.uuid4().hex, date), "frame binary")
    # bytes pass through as they are; the separator is itself a frame that readers skip
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(folder)


def records_of(content: bytes) -> Iterator[bytes]:
    """The records of one archive, by its own dictionary."""
    view, at, learned = memoryview(content), 0, None
    decompressor = zstandard.ZstdDecompressor()
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC and at == 0:
                learned = zstandard.ZstdDecompressor().decompress(bytes(view[8 : 8 + size]))
                decompressor = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(learned))
            at += 8 + size
            continue
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            piece = view[at : at + WINDOW]
            if not len(piece):
                raise ValueError("an archive ends within a record")
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the response in it, and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:40]}")
    named = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(named["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record has not the length that it states")
    http, _, payload = block.partition(b"\r\n\r\n")
    return named, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def _read(payloads: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(RECORDS + ", payload binary" * payloads)
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for data in records_of(content.as_py()):
                named, http, payload = parse_record(data)
                kind, digest = named["WARC-Type"], named["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"the payload of {named['WARC-Record-ID']} has another digest than stated")
                page = named.get("X-Page-ID")
                row = (
                    named["WARC-Record-ID"], kind, None if page is None else int(page), named.get("WARC-Target-URI"),
                    digest, int(http["Content-Length"]), named.get("WARC-Refers-To"),
                )
                rows.append(row + (payload if kind == "response" else None,) * payloads)
                if len(rows) == CHUNK:
                    yield batch_of(rows, schema)
                    rows = []
            yield batch_of(rows, schema)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """All records of a folder of archives: ``record_id, record_type, page_id, target, payload_digest,
    payload_bytes, refers_to`` and, if asked, ``payload`` (missing in revisits).

    Each archive is read by one task. The digest of every response is computed again
    and must be the stated one.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(partial(_read, payloads), RECORDS + ", payload binary" * payloads)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages as archives and give what the archives say of each: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "archives")
    write_archives(pages, folder)
    records = stored(read_archives(spark, folder, payloads=False), "records")
    responses = records.where("record_type = 'response'")
    known = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("response_page"), F.lit(True).alias("known"))
    revisits = records.where("record_type = 'revisit'").join(known, "refers_to", "left")
    found = F.when(F.col("known"), F.col("response_page")).otherwise(F.raise_error(F.lit("a revisit names a record that is not archived")).cast("long"))
    shown = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return responses.select(*shown, F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select(*shown, found.alias("refers_to"))
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER () AS row FROM pages),
hashed AS (
  SELECT *, sha1(html) AS hex,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, row) AS place,
    max(page_id) OVER (PARTITION BY html) AS response FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform([1, 11, 21, 31], lambda i: translate(upper(to_base(('0x' || hex[i:i + 9])::BIGINT, 32, 8)),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN response END AS refers_to
FROM hashed
"""
