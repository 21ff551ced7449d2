"""WARC archives in Zstandard with a dictionary in a leading skippable frame.

A dictionary is built from archived records and stored, compressed, in the
first frame of every file, which decoders without knowledge of it skip. Every
record is a frame of its own, so one can be read alone by its offset. Payloads
that repeat are written once; later captures are revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import query, shared_folder, table, text_of

# The skippable frame for dictionaries, and the Zstandard frame.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 1000  # records that the dictionary is built from
SAMPLE_BYTES = 64 << 10  # largest record among them
ARCHIVE_BYTES = 64 << 20  # an archive is closed beyond this size
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32_of(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record_id(page: object, sha1: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{sha1}')}>"


def header_value(text: object) -> str:
    """A header value on one line: line breaks and percent signs before them are escaped."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n%" else c for c in str(text))


def value_of_header(text: str) -> str:
    for c in "\r\n%":
        text = text.replace(f"%{ord(c):02X}", c)
    return text


def record(page: object, url: str | None, payload: bytes | None, size: int, sha1: str, refers_to: object = None) -> bytes:
    """One WARC record; without ``payload`` a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    named = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", record_id(page, sha1)),
             ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Page-Id", "" if page is None else page)]
    if url is not None:
        named.append(("WARC-Target-URI", url))
    if payload is None:
        named += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, sha1)), ("Refers-To-Page-Id", refers_to)]
    named += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {header_value(v)}\r\n" for k, v in named) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC headers, HTTP head, payload) of a record, with its lengths checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    named = {k.lower(): value_of_header(v) for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(named["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return named, http, payload


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame: the dictionary, itself compressed."""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def records(archive: bytes) -> Iterator[bytes]:
    """All records of an archive, decompressed with the dictionary in its first frame."""
    at, dictionary = 0, None
    if archive[:4] == struct.pack("<I", SKIPPABLE):
        size = struct.unpack("<I", archive[4:8])[0]
        raw = zstandard.ZstdDecompressor().decompress(archive[8:8 + size])
        dictionary, at = zstandard.ZstdCompressionDict(raw), 8 + size
    reader = zstandard.ZstdDecompressor(**({"dict_data": dictionary} if dictionary else {}))
    view = memoryview(archive)
    while at < len(archive):
        one = reader.decompressobj()
        out = one.decompress(view[at:])
        if not one.eof:
            raise ValueError("an archive ends inside a frame")
        at = len(archive) - len(one.unused_data)
        yield out


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; raw content where there is too little to train on."""
    if not samples:
        return b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def with_originals(pages: DataFrame, html: str = "html", page: str = "page_id") -> DataFrame:
    """Payload columns and ``_first``, the smallest page of equal payloads."""
    rows = pages.select(F.col(page).alias("_page"), F.col("url").cast("string").alias("_url"), text_of(html).alias("_html"))
    rows = rows.select("*", F.sha1("_html").alias("_sha1"), F.octet_length("_html").cast("long").alias("_size"))
    # one short row per payload and task before the shuffle; only payloads that repeat are joined
    first = rows.groupBy("_sha1", "_size").agg(F.min("_page").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return rows.join(first.drop("_n"), ["_sha1", "_size"], "left")


def write_archives(pages: DataFrame, folder: str, html: str = "html", page: str = "page_id",
                   least: int = 0, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row into ``folder``; (path, records, bytes) of each archive.

    Of equal payloads of at least ``least`` bytes the row with the smallest
    page is the response, the others revisit it; rows that repeat page and
    payload are the same capture and alike. Null html is an empty payload, a
    null URL leaves its header out, and a null page is a response of its own
    unless an equal payload has a page. An empty table writes no archive.
    Other columns are not read. A task that runs again writes the same bytes
    to the same names.
    """
    rows = with_originals(pages, html, page)
    # the records with the smallest hashes: first the numbers alone, then only these texts
    drawn = pages.select(text_of(html).alias("h"), F.xxhash64(text_of(html)).alias("x")).where(F.octet_length("h").between(1, SAMPLE_BYTES))
    cut = drawn.select("x").orderBy("x").limit(SAMPLE_RECORDS).agg(F.max("x")).first()[0]
    sample = drawn.where(F.col("x") <= cut).dropDuplicates(["x"]).orderBy("x").limit(SAMPLE_RECORDS).collect() if cut is not None else []
    dictionary = build_dictionary([record(k, "https://www.example.com/", r.h.encode("utf-8", "surrogatepass"), len(r.h.encode("utf-8", "surrogatepass")),
                                          digest(r.h.encode("utf-8", "surrogatepass"))) for k, r in enumerate(sample)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = pa.fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        known = zstandard.ZstdCompressionDict(dictionary)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        parts: list[bytes] = []
        number = filled = 0

        def close() -> pa.RecordBatch:
            nonlocal parts, number, filled
            name = f"{root}/part-{task.partitionId():06d}-{number:04d}.warc.zst"
            body = dictionary_frame(dictionary) + b"".join(parts)
            trial = f"{name}.{task.taskAttemptId()}.tmp"
            with store.open_output_stream(trial) as f:
                f.write(body)
            store.move(trial, name)
            out = pa.RecordBatch.from_pydict({"path": [name], "records": [len(parts)], "bytes": [len(body)]})
            parts, number, filled = [], number + 1, 0
            return out

        store.create_dir(root, recursive=True)
        for batch in batches:
            for p, url, text, sha1, n, first in zip(*(batch.column(c).to_pylist() for c in ("_page", "_url", "_html", "_sha1", "_size", "_first"))):
                sha1 = base32_of(sha1)
                if first is not None and n >= least and p != first:
                    raw = record(p, url, None, n, sha1, first)
                else:
                    raw = record(p, url, text.encode("utf-8", "surrogatepass"), n, sha1)
                parts.append(press.compress(raw))
                filled += len(parts[-1])
                if filled >= size:
                    yield close()
        if parts:
            yield close()

    return rows.select("_page", "_url", "_html", "_sha1", "_size", "_first").mapInArrow(run, "path string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in ``folder``, payloads checked against their digests.

    Columns: page_id, url, payload (null for revisits), payload_bytes,
    payload_digest, record_type, refers_to.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda text: int(text) if text else None
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for raw in records(content.as_py()):
                    named, http, payload = parse_record(raw)
                    sha1 = named["warc-payload-digest"].removeprefix("sha1:")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
                    response = named["warc-type"] == "response"
                    if response and (len(payload) != size or digest(payload) != sha1):
                        raise ValueError(f"payload of {named['warc-record-id']} is damaged")
                    rows.append({"page_id": number(named["page-id"]), "url": named.get("warc-target-uri"), "payload": payload if response else None,
                                 "payload_bytes": size, "payload_digest": sha1, "record_type": named["warc-type"],
                                 "refers_to": number(named.get("refers-to-page-id"))})
                    held += len(payload)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages),
g AS (SELECT h, bits, k, substr(bits, 1 + 5 * k, 5) AS five FROM (SELECT DISTINCT h, bits FROM p), range(0, 32) r(k)),
d AS (SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(five[1] AS INTEGER) + 8 * CAST(five[2] AS INTEGER)
        + 4 * CAST(five[3] AS INTEGER) + 2 * CAST(five[4] AS INTEGER) + CAST(five[5] AS INTEGER), 1), '' ORDER BY k) AS payload_digest
      FROM g GROUP BY h)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM p JOIN d USING (h) WINDOW w AS (PARTITION BY h)"""


@query("op4_warc", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder).agg(F.sum("records")).collect()  # one row
    return read_archives(spark, folder).drop("payload", "url")
