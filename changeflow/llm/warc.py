"""WARC archives, one Zstandard frame per record, with a dictionary in the leading skippable frame."""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.skew import hot_from_counts, salted_left_join
from changeflow.session import materialise

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Payload bytes after which a task starts a new archive, and the payload bytes its dictionary is trained on.
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10

#: Compressed bytes handed to the decoder at a time.
STEP = 8 << 10

PAGE = re.compile(r"<urn:page:(-?\d+|null)>")


class BadArchive(ValueError):
    """An archive that breaks its format; the message says where and how."""


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def page_uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    found = PAGE.fullmatch(uri)
    if not found:
        raise BadArchive(f"not a page: {uri}")
    return None if found[1] == "null" else int(found[1])


def digest_header(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(binascii.unhexlify(sha1_hex)).decode()


def digest_hex(header: str) -> str:
    kind, _, value = header.partition(":")
    if kind != "sha1" or len(value) != 32:
        raise BadArchive(f"not a SHA-1: {header}")
    return base64.b32decode(value).hex()


def safe_uri(url: str | None) -> str:
    """Control characters and spaces would break a header; they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, revisit: bool
) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_uri(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {safe_uri(url)}",
        f"WARC-Payload-Digest: {digest_header(payload_digest)}",
        f"WARC-Block-Digest: {digest_header(hashlib.sha1(block).hexdigest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {page_uri(refers_to)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> zstd.ZstdCompressionDict:
    """A dictionary from the first records of an archive, or their raw bytes where there are too few to train on."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
    except zstd.ZstdError:
        raw = b"".join(samples)[:DICTIONARY_BYTES]
        return zstd.ZstdCompressionDict(raw if len(raw) >= 8 else raw.ljust(8), dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes]) -> bytes:
    """The archive of some records: the dictionary in a skippable frame, then a frame per record.

    Frames state their content size and carry a checksum. The dictionary is itself compressed.
    """
    taken = samples = 0
    while samples < len(records) and taken < SAMPLE_BYTES:
        taken += len(records[samples])
        samples += 1
    dictionary = trained(records[:samples])
    packed = zstd.ZstdCompressor().compress(dictionary.as_bytes())
    writer = zstd.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)
    leading = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed
    return leading + b"".join(map(writer.compress, records))


def dictionary_of(archive: bytes) -> tuple[zstd.ZstdCompressionDict | None, int]:
    """The dictionary in the leading skippable frame, if there is one, and where the records begin."""
    if len(archive) < 8:
        raise BadArchive("no frame")
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_FRAME:
        return None, 0
    if len(archive) < 8 + size:
        raise BadArchive("the dictionary is cut off")
    content = archive[8 : 8 + size]
    if content[:4] == FRAME_MAGIC:
        content = zstd.ZstdDecompressor().decompress(content)
    return zstd.ZstdCompressionDict(content), 8 + size


def frames(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every record frame, decoded one at a time; other skippable frames are passed over."""
    dictionary, at = dictionary_of(archive)
    reader = zstd.ZstdDecompressor(dict_data=dictionary) if dictionary else zstd.ZstdDecompressor()
    view = memoryview(archive)
    while at < len(archive):
        magic = struct.unpack_from("<I", archive, at)[0] if len(archive) - at >= 8 else 0
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", archive, at + 4)[0]
            continue
        frame, parts, end = reader.decompressobj(), [], at
        try:
            stated = zstd.get_frame_parameters(view[at : at + 18]).content_size
            while not frame.eof and end < len(archive):
                parts.append(frame.decompress(view[end : end + STEP]))
                end = min(end + STEP, len(archive))
        except zstd.ZstdError as e:
            raise BadArchive(f"frame at {at}: {e}") from e
        if not frame.eof:
            raise BadArchive(f"frame at {at} is cut off")
        content = b"".join(parts)
        if stated != zstd.CONTENTSIZE_UNKNOWN and stated != len(content):
            raise BadArchive(f"frame at {at} states {stated} bytes and holds {len(content)}")
        yield at, content
        at = end - len(frame.unused_data)


def header_lines(raw: bytes, where: str) -> dict[str, str]:
    found = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.decode().partition(":")
        if not colon or name != name.strip() or not name:
            raise BadArchive(f"{where}: bad header line {line!r}")
        found[name.lower()] = value.strip()
    return found


def parsed(content: bytes, where: str) -> Record:
    """A record's parts, with its lengths and digests checked."""
    head, blank, rest = content.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version not in (b"WARC/1.0", VERSION) or not blank:
        raise BadArchive(f"{where}: not a WARC record")
    headers = header_lines(lines, where)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadArchive(f"{where}: no {name}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4:
        raise BadArchive(f"{where}: content-length {headers['content-length']} does not fit {len(rest) - 4}")
    if rest[-4:] != b"\r\n\r\n":
        raise BadArchive(f"{where}: no end of record")
    block = rest[:-4]
    if "warc-block-digest" in headers and digest_hex(headers["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise BadArchive(f"{where}: wrong block digest")
    if not headers.get("content-type", "").startswith("application/http"):
        return Record(headers, {}, block)
    http_head, http_blank, payload = block.partition(b"\r\n\r\n")
    status, _, http_lines = http_head.partition(b"\r\n")
    if not status.startswith(b"HTTP/") or not http_blank:
        raise BadArchive(f"{where}: not an HTTP response")
    http = header_lines(http_lines, where)
    revisit = headers["warc-type"] == "revisit"
    if not revisit:
        if int(http.get("content-length", len(payload))) != len(payload):
            raise BadArchive(f"{where}: HTTP content-length does not fit")
        if "warc-payload-digest" in headers and digest_hex(headers["warc-payload-digest"]) != hashlib.sha1(payload).hexdigest():
            raise BadArchive(f"{where}: wrong payload digest")
    elif payload or "warc-refers-to" not in headers:
        raise BadArchive(f"{where}: a revisit refers to its payload")
    return Record(headers, http, payload)


def records_of(archive: bytes, path: str = "") -> Iterator[Record]:
    for at, content in frames(archive):
        yield parsed(content, f"{path} at {at}")


def with_revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, payload_digest, revisit, refers_to`` of every row of ``pages``.

    Among payloads of at least ``least_bytes`` that are equal, in SHA-1 and length, those with the largest
    ``page_id`` are responses and the others revisit it. A null html is the empty payload. A null ``page_id``
    is smaller than any other; rows that repeat the largest are all responses.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    made = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    made = made.withColumn("payload_digest", F.sha1("payload"))
    long = F.octet_length("payload") >= least_bytes
    key = F.when(long, F.concat_ws("/", "payload_digest", F.octet_length("payload")))
    groups = (
        made.select(key.alias("same"), "page_id")
        .where("same IS NOT NULL")
        .groupBy("same")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
        .where("n > 1")
    )
    groups = materialise(groups, "payloads")
    joined = salted_left_join(
        made.withColumn("same", key), groups.select("same", "head"), "same", "page_id", hot_from_counts(groups, "same", "n")
    )
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest", revisit.alias("revisit"), F.when(revisit, F.col("head")).alias("refers_to")
    )


def archives(records: DataFrame, archive_limit: int = ARCHIVE_BYTES) -> DataFrame:
    """``path, content``: archives of ``records`` (as :func:`with_revisits` gives them), as a file reader would list them.

    A task closes an archive after ``archive_limit`` bytes, so one is held at a time. The rows are meant to be
    written to a table; ``content`` is a whole ``.warc.zst`` file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        size = number = 0

        def closed() -> pa.RecordBatch:
            content = archive_bytes(waiting)
            path = f"{hashlib.sha1(content).hexdigest()}-{number:05d}.warc.zst"
            return pa.RecordBatch.from_pylist(
                [{"path": path, "content": content}], schema=pa.schema([("path", pa.string()), ("content", pa.binary())])
            )

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                waiting.append(record_bytes(**row))
                size += len(waiting[-1])
                if size >= archive_limit:
                    yield closed()
                    waiting, size, number = [], 0, number + 1
        if waiting:
            yield closed()

    columns = ("page_id", "url", "payload", "payload_digest", "refers_to", "revisit")
    return records.select(*columns).mapInArrow(write, "path string, content binary")


RECORD_ROW = "path string, record_type string, page_id long, url string, payload binary, payload_bytes long, payload_digest string, refers_to long"


def read_archives(files: DataFrame) -> DataFrame:
    """The page records of ``files`` (``path, content``, as ``spark.read.format("binaryFile")`` gives them).

    Frames are decoded one by one; a broken frame, header, length or digest stops the job with
    :class:`BadArchive`. A revisit has no payload of its own: its length and digest are those it states.
    Records of other types are passed over.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("path", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
            ]
        )
        for batch in batches:
            for path, content in zip(batch[0].to_pylist(), batch[1], strict=True):
                rows: list[dict] = []
                for r in records_of(content.as_buffer().to_pybytes(), path):
                    kind = r.headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    refers = r.headers.get("warc-refers-to")
                    rows.append(
                        {
                            "path": path,
                            "record_type": kind,
                            "page_id": page_of(r.headers["warc-record-id"]),
                            "url": r.headers.get("warc-target-uri"),
                            "payload": r.payload if kind == "response" else None,
                            "payload_bytes": int(r.http.get("content-length", len(r.payload))),
                            "payload_digest": digest_hex(r.headers["warc-payload-digest"]),
                            "refers_to": page_of(refers) if refers else None,
                        }
                    )
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.select("path", "content").mapInArrow(read, RECORD_ROW)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``) and read the archives back.

    Every row gives one record, repeated rows too; an empty table gives no archive and no rows.
    """
    return read_archives(materialise(archives(with_revisits(pages)), "archives"))


SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN head END AS refers_to
FROM r
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
