"""WARC archives in Zstandard with a dictionary: one frame per record.

An archive starts with a skippable frame that holds the dictionary; each
record after it is a frame of its own, so a reader can start at any record.
Archives are rows ``(archive, content)`` of bounded size in a table, or files
of a folder (``write_files``, ``read_files``; a file must stay under 2 GB).

Archives of other writers are read too: WARC/1.0 and 1.1, header names in any
case, folded header lines, any record type, SHA-1, SHA-256 and MD5 digests in
base32 or hex or none, a compressed dictionary, none, other skippable frames.
Of a record that holds an HTTP message the payload is its body. The payload
digest is checked unless the record is cut short, segmented, a revisit, or its
body sent in chunks (writers differ there); digests of other kinds are not.

Defined results: a null payload is empty; a record without a target URI has no
such header; repeated rows are written each; a null id sorts after all others
when the response among equal payloads is chosen (the smallest id); an empty
table gives no archive; columns other than those named are not read. Very long
payloads are records like others; one task holds one archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, settle, table

SKIPPABLE = 0x184D2A5D  # skippable frame that holds a dictionary (fixed by the format)
MAGIC = b"\x28\xb5\x2f\xfd"
ARCHIVE_BYTES = 16 << 20  # payload bytes after which an archive is closed
DICT_BYTES = 16 << 10
DICT_SAMPLE = 200  # records, of at most SAMPLE_BYTES each, that an archive's dictionary is trained on
SAMPLE_BYTES = 8 << 10
VERSION = b"WARC/1.1"
READABLE = (b"WARC/1.0", b"WARC/1.1")
DIGESTS = ("sha1", "sha256", "md5")
FEED_BYTES = 64 << 10  # compressed bytes given to the decoder at a time
# The headers of the standard that a record has once at most
SINGLE = {"warc-type", "warc-record-id", "warc-date", "content-length", "content-type", "warc-block-digest", "warc-payload-digest",
          "warc-ip-address", "warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date", "warc-target-uri", "warc-truncated",
          "warc-warcinfo-id", "warc-filename", "warc-profile", "warc-identified-payload-type", "warc-segment-origin-id",
          "warc-segment-number", "warc-segment-total-length", "warc-payload-length"}
DATE = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    pass


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed record. A revisit holds no payload, only its digest, length and the record it refers to."""
    name = "null" if page_id is None else page_id
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE),
            ("Content-Type", "text/html; charset=utf-8"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Payload-Length", str(len(payload)))]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    block = b"" if revisit else payload
    head.append(("Content-Length", str(len(block))))
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    """Headers by lower-case name; a line that starts with white space continues the one before. Names that may come
    again (``WARC-Concurrent-To`` and those of no standard) keep all values, joined by a space."""
    found: list[list[str]] = []
    for line in head.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if found and text[:1] in (" ", "\t"):
            found[-1][1] += " " + text.strip()
            continue
        key, colon, value = text.partition(":")
        if not colon or not key.strip():
            raise WarcError(f"bad header line {line!r}")
        found.append([key.strip().lower(), value.strip()])
    headers: dict[str, str] = {}
    for key, value in found:
        if key in headers and key in SINGLE:
            raise WarcError(f"header {key} comes twice")
        headers[key] = f"{headers[key]} {value}" if key in headers else value
    return headers


def _check_digest(stated: str, data: bytes, what: str) -> None:
    """Compare a ``algorithm:value`` digest with the data; algorithms other than the known are passed over."""
    kind, _, value = stated.partition(":")
    if kind.strip().lower().replace("-", "") not in DIGESTS:
        return
    digest = hashlib.new(kind.strip().lower().replace("-", ""), data).digest()
    if value.strip().rstrip("=").upper() not in (base64.b32encode(digest).decode().rstrip("="), digest.hex().upper()):
        raise WarcError(f"{what} does not match")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (by lower-case name) and payload of a record; every length and the digests are checked."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    if not found or head.split(b"\r\n", 1)[0] not in READABLE:
        raise WarcError(f"not a record of {' or '.join(v.decode() for v in READABLE)}: {raw[:20]!r}")
    headers = _headers(head)
    for key in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"):
        if key.lower() not in headers:
            raise WarcError(f"header {key} is missing")
    name, length = headers["warc-record-id"], headers["content-length"]
    if not (length.isascii() and length.isdigit()) or int(length) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {length} does not fit a block of {len(rest) - 4} bytes")
    block = payload = rest[:-4]
    if "warc-block-digest" in headers:
        _check_digest(headers["warc-block-digest"], block, f"block digest of {name}")
    if headers["warc-type"].lower() == "revisit":
        stated = headers.get("warc-payload-length", "0")
        if not (stated.isascii() and stated.isdigit()):
            raise WarcError(f"payload length of {name} is no number")
        return headers, block
    chunked = False
    if headers.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        chunked = b"\r\ntransfer-encoding:" in http.lower()
    whole = "warc-truncated" not in headers and "warc-segment-number" not in headers
    if "warc-payload-digest" in headers and whole and not chunked:
        _check_digest(headers["warc-payload-digest"], payload, f"payload digest of {name}")
    if whole and headers.get("warc-payload-length", str(len(payload))) != str(len(payload)):
        raise WarcError(f"payload length of {name} does not match")
    return headers, payload


def pack_archive(records: list[bytes]) -> bytes:
    """Skippable frame with the dictionary, then one frame per record."""
    sample = [r[:SAMPLE_BYTES] for r in records[:: max(1, len(records) // DICT_SAMPLE)]][:DICT_SAMPLE]
    try:
        dictionary = zstandard.train_dictionary(DICT_BYTES, sample)
    except zstandard.ZstdError:  # too little to train on: the sample itself serves
        dictionary = zstandard.ZstdCompressionDict(b"".join(sample)[:DICT_BYTES].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = dictionary.as_bytes()
    pack = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_content_size=True, write_checksum=True)
    return SKIPPABLE.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw + b"".join(map(pack.compress, records))


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    if raw[:4] == MAGIC:  # the dictionary may itself be compressed
        one = zstandard.ZstdDecompressor().decompressobj()
        raw = one.decompress(raw)
        if not one.eof:
            raise WarcError("the compressed dictionary is cut off")
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind)


def _frame(reader: zstandard.ZstdDecompressor, view: memoryview, start: int) -> tuple[bytes, int]:
    """The content of the frame at ``start`` and where it ends. Fed in steps: what the decoder gives back unused is
    copied, and for a whole archive a record that would be quadratic."""
    one, parts, at = reader.decompressobj(), [], start
    try:
        size = zstandard.frame_content_size(view[start:start + 18])
        while not one.eof and at < len(view):
            parts.append(one.decompress(view[at:at + FEED_BYTES]))
            at = min(at + FEED_BYTES, len(view))
    except zstandard.ZstdError as e:
        raise WarcError(f"the frame at byte {start} cannot be decoded: {e}") from e
    record = b"".join(parts)
    if not one.eof or (size >= 0 and size != len(record)):
        raise WarcError(f"the frame at byte {start} is cut off")
    return record, at - len(one.unused_data)


def frames(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each, decoded with the dictionary of the leading skippable frame. An archive
    that starts with a record's frame has no dictionary."""
    view, at = memoryview(content), 0
    reader = zstandard.ZstdDecompressor()
    if view[:4] != MAGIC:
        if len(content) < 8 or int.from_bytes(content[:4], "little") != SKIPPABLE:
            raise WarcError("no leading dictionary frame")
        at = 8 + int.from_bytes(content[4:8], "little")
        if at > len(content):
            raise WarcError("the dictionary frame is cut off")
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(content[8:at]))
    while at < len(content):
        if view[at:at + 4] == MAGIC:
            record, at = _frame(reader, view, at)
            yield record
        elif len(view) - at >= 8 and int.from_bytes(view[at:at + 4], "little") & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + int.from_bytes(view[at + 4:at + 8], "little")
            if at > len(content):
                raise WarcError("a skippable frame is cut off")
        else:
            raise WarcError(f"no frame at byte {at}")


def _write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, number, records, size = TaskContext.get().partitionId(), 0, [], 0

    def close():
        nonlocal number, records, size
        out = pa.RecordBatch.from_arrays([pa.array([f"part-{task:05d}-{number:05d}.warc.zst"]), pa.array([pack_archive(records)], pa.binary())],
                                         names=["archive", "content"])
        number, records, size = number + 1, [], 0
        return out

    for batch in batches:
        for page_id, url, payload, digest, first in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "first"))):
            code = base64.b32encode(bytes.fromhex(digest)).decode()
            records.append(record_bytes(page_id, url, payload, code, first, first is not None and first != page_id))
            size += len(payload)
            if size >= ARCHIVE_BYTES:
                yield close()
    if records:
        yield close()


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """``(archive, content)``. Of records with equal payloads of at least ``least`` bytes the smallest id is the
    response and the others revisit it."""
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    slim = rows.where(large).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    copies = settle(slim.where("n > 1").select("digest", "first"))  # payloads met once need no partner
    shared = rows.join(copies, "digest", "left").withColumn("first", F.when(large, F.col("first")))
    out = settle(shared.mapInArrow(_write, "archive string, content binary"))
    discard(spark, copies)
    return out


RECORD = "archive string, record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def _length_and_digest(head: dict[str, str], payload: bytes) -> tuple[int | None, str | None]:
    """Bytes and bare SHA-1 of the payload; of a revisit, what its headers say of the payload that it does not hold."""
    if head["warc-type"].lower() != "revisit":
        return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    length, (kind, _, digest) = head.get("warc-payload-length"), head.get("warc-payload-digest", "").partition(":")
    return int(length) if length else None, digest.strip().upper() if kind.strip().lower() == "sha1" else None


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORD.split(", ")]
    types = [pa.int64() if " long" in f else pa.binary() if " binary" in f else pa.string() for f in RECORD.split(", ")]

    def emit(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for archive, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows, size = [], 0
            for raw in frames(content):
                head, payload = parse_record(raw)
                rows.append((archive, head["warc-record-id"], head["warc-type"].lower(), head.get("warc-target-uri"),
                             *_length_and_digest(head, payload), head.get("warc-refers-to"), payload))
                size += len(payload)
                if size > 4 << 20:
                    yield emit(rows)
                    rows, size = [], 0
            if rows:
                yield emit(rows)


def read_warc(archives: DataFrame, name_col: str = "archive", content_col: str = "content") -> DataFrame:
    """Every record of the archives; a damaged one raises ``WarcError``."""
    return archives.select(F.col(name_col).alias("archive"), F.col(content_col).alias("content")).mapInArrow(_read, RECORD)


def write_files(archives: DataFrame, folder: str) -> DataFrame:
    """Write every archive as a file of its name in ``folder`` (a shared path or a URI that pyarrow opens) and return
    ``(archive, n_bytes)``; the files are there when that result has been computed. A file gets its name once it is
    whole, so a repeated task replaces it by the same one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = f"{root}/.{uuid.uuid4().hex}.part"
                with system.open_output_stream(part, compression=None) as out:
                    out.write(content.as_buffer())
                system.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(c.as_buffer()) for c in batch.column(1)], pa.int64())],
                                             names=["archive", "n_bytes"])

    return archives.select("archive", "content").mapInArrow(run, "archive string, n_bytes long")


def read_files(spark: SparkSession, folder: str, pattern: str = "*.warc.zst") -> DataFrame:
    """The records of all archive files of a folder whose names fit ``pattern``, in any Spark file system."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return read_warc(files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    def page(c):
        return F.regexp_extract(F.col(c), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return read_warc(write_warc(table(spark, sf_dir, "pages"))).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


ORACLE = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, html, digest, min(page_id) OVER (PARTITION BY digest) AS first
      FROM (SELECT page_id, html,
                   list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                     1 + CAST(('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8)) & 31 AS INT), 1)),
                     'string_agg', '') AS digest
            FROM (SELECT page_id, html, sha1(coalesce(html, '')) AS h FROM pages)))
"""
