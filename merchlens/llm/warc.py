"""WARC archives in Zstandard: writer and reader.

A file starts with a skippable frame that holds the dictionary, followed by one frame per
record. The writer trains the dictionary on a bounded number of its first records (and writes
no dictionary where those are too few); the reader loads it, decodes frame after frame in
pieces of the file, and checks each record: version line, required headers, Content-Length
against the block, the two closing line ends, and the payload against its SHA-1. Files are
written and read inside tasks, by URIs that ``pyarrow.fs`` understands, in the shared folder.

Of records with equal payloads of at least ``least`` bytes, those with the smallest page_id are
responses; others are revisits: they carry the digest and length of the full payload and the page
they refer to, but no payload.

Defined cases: a null html is an empty payload; a null url leaves the target out; rows that repeat
the smallest page_id of their payload are all responses; a row without page_id revisits a page with
an id if one has its payload, else it is a response; an empty table gives no archive and an empty
result; other columns are never read. A broken record raises, or is returned with ``error`` set
when ``strict`` is off.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import scratch_path, store, table

# Fixed values of the formats.
SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
FRAME = (0xFD2FB528).to_bytes(4, "little")
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 64 * 1024 * 1024
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 200, 16_384, 65_536
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to, revisit: bool, date: str = DATE) -> bytes:
    """One record: an HTTP response with its payload, or a revisit with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    named = "" if page_id is None else str(page_id)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{named}|{url}|{revisit}')}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-Id", named))
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Page", str(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one decoded frame; raises ValueError where it is no valid record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC version line or no end of the headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"malformed header {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(name):
            raise ValueError(f"header {name} is missing")
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(rest) - 4} bytes")
    block, kind = rest[:length], fields["warc-type"]
    _, ended, payload = block.partition(b"\r\n\r\n")
    if fields.get("content-type", "").startswith("application/http") and not ended:
        raise ValueError("the HTTP headers do not end")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and stated and stated != digest(payload):
        raise ValueError("the payload does not have the stated digest")
    if kind == "revisit" and (payload or not stated or "warc-refers-to-page" not in fields):
        raise ValueError("a revisit needs a digest and a page, and no payload")
    size = int(fields.get("warc-payload-length", len(payload)))
    if kind == "response" and size != len(payload):
        raise ValueError(f"the payload has {len(payload)} bytes, not {size}")
    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page")
    return {
        "page_id": int(page) if page else None, "record_type": kind, "target_uri": fields.get("warc-target-uri"),
        "payload_digest": stated or digest(payload), "payload_bytes": size,
        "refers_to": int(refers) if refers else None, "payload": payload,
    }


def dictionary_frame(sample: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """A skippable frame with a trained dictionary; nothing where even a small one cannot be trained."""
    size = min(DICTIONARY_BYTES, sum(map(len, sample)) // 8)
    while size >= 256:
        try:
            trained = zstandard.train_dictionary(size, sample)
        except zstandard.ZstdError:  # too few, too small or too alike for this size
            size //= 4
            continue
        content = trained.as_bytes()
        return SKIPPABLE + len(content).to_bytes(4, "little") + content, trained
    return b"", None


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Archives of ``records`` (page_id, url, payload, refers_to, revisit) below ``folder``; (path, records, bytes) of each.

    Every attempt of a task writes names of its own, so only what the stored result lists counts.
    """
    def of(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        number, held, out, done = 0, [], None, []

        def start(sample):
            name = posixpath.join(base, f"{stem}-{number:05d}.warc.zst")
            head, trained = dictionary_frame([x[:SAMPLE_BYTES] for x in sample])
            stream = system.open_output_stream(name, compression=None)
            stream.write(head)
            press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
            return [posixpath.join(folder.rstrip("/"), posixpath.basename(name)), stream, press, 0, len(head)]

        def put(record):
            frame = out[2].compress(record)
            out[1].write(frame)
            out[3] += 1
            out[4] += len(frame)

        def flush():
            nonlocal out, held
            out = start(held)
            for record in held:
                put(record)
            held = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                record = record_bytes(row[0], row[1], row[2], row[3], row[4])
                if out is None:
                    held.append(record)
                    if len(held) >= SAMPLE_RECORDS or sum(map(len, held[-1:])) > FILE_BYTES:
                        flush()
                else:
                    put(record)
                if out is not None and out[4] >= FILE_BYTES:
                    out[1].close()
                    done.append((out[0], out[3], out[4]))
                    number, out = number + 1, None
        if held:
            flush()
        if out is not None:
            out[1].close()
            done.append((out[0], out[3], out[4]))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*done, strict=True)], ["path", "records", "bytes"])

    return store(
        records.select("page_id", "url", "payload", "refers_to", "revisit").mapInArrow(of, MANIFEST), "warc-manifest"
    )


def frames(stream, piece: int = 65_536):
    """Yield (offset, bytes) of every record's frame of an open archive."""
    data, at = stream.read(8), 0
    trained = None
    if data[:4] == SKIPPABLE:
        size = int.from_bytes(data[4:8], "little")
        content = stream.read(size)
        if len(content) != size:
            raise ValueError("the dictionary is cut off")
        if content[:4] == FRAME:  # the dictionary may itself be compressed
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        trained = zstandard.ZstdCompressionDict(content)
        data, at = b"", 8 + size
    opener = zstandard.ZstdDecompressor(dict_data=trained)
    while data or (data := stream.read(piece)):
        frame, parts, used = opener.decompressobj(), [], 0
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                used += len(data) - len(frame.unused_data)
                data = frame.unused_data
                break
            used += len(data)
            data = stream.read(piece)
            if not data:
                raise ValueError(f"the frame at {at} is cut off")
        yield at, b"".join(parts)
        at += used


def read_archives(archives: DataFrame, strict: bool = True, payload: bool = False) -> DataFrame:
    """One row per record of the archives listed in ``archives`` (path), read in parallel by file."""
    names = ["archive", "position", "page_id", "record_type", "target_uri", "payload_digest", "payload_bytes", "refers_to", "error", "payload"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = (
        "archive string, position long, page_id long, record_type string, target_uri string, payload_digest string, "
        "payload_bytes long, refers_to long, error string, payload binary"
    )

    def of(batches):
        from pyarrow import fs

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names
            )

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, base = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with system.open_input_stream(base, compression=None) as stream:
                    try:
                        for at, data in frames(stream):
                            try:
                                row = parse_record(data)
                            except ValueError as error:
                                if strict:
                                    raise
                                row = {"error": str(error)}
                            if not payload:
                                row.pop("payload", None)
                            rows.append(row | {"archive": path, "position": at})
                            size += len(data) if payload else 200
                            if size > 8_000_000:
                                yield batch_of(rows)
                                rows, size = [], 0
                    except (ValueError, zstandard.ZstdError) as error:
                        if strict:
                            raise ValueError(f"{path}: {error}") from error
                        rows.append({"archive": path, "error": str(error)})
                if rows:
                    yield batch_of(rows)

    paths = archives.select("path")
    out = paths.repartition(max(1, paths.count())).mapInArrow(of, schema)
    return out if payload else out.drop("payload")


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) of ``pages`` (page_id, url, html)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")
    ).withColumn("_digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    first = (
        rows.filter(large).groupBy("_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").select(F.col("_digest").alias("_of"), "first_id")
    )
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    return rows.join(first, (F.col("_digest") == F.col("_of")) & large, "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit")
    )


def op1_warc(spark, sf_dir: str) -> DataFrame:
    archives = write_archives(mark_revisits(table(spark, sf_dir, "pages")), scratch_path(spark, "warc"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 writes five hex digits as four letters; SHA-1 has eight such groups.
OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first_id FROM p GROUP BY hex)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(p.hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f USING (hex)
"""
