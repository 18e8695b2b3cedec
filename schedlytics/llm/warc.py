"""WARC archives with Zstandard: one frame per record, the dictionary in a leading skippable frame; writer and validating reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself compressed. Spark's own text
writer puts the bytes on any file system with its commit protocol, so a lost task leaves no half archive: every frame is
a row, and the row separator is an empty skippable frame, which is eight ASCII bytes and no content to a reader.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schedlytics.llm.tables import small_batches

# Frame marks of the format and the record framing.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
# Bytes of records that a task trains its archive's dictionary on, and the dictionary's size. Both change sizes only, never contents.
TRAINING_BYTES = 1 << 21
DICTIONARY_BYTES = 1 << 15


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str, payload: bytes | None, length: int, sha: str, refers_to) -> bytes:
    """One record: an HTTP response, or a revisit whose block is the same HTTP head without the payload. Ids are part of URNs."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    target = "".join(c if c.isprintable() and c != " " else "%" + format(ord(c), "02X") for c in url) or "urn:unknown"
    lines = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Block-Digest: sha1:{digest(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def planned(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, bytes, sha1 hex, refers_to): of equal payloads of ``least`` bytes or more all rows but one are revisits.

    The row with the smallest page_id (null last; then by url) is the response. Rows equal in both are told apart by their
    place in the scan. The first of each payload is found by a combinable minimum, then joined back, so that a payload with
    many copies is split by the adaptive join.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    me = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "url", "place")
    first = rows.groupBy("sha", "size").agg(F.min(me).alias("first"))
    rows = rows.join(first, ["sha", "size"])
    again = (F.col("first") != me) & (F.col("size") >= least)
    return rows.select("page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "sha", again.alias("revisit"), F.col("first.page_id").alias("first_id"))


def write_archives(pages: DataFrame, path: str, least: int = 0) -> str:
    """Write every row of ``pages`` (page_id, url, html) as a record; several archives below ``path``, one
    for each partition of the join that finds the revisits, which adaptive execution merges and splits by size.

    Nulls: an empty payload, no url (``urn:unknown``), the id ``none``. Other columns are not read. An empty table gives no records.
    """
    small_batches(pages.sparkSession)
    rows = planned(pages, least)

    def frames(batches):
        held, size, codec = [], 0, None

        def start():
            raw = b""
            if size > DICTIONARY_BYTES * 4 and len(held) >= 16:
                try:
                    raw = zstandard.train_dictionary(DICTIONARY_BYTES, held).as_bytes()
                except zstandard.ZstdError:
                    pass
            if not raw:
                raw = b"".join(held)[:DICTIONARY_BYTES].ljust(8, b"\n")
            packed = zstandard.ZstdCompressor().compress(raw)
            kind = zstandard.DICT_TYPE_AUTO
            own = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind), write_checksum=True, write_content_size=True)
            return own, struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed

        def batch_of(values):
            return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])

        for batch in batches:
            out = []
            for page_id, url, payload, length, sha, revisit, first in zip(*[batch.column(i).to_pylist() for i in range(7)], strict=True):
                refers = None if not revisit else "none" if first is None else first
                made = record(page_id, url, payload, length, base64.b32encode(bytes.fromhex(sha)).decode(), refers)
                if codec is None:
                    held.append(made)
                    size += len(made)
                    if size >= TRAINING_BYTES:
                        codec, head = start()
                        out += [head, *map(codec.compress, held)]
                        held = []
                else:
                    out.append(codec.compress(made))
            if out:
                yield batch_of(out)
        if codec is None and held:
            codec, head = start()
            yield batch_of([head, *map(codec.compress, held)])

    # The text writer writes the bytes of a value as they are; the cast changes none.
    rows.mapInArrow(frames, "value binary").select(F.col("value").cast("string").alias("value")).write.mode("overwrite").option("lineSep", EMPTY_FRAME).text(path)
    return path


def frame_spans(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """(magic, start, end) of each frame, found from frame and block headers without decoding."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError(f"truncated frame at byte {at}")
        magic, start = struct.unpack_from("<I", data, at)[0], at
        if magic in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            checksum = data[at + 4] & 4
            at += zstandard.frame_header_size(data[at:at + 18])
            last = False
            while not last:
                if at + 3 > len(data):
                    raise ValueError(f"truncated block in the frame at byte {start}")
                head = int.from_bytes(data[at:at + 3], "little")
                last, kind, size = bool(head & 1), head >> 1 & 3, head >> 3
                if kind == 3:
                    raise ValueError(f"reserved block type in the frame at byte {start}")
                at += 3 + (1 if kind == 1 else size)
            at += 4 if checksum else 0
        else:
            raise ValueError(f"no frame at byte {at}")
        if at > len(data):
            raise ValueError(f"truncated frame at byte {start}")
        yield magic, start, at


def parse_record(raw: bytes) -> dict:
    """Headers, block and payload of one record; a wrong header, length or digest raises ValueError."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip() or name.lower() in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise ValueError(f"missing headers {sorted(missing)}")
    if not headers["content-length"].isdecimal() or int(headers["content-length"]) != len(rest) - 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("Content-Length differs from the block")
    block = rest[:-4]
    if (said := headers.get("warc-block-digest")) and said != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    out = {"headers": headers, "block": block, "payload": block, "length": len(block)}
    if headers.get("content-type", "").startswith("application/http"):
        http, mark, payload = block.partition(b"\r\n\r\n")
        sizes = [x.split(b":")[1].strip() for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
        if not mark or len(sizes) != 1 or not sizes[0].isdigit():
            raise ValueError("bad HTTP head")
        out |= {"payload": payload, "length": int(sizes[0])}
    if headers["warc-type"] == "revisit":
        if "warc-refers-to" not in headers or "warc-profile" not in headers or out["payload"]:
            raise ValueError("bad revisit")
    elif out["length"] != len(out["payload"]) or headers.get("warc-payload-digest", f"sha1:{digest(out['payload'])}") != f"sha1:{digest(out['payload'])}":
        raise ValueError("payload length or digest differs")
    return out


def records(data: memoryview) -> Iterator[bytes]:
    """The decoded records of one archive."""
    codec = None
    for magic, start, end in frame_spans(data):
        if magic == DICTIONARY_MAGIC and start == 0:
            raw = bytes(data[8:end])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                raw = zstandard.ZstdDecompressor().decompress(raw)
            codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        elif magic == FRAME_MAGIC:
            codec = codec or zstandard.ZstdDecompressor()
            size = zstandard.get_frame_parameters(data[start:start + 18]).content_size
            if size == zstandard.CONTENTSIZE_UNKNOWN:
                raise ValueError(f"the frame at byte {start} does not tell its size")
            made = codec.decompress(data[start:end])
            if len(made) != size:
                raise ValueError(f"the frame at byte {start} has another size than it tells")
            yield made


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record below ``path``: page_id, url, record_type, refers_to, payload (null for a revisit), payload_bytes, payload_digest.

    An archive is one task's input, a frame is decoded at a time. Damage raises an error that names the archive.
    """
    small_batches(spark)
    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
    names = [x.split()[0] for x in schema.split(", ")]
    number = lambda urn: None if urn is None or urn == "<urn:page:none>" else int(urn[len("<urn:page:"):-1])

    def run(batches):
        def out(rows):
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                try:
                    for raw in records(memoryview(content.as_buffer())):
                        x = parse_record(raw)
                        h, again = x["headers"], x["headers"]["warc-type"] == "revisit"
                        rows.append((number(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"], number(h.get("warc-refers-to")) if again else None,
                                     None if again else x["payload"], x["length"], h.get("warc-payload-digest", "").removeprefix("sha1:")))
                        size += len(raw)
                        if size > 1 << 22:
                            yield out(rows)
                            rows, size = [], 0
                except (ValueError, zstandard.ZstdError) as error:
                    raise ValueError(f"{name}: {error}") from error
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").repartition(F.col("path"))
    return files.mapInArrow(run, schema)
