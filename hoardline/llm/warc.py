"""WARC archives compressed record by record with a Zstandard dictionary in a leading skippable frame.

Each task writes one archive through Spark's own text writer, which puts raw bytes on any file system and commits
whole files. That writer ends every row with a line feed; the line feed is made the payload of an empty
skippable frame, so an archive stays a plain sequence of frames: the dictionary, then one frame per record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import text_or_empty
from hoardline.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
PADDING_MAGIC = 0x184D2A50
LINE_END = struct.pack("<II", PADDING_MAGIC, 1)  # the writer's line feed completes this frame

DICTIONARY_BYTES = 64 << 10
TRAINING_BYTES = 4 << 20
LEVEL = 6
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"


def classified(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, first_id``: of equal payloads of ``min_bytes`` or more, all rows carry the smallest
    page id in ``first_id``. Only ids and digests are grouped; the payloads meet their group's single row in a join that can be split."""
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        text_or_empty(html_column).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    firsts = rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("digest").alias("_digest")).agg(F.min("page_id").alias("first_id"))
    return rows.join(firsts.hint("shuffle_hash"), F.col("digest") == F.col("_digest"), "left").drop("_digest")


def _block(page_id, url, payload: bytes, digest: str, first_id) -> bytes:
    """One WARC record. A revisit carries the HTTP header of its payload, not the payload."""
    revisit = first_id is not None and page_id != first_id
    name = "null" if page_id is None else str(page_id)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Refers-To", f"<urn:page:{first_id}>" if revisit else None),
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary from archived records; too few to train on become a dictionary of their raw bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _frames(records: Iterator[bytes], dictionary_bytes: int, training_bytes: int, level: int) -> Iterator[bytes]:
    held: list[bytes] = []
    used, compressor = 0, None

    def begin():
        dictionary = trained(held, dictionary_bytes)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
        made = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        return head, made

    for record in records:
        if compressor is not None:
            yield compressor.compress(record)
            continue
        held.append(record)
        used += len(record)
        if used >= training_bytes:
            head, compressor = begin()
            yield head
            yield from map(compressor.compress, held)
            held = []
    if held:
        head, compressor = begin()
        yield head
        yield from map(compressor.compress, held)


def write(rows: DataFrame, path: str, dictionary_bytes: int = DICTIONARY_BYTES, training_bytes: int = TRAINING_BYTES, level: int = LEVEL) -> None:
    """Archives below ``path``, one per partition of ``rows`` (as ``classified`` returns them). The dictionary of an archive is
    trained on its own first ``training_bytes``, which is all a task holds besides a batch."""

    def run(batches):
        records = (
            _block(*values)
            for batch in batches
            for values in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "digest", "first_id")), strict=True)
        )
        for frame in _frames(records, dictionary_bytes, training_bytes, level):
            yield pa.RecordBatch.from_arrays([pa.array([frame + LINE_END], pa.binary())], ["frame"])

    frames = rows.select("page_id", "url", "payload", "digest", "first_id").mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").option("compression", "none").text(path)


def _records(data: bytes) -> Iterator[bytes]:
    """The records of one archive; frames are read one after the other."""
    at, view, decompressor = 0, memoryview(data), zstandard.ZstdDecompressor()
    while at < len(data):
        magic, length = struct.unpack_from("<II", data, at)
        if magic == DICTIONARY_MAGIC:
            decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + length])))
            at += 8 + length
        elif magic & 0xFFFFFFF0 == PADDING_MAGIC:
            at += 8 + length
        else:
            one = decompressor.decompressobj()
            start, step, parts = at, 1 << 12, []
            while not one.eof:
                piece = view[start : start + step]
                if not len(piece):
                    raise ValueError("an archive ends inside a record")
                parts.append(one.decompress(piece))
                start, step = start + len(piece), min(2 * step, 1 << 20)
            at = start - len(one.unused_data)
            yield b"".join(parts)


def parsed(record: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest and length."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if lines[0] != "WARC/1.1" or rest[int(fields["Content-Length"]) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("a payload differs from its digest")

    def page(name: str):
        value = fields.get(name, "<urn:page:null>")[len("<urn:page:") : -1]
        return None if value == "null" else int(value)

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
    }


READ_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(spark, path: str) -> DataFrame:
    """One row per record of the archives below ``path``; a revisit has no payload of its own."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def run(batches):
        for batch in batches:
            for value in batch.column(0):
                held, used = [], 0
                for record in _records(value.as_py()):
                    held.append(parsed(record))
                    used += len(record)
                    if used > 8 << 20 or len(held) >= 5_000:
                        yield pa.RecordBatch.from_pylist(held, pa.schema(list(kinds.items())))
                        held, used = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, pa.schema(list(kinds.items())))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, READ_SCHEMA)


def archive(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes all of ``pages`` and returns what the archives hold, one row per page.

    Null html is an empty payload; null urls are left out. Rows that share the smallest page id of a payload are all
    responses; rows without an id are revisits if another row of the payload has one. An empty table gives no rows."""
    path = path or scratch_path(pages.sparkSession, "warc")
    write(classified(pages, min_bytes), path)
    return read(pages.sparkSession, path)
