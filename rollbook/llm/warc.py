"""WARC archives compressed with Zstandard, a frame a record, and a reader that validates them.

An archive begins with a skippable frame that holds the dictionary all its records are compressed with.
Archives are rows of bytes: a table of them can be written anywhere Spark writes to, and archives that lie
in files are read by ``binaryFile`` into the same form.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENDS = b"\r\n\r\n"
#: Payload bytes after which an archive is closed; dictionary size; samples it is trained on.
ARCHIVE_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 14
SAMPLES = 128
DATE = "1970-01-01T00:00:00Z"
RECORDS = "archive string, place int, record_id string, uri string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value: str) -> bytes:
    return f"{name}: {value}\r\n".encode()


def record(kind: str, record_id: str, uri: str | None, payload: bytes, refers_to: str | None, of_payload: str) -> bytes:
    """A response, or a revisit that leaves the payload out but tells its length and digest."""
    http = b"HTTP/1.1 200 OK\r\n" + _line("Content-Type", "text/html; charset=utf-8") + _line("Content-Length", str(len(payload))) + b"\r\n"
    block = http + (payload if kind == "response" else b"")
    head = VERSION + b"\r\n" + _line("WARC-Type", kind) + _line("WARC-Record-ID", record_id) + _line("WARC-Date", DATE)
    if uri is not None:  # a line break can't stand in a header
        head += _line("WARC-Target-URI", uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head += _line("WARC-Payload-Digest", f"sha1:{of_payload}")
    if kind == "revisit":
        head += _line("WARC-Profile", PROFILE) + _line("WARC-Refers-To", refers_to or "")
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", str(len(block)))
    return head + b"\r\n" + block + ENDS


def archive(records: list[bytes]) -> bytes:
    """Records as frames behind the dictionary they share. It is trained on some of the archive's first
    records; too few of them for training give their bytes as it is."""
    samples = [r[:8192] for r in records[:SAMPLES]]
    try:
        shared = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        shared = b"".join(samples)[:DICTIONARY_BYTES]
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(shared), write_checksum=True)
    packed = zstandard.ZstdCompressor(level=3).compress(shared)
    head = DICTIONARY_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    return head + b"".join(packer.compress(r) for r in records)


def frames(content: bytes) -> Iterator[bytes]:
    """Contents of the frames of an archive, one record each."""
    at, shared = 0, None
    if int.from_bytes(content[:4], "little") == DICTIONARY_MAGIC:
        size = int.from_bytes(content[4:8], "little")
        if len(content) < 8 + size:
            raise ValueError("the dictionary frame is cut off")
        raw = content[8 : 8 + size]
        if raw[:4] == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        shared = zstandard.ZstdCompressionDict(raw)
        at = 8 + size
    unpacker = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    step = 1 << 14
    while at < len(content):
        one, out = unpacker.decompressobj(), []
        while not one.eof:
            if at >= len(content):
                raise ValueError("a frame is cut off")
            part = content[at : at + step]
            out.append(one.decompress(part))
            at += len(part)
        at -= len(one.unused_data)
        yield b"".join(out)


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError(f"not a header: {line[:60]!r}")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def parse_record(raw: bytes) -> dict:
    """A record's fields; raises ValueError where version, headers, lengths or digest are wrong."""
    head, cut, rest = raw.partition(ENDS)
    lines = head.split(b"\r\n")
    if not cut or lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {raw[:20]!r}")
    told = _headers(lines[1:])
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in told:
            raise ValueError(f"no header {name}")
    length = int(told["content-length"])
    if len(rest) != length + len(ENDS) or rest[length:] != ENDS:
        raise ValueError(f"content length {length}, but {len(rest) - len(ENDS)} bytes")
    kind = told["warc-type"]
    uri = told.get("warc-target-uri")
    if uri is not None:
        uri = uri.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    out = {"record_id": told["warc-record-id"], "uri": uri, "record_type": kind, "payload": None, "refers_to": None, "payload_bytes": None, "payload_digest": None}
    if kind not in ("response", "revisit"):
        return out
    http, cut, payload = rest[:length].partition(ENDS)
    if not cut or not http.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    out["payload_bytes"] = int(_headers(http.split(b"\r\n")[1:])["content-length"])
    out["payload_digest"] = told["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != out["payload_bytes"] or digest(payload) != out["payload_digest"]:
            raise ValueError("payload does not match its length or digest")
        out["payload"] = payload
    else:
        if payload or "warc-refers-to" not in told:
            raise ValueError("a revisit has a payload or refers to nothing")
        out["refers_to"] = told["warc-refers-to"] or None
    return out


def write_archives(
    pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``archive, content``: the pages (null html: empty) as archives of about ``archive_bytes`` payload.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the greatest id is the response
    and the others revisit it; repeated rows of the greatest id are all responses, as are pages without id
    where none has one. Record ids are ``<urn:page:ID>``, ``<urn:page:>`` without id.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha1(F.col("html").cast("binary")))
    last = rows.groupBy("sha").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
    # Alone, or without a target: a response. Many copies of one payload are split by AQE's skew join.
    told = rows.join(last.filter("n > 1").select("sha", "last"), "sha", "left")
    revisit = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")) & (F.octet_length("html") >= least_bytes)
    told = told.select("id", "url", "html", F.when(revisit, F.col("last")).alias("target"))

    def write(batches):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def closed() -> pa.RecordBatch:
            content = archive(held)
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{n:06d}.warc.zst"]), pa.array([content], pa.binary())], ["archive", "content"])

        for batch in batches:
            for i, url, html, target in zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True):
                payload = html.encode()
                name = lambda x: f"<urn:page:{'' if x is None else x}>"
                kind = "response" if target is None else "revisit"
                held.append(record(kind, name(i), url, payload, None if target is None else name(target), digest(payload)))
                size += len(payload)
                if size >= archive_bytes:
                    yield closed()
                    held, size, n = [], 0, n + 1
        if held:
            yield closed()

    return told.mapInArrow(write, "archive string, content binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives (``archive, content``; a path and content from ``binaryFile`` do as well):
    ``archive, place, record_id, uri, record_type, payload_bytes, payload_digest, refers_to, payload``.

    Every frame must be one valid record: a wrong one ends the job with the archive's name and place. Null
    or empty content has no records. Revisits tell length and digest of the full payload and carry none."""
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out, place = [], -1
                try:
                    for place, raw in enumerate(frames(content or b"")):
                        out.append({"archive": name, "place": place, **parse_record(raw)})
                except (ValueError, KeyError, zstandard.ZstdError) as wrong:
                    raise ValueError(f"{name}, after record {place}: {wrong}") from wrong
                types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(names, types, strict=True)], names)

    return archives.mapInArrow(read, RECORDS)
