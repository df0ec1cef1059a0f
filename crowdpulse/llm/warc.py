"""WARC archives with an embedded Zstandard dictionary.

Each file begins with a skippable frame that holds the dictionary; every record after it is a
frame of its own, compressed with that dictionary, so that a record can be read by its offset. The
dictionary is built from a bounded sample of the records to be archived. Tasks write files of
bounded size under temporary names and move them when whole; only files in the manifest of a
finished job are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm.common import shared_path, written

#: Magic number of the skippable frame for the dictionary of a .warc.zst file.
DICTIONARY_FRAME = 0x184D2A5D
#: Bytes read at a time: what is left of them after a frame is copied.
CHUNK = 1 << 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, record_type string, file string, offset long, length long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def filesystem(uri: str):
    """The file system of a Hadoop-style address and the path in it; a bare path is a local one."""
    from pyarrow import fs

    if re.match(r"file:/(?!/)", uri):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def record(page_id: int | None, url: str | None, payload: bytes, date: str, refers_to: int | None = None,
           size: int | None = None, digest: bytes | None = None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names its response."""
    revisit = refers_to is not None
    digest = digest or hashlib.sha1(payload).digest()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload) if size is None else size}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    # Bytes that would end a header line, or blanks, are percent-encoded; read_records undoes that.
    target = "" if url is None else re.sub(r"[%\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {target}"]),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        *([f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def train_dictionary(samples: list[bytes], size: int = 1 << 16) -> bytes:
    """A trained dictionary; with too few samples to train on, their last bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _frames(stream, dictionary: bytes):
    """The content of every frame of an open stream; a frame that is cut off raises."""
    plain = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    data = stream.read(CHUNK)
    while data:
        frame, parts = plain.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the last record is cut off")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(CHUNK)
        yield b"".join(parts)
        data = data or stream.read(CHUNK)


def read_records(stream):
    """Yield ``headers, payload`` of every record of an open .warc.zst stream, one frame each."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start")
    for one in _frames(stream, stream.read(size)):
        head, _, rest = one.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
            raise ValueError(f"not a whole record: {one[:40]!r}")
        http, _, payload = rest[:length].partition(b"\r\n\r\n")
        headers["HTTP-Length"] = re.search(rb"Content-Length: (\d+)", http)[1].decode()
        yield headers, payload


def _number(header: str | None) -> int | None:
    digits = (header or "").removeprefix("<urn:x-page:").rstrip(">")
    return int(digits) if digits else None


def revisits(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``page_id, digest, refers_to`` for every page that repeats the payload of a larger page_id."""
    meta = written(pages.select("page_id", "digest", "bytes").filter(F.col("bytes") >= least_bytes), "payloads")
    held = (
        meta.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
        .filter("least < refers_to").select(F.col("digest").alias("_d"), F.col("bytes").alias("_b"), "refers_to")
    )
    # Both sides of the join are plain tables: adaptive execution can split a payload with very many pages.
    held = written(held, "repeated-payloads")
    return meta.join(held, (F.col("digest") == F.col("_d")) & (F.col("bytes") == F.col("_b"))).filter(
        "page_id < refers_to"
    ).select("page_id", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, folder: str | None = None, least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z",
               level: int = 3, max_file_bytes: int = 1 << 30, sample_records: int = 1000,
               sample_bytes: int = 1 << 24) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) in ``folder`` and return the index of records.

    The index has ``page_id, url, record_type, file, offset, length``; a record is the frame at its
    offset. Of equal payloads of at least ``least_bytes``, that with the largest page_id is a
    response and the others revisit it; smaller ones are all responses. A null html is empty; a
    null page_id is always a response; rows that repeat the largest page_id with the same payload
    are responses each. The dictionary is built from about ``sample_records`` records, chosen by a
    hash of the page_id, of ``sample_bytes`` in all at most. An empty table writes no file.
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    ).withColumns({"digest": F.sha1("html"), "bytes": F.octet_length("html").cast("long")})
    again = written(revisits(rows, least_bytes), "revisits")

    count = rows.select("page_id").count()
    limit = int(min(1.0, sample_records / max(count, 1)) * 2**31)
    sample, room = [], sample_bytes
    chosen = rows.filter((F.pmod(F.xxhash64(F.lit(3), "page_id"), F.lit(2**31)) < limit) & (F.col("bytes") < sample_bytes // 16))
    for r in chosen.select("page_id", "url", "html").orderBy("page_id").limit(2 * sample_records).toLocalIterator():
        one = record(r[0], r[1], bytes(r[2]), date)
        room -= len(one)
        if room < 0:
            break
        sample.append(one)
    # At most a few ten thousand bytes: the broadcast does not grow with the archive.
    shared = spark.sparkContext.broadcast(train_dictionary(sample))

    def run(batches):
        where, top = filesystem(folder)
        dictionary = shared.value
        options = {} if not dictionary else {"dict_data": _dictionary(dictionary)}
        compress = zstandard.ZstdCompressor(level=level, write_checksum=True, **options).compress
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        number, out, name, at = 0, None, "", 0

        def finish():
            out.close()
            where.move(f"{top}/.{name}.{attempt}", f"{top}/{name}")

        for batch in batches:
            index = []
            for page_id, url, payload, digest, size, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and at >= max_file_bytes:
                    finish()
                    out, number = None, number + 1
                if out is None:
                    where.create_dir(top, recursive=True)
                    name = f"part-{part:06d}-{number:04d}.warc.zst"
                    out = where.open_output_stream(f"{top}/.{name}.{attempt}", compression=None)
                    lead = dictionary_frame(dictionary)
                    out.write(lead)
                    at = len(lead)
                frame = compress(record(page_id, url, payload or b"", date, refers_to, size, bytes.fromhex(digest)))
                out.write(frame)
                kind = "response" if refers_to is None else "revisit"
                index.append((page_id, url, kind, f"{folder}/{name}", at, len(frame)))
                at += len(frame)
            columns = list(zip(*index)) if index else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                names=["page_id", "url", "record_type", "file", "offset", "length"],
            )
        if out is not None:
            finish()

    mine = again.select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to")
    kinds = rows.join(mine, (F.col("page_id") == F.col("_p")) & (F.col("digest") == F.col("_d")), "left")
    payload = F.when(F.col("refers_to").isNull(), F.col("html"))
    index = kinds.select("page_id", "url", payload.alias("html"), "digest", "bytes", "refers_to").mapInArrow(run, INDEX)
    return written(index, "warc-index")


def read_warc(spark: SparkSession, files: DataFrame, *, payload: bool = False) -> DataFrame:
    """The records of archives: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    ``files`` has a column ``file``. Sizes and digests of responses are taken from the payload that
    was read, and must agree with its headers; those of revisits come from the headers. With
    ``payload``, a column of that name holds a response's bytes.
    """

    def run(batches):
        for batch in batches:
            for file in batch.column(0).to_pylist():
                where, path = filesystem(file)
                rows, held = [], 0
                with where.open_input_stream(path, compression=None) as stream:
                    for headers, body in read_records(stream):
                        kind = headers["WARC-Type"]
                        size = int(headers["HTTP-Length"])
                        digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
                        if kind == "response" and (len(body) != size or hashlib.sha1(body).digest() != digest):
                            raise ValueError(f"damaged record in {file}: {headers['WARC-Record-ID']}")
                        url = headers.get("WARC-Target-URI")
                        if url is not None:
                            url = re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url)
                        rows.append(
                            (_number(headers["WARC-Record-ID"]), url, size, digest.hex(), kind, _number(headers.get("WARC-Refers-To")))
                            + ((body if kind == "response" else None,) if payload else ())
                        )
                        held += len(body) * payload
                        if len(rows) >= 4096 or held > 1 << 24:
                            yield _batch(rows, payload)
                            rows, held = [], 0
                yield _batch(rows, payload)

    # One file a task at a time; each is bounded by the writer. The names are few bytes, so adaptive
    # execution would merge them into one task unless their number is given.
    names = files.select("file").distinct()
    dealt = names.repartition(max(1, names.count()), "file")
    return dealt.mapInArrow(run, RECORDS + ", payload binary" * payload)


def _batch(rows: list, payload: bool) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()) + (pa.binary(),) * payload
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
