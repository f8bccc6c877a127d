"""Web archives with a shared dictionary: a Zstandard frame per record.

Every archive file starts with a skippable frame that holds the dictionary (itself compressed);
each WARC record follows as a frame of its own, compressed with it, so that one record can be
read alone. The dictionary is built once, from a bounded sample of the records: at most
``sample_records`` chosen by a hash of their id, of each at most ``SAMPLE_BYTES`` bytes. What
is archived does not depend on the sample.

Records with equal payloads of at least ``min_revisit_bytes`` bytes are archived once, under the
smallest page id, as a response; the others are revisits that refer to it and hold the HTTP
headers only. A null payload is empty. A null page id counts as the largest; rows that repeat
page id and payload are responses each. An empty table gives no files.

Tasks write to the shared folder through the file system of its URI. A file counts only if the
manifest lists it; a repeated attempt writes another file, which nobody reads if it is not
listed, so a lost executor does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shared_folder, stored

# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 1000
SAMPLE_BYTES = 16 << 10
FILE_BYTES = 1 << 30
LEVEL = 3
BATCH_RECORDS = 200
RECORD_URN = "urn:page:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    """Without characters that would break a header line."""
    return quote(url, safe="".join(map(chr, range(33, 127))))


def make_record(page_id, url, payload: bytes, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record; ``refers_to`` counts for revisits."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{RECORD_URN}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _uri(url),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Refers-To": f"<{RECORD_URN}{refers_to}>" if revisit else None,
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = [f"{k}: {v}".encode() for k, v in headers.items() if v is not None]
    return b"\r\n".join([VERSION, *lines, b"", block, b"", b""])


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or plain content where the samples are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed


def _file_system(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def _with_first(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int):
    """(page_id, url, payload, refers_to): null for responses, else the response's page."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
        .alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    revisits = (
        (F.octet_length("payload") >= least)
        & F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    )
    # A payload that fills a third of the table makes its join partition large; adaptive
    # execution splits it, since nothing after needs rows of one digest together.
    return rows.join(first, "digest").select(
        "page_id", "url", "payload", F.when(revisits, F.col("first_id")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    sample_records: int = SAMPLE_RECORDS,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the archives; the manifest (path, records, bytes), one row per file."""
    spark = pages.sparkSession
    folder = f"{folder or shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    system, place = _file_system(folder)
    system.create_dir(place, recursive=True)
    total = pages.count()
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(max(1, total // sample_records)))
    sample = pages.filter(draw == 0).limit(sample_records).select(
        F.col(id_col).cast("long"), F.col(url_col).cast("string"),
        F.substring(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), 1, SAMPLE_BYTES),
    )
    samples = [
        make_record(page_id, url, text.encode("utf-8"), None, False, date)
        for page_id, url, text in sample.toLocalIterator()
    ]
    dictionary = build_dictionary(samples)  # at most DICTIONARY_BYTES, part of the task

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _file_system(folder)
        prepared = zstandard.ZstdCompressionDict(dictionary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=prepared)
        header, out, done = dictionary_frame(dictionary), None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page_id, url, payload, refers_to = row
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
                    out = system.open_output_stream(f"{place}/{name}", compression=None)
                    out.write(header)
                    done.append([f"{folder}/{name}", 0, 0])
                out.write(compressor.compress(
                    make_record(page_id, url, payload, refers_to, refers_to is not None, date)
                ))
                done[-1][1] += 1
                if out.tell() >= file_bytes:
                    done[-1][2] = out.tell()
                    out.close()
                    out = None
        if out is not None:
            done[-1][2] = out.tell()
            out.close()
        if done:
            path, records, size = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(records, pa.int64()),
                 pa.array(size, pa.int64())],
                names=["path", "records", "bytes"],
            )

    chosen = _with_first(pages, id_col, url_col, payload_col, min_revisit_bytes)
    return stored(chosen.mapInArrow(write, "path string, records long, bytes long"))


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("the archive does not start with a dictionary")
    dictionary = zstandard.ZstdDecompressor().decompress(stream.read(size))
    decompressor = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary)
    )
    with decompressor.stream_reader(stream, read_across_frames=True, closefd=False) as plain:
        held = b""
        while True:
            while (end := held.find(b"\r\n\r\n")) < 0:
                more = plain.read(64 << 10)
                if not more:
                    if held:
                        raise ValueError("the archive ends within a record")
                    return
                held += more
            version, *lines = held[:end].split(b"\r\n")
            if version != VERSION:
                raise ValueError("not a WARC record")
            headers = dict(line.decode("utf-8").split(": ", 1) for line in lines)
            need = end + 4 + int(headers["Content-Length"]) + 4
            parts, have = [held], len(held)
            while have < need:
                more = plain.read(max(64 << 10, need - have))
                if not more:
                    raise ValueError("the archive ends within a record")
                parts.append(more)
                have += len(more)
            held = b"".join(parts)
            yield headers, held[end + 4 : need - 4]
            held = held[need:]


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix(f"<{RECORD_URN}").removesuffix(">")
    return int(number) if number else None


def parse_record(headers: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload)."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    kind = headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return (
        _page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
        _page_of(headers.get("WARC-Refers-To")), digest, size,
        payload if kind == "response" else None,
    )


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the listed files, digests checked; a file is read by one task."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = _file_system(path)
                with system.open_input_stream(place, compression=None) as stream:
                    rows = []
                    for headers, block in read_records(stream):
                        rows.append(parse_record(headers, block))
                        if len(rows) == BATCH_RECORDS:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(
        read,
        "page_id long, url string, record_type string, refers_to long, payload_digest string, "
        "payload_bytes long, payload binary",
    )
