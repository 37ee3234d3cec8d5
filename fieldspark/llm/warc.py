"""WARC archives of web pages in Zstandard with an embedded dictionary.

Each file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, trained on a bounded sample of
the records; then each record is a frame of its own. Of equal payloads one is a response record, the others are revisit
records (profile identical-payload-digest), which keep the HTTP head and name the response. Files go to the shared
folder, whole or not at all, under names of their task attempt: the rows of a part come in no fixed order, so a second
attempt cuts them into other files. The index, which Spark commits by task, names those of the attempts that count; only it
tells what belongs to the archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import _fs, hashed_sample, partitions, shared_dir, stored, write_file

MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, sha: str, refers_to=None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record; refers_to makes it a revisit. A null id is written as ``null``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}"] if url else []),
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int = 32 << 10) -> bytes:
    """A dictionary from sample records; few or tiny ones serve as raw content."""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record starts with {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().partition(":")
            head[k.lower()] = v.strip()
        block = stream.read(int(head["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record has no end")
        yield head, block


def read_file(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    fs, p = _fs(path)
    with fs.open_input_stream(p, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != MAGIC:
            raise ValueError("no dictionary frame")
        raw = f.read(size)
        known = zstd.ZstdCompressionDict(raw) if raw else None
        with zstd.ZstdDecompressor(dict_data=known).stream_reader(f, read_across_frames=True) as r:
            yield from parse(io.BufferedReader(r, 1 << 18))


def _write(folder: str, dictionary: bytes, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        if known is not None:
            known.precompute_compress(level=3)
        squeeze = zstd.ZstdCompressor(level=3, dict_data=known) if known is not None else zstd.ZstdCompressor(level=3)
        task, number, held, size, n = TaskContext.get(), 0, [], 0, 0
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId():08d}"
        lead = struct.pack("<II", MAGIC, len(dictionary)) + dictionary

        def flush():
            path = f"{name}-{number:05d}.warc.zst"
            write_file(path, b"".join([lead, *held]))
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size + len(lead)], pa.int64())], ["path", "records", "bytes"])

        for b in batches:
            for page, url, html, sha, first in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "first"))):
                frame = squeeze.compress(record(page, url, html.encode(), base64.b32encode(bytes.fromhex(sha)).decode(), first))
                held.append(frame)
                size += len(frame)
                n += 1
                if size > roll:
                    yield flush()
                    number, held, size, n = number + 1, [], 0, 0
        if held:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, sample: int = 500, sample_chars: int = 8192, roll: int = 16 << 20) -> DataFrame:
    """Writes a record per row of pages (page_id, url, html) and gives (path, records, bytes) of the files.

    Of payloads of at least min_bytes that are equal, the row with the smallest page_id is the response (each of its
    repeats too, and all rows of a group without ids); smaller payloads are all responses. A null html is an empty
    payload; a null url leaves out the header. Other columns are ignored; an empty table writes no file. sample and
    sample_chars bound the rows, and the characters of each, from which the dictionary is trained; they affect sizes only.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html"))
    some = hashed_sample(rows.select("page_id", "url", F.substring("html", 1, sample_chars).alias("html")), sample, "page_id", "url")
    samples = [record(r["page_id"], r["url"], r["html"].encode(), digest(r["html"].encode())) for r in some.collect()]
    first = rows.where(F.octet_length("html") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("low"), F.count("*").alias("n")).where("n > 1 and low is not null").select("sha", "low")
    first = stored(first, f"{folder}/first")  # a plain side: the join can split a page that has many copies
    joined = rows.join(first, "sha", "left").withColumn("first", F.when(F.coalesce(F.col("page_id") != F.col("low"), F.lit(True)) & (F.octet_length("html") >= min_bytes), F.col("low")))
    out = joined.select("page_id", "url", "html", "sha", "first").mapInArrow(_write(folder, train(samples), roll), "path string, records long, bytes long")
    return stored(out, f"{folder}/index")


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _read(keep: bool):
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]

    def page(name: str | None):
        text = name[len("<urn:page:") : -1] if name else "null"
        return None if text == "null" else int(text)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], schema=pa.schema(fields))

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                rows, size = [], 0
                for head, block in read_file(path):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = head["warc-type"]
                    if kind == "response":
                        n, sha = len(payload), digest(payload)
                        if sha != head["warc-payload-digest"][5:]:
                            raise ValueError(f"{path}: a payload does not have its digest")
                    else:
                        n, sha, payload = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1]), head["warc-payload-digest"][5:], None
                    rows.append((page(head["warc-record-id"]), head.get("warc-target-uri"), n, sha, kind, page(head.get("warc-refers-to")), payload if keep else None))
                    size += len(block) if keep else 100
                    if size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) per record of the files (path).

    Digests of responses are computed from what was read; a payload that does not have its digest is a ValueError.
    payloads False leaves the payload column null. Records of a null page_id have a null one, a record without an address
    a null url, repeated records a row each. No file, no row.
    """
    spread = files.select("path").repartition(max(partitions(files.sparkSession), 1))
    return spread.mapInArrow(_read(payloads), _READ)


def archived(pages: DataFrame) -> DataFrame:
    """Writes pages and reads the archives back, without payloads: a row per row of pages, with write_archives' results."""
    folder = shared_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), False).drop("payload")
