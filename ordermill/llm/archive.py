"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own; a skippable frame at the end of a
bundle is its seek table (the public Zstandard seekable format), and an index maps each record to
its bundle, frame and offset inside the frame. Of records with equal payloads one is a response and
the others are revisits of it.

Tasks write bundles straight to the given folder, which all executors reach, each under a name that
holds the task attempt. The index, written after them, names the bundles that count: what a lost or
repeated attempt left behind is in no index. Memory follows the largest record and one frame.

Defined results: a null payload is an empty one; the record with the largest id is the response, and
rows that share that id and payload are responses too; a null id is never the largest unless all
are null; a null address is written as about:blank; extra columns are left out of the archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import map_arrow, quoted
from ordermill.session import materialise, scratch_folder

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
RECORD_DATE = "1970-01-01T00:00:00Z"
# The magic numbers of the Zstandard seekable format, and the revisit profile of WARC 1.1.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, bundle string, frame int, offset long, length long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP head only."""
    address = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else "about:blank"
    name = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {RECORD_DATE}", f"WARC-Target-URI: {address}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What one record says; a response's payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    n = int(http.decode().rsplit("Content-Length: ", 1)[1])
    if kind == "response" and (payload_digest(payload) != digest or len(payload) != n):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(field: str) -> int | None:
        found = fields.get(field, "").removeprefix("<urn:page:").removesuffix(">")
        return int(found) if found else None

    return {"page_id": number("WARC-Record-ID"), "payload_bytes": n, "payload_digest": digest, "record_type": kind,
            "refers_to": number("WARC-Refers-To"), "payload": payload if kind == "response" else None}


class Bundle:
    """Writes frames to one bundle and closes it with its seek table."""

    def __init__(self, folder: str, name: str):
        store, path = fs.FileSystem.from_uri(folder)
        self.name, self.entries, self.written = name, [], 0
        self.out = store.open_output_stream(f"{path}/{name}", compression=None)

    def frame(self, data: bytes) -> None:
        packed = zstandard.ZstdCompressor(level=3).compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data)))
        self.written += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *e) for e in self.entries)
        foot = struct.pack("<IBI", len(self.entries), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + len(foot)) + table + foot)
        self.out.close()


class Seekable:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        store, path = fs.FileSystem.from_uri(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{name} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.entries, at = [], 0
        for packed, plain in struct.iter_unpack("<II", table):
            self.entries.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, plain = self.entries[k]
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)
        if len(data) != plain:
            raise ValueError("damaged frame")
        return data


def with_roles(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): for each group of equal payloads the largest id is the response.

    Group sizes are summed before the shuffle, and only payloads that occur twice or more are joined back;
    adaptive execution splits a payload that holds much of the rows.
    """
    rows = pages.select(
        quoted(page_id).cast("long").alias("page_id"), quoted(url).cast("string").alias("url"),
        F.coalesce(quoted(payload), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("_same", F.sha2("payload", 256))
    keepers = (
        rows.filter(F.octet_length("payload") >= min_bytes).groupBy("_same")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(keepers, "_same", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("keeper")).alias("refers_to"), revisit.alias("revisit"))


def write(rows: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the records of ``with_roles`` into bundles below ``folder``; returns their stored index."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        bundle, number, frame, waiting = None, 0, [], []

        def flush() -> None:
            if frame:
                bundle.frame(b"".join(frame))
                frame.clear()

        def entries() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pylist(waiting, pa.schema([
                ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
            waiting.clear()
            return out

        held = 0
        for batch in batches:
            columns = [batch.column(k) for k in range(5)]
            for i in range(batch.num_rows):
                data = record(*(c[i].as_py() for c in columns))
                if bundle is None:
                    bundle = Bundle(folder, f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{number}.warc.zst")
                    number += 1
                waiting.append({"page_id": columns[0][i].as_py(), "bundle": bundle.name, "frame": len(bundle.entries), "offset": held, "length": len(data)})
                frame.append(data)
                held += len(data)
                if held >= frame_bytes:
                    flush()
                    held = 0
                    if bundle.written >= bundle_bytes:
                        bundle.close()
                        bundle = None
            if waiting:
                yield entries()
        if bundle is not None:
            flush()
            bundle.close()

    ordered = rows.select("page_id", "url", "payload", "refers_to", "revisit")
    return materialise(map_arrow(ordered, run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records that ``index`` names, each found by its frame and offset; a frame is unpacked once.

    Any part of an index will do: only frames that hold a wanted record are read.
    """
    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, bundle, number, data = None, None, -1, b""
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name, number = row["bundle"], -1
                    bundle = Seekable(folder, name)
                if row["frame"] != number:
                    number = row["frame"]
                    data = bundle.frame(number)
                found.append(parse(data[row["offset"]: row["offset"] + row["length"]]))
            yield pa.RecordBatch.from_pylist(found, pa.schema(kinds))

    wanted = index.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return map_arrow(wanted, run, schema)


def archive_folder(spark, label: str = "warc") -> str:
    return scratch_folder(spark, label)
