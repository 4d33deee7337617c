"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole records,
and ends in the seek table of the public seekable format (a skippable frame with
the sizes of all frames).  An index, a table, maps each record to its bundle, its
frame and its offset inside the frame, so one record costs one frame.

Every task writes bundles of its own under names of its own to the shared folder
and hands on the index rows; the index that Spark commits decides which bundles
count, so a task that runs twice or an executor that is lost leaves at most files
that nobody names.  Files go through ``pyarrow.fs`` and lie where the shared
folder lies, be it a local mount, HDFS or an object store.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, work_folder
from .common import stored

#: Bytes of records in a frame, and of frames in a bundle, from which the next one starts.
FRAME, BUNDLE = 1 << 20, 1 << 28
#: Bytes of compressed frames that a task reads back.
READ = 32 << 20
#: Digests shared by more pages than this fraction of all are looked up by broadcast: at most 1000.
HOT_SHARE = 1000

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

INDEX = (
    "page_id long, record_id string, record_type string, refers_to long, bundle string, frame int, "
    "frame_offset long, frame_bytes long, record_offset long, record_bytes long"
)


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of (compressed, plain) sizes, without checksums."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed, plain) of every frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    width = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * width)
    entries, at, out = file.read(count * width), 0, []
    for k in range(count):
        packed, plain = struct.unpack_from("<II", entries, k * width)
        out.append((at, packed, plain))
        at += packed
    return out


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit names its response and carries no payload."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{name_of(page_id)}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{name_of(refers_to)}>",
            f"X-Refers-To-Page: {refers_to}",
        ]
        payload = b""
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """The record at ``offset``: headers, payload and where the next one starts."""
    end = data.index(b"\r\n\r\n", offset)
    lines = data[offset:end].decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return headers, data[start:stop], stop + 4


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def name_of(page_id: int | None) -> str:
    """A record id that follows from the page id, so a rerun gives the same."""
    return uuid.uuid5(uuid.NAMESPACE_OID, f"page {page_id}").urn


class Bundle:
    """A bundle being written: frames are closed at FRAME bytes, the seek table comes last."""

    def __init__(self, folder: str, frame_bytes: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        filesystem, place = pyarrow.fs.FileSystem.from_uri(self.path)
        filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.file = filesystem.open_output_stream(place, compression=None)
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.at, self.plain = 0, []  # bytes written; records of the open frame
        self.filled, self.waiting = 0, []  # its size; its index rows

    def add(self, data: bytes, row: tuple) -> list[tuple]:
        """Index rows of records whose frame is written."""
        self.waiting.append((*row, self.filled, len(data)))
        self.plain.append(data)
        self.filled += len(data)
        return self.flush() if self.filled >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.plain:
            return []
        packed = self.packer.compress(b"".join(self.plain))
        self.file.write(packed)
        rows = [(*r[:4], self.path, len(self.frames), self.at, len(packed), *r[4:]) for r in self.waiting]
        self.frames.append((len(packed), self.filled))
        self.at += len(packed)
        self.plain, self.filled, self.waiting = [], 0, []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        self.file.write(seek_table(self.frames))
        self.file.close()
        return rows


def first_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, sha1, refers_to`` of every page whose payload an earlier page has.

    Only payloads of at least ``least_bytes`` bytes count.  Pages that share both
    id and payload are all first.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    digests = stored(
        pages.where(F.octet_length(payload) >= least_bytes).select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("sha1")),
        "digests",
    )
    groups = digests.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL")
    groups = cut_lineage(groups.withColumnRenamed("sha1", "of_sha1"))
    total = digests.count()
    hot = groups.where(F.col("n") * HOT_SHARE > total)  # fewer than HOT_SHARE of them
    found = [digests.join(side, F.col("sha1") == F.col("of_sha1")) for side in (F.broadcast(hot), groups.where(F.col("n") * HOT_SHARE <= total))]
    later = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    return found[0].union(found[1]).where(later).select("page_id", "sha1", F.col("first_id").alias("refers_to"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, frame_bytes: int = FRAME, bundle_bytes: int = BUNDLE) -> DataFrame:
    """Write every row of ``pages`` as a record and return the index (written beside the bundles).

    Null html is an empty payload, a null url an empty one.  Of equal payloads the
    one with the smallest page_id is a response, the others revisit it; a null
    page_id never is the smallest.  An empty table gives an empty index.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    revisits = first_pages(pages, least_bytes).select(F.col("page_id").alias("of_id"), F.col("sha1").alias("of_sha1"), "refers_to").distinct()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("html"))
    same = F.col("page_id").eqNullSafe(F.col("of_id")) & (F.sha1("html") == F.col("of_sha1"))
    rows = rows.join(revisits, same, "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            done = []
            for page_id, url, body, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bundle = bundle or Bundle(folder, frame_bytes)
                row = (page_id, name_of(page_id), "response" if refers_to is None else "revisit", refers_to)
                done += bundle.add(record(page_id, url, body, refers_to), row)
                if bundle.at >= bundle_bytes:
                    done += bundle.close()
                    bundle = None
            yield _index(done)
        if bundle:
            yield _index(bundle.close())

    path = f"{folder}/index"
    rows.mapInArrow(run, INDEX).write.parquet(path)
    return pages.sparkSession.read.schema(INDEX).parquet(path)


def read(index: DataFrame) -> DataFrame:
    """``page_id, headers, payload`` of every indexed record, read from its frame.

    A frame is opened once for all its records that the index names; a task gets
    whole frames, about ``READ`` bytes of them, or fewer where that leaves cores idle.
    A revisit has the empty payload it was written with.
    """
    place = ["bundle", "frame", "frame_offset", "frame_bytes"]
    n, total = index.select(*place).distinct().agg(F.count("*"), F.coalesce(F.sum("frame_bytes"), F.lit(0))).first()
    tasks = max(1, -(-total // READ), min(n, index.sparkSession.sparkContext.defaultParallelism))
    at = F.struct("record_offset", "record_bytes", "page_id").alias("at")
    frames = index.select(*place, at).groupBy(*place).agg(F.collect_list("at").alias("records"))
    frames = frames.repartition(tasks, "bundle", "frame_offset")  # a stated number, which adaptive execution keeps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bundle, _, offset, size, records = (c[row].as_py() for c in batch.columns)
                filesystem, place = pyarrow.fs.FileSystem.from_uri(bundle)
                with filesystem.open_input_file(place) as file:
                    file.seek(offset)
                    plain = zstandard.ZstdDecompressor().decompress(file.read(size))
                out = []
                for r in sorted(records, key=lambda r: r["record_offset"]):
                    headers, payload, end = parse(plain, r["record_offset"])
                    if end != r["record_offset"] + r["record_bytes"]:
                        raise ValueError(f"the index and {bundle} disagree")
                    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{digest_of(payload)}":
                        raise ValueError(f"a payload in {bundle} is not what was written")
                    out.append((r["page_id"], list(headers.items()), payload))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "headers", "payload"])

    return frames.mapInArrow(run, "page_id long, headers map<string,string>, payload binary")


def archive(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read the records back.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` per row, all
    from the records; ``read`` has checked the digest of every payload it met.
    """
    headers = F.col("headers")
    return read(write(pages, work_folder(pages.sparkSession, "warc"), least_bytes)).select(
        "page_id",
        headers["X-Payload-Length"].cast("long").alias("payload_bytes"),
        F.regexp_replace(headers["WARC-Payload-Digest"], "^sha1:", "").alias("payload_digest"),
        headers["WARC-Type"].alias("record_type"),
        F.try_element_at("headers", F.lit("X-Refers-To-Page")).cast("long").alias("refers_to"),
    )


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in INDEX.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
