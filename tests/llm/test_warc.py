import base64
import hashlib

import pyarrow.fs
import zstandard
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.session import work_folder

SCHEMA = "page_id long, url string, html string"
ROWS = [(3, "http://a/1", "same"), (1, "http://a/2", "same"), (2, None, "other é"), (4, "http://a\r\nX: y/4", None), (5, "u", ""), (6, "u", "\r\n\r\nWARC/1.1\r\n"),
        (None, "u", "same"), (None, "u", "alone"), (7, "u", "z" * 300_000), (8, "u", "other é")]


def plain(rows, least=0):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in bodies:
        if i is not None and len(b) >= least:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in bodies:
        response = first.get(b, i) == i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else first[b]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in df.collect()), key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3).withColumn("refers_to", F.lit("x")).withColumn("sha1", F.lit(1))
    assert rows_of(warc.archive(pages)) == plain(ROWS)
    assert rows_of(warc.archive(pages, least_bytes=5)) == plain(ROWS, 5)
    assert warc.archive(pages.limit(0)).count() == 0


def test_hot_payload_and_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    extra = spark.createDataFrame([(10_000 + i, "u", "hot") for i in range(120)], SCHEMA)
    both = pages.union(extra)
    assert rows_of(warc.archive(both)) == plain([(r["page_id"], r["url"], r["html"]) for r in both.collect()])


def test_records_stand_alone_in_seekable_frames(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    index = warc.write(pages, work_folder(spark, "warc-test"), frame_bytes=1000, bundle_bytes=200_000)
    rows = index.collect()
    assert {r["record_id"] for r in rows} == {warc.name_of(i) for i, _, _ in ROWS}
    for path in {r["bundle"] for r in rows}:
        filesystem, place = pyarrow.fs.FileSystem.from_uri(path)
        with filesystem.open_input_file(place) as file:
            table = warc.read_seek_table(file)
            file.seek(0)
            data = file.read()
        mine = [r for r in rows if r["bundle"] == path]
        assert len(table) == 1 + max(r["frame"] for r in mine)
        for r in mine:
            offset, packed, size = table[r["frame"]]
            assert (offset, packed) == (r["frame_offset"], r["frame_bytes"])
            frame = zstandard.ZstdDecompressor().decompress(data[offset : offset + packed])
            assert len(frame) == size
            headers, payload, end = warc.parse(frame, r["record_offset"])
            assert end - r["record_offset"] == r["record_bytes"] and headers["WARC-Record-ID"] == f"<{r['record_id']}>"
        # a plain decoder reads the whole bundle and skips the table
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert whole.count(b"WARC-Record-ID") == len(mine)
