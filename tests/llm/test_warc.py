import base64
import gzip
import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from plantmetrics.llm.warc import (
    archive_pages,
    normalise_archives,
    page_records,
    read_index,
    read_records,
    write_archives,
)

PAGES = "page_id long, url string, html string"


def test_round_trip_with_copies(spark, tmp_path):
    long = "é" * 3_000_000
    rows = [(5, "http://a/ b", "<p>x</p>"), (2, None, "<p>x</p>"), (7, "u", None), (8, "u", ""), (9, "", long)]
    rows += [(2, None, "<p>x</p>"), (None, "u", "<p>x</p>"), (11, "u", "a\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1))
    got = archive_pages(pages, f"file://{tmp_path}/w").collect()
    expected = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        least = min(i for i, _, h in rows if (h or "") == (html or "") and i is not None)
        copy = page_id is None or page_id > least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected.append((page_id, "revisit" if copy else "response", least if copy else None, digest, len(body)))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)


def test_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k % 3}</p>") for k in range(20)], PAGES)
    write_archives(page_records(pages, min_revisit_bytes=9).coalesce(1), f"file://{tmp_path}/raw")
    (raw,) = [f for f in os.listdir(tmp_path / "raw") if f.endswith(".gz")]
    summary = normalise_archives(spark, f"file://{tmp_path}/raw", f"file://{tmp_path}/out").collect()
    (done,) = [s for s in summary if s.records]
    path = done.archive.removeprefix("file:")
    path = path if os.path.exists(path) else f"{tmp_path}/out/{os.path.basename(path)}"
    whole = open(path, "rb").read()
    assert gzip.decompress(whole) == gzip.open(tmp_path / "raw" / raw).read()
    index = read_index(spark, f"file://{tmp_path}/out").orderBy("offset").collect()
    assert len(index) == 20 and index[-1].offset + index[-1].length == len(whole) == done.bytes
    one = gzip.decompress(whole[index[7].offset : index[7].offset + index[7].length])
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
    assert {r.record_type for r in read_records(read_index(spark, f"file://{tmp_path}/out")).collect()} == {"response"}


def test_cut_archives_are_errors(spark, tmp_path):
    """Cut where a record ends, inside one, and before the trailer; empty files and whole members are archives."""
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k * 7919}</p>" * 30) for k in range(50)], PAGES)
    write_archives(page_records(pages).coalesce(1), f"file://{tmp_path}/raw")
    (raw,) = [f for f in os.listdir(tmp_path / "raw") if f.endswith(".gz")]
    whole = gzip.open(tmp_path / "raw" / raw).read()
    records = [b"WARC/1.1" + part for part in whole.split(b"WARC/1.1")[1:]]
    packed = gzip.compress(whole, mtime=0)
    deflater = zlib.compressobj(6, zlib.DEFLATED, 31)
    at_record_end = deflater.compress(b"".join(records[:31])) + deflater.flush(zlib.Z_SYNC_FLUSH)
    members = b"".join(gzip.compress(r) for r in records)
    cases = {"end": at_record_end, "inside": packed[: len(packed) // 2], "trailer": packed[:-8], "short": packed[:-1]}
    cases |= {"member": members[:-3], "whole": packed, "members": members, "nothing": gzip.compress(b""), "empty": b""}
    for name, data in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.gz").write_bytes(data)
        if name in ("end", "inside", "trailer", "short", "member"):
            with pytest.raises(Exception, match="archive ends inside"):
                normalise_archives(spark, f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}-out")
        else:
            done = normalise_archives(spark, f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}-out").collect()
            assert sum(r.records for r in done) == (50 if name in ("whole", "members") else 0)


def test_empty_table(spark):
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0
