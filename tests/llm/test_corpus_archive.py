import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm import archive

SCHEMA = "page_id long, url string, html string, frame string"


@pytest.fixture(scope="module")
def rows():
    texts = ["<p>one</p>", "", None, "é" * 5000, "x" * 300_000, "<p>one</p>\r\n\r\nWARC/1.1"]
    return [(k, None if k % 7 == 0 else f"http://a.b/{k}\r\nX: y z", texts[k % len(texts)], "theirs") for k in range(60)] + [
        (59, "http://a.b/59", "own", "theirs"), (58, "u", "tie", "t"), (58, "u", "tie", "t"), (None, "u", "only null id", "t"), (None, "u", "tie", "t")]


def expected(rows):
    keep = {}
    for i, _, t, _ in rows:
        if i is not None:
            keep[t or ""] = max(keep.get(t or "", i), i)
    out = []
    for i, _, t, _ in rows:
        data = (t or "").encode()
        k = keep.get(t or "")
        revisit = k is not None and i != k
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", k if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = archive.write(archive.with_roles(df), tmp_path.as_uri(), frame_bytes=20_000, bundle_bytes=300)
    found = archive.read(index, tmp_path.as_uri(), payloads=True).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == expected(rows)
    texts = {(r[0], (r[2] or "").encode()) for r in rows}
    assert all((r.page_id, bytes(r.payload)) in texts for r in found if r.record_type == "response")
    assert index.select("bundle").distinct().count() > 1
    assert archive.write(archive.with_roles(df), tmp_path.as_uri(), frame_bytes=5_000).agg(F.max("frame")).first()[0] > 1


def test_one_record_is_found_without_the_rest(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    index = archive.write(archive.with_roles(df), tmp_path.as_uri(), frame_bytes=5_000)
    one = archive.read(index.filter("page_id = 3"), tmp_path.as_uri(), payloads=True).collect()
    assert [r.page_id for r in one] == [3]
    entry = index.filter("page_id = 3").first()
    bundle = archive.Seekable(tmp_path.as_uri(), entry.bundle)
    data = bundle.frame(entry.frame)
    assert archive.parse(data[entry.offset: entry.offset + entry.length])["page_id"] == 3


def test_small_payloads_may_stay_responses(spark, rows):
    df = archive.with_roles(spark.createDataFrame(rows, SCHEMA), min_bytes=100)
    assert df.filter("revisit AND octet_length(payload) < 100").count() == 0 and df.filter("revisit").count() > 0


def test_a_damaged_record_is_noticed():
    data = archive.record(1, "u", b"payload", None, False)
    assert archive.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        archive.parse(data.replace(b"\r\n\r\npayload", b"\r\n\r\npayloaD"))


def test_empty_table(spark, tmp_path):
    index = archive.write(archive.with_roles(spark.createDataFrame([], SCHEMA)), tmp_path.as_uri())
    assert archive.read(index, tmp_path.as_uri()).count() == 0
