"""Archives out and back, push-down, and archives of others."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from armature.llm import warc
from armature.sources.sinks import scratch

SAME = "<html>" + "same é " * 40 + "</html>"
PAGES = [(1, "http://a/\r\nEvil: x", "short"), (2, None, "short"), (5, "http://b/", SAME), (3, "http://c/", SAME), (4, "http://d/", None), (6, "http://e/", "x" * 3_000_000), (None, "http://f/", SAME), (7, "http://g/", "\r\n\r\nWARC/1.1\r\n" * 20), (8, "", "n" * 100), (9, "", "n" * 100), (None, "", "only " * 40), (None, "", "only " * 40), (3, "", SAME)]


def written(spark, **options):
    path = scratch(spark, "test-warc")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("id", F.lit("x"))
    warc.write_archives(warc.page_records(pages.repartition(3)), path, **options)
    return path


@pytest.fixture(scope="module")
def archive(spark):
    return written(spark)


def test_round_trip(spark, archive):
    rows = warc.read_archives(spark, archive).withColumn("page", warc.page_id_of(F.col("record_id"))).withColumn("of", warc.page_id_of(F.col("refers_to"))).collect()
    assert len(rows) == len(PAGES)
    got = sorted(((r.page, r.warc_type, r.of, r.payload_length, r.payload_digest) for r in rows), key=repr)
    first = {SAME: 3, "n" * 100: 8}
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        again = html in first and page != first[html]
        want.append((page, "revisit" if again else "response", first[html] if again else None, len(body), hashlib.sha256(body).hexdigest()))
    assert got == sorted(want, key=repr)
    texts = {p: h for p, _, h in PAGES}
    for r in rows:
        if r.warc_type == "response" and r.page is not None:
            assert bytes(r.payload).decode() == (texts[r.page] or "")
        assert "evil" not in r.headers and r.warc_date == "2000-01-01T00:00:00Z"


def test_gzip_readers_read_it(archive):
    names = [n for n in os.listdir(archive) if n.endswith(".gz")]
    text = b"".join(gzip.open(f"{archive}/{n}").read() for n in names)
    assert text.count(b"WARC/1.1\r\nWARC-Type:") == len(PAGES)


def test_predicates_are_pushed_down_and_payloads_skipped(spark, archive, monkeypatch):
    df = warc.read_archives(spark, archive, payload="none").filter((F.col("warc_type") == "revisit") & F.col("target_uri").startswith("http"))
    rows = df.collect()
    assert {r.target_uri for r in rows} == {"http://b/", "http://f/"} and all(r.payload is None for r in rows)
    reader = warc.WarcReader({"path": archive, "payload": "response"})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    left = list(reader.pushFilters([EqualTo(("warc_type",), "response"), In(("warc_date",), ("2000-01-01T00:00:00Z",)), GreaterThan(("payload_length",), 5)]))
    assert [type(x).__name__ for x in left] == ["GreaterThan"]
    # a record that is not wanted is never inflated beyond its headers
    inflated = []
    more = warc.Inflated.more
    monkeypatch.setattr(warc.Inflated, "more", lambda self, most=0: (inflated.append(most), more(self, most))[1])
    reader = warc.WarcReader({"path": archive})
    list(reader.pushFilters([EqualTo(("warc_type",), "nothing")]))
    assert not [b for p in reader.partitions() for b in reader.read(p)] and set(inflated) == {4096}


def test_files_of_failed_tasks_are_not_read(spark, archive):
    with open(f"{archive}/left-over.warc.gz", "wb") as f:
        f.write(b"half a record")
    assert warc.read_archives(spark, archive).count() == len(PAGES)


def test_small_files_and_appends(spark):
    path = written(spark, file_bytes=500)
    assert len(os.listdir(path)) > 3
    warc.write_archives(warc.page_records(spark.createDataFrame(PAGES[:2], "page_id long, url string, html string")), path)
    assert warc.read_archives(spark, path).count() == len(PAGES) + 2


def test_archives_of_others(spark, tmp_path):
    one = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:b>\r\nX-Long: a\r\n b\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 30\r\n\r\nHTTP/1.0 200\r\nA: b\r\n\r\nbody....\r\n\r\n"
    (tmp_path / "plain.warc").write_bytes(one + two)
    (tmp_path / "members.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("file", "file_offset").collect()
    assert [(r.record_id, bytes(r.payload)) for r in rows] == [("<urn:a>", b"hello"), ("<urn:b>", b"body....")] * 2
    assert rows[1].headers["x-long"] == "a b" and rows[1].payload_length == 8
    alone = warc.read_archives(spark, str(tmp_path / "plain.warc"), payload="response").collect()
    assert [r.payload for r in alone][0] is None and len(alone) == 2


def test_no_pages(spark):
    path = scratch(spark, "test-warc")
    warc.write_archives(warc.page_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_archives(spark, path).count() == 0
