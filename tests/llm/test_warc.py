import gzip
import hashlib

import duckdb
import pytest

from evidra.llm import warc as W

LONG = "<p>" + "x" * 200


def test_archive_round_trip_dedup_and_pushdown(spark, tmp_path):
    rows = [(5, "http://a/\n1", LONG), (2, None, LONG), (9, "http://c", LONG), (4, "u", None), (3, "v", "short"), (1, "w", "short"), (None, "n", LONG), (7, "é", "ü" * 60)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    path = f"file://{tmp_path}/w"
    W.write_archive(pages, path)
    back = {r.page_id: r for r in W.read_archive(spark, path).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in back.items() if r.record_type == "revisit"} == {5: ("revisit", 2), 9: ("revisit", 2), None: ("revisit", 2)}
    for page, _, html in rows:
        raw = (html or "").encode()
        assert (back[page].payload_digest, back[page].payload_bytes) == (hashlib.sha256(raw).hexdigest(), len(raw))
        assert back[page].payload is None if back[page].record_type == "revisit" else bytes(back[page].payload) == raw
    some = W.read_archive(spark, path).where("record_type = 'revisit' AND page_id IN (5, 4)")
    assert [r.page_id for r in some.collect()] == [5]
    assert W.read_archive(spark, path, payload=False).where("payload IS NOT NULL").count() == 0
    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == len(rows) and b"http://a/%0A1" in text
    (tmp_path / "z").mkdir()
    (tmp_path / "z/plain.warc.gz").write_bytes(b"".join(gzip.compress(W.record({"record_type": "response", "page_id": k, "url": "u", "payload_digest": "d", "payload_bytes": 9, "payload": b"123456789", "refers_to": None}, "x")) for k in range(3)))
    assert [bytes(r.payload) for r in W.read_archive(spark, f"file://{tmp_path}/z").collect()] == [b"123456789"] * 3
    W.write_archive(pages.limit(0), f"file://{tmp_path}/e")
    assert W.read_archive(spark, f"file://{tmp_path}/e").count() == 0


def test_writing_again_keeps_or_replaces(spark, tmp_path):
    page = lambda *ids: spark.createDataFrame([(i, f"http://{i}", LONG) for i in ids], "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    read = lambda: sorted((r.page_id, r.record_type, r.refers_to) for r in W.read_archive(spark, path).collect())
    W.write_archive(page(1, 2), path)
    W.write_archive(page(3), path)
    assert read() == [(1, "response", None), (2, "revisit", 1), (3, "response", None)]
    (tmp_path / "w" / f"{'0' * 32}.warc.gz").write_bytes(b"of a lost task")
    other = W.member(W.record({"record_type": "response", "page_id": 9, "url": "u", "payload_digest": "d", "payload_bytes": 1, "payload": b"x", "refers_to": None}, "x"))
    (tmp_path / "w" / "other.warc.gz").write_bytes(other)
    assert [r[0] for r in read()] == [1, 2, 3, 9]
    with pytest.raises(FileExistsError):
        W.write_archive(page(4), path, mode="error")
    W.write_archive(page(5, 6), path, mode="overwrite")
    assert read() == [(5, "response", None), (6, "revisit", 5)]
    W.write_archive(page(7), path)
    assert [r[0] for r in read()] == [5, 6, 7]
    W.write_archive(page(8), f"file://{tmp_path}/new", mode="error")
    assert W.read_archive(spark, f"file://{tmp_path}/new").count() == 1
    with pytest.raises(ValueError, match="no mode"):
        W.write_archive(page(8), path, mode="ignore")


def test_odd_pages_equal_sql(spark, tmp_path):
    """Null and repeated page_ids, and a very long payload, are told alike by code and SQL."""
    rows = [(None, LONG), (1, LONG), (1, LONG), (2, LONG), (None, "<i>" + "y" * 300), (3, "z" * 5_000_000), (4, "z" * 5_000_000), (5, None), (5, ""), (None, None)]
    spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = sorted((tuple(r) for r in W.op9_warc(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(duckdb.sql(W.OP9_SQL).fetchall(), key=repr) and sum(r[3] == "revisit" for r in got) == 3


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
    got = sorted(tuple(r) for r in W.op9_warc(spark, d).collect())
    assert got == sorted(duckdb.sql(W.OP9_SQL).fetchall())
