import hashlib
import struct
import zlib

import pytest

from evidra.llm import matroska as M


@pytest.mark.parametrize("n", [64, 512, 576, 4096, 4160, 131072, 131136, 1_000_000])
def test_round_trip_timestamps_and_cues(n):
    samples = bytes(i * 7 % 251 for i in range(n))
    data = M.mux(samples)
    packets, cues = M.demux(data)
    assert b"".join(data[o : o + s] for _, _, _, o, s in packets) == samples
    assert [p[1] for p in packets] == [k * 64_000_000 for k in range(len(packets))]
    assert len(cues) == -(-n // 131072) and all(data[c : c + 4] == b"\x1fC\xb6u" for _, _, c in cues)


def test_other_forms_of_lacing_groups_voids_and_unknown_sizes():
    track = M.element(M.TRACKS, M.element(M.TRACK_ENTRY, M.unsigned(M.TRACK_NUMBER, 1)))
    xiph = b"\x81" + struct.pack(">hB", 5, 0x82) + b"\x02" + b"\xff\x05" + b"\x03" + b"a" * 260 + b"bbb" + b"cc"
    ebml = b"\x81" + struct.pack(">hB", 9, 0x86) + b"\x02" + M.vint(3) + b"\xc0" + b"a" * 3 + b"b" * 4 + b"z"
    group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, b"\x81" + struct.pack(">hB", 7, 0) + b"grp") + M.element(M.REFERENCE_BLOCK, b"\xff"))
    cluster = M.unsigned(M.TIMESTAMP, 100) + M.element(0xEC, b"void") + M.element(M.SIMPLE_BLOCK, xiph) + group + M.element(M.SIMPLE_BLOCK, ebml)
    unknown = M.CLUSTER.to_bytes(4, "big") + b"\xff" + cluster
    data = M.element(M.EBML, b"") + M.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + track + unknown + M.element(M.CLUSTER, M.unsigned(M.TIMESTAMP, 200) + M.element(M.SIMPLE_BLOCK, b"\x81\x00\x00\x80end"))
    packets, _ = M.demux(data)
    assert [(data[o : o + s], t // 10**6, k) for _, t, k, o, s in packets] == [
        (b"a" * 260, 105, True), (b"bbb", 105, True), (b"cc", 105, True), (b"grp", 107, False), (b"aaa", 109, True), (b"bbbb", 109, True), (b"z", 109, True), (b"end", 200, True)]


def test_query_reads_back_what_it_stored(spark):
    got = {r.doc_id: r for r in M.op6_media_columns(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        raw = r.text.encode()
        payload = raw + bytes(-len(raw) % 64)
        x = got.pop(r.doc_id)
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        data = M.mux(payload)
        assert (x.media_bytes, x.n_packets, x.last_timestamp_ns) == (len(data), -(-len(payload) // 512), (-(-len(payload) // 512) - 1) * 64_000_000)
        crossings = sum((a >= 128) != (b >= 128) for a, b in zip(payload, payload[1:]))
        told = {"packets": -(-len(payload) // 512), "sum": sum(payload), "squares": sum(b * b for b in payload), "crossings": crossings, "max": max(payload), "distinct": len(set(payload))}
        assert x.feature == ";".join(f"{k}={v}" for k, v in told.items())
        assert x.media_sha256 == hashlib.sha256(M.mux(payload)).hexdigest()
    assert not got


def test_nulls_errors_and_empty(spark):
    docs = spark.createDataFrame([(1, None, b"x"), (1, None, b"y"), (None, "a" * 64, b"z")], "doc_id long, text string, media binary")
    rows = M.media_features(M.with_packets(M.media_column(docs))).collect()
    assert sorted((r.n_bytes, r.payload_bytes) for r in rows) == [(0, 64), (0, 64), (64, 64)] and len({r.media_sha256 for r in rows if r.n_bytes == 0}) == 1
    broken = M.packet_table(spark.createDataFrame([(1, b"\x1a\x45\xdf\xa3\x90"), (2, None), (3, M.mux(bytes(64)))], "doc_id long, media binary")).collect()
    assert [(r.doc_id, r.error is None) for r in broken] == [(1, False), (2, False), (3, True)]
    files = spark.createDataFrame([(1, 5, b"\x1a\x45\xdf\xa3\x90", 0), (2, 5, None, 0), (3, 64, M.mux(bytes(64)), 0), (4, 0, b"", 0)], "doc_id long, n_bytes long, media binary, feature int")
    got = {r.doc_id: r for r in M.media_features(M.with_packets(files)).collect()}
    assert {k: r.error for k, r in got.items() if k != 1} == {2: "no media", 3: None, 4: "no packets"} and got[1].error and got[1].feature is None
    assert got[3].payload_bytes == 64 and got[2].media_bytes is None
    assert M.media_features(M.with_packets(M.media_column(docs.limit(0)))).count() == 0
