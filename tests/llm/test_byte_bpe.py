import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

from evidra.llm import byte_bpe as B

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["don't  stop\t\tnow's ", " étude 日本語 テキスト", "😀😀 a😀b\n\n  x", "", None, "İ ΣΑΣ\x1cz　y", "a\n b\r\n c 123 4５６ ½", "  \n", "x" * 5000, "aaa ababab'll'S"]


def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_tiktoken_and_bytes_come_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(list(enumerate(ODD, 10**6)), "doc_id long, text string")
    both = docs.unionByName(odd)
    enc, got = plain(), {r.doc_id: r for r in B.round_trip(both, PATH, P.PATTERN).collect()}
    for r in both.collect():
        ids = enc.encode_ordinary(r.text or "")
        x = got[r.doc_id]
        assert (x.n_tokens, x.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()), r
        assert x.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_offsets_and_split_characters(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    coded = B.encode(docs, PATH, P.PATTERN)
    rows = {r.doc_id: r for r in coded.collect()}
    assert any(len(r.ids) > len(ODD[i]) for i, r in rows.items() if ODD[i])  # characters of several tokens
    assert all(r.byte_offsets[:1] == ([0] if ODD[i] else []) for i, r in rows.items())
    assert {r.doc_id: r.decoded_text for r in B.decode(coded, PATH, P.PATTERN).collect()} == {i: t or "" for i, t in enumerate(ODD)}


def test_repeated_rows_clashing_columns_and_empty_tables(spark):
    rows = [(1, "same text", 5, "x"), (1, "same text", 5, "x"), (None, None, 6, "y"), (2, "word " * 200_000, 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids_sha256 string")
    got = sorted((r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in B.round_trip(docs, PATH, P.PATTERN).collect())
    enc = plain()
    assert got == sorted((i or 0, len(enc.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert B.round_trip(docs.limit(0), PATH, P.PATTERN).collect() == [] and B.encode(docs.limit(0), PATH, P.PATTERN).collect() == []


def test_the_garbage_collector_is_on_again_after_an_error():
    """A reused worker must not keep it off: the function of batches is run here as a worker would, up to a batch that fails."""
    import gc

    class Docs:
        sparkSession = None

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run

    run, ship, B.ship = None, B.ship, lambda spark: None
    column, B.F.col = B.F.col, lambda name: type("C", (), {"cast": lambda s, t: s, "alias": lambda s, n: s})()
    try:
        run = B.round_trip(Docs(), PATH, P.PATTERN)
    finally:
        B.ship, B.F.col = ship, column
    import pyarrow as pa
    import pytest

    good = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a b"])], names=["doc_id", "text"])
    with pytest.raises(Exception):
        list(run(iter([good, pa.RecordBatch.from_arrays([pa.array([1])], names=["doc_id"])])))
    assert gc.isenabled()
    some = run(iter([good, good]))
    next(some)
    some.close()
    assert gc.isenabled()
