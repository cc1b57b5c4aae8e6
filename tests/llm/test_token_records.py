import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from evidra.llm import token_records as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [(3, "Hello, world. don't étude"), (1, None), (2, ""), (3, "Again"), (None, "no id"), (7, "x " * 30000), (5, "a<|endoftext|>b İ ΣΑΣ 3.14 日本")]


def test_crc32c_has_the_published_check_value():
    crc = T.masked_crc32c(np.frombuffer(b"12345678" * 50, np.uint8), np.array([0, 8]), np.array([8, 390]))
    def slow(data):
        r = 0xFFFFFFFF
        for b in data:
            r ^= b
            for _ in range(8):
                r = (r >> 1) ^ (0x82F63B78 if r & 1 else 0)
        r ^= 0xFFFFFFFF
        return ((r >> 15 | r << 17) + 0xA282EAD8) & 0xFFFFFFFF
    assert crc.tolist() == [slow(b"12345678"), slow((b"12345678" * 50)[8:398])]


def test_records_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x") for i, t in TEXTS], "doc_id long, text string, start string")
    index = T.write_records(docs, PATH, f"file://{tmp_path}/r")
    rows = {(r.doc_id, r.n_tokens): r.ids for r in T.read_records(index.orderBy("n_tokens"), f"file://{tmp_path}/r").collect()}
    tok = Tokenizer.from_file(PATH)
    want = {}
    for i, t in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[(i, len(ids))] = np.array(ids, "<u4").tobytes()
    assert {k: bytes(v) for k, v in rows.items()} == want
    assert T.read_records(T.write_records(docs.limit(0), PATH, f"file://{tmp_path}/e"), f"file://{tmp_path}/e").count() == 0


def test_query_against_plain_encoding(spark):
    got = {r.doc_id: r for r in T.op4_token_records(spark, "/root/testdata/sf0.001").collect()}
    tok, start = Tokenizer.from_file(PATH), 0
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect():
        ids = tok.encode(r.text, add_special_tokens=False).ids + [1]
        row = got.pop(r.doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got
