import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from evidra.llm import chunk_tokens as C

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "\n\n", "x" * 3000, "Hello, world. don't étude " * 40, "a<|endoftext|>b <|startoftext|>" * 60, "İ ΣΑΣ 3.14 日本語 " * 50, "日本" * 900, "é ́  x y\tz\r\n" * 30,
    "it's we'll they'd 's's 'll " * 50, "<|endof text|> <|endoftext|><|endoftext|>" * 40, "\U0001f600 " * 300, "A" * 300 + " " + "b" * 300,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(e, texts, library):
    ids, bounds = e.encode(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    want = [library.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(bounds, bounds[1:])]
    assert e.decode(ids, bounds).to_pylist() == want


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_ids_are_the_librarys_wherever_texts_are_cut(library, bits):
    e = C.ChunkEncoder(PATH, bits=bits, chunks=50, pieces=40)
    rng = random.Random(bits)
    parts = ["the ", "Wor", "ld's", " ", "\n", "<|endoftext|>", "<|end", "é", "é", "日本", "42", "...", " a", " ", "'ll"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(400))) for _ in range(80)]
    check(e, texts, library)
    check(e, texts[::-1], library)  # from what is kept by now, some of it forgotten
    check(e, ["fresh unseen qqq " * 90], library)
    assert len(e.chunks) < 150 and len(e.pieces) < 150


def test_shared_chunks_are_encoded_once(library):
    rng = random.Random(1)
    passage = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000))
    e = C.ChunkEncoder(PATH)
    check(e, [f"{i} own beginning {'z' * i} {passage}" for i in range(20)], library)
    assert e.met > 19 * len(passage) and e.encoded < 1.3 * len(passage)


def test_cuts_follow_the_content():
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 5000).astype(np.uint8)
    one = C.cuts(np.concatenate([passage]), np.array([0]), 6)
    two = C.cuts(np.concatenate([rng.integers(97, 123, 77).astype(np.uint8), passage]), np.array([0]), 6) - 77
    assert len(one) > 40 and set(one[one >= 32]) == set(two[two >= 32])


def test_edges_that_do_not_agree_are_widened():
    class Merging(C.ChunkEncoder):
        """A tokenizer of characters that makes one id of 'x y'."""

        def _library(self, texts):
            each = [[0 if c == "\x00" else ord(c) for c in t.replace("x y", "\x00") if c != " "] for t in texts]
            return np.array([i for x in each for i in x], "<u4"), np.cumsum([0] + [len(x) for x in each]).tolist()

    e = Merging(PATH)
    assert e._agreed(["x y ab ef cd"])[0] == ("x y", np.array([97, 98], "<u4").tobytes(), "ef cd")
    assert e._agreed(["qx y"])[0] == ("qx y", b"", None)


def test_query_against_the_library(spark, library):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in C.op11_chunked_bpe(spark, d).collect()}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got.pop(r.doc_id) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert not got


def test_odd_rows_and_round_trip(spark, library):
    rows = [(i if i else None, t, "own", 1) for i, t in enumerate(TEXTS)] + [(3, "again", "x", 2), (3, "again", "x", 2), (99, "long word " * 100_000, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    encoded = C.encode_documents(docs, PATH)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=repr) == want
    texts = sorted(((r.doc_id, r.text) for r in C.decode_documents(encoded, PATH).collect()), key=repr)
    assert texts == sorted(((i, library.decode(ids, skip_special_tokens=False)) for i, ids in want), key=repr)
    assert C.digests(docs.limit(0), PATH).collect() == [] and C.decode_documents(encoded.limit(0), PATH).collect() == []


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, library = C.ChunkEncoder(path), Tokenizer.from_file(path)
    ids, bounds = e.encode(pa.array(["a  b\n c" * 100, None]))
    assert ids.tolist() == library.encode("a  b\n c" * 100, add_special_tokens=False).ids and bounds.tolist() == [0, len(ids), len(ids)]
    assert e.decode(ids, bounds).to_pylist() == ["a  b\n c" * 100, ""]
