import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from evidra.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_nears_the_bound(seed):
    rng = random.Random(seed)
    histogram = defaultdict(int)
    for _ in range(4000):
        histogram[min(4096, max(1, int(rng.lognormvariate(6 + seed / 4, 1))))] += 1
    rows = P.planned(histogram)
    room = defaultdict(int)
    for a, n in histogram.items():
        spans = sorted(rows[rows.at_length == a][["lo", "hi"]].itertuples(index=False))
        assert [s.lo for s in spans] == [0, *[s.hi for s in spans][:-1]] and spans[-1].hi == n
    for r in rows.itertuples():
        for b in range((r.hi - r.lo) // r.each):
            room[r.sequence + b] += r.each * r.at_length
    assert max(room.values()) <= 4096 and sorted(room) == list(range(len(room)))
    assert len(room) <= 1.02 * sum(a * n for a, n in histogram.items()) / 4096 + 15


def test_query_packs_whole_documents_gapless(spark):
    rows = P.op1_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = tok.encode(d.text, add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc.pop(d.doc_id), key=lambda r: r.piece)
        assert [(p.start, p.length) for p in pieces] == [(a, min(4096, len(ids) - a)) for a in range(0, len(ids), 4096)]
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes()) for a in range(0, len(ids), 4096)]
    assert not by_doc
    for spans in by_seq.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()] and sum(n for _, n in spans) <= 4096
    assert len(by_seq) <= sum(r.length for r in rows) / 4096 * 1.03 + 2


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 2), (2, "", 3), (None, "a b", 4), (3, "w " * 9000, 5)], "doc_id long, text string, rank int")
    rows = P.pack_documents(docs, PATH).collect()
    assert len(rows) == 4 + 3 and len({r.sequence_id for r in rows}) == 3
    assert P.pack_documents(docs.limit(0), PATH).count() == 0
