import math
import random
import re
from collections import Counter

import duckdb
import pytest

from evidra.llm import lexical as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, k=20):
    """Every document scored for every item; rows (item_id, rank, doc_id, score)."""
    found = [(i, TERM.findall(lower(t))) for i, t in docs]
    found = [(i, Counter(x), len(x)) for i, x in found if x]
    n, total = len(found), sum(x[2] for x in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, counts, length in found:
            m = 75 + 25 * length * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in TERM.findall(lower(text)) if t in counts)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def test_terms():
    text = "Ab-c_D9 é\xa0É\x1cx\x7fy 日本!  z"
    assert [t.decode() for t in L.terms_of(text)] == TERM.findall(lower(text))


@pytest.mark.parametrize("places", [1, 8])
def test_bounds_are_never_below_scores(places, monkeypatch):
    monkeypatch.setattr(L, "PLACES", places)
    rng = random.Random(places)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 900))) for _ in range(60)] + ["w1 " * 400, "w1"]
    queries = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(30)]
    block = L.Block(queries, {w.encode(): i for i, w in enumerate(words)}, len(texts), sum(len(t.split()) for t in texts))
    loose = 0
    for t in texts:
        counts, n = Counter(L.terms_of(t)), len(t.split())
        bounds = block.bounds(n, L.sketch(counts, L.Hashes()))
        for j, bound in enumerate(bounds):
            assert bound >= block.score(j, counts, n)
            loose += bound - block.score(j, counts, n)
    assert loose > 0 if places == 1 else True


def made():
    rng = random.Random(9)
    words = [f"t{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, weights=range(300, 0, -1), k=rng.randrange(1, 120)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(50)] + [(7, docs[7][1]), (7, "t5 t5 other"), (None, docs[7][1]), (None, None), (5000, ""), (5001, "-- !"), (5002, "t299 " * 50_000 + "T298"), (5003, "t1 " * 300)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(30)] + [(30, docs[7][1]), (31, None), (32, "none of these"), (33, "t5 T5 t5"), (33, "t5 T5 t5"), (None, "other")]
    return docs, items


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("block", [7, 256])
def test_search_equals_scoring_every_document(spark, monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    docs, items = made()
    frame = spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, text string, key string, items int").repartition(5)
    asked = spark.createDataFrame([(*q, 1) for q in items], "item_id long, text string, rank int")
    index = L.build_index(frame)
    assert ordered(L.search(index, frame, asked).collect()) == ordered(plain(docs, items))
    assert ordered(L.search(index, frame, asked, k=3).collect()) == ordered(plain(docs, items, 3))


def test_empty_tables(spark):
    docs, items = made()
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert L.search(L.build_index(frame.limit(0)), frame.limit(0), asked).collect() == []
    assert L.search(L.build_index(frame), frame, asked.limit(0)).collect() == []


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    got = ordered(L.op12_lexical_search(spark, d).collect())
    assert got == ordered(duckdb.sql(L.OP12_SQL).fetchall()) and len(got) > 300
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert got == ordered(plain(docs, items))
