import hashlib
import random
import zlib

import numpy as np
import pytest

from evidra.llm import periodic as P


def plain_runs(words):
    """All runs by definition: for every period the maximal stretches that keep it, the smallest period of each stretch."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q) and j > i:
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((a, b, q) for (a, b), q in best.items())


def samples():
    rng = random.Random(5)
    yield []
    yield [1] * 11
    yield [1] * 12
    yield [1] * 300
    yield [1, 2] * 7
    yield list(range(40)) * 2
    yield list(range(40)) * 2 + [40]
    yield ([1] * 30 + [2]) * 9
    yield [1] * 60 + [2] + [1] * 70
    thue = [bin(i).count("1") % 2 for i in range(3000)]
    yield thue
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    yield b  # Fibonacci word: many nested runs
    for k in (1, 2, 3, 50):
        for n in (13, 100, 257, 700):
            yield [rng.randrange(k) for _ in range(n)]
    for _ in range(60):
        words = []
        while len(words) < rng.randrange(12, 500):
            part = [rng.randrange(4) for _ in range(rng.randrange(1, 60))]
            words += part * rng.randrange(1, 5) + part[: rng.randrange(len(part) + 1)]
        yield words


def test_runs_by_definition():
    texts = list(samples())
    for words, runs in zip(texts, P.documents_runs([np.array(t, np.int64) for t in texts])):
        assert [tuple(r) for r in runs.tolist()] == plain_runs(words)


@pytest.mark.parametrize("step", [1, 7, 64])
def test_appended_words_catch_the_same(step):
    for words in list(samples())[:9] + list(samples())[-12:]:
        catcher, caught = P.SquareCatcher(), []
        for i in range(0, len(words), step):
            for start, q in catcher.append(np.array(words[i : i + step], np.int64)).tolist():
                length = max(12, 2 * q)
                assert start + length <= catcher.n and all(words[j] == words[j + q] for j in range(start, start + length - q))
                caught.append((start, q))
        assert [tuple(r) for r in catcher.runs().tolist()] == plain_runs(words)
        assert {(a, q) for a, _, q in plain_runs(words)} <= set(caught)


def test_collisions_only_cost_time(monkeypatch):
    """Hashes of three values: matches are much too long, and are cut by comparing words."""
    monkeypatch.setattr(P, "MIXERS", (np.uint64(0), np.uint64(0)))
    for words in ([1, 2] * 9 + [3], list(range(30)) * 2):
        catcher = P.SquareCatcher()
        catcher.append(np.array(words, np.int64))
        assert set(map(tuple, catcher.runs().tolist())) <= set(plain_runs(words))


def row(doc_id, text, rewritten=True):
    words = text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if rewritten and doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for a, b, q in runs for i in range(a + q, b)}
    top = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    best = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    told = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_plain_runs(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    got = sorted(tuple(r) for r in P.op13_periodic_runs(spark, d).collect())
    assert got == sorted(row(r.doc_id, r.text or "") for r in docs)
    assert sum(r[1] > 0 for r in got) > 15


def test_odd_rows(spark):
    long = " ".join(map(str, range(3000))) + " x" * 50000
    rows = [(1, None), (2, ""), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a b " * 20), (4, "é b " * 12), (4, "c " * 12), (5, "a b c " * 5 + "x y z w " * 9)]
    docs = spark.createDataFrame([(*r, "own", 7) for r in rows], "doc_id long, text string, start string, n_runs int")
    got = sorted((tuple(r) for r in P.repeated_runs(docs).collect()), key=repr)
    assert got == sorted((row(i, t or "", False) for i, t in rows), key=repr)
    assert P.repeated_runs(docs.limit(0)).collect() == []
    one = P.repeated_runs(spark.createDataFrame([(9, long)], "doc_id long, text string")).first()
    assert (one.n_runs, one.start, one.length, one.period) == (1, 3000, 50000, 1)


def test_a_hot_text_of_many_squares_ends():
    words = np.array(([0] * 50 + [1]) * 4000 + [0] * 100000, np.int64)
    assert tuple(P.documents_runs([words])[0][0]) == (0, 50, 1)
