"""Intervals that meet by position against intervals that all meet."""

import random

import pytest

from evidra.operators import merge as M


def frames(spark, spans, chains):
    return spark.createDataFrame(spans, "entry long, start long, stop long"), spark.createDataFrame(chains, "entry long, c int, c_start long, c_stop long")


def plain(spans, chains):
    return sorted((e, a, b, c, x, y) for e, a, b in set(spans) for f, c, x, y in chains if e == f and a <= b and x <= y and x <= b and y >= a)


@pytest.mark.parametrize("direct", [0, 3, 64])
def test_all_overlaps_once(spark, monkeypatch, direct):
    monkeypatch.setattr(M, "DIRECT", direct)
    rng = random.Random(direct)
    length = lambda: rng.choice([0, 1, 2, 3, 7, 8, 9, 60, 300])
    spans, chains = [], []
    for e in range(6):
        for _ in range(rng.randrange(40)):
            a = rng.randrange(0, 400)
            spans.append((e, a, a + length()))
        for c in range(rng.randrange(60)):
            a = rng.randrange(0, 400)
            chains.append((e, c, a, a + length()))
    spans += [(0, 5, 5), (0, 9, 8), (0, 1, 1 << 40), (1, 0, 0)]
    chains += [(0, 900, 5, 5), (0, 901, 5, 4), (0, 902, 1, 1 << 41), (7, 0, 1, 9), (1, 903, 0, 0)]
    one, two = frames(spark, spans, chains)
    assert sorted(tuple(r) for r in M.overlaps(one.distinct(), two).collect()) == plain(spans, chains)


def test_best_match_is_the_same_by_position(spark, monkeypatch):
    rng = random.Random(2)
    spans = [(1, a, a + rng.randrange(40)) for a in rng.sample(range(900), 80)]
    chains = [(1, c, a, a + rng.randrange(60)) for c, a in enumerate(rng.sample(range(900), 200))]
    one, two = frames(spark, spans, chains)
    texts = spark.createDataFrame([(1,)], "entry long")
    found = []
    for direct in (0, 1000):
        monkeypatch.setattr(M, "DIRECT", direct)
        found.append(sorted(tuple(r) for r in M.interval_best_match(one, two, texts).collect()))
    assert found[0] == found[1] and {r[3] for r in found[0]} >= {"best", "overlaps"}


def test_an_entry_of_a_hundred_thousand_chains_ends(spark):
    chains = spark.range(100_000).selectExpr("1L AS entry", "cast(id AS int) AS c", "id * 10 AS c_start", "id * 10 + 14 AS c_stop")
    spans = spark.range(50_000).selectExpr("1L AS entry", "id * 20 + 3 AS start", "id * 20 + 17 AS stop")
    found = M.overlaps(spans, chains)
    assert found.count() == sum(len(range(max(0, (20 * i + 3 - 14 + 9) // 10), min(99_999, (20 * i + 17) // 10) + 1)) for i in range(50_000))
