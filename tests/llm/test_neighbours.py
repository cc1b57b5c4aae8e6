import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from evidra.llm import neighbours as A

COLUMNS = "vec_id long, embedding array<double>"


def brute(ids, x, q, own, k=10):
    """The k nearest of a query's row by brute force, as (vec_id, distance)."""
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    return [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d)) if ids[i] != own][:k]


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_recall_and_exact_scores(spark, spread):
    """20 000 vectors of 64 components: one cloud without any structure, and one of 200 clusters."""
    rng = np.random.default_rng(11)
    x = (rng.normal(size=(20_000, 64)) + spread * rng.normal(size=(200, 64))[rng.integers(0, 200, 20_000)]).astype(np.float32)
    ids = np.arange(20_000)
    frame = spark.createDataFrame(list(zip(ids.tolist(), x.tolist())), "vec_id long, embedding array<float>")
    got: dict[int, list] = {}
    for r in A.nearest(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x, hit = x.astype(np.float64), 0
    for q in range(0, 20_000, 100):
        own, want = got.pop(q), brute(ids, x, q, q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert np.allclose([r[2] for r in own], np.sqrt(((x[[r[1] for r in own]] - x[q]) ** 2).sum(1)), rtol=1e-12)
        hit += len({v for v, _ in want} & {r[1] for r in own})
    assert not got and hit / 2000 >= 0.95


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(100, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, nan]), (5, [1.0, None]), (6, [1.0, 1.0]), (200, [nan, 1.0]), (7, [1.0]), (None, [1.0, 2.0]), (100, [3.0, 0.0])]
    v = spark.createDataFrame([(*r, 0.0, "x") for r in rows], f"{COLUMNS}, score double, rank string")
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6)) for r in A.nearest(v, F.col("vec_id") % 100 == 0).collect())
    assert got == [(100, 1, 1, 1.0), (100, 1, 1, 2.236068), (100, 2, 6, 1.0), (100, 2, 6, 2.236068)]
    assert A.nearest(v.limit(0), F.lit(True)).count() == 0
    assert A.nearest(v.where("vec_id IN (2, 3, 4)"), F.lit(True)).count() == 0


def test_repeated_queries_have_lists_of_their_own_and_the_sql_agrees(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.integers(-3, 4, 3).astype(float).tolist()) for k in range(90)] + [(100, [1.0, 0.0, 0.0]), (100, [9.0, 0.0, 0.0]), (100, [9.0, 0.0, 0.0]), (200, [0.0, 0.0, 0.0]), (1, [1.0, 2.0])]
    v = spark.createDataFrame(rows, COLUMNS)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in A.nearest(v, F.col("vec_id") % 100 == 0).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = sorted((a, b, c, round(s, 9)) for a, b, c, s in con.execute(A.OP10_SQL).fetchall())
    assert got == want and sum(r[0] == 100 for r in got) == 30


def test_lengths_that_differ_between_queries_and_others(spark):
    v = spark.createDataFrame([(k, [1.0 * k, 1.0]) for k in range(1, 20)] + [(100, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 3.0]), (300, [5.0, 1.0])], COLUMNS)
    got = A.nearest(v, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert {r.query_id for r in got} == {300} and [r.vec_id for r in got[:3]] == [5, 4, 6]


def test_components_of_any_size(spark):
    rows = [(k, [k * 1e200, 0.0]) for k in range(1, 30)] + [(100, [3.1e200, 0.0])]
    got = A.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got[:4]] == [3, 4, 2, 5] and abs(got[0].score / 1e199 - 1) < 1e-9
    rows = [(k, [k * 1.0, 1.0]) for k in range(1, 40)] + [(77, [1e300, 1e300]), (100, [3.1, 1.0])]
    got = A.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got[:4]] == [3, 4, 2, 5]


def test_many_equal_queries_and_very_long_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 3000))
    rows = [(k + 1, x[k].tolist()) for k in range(30)] + [(100, x[0].tolist())] * 40
    got = A.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") == 100).collect()
    assert len(got) == 400 and sum(r.vec_id == 1 and r.rank == 1 and r.score == 0 for r in got) == 40


def test_chunks_and_blocks_leave_the_result_as_it_is(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 6))
    v = spark.createDataFrame([(k, x[k].tolist()) for k in range(900)], COLUMNS)
    want = sorted(tuple(r) for r in A.nearest(v, F.col("vec_id") % 3 == 0, rerank=900, probe=256).collect())
    plain = sorted((q, n + 1, i) for q in range(0, 900, 3) for n, (i, _) in enumerate(brute(np.arange(900), x, q, q)))
    assert [r[:3] for r in want] == plain
    monkeypatch.setattr(A, "CHUNK", 200)
    monkeypatch.setattr(A, "LEAST_QUERIES", 50)
    monkeypatch.setattr(A, "MOST_QUERIES", 50)
    assert sorted(tuple(r) for r in A.nearest(v, F.col("vec_id") % 3 == 0, rerank=900, probe=256).collect()) == want


def test_copies_crowd_nothing_out(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 8))
    rows = [(k, x[k].tolist()) for k in range(40)] + [(k, x[0].tolist()) for k in range(100, 3100)] + [(150, x[0].tolist()), (7, x[0].tolist())]
    v = spark.createDataFrame(rows, COLUMNS).repartition(7)
    got: dict[int, list] = {}
    for r in A.nearest(v, F.col("vec_id").isin(0, 39, 3000), rerank=12).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    ids, at = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for q, own in ((0, x[0]), (39, x[39]), (3000, x[0])):
        order = np.lexsort((ids, np.sqrt(((at - own) ** 2).sum(1))))
        assert got[q] == [i for i in ids[order].tolist() if i != q][:10], q


def test_exact_where_codes_fit_badly(spark):
    """Many components without structure, sizes that differ by magnitudes, tight groups far apart, and ties of nearly all."""
    rng = np.random.default_rng(17)
    n = 3000
    groups = rng.normal(size=(6, 16)) * 1e6
    kinds = {
        "many components": rng.normal(size=(n, 256)),
        "sizes": rng.normal(size=(n, 16)) * np.exp(4 * rng.normal(size=(n, 1))),
        "groups": groups[rng.integers(0, 6, n)] + 1e-3 * rng.normal(size=(n, 16)),
        "far off": 1e8 + rng.normal(size=(n, 16)),
        "ties": np.eye(48)[rng.integers(0, 48, n)] * rng.integers(1, 40, (n, 1)),
    }
    for kind, x in kinds.items():
        frame = spark.createDataFrame([(k, x[k].tolist()) for k in range(n)], COLUMNS)
        got: dict[int, list] = {}
        for r in A.nearest(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == {q: [i for i, _ in brute(np.arange(n), x, q, q)] for q in range(0, n, 100)}, kind


def test_rows_of_a_querys_own_id_take_no_place(spark):
    """One id on 400 vectors next to a query of that id, whose nearest others are farther off than all of them."""
    rng = np.random.default_rng(4)
    near, other = rng.normal(size=(400, 4)) * 0.01, rng.normal(size=(300, 4)) + 5
    rows = [(100, v.tolist()) for v in near] + [(k + 1000, v.tolist()) for k, v in enumerate(other)] + [(7, near[3].tolist())]
    got: dict[tuple, list] = {}
    found = A.nearest(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") == 100).collect()
    assert len(found) == 4000 and all(r.vec_id != 100 for r in found)
    assert sum(r.vec_id == 7 and r.rank == 1 for r in found) == 400
    for r in found:
        got.setdefault((r.rank,), []).append(r.score)
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    want = [[d for _, d in brute(ids, x, q, 100)] for q in range(400)]
    assert all(np.allclose(sorted(got[k + 1,]), sorted(w[k] for w in want), rtol=1e-12) for k in range(10))
