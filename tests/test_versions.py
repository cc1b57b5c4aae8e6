"""Pointers that are put once, publishers that meet, and metadata kept from version to version."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from evidra.operators import audit as V
from evidra.operators import versions as N
from evidra.operators.shared import published


def test_one_of_many_writers_puts_a_pointer(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: N.put_if_absent(spark, f"{tmp_path}/versions/{1:010d}", f'{{"run": "{i}"}}'), range(24)))
    assert won.count(True) == 1 and N.pointers(spark, str(tmp_path)) == {1: {"run": str(won.index(True))}}
    assert [p.name for p in (tmp_path / "versions").iterdir()] == ["0000000001"]


def test_publishers_that_meet(spark, tmp_path):
    root = str(tmp_path)
    V.publish(spark, {"things": spark.range(1)}, root)

    def meanwhile(read):
        V.publish(spark, {"things": spark.range(5)}, root)
        return []

    with pytest.raises(N.Overtaken, match="version 2"):
        V.publish(spark, {"things": spark.range(9)}, root, meanwhile)
    assert V.opened(spark.newSession(), root)["things"].count() == 5 and V.opened(spark, root, 1)["things"].count() == 1
    V.publish(spark, {"things": spark.range(9)}, root)
    assert N.latest(spark, root) == 3 and V.opened(spark, root)["things"].count() == 9
    runs = lambda: sum(p.name.startswith("run-") for p in tmp_path.iterdir())
    assert runs() == 4 and N.cleaned(spark, root) == []  # the others are too young
    gone = N.cleaned(spark, root, keep=2, unseen_for=-60)
    assert len(gone) == 2 and runs() == 2 and V.opened(spark, root)["things"].count() == 9 and V.opened(spark, root, 2)["things"].count() == 5


def test_metadata_from_version_to_version(spark, tmp_path):
    root, columns = f"{tmp_path}/cache", "pmid string, title string, year long"
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "pmid string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert N.metadata(spark, root) is None
    missing, at = N.to_fetch(spark, root, ids("1", "2", "3", "3"), "pmid")
    assert rows(missing) == [("1",), ("2",), ("3",)] and at == 0
    first = spark.createDataFrame([("1", "one", 2001), ("2", "two", 2002), ("2", "again", 2003), ("9", "not asked", 1)], columns)
    assert N.update_metadata(spark, root, ids("1", "2", "3"), first, "pmid", 0) == 1
    pinned = N.metadata(spark, root)
    assert rows(pinned) == [("1", "one", 2001), ("2", "again", 2003), ("3", "", 0)]
    missing, at = N.to_fetch(spark, root, ids("2", "3", "4"), "pmid")
    assert rows(missing) == [("4",)] and at == 1  # an empty row isn't asked for again
    more = spark.createDataFrame([("4", "four", 2004), ("2", "other", 1)], columns)
    with pytest.raises(Exception, match="nothere"):
        N.update_metadata(spark, root, ids("2", "4"), more.selectExpr("pmid", "raise_error('nothere') AS title", "year"), "pmid", 1).collect()
    assert N.latest(spark, root) == 1 and rows(N.metadata(spark, root)) == rows(pinned)
    assert N.update_metadata(spark, root, ids("2", "3", "4"), more, "pmid", 1) == 2
    assert rows(N.metadata(spark, root)) == [("2", "again", 2003), ("3", "", 0), ("4", "four", 2004)]
    with pytest.raises(N.Overtaken):
        N.update_metadata(spark, root, ids("5"), more, "pmid", 1)
    assert rows(pinned) == rows(N.metadata(spark, root, 1)) and N.latest(spark, root) == 2


def test_queries_over_opened_tables(spark, tmp_path):
    V.publish(spark, {"things": spark.range(5), "more": spark.range(2).selectExpr("id", "'x' AS name")}, str(tmp_path))
    tables = V.opened(spark, str(tmp_path))
    assert V.listing(tables) == [("more", "id", "bigint"), ("more", "name", "string"), ("things", "id", "bigint")]
    got = V.asked(spark, "SELECT t.id FROM {things} t LEFT JOIN {more} m ON t.id = m.id WHERE t.id < :most AND (name = :name OR name IS NULL)", tables, most=4, name="x' OR 1=1 --")
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_a_published_table_is_made_once_for_the_same_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in.parquet")
    made = []

    def make():
        made.append(1)
        return spark.read.parquet(f"{tmp_path}/in.parquet").selectExpr("id * 2 AS x")

    read = lambda: sorted(r.x for r in published(spark, "twice", [f"{tmp_path}/in.parquet"], make).collect())
    assert read() == read() == [0, 2, 4] and len(made) == 1
    spark.range(3, 4).write.mode("append").parquet(f"{tmp_path}/in.parquet")
    assert read() == [0, 2, 4, 6] and len(made) == 2
