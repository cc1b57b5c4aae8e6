"""Queries without subsets of ids against counts in plain Python."""

from collections import Counter

from evidra.operators import graph as G
from evidra.plans import catalogue

DIR = "/root/testdata/sf0.001"


def met(spark):
    """The distinct suppliers of each order."""
    found = {}
    for r in spark.read.parquet(f"{DIR}/lineitem.parquet").select("l_orderkey", "l_suppkey").collect():
        found.setdefault(r.l_orderkey, set()).add(r.l_suppkey)
    return found


def test_two_hop_all_takes_every_pair_and_seed(spark):
    partners = {}
    for s in met(spark).values():
        for a in s:
            partners.setdefault(a, set()).update(s - {a})
    paths = Counter((a, c) for a in partners for b in partners[a] for c in partners[b] if a != c)
    got = catalogue.QUERIES["two_hop_all"](spark, DIR).collect()
    assert len(got) == len(paths) and {(r.protein, r.target): r.n_paths for r in got} == paths


def test_two_hop_takes_the_stated_seeds(spark):
    got = catalogue.QUERIES["two_hop"](spark, DIR).collect()
    assert got and {r.protein for r in got} == {k for k in set().union(*met(spark).values()) if k % 50 == 0}


def test_two_hop_over_a_hub(spark):
    pairs = spark.createDataFrame([(0, k) for k in range(1, 40)] + [(1, 2), (3, 3)], "a long, b long")
    got = {(r.protein, r.target): r.n_paths for r in G.two_hop(pairs, spark.range(0, 3).withColumnRenamed("id", "protein")).collect()}
    want = {(1, k): 1 for k in range(2, 40)} | {(2, k): 1 for k in [1, *range(3, 40)]} | {(0, 1): 1, (0, 2): 1, (1, 0): 1, (2, 0): 1}
    assert got == want


def ids(spark, name, column):
    return {r[0] for r in spark.read.parquet(f"{DIR}/{name}.parquet").select(column).collect()}


def test_queries_over_all_ids_leave_none_out(spark):
    found = {n: catalogue.QUERIES[n](spark, DIR).collect() for n in ("partners_above", "family_rollup", "ancestor_closure", "closure_edges", "observed_lookup", "asof_release")}
    suppliers, parts, orders = set().union(*met(spark).values()), ids(spark, "part", "p_partkey"), ids(spark, "orders", "o_orderkey")
    together = Counter((a, b) for s in met(spark).values() for a in s for b in s if a != b)
    assert {(r.protein, r.partner): r.n_publications for r in found["partners_above"]} == {k: n for k, n in together.items() if n >= 2}
    assert max(r.n_hosts for r in found["family_rollup"]) == len(suppliers)
    assert parts <= {r.id for r in found["ancestor_closure"]} and parts - {0} == {r.child for r in found["closure_edges"]}
    looked = {r.stable_id: r.accession for r in found["observed_lookup"]}
    assert {k for k in looked if k >= 0} == orders and all(looked[-k - 1] is None for k in orders)
    dates = {str(x)[:10] for x in ids(spark, "orders", "o_orderdate")}
    for r in found["asof_release"]:
        assert (r.release and str(r.release)) == max((x for x in dates if x <= str(r.cutoff)), default=None)
