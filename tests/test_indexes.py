"""Closure tables, postings, facts and hubs against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evidra.operators import assemble as A
from evidra.operators import closure as C
from evidra.operators import graph as G
from evidra.operators import lookup as L
from evidra.operators.shared import released, split, written


def plain_closure(edges, nodes):
    up = defaultdict(set)
    for a, b in edges:
        up[a].add(b)
    out = {}
    for n in {x for e in edges for x in e} | set(nodes):
        reached, frontier, d = {n: 0}, [n], 0
        while frontier:
            d += 1
            frontier = [p for x in frontier for p in up[x] if p not in reached and not reached.update({p: d})]
        out |= {(n, a): k for a, k in reached.items()}
    return out


def test_closure_table_over_chains_diamonds_and_cycles(spark):
    rng = random.Random(4)
    cases = [[(i, i + 1) for i in range(37)], [(1, 2), (2, 3), (3, 1), (3, 4), (5, 5)], [(9, 5), (9, 6), (5, 1), (6, 7), (7, 1), (1, 0), (9, 5)]]
    cases.append([(i, rng.randrange(i)) for i in range(1, 120) for _ in range(rng.randrange(3))])
    for edges in cases:
        table = C.closure_table(spark.createDataFrame(edges, "child long, parent long"), spark.createDataFrame([(99,), (1,)], "id long"))
        rows = table.collect()
        assert {(r.id, r.ancestor): r.distance for r in rows} == plain_closure(edges, [99, 1]) and len(rows) == len(plain_closure(edges, [99, 1]))
    below = C.under(table, spark.createDataFrame([(0,), (3,)], "id long")).collect()
    assert {(r.id, r.term) for r in below} == {k for k in plain_closure(cases[-1], [99, 1]) if k[1] in (0, 3)}


def test_lineages_and_merges_by_doubling(spark):
    parents = [(i, max(0, i - 1)) for i in range(21)] + [(100, 20), (101, 20)]
    lines = C.lineage(spark.createDataFrame([(100,), (3,), (3,)], "id long"), spark.createDataFrame(parents, "id long, parent long"))
    got = sorted(tuple(r) for r in lines.collect())
    assert got == sorted([(3, 3 - d, d) for d in range(4)] + [(100, 100, 0)] + [(100, 20 - d, d + 1) for d in range(21)])
    hops = [(i, i + 1) for i in range(1, 30)]
    for ends in ({8}, {9, 4}, {30}):
        got = {r.id: r.resolved for r in C.resolve_merges(spark.range(0, 31), spark.createDataFrame(hops, "old_id long, new_id long"), spark.createDataFrame([(e,) for e in ends], "id long")).collect()}
        assert got == {i: next((j for j in range(i, i + 8) if j in ends and i), None) for i in range(31)}


TEXTS = [(i, " ".join(random.Random(i).choices(["The", "virus", "binds", "host", "a-b", "", "cell2"], k=i % 9)), None if i % 5 == 0 else f"on virus {i}") for i in range(60)]


def plain_scores(docs, terms, weights):
    tf = {(k, f): Counter(w for w in re.split("[^a-z]+", (x or "").lower()) if w) for k, *xs in docs for f, x in zip(("body", "title"), xs)}
    df = Counter((f, w) for (_, f), c in tf.items() for w in c)
    out = defaultdict(float)
    for (k, f), c in tf.items():
        for w in set(terms):
            if c[w]:
                out[k] += weights[f] * (1 + math.log(c[w])) * math.log(1 + len(docs) / df[f, w])
    return {k: round(x, 6) for k, x in out.items()}


def test_search_reads_the_buckets_of_its_terms(spark, tmp_path):
    columns, weights = "id long, body string, title string", {"title": 2.5, "body": 1.0}
    docs = spark.createDataFrame(TEXTS, columns)
    index = written(L.postings(docs, "id", ["body", "title"]), "postings", ["bucket"])
    counts = written(L.term_counts(index), "terms", ["bucket"])
    found = L.search_postings(index, counts, len(TEXTS), "id", ["VIRUS", "cell"], weights)
    assert {r.id: pytest.approx(r.score, abs=2e-6) for r in found.collect()} == plain_scores(TEXTS, ["virus", "cell"], weights)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert scans and all("bucket" in s for s in scans)
    read = {r.bucket for r in spark.createDataFrame([("virus",), ("cell",)], "term string").select(L.bucket(F.col("term")).alias("bucket")).collect()}
    used = index.where(F.col("bucket").isin(list(read)))
    assert 0 < len(used.inputFiles()) and used.select("bucket").distinct().count() <= 2 < index.select("bucket").distinct().count()
    some, more = docs.where("id < 40"), docs.where("id >= 40")
    first = L.postings(some, "id", ["body", "title"])
    both = L.added_postings(first, L.term_counts(first), L.postings(more, "id", ["body", "title"]))
    added = {r.id: r.score for r in L.search_postings(*both, len(TEXTS), "id", ["virus", "cell"], weights).collect()}
    assert added == {r.id: r.score for r in found.collect()}
    assert L.search_postings(index, counts, len(TEXTS), "id", ["--"], weights).collect() == [] and L.search_postings(index, counts, 60, "id", ["nothere"], weights).collect() == []


def test_counters_of_slices_add_up(spark):
    rng = random.Random(8)
    rows = [("a" * rng.randrange(1, 4), rng.randrange(3), rng.randrange(30), rng.choice("xyz") if rng.random() < 0.9 else None, rng.choice("PQ")) for _ in range(400)]
    obs = spark.createDataFrame(rows, "a string, b long, publication long, method string, peptide string")
    pair = ["a", "b"]
    want = {(a, b): (len(g), *(len({x[i] for x in g if x[i] is not None}) for i in (2, 3, 4))) for a, b in {r[:2] for r in rows} for g in [[r for r in rows if r[:2] == (a, b)]]}
    read = lambda df: {(r.a, r.b): (r.n_descriptions, r.n_publications, r.n_methods, r.n_peptides) for r in df.collect()}
    assert read(G.pair_counters(obs, pair)) == want
    one, two = obs.where("publication < 20 AND b < 2"), obs.where("NOT (publication < 20 AND b < 2)")
    facts = G.pair_facts(one, pair)
    counters, merged = G.updated_counters(G.fact_counters(facts, pair), facts, G.pair_facts(two, pair), pair)
    assert read(counters) == want == read(G.fact_counters(merged, pair))


def test_only_hubs_are_dealt_out(spark):
    rng = random.Random(3)
    pairs = list({(min(x), max(x)) for x in [(0, i) for i in range(1, 60)] + [tuple(rng.sample(range(60), 2)) for _ in range(90)]} | {(7, 7)})
    partners = defaultdict(set)
    for a, b in pairs:
        if a != b:
            partners[a].add(b)
            partners[b].add(a)
    want = Counter((a, c) for a in partners for b in partners[a] for c in partners[b] if a != c)
    frame, seeds = spark.createDataFrame(pairs, "a long, b long"), spark.range(0, 60).withColumnRenamed("id", "protein")
    for hub in (5, 20, 10_000):
        assert {(r.protein, r.target): r.n_paths for r in G.two_hop(frame, seeds, hub).collect()} == want


def test_pairs_of_large_groups_are_dealt_out(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(80)) for g, n in ((0, 70), (1, 5), (2, 1)) for _ in range(n)]
    want = sorted((g, a, b) for g in (0, 1, 2) for a in {m for h, m in rows if h == g} for b in {m for h, m in rows if h == g} if a <= b)
    frame = spark.createDataFrame(rows, "g long, m long")
    for hub in (3, 30, 10_000):
        assert sorted(tuple(r) for r in G.pairs_within(frame, "g", "m", hub).collect()) == want


def test_rows_that_stay_and_reasons_of_the_others(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", ["x"]), (2, None, []), (3, "c", None)], "id long, v string, l array<string>")
    kept, counts = split(rows, F.when(F.col("id") == 2, "two"), "test")
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a", ["x"]), (3, "c", None)] and [tuple(r) for r in counts.collect()] == [("two", 1)]
    kept, counts = split(rows.limit(0), F.lit("all"), "test")
    assert kept.collect() == [] and counts.collect() == []
    one = written(rows, "test")
    released(one)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ"):
        one.collect()


def test_cited_ids_of_silos(spark):
    df = spark.createDataFrame
    lists = lambda *x: df([(list(x),), ([],), (None,)], "pmids array<string>")
    got = A.cited_by_silo(df([("1", "HH"), ("2", "VH"), ("1", "VH")], "pmid string, kind string"), df([("3",), ("3",)], "pmid string"), lists("4", "2"), lists("5", "4"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "host"), ("1", "viral"), ("2", "host"), ("2", "viral"), ("3", "host"), ("4", "host"), ("4", "viral"), ("5", "viral")]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(last + (x != y), row[j] + 1, row[j + 1] + 1)
    return row[-1]


def test_near_names_meet_few_and_miss_none(spark):
    rng = random.Random(6)
    parts = ["poly", "merase", "core", "capsid", "Spike", "glyco", "protein", "NS", "1", "2A", "X", "nucleo", "matrix", "-", " ", "E7", "É", "İ"]
    names = sorted({(t, "".join(rng.choices(parts, k=rng.randrange(1, 5)))) for t in range(3) for _ in range(60)})
    asked = sorted({(t, "".join(c for c in n.lower() if rng.random() < 0.9) + rng.choice(["", "s", "xx"])) for t, n in rng.sample(names, 60)} | {(0, ""), (9, "core")})
    similar = lambda a, n: round(1 - distance(a, n.lower()) / max(len(a), len(n)), 6)
    pairs = {(t, a, n) for t, a in asked for u, n in names if t == u}
    want = {p for p in pairs if similar(*p[1:]) >= 0.6}
    frames = spark.createDataFrame(asked, "taxon long, asked string"), spark.createDataFrame(names, "taxon long, name string")
    met = [tuple(r) for r in L.near_candidates(*frames, "taxon").collect()]
    assert len(met) == len(set(met)) and want <= set(met) <= pairs and len(met) < 0.7 * len(pairs)
    got = sorted(tuple(r)[:4] for r in L.near_names(*frames, "taxon").collect())
    best = [sorted(((-similar(a, n), n) for t2, a2, n in want if (t2, a2) == (t, a)))[:3] for t, a in asked]
    assert got == sorted((t, a, n, -s) for (t, a), b in zip(asked, best) for s, n in b)
