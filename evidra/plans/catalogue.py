"""Every query of the library by name, bound to the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.functions.text import clean, without_citations
from evidra.operators import archive as R
from evidra.operators import assemble as A
from evidra.operators import audit as V
from evidra.operators import closure as C
from evidra.operators import graph as G
from evidra.operators import lookup as L
from evidra.operators import merge as M
from evidra.operators.shared import published, written

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PEPTIDE = "upper(replace(p_name, ' ', ''))"
VH = f"""(SELECT l_suppkey AS a, c_nationkey AS b_nation, c_mktsegment AS b_name, l_orderkey AS publication, p_brand AS method, {PEPTIDE} AS peptide
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""
S = "(SELECT DISTINCT l_orderkey AS publication, l_suppkey AS s FROM lineitem)"
HH = f"(SELECT x.publication, x.s AS a, y.s AS b FROM {S} x JOIN {S} y ON x.publication = y.publication AND x.s <= y.s)"
HH_PAIRS = f"(SELECT a, b, count(*) AS n_descriptions, count(DISTINCT publication) AS n_publications FROM {HH} GROUP BY a, b)"
HH_BOTH = f"(SELECT a AS protein, b AS partner, n_publications FROM {HH_PAIRS} WHERE a <> b UNION ALL SELECT b, a, n_publications FROM {HH_PAIRS} WHERE a <> b)"
EDGES = """(SELECT p_partkey AS child, p_partkey // 2 AS parent, 'IS_A' AS relation FROM part WHERE p_partkey > 0
  UNION ALL SELECT p_partkey, p_partkey // 3, 'PART_OF' FROM part WHERE p_partkey > 0)"""


def vh_observations(spark: SparkSession, d: str) -> DataFrame:
    """Lines with their order, customer and part: supplier, (nation, segment), publication, method, peptide."""
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr("l_suppkey AS a", "c_nationkey AS b_nation", "c_mktsegment AS b_name", "l_orderkey AS publication", "p_brand AS method", f"{PEPTIDE} AS peptide")


def hh_observations(spark: SparkSession, d: str) -> DataFrame:
    """Unordered pairs of suppliers of one order, a supplier with itself included."""
    return G.pairs_within(t(spark, d, "lineitem").select(F.col("l_orderkey").alias("publication"), "l_suppkey"), "publication", "l_suppkey")


def paths(d: str, *names: str) -> list[str]:
    return [f"{d}/{name}.parquet" for name in names]


PAIR = ["a", "b_nation", "b_name"]


def hh_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Counted pairs of suppliers, published once."""
    return published(spark, "hh-pairs", paths(d, "lineitem"), lambda: G.pair_counters(hh_observations(spark, d), ["a", "b"]))


def vh_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counted pairs of suppliers and (nation, segment), published once."""
    return published(spark, "vh-counters", paths(d, "lineitem", "orders", "customer", "part"), lambda: G.pair_counters(vh_observations(spark, d), PAIR))


def partners(spark: SparkSession, d: str) -> DataFrame:
    """Both directions of the pairs of two suppliers, published once, the partners of a protein together."""
    make = lambda: G.both_ways(hh_pairs(spark, d)).where("protein <> partner").repartitionByRange("protein", "partner").sortWithinPartitions("protein", "partner")
    return published(spark, "partners", paths(d, "lineitem"), make)


def closure(spark: SparkSession, d: str) -> DataFrame:
    """id, ancestor, distance over the edges of parts, published once."""
    nodes = t(spark, d, "part").selectExpr("p_partkey AS id")
    return published(spark, "closure", paths(d, "part"), lambda: C.by_ancestor(C.closure_table(edges(spark, d), nodes)))


def publish(spark: SparkSession, d: str) -> None:
    """Make all tables that queries read published, as a build does before it is queried."""
    for table in (hh_pairs, vh_counters, partners, closure, document_index, page_index):
        table(spark, d)


def edges(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part").where("p_partkey > 0")
    return part.selectExpr("p_partkey AS child", "p_partkey div 2 AS parent", "'IS_A' AS relation").unionByName(part.selectExpr("p_partkey AS child", "p_partkey div 3 AS parent", "'PART_OF' AS relation"))


@query(f"SELECT a, b_nation, b_name, count(*) AS n_descriptions, count(DISTINCT publication) AS n_publications, count(DISTINCT method) AS n_methods, count(DISTINCT peptide) AS n_peptides FROM {VH} GROUP BY ALL")
def pair_counters_vh(spark, d):
    return vh_counters(spark, d)


@query(ORACLE_SQL["pair_counters_vh"])
def pair_counters_added(spark, d):
    """The same counters from two slices: those of orders not divisible by 10, to which the others are added by their facts."""
    obs = vh_observations(spark, d)
    first, more = (written(G.pair_facts(obs.where(part), PAIR), "facts") for part in ("publication % 10 <> 0", "publication % 10 = 0"))
    return G.updated_counters(G.fact_counters(first, PAIR), first, more, PAIR)[0]


@query(f"SELECT * FROM {HH_PAIRS}")
def pair_counters_hh(spark, d):
    return hh_pairs(spark, d)


@query(f"SELECT protein, partner, n_publications, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY protein ORDER BY n_publications DESC, partner) AS rank FROM {HH_BOTH}) WHERE rank <= 5")
def top_partners(spark, d):
    return G.top_of(partners(spark, d), "n_publications", 5).select("protein", "partner", "n_publications", "rank")


@query(f"SELECT protein, partner, n_publications FROM {HH_BOTH} WHERE n_publications >= 2")
def partners_above(spark, d):
    """Partners of every protein with two publications or more."""
    return partners(spark, d).where("n_publications >= 2").select("protein", "partner", "n_publications")


@query("""WITH x AS (SELECT l_orderkey AS publication, l_suppkey AS a, l_partkey AS b, p_brand AS method, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT publication, a, b, method, 'curated' AS source FROM x WHERE l_returnflag = 'R' UNION ALL
SELECT DISTINCT publication, a, b, method, 'archive' FROM x WHERE l_returnflag <> 'R' AND publication NOT IN (SELECT publication FROM x WHERE l_returnflag = 'R')""")
def source_precedence(spark, d):
    x = t(spark, d, "lineitem").join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    x = x.selectExpr("l_orderkey AS publication", "l_suppkey AS a", "l_partkey AS b", "p_brand AS method", "l_returnflag")
    return M.precedence(x.where("l_returnflag = 'R'"), x.where("l_returnflag <> 'R'"), "publication", ["publication", "a", "b", "method"])


GROUPED = """(SELECT DISTINCT l_suppkey AS a, p_brand AS b, CASE WHEN o_custkey % 50 < 10 THEN o_custkey % 50 END AS grp, l_orderkey AS publication
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


@query(f"SELECT a, b, grp, publication FROM (SELECT *, min(publication) OVER (PARTITION BY a, b, grp) AS low FROM {GROUPED}) WHERE grp IS NULL OR publication = low")
def first_of_group(spark, d):
    x = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    x = x.selectExpr("l_suppkey AS a", "p_brand AS b", "CASE WHEN o_custkey % 50 < 10 THEN o_custkey % 50 END AS grp", "l_orderkey AS publication").distinct()
    return M.first_of_group(x, ["a", "b"], "grp", "publication")


REASONS = [("malformed", "l_quantity < 3"), ("negative", "l_discount >= 0.09"), ("not of the host", "l_suppkey % 7 = 0"), ("method not kept", "p_brand LIKE '%5'"), ("open", "o_orderstatus = 'P'")]


@query("SELECT drop_reason, count(*) AS n FROM (SELECT CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in REASONS) + " ELSE 'kept' END AS drop_reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) GROUP BY 1")
def drop_reasons(spark, d):
    x = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    reason = M.first_reason([(n, F.expr(c)) for n, c in REASONS])
    return x.select(F.coalesce(reason, F.lit("kept")).alias("drop_reason")).groupBy("drop_reason").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT l_suppkey, l_partkey, l_returnflag, l_orderkey, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS codes FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_partkey, l_returnflag, count(*) AS n_publications, string_agg(l_orderkey::VARCHAR || ':' || codes, ';' ORDER BY l_orderkey) AS evidence FROM c GROUP BY ALL""")
def annotation_codes(spark, d):
    return G.annotation_codes(t(spark, d, "lineitem"), ["l_suppkey", "l_partkey", "l_returnflag"], "l_orderkey", "l_linestatus")


@query("SELECT l_suppkey, l_partkey, l_returnflag, l_orderkey, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS codes FROM lineitem GROUP BY ALL")
def annotation_evidence(spark, d):
    """A row for each publication of an annotation, with its codes."""
    return G.annotation_evidence(t(spark, d, "lineitem"), ["l_suppkey", "l_partkey", "l_returnflag"], "l_orderkey", "l_linestatus")


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS pmid FROM lineitem),
s AS (SELECT o_orderkey AS pmid, 'host ' || o_orderpriority AS title, 0 AS silo FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, 'viral ' || o_orderstatus, 1 FROM orders WHERE o_orderkey % 2 = 0)
SELECT c.pmid, f.title, CAST(f.silo AS INTEGER) AS silo FROM c LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY silo) AS n FROM s) WHERE n = 1) f USING (pmid)""")
def publications_by_rank(spark, d):
    o = t(spark, d, "orders")
    silos = [o.where("o_orderkey % 3 = 0").selectExpr("o_orderkey AS pmid", "'host ' || o_orderpriority AS title"), o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS pmid", "'viral ' || o_orderstatus AS title")]
    return M.by_rank(t(spark, d, "lineitem").selectExpr("l_orderkey AS pmid").distinct(), silos, "pmid")


@query("""SELECT coalesce(w.pmid, k.pmid) AS pmid, CASE WHEN w.pmid IS NULL THEN 'dropped' WHEN k.pmid IS NULL THEN 'fetch' ELSE 'cached' END AS status
FROM (SELECT DISTINCT l_orderkey AS pmid FROM lineitem WHERE l_returnflag = 'A') w FULL JOIN (SELECT DISTINCT o_orderkey AS pmid FROM orders WHERE o_orderkey % 2 = 0) k ON w.pmid = k.pmid""")
def delta_worklist(spark, d):
    return M.worklist(t(spark, d, "lineitem").where("l_returnflag = 'A'").selectExpr("l_orderkey AS pmid"), t(spark, d, "orders").where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS pmid"), "pmid")


CLOSURE = f"r AS (SELECT DISTINCT p_partkey AS id FROM part UNION SELECT e.parent FROM r JOIN {EDGES} e ON e.child = r.id)"


@query(f"WITH RECURSIVE {CLOSURE} SELECT id FROM r")
def ancestor_closure(spark, d):
    """All ancestors of all parts."""
    return C.ancestors(t(spark, d, "part").selectExpr("p_partkey AS id"), edges(spark, d))


@query(f"WITH RECURSIVE {CLOSURE} SELECT child, parent, relation FROM {EDGES} WHERE child IN (SELECT id FROM r)")
def closure_edges(spark, d):
    """All edges out of them."""
    return C.walked_edges(ancestor_closure(spark, d), edges(spark, d)).select("child", "parent", "relation")


@query(f"""WITH RECURSIVE c AS (SELECT p_partkey AS id, p_partkey AS ancestor, 0 AS distance FROM part UNION SELECT c.id, e.parent, c.distance + 1 FROM c JOIN {EDGES} e ON e.child = c.ancestor AND e.parent <> e.child)
SELECT id, ancestor, CAST(min(distance) AS INTEGER) AS distance FROM c GROUP BY ALL""")
def closure_table(spark, d):
    """Every part with each of its ancestors, itself included, and the length of the shortest way."""
    return closure(spark, d).select("id", "ancestor", "distance")


DOWN = f"b AS (SELECT 5::BIGINT AS id UNION SELECT e.child FROM b JOIN {EDGES} e ON e.parent = b.id)"


@query(f"WITH RECURSIVE {DOWN} SELECT id, min(reason) AS reason FROM (SELECT id, 'under binding' AS reason FROM b UNION ALL SELECT p_partkey, 'component' FROM part WHERE p_partkey % 3 = 2) GROUP BY id")
def excluded_terms(spark, d):
    below = C.under(closure(spark, d), spark.range(5, 6)).select("id")
    return C.excluded([("under binding", below), ("component", t(spark, d, "part").where("p_partkey % 3 = 2").selectExpr("p_partkey AS id"))])


@query("SELECT p_partkey AS id, p_partkey - p_partkey % 8 AS resolved FROM part WHERE p_partkey % 16 <> 9 UNION ALL SELECT p_partkey, NULL FROM part WHERE p_partkey % 16 = 9")
def merge_resolve(spark, d):
    """Ids of 16k + 9 point to themselves in a cycle and so don't resolve; 16k + 10 and on merge past them."""
    part = t(spark, d, "part").selectExpr("p_partkey AS id")
    merged = part.where("id % 8 <> 0").selectExpr("id AS old_id", "CASE WHEN id % 16 = 9 THEN id WHEN id % 16 = 10 THEN id - 2 ELSE id - 1 END AS new_id")
    return C.resolve_merges(part, merged, part.where("id % 8 = 0"))


TREE = "(SELECT p_partkey // 8 AS id, p_partkey // 16 AS parent FROM part WHERE p_partkey % 8 = 0)"
LINES = f"l AS (SELECT id, id AS ancestor, 0 AS depth FROM {TREE} UNION ALL SELECT l.id, p.parent, depth + 1 FROM l JOIN {TREE} p ON p.id = l.ancestor AND p.id <> p.parent)"


def tree(spark, d):
    return t(spark, d, "part").where("p_partkey % 8 = 0").selectExpr("p_partkey div 8 AS id", "p_partkey div 16 AS parent")


@query(f"WITH RECURSIVE {LINES} SELECT id, ancestor, CAST(depth AS INTEGER) AS depth FROM l")
def lineage(spark, d):
    return C.lineage(tree(spark, d), tree(spark, d))


@query(f"WITH RECURSIVE {LINES} SELECT id, arg_min(ancestor, depth) AS nearest FROM l WHERE ancestor BETWEEN 8 AND 15 GROUP BY id")
def nearest_family(spark, d):
    return C.nearest_of_rank(C.lineage(tree(spark, d), tree(spark, d)), tree(spark, d).where("id BETWEEN 8 AND 15"))


@query(f"WITH RECURSIVE {DOWN} SELECT l_suppkey AS protein, count(DISTINCT l_partkey) AS n_terms FROM lineitem WHERE l_partkey IN (SELECT id FROM b) AND l_returnflag <> 'N' GROUP BY 1")
def under_term(spark, d):
    """Distinct terms of each protein at or below a term, by one join with the closure table."""
    below = C.under(closure(spark, d), spark.range(5, 6)).select(F.col("id").alias("l_partkey"))
    rows = t(spark, d, "lineitem").where("l_returnflag <> 'N'").join(below, "l_partkey", "left_semi")
    return rows.groupBy(F.col("l_suppkey").alias("protein")).agg(F.countDistinct("l_partkey").alias("n_terms"))


SPANS = "(SELECT DISTINCT l_orderkey AS entry, CAST(1 + 100 * (l_linenumber % 3) + l_quantity % 50 AS BIGINT) AS start FROM lineitem)"
CHAINS = "(SELECT o_orderkey AS entry, j AS c, 1 + 100 * j AS c_start, 100 + 100 * j AS c_stop FROM orders, (SELECT unnest([0, 1, 2]) AS j) WHERE o_orderkey % 3 <> 0)"


@query(f"""WITH s AS (SELECT entry, start, start + 99 AS stop FROM {SPANS}),
m AS (SELECT s.*, c, CASE WHEN c IS NOT NULL THEN (least(stop, c_stop) - greatest(start, c_start) + 1)::DOUBLE / (greatest(stop, c_stop) - least(start, c_start) + 1) END AS score
  FROM s LEFT JOIN {CHAINS} k ON s.entry = k.entry AND c_start <= stop AND c_stop >= start),
g AS (SELECT entry, start, stop, max(score) AS best, arg_max(c, (score, -c)) AS chain, string_agg(c::VARCHAR, ',' ORDER BY c) AS over FROM m GROUP BY ALL),
n AS (SELECT entry, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT *, CASE WHEN best >= 0.8 THEN 'best' WHEN n = 1 AND entry % 2 = 0 THEN 'entry' WHEN over IS NOT NULL THEN 'overlaps' ELSE 'nothing' END AS kind FROM g JOIN n USING (entry))
SELECT entry, start, stop, kind, CASE kind WHEN 'best' THEN chain::VARCHAR WHEN 'overlaps' THEN over ELSE '' END AS chains FROM k""")
def interval_best_match(spark, d):
    spans = t(spark, d, "lineitem").selectExpr("l_orderkey AS entry", "CAST(1 + 100 * (l_linenumber % 3) + l_quantity % 50 AS BIGINT) AS start").distinct().withColumn("stop", F.col("start") + 99)
    o = t(spark, d, "orders")
    chains = o.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey AS entry", "explode(array(0, 1, 2)) AS c").selectExpr("entry", "c", "1 + 100 * c AS c_start", "100 + 100 * c AS c_stop")
    return M.interval_best_match(spans, chains, o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS entry").distinct())


@query("""SELECT c.cutoff, max(r.release) AS release FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS cutoff FROM lineitem) c
LEFT JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS release FROM orders) r ON r.release <= c.cutoff GROUP BY 1""")
def asof_release(spark, d):
    """The latest order date not after each ship date."""
    cutoffs = t(spark, d, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS cutoff").distinct()
    return M.as_of(cutoffs, t(spark, d, "orders").selectExpr("CAST(o_orderdate AS DATE) AS release"))


@query(f"SELECT x.protein, y.partner AS target, count(*) AS n_paths FROM {HH_BOTH} x JOIN {HH_BOTH} y ON x.partner = y.protein WHERE x.protein % 50 = 0 AND x.protein <> y.partner GROUP BY 1, 2")
def two_hop(spark, d):
    """Two hops over all pairs from the stated query set: suppliers whose id is divisible by 50."""
    return G.two_hop_of(partners(spark, d), t(spark, d, "supplier").where("s_suppkey % 50 = 0").selectExpr("s_suppkey AS protein"))


@query(f"SELECT x.protein, y.partner AS target, count(*) AS n_paths FROM {HH_BOTH} x JOIN {HH_BOTH} y ON x.partner = y.protein WHERE x.protein <> y.partner GROUP BY 1, 2")
def two_hop_all(spark, d):
    """two_hop over all pairs, every supplier being a seed."""
    return G.two_hop_of(partners(spark, d), t(spark, d, "supplier").selectExpr("s_suppkey AS protein"))


@query("""SELECT n_name AS virus, c_mktsegment AS protein, l_suppkey AS human, count(*) AS n_descriptions, count(DISTINCT l_orderkey) AS n_publications
FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE n_name LIKE '%A%' GROUP BY ALL""")
def virus_drilldown(spark, d):
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t(spark, d, "nation").where("n_name LIKE '%A%'"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_name").alias("virus"), F.col("c_mktsegment").alias("protein"), F.col("l_suppkey").alias("human")).agg(F.count("*").alias("n_descriptions"), F.countDistinct("l_orderkey").alias("n_publications"))


@query(f"SELECT r_name AS family, count(DISTINCT (a, b_nation, b_name)) AS n_interactions, count(DISTINCT a) AS n_hosts FROM {VH} JOIN nation ON b_nation = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def family_rollup(spark, d):
    """Distinct interactions and hosts of a family."""
    rows = vh_observations(spark, d).select("a", "b_nation", "b_name").distinct()
    rows = rows.join(F.broadcast(t(spark, d, "nation")), F.col("b_nation") == F.col("n_nationkey")).join(F.broadcast(t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy(F.col("r_name").alias("family")).agg(F.count("*").alias("n_interactions"), F.countDistinct("a").alias("n_hosts"))


@query(f"SELECT DISTINCT peptide, a AS source, b_nation, b_name FROM {VH}")
def peptide_from_binds(spark, d):
    """Every peptide with each protein it is from and each it binds."""
    return vh_observations(spark, d).selectExpr("peptide", "a AS source", "b_nation", "b_name").distinct()


@query("""SELECT publication, kind, count(*) AS n FROM (
SELECT l_orderkey AS publication, 'description' AS kind FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT l_orderkey, 'annotation' FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT o_orderkey, 'function text' FROM orders WHERE o_orderkey % 5 = 0) GROUP BY ALL""")
def publication_backs(spark, d):
    x = t(spark, d, "lineitem")
    rows = x.where("l_returnflag = 'R'").selectExpr("l_orderkey AS publication", "'description' AS kind").unionByName(x.where("l_linestatus = 'F'").selectExpr("l_orderkey AS publication", "'annotation' AS kind"))
    rows = rows.unionByName(t(spark, d, "orders").where("o_orderkey % 5 = 0").selectExpr("o_orderkey AS publication", "'function text' AS kind"))
    return rows.groupBy("publication", "kind").agg(F.count("*").alias("n"))


def stated_claims(obs: DataFrame) -> DataFrame:
    """Claims as an older build states them: without the observations of orders divisible by 1000, and those of hosts divisible by
    25 twice, so that the audit has something to find."""
    old = G.pair_counters(obs.where("publication % 1000 <> 0"), ["a", "b_nation", "b_name"])
    return old.unionByName(old.where("a % 25 = 0"))


STATED = f"""(SELECT a, b_nation, b_name, count(*) AS n, count(DISTINCT peptide) AS p FROM {VH} WHERE publication % 1000 <> 0 GROUP BY ALL)"""
RECOUNT = f"""(SELECT a, b_nation, b_name, count(*) AS n, count(DISTINCT peptide) AS p FROM {VH} GROUP BY ALL)"""


def checks(spark, d) -> list[V.Check]:
    line, orders, customer, part, supplier = (t(spark, d, x) for x in ("lineitem", "orders", "customer", "part", "supplier"))
    obs = vh_observations(spark, d)
    pairs = stated_claims(obs)
    order_key = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    recount = obs.groupBy("a", "b_nation", "b_name").agg(F.count("*").alias("n_descriptions"), F.countDistinct("peptide").alias("n_peptides"))
    return [
        V.Check("V0", "unique supplier", V.repeated(supplier, ["s_suppkey"])),
        V.Check("V0", "unique order line", V.repeated(line, ["l_orderkey", "l_linenumber"])),
        V.Check("S2", "order complete", V.incomplete(orders, ["o_orderkey", "o_custkey", "o_orderdate"])),
        V.Check("S3", "one sub-label", V.overlapping(line.where("l_returnflag = 'R'"), line.where("l_returnflag <> 'R'"), ["l_orderkey"])),
        V.Check("S4", "line's order exists", V.dangling(line, ["l_orderkey"], orders, ["o_orderkey"])),
        V.Check("S4", "order's customer exists", V.dangling(orders, ["o_custkey"], customer, ["c_custkey"])),
        V.Check("I1", "one interaction a pair", V.repeated(pairs, ["a", "b_nation", "b_name"])),
        V.Check("I4", "counters equal a recount", V.differing(pairs, recount, ["a", "b_nation", "b_name"], ["n_descriptions", "n_peptides"])),
        V.Check("I2", "order has 1 to 6 lines", V.wrong_degree(order_key, ["l_orderkey"], line, 1, 6)),
        V.Check("D3", "brand's form", part.where(~F.col("p_brand").rlike("^Brand#[1-5][1-5]$"))),
        V.Check("P1", "peptide length", part.where(f"length({PEPTIDE}) NOT BETWEEN 5 AND 20")),
        V.Check("B1", "order is cited", V.childless(orders, ["o_orderkey"], line, ["l_orderkey"])),
    ]


@query(f"""SELECT 'V0' AS invariant, 'unique supplier' AS name, count(*) AS n_broken FROM (SELECT 1 FROM supplier GROUP BY s_suppkey HAVING count(*) > 1) UNION ALL
SELECT 'V0', 'unique order line', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL
SELECT 'S2', 'order complete', count(*) FROM orders WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL UNION ALL
SELECT 'S3', 'one sub-label', count(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R') UNION ALL
SELECT 'S4', 'line''s order exists', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL
SELECT 'S4', 'order''s customer exists', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL
SELECT 'I1', 'one interaction a pair', count(*) FROM {STATED} WHERE a % 25 = 0 UNION ALL
SELECT 'I4', 'counters equal a recount', coalesce(sum(CASE WHEN a % 25 = 0 AND s_n IS NOT NULL THEN 2 ELSE 1 END), 0)::BIGINT FROM (
  SELECT r.a, s.n AS s_n, s.n IS NOT DISTINCT FROM r.n AND s.p IS NOT DISTINCT FROM r.p AS same FROM {RECOUNT} r LEFT JOIN {STATED} s USING (a, b_nation, b_name)) WHERE NOT same UNION ALL
SELECT 'I2', 'order has 1 to 6 lines', count(*) FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) WHERE n NOT BETWEEN 1 AND 6 UNION ALL
SELECT 'D3', 'brand''s form', count(*) FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[1-5][1-5]$') UNION ALL
SELECT 'P1', 'peptide length', count(*) FROM part WHERE length({PEPTIDE}) NOT BETWEEN 5 AND 20 UNION ALL
SELECT 'B1', 'order is cited', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def audit_report(spark, d):
    return V.tally(checks(spark, d))


@query("""SELECT k.key AS requested, CASE WHEN s.s_suppkey IS NOT NULL THEN 'known' WHEN n.s_suppkey IS NOT NULL THEN 'name' ELSE 'unknown' END AS status, n.s_suppkey AS hint
FROM (SELECT DISTINCT CASE WHEN l_suppkey % 3 = 0 THEN s_name WHEN l_suppkey % 3 = 1 THEN l_suppkey::VARCHAR ELSE (l_suppkey + 1000000)::VARCHAR END AS key FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) k
LEFT JOIN supplier s ON s.s_suppkey::VARCHAR = k.key LEFT JOIN supplier n ON n.s_name = k.key""")
def key_check(spark, d):
    s = t(spark, d, "supplier")
    keys = t(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr("CASE WHEN l_suppkey % 3 = 0 THEN s_name WHEN l_suppkey % 3 = 1 THEN CAST(l_suppkey AS STRING) ELSE CAST(l_suppkey + 1000000 AS STRING) END AS requested").distinct()
    return L.key_check(keys, s.selectExpr("CAST(s_suppkey AS STRING) AS key", "s_name AS name", "s_suppkey AS id"))


NAMED = "SELECT 'supplier' AS kind, s_suppkey::BIGINT AS key, s_name AS name FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name FROM customer UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation UNION ALL SELECT 'part', p_partkey, p_name FROM part"


@query(f"""WITH f AS (SELECT unnest(['9', 'an', 'Supplier#000000007', 'INDIA', '%']) AS fragment)
SELECT kind, key, name, fragment, lower(name) = lower(fragment) AS exact FROM ({NAMED}) JOIN f ON contains(lower(name), lower(fragment))""")
def name_search(spark, d):
    """Nodes of every kind by their name or a fragment of it."""
    named = None
    for kind, key, name in (("supplier", "s_suppkey", "s_name"), ("customer", "c_custkey", "c_name"), ("nation", "n_nationkey", "n_name"), ("part", "p_partkey", "p_name")):
        one = t(spark, d, kind).selectExpr(f"'{kind}' AS kind", f"CAST({key} AS LONG) AS key", f"{name} AS name")
        named = one if named is None else named.unionByName(one)
    return L.find_names(named, ["9", "an", "Supplier#000000007", "INDIA", "%"])


CITED = """SELECT l_orderkey AS pmid, CASE WHEN l_returnflag = 'R' THEN 'viral' ELSE 'host' END AS silo FROM lineitem UNION SELECT l_orderkey + 1, 'host' FROM lineitem WHERE l_linestatus = 'F'
UNION SELECT o_orderkey + 2, 'host' FROM orders WHERE o_orderkey % 5 = 0 UNION SELECT o_orderkey * 2, 'viral' FROM orders WHERE o_orderkey % 7 = 0"""


@query(CITED)
def cited_by_silo(spark, d):
    """Publications that each silo cites: of descriptions, annotations and both kinds of texts."""
    x, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    texts = lambda where, pmid: o.where(where).selectExpr(f"array({pmid}) AS pmids")
    rows = x.selectExpr("l_orderkey AS pmid", "if(l_returnflag = 'R', 'VH', 'HH') AS kind"), x.where("l_linestatus = 'F'").selectExpr("l_orderkey + 1 AS pmid")
    return A.cited_by_silo(*rows, texts("o_orderkey % 5 = 0", "o_orderkey + 2"), texts("o_orderkey % 7 = 0", "o_orderkey * 2"))


@query("""WITH q AS (SELECT DISTINCT p_brand AS taxon, lower(p_type) || 's' AS asked FROM part WHERE p_partkey % 50 = 0), n AS (SELECT DISTINCT p_brand AS taxon, p_type AS name FROM part),
s AS (SELECT q.taxon, asked, name, round(1 - levenshtein(asked, lower(name))::DOUBLE / greatest(length(asked), length(name)), 6) AS similarity FROM q JOIN n USING (taxon)),
r AS (SELECT *, row_number() OVER (PARTITION BY taxon, asked ORDER BY similarity DESC, name) AS rank FROM s WHERE similarity >= 0.6)
SELECT taxon, asked, name, similarity, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def near_names(spark, d):
    p = t(spark, d, "part")
    asked = p.where("p_partkey % 50 = 0").selectExpr("p_brand AS taxon", "lower(p_type) || 's' AS asked").distinct()
    return L.near_names(asked, p.selectExpr("p_brand AS taxon", "p_type AS name").distinct(), "taxon")


@query("SELECT c_nationkey AS ncbi_taxon_id, c_mktsegment AS name, c_custkey AS accession, n_name AS strain, length(c_name) AS length FROM customer JOIN nation ON c_nationkey = n_nationkey")
def site_lookup(spark, d):
    """The sites of every viral protein there is."""
    wanted = t(spark, d, "customer").selectExpr("c_nationkey AS ncbi_taxon_id", "c_mktsegment AS name").distinct()
    mature = t(spark, d, "customer").selectExpr("c_nationkey AS ncbi_taxon_id", "c_mktsegment AS name", "c_custkey AS accession", "length(c_name) AS length")
    entry = t(spark, d, "customer").join(F.broadcast(t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey AS accession", "n_name AS strain")
    return L.sites(wanted, mature, entry).select("ncbi_taxon_id", "name", "accession", "strain", "length")


@query("""SELECT i.id AS stable_id, c_custkey AS accession, c_name AS description
FROM (SELECT o_orderkey AS id FROM orders UNION SELECT -o_orderkey - 1 FROM orders) i LEFT JOIN orders ON o_orderkey = i.id LEFT JOIN customer ON o_custkey = c_custkey""")
def observed_lookup(spark, d):
    """All orders, and as many ids without an observation, against all observations."""
    o = t(spark, d, "orders").selectExpr("o_orderkey AS stable_id", "o_custkey AS accession")
    asked = o.select("stable_id").unionByName(o.selectExpr("-stable_id - 1 AS stable_id")).distinct()
    return L.observed(asked, o, t(spark, d, "customer").selectExpr("c_custkey AS accession", "c_name AS description"))


def document_index(spark, d):
    index = published(spark, "postings", paths(d, "documents"), lambda: L.postings(t(spark, d, "documents"), "doc_id", ["text"]), ["bucket"])
    return index, published(spark, "terms", paths(d, "documents"), lambda: L.term_counts(index), ["bucket"])


def page_index(spark, d):
    index = published(spark, "page-postings", paths(d, "pages"), lambda: L.postings(t(spark, d, "pages"), "page_id", ["url", "html"]), ["bucket"])
    return index, published(spark, "page-terms", paths(d, "pages"), lambda: L.term_counts(index), ["bucket"])


TERMS = ["the", "und", "que", "licensed"]


@query("""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM w WHERE term IN ('the', 'und', 'que', 'licensed') GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), n AS (SELECT count(*) AS n FROM documents)
SELECT doc_id, round(sum((1 + ln(tf)) * ln(1 + n / df)), 6) AS score FROM tf JOIN df USING (term), n GROUP BY doc_id""")
def text_search(spark, d):
    """Scores from the published postings of documents: their buckets of the terms are read, no text."""
    index, counts = document_index(spark, d)
    return L.search_postings(index, counts, t(spark, d, "documents").count(), "doc_id", TERMS, {"text": 1.0})


WORDS = ["http", "com", "data", "language"]


@query("""WITH f AS (SELECT page_id, 'url' AS field, 3.0::DOUBLE AS weight, url AS text FROM pages UNION ALL SELECT page_id, 'html', 1.0, html FROM pages),
w AS (SELECT page_id, field, weight, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS term FROM f),
tf AS (SELECT page_id, field, weight, term, count(*) AS tf FROM w WHERE term IN ('http', 'com', 'data', 'language') GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM tf GROUP BY ALL), n AS (SELECT count(*) AS n FROM pages)
SELECT page_id, round(sum(weight * (1 + ln(tf)) * ln(1 + n / df)), 6) AS score FROM tf JOIN df USING (field, term), n GROUP BY page_id""")
def title_search(spark, d):
    """Search over titles and bodies: of pages the address, at three times the weight, and the text."""
    index, counts = page_index(spark, d)
    return L.search_postings(index, counts, t(spark, d, "pages").count(), "page_id", WORDS, {"url": 3.0, "html": 1.0})


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '\s*\((?:PubMed|Ref\.)[^()]*\)', '', 'g'), '[\s\x1c-\x1f]+', ' ', 'g'))) AS digest FROM documents")
def text_clean(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(F.encode(without_citations(F.col("text")), "UTF-8")).alias("digest"))


@query("SELECT page_id, length(trim(regexp_replace(html, '[\\s\\x1c-\\x1f]+', ' ', 'g'))) AS length FROM pages")
def page_clean(spark, d):
    return t(spark, d, "pages").select("page_id", F.length(clean(F.col("html"))).cast("long").alias("length"))


SUMMARY = {"Protein": "supplier", "Publication": "orders", "Description": "lineitem", "Peptide": "part", "Virus": "nation", "Family": "region", "Viral protein": "customer"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS label, count(*) AS n FROM {v}" for k, v in SUMMARY.items()))
def graph_summary(spark, d):
    parts = [t(spark, d, v).agg(F.count("*").alias("n")).select(F.lit(k).alias("label"), "n") for k, v in SUMMARY.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


LANDED = """(SELECT l_quantity < 3 AS malformed, l_discount >= 0.09 AS negative, l_suppkey AS s, l_partkey % 100 AS p, l_partkey % 13 = 0 AS chemical, l_orderkey AS o, o_custkey, p_size, p_brand, l_linenumber, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
ARCHIVE = f"""m AS (SELECT *, CASE WHEN malformed THEN 'malformed' WHEN negative THEN 'negative' WHEN chemical THEN 'not two proteins' WHEN o % 11 = 0 THEN 'no publication'
    WHEN o % 11 = 1 THEN 'several publications' WHEN p_size % 10 < 2 THEN 'not one method' WHEN p_size % 10 = 2 THEN 'method not in the ontology' WHEN p_brand LIKE '%4' THEN 'unlisted'
    WHEN p_brand LIKE '%5' THEN 'method not kept: ' || p_brand || ' ' || lower(p_brand) WHEN l_linenumber = 1 THEN 'not one id' END AS reason FROM {LANDED}),
k AS (SELECT least('P' || s, 'P' || p) AS accession1, greatest('P' || s, 'P' || p) AS accession2, o::VARCHAR AS pmid, p_brand AS psimi_id, o::VARCHAR AS intact_id, s % 7 = 0 OR p % 7 = 0 AS strange,
    CASE WHEN o_custkey % 50 < 10 THEN 'g' || (o_custkey % 50) END AS grp, o FROM m WHERE reason IS NULL),
h AS (SELECT DISTINCT * FROM k WHERE NOT strange), w AS (SELECT *, min(o) OVER (PARTITION BY accession1, accession2, grp) AS low FROM h)"""


def landed(spark, d) -> DataFrame:
    """Lines as rows of an interaction archive, with every fault that it may have."""
    x = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return x.selectExpr(
        "concat('uniprotkb:P', l_suppkey, if(l_linenumber % 2 = 0, '-2', '')) AS id_a", "concat(if(l_partkey % 13 = 0, 'chebi:', 'uniprotkb:P'), l_partkey % 100) AS id_b",
        "CASE WHEN p_size % 10 = 0 THEN array() WHEN p_size % 10 = 1 THEN array(p_brand, 'other') WHEN p_size % 10 = 2 THEN array('unknown') ELSE array(p_brand) END AS methods",
        "transform(CASE WHEN l_orderkey % 11 = 0 THEN array() WHEN l_orderkey % 11 = 1 THEN array(l_orderkey, l_orderkey + 1) ELSE array(l_orderkey) END, x -> cast(x AS STRING)) AS pmids",
        "if(l_linenumber = 1, array(), array(cast(l_orderkey AS STRING))) AS ids", "l_discount >= 0.09 AS negative", "l_quantity < 3 AS malformed",
    )


def archive(spark, d):
    part, orders = t(spark, d, "part"), t(spark, d, "orders")
    brands = part.selectExpr("p_brand AS declared", "p_brand AS method_id").distinct()
    kept = part.selectExpr("p_brand AS id", "lower(p_brand) AS name", "p_brand NOT LIKE '%5' AS keep").where("id NOT LIKE '%4'").distinct()
    ids = t(spark, d, "supplier").selectExpr("s_suppkey AS n").unionByName(part.selectExpr("p_partkey % 100 AS n"))
    groups = orders.where("o_custkey % 50 < 10").selectExpr("concat('g', o_custkey % 50) AS `group`", "cast(o_orderkey AS STRING) AS pmid")
    return R.filter_interactions(landed(spark, d), brands, kept, ids.where("n % 7 <> 0").selectExpr("concat('P', n) AS accession").distinct(), groups)


@query(f"WITH {ARCHIVE} SELECT accession1, accession2, pmid, psimi_id, intact_id FROM w WHERE grp IS NULL OR o = low")
def archive_kept(spark, d):
    """The archive's rows after the cascade, the hosts' semi-join and the first publication of each group."""
    return archive(spark, d)[0].select("accession1", "accession2", "pmid", "psimi_id", "intact_id")


@query(f"""WITH {ARCHIVE} SELECT reason AS drop_reason, count(*) AS n FROM m WHERE reason IS NOT NULL AND reason <> 'unlisted' GROUP BY 1 UNION ALL SELECT 'not a protein of the host', count(*) FROM k WHERE strange HAVING count(*) > 0
UNION ALL SELECT 'repeated in group ' || grp || ': ' || pmid, count(*) FROM w WHERE grp IS NOT NULL AND o <> low GROUP BY ALL""")
def archive_dropped(spark, d):
    """Why the archive's other rows were dropped."""
    return archive(spark, d)[1]


@query(f"WITH {ARCHIVE} SELECT p_brand AS psimi_id, count(*) AS n FROM m WHERE reason = 'unlisted' GROUP BY 1")
def archive_unlisted(spark, d):
    """Methods that the archive uses and the list of kept ones doesn't have."""
    return archive(spark, d)[2]


NOTED = f"""n AS (SELECT *, 'T' || CASE WHEN p % 9 = 0 THEN p + 1000 ELSE p END AS term, CASE WHEN malformed THEN 'malformed' WHEN p_size % 4 = 0 THEN 'not experimental' WHEN o % 11 = 0 THEN 'no publication' END AS reason FROM {LANDED}),
e AS (SELECT * , o AS pmid FROM n WHERE reason IS NULL UNION ALL SELECT *, o + 1 FROM n WHERE reason IS NULL AND o % 11 = 1),
j AS (SELECT *, CASE WHEN p % 10 = 3 AND p % 9 <> 0 THEN 'term not in the ontology' WHEN p % 10 = 4 THEN 'left out: binding' WHEN s % 7 = 0 THEN 'not a protein of the host' END AS late FROM e)"""


def noted(spark, d):
    x = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = x.selectExpr(
        "concat('P', l_suppkey) AS accession", "l_returnflag AS qualifier", "concat('T', if(l_partkey % 100 % 9 = 0, l_partkey % 100 + 1000, l_partkey % 100)) AS go_id",
        "concat('E', p_size % 4) AS evidence_code", "l_linestatus AS assigned_by", "l_quantity < 3 AS malformed",
        "transform(CASE WHEN l_orderkey % 11 = 0 THEN array() WHEN l_orderkey % 11 = 1 THEN array(l_orderkey, l_orderkey + 1) ELSE array(l_orderkey) END, x -> cast(x AS STRING)) AS pmids",
    )
    numbers = t(spark, d, "part").selectExpr("p_partkey % 100 AS n").distinct()
    terms = numbers.where("n % 10 <> 3 OR n % 9 = 0").selectExpr("concat('T', n) AS id")
    aliases = numbers.where("n % 9 = 0").selectExpr("concat('T', n + 1000) AS alias", "explode(array(concat('T', n), concat('Z', n))) AS id")
    left_out = numbers.where("n % 10 = 4").selectExpr("concat('T', n) AS id", "'binding' AS reason")
    hosts = t(spark, d, "supplier").where("s_suppkey % 7 <> 0").selectExpr("concat('P', s_suppkey) AS accession")
    return R.filter_annotations(rows, ("E1", "E2", "E3"), terms, aliases, left_out, hosts)


@query(f"WITH {NOTED} SELECT DISTINCT 'P' || s AS accession, 'T' || p AS go_id, l_returnflag AS qualifier, 'E' || (p_size % 4) AS evidence_code, l_linestatus AS assigned_by, pmid::VARCHAR AS pmid FROM j WHERE late IS NULL")
def annotations_kept(spark, d):
    """The annotation archive's rows, one a publication, after the cascade, aliases, exclusion and the hosts' semi-join."""
    return noted(spark, d)[0]


@query(f"WITH {NOTED} SELECT reason AS drop_reason, count(*) AS n FROM n WHERE reason IS NOT NULL GROUP BY 1 UNION ALL SELECT late, count(*) FROM j WHERE late IS NOT NULL GROUP BY 1")
def annotations_dropped(spark, d):
    return noted(spark, d)[1]


@query("""WITH x AS (SELECT l_orderkey AS publication, l_suppkey AS a, l_partkey AS b, l_returnflag = 'R' AS curated FROM lineitem), c AS (SELECT DISTINCT publication FROM x WHERE curated), r AS (SELECT DISTINCT publication, a, b FROM x WHERE NOT curated)
SELECT (SELECT count(*) FROM x WHERE curated) AS curated, count(*) FILTER (publication NOT IN (SELECT * FROM c)) AS archive, count(*) FILTER (publication IN (SELECT * FROM c)) AS archive_dropped FROM r""")
def overlap_summary(spark, d):
    """How curated and archive rows overlap."""
    x = t(spark, d, "lineitem").selectExpr("l_orderkey AS publication", "l_suppkey AS a", "l_partkey AS b", "l_returnflag")
    return R.overlap(x.where("l_returnflag = 'R'"), x.where("l_returnflag <> 'R'"), "publication", ["publication", "a", "b"])


@query("""WITH l AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 17 = 0 THEN 'old ' || p_name ELSE p_name END AS name FROM part WHERE p_partkey % 5 <> 0 UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey % 41 = 1 AND p_partkey % 5 <> 0 UNION ALL SELECT -p_partkey - 1, 'none' FROM part WHERE p_size = 1)
SELECT CASE WHEN p_partkey IS NULL THEN 'no current term' WHEN p_partkey % 19 = 0 THEN 'not a detection method' ELSE 'renamed' END AS finding, id, name FROM l LEFT JOIN part ON p_partkey = id WHERE p_partkey IS NULL OR p_partkey % 19 = 0 OR name <> p_name
UNION ALL SELECT 'listed twice', id, min(name) FROM l GROUP BY id HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'used but not listed', p_partkey, p_name FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_partkey NOT IN (SELECT id FROM l)""")
def method_findings(spark, d):
    """What is wrong with a list of parts that stand for methods."""
    part = t(spark, d, "part")
    listed = part.where("p_partkey % 5 <> 0").selectExpr("p_partkey AS id", "if(p_partkey % 17 = 0, concat('old ', p_name), p_name) AS name")
    listed = listed.unionByName(part.where("p_partkey % 41 = 1 AND p_partkey % 5 <> 0").selectExpr("p_partkey AS id", "p_name AS name")).unionByName(part.where("p_size = 1").selectExpr("-p_partkey - 1 AS id", "'none' AS name"))
    return R.method_findings(listed, part.selectExpr("p_partkey AS id", "p_name AS name"), part.where("p_partkey % 19 <> 0").selectExpr("p_partkey AS id"), t(spark, d, "lineitem").selectExpr("l_partkey AS id"))


SAID = "(SELECT *, CASE c WHEN 0 THEN 'head' WHEN 1 THEN 'body' ELSE 'tail' END AS name, 'chain ' || c || ' of ' || entry AS said FROM " + CHAINS + ")"


@query("WITH x AS (" + ORACLE_SQL["interval_best_match"] + f"""), b AS (SELECT x.entry, start, stop, kind, string_agg(CASE WHEN kind = 'best' THEN said ELSE '[' || name || ']: ' || said END, ' ' ORDER BY c) AS told
  FROM x LEFT JOIN {SAID} k ON x.entry = k.entry AND list_contains(string_split(chains, ','), c::VARCHAR) GROUP BY ALL)
SELECT entry, start, stop, kind, CASE WHEN kind = 'entry' THEN 'whole of ' || entry ELSE coalesce(told, '') END AS text FROM b""")
def interval_texts(spark, d):
    """The texts that describe spans: of their best chain, their entry, or all chains they overlap under their names."""
    o = t(spark, d, "orders")
    chains = o.where("o_orderkey % 3 <> 0").selectExpr("o_orderkey AS entry", "explode(array(0, 1, 2)) AS c")
    texts = chains.selectExpr("entry", "c", "CASE c WHEN 0 THEN 'head' WHEN 1 THEN 'body' ELSE 'tail' END AS name", "concat('chain ', c, ' of ', entry) AS text")
    return M.interval_texts(interval_best_match(spark, d), texts, o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS entry", "concat('whole of ', o_orderkey) AS text"))


@query("""SELECT min(l_orderkey * 10 + l_linenumber) AS position, l_partkey AS accession, length(max(p_name)) AS length, max(p_name) AS sequence, CASE WHEN max(p_name) IS NULL THEN 'no protein ' || l_partkey END AS error
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size > 5 GROUP BY l_partkey""")
def host_sequences(spark, d):
    """Sequences in the order they are first asked for, and errors of those that are unknown."""
    asked = t(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS position", "l_partkey AS accession")
    return L.host_sequences(asked, t(spark, d, "part").where("p_size > 5").selectExpr("p_partkey AS accession", "p_name AS sequence"))


@query("""WITH w AS (SELECT DISTINCT c_nationkey AS ncbi_taxon_id, unnest([c_mktsegment, 'nothing']) AS name FROM customer), m AS (SELECT c_nationkey AS ncbi_taxon_id, c_mktsegment AS name, c_custkey AS accession, c_custkey % 7 AS start, c_custkey % 7 + 9 AS stop, c_name AS sequence FROM customer)
SELECT ncbi_taxon_id, name, CAST(row_number() OVER (PARTITION BY ncbi_taxon_id, name ORDER BY accession, start, stop) AS INTEGER) AS place, accession, n_name AS strain, CASE WHEN accession IS NOT NULL THEN 'r' || (accession % 3) END AS release, start, stop, length(sequence) AS length, sequence,
  CASE WHEN accession IS NULL THEN 'no protein ' || name END AS error FROM w LEFT JOIN m USING (ncbi_taxon_id, name) LEFT JOIN nation ON n_nationkey = ncbi_taxon_id AND accession IS NOT NULL""")
def viral_sites(spark, d):
    """Sites of viral proteins in order, with span and residues."""
    nation, customer = t(spark, d, "nation"), t(spark, d, "customer")
    mature = customer.selectExpr("c_nationkey AS ncbi_taxon_id", "c_mktsegment AS name", "c_custkey AS accession", "c_custkey % 7 AS start", "c_custkey % 7 + 9 AS stop", "c_name AS sequence")
    entries = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey AS accession", "n_name AS strain", "concat('r', c_custkey % 3) AS release")
    return L.viral_sites(customer.selectExpr("c_nationkey AS ncbi_taxon_id", "explode(array(c_mktsegment, 'nothing')) AS name").distinct(), mature, entries)


@query("""WITH i AS (SELECT o_orderkey AS id FROM orders UNION SELECT -o_orderkey - 1 FROM orders),
x AS (SELECT id, o_custkey, c_nationkey, c_custkey, CASE WHEN o_custkey IS NULL THEN 'no such description' WHEN o_orderkey % 4 = 0 THEN 'not a description of a viral protein' WHEN o_orderkey % 4 = 1 THEN 'no observed protein' WHEN c_custkey % 6 = 0 THEN 'several places in the entry' END AS error
  FROM i LEFT JOIN orders ON o_orderkey = id LEFT JOIN customer ON c_custkey = o_custkey)
SELECT id AS stable_id, CASE WHEN error IS NULL THEN c_custkey END AS accession, CASE WHEN error IS NULL THEN n_name END AS strain, CASE WHEN error IS NULL THEN 'r' || (c_custkey % 3) END AS release,
  CASE WHEN error IS NULL THEN c_custkey % 7 END AS start, CASE WHEN error IS NULL THEN c_custkey % 7 + 9 END AS stop, error FROM x LEFT JOIN nation ON n_nationkey = c_nationkey""")
def observed_proteins(spark, d):
    """The viral protein that each description observed, or why there is none."""
    o, customer, nation = t(spark, d, "orders"), t(spark, d, "customer"), t(spark, d, "nation")
    asked = o.selectExpr("explode(array(o_orderkey, -o_orderkey - 1)) AS stable_id")
    placed = o.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    described = placed.selectExpr("o_orderkey AS stable_id", "if(o_orderkey % 4 = 0, 'HH', 'VH') AS kind", "c_nationkey AS ncbi_taxon_id", "c_mktsegment AS name")
    seen = placed.where("o_orderkey % 4 <> 1").selectExpr("o_orderkey AS stable_id", "c_custkey AS accession")
    mature = customer.selectExpr("c_nationkey AS ncbi_taxon_id", "c_mktsegment AS name", "c_custkey AS accession", "explode(if(c_custkey % 6 = 0, array(0, 50), array(0))) AS more").selectExpr("ncbi_taxon_id", "name", "accession", "accession % 7 + more AS start", "accession % 7 + 9 + more AS stop")
    entries = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("c_custkey AS accession", "n_name AS strain", "concat('r', c_custkey % 3) AS release")
    return L.observed_proteins(asked, described, seen, mature, entries)
