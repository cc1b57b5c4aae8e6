"""Traps of the operators on small hand-made frames."""

import json

import pytest
from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.operators import archive as A
from evidra.operators import audit as V
from evidra.operators import closure as C
from evidra.operators import graph as G
from evidra.operators import merge as M
from evidra.sources import readers as R


def test_closure_over_a_diamond_with_merges_and_cycles(spark):
    e = spark.createDataFrame([(4, 2), (4, 3), (2, 1), (3, 1), (9, 8)], "child long, parent long")
    assert {r.id for r in C.ancestors(spark.createDataFrame([(4,)], "id long"), e).collect()} == {4, 3, 2, 1}
    assert {r.id for r in C.descendants(spark.createDataFrame([(1,)], "id long"), e).collect()} == {1, 2, 3, 4}
    merged = spark.createDataFrame([(k, k - 1) for k in range(1, 9)] + [(20, 21), (21, 20)], "old_id long, new_id long")
    ids = spark.createDataFrame([(0,), (7,), (8,), (20,), (99,)], "id long")
    got = {r.id: r.resolved for r in C.resolve_merges(ids, merged, spark.createDataFrame([(0,)], "id long")).collect()}
    assert got == {0: 0, 7: 0, 8: None, 20: None, 99: None}


def test_lineage_of_a_self_parent_root_and_nearest_rank(spark):
    p = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 1)], "id long, parent long")
    lines = C.lineage(p, p)
    assert sorted((r.id, r.ancestor, r.depth) for r in lines.where("id = 3").collect()) == [(3, 1, 2), (3, 2, 1), (3, 3, 0)]
    got = {r.id: r.nearest for r in C.nearest_of_rank(lines, spark.createDataFrame([(2,)], "id long")).collect()}
    assert got == {2: 2, 3: 2}


def test_precedence_group_and_reasons(spark):
    cur = spark.createDataFrame([(1, "a"), (1, "a")], "pmid long, pair string")
    arc = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "pmid long, pair string")
    assert sorted(tuple(r) for r in M.precedence(cur, arc, "pmid", ["pmid", "pair"]).collect()) == [(1, "a", "curated"), (1, "a", "curated"), (2, "c", "archive")]
    rows = spark.createDataFrame([("p", 1, 9, "m"), ("p", 1, 10, "m"), ("p", 1, 9, "n"), ("p", None, 11, "m")], "pair string, grp int, pmid long, method string")
    assert M.first_of_group(rows, ["pair"], "grp", "pmid").count() == 3
    texts = M.first_of_group(rows.withColumn("pmid", F.col("pmid").cast("string")), ["pair"], "grp", "pmid")
    assert sorted(r.pmid for r in texts.collect()) == ["11", "9", "9"]  # by number: as text, 10 would be lower than 9
    kept, dropped = M.with_reasons(rows, [("low", F.col("pmid") < 10), ("grouped", F.col("grp").isNotNull())])
    assert kept.count() == 1 and [tuple(r) for r in dropped.collect()] == [("low", 2), ("grouped", 1)]


def test_interval_ties_and_absent_chains(spark):
    s = spark.createDataFrame([(1, 1, 100), (2, 50, 149), (3, 1, 10), (4, 1, 10), (4, 20, 30)], "entry long, start long, stop long")
    c = spark.createDataFrame([(1, 0, 1, 100), (1, 1, 1, 100), (2, 0, 1, 100), (2, 1, 101, 200)], "entry long, c int, c_start long, c_stop long")
    got = {(r.entry, r.start): (r.kind, r.chains) for r in M.interval_best_match(s, c, spark.createDataFrame([(3,), (4,)], "entry long")).collect()}
    assert got == {(1, 1): ("best", "0"), (2, 50): ("overlaps", "0,1"), (3, 1): ("entry", ""), (4, 1): ("nothing", ""), (4, 20): ("nothing", "")}


def test_homodimer_once_and_never_its_own_partner(spark):
    p = spark.createDataFrame([(1, 1, 5), (1, 2, 3)], "a long, b long, n long")
    assert sorted((r.protein, r.partner) for r in G.both_ways(p).collect()) == [(1, 1), (1, 2), (2, 1)]
    assert [(r.protein, r.partner) for r in G.top_partners(p, "n", 5).orderBy("protein").collect()] == [(1, 2), (2, 1)]


def test_each_audit_rule_fires_alone(spark):
    nodes = spark.createDataFrame([(1, "x"), (2, "y")], "k long, name string")
    edges = spark.createDataFrame([(1,), (2,)], "k long")
    fine = dict(unique=V.repeated(nodes, ["k"]), full=V.incomplete(nodes, ["name"]), ends=V.dangling(edges, ["k"], nodes, ["k"]), degree=V.wrong_degree(nodes, ["k"], edges, 1, 1), used=V.childless(nodes, ["k"], edges, ["k"]))
    V.gate([V.Check("X", n, b) for n, b in fine.items()])
    broken = dict(
        unique=V.repeated(nodes.unionByName(nodes.limit(1)), ["k"]), full=V.incomplete(nodes.withColumn("name", F.lit(None).cast("string")), ["name"]),
        ends=V.dangling(spark.createDataFrame([(3,)], "k long"), ["k"], nodes, ["k"]), degree=V.wrong_degree(nodes, ["k"], edges.limit(1), 1, 1), used=V.childless(nodes, ["k"], edges.limit(1), ["k"]))
    for name, b in broken.items():
        with pytest.raises(V.BrokenRules, match=name):
            V.gate([V.Check("X", n, fine[n] if n != name else b) for n in fine])
    assert V.misshapen(nodes, edges.schema) == ["name"]


def test_publish_leaves_old_views_when_a_rule_breaks(spark, tmp_path):
    good, bad = spark.range(3), spark.range(3).unionByName(spark.range(1))
    rule = lambda read: [V.Check("V0", "unique", V.repeated(read["things"], ["id"]))]
    V.publish(spark, {"things": good}, str(tmp_path), rule)
    with pytest.raises(V.BrokenRules):
        V.publish(spark, {"things": bad}, str(tmp_path), rule)
    assert spark.sql("SELECT count(*) FROM things").first()[0] == 3


def test_another_session_reads_what_was_published_last(spark, tmp_path):
    for n in (2, 4):
        V.publish(spark, {"things": spark.range(n), "more": spark.range(1)}, str(tmp_path))
    other = spark.newSession()
    assert V.opened(other, str(tmp_path))["things"].count() == 4 and other.sql("SELECT count(*) FROM things").first()[0] == 4


def test_annotation_archive_and_lists(spark, tmp_path):
    cells = lambda *x: "\t".join(dict(x).get(i, "") for i in range(17))
    line = cells((1, "P1"), (3, "NOT|enables"), (4, "T:9"), (5, "PMID:1|PMID:2|PMID:1|DOI:3"), (6, "IDA"), (14, "X"))
    (tmp_path / "a.gaf").write_text("!comment\n" + line + "\nshort\tline\n")
    rows = R.read_annotations(spark, str(tmp_path / "a.gaf"))
    assert [(r.accession, r.qualifier, r.go_id, r.evidence_code, r.assigned_by, r.pmids) for r in rows.where("NOT malformed").collect()] == [("P1", "NOT|enables", "T:9", "IDA", "X", ["1", "2"])]
    one = lambda v, c: spark.createDataFrame(v, c)
    kept, counts = A.filter_annotations(rows, ("IDA",), one([("T:2",), ("T:1",)], "id string"), one([("T:9", "T:2"), ("T:9", "T:1")], "alias string, id string"), one([("T:2", "r")], "id string, reason string"), one([("P1",)], "accession string"))
    assert sorted((r.go_id, r.pmid) for r in kept.collect()) == [("T:1", "1"), ("T:1", "2")] and [tuple(r) for r in counts.collect()] == [("malformed", 1)]
    (tmp_path / "m.tsv").write_text("psimi_id\tname\tkeep\nM:1\tone\tyes\nM:2\ttwo\tno\nM:3\tthree\tmaybe\n")
    listed, wrong = R.read_methods(spark, str(tmp_path / "m.tsv"))
    assert sorted(tuple(r) for r in listed.collect()) == [("M:1", "one", True), ("M:2", "two", False)] and [r.id for r in wrong.collect()] == ["M:3"]
    (tmp_path / "g.tsv").write_text("group\tpmid\tnote\na\t1\t\na\t2\t\nb\t3\t\na\t1\t\n")
    assert sorted(tuple(r) for r in A.group_findings(R.read_groups(spark, str(tmp_path / "g.tsv"))).collect()) == [("group of one", "b"), ("publication twice", "1")]
    silos = [one([("1", "t", 1999)], "pmid string, title string, year long")]
    got = M.with_empty(M.by_rank(one([("1",), ("2",)], "pmid string"), silos, "pmid"), "pmid")
    assert sorted((r.pmid, r.title, r.year) for r in got.collect()) == [("1", "t", 1999), ("2", "", 0)]


def test_text_expressions(spark):
    row = spark.createDataFrame([(" a b\x1c\n c ", "Binds X (PubMed:1, PubMed:2) well (Ref.3).", " x; ;y ", "pubmed:1|doi:2|pubmed:3", "P1-2", "c. 1999 Jan")], "a string, b string, c string, d string, e string, f string")
    got = row.select(X.clean(F.col("a")), X.without_citations(F.col("b")), X.listed(F.col("c")), X.tagged(F.col("d"), "pubmed:"), X.canonical(F.col("e")), X.first_year([F.lit("none"), F.col("f")])).first()
    assert list(got) == ["a b c", "Binds X well.", ["x", "y"], ["1", "3"], "P1", 1999]


def test_readers(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("﻿b\ta\r\n 1 \tNULL\r\n\r\n2\t\n\"q\t\\N\nx\n".encode())
    rows, errors = R.read_tsv(spark, str(tmp_path / "a.tsv"), ["a", "b"])
    assert [tuple(r) for r in rows.collect()] == [("NULL", "1"), ("", "2"), ("\\N", '"q')] and [r.row for r in errors.collect()] == ["x"]
    (tmp_path / "o.obo").write_text("format: 1\n\n[Term]\nid: T:1\nname: one\nnamespace: n\nalt_id: T:9\n\n[Term]\nid: T:2\nname: two\nis_a: T:1 ! one\nrelationship: part_of T:3 ! x\nrelationship: regulates T:4\nis_obsolete: true\n\n[Typedef]\nid: part_of\n")
    terms, aliases, edges = R.read_ontology(spark, str(tmp_path / "o.obo"))
    assert {(r.id, r.name, r.obsolete) for r in terms.collect()} == {("T:1", "one", False), ("T:2", "two", True)}
    assert [tuple(r) for r in aliases.collect()] == [("T:9", "T:1")] and {tuple(r) for r in edges.collect()} == {("T:2", "T:1", "IS_A"), ("T:2", "T:3", "PART_OF")}
    for name, text in (("nodes", "1\t|\t1\t|\tno rank\t|\n9\t|\t1\t|\tfamily\t|\n"), ("names", "9\t|\tF\t|\t\t|\tscientific name\t|\n9\t|\tG\t|\t\t|\tsynonym\t|\n"), ("merged", "8\t|\t9\t|\n")):
        (tmp_path / name).write_text(text)
    taxa, merged = R.read_taxonomy(spark, *(str(tmp_path / n) for n in ("nodes", "names", "merged")))
    assert {tuple(r) for r in taxa.collect()} == {(1, 1, "no rank", None), (9, 1, "family", "F")} and [tuple(r) for r in merged.collect()] == [(8, 9)]
    (tmp_path / "p.xml").write_text("<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>A <i>b</i> c</ArticleTitle><Journal><Title>J</Title><PubDate><MedlineDate>1998 Jan</MedlineDate></PubDate></Journal></Article></MedlineCitation></PubmedArticle></Set>")
    assert [tuple(r) for r in R.read_publications(spark, str(tmp_path / "p.xml")).collect()] == [("7", "A b c", 1998, "J", [], "")]
    entry = {"primaryAccession": "P1", "entryType": "UniProtKB reviewed (Swiss-Prot)", "comments": [{"commentType": "FUNCTION", "texts": [{"value": "Does.", "evidences": [{"source": "PubMed", "id": "5"}, {"source": "PubMed", "id": "x"}]}]}]}
    (tmp_path / "e.json").write_text(json.dumps({"results": [entry, entry | {"entryType": "UniProtKB unreviewed (TrEMBL)"}]}))
    assert [tuple(r) for r in R.read_entries(spark, str(tmp_path / "e.json")).collect()] == [("P1", "", "Does.", ["5"])]


def test_authors_sections_and_books(spark, tmp_path):
    article = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>8</PMID><DateCompleted><Year>2001</Year></DateCompleted><Article><Journal><Title>J &amp; K</Title></Journal>
      <ArticleTitle>On <i>x</i>
      y</ArticleTitle><Abstract><AbstractText Label="AIM">To <b>see</b>.</AbstractText><AbstractText/><AbstractText>It is.</AbstractText></Abstract>
      <AuthorList><Author><LastName>Roe</LastName><Initials>J</Initials></Author><Author><CollectiveName>The Group</CollectiveName></Author><Author><LastName>Solo</LastName></Author></AuthorList>
      </Article><OtherAbstract><AbstractText>Other.</AbstractText></OtherAbstract></MedlineCitation></PubmedArticle>"""
    book = """<PubmedBookArticle><BookDocument><PMID>9</PMID><Book><Publisher><PublisherName>Press</PublisherName></Publisher><BookTitle>Book</BookTitle><PubDate><Year>2010</Year></PubDate>
      <AuthorList><Author><LastName>Editor</LastName></Author></AuthorList></Book><AuthorList><Author><LastName>Own</LastName><Initials>A B</Initials></Author></AuthorList></BookDocument></PubmedBookArticle>
      <PubmedArticle><MedlineCitation><PMID>10</PMID></MedlineCitation></PubmedArticle></PubmedArticleSet>"""
    (tmp_path / "p.xml").write_text(article + book)
    got = [tuple(r) for r in R.read_publications(spark, str(tmp_path / "p.xml")).orderBy("pmid").collect()]
    assert got == [("8", "On x y", 2001, "J & K", ["Roe J", "The Group", "Solo"], "AIM: To see. It is."), ("9", "Book", 2010, "Press", ["Own A B"], "")]


def test_chains_and_scoped_texts(spark, tmp_path):
    said = lambda value, *ids: {"value": value, "evidences": [{"source": "PubMed", "id": i} for i in ids]}
    chain = lambda name, a, b: {"type": "Chain", "description": name, "location": {"start": {"value": a}, "end": {"value": b}}}
    comments = [
        {"commentType": "FUNCTION", "texts": [said("Whole (PubMed:1).", "2", "1"), said("(PubMed:3)", "3")]},
        {"commentType": "FUNCTION", "molecule": "M", "texts": [said("Cuts.", "4"), {"value": "Binds."}]},
        {"commentType": "FUNCTION", "molecule": "Isoform 2", "texts": [said("Shorter.", "2")]},
        {"commentType": "FUNCTION", "molecule": "N", "texts": [said("Lost.")]},
        {"commentType": "SUBUNIT", "texts": [said("Dimer.")]},
    ]
    entry = {"primaryAccession": "P1", "entryType": "UniProtKB reviewed (Swiss-Prot)", "comments": comments, "features": [chain("M", 1, 9), chain("M", 20, 29), chain("N", None, 5)]}
    bare = {"primaryAccession": "P2", "entryType": "UniProtKB reviewed (Swiss-Prot)"}
    (tmp_path / "e.json").write_text(json.dumps({"results": [entry, bare, entry | {"primaryAccession": "P3", "entryType": "UniProtKB unreviewed (TrEMBL)"}]}))
    whole, chains = R.read_scoped_functions(spark, str(tmp_path / "e.json"))
    assert [tuple(r) for r in whole.orderBy("comment", "place").collect()] == [
        ("P1", 0, 0, "Whole.", ["2", "1"]), ("P1", 2, 0, "[Isoform 2]: Shorter.", ["2"]), ("P1", 3, 0, "[N]: Lost.", []),
    ]
    assert [tuple(r)[3:] for r in chains.orderBy("place", "start").collect()] == [("M", a, b, f, p) for f, p in (("Cuts.", ["4"]), ("Binds.", [])) for a, b in ((1, 9), (20, 29))]
    hosts = R.read_host_functions(spark, str(tmp_path / "e.json")).collect()
    assert [tuple(r) for r in hosts] == [("P1", "Whole. [M]: Cuts. Binds. [Isoform 2]: Shorter. [N]: Lost.", ["2", "1", "3", "4"])]
