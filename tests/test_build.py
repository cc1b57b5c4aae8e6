"""A small build from end to end, its audit, and builds that must fail."""

import pytest
from pyspark.sql import functions as F

from evidra.operators import audit as V
from evidra.operators import store as K
from evidra.plans import build as B
from evidra.sources import export as X

HH = "stable_id\tversion\tpmid\tpsimi_id\taccession1\taccession2\n"
VH = "pmid\tstable_id\tpsimi_id\taccession1\taccession2\tstart2\tstop2\trelease2\tprotein\tspecies_ncbi_taxon_id\tspecies\tstrain_ncbi_taxon_id\tstrain\n"
FILES = {
    "descriptions_hh_1": HH + "E1\t1\t10\tMI:0001\tP1\tP1\nE2\t1\t10\tMI:0099\tP3\tP2\nE3\t1\t10\tMI:0001\tP3\tP2\n",
    "descriptions_vh_1": VH + "12\tE4\tMI:0002\tP1\tV1\t1\t6\t2020_01\tE6\t101\tvirus one\t1010\tstrain A\n13\tE5\tMI:0002\tP2\tV2\t2\t5\t2020_01\te6\t102\tvirus two\t102\t\n",
    "interactors_human_1": "accession\trelease\tgene_name\tuniprot_name\tsequence\n" + "".join(f"P{i}\t2020_01\t{'N/A' if i == 3 else f'G{i}'}\tprotein {i}\tmkv\n" for i in range(1, 5)),
    "interactors_viral_1": "accession\tstart\tstop\trelease\tuniprot_name\tsequence\nV1\t1\t6\t2020_01\tentry one\tMKVLAA\nV2\t2\t5\t2020_01\tentry two\tmkvl\n",
    "mappings_h_1": "stable_id\tsequence\taccession\ttarget\nE1\tmkvla\tP1\th\nE1\tAAAA\tP9\tx\nE4\tMKVLAAAAAA\tP1\tv\nE2\t" + "A" * 21 + "\tP9\th\n",
    "mappings_v_1": "stable_id\tsequence\taccession\tstart\tstop\nE4\tMKVLAA\tV1\t1\t6\nE4\tMKVLAA\tV1\t1\t6\n",
}


def put(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.tsv").write_text("﻿" + text if name == "descriptions_hh_1" else text, encoding="utf-8")
    return str(folder)


@pytest.fixture()
def given(spark):
    df = spark.createDataFrame
    return B.Prepared(
        methods=df([("MI:0001", "one"), ("MI:0002", "two")], "id string, name string"),
        method_aliases=df([("MI:0099", "MI:0002"), ("MI:0001", "MI:0002")], "alias string, id string"),
        host_functions=df([("P1", "binds", ["20", "10"])], "accession string, function string, pmids array<string>"),
        viral_functions=df([("V1", 1, 6, "enters", ["21"])], "accession string, start long, stop long, function string, pmids array<string>"),
        archive=df([("P2", "P1", "10", "MI:0001"), ("P4", "P1", "12", "MI:0001"), ("P1", "P4", "12", "MI:0001")], "accession1 string, accession2 string, pmid string, psimi_id string"),
        annotations=df([("P1", "T3", "", c, "30") for c in ("IPI", "IDA", "IDA")] + [("P9", "T9", "", "IDA", "31")], "accession string, go_id string, qualifier string, evidence_code string, pmid string"),
        terms=df([(f"T{i}", f"term {i}", "P", i == 9) for i in (0, 1, 2, 3, 9)], "id string, name string, namespace string, obsolete boolean"),
        term_edges=df([("T3", "T1", "IS_A"), ("T3", "T2", "PART_OF"), ("T1", "T0", "IS_A"), ("T2", "T0", "IS_A")], "child string, parent string, relation string"),
        publications=[df([(p, f"{s} {p}", 0) for p in ps], "pmid string, title string, year long") for s, ps in (("host", ["10", "12", "20", "30"]), ("viral", ["12", "13", "21"]))],
        taxa=df([(1, 1, "no rank", "root"), (5, 1, "family", "family five"), (100, 5, "species", "virus one"), (102, 1, "species", "virus two")], "tax_id long, parent_id long, rank string, name string"),
        merged=df([(101, 100)], "old_id long, new_id long"),
    )


def test_a_build_from_end_to_end(spark, given, tmp_path):
    run, report = B.build(spark, put(tmp_path / "export", FILES), given, str(tmp_path / "out"))
    n = {r["name"]: r["count"] for r in report.collect()}
    assert n["description"] == 6 and n["interaction"] == 5 and n["involves"] == 10 and n["peptide"] == 3 and n["reports"] == 3 and n["go_term"] == 4
    assert n["total"] == sum(c for name, c in n.items() if name != "total")
    t = {name: spark.read.parquet(f"{run}/{name}") for name in n if name != "total"}
    claims = {(r.kind, r.a.accession, r.b.accession or r.b["name"]): (r.n_descriptions, r.n_publications, r.n_methods, r.n_peptides) for r in t["interaction"].collect()}
    assert claims == {("HH", "P1", "P1"): (1, 1, 1, 1), ("HH", "P2", "P3"): (2, 1, 2, 0), ("HH", "P1", "P4"): (1, 1, 1, 0), ("VH", "P1", "E6"): (1, 1, 1, 2), ("VH", "P2", "e6"): (1, 1, 1, 0)}
    twice = t["involves"].where("a = b").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    bound = {(r.sequence, r.protein.accession or r.protein["name"]) for r in t["binds"].collect()}
    assert bound == {("MKVLA", "P1"), ("MKVLAAAAAA", "E6"), ("MKVLAA", "P1")}
    assert {r.accession: r["name"] for r in t["human"].collect()}["P3"] == "P3"
    assert {r.pmid: r.title for r in t["publication"].collect()}["12"] == "host 12"
    assert [tuple(r) for r in t["parent"].collect()] == [(101, 5)]
    assert [r.evidence_codes for r in t["annotation_reported_in"].collect()] == [["IDA", "IPI"]]
    assert {r.accession: r.taxon_name for r in t["vault_entry"].collect()} == {"V1": "strain A", "V2": ""}


BROKEN = {
    "a pmid that is no number": ("descriptions_hh_1", "E2\t1\t10", "E2\t1\tx", "pmid is not digits"),
    "a partner that is no host": ("descriptions_hh_1", "E3\t1\t10\tMI:0001\tP3\tP2", "E3\t1\t10\tMI:0001\tP3\tP8\nE6\t1\t10\tMI:7777\tP3\tP2", "partner of no host"),
    "an unknown method": ("descriptions_hh_1", "MI:7777", "MI:7777", "not a method"),
    "a stable_id twice": ("descriptions_hh_1", "E3\t", "E1\t", "stable_id twice"),
    "a row too short": ("interactors_human_1", "P4\t2020_01", "P4", "wrong number"),
    "a span of another length": ("interactors_viral_1", "mkvl", "mkv", "span's length"),
    "a site that isn't exported": ("interactors_viral_1", "V2\t2\t5", "V2\t2\t5", "site not exported"),
    "another release": ("interactors_viral_1", "V1\t1\t6\t2020_01", "V1\t1\t6\t2021_01", "another release"),
    "a long mapping without letters": ("mappings_h_1", "A" * 21, "1" * 21, "not residues"),
    "a source that is no partner": ("mappings_h_1", "mkvla\tP1", "mkvla\tP2", "not a partner"),
    "a viral source elsewhere": ("mappings_v_1", "V1\t1\t6\nE4", "V1\t1\t5\nE4", "not a partner"),
    "a target of the wrong kind": ("mappings_h_1", "P1\tv", "P1\th", "wrong kind"),
    "a peptide of no description": ("mappings_v_1", "\nE4\tMKVLAA\tV1\t1\t6\n", "\nE7\tMKVLAA\tV1\t1\t6\n", "no description"),
}


def test_what_breaks_an_assembly(spark, given, tmp_path):
    files = dict(FILES)
    for name, old, new, _ in BROKEN.values():
        assert old in files[name]
        files[name] = files[name].replace(old, new, 1)
    _, checks = B.assemble(spark, put(tmp_path / "export", files), given)
    found = V.report(checks).selectExpr("concat_ws(' ', name, example) AS line").collect()
    for case, (*_, says) in BROKEN.items():
        assert any(says in r.line for r in found), case
    with pytest.raises(V.BrokenRules):
        V.gate(checks[:1])


MUTANTS = {
    "S4": ("supports", lambda df: df.withColumn("a", F.struct(F.lit("h").alias("kind"), F.lit("P7").alias("accession"), F.lit(0).cast("long").alias("ncbi_taxon_id"), F.lit("").alias("name")))),
    "V0": ("human", lambda df: df.unionByName(df.limit(1))),
    "I2": ("involves", lambda df: df.distinct()),
    "I4": ("interaction", lambda df: df.withColumn("n_methods", F.col("n_methods") + 1)),
    "I5": ("interacts_with", lambda df: df.withColumn("n_peptides", F.col("n_peptides") + 1)),
    "D1": ("description_reported_in", lambda df: df.unionByName(df.limit(1))),
    "D3": ("description", lambda df: df.withColumn("method_id", F.lit("MI:1"))),
    "P1": ("peptide", lambda df: df.withColumn("length", F.lit(4))),
    "T3": ("parent", lambda df: df.unionByName(df)),
    "B1": ("publication", lambda df: df.unionByName(df.limit(1).withColumn("pmid", F.lit("99")))),
}


def test_mutants_break_their_rules(spark, given, tmp_path):
    tables, _ = B.assemble(spark, put(tmp_path / "export", FILES), given)
    run = V.publish(spark, tables, str(tmp_path / "out"))
    t = {name: spark.read.parquet(f"{run}/{name}") for name in tables}
    for invariant, (name, change) in MUTANTS.items():
        mine = [c.broken for c in B.audit(t | {name: change(t[name])}) if c.invariant == invariant]
        assert any(not broken.isEmpty() for broken in mine), invariant


def viral(name):
    return F.struct(F.lit("v").alias("kind"), F.lit("").alias("accession"), F.lit(101).cast("long").alias("ncbi_taxon_id"), F.lit(name).alias("name"))


LISTED = {
    "S1": ("strange", lambda df: df),
    "S3": ("description", lambda df: df.withColumn("source", F.lit("other"))),
    "I1": ("interaction", lambda df: df.unionByName(df.select("kind", F.col("b").alias("a"), F.col("a").alias("b"), *[c for c in df.columns if c.startswith("n_")]))),
    "D7": ("description", lambda df: df.withColumn("method_id", F.lit("MI:0003"))),
    "D8": ("description_reported_in", lambda df: df.unionByName(df.where("pmid = '12'").withColumn("pmid", F.lit("13")))),
    "A4": ("annotation_reported_in", lambda df: df.withColumn("evidence_codes", F.array(F.lit("IEA")))),
    "G2": ("go_edge", lambda df: df.where("child <> 'T1'")),
    "T1": ("in_taxon", lambda df: df.where("name <> 'E6'")),
    "T2": ("in_taxon", lambda df: df.withColumn("name", F.concat("name", F.lit("x")))),
    "P3": ("from", lambda df: df.withColumn("protein", viral("E6"))),
}


def test_listed_rules_pass_a_build_and_mutants_break_them(spark, given, tmp_path):
    tables, _ = B.assemble(spark, put(tmp_path / "export", FILES), given)
    run = V.publish(spark, tables, str(tmp_path / "out"))
    t = {name: spark.read.parquet(f"{run}/{name}") for name in tables}
    grouped = spark.createDataFrame([("g", "12"), ("g", "13")], "group string, pmid string")
    rules = B.Rules(given.methods.select("id"), grouped, ("IDA", "IPI"), ("P",), ("T0",), "T9")
    wanted = lambda mine, r=rules: [c for c in B.audit(mine, r) if c.invariant in {*LISTED, "A5"}]
    assert V.report(wanted(t), 2).collect() == []
    for invariant, (name, change) in LISTED.items():
        mine = [c.broken for c in wanted(t | {name: change(t[name] if name in t else t["human"])}) if c.invariant == invariant]
        assert any(not broken.isEmpty() for broken in mine), invariant
    below = [c.broken for c in B.audit(t, B.Rules(binding="T1", namespaces=("F",))) if c.invariant == "A5"]
    assert [broken.count() for broken in below] == [1, 1]


def test_terms_of_another_namespace_break_g1(spark):
    terms = spark.createDataFrame([("T0", "P"), ("T1", "P"), ("T2", "C"), ("T3", None)], "id string, namespace string")
    t = {"go_term": terms, "go_edge": spark.createDataFrame([("T1", "T0")], "child string, parent string")}
    t |= {"annotation": spark.createDataFrame([("T1",)], "go_id string")}
    t |= {"supports": spark.createDataFrame([], "description_id string"), "description_reported_in": spark.createDataFrame([], "description_id string, pmid string")}
    t |= {"description": spark.createDataFrame([], "description_id string, source string")}
    found = {c.invariant: c.broken for c in B.audit_by(t, B.Rules(namespaces=("P",)))}
    assert {r.id for r in found["G1"].collect()} == {"T2", "T3"} and found["A5"].isEmpty()


def test_sinks(spark, tmp_path):
    nodes = spark.createDataFrame([("b",), ("a",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a")], "x string, y string")
    ends = [(["x"], nodes, ["id"]), (["y"], nodes, ["id"])]
    K.write_edges(edges, ends, str(tmp_path / "e"), once=["x", "y"])
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2
    with pytest.raises(V.BrokenRules):
        K.write_edges(edges.unionByName(spark.createDataFrame([("a", "z")], "x string, y string")), ends, str(tmp_path / "f"))
    assert not (tmp_path / "f").exists()
    assert K.write_table(spark.createDataFrame([("b", '"x"', ""), ("a", "", None)], "k string, v string, w string"), str(tmp_path / "t")) == 2
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*")))
    assert [line for line in text.splitlines() if not line.startswith("k\t")] == ["a\t\t", 'b\t"x"\t']
    K.write_nodes(nodes.withColumn("other", F.lit(1)), ["id"], str(tmp_path / "n"))
    assert spark.read.parquet(str(tmp_path / "n")).columns == ["id"]


def test_provenance_and_the_one_file_of_a_stem(spark, tmp_path):
    old = spark.createDataFrame([("b", "u", "1", "r"), ("a", "u", "1", "r")], "dataset string, url string, fetched string, release string")
    new = spark.createDataFrame([("b", "v", "2", "s"), ("c", "v", "2", "s")], "dataset string, url string, fetched string, release string")
    assert [(r.dataset, r.fetched) for r in X.updated_provenance(old, new).collect()] == [("a", "1"), ("b", "2"), ("c", "2")]
    folder = put(tmp_path / "export", {"x_1": "pmid\n1\n", "x_2": "pmid\n1\n"})
    for stem in ("x", "y"):
        with pytest.raises(ValueError, match="expected"):
            X.export_file(spark, folder, stem)
    assert X.export_file(spark, folder, "x_1").endswith("x_1.tsv")
    assert [r.pmid for r in X.read_cited(spark, put(tmp_path / "more", FILES), "hh").collect()] == ["10"] * 3
