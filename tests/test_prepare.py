"""From landed files to a published build, and lists and archives that must stop it."""

import gzip
import json

import pytest

from evidra.operators import audit as V
from evidra.plans import prepare as P
from evidra.sources import readers as S
from tests.test_build import FILES, put

INTERACTION = {0: "uniprotkb:P2", 1: "uniprotkb:P1-2", 6: 'psi-mi:"MI:0002"(two)', 8: "pubmed:20|pubmed:unassigned7", 13: "intact:EBI-1", 35: "false"}
ROWS = [
    {},  # kept: the unassigned id is none
    {},  # once only
    {8: "pubmed:unassigned12|doi:3"},
    {8: "pubmed:20|pubmed:21"},
    {1: "chebi:1"},
    {6: 'psi-mi:"MI:0005"(five)'},
    {6: 'psi-mi:"MI:0005"(five)', 13: "intact:EBI-2"},
    {6: 'psi-mi:"MI:9999"(x)'},
    {35: "true"},
    {1: "uniprotkb:P77"},
    {8: "pubmed:40", 13: "intact:EBI-3"},  # kept: the lowest of its group
    {8: "pubmed:41", 13: "intact:EBI-4"},
    {13: "intact:EBI-5|intact:EBI-6"},
]
NOTE = {1: "P1", 3: "NOT|enables ", 4: "GO:0000009", 5: "PMID:30|PMID:x", 6: "IDA", 14: " G  O"}
NOTES = [{}, {}, {6: "IEA"}, {5: "PMID:x"}, {4: "GO:0005515"}, {4: "GO:0000007"}, {4: "GO:404"}, {1: "P88"}, {4: "GO:0000003", 5: "PMID:30|PMID:31"}]
DETECTION = "".join(
    f"\n[Term]\nid: {i}\nname: {n}\n{x}"
    for i, n, x in (("MI:0001", "detection", ""), ("MI:0002", "two", "is_a: MI:0001 ! d\nalt_id: MI:0099\n"), ("MI:0003", "three", "is_a: MI:0002\n"), ("MI:0005", "five", "is_a: MI:0001\n"), ("MI:0006", "other", ""))
)
TERMS = (
    ("GO:0003674", "root", "molecular_function", ""), ("GO:0008150", "process", "biological_process", ""), ("GO:0000003", "three", "molecular_function", "is_a: GO:0003674 ! root\nalt_id: GO:0000009\n"),
    ("GO:0005515", "binding", "molecular_function", "is_a: GO:0003674\n"), ("GO:0000007", "cell", "cellular_component", ""),
)
SAID = [{"value": "Enters (PubMed:5).", "evidences": [{"source": "PubMed", "id": "50"}]}]


def line(width, base, change):
    cells = base | change
    return "\t".join(cells.get(i, "-") for i in range(width))


def entry(accession, comments, chains=()):
    features = [{"type": "Chain", "description": n, "location": {"start": {"value": a}, "end": {"value": b}}} for n, a, b in chains]
    return {"primaryAccession": accession, "entryType": "UniProtKB reviewed (Swiss-Prot)", "comments": [{"commentType": "FUNCTION", **c} for c in comments], "features": features}


def article(pmid):
    return f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><ArticleTitle>On {pmid}</ArticleTitle><Journal><Title>J</Title><PubDate><Year>2001</Year></PubDate></Journal></Article></MedlineCitation></PubmedArticle>"


def land(folder, **changed):
    folder.mkdir()
    (folder / "entries/host").mkdir(parents=True)
    (folder / "entries/viral").mkdir()
    for silo, pmids in (("host", (10, 20, 30, 31, 40)), ("viral", (12, 13, 50))):
        (folder / f"publications/{silo}").mkdir(parents=True)
        (folder / f"publications/{silo}/a.xml").write_text(f"<S>{''.join(map(article, pmids))}</S>")
    (folder / "interactions.txt").write_text("#head\n" + "\n".join([line(42, INTERACTION, x) for x in ROWS + changed.get("rows", [])] + ["short\tline", ""]))
    (folder / "annotations.gaf.gz").write_bytes(gzip.compress(("!v\n" + "\n".join(line(17, NOTE, x) for x in NOTES) + "\nx\ty\n").encode()))
    (folder / "detection.obo").write_text("format: 1\n" + DETECTION)
    (folder / "ontology.obo").write_text("format: 1\n" + "".join(f"\n[Term]\nid: {i}\nname: {n}\nnamespace: {s}\n{x}" for i, n, s, x in TERMS))
    (folder / "methods.tsv").write_text("psimi_id\tname\tkeep\nMI:0002\ttwo\tyes\nMI:0005\tfive\tno\n" + changed.get("methods", ""))
    (folder / "groups.tsv").write_text("group\tpmid\tnote\ng\t40\t\ng\t41\t\n" + changed.get("groups", ""))
    (folder / "nodes.dmp").write_text("".join(f"{a}\t|\t{b}\t|\t{r}\t|\n" for a, b, r in ((1, 1, "no rank"), (5, 1, "family"), (100, 5, "species"), (102, 1, "species"))))
    (folder / "names.dmp").write_text("".join(f"{i}\t|\t{n}\t|\t\t|\tscientific name\t|\n" for i, n in ((1, "root"), (5, "family five"), (100, "virus one"), (102, "virus two"))))
    (folder / "merged.dmp").write_text("101\t|\t100\t|\n")
    (folder / "entries/host/a.json").write_text(json.dumps({"results": [entry("P1", [{"texts": SAID}]), entry("P99", [{"texts": SAID}])]}))
    chains = [("N", 1, 6), ("M", 1, 3), ("M", 4, 6)]
    viral = [entry("V1", [{"texts": SAID}, {"molecule": "N", "texts": [{"value": "Cuts."}]}, {"molecule": "M", "texts": [{"value": "Binds."}]}], chains), entry("V2", [{"texts": SAID}])]
    (folder / "entries/viral/a.json").write_text(json.dumps({"results": viral}))
    return P.landed_in(str(folder))


FILES = {k: v.replace("MI:0001", "MI:0003") for k, v in FILES.items()}


def test_a_build_from_landed_files(spark, tmp_path):
    landed, export = land(tmp_path / "landed"), put(tmp_path / "export", FILES)
    run, report, dropped = P.build_landed(spark, export, landed, str(tmp_path / "out"))
    assert {(r.source, r.drop_reason): r.n for r in dropped.collect()} == {
        ("interactions", "malformed"): 1, ("interactions", "negative"): 1, ("interactions", "not two proteins"): 1, ("interactions", "no publication"): 1, ("interactions", "several publications"): 1,
        ("interactions", "method not in the ontology"): 1, ("interactions", "method not kept: MI:0005 five"): 2, ("interactions", "not one id"): 1, ("interactions", "not a protein of the host"): 1,
        ("interactions", "repeated in group g: 41"): 1,
        ("annotations", "malformed"): 1, ("annotations", "not experimental"): 1, ("annotations", "no publication"): 1, ("annotations", "left out: protein binding"): 1,
        ("annotations", "left out: cellular component"): 1, ("annotations", "term not in the ontology"): 1, ("annotations", "not a protein of the host"): 1,
    }
    t = {r["name"]: spark.read.parquet(f"{run}/{r['name']}") for r in report.collect() if r["name"] != "total"}
    archive = t["description"].where("source = 'archive'").join(t["description_reported_in"], "description_id")
    assert sorted(r.pmid for r in archive.collect()) == ["20", "40"]
    assert {(r.accession, r.function) for r in t["human"].collect() if r.function} == {("P1", "Enters.")}
    assert {(r["name"], r.function) for r in t["viral"].collect()} == {("E6", "Cuts."), ("e6", "Enters.")}
    noted = sorted((r.accession, r.go_id, r.qualifier, r.pmid, r.evidence_codes) for r in t["annotation_reported_in"].collect())
    assert noted == [("P1", "GO:0000003", "NOT|enables", pmid, ["IDA"]) for pmid in ("30", "31")]
    assert V.report(P.B.audit(t, P.prepare(spark, export, landed, str(tmp_path / "again")).rules), 2).collect() == []


def test_what_stops_a_build(spark, tmp_path):
    """A method without a row, one listed twice, one that is no detection method, an answer that is neither yes nor no, a group of
    one and one whose publication isn't digits: each is told, and nothing is published."""
    methods = "MI:0002\ttwo\tyes\nMI:0006\tother\tno\nMI:0001\tdetection\tmaybe\n"
    landed = land(tmp_path / "landed", rows=[{6: 'psi-mi:"MI:0003"(three)', 13: "intact:EBI-9"}], methods=methods, groups="h\t50\t\ng\tx1\t\n")
    with pytest.raises(V.BrokenRules) as stopped:
        P.build_landed(spark, put(tmp_path / "export", FILES), landed, str(tmp_path / "out"))
    for says in ("used but not listed", "listed twice", "not a detection method", "neither yes nor no", "group of one", "isn't digits"):
        assert says in str(stopped.value), says
    assert not (tmp_path / "out/versions").exists()


def test_a_renamed_method_is_told_but_stops_nothing(spark, tmp_path):
    landed = land(tmp_path / "landed", methods="MI:0003\told name\tyes\n")
    ready = P.prepare(spark, put(tmp_path / "export", FILES), landed, str(tmp_path / "out"))
    V.gate(ready.checks)
    assert [(r.id, r.name) for r in ready.renamed.collect()] == [("MI:0003", "old name")]


def test_files_of_one_list_may_order_their_columns_differently(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "x/b.tsv").write_text("b\tc\ta\n4\t9\t3\nshort\n")
    rows, errors = S.read_tsv(spark, str(tmp_path / "x"), ["a", "b"])
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "2"), ("3", "4")] and [r.row for r in errors.collect()] == ["short"]
    (tmp_path / "x/c.tsv").write_text("b\n4\n")
    with pytest.raises(ValueError, match="no column a"):
        S.read_tsv(spark, str(tmp_path / "x"), ["a", "b"])


def test_texts_of_spans(spark):
    spans = spark.createDataFrame([("A", 1, 10), ("A", 5, 30), ("B", 1, 9), ("C", 1, 9), ("C", 20, 29), ("D", 1, 5), ("D", 1, 5)], "accession string, start long, stop long")
    whole = spark.createDataFrame([("A", 0, 0, "whole A", ["1"]), ("B", 0, 0, "one", []), ("B", 0, 1, "two", ["2"]), ("C", 0, 0, "whole C", [])], "accession string, comment int, place int, function string, pmids array<string>")
    chains = spark.createDataFrame([("A", 1, 0, "M", 1, 10, "first", ["3"]), ("A", 2, 0, "N", 1, 10, "tie", []), ("A", 3, 0, "O", 20, 29, "far", [])], "accession string, comment int, place int, name string, start long, stop long, function string, pmids array<string>")
    got = sorted(tuple(r) for r in P.span_functions(spans, whole, chains).collect())
    assert got == [
        ("A", 1, 10, "first", ["3"]), ("A", 5, 30, "[M]: first", ["3"]), ("A", 5, 30, "[N]: tie", []), ("A", 5, 30, "[O]: far", []), ("B", 1, 9, "one", []), ("B", 1, 9, "two", ["2"]),
    ]
