"""A whole build: an export and prepared tables in, node, edge and sequence tables out, with the checks that guard them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.operators import assemble as A
from evidra.operators import audit as V
from evidra.operators import closure as C
from evidra.operators import merge as M
from evidra.operators import store as K
from evidra.sources import export as X


@dataclass(frozen=True)
class Prepared:
    """What a build reads beside the export; lists of publications are arrays of text."""

    methods: DataFrame  # id, name
    method_aliases: DataFrame  # alias, id
    host_functions: DataFrame  # accession, function, pmids
    viral_functions: DataFrame  # accession, start, stop, function, pmids
    archive: DataFrame  # accession1, accession2, pmid, psimi_id
    annotations: DataFrame  # accession, go_id, qualifier, evidence_code, pmid
    terms: DataFrame  # id, name, namespace, obsolete
    term_edges: DataFrame  # child, parent, relation
    publications: list[DataFrame]  # pmid, title, year, journal, authors, abstract; the first table that has one gives it
    taxa: DataFrame  # tax_id, parent_id, rank, name
    merged: DataFrame  # old_id, new_id


def families(viruses: DataFrame, taxa: DataFrame, merged: DataFrame) -> tuple[DataFrame, list[V.Check]]:
    """virus_id, family_id, family_name of viruses (virus_id) below a family or families themselves, merged ids resolved first."""
    ids = viruses.select(F.col("virus_id").alias("id"))
    found = C.resolve_merges(ids, merged, taxa.select(F.col("tax_id").alias("id")))
    lines = C.lineage(found.where("resolved IS NOT NULL").select(F.col("resolved").alias("id")), taxa.select(F.col("tax_id").alias("id"), F.col("parent_id").alias("parent")))
    nearest = C.nearest_of_rank(lines, taxa.where("rank = 'family'").select(F.col("tax_id").alias("id")))
    names = taxa.select(F.col("tax_id").alias("nearest"), F.col("name").alias("family_name"))
    out = found.join(nearest.withColumnRenamed("id", "resolved"), "resolved").join(names, "nearest")
    return out.select(F.col("id").alias("virus_id"), F.col("nearest").alias("family_id"), "family_name"), [V.Check("T1", "taxon unknown", found.where("resolved IS NULL"))]


def descriptions_of(curated: DataFrame, archive: DataFrame, methods: DataFrame) -> DataFrame:
    """Curated rows as they are, and archive rows of publications without curated HH rows, each pair, publication and method
    once: description_id, source, stable_id, kind, a, b, pmid, method_id, method_name."""
    columns = ["stable_id", "kind", "a", "b", "pmid", "method_id"]
    pair = [A.human_ref(F.least("accession1", "accession2")).alias("a"), A.human_ref(F.greatest("accession1", "accession2")).alias("b")]
    observed = archive.select(F.lit("").alias("stable_id"), F.lit("HH").alias("kind"), *pair, "pmid", F.col("psimi_id").alias("method_id"))
    hosts = M.precedence(curated.where("kind = 'HH'"), observed, "pmid", columns)
    both = hosts.unionByName(curated.where("kind = 'VH'").select(*columns, F.lit("curated").alias("source")))
    named = both.join(methods.select(F.col("id").alias("method_id"), F.col("name").alias("method_name")), "method_id", "left")
    key = F.when(F.col("stable_id") != "", F.col("stable_id")).otherwise(F.concat_ws("|", "a.accession", "b.accession", "pmid", "method_id"))
    return named.withColumn("description_id", key)


def assemble(spark: SparkSession, export: str, given: Prepared) -> tuple[dict[str, DataFrame], list[V.Check]]:
    """The tables of a build by name, and the checks that must be empty before they are published. What many tables and checks
    share is cut to a checkpoint, so that none of them reads the export anew."""
    read = [X.read_descriptions(spark, export, given.methods, given.method_aliases), X.read_hosts(spark, export), X.read_sites(spark, export), X.read_peptides(spark, export)]
    rows, hosts, exported, mappings = (C.cut(df) for df, _ in read)
    checks = [V.Check("P1", "row of the export", errors) for _, errors in read]
    human, c1 = A.human_proteins(hosts, given.host_functions)
    curated, sites, c2 = A.curated_rows(rows, hosts, exported)
    curated, sites = C.cut(curated), C.cut(sites)
    viral, c3 = A.viral_proteins(sites, given.viral_functions)
    sources, c4 = A.peptide_sources(mappings, curated)
    vault, c5 = A.vault(hosts, sites, curated)
    described = C.cut(descriptions_of(curated, given.archive, given.methods))
    reports = C.cut(A.peptide_reports(sources, curated))
    viruses = curated.where("kind = 'VH'").select("virus_id", F.col("virus_name").alias("name")).distinct()
    family, c6 = families(viruses, given.taxa, given.merged)
    annotated = given.annotations.join(hosts.select("accession"), "accession", "left_semi")
    reached = C.ancestors(annotated.select(F.col("go_id").alias("id")), given.term_edges)
    terms = given.terms.join(reached, "id", "left_semi")
    cites = human.select(A.human_ref(F.col("accession")).alias("protein"), F.explode("pmids").alias("pmid")).unionByName(
        viral.select(A.viral_ref(F.col("virus_id"), F.col("name")).alias("protein"), F.explode("pmids").alias("pmid"))
    )
    wanted = A.cited_by_silo(described, annotated, human, viral).select("pmid").distinct()
    publications = M.by_rank(wanted, given.publications, "pmid")
    tables = {
        "human": human.drop("pmids"),
        "viral": viral.drop("pmids").withColumnRenamed("virus_id", "ncbi_taxon_id"),
        "function_cites": cites.distinct(),
        "virus": viruses.withColumnRenamed("virus_id", "ncbi_taxon_id"),
        "family": family.select(F.col("family_id").alias("ncbi_taxon_id"), F.col("family_name").alias("name")).distinct(),
        "parent": family.select("virus_id", "family_id"),
        "in_taxon": viral.select(F.col("virus_id").alias("ncbi_taxon_id"), "name"),
        "publication": shaped(publications.where("silo IS NOT NULL"), SHAPES["publication"]),
        **K.claim_tables(A.counted_claims(described, reports), described),
        "peptide": reports.select("sequence", F.length("sequence").alias("length")).distinct(),
        "reports": reports.select(F.col("stable_id").alias("description_id"), "sequence").distinct(),
        "from": reports.select("sequence", F.col("source").alias("protein")).distinct(),
        "binds": reports.select("sequence", F.col("target").alias("protein")).distinct(),
        "go_term": terms.drop("obsolete"),
        "go_edge": C.walked_edges(reached, given.term_edges),
        **K.annotation_tables(annotated),
        **{f"vault_{name}": df for name, df in vault.items()},
    }
    checks += [*c1, *c2, *c3, *c4, *c5, *c6]
    checks += [
        V.Check("D3", "method without name", described.where("method_name IS NULL")),
        V.Check("J14", "cited publication without metadata", publications.where("silo IS NULL").select("pmid")),
        V.Check("G1", "annotated term is obsolete", terms.where("obsolete").join(annotated.select(F.col("go_id").alias("id")), "id", "left_semi")),
    ]
    return tables, checks


#: Keys of the node tables, unique in each.
KEYS = {
    "human": ["accession"], "viral": ["ncbi_taxon_id", "name"], "virus": ["ncbi_taxon_id"], "family": ["ncbi_taxon_id"], "publication": ["pmid"],
    "interaction": ["kind", "a", "b"], "description": ["description_id"], "peptide": ["sequence"], "go_term": ["id"], "annotation": ["accession", "go_id", "qualifier"],
    "vault_sequence": ["accession"], "vault_entry": ["accession"], "vault_observation": ["stable_id"],
}

#: Edge tables, their columns of one end, and the node table that end must match.
ENDS = [
    ("function_cites", ["pmid"], "publication"), ("parent", ["virus_id"], "virus"), ("parent", ["family_id"], "family"), ("in_taxon", ["ncbi_taxon_id"], "virus"),
    ("supports", ["kind", "a", "b"], "interaction"), ("involves", ["kind", "a", "b"], "interaction"), ("supports", ["description_id"], "description"),
    ("description_reported_in", ["description_id"], "description"), ("description_reported_in", ["pmid"], "publication"), ("reports", ["sequence"], "peptide"),
    ("reports", ["description_id"], "description"), ("from", ["sequence"], "peptide"), ("binds", ["sequence"], "peptide"), ("go_edge", ["child"], "go_term"), ("go_edge", ["parent"], "go_term"),
    ("annotation", ["accession"], "human"), ("annotation", ["go_id"], "go_term"), ("annotation_reported_in", ["accession", "go_id", "qualifier"], "annotation"),
    ("annotation_reported_in", ["pmid"], "publication"), ("vault_observation", ["accession"], "vault_entry"), ("vault_mature", ["accession"], "vault_entry"),
    ("in_taxon", ["ncbi_taxon_id", "name"], "viral"),
]

#: Rules of node tables on how often the ends named `table_column` (ENDS) occur, besides those that every table has.
DEGREES = {
    "interaction": [("I2", "two INVOLVES a claim", "n > 0 AND involves_kind <> 2"), ("I6", "claim without description", "n > 0 AND supports_kind = 0")],
    "description": [("D1", "one claim a description", "n > 0 AND supports_description_id <> 1"), ("D1", "one publication a description", "n > 0 AND description_reported_in_description_id <> 1")],
    "publication": [("B1", "publication that nothing cites", "n > 0 AND function_cites_pmid + description_reported_in_pmid + annotation_reported_in_pmid = 0")],
    "peptide": [("P2", f"peptide without {e}", f"n > 0 AND {e}_sequence = 0") for e in ("reports", "from", "binds")],
    "go_term": [("G3", "term neither annotated nor a parent", "n > 0 AND go_edge_parent + annotation_go_id = 0")],
    "virus": [("T3", "virus of several families", "parent_virus_id > 1"), ("T4", "virus without protein", "n > 0 AND in_taxon_ncbi_taxon_id = 0")],
    "annotation": [("A2", "annotation without publication", "n > 0 AND annotation_reported_in_accession = 0")],
    "viral": [("T1", "viral protein without its virus", "n > 0 AND in_taxon_ncbi_taxon_id = 0")],
}


#: Every table of a build.
TABLES = frozenset({
    "human", "viral", "function_cites", "virus", "family", "parent", "in_taxon", "publication", "interaction", "involves", "interacts_with", "description", "supports",
    "description_reported_in", "peptide", "reports", "from", "binds", "go_term", "go_edge", "annotation", "annotation_reported_in", "vault_sequence", "vault_entry",
    "vault_mature", "vault_observation",
})


_PROTEIN = "struct<kind:string,accession:string,ncbi_taxon_id:bigint,name:string>"
_CLAIM = f"kind string, a {_PROTEIN}, b {_PROTEIN}"
_COUNTERS = "n_descriptions bigint, n_publications bigint, n_methods bigint, n_peptides bigint"
#: The columns and types of tables, nodes and edges; a build's may have no others.
SHAPES = {
    "human": "accession string, name string, description string, function string", "viral": "ncbi_taxon_id bigint, name string, function string",
    "function_cites": f"protein {_PROTEIN}, pmid string", "virus": "ncbi_taxon_id bigint, name string", "family": "ncbi_taxon_id bigint, name string",
    "parent": "virus_id bigint, family_id bigint", "in_taxon": "ncbi_taxon_id bigint, name string", "interaction": f"{_CLAIM}, {_COUNTERS}",
    "involves": f"{_CLAIM}, protein {_PROTEIN}", "interacts_with": f"a {_PROTEIN}, b {_PROTEIN}, {_COUNTERS}",
    "description": "description_id string, source string, stable_id string, method_id string, method_name string", "supports": f"description_id string, {_CLAIM}",
    "description_reported_in": "description_id string, pmid string", "peptide": "sequence string, length int", "reports": "description_id string, sequence string",
    "from": f"sequence string, protein {_PROTEIN}", "binds": f"sequence string, protein {_PROTEIN}", "go_term": "id string, name string, namespace string",
    "go_edge": "child string, parent string, relation string", "annotation": "accession string, go_id string, qualifier string",
    "annotation_reported_in": "accession string, go_id string, qualifier string, pmid string, evidence_codes array<string>",
    "publication": "pmid string, title string, year bigint, journal string, authors array<string>, abstract string",
    "vault_sequence": "accession string, sequence string", "vault_entry": "accession string, taxon_id bigint, taxon_name string, release string, description string",
    "vault_mature": "ncbi_taxon_id bigint, name string, accession string, start bigint, stop bigint, sequence string", "vault_observation": "stable_id string, accession string",
}


def shaped(df: DataFrame, shape: str) -> DataFrame:
    """df with exactly the columns of a shape; those it lacks are empty: '' or 0, or a list of none."""
    empty = {"string": F.lit(""), "bigint": F.lit(0), "array<string>": F.array()}
    fields = df.sparkSession.createDataFrame([], shape).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else empty[f.dataType.simpleString()].cast(f.dataType)).alias(f.name) for f in fields])


def misshapen(t: dict[str, DataFrame]) -> DataFrame:
    """table, column of every column that is missing, of another type or not expected."""
    spark, found = t["human"].sparkSession, []
    for name, shape in SHAPES.items():
        if name in t:
            want = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], shape).schema}
            have = {f.name: f.dataType.simpleString() for f in t[name].schema}
            found += [(name, c) for c in sorted(have.keys() | want.keys()) if have.get(c) != want.get(c)]
    return spark.createDataFrame(found, "table string, column string")


@dataclass(frozen=True)
class Rules:
    """What the audit needs beside the tables; rules without their part aren't tested."""

    kept_methods: DataFrame | None = None  # id
    groups: DataFrame | None = None  # group, pmid
    codes: tuple[str, ...] = ()
    namespaces: tuple[str, ...] = ()
    roots: tuple[str, ...] = ()
    binding: str | None = None


#: Codes of experimental evidence, namespaces of annotated terms with their roots, and protein binding.
CODES = ("EXP", "IDA", "IPI", "IMP", "IGI", "IEP", "HTP", "HDA", "HMP", "HGI", "HEP")
NAMESPACES = ("molecular_function", "biological_process")
ROOTS = ("GO:0003674", "GO:0008150")
BINDING = "GO:0005515"


def proteins(t: dict[str, DataFrame]) -> DataFrame:
    """protein: the reference of every protein."""
    return t["human"].select(A.human_ref(F.col("accession")).alias("protein")).unionByName(t["viral"].select(A.viral_ref(F.col("ncbi_taxon_id"), F.col("name")).alias("protein")))


def audit_by(t: dict[str, DataFrame], rules: Rules) -> list[V.Check]:
    """The rules of written tables that depend on lists kept beside them."""
    found, pair = [], ["kind", "a", "b"]
    archive = t["supports"].join(t["description_reported_in"], "description_id").join(t["description"].where("source = 'archive'"), "description_id")
    if rules.kept_methods is not None:
        found.append(V.Check("D7", "archive method that isn't kept", V.dangling(archive, ["method_id"], rules.kept_methods, ["id"])))
    if rules.groups is not None:
        several = archive.join(rules.groups.select("group", "pmid"), "pmid").groupBy(*pair, "group").agg(F.sort_array(F.collect_set("pmid")).alias("pmids"))
        found.append(V.Check("D8", "claim with two publications of a group", several.where(F.size("pmids") > 1)))
    if rules.namespaces:
        terms = t["go_term"].where(~F.coalesce(F.col("namespace").isin(*rules.namespaces), F.lit(False)))
        found.append(V.Check("G1", "term of another namespace", terms))
        found.append(V.Check("A5", "annotation to another namespace", t["annotation"].join(terms.select(F.col("id").alias("go_id")), "go_id", "left_semi")))
    if rules.binding:
        root = t["go_term"].sparkSession.createDataFrame([(rules.binding,)], "id string")
        below = C.descendants(root, t["go_edge"]).select(F.col("id").alias("go_id"))
        found.append(V.Check("A5", "annotation at or below binding", t["annotation"].join(below, "go_id", "left_semi")))
    if rules.roots:
        orphans = V.childless(t["go_term"], ["id"], t["go_edge"], ["child"]).where(~F.col("id").isin(*rules.roots))
        found.append(V.Check("G2", "term without parent", orphans))
    return found


def misplaced_peptides(t: dict[str, DataFrame]) -> DataFrame:
    """Reports (description_id, sequence) unless exactly one protein of the description's pair is a source of the peptide, and
    at least one binds it."""
    sides = t["reports"].join(t["supports"], "description_id").select("description_id", "sequence", F.explode(F.array_distinct(F.array("a", "b"))).alias("protein"))
    for edge in ("from", "binds"):
        sides = sides.join(t[edge].select("sequence", "protein", F.lit(1).alias(f"is_{edge}")).distinct(), ["sequence", "protein"], "left")
    counted = sides.groupBy("description_id", "sequence").agg(F.count("is_from").alias("sources"), F.count("is_binds").alias("targets"))
    return counted.where("sources <> 1 OR targets = 0")


def key_rules(t: dict[str, DataFrame]) -> list[V.KeyRules]:
    """For every node table: its key doesn't repeat, what names it finds it, and its degrees (DEGREES)."""
    out = []
    for node, key in KEYS.items():
        ends = [(name, columns) for name, columns, to in ENDS if to == node]
        named = {f"{name}_{columns[0]}": (t[name], columns) for name, columns in ends}
        invariant = "T2" if node == "viral" else "S4"  # of a viral protein the end is a taxon's protein that isn't viral
        rules = [("V0", f"{node}: key repeats", "n > 1")] + [(invariant, f"{end} to {node}", f"{end} > 0 AND n = 0") for end in named]
        out.append(V.KeyRules(t[node], key, named, rules + DEGREES.get(node, [])))
    ends = {name: (t[name], ["protein"]) for name in ("involves", "from", "binds", "function_cites")}
    return [*out, V.KeyRules(proteins(t), ["protein"], ends, [("S4", f"{name} to a protein", f"`{name}` > 0 AND n = 0") for name in ends])]


def row_rules(t: dict[str, DataFrame], rules: Rules) -> list[V.RowRules]:
    """For every table: nothing is missing, and what a row of it must say."""
    own: dict[str, list[tuple[str, str, F.Column]]] = {
        "interaction": [("S3", "claim neither HH nor VH", ~F.col("kind").isin("HH", "VH"))],
        "description": [
            ("S3", "description neither curated nor of the archive", ~F.col("source").isin("curated", "archive")), ("D2", "curated without stable_id", F.expr("source = 'curated' AND stable_id = ''")),
            ("D3", "method id or name", F.expr("method_name = '' OR NOT method_id RLIKE '^MI:.{4}$'")),
        ],
        "annotation_reported_in": [("A4", "annotation without codes", F.size("evidence_codes") == 0)],
        "peptide": [("P1", "peptide's length or case", F.expr("length NOT BETWEEN 5 AND 20 OR length <> length(sequence) OR NOT sequence RLIKE '^[A-Z]+$'"))],
    }
    if rules.codes:
        own["annotation_reported_in"].append(("A4", "code that isn't experimental", F.size(F.array_except("evidence_codes", F.array(*map(F.lit, rules.codes)))) > 0))
    missing = lambda df: reduce(lambda x, y: x | y, [F.col(f"`{c}`").isNull() for c in df.columns])
    return [V.RowRules(t[name], [("S2" if name in KEYS else "S4", f"{name}: a value is missing", missing(t[name])), *own.get(name, [])]) for name in sorted(TABLES)]


def audit_parts(t: dict[str, DataFrame], rules: Rules = Rules()) -> list[V.Check | V.RowRules | V.KeyRules]:
    """The rules of written tables, those on rows grouped by table and those on keys by node table."""
    spark = t["human"].sparkSession
    strange = spark.createDataFrame([(name,) for name in sorted(t.keys() ^ TABLES)], "name string")
    claims, described = t["interaction"], t["supports"].join(t["description_reported_in"], "description_id").join(t["description"], "description_id")
    pair, counters = ["kind", "a", "b"], ["n_descriptions", "n_publications", "n_methods", "n_peptides"]
    peptides = t["reports"].join(t["supports"], "description_id").select(*pair, "sequence")
    grouped = t["involves"].groupBy(*pair).agg(F.count_if(F.col("protein.kind") == "v").alias("n_viral"))
    archive = described.where("source = 'archive'")
    return [
        V.Check("S1", "table that isn't declared, or is missing", strange),
        V.Check("S2", "column that is missing, of another type or not declared", misshapen(t)),
        *row_rules(t, rules),
        *key_rules(t),
        *audit_by(t, rules),
        V.Check("S3", "taxon both virus and family", V.overlapping(t["virus"], t["family"], ["ncbi_taxon_id"])),
        V.Check("I1", "claims of one unordered pair", V.repeated(claims.select(F.least("a", "b").alias("one"), F.greatest("a", "b").alias("two")), ["one", "two"])),
        V.Check("I3", "VH is one human and one viral protein, HH two human ones", grouped.where("n_viral <> CASE kind WHEN 'VH' THEN 1 ELSE 0 END")),
        V.Check("I4", "counters equal a recount", V.differing(claims, A.counted_claims(described, peptides), pair, counters)),
        V.Check("I5", "one shortcut a claim, with its counters", V.differing(t["interacts_with"], claims.drop("kind"), ["a", "b"], counters)),
        V.Check("D4", "archive description repeats", V.repeated(archive, ["a", "b", "pmid", "method_id"])),
        V.Check("D5", "archive description of a curated publication", archive.join(described.where("kind = 'HH' AND source = 'curated'").select("pmid"), "pmid", "left_semi")),
        V.Check("D6", "VH description of the archive", archive.where("kind = 'VH'")),
        V.Check("P3", "peptide without its one source, or without target, in the pair", misplaced_peptides(t)),
    ]


def audit(t: dict[str, DataFrame], rules: Rules = Rules()) -> list[V.Check]:
    """audit_parts, a check for each rule."""
    return [c for part in audit_parts(t, rules) for c in ([part] if isinstance(part, V.Check) else part.checks())]


def build(spark: SparkSession, export: str, given: Prepared, root: str, rules: Rules = Rules()) -> tuple[str, DataFrame]:
    """Assemble, gate, write and publish a build; gives its folder and the number of rows of every table."""
    tables, checks = assemble(spark, export, given)
    V.gate(checks)
    run = V.publish(spark, tables, root, lambda read: audit_parts(read, rules))
    return run, K.build_report({name: spark.table(name) for name in tables})
