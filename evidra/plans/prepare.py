"""From landed files to prepared tables: archives filtered with counts for every reason, texts of hosts and viral spans, curated
lists tested, everything written once as tables that builds read. And a whole build from an export and landed files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.operators import archive as R
from evidra.operators import audit as V
from evidra.operators import closure as C
from evidra.operators import merge as M
from evidra.operators.closure import first_by
from evidra.plans import build as B
from evidra.sources import export as X
from evidra.sources import readers as S

#: The root of detection methods, and the namespace whose terms no annotation may use.
DETECTION = "MI:0001"
COMPONENT = "cellular_component"


@dataclass(frozen=True)
class Landed:
    """Paths of landed files, each a file, a folder or a pattern."""

    interactions: str
    annotations: str
    detection: str  # ontology of detection methods
    ontology: str
    methods: str
    groups: str
    nodes: str
    names: str
    merged: str
    host_entries: str
    viral_entries: str
    publications: tuple[str, ...] = field(default_factory=tuple)  # the first that has one gives it


def landed_in(folder: str) -> Landed:
    """The landed files of a folder under their usual names."""
    at = lambda name: f"{folder.rstrip('/')}/{name}"
    return Landed(
        at("interactions*"), at("annotations*"), at("detection.obo"), at("ontology.obo"), at("methods.tsv"), at("groups.tsv"), at("nodes.dmp"), at("names.dmp"), at("merged.dmp"),
        at("entries/host"), at("entries/viral"), (at("publications/host"), at("publications/viral")),
    )


def span_functions(spans: DataFrame, whole: DataFrame, chains: DataFrame) -> DataFrame:
    """accession, start, stop, function, pmids: what entries say about spans (accession, start, stop). Of the texts of chains and of
    whole entries (as readers.read_scoped_functions gives them) a span has that of the chain it agrees with best, if it does; else,
    where the entry has no other span, those of the entry; else those of all chains it overlaps, each under its name."""
    order = Window.partitionBy("accession").orderBy("comment", "place", "start", "stop")
    numbered = chains.withColumn("c", F.row_number().over(order))
    asked = spans.select("accession", "start", "stop").distinct()
    kinds = M.interval_best_match(
        asked.withColumnRenamed("accession", "entry"), numbered.select(F.col("accession").alias("entry"), "c", F.col("start").alias("c_start"), F.col("stop").alias("c_stop")),
        whole.select(F.col("accession").alias("entry")).distinct(),
    ).withColumnRenamed("entry", "accession")
    of_chain = kinds.where("kind IN ('best', 'overlaps')").select("accession", "start", "stop", "kind", F.explode(F.split("chains", ",").cast("array<int>")).alias("c"))
    told = of_chain.join(numbered.select("accession", "c", "name", "function", "pmids"), ["accession", "c"])
    text = F.when(F.col("kind") == "best", F.col("function")).otherwise(F.concat(F.lit("["), "name", F.lit("]: "), "function"))
    own = kinds.where("kind = 'entry'").join(whole.select("accession", "function", "pmids"), "accession")
    columns = ["accession", "start", "stop", "function", "pmids"]
    return told.withColumn("function", text).select(*columns).unionByName(own.select(*columns))


@dataclass(frozen=True)
class Ready:
    """Prepared tables, the rules their build is audited by, the counts (source, drop_reason, n) of rows left out, methods listed
    under an older name (finding, id, name), and the checks that must be empty before anything is built."""

    prepared: B.Prepared
    rules: B.Rules
    dropped: DataFrame
    renamed: DataFrame
    checks: list[V.Check]


def prepare(spark: SparkSession, export: str, landed: Landed, root: str) -> Ready:
    """Read landed files for the hosts and viral spans of an export, write the prepared tables below a new folder of root and
    read them from there."""
    run = f"{root.rstrip('/')}/prepared-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{run}/{name}")
        return spark.read.schema(df.schema).parquet(f"{run}/{name}")

    hosts = kept(X.read_hosts(spark, export)[0].select("accession"), "hosts")
    spans = X.read_sites(spark, export)[0].select("accession", "start", "stop")
    detection, aliases, detection_edges = (kept(df, f"detection_{n}") for df, n in zip(S.read_ontology(spark, landed.detection), ("terms", "aliases", "edges")))
    current = X.current_methods(detection, aliases)
    listed, list_errors = S.read_methods(spark, landed.methods)
    listed = kept(listed, "methods")
    groups, group_errors = S.read_group_list(spark, landed.groups)
    groups = kept(groups, "groups")
    one = listed.groupBy("id").agg(F.min("name").alias("name"), F.min("keep").alias("keep"))  # a method listed twice is an error, below
    pairs, dropped_pairs, unlisted = R.filter_interactions(S.read_interactions(spark, landed.interactions), current, one, hosts, groups)
    pairs = kept(pairs, "interactions")
    root_of = spark.createDataFrame([(DETECTION,)], "id string")
    below = C.descendants(root_of, detection_edges.where("relation = 'IS_A'"))
    findings = R.method_findings(listed, detection, below, unlisted.select(F.col("psimi_id").alias("id")))

    terms, term_aliases, edges = (kept(df, f"ontology_{n}") for df, n in zip(S.read_ontology(spark, landed.ontology), ("terms", "aliases", "edges")))
    binding = C.descendants(spark.createDataFrame([(B.BINDING,)], "id string"), edges)
    excluded = C.excluded([("cellular component", terms.where(F.col("namespace") == COMPONENT)), ("protein binding", binding)])
    annotations, dropped_annotations = R.filter_annotations(S.read_annotations(spark, landed.annotations), B.CODES, terms, term_aliases, excluded, hosts)
    annotations = kept(annotations, "annotations")

    functions = kept(first_by(S.read_host_functions(spark, landed.host_entries).join(hosts, "accession", "left_semi"), ["accession"], ["function"]), "host_functions")
    whole, chains = (kept(df, name) for df, name in zip(S.read_scoped_functions(spark, landed.viral_entries), ("entry_texts", "chain_texts")))
    viral = kept(span_functions(spans, whole, chains), "viral_functions")
    taxa, merged = S.read_taxonomy(spark, landed.nodes, landed.names, landed.merged)
    publications = [kept(S.read_publications(spark, p), f"publications_{i}") for i, p in enumerate(landed.publications)]

    counts = dropped_pairs.withColumn("source", F.lit("interactions")).unionByName(dropped_annotations.withColumn("source", F.lit("annotations")))
    dropped = kept(counts.select("source", "drop_reason", "n"), "dropped")
    checks = [
        V.Check("S14", "method list", list_errors),
        V.Check("S14", "publication groups", group_errors),
        V.Check("S14", "publication groups", R.group_findings(groups)),
        V.Check("A10", "method list against the ontology", findings.where("finding <> 'renamed'")),
    ]
    given = B.Prepared(
        methods=detection.select("id", "name"), method_aliases=aliases, host_functions=functions, viral_functions=viral,
        archive=pairs, annotations=annotations, terms=terms, term_edges=edges, publications=publications, taxa=kept(taxa, "taxa"), merged=kept(merged, "merged"),
    )
    rules = B.Rules(one.where("keep").select("id"), groups, B.CODES, B.NAMESPACES, B.ROOTS, B.BINDING)
    return Ready(given, rules, dropped, findings.where("finding = 'renamed'"), checks)


def build_landed(spark: SparkSession, export: str, landed: Landed, root: str) -> tuple[str, DataFrame, DataFrame]:
    """Prepare, gate, build, audit and publish; gives the build's folder, its report and the counts of rows left out. An archive
    that uses a method without a row in the list, or a list that breaks a rule, stops it with nothing published."""
    ready = prepare(spark, export, landed, f"{root.rstrip('/')}/prepared")
    V.gate(ready.checks)
    run, report = B.build(spark, export, ready.prepared, root, ready.rules)
    return run, report, ready.dropped
