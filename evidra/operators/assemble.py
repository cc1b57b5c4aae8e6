"""Assembly of an export's rows into proteins, claims, peptides and sequence tables; what breaks a rule comes as Check rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidra.operators.audit import Check
from evidra.operators.closure import first_by
from evidra.operators.graph import pair_counters

SITE = ["accession", "start", "stop"]
PLACEMENT = ["protein", "virus_id", "strain_id", "strain_name", "release"]


def human_ref(accession: Column) -> Column:
    """A protein reference; the fields of the other kind's key are 0 and '', never null, so that references compare."""
    return F.struct(F.lit("h").alias("kind"), accession.alias("accession"), F.lit(0).cast("long").alias("ncbi_taxon_id"), F.lit("").alias("name"))


def viral_ref(taxon: Column, name: Column) -> Column:
    return F.struct(F.lit("v").alias("kind"), F.lit("").alias("accession"), taxon.alias("ncbi_taxon_id"), name.alias("name"))


def human_proteins(hosts: DataFrame, functions: DataFrame) -> tuple[DataFrame, list[Check]]:
    """accession, name, description, function ('' if there is none) and pmids (a list) of every host entry."""
    texts = functions.select("accession", "function", "pmids")
    checks = [
        Check("J6", "function text of no host entry", texts.join(hosts, "accession", "left_anti")),
        Check("J6", "host entry twice", hosts.groupBy("accession").count().where("count > 1")),
        Check("J6", "function text twice", texts.groupBy("accession").count().where("count > 1")),
    ]
    out = hosts.select("accession", "name", "description").join(texts, "accession", "left")
    return out.withColumns({"function": F.coalesce("function", F.lit("")), "pmids": F.coalesce("pmids", F.array().cast("array<string>"))}), checks


def curated_rows(rows: DataFrame, hosts: DataFrame, exported: DataFrame) -> tuple[DataFrame, DataFrame, list[Check]]:
    """Curated rows with their protein references (a, b; HH pairs in order), the observed sites, and the rows that break a rule:
    ids that repeat, partners that are no host entry, sites that are unknown or that rows disagree on, viruses of two names."""
    ids = hosts.select("accession")
    human = rows.select("stable_id", F.explode(F.when(F.col("kind") == "HH", F.array("accession1", "accession2")).otherwise(F.array("accession1"))).alias("accession"))
    vh = rows.where("kind = 'VH'").withColumnRenamed("accession2", "accession")
    known = exported.select(*SITE, F.col("release").alias("its_release"), "description", "sequence")
    agreed = vh.groupBy(*SITE).agg((F.min(F.struct(*PLACEMENT)) != F.max(F.struct(*PLACEMENT))).alias("differ"), F.min(F.struct(*PLACEMENT)).alias("p"))
    checks = [
        Check("A4", "stable_id twice", rows.groupBy("stable_id").count().where("count > 1")),
        Check("J7", "partner of no host entry", human.join(ids, "accession", "left_anti")),
        Check("J8", "site not exported", vh.select(*SITE).distinct().join(known, SITE, "left_anti")),
        Check("J8", "rows disagree on a site", agreed.where("differ")),
        Check("J8", "another release than the exported one", vh.join(known, SITE).where("release <> its_release").select("stable_id", *SITE)),
        Check("A4", "virus of several names", vh.groupBy("virus_id").agg(F.countDistinct("virus_name").alias("n")).where("n > 1")),
    ]
    placed = agreed.select(*SITE, "p.*").join(first_by(known, SITE, ["its_release", "description", "sequence"]).drop("its_release"), SITE)
    one, two = F.least("accession1", "accession2"), F.greatest("accession1", "accession2")
    virus = F.col("kind") == "VH"
    a = human_ref(F.when(virus, F.col("accession1")).otherwise(one))
    b = F.when(virus, viral_ref(F.coalesce("virus_id", F.lit(0)), F.coalesce("protein", F.lit("")))).otherwise(human_ref(two))
    return rows.withColumns({"a": a, "b": b}), placed, checks


def viral_proteins(sites: DataFrame, functions: DataFrame) -> tuple[DataFrame, list[Check]]:
    """virus_id, name, function (distinct texts of its sites in order, a blank line between) and pmids."""
    texts = functions.select(*SITE, "function", "pmids")
    checks = [Check("J10", "function text of no site", texts.join(sites, SITE, "left_anti"))]
    met = sites.select(*SITE, "virus_id", F.col("protein").alias("name")).join(texts, SITE, "left")
    pooled = met.groupBy("virus_id", "name").agg(
        F.array_join(F.array_sort(F.collect_set("function")), "\n\n").alias("function"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pmids")))).alias("pmids"),
    )
    return pooled, checks


def peptide_sources(peptides: DataFrame, curated: DataFrame) -> tuple[DataFrame, list[Check]]:
    """stable_id, sequence, source (a protein reference) of every peptide; broken: no such row, a source that is none of the
    row's partners (a viral one must match accession and span), a target of the wrong kind."""
    row = curated.select("stable_id", F.col("kind").alias("claim"), "accession1", "accession2", F.col("start").alias("at"), F.col("stop").alias("to"), "b")
    met = peptides.join(row, "stable_id", "left")
    known, vh, human = F.col("claim").isNotNull(), F.col("claim") == "VH", F.col("kind") == "h"
    by_host = human & ((F.col("accession") == F.col("accession1")) | (~vh & (F.col("accession") == F.col("accession2"))))
    by_virus = ~human & vh & (F.col("accession") == F.col("accession2")) & (F.col("start") == F.col("at")) & (F.col("stop") == F.col("to"))
    met = met.withColumn("source", F.when(by_host, human_ref(F.col("accession"))).when(by_virus, F.col("b")))
    aim = F.when(vh & human, "v").otherwise("h")
    shown = lambda which: met.where(which).select(*peptides.columns)
    checks = [
        Check("J11", "peptide of no description", shown(~known)),
        Check("J11", "source is not a partner", shown(known & F.col("source").isNull())),
        Check("J11", "target of the wrong kind", shown(known & F.col("source").isNotNull() & (F.col("target") != aim))),
    ]
    return met.where(known & F.col("source").isNotNull() & (F.col("target") == aim)).select("stable_id", "sequence", "source"), checks


def peptide_reports(sources: DataFrame, curated: DataFrame) -> DataFrame:
    """kind, a, b, stable_id, sequence, source, target: the target is the pair's other side, the same protein where both are."""
    target = F.when(F.col("source") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return sources.join(curated.select("stable_id", "kind", "a", "b"), "stable_id").select("kind", "a", "b", "stable_id", "sequence", "source", target.alias("target")).distinct()


def cited_by_silo(descriptions: DataFrame, annotations: DataFrame, human: DataFrame, viral: DataFrame) -> DataFrame:
    """pmid, silo of every cited publication: the host silo's of HH descriptions (kind, pmid), annotations and texts of human
    proteins (pmids, a list), the viral silo's of VH descriptions and texts of viral proteins. One that both cite is in both."""
    rows = descriptions.select("pmid", F.when(F.col("kind") == "VH", "viral").otherwise("host").alias("silo"))
    rows = rows.unionByName(annotations.select("pmid", F.lit("host").alias("silo")))
    for texts, silo in ((human, "host"), (viral, "viral")):
        rows = rows.unionByName(texts.select(F.explode("pmids").alias("pmid"), F.lit(silo).alias("silo")))
    return rows.distinct()


def counted_claims(descriptions: DataFrame, reports: DataFrame) -> DataFrame:
    """kind, a, b with numbers of descriptions and distinct publications, methods and peptides; peptides are counted before
    they meet the pairs, so no description counts twice."""
    key = ["kind", "a", "b"]
    counted = pair_counters(descriptions.select(*key, F.col("pmid").alias("publication"), F.col("method_id").alias("method")), key)
    peptides = reports.groupBy(*key).agg(F.countDistinct("sequence").alias("n_peptides"))
    return counted.join(peptides, key, "left").withColumn("n_peptides", F.coalesce("n_peptides", F.lit(0)))


def vault(hosts: DataFrame, sites: DataFrame, curated: DataFrame) -> tuple[dict[str, DataFrame], list[Check]]:
    """Sequence tables: sequence, entry, mature and observation (the entry each VH row observed)."""
    entry = sites.select("accession", F.col("strain_id").alias("taxon_id"), F.col("strain_name").alias("taxon_name"), "release", "description").distinct()
    tables = {
        "sequence": hosts.select("accession", "sequence"),
        "entry": entry,
        "mature": sites.select(F.col("virus_id").alias("ncbi_taxon_id"), F.col("protein").alias("name"), *SITE, "sequence").distinct(),
        "observation": curated.where("kind = 'VH'").select("stable_id", F.col("accession2").alias("accession")),
    }
    return tables, [Check("A4", "entry of several taxa, releases or names", entry.groupBy("accession").count().where("count > 1"))]
