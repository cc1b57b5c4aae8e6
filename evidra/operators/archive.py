"""Filters of the interaction and annotation archives and of curated lists: the rows kept, and how many were dropped for what.

A row is dropped for the first reason it meets, in the order given here; each reason is counted once a row (of annotations once a
row and publication). Counts are rows (drop_reason, n). Missing cells are nulls or empty lists, and an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidra.functions.text import canonical
from evidra.operators.merge import first_reason, lowest_of_group
from evidra.operators.shared import split

#: Fixed value of the archives' format: how a protein of the sequence database is written.
PROTEIN = "uniprotkb:"
NOT_HOST, REPEATED, NOT_LISTED = "not a protein of the host", "repeated in group", "method not listed: "
RECORD = ["accession1", "accession2", "pmid", "psimi_id", "intact_id"]


def filter_interactions(rows: DataFrame, methods: DataFrame, kept: DataFrame, hosts: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The archive's rows (as readers.read_interactions gives them) of hosts, by methods (declared, method_id) of the ontology that
    the list `kept` (id, name, keep) keeps, of each pair and publication group (group, pmid) only its lowest publication:
    accession1, accession2, pmid, psimi_id, intact_id; the counts, those of methods not kept for each method; and the methods
    (psimi_id, n) that rows use but the list doesn't have, for which nothing should be published."""
    flags = kept.select(F.col("id").alias("method_id"), F.col("name").alias("method_name"), "keep")
    met = rows.withColumn("declared", F.get("methods", F.lit(0))).join(methods, "declared", "left").join(flags, "method_id", "left")
    protein = lambda c: F.coalesce(F.col(c).startswith(PROTEIN), F.lit(False))
    reason = first_reason([
        ("malformed", F.col("malformed")), ("negative", F.coalesce("negative", F.lit(False))), ("not two proteins", ~protein("id_a") | ~protein("id_b")),
        ("no publication", F.coalesce(F.size("pmids"), F.lit(0)) <= 0), ("several publications", F.size("pmids") > 1), ("not one method", F.coalesce(F.size("methods"), F.lit(0)) != 1),
        ("method not in the ontology", F.col("method_id").isNull()), (F.concat(F.lit(NOT_LISTED), "method_id"), F.col("keep").isNull()),
        (F.concat_ws(" ", F.lit("method not kept:"), "method_id", "method_name"), ~F.col("keep")), ("not one id", F.coalesce(F.size("ids"), F.lit(0)) != 1),
    ])
    named = lambda c: canonical(F.substr(c, F.lit(len(PROTEIN) + 1)))
    fields = met.select(
        F.least(named("id_a"), named("id_b")).alias("accession1"), F.greatest(named("id_a"), named("id_b")).alias("accession2"),
        F.get("pmids", F.lit(0)).alias("pmid"), F.col("method_id").alias("psimi_id"), F.get("ids", F.lit(0)).alias("intact_id"), reason.alias("reason"),
    )
    pairs, counts = split(fields, F.col("reason"), "archive")
    unlisted = counts.where(F.col("drop_reason").startswith(NOT_LISTED)).select(F.substr("drop_reason", F.lit(len(NOT_LISTED) + 1)).alias("psimi_id"), "n")
    counts = counts.where(~F.col("drop_reason").startswith(NOT_LISTED))
    known = hosts.select("accession").distinct().withColumn("is_host", F.lit(True))
    of_host = pairs.drop("reason")
    for n in ("1", "2"):
        of_host = of_host.join(known.select(F.col("accession").alias(f"accession{n}"), F.col("is_host").alias(f"host{n}")), f"accession{n}", "left")
    ours, strangers = split(of_host, F.when(F.col("host1").isNull() | F.col("host2").isNull(), NOT_HOST), "archive")
    ours = lowest_of_group(ours.select(*RECORD).distinct().join(groups.select("group", "pmid"), "pmid", "left"), ["accession1", "accession2"], "group", "pmid")
    first, again = split(ours, F.when(F.col("pmid") != F.col("lowest"), F.concat(F.lit(f"{REPEATED} "), F.col("group"), F.lit(": "), F.col("pmid"))), "archive")
    return first.select(*RECORD), counts.unionByName(strangers).unionByName(again), unlisted


def filter_annotations(rows: DataFrame, codes: tuple[str, ...], terms: DataFrame, aliases: DataFrame, excluded: DataFrame, hosts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The annotation archive's rows (as readers.read_annotations gives them) with one of the codes, one row a publication, to
    current terms (id; an alias counts as its smallest id) that aren't excluded (id, reason), of hosts: accession, go_id,
    qualifier, evidence_code, assigned_by, pmid; and the counts."""
    early = first_reason([("malformed", F.col("malformed")), ("not experimental", ~F.coalesce(F.col("evidence_code").isin(*codes), F.lit(False))), ("no publication", F.coalesce(F.size("pmids"), F.lit(0)) <= 0)])
    fields, counts = split(rows, early, "annotations")
    each = fields.withColumn("pmid", F.explode("pmids")).drop("pmids", "malformed")
    own = terms.select(F.col("id").alias("go_id"), F.col("id").alias("current"))
    other = aliases.groupBy(F.col("alias").alias("go_id")).agg(F.min("id").alias("current")).join(own.select("go_id"), "go_id", "left_anti")
    met = each.join(own.unionByName(other), "go_id", "left").join(excluded.select(F.col("id").alias("current"), "reason"), "current", "left")
    met = met.join(hosts.select("accession", F.lit(True).alias("is_host")).distinct(), "accession", "left")
    late = first_reason([("term not in the ontology", F.col("current").isNull()), (F.concat(F.lit("left out: "), "reason"), F.col("reason").isNotNull()), (NOT_HOST, F.col("is_host").isNull())])
    kept, more = split(met, late, "annotations")
    return kept.select("accession", F.col("current").alias("go_id"), "qualifier", "evidence_code", "assigned_by", "pmid").distinct(), counts.unionByName(more)


def method_findings(listed: DataFrame, terms: DataFrame, under: DataFrame, used: DataFrame) -> DataFrame:
    """finding, id, name of what is wrong with a method list (id, name, keep): ids listed twice, ids that are no current term
    (id, name), that aren't `under` (id) the root of detection methods, or bear another name by now; and used methods (id)
    that it doesn't list."""
    now = terms.select("id", F.col("name").alias("current"))
    met = listed.join(now, "id", "left").join(under.select("id", F.lit(True).alias("below")).distinct(), "id", "left")
    reason = first_reason([("no current term", F.col("current").isNull()), ("not a detection method", F.col("below").isNull()), ("renamed", F.col("name") != F.col("current"))])
    found = met.select(reason.alias("finding"), "id", "name").where("finding IS NOT NULL")
    twice = listed.groupBy("id").agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n > 1").select(F.lit("listed twice").alias("finding"), "id", "name")
    open_ = used.select("id").distinct().join(listed.select("id"), "id", "left_anti").join(now, "id", "left")
    return found.unionByName(twice).unionByName(open_.select(F.lit("used but not listed").alias("finding"), "id", F.col("current").alias("name")))


def group_findings(groups: DataFrame) -> DataFrame:
    """finding, key of what is wrong with publication groups (group, pmid): groups of one, publications of several rows."""
    single = groups.groupBy("group").agg(F.countDistinct("pmid").alias("n")).where("n < 2").select(F.lit("group of one").alias("finding"), F.col("group").alias("key"))
    several = groups.groupBy("pmid").count().where("count > 1").select(F.lit("publication twice").alias("finding"), F.col("pmid").alias("key"))
    return single.unionByName(several)


def overlap(curated: DataFrame, archive: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: how many curated rows there are, how many distinct archive rows stay, and how many give way to a curated key."""
    distinct = archive.select(*columns).distinct().join(curated.select(key, F.lit(True).alias("given_way")).distinct(), key, "left")
    counts = distinct.agg(F.count_if(F.col("given_way").isNull()).alias("archive"), F.count_if("given_way").alias("archive_dropped"))
    return curated.agg(F.count("*").alias("curated")).crossJoin(counts)  # one row and one row
