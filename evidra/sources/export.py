"""Readers of a curation export: one tab-separated file a kind, found by the stem of its name.

Every reader gives its rows, typed, and the errors (file, row, error): rows that break a rule of the file, with the first rule
they break. Which line a row came from isn't known in a distributed scan; the row itself is given instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.sources.readers import read_tsv

#: Fixed values of the export's format.
NO_GENE = "N/A"
PEPTIDE_LENGTHS = (5, 20)

Read = tuple[DataFrame, DataFrame]
Rule = tuple[str, Column]


def export_file(spark: SparkSession, directory: str, stem: str) -> str:
    """The one file of a folder whose name begins with the stem and ends in .tsv."""
    found = sorted(spark.read.option("pathGlobFilter", f"{stem}*.tsv").text(directory).inputFiles())
    if len(found) != 1:
        raise ValueError(f"{directory}: one {stem}*.tsv expected, found {', '.join(found) or 'none'}")
    return found[0]


def required(column: str) -> Rule:
    return f"{column} is empty", F.col(column) == ""


def whole(column: str) -> Rule:
    return f"{column} is not a whole number", F.col(column).try_cast("long").isNull()


def residues(column: str = "sequence") -> Rule:
    return f"{column} is not residues", ~F.upper(column).rlike("^[A-Z]+$")


def read_checked(spark: SparkSession, directory: str, stem: str, columns: list[str], rules: list[Rule]) -> Read:
    """The rows of an export file that pass every rule, all text, and the errors of the others."""
    path = export_file(spark, directory, stem)
    rows, wide = read_tsv(spark, path, columns)
    found = F.coalesce(*[F.when(broken, F.lit(error)) for error, broken in rules])
    marked = rows.withColumn("error", found)
    errors = marked.where("error IS NOT NULL").select(F.lit(path).alias("file"), F.to_json(F.struct(*columns)).alias("row"), "error")
    return marked.where("error IS NULL").drop("error"), wide.unionByName(errors)


def _both(one: Read, two: Read) -> Read:
    return one[0].unionByName(two[0], allowMissingColumns=True), one[1].unionByName(two[1])


def current_methods(terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """declared -> method_id: a term's own id, else the smallest id it is an alias of."""
    own = terms.select(F.col("id").alias("declared"), F.col("id").alias("method_id"))
    other = aliases.groupBy(F.col("alias").alias("declared")).agg(F.min("id").alias("method_id"))
    return own.unionByName(other.join(own, "declared", "left_anti"))


def read_descriptions(spark: SparkSession, directory: str, terms: DataFrame, aliases: DataFrame) -> Read:
    """HH and VH rows: kind, stable_id, pmid, method_id, accession1, accession2, and of VH rows start, stop, release, protein,
    virus_id, virus_name, strain_id, strain_name."""
    common = ["stable_id", "pmid", "psimi_id", "accession1", "accession2"]
    rules = [required(c) for c in common] + [("pmid is not digits", ~F.col("pmid").rlike("^[0-9]+$"))]
    numbers = ["start2", "stop2", "species_ncbi_taxon_id", "strain_ncbi_taxon_id"]
    named = ["protein", "species", "release2"]
    hh = read_checked(spark, directory, "descriptions_hh", common, rules)
    vh, vh_errors = read_checked(spark, directory, "descriptions_vh", [*common, *numbers, *named, "strain"], rules + [whole(c) for c in numbers] + [required(c) for c in named])
    placed = vh.select(
        *common, F.col("start2").cast("long").alias("start"), F.col("stop2").cast("long").alias("stop"), F.col("release2").alias("release"), "protein",
        F.col("species_ncbi_taxon_id").cast("long").alias("virus_id"), F.col("species").alias("virus_name"),
        F.col("strain_ncbi_taxon_id").cast("long").alias("strain_id"), F.col("strain").alias("strain_name"),
    )
    rows, errors = _both((hh[0].withColumn("kind", F.lit("HH")), hh[1]), (placed.withColumn("kind", F.lit("VH")), vh_errors))
    met = rows.withColumnRenamed("psimi_id", "declared").join(current_methods(terms, aliases), "declared", "left")
    unknown = met.where("method_id IS NULL").select(F.concat(F.lit("descriptions_"), F.lower("kind")).alias("file"), F.to_json(F.struct("stable_id", "declared")).alias("row"), F.lit("not a method of the ontology").alias("error"))
    return met.where("method_id IS NOT NULL").drop("declared"), errors.unionByName(unknown)


def read_hosts(spark: SparkSession, directory: str) -> Read:
    """accession, release, name (the accession where there is no gene), description, sequence in capitals."""
    columns = ["accession", "release", "gene_name", "uniprot_name", "sequence"]
    rows, errors = read_checked(spark, directory, "interactors_human", columns, [*map(required, columns), residues()])
    name = F.when(F.col("gene_name") == NO_GENE, F.col("accession")).otherwise(F.col("gene_name"))
    return rows.select("accession", "release", name.alias("name"), F.col("uniprot_name").alias("description"), F.upper("sequence").alias("sequence")), errors


def read_sites(spark: SparkSession, directory: str) -> Read:
    """accession, start, stop, release, description and sequence, of exactly the span's length."""
    columns = ["accession", "start", "stop", "release", "uniprot_name", "sequence"]
    length = F.col("stop").try_cast("long") - F.col("start").try_cast("long") + 1
    rules = [*map(required, columns), whole("start"), whole("stop"), ("sequence is not of the span's length", F.length("sequence") != length)]
    rows, errors = read_checked(spark, directory, "interactors_viral", columns, rules)
    return rows.select("accession", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "release", F.col("uniprot_name").alias("description"), F.upper("sequence").alias("sequence")), errors


def read_peptides(spark: SparkSession, directory: str) -> Read:
    """Mappings of 5 to 20 residues of both files: stable_id, sequence, kind and accession of the source, its span (0 and 0 for
    a human one) and the kind of the target. Letters are tested in every mapping, the other rules in those of these lengths."""
    is_peptide = F.length("sequence").between(*PEPTIDE_LENGTHS)
    later = lambda rule: (rule[0], is_peptide & rule[1])
    ids = ["stable_id", "accession"]
    first = [required("sequence"), residues(), *[later(required(c)) for c in ids]]
    human, human_errors = read_checked(spark, directory, "mappings_h", [*ids, "sequence", "target"], [*first, later(("target is neither h nor v", ~F.col("target").isin("h", "v")))])
    viral, viral_errors = read_checked(spark, directory, "mappings_v", [*ids, "sequence", "start", "stop"], [*first, later(whole("start")), later(whole("stop"))])
    shape = lambda df, kind, start, stop, target: df.where(is_peptide).select(
        "stable_id", F.upper("sequence").alias("sequence"), F.lit(kind).alias("kind"), "accession", start.cast("long").alias("start"), stop.cast("long").alias("stop"), target.alias("target")
    )
    zero = F.lit(0)
    return _both(
        (shape(human, "h", zero, zero, F.col("target")), human_errors),
        (shape(viral, "v", F.col("start"), F.col("stop"), F.lit("h")), viral_errors),
    )


def read_cited(spark: SparkSession, directory: str, kind: str) -> DataFrame:
    """pmid of every row of one kind (hh or vh) that has one, not tested further."""
    return read_tsv(spark, export_file(spark, directory, f"descriptions_{kind}"), ["pmid"])[0].where("pmid <> ''")


def updated_provenance(old: DataFrame, new: DataFrame) -> DataFrame:
    """dataset, url, fetched, release: each new row in place of the old one of its dataset, in the order of datasets."""
    columns = ["dataset", "url", "fetched", "release"]
    return old.select(*columns).join(new.select("dataset"), "dataset", "left_anti").unionByName(new.select(*columns)).orderBy("dataset")
