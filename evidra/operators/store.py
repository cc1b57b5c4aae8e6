"""Sinks: sorted text tables, node and edge tables whose ends must exist, claims and annotations fanned out to their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from evidra.operators.audit import BrokenRules, dangling


def write_table(df: DataFrame, path: str) -> int:
    """Write a tab-separated table with header in the order of all its columns; gives the number of rows written.

    Cells hold neither tabs nor line ends (see functions.text.clean); a null becomes an empty cell.
    """
    seen = Observation()
    counted = df.orderBy(*df.columns).observe(seen, F.count(F.lit(1)).alias("n"))  # behind the sort, whose sampling reads df too
    counted.write.option("sep", "\t").option("header", True).option("quote", "\u0000").option("emptyValue", "").option("nullValue", "").csv(path)
    return seen.get["n"]


def write_nodes(df: DataFrame, columns: list[str], path: str) -> None:
    """Write the declared columns of a node table, no others."""
    df.select(*columns).write.parquet(path)


def write_edges(edges: DataFrame, ends: list[tuple[list[str], DataFrame, list[str]]], path: str, once: list[str] | None = None) -> None:
    """Write edges whose ends all match a node, each end given as (columns, nodes, key of the nodes); with `once`, one edge for
    each value of these columns. Fails, writing nothing, with five examples if an end matches no node."""
    for columns, nodes, key in ends:
        lost = dangling(edges, columns, nodes, key).limit(5).collect()
        if lost:
            raise BrokenRules(f"{path}: {', '.join(columns)} of no node: {lost}")
    (edges.dropDuplicates(once) if once else edges).write.parquet(path)


def claim_tables(counted: DataFrame, descriptions: DataFrame) -> dict[str, DataFrame]:
    """Tables of claims (kind, a, b and counters; a and b protein references) and their descriptions (description_id, kind, a, b,
    pmid, ...). A claim has two INVOLVES rows, equal ones if both ends are one protein, and one INTERACTS_WITH row."""
    sides = F.explode(F.array("a", "b"))
    return {
        "interaction": counted,
        "involves": counted.select("kind", "a", "b", sides.alias("protein")),
        "interacts_with": counted.drop("kind"),
        "description": descriptions.drop("kind", "a", "b", "pmid"),
        "supports": descriptions.select("description_id", "kind", "a", "b"),
        "description_reported_in": descriptions.select("description_id", "pmid"),
    }


def annotation_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Tables of annotations from rows (accession, go_id, qualifier, pmid, evidence_code), repeated rows counting once: one
    annotation a protein, term and qualifier, and for each of its publications the sorted list of its codes."""
    key = ["accession", "go_id", "qualifier"]
    cited = rows.groupBy(*key, "pmid").agg(F.array_sort(F.collect_set("evidence_code")).alias("evidence_codes"))
    return {"annotation": rows.select(*key).distinct(), "annotation_reported_in": cited}


def build_report(tables: dict[str, DataFrame]) -> DataFrame:
    """name, count of every table, and their total."""
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("name"), "count")
        out = one if out is None else out.unionByName(one)
    return out.unionByName(out.agg(F.sum("count").alias("count")).select(F.lit("total").alias("name"), "count"))
