"""Column expressions on text: cleaning, tagged lists, dates, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Fixed value of the entries' format: an inline reference.
CITATION = r"\s*\((?:PubMed|Ref\.)[^()]*\)"


def clean(text: Column) -> Column:
    """One line: each run of white space, of any kind, as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def without_citations(text: Column) -> Column:
    """Text without inline references such as (PubMed:1, PubMed:2) or (Ref.3), on one line."""
    return clean(F.regexp_replace(text, CITATION, ""))


def stripped(cell: Column) -> Column:
    return F.regexp_replace(F.coalesce(cell, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def listed(cell: Column, separator: str = ";") -> Column:
    """The parts of a list cell, stripped, none empty."""
    return F.filter(F.transform(F.split(cell, separator), stripped), lambda x: x != "")


def tagged(cell: Column, prefix: str) -> Column:
    """Values of the parts of a |-list that begin with a prefix."""
    return F.transform(F.filter(F.split(cell, r"\|"), lambda x: x.startswith(prefix)), lambda x: F.substr(x, F.lit(len(prefix) + 1)))


def canonical(accession: Column) -> Column:
    return F.substring_index(accession, "-", 1)


def first_year(dates: list[Column]) -> Column:
    """The first four digits in the first date that has any, else 0."""
    years = [F.nullif(F.regexp_extract(F.coalesce(d, F.lit("")), r"\d{4}", 0), F.lit("")).try_cast("long") for d in dates]
    return F.coalesce(*years, F.lit(0).cast("long"))
