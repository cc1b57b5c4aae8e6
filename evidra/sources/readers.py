"""Readers that turn landed files into DataFrames of text, and name what is wrong with a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.functions.text import clean, first_year, stripped, tagged, without_citations


#: Fixed value of the archive's format: how a detection method is written.
METHOD = r'psi-mi:"(MI:\d{4})"'


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The named columns of a tab-separated file with a header, stripped, no quoting, and the rows of a wrong width.

    Columns are found by name, in every file by its own header. Empty lines are skipped; an empty cell is ''; NULL and \\N are text.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    files: dict[str, list[str]] = {}
    for r in first.collect():  # a row a file
        files.setdefault(r["header"], []).append(r["file"])
    kept = wide = None
    for header, named in sorted(files.items()):
        names = [x.strip() for x in header.split("\t")]
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"{', '.join(named)} has no column {', '.join(missing)}")
        mine = lines.where(F.col("file").isin(named)) if len(files) > 1 else lines
        rows = mine.where((F.col("value") != header) & (F.trim("value") != "")).withColumn("cells", F.split("value", "\t", -1))
        right = F.size("cells") == len(names)
        good = rows.where(right).select(*[stripped(F.get("cells", F.lit(names.index(c)))).alias(c) for c in columns])
        bad = rows.where(~right).select("file", F.col("value").alias("row"), F.lit("wrong number of columns").alias("error"))
        kept, wide = (good, bad) if kept is None else (kept.unionByName(good), wide.unionByName(bad))
    if kept is None:
        raise ValueError(f"{path} has no header")
    return kept, wide


def read_delimited(spark: SparkSession, path: str, width: int, comment: str) -> DataFrame:
    """cells of the lines of a file without header; lines of another width have null cells."""
    lines = spark.read.text(path).where(~F.col("value").startswith(comment) & (F.col("value") != ""))
    cells = F.split("value", "\t", -1)
    return lines.select("value", F.when(F.size(cells) == width, cells).alias("cells"))


def numbers(values: Column) -> Column:
    """The values that are digits: other ids of publications stand for none."""
    return F.filter(values, lambda x: x.rlike(r"^\d+$"))


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    """The interaction archive: 42 columns, of which six are read by position."""
    rows = read_delimited(spark, path, 42, "#")
    at = lambda i: F.get("cells", F.lit(i))
    return rows.select(
        at(0).alias("id_a"), at(1).alias("id_b"), F.regexp_extract_all(at(6), F.lit(METHOD), 1).alias("methods"),
        F.array_distinct(numbers(tagged(at(8), "pubmed:"))).alias("pmids"), tagged(at(13), "intact:").alias("ids"), (at(35) == "true").alias("negative"), F.col("cells").isNull().alias("malformed"),
    )


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """The annotation archive: 17 columns, of which six are read by position; gzip files are read as they are."""
    rows = read_delimited(spark, path, 17, "!")
    at = lambda i: F.get("cells", F.lit(i))
    return rows.select(
        at(1).alias("accession"), clean(at(3)).alias("qualifier"), at(4).alias("go_id"), at(6).alias("evidence_code"), clean(at(14)).alias("assigned_by"),
        F.array_distinct(numbers(tagged(at(5), "PMID:"))).alias("pmids"), F.col("cells").isNull().alias("malformed"),
    )


def read_methods(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """id, name, keep of a method list, and the rows (id, error) whose answer is neither yes nor no or that have no id."""
    rows, wide = read_tsv(spark, path, ["psimi_id", "name", "keep"])
    right = F.col("keep").isin("yes", "no") & (F.col("psimi_id") != "")
    wrong = rows.where(~right).select(F.col("psimi_id").alias("id"), F.lit("keep is neither yes nor no, or no id").alias("error"))
    return rows.where(right).select(F.col("psimi_id").alias("id"), "name", (F.col("keep") == "yes").alias("keep")), wrong.unionByName(wide.select(F.col("row").alias("id"), "error"))


def read_group_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """group, pmid of publication groups, and the rows (id, error) without a group or with a publication that isn't digits."""
    rows, wide = read_tsv(spark, path, ["group", "pmid"])
    right = (F.col("group") != "") & F.col("pmid").rlike(r"^\d+$")
    wrong = rows.where(~right).select(F.col("pmid").alias("id"), F.lit("no group, or a publication that isn't digits").alias("error"))
    return rows.where(right), wrong.unionByName(wide.select(F.col("row").alias("id"), "error"))


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """group, pmid of the sound rows of a list of publication groups."""
    return read_group_list(spark, path)[0]


def read_ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """terms (id, name, namespace, obsolete), aliases (alias, id), edges (child, parent, relation) of a stanza file."""
    stanzas = spark.read.option("lineSep", "\n[").text(path).where(F.col("value").startswith("Term]"))
    lines = stanzas.select(F.split("value", "\n").alias("lines"))
    tag = lambda t: F.transform(F.filter("lines", lambda x: x.startswith(f"{t}: ")), lambda x: F.substring_index(F.substr(x, F.lit(len(t) + 3)), " ! ", 1))
    terms = lines.select(
        F.get(tag("id"), F.lit(0)).alias("id"), F.coalesce(F.get(tag("name"), F.lit(0)), F.lit("")).alias("name"),
        F.coalesce(F.get(tag("namespace"), F.lit(0)), F.lit("")).alias("namespace"), F.array_contains(tag("is_obsolete"), "true").alias("obsolete"),
        tag("alt_id").alias("alt"), tag("is_a").alias("is_a"), F.transform(F.filter(tag("relationship"), lambda x: x.startswith("part_of ")), lambda x: F.substr(x, F.lit(9))).alias("part_of"),
    )
    edge = lambda c: terms.select(F.col("id").alias("child"), F.explode(c).alias("parent"), F.lit(c.upper()).alias("relation"))
    return terms.drop("alt", "is_a", "part_of"), terms.select(F.explode("alt").alias("alias"), "id"), edge("is_a").unionByName(edge("part_of"))


def read_taxonomy(spark: SparkSession, nodes: str, names: str, merged: str) -> tuple[DataFrame, DataFrame]:
    """taxon (tax_id, parent_id, rank, name) and merged (old_id, new_id) of a taxonomy dump."""
    cut = lambda path: spark.read.text(path).select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t", -1).alias("c"))
    at = lambda i: F.get("c", F.lit(i))
    named = cut(names).where(at(3) == "scientific name").select(at(0).cast("long").alias("tax_id"), at(1).alias("name"))
    taxa = cut(nodes).select(at(0).cast("long").alias("tax_id"), at(1).cast("long").alias("parent_id"), at(2).alias("rank"))
    return taxa.join(named, "tax_id", "left"), cut(merged).select(at(0).cast("long").alias("old_id"), at(1).cast("long").alias("new_id"))


def _elements(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """xml of the elements of a name, one to a row; elements of one name don't nest."""
    rows = spark.read.option("lineSep", f"</{tag}>").text(path).where(F.col("value").rlike(f"<{tag}[ >]"))
    return rows.select(F.concat(F.regexp_extract("value", rf"(?s).*(<{tag}[ >].*)", 1), F.lit(f"</{tag}>")).alias("xml"))


def _xpath(xml: str | Column, path: str) -> Column:
    return clean(F.xpath_string(xml, F.lit(path)))


def _publication(rows: DataFrame, document: str, title: list[str], dates: list[str], journal: str) -> DataFrame:
    """A publication of each element; `own` is the part of it whose authors and abstract are its own."""
    at = lambda p: _xpath("xml", f"{document}/{p}")
    part = lambda x, tag: F.regexp_extract_all(x, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?(?<!/)>.*?</{tag}>"), F.lit(0))
    name = lambda x, *tags: F.concat_ws(" ", *[F.nullif(_xpath(x, f"/Author/{t}"), F.lit("")) for t in tags])
    people = F.flatten(F.transform(part("own", "AuthorList"), lambda x: part(x, "Author")))
    named = F.transform(people, lambda x: F.coalesce(F.nullif(name(x, "CollectiveName"), F.lit("")), name(x, "LastName", "Initials")))
    sections = F.flatten(F.transform(part("own", "Abstract"), lambda x: part(x, "AbstractText")))
    told = F.transform(sections, lambda x: F.struct(F.xpath_string(x, F.lit("/AbstractText/@Label")).alias("label"), _xpath(x, "/AbstractText").alias("text")))
    told = F.transform(F.filter(told, lambda s: s["text"] != ""), lambda s: F.when(s["label"] != "", F.concat(s["label"], F.lit(": "), s["text"])).otherwise(s["text"]))
    return rows.select(
        at("PMID" if "Book" in document else "../PMID").alias("pmid"), F.coalesce(*[F.nullif(at(p), F.lit("")) for p in title], F.lit("")).alias("title"),
        first_year([at(p) for p in dates]).alias("year"), at(journal).alias("journal"), F.filter(named, lambda x: x != "").alias("authors"), F.array_join(told, " ").alias("abstract"),
    )


def read_publications(spark: SparkSession, path: str) -> DataFrame:
    """pmid, title, year, journal, authors and abstract of the articles and book articles of publication files.

    An author is a consortium's name or a last name with initials; sections of an abstract stand under their labels. Elements
    without a citation's article or a book's document are left out.
    """
    articles = _elements(spark, path, "PubmedArticle").withColumn("own", F.regexp_extract("xml", r"(?s)<Article[ >].*</Article>", 0)).where("own <> ''")
    books = _elements(spark, path, "PubmedBookArticle").where(F.col("xml").rlike("<BookDocument[ >]"))
    books = books.withColumn("own", F.regexp_replace("xml", r"(?s)<Book[ >].*?</Book>", ""))
    found = _publication(
        articles, "/PubmedArticle/MedlineCitation/Article", ["ArticleTitle"], ["Journal//PubDate", "ArticleDate", "../DateCompleted"], "Journal/Title"
    )
    return found.unionByName(_publication(books, "/PubmedBookArticle/BookDocument", ["ArticleTitle", "Book/BookTitle"], ["Book/PubDate"], "Book/Publisher/PublisherName"))


ENTRY = (
    "results array<struct<primaryAccession:string,entryType:string,comments:array<struct<commentType:string,molecule:string,"
    "texts:array<struct<value:string,evidences:array<struct<source:string,id:string>>>>>>,features:array<struct<type:string,"
    "location:struct<start:struct<value:long>,`end`:struct<value:long>>,description:string>>>>"
)


def _cited(texts: str | Column) -> Column:
    """The publications that texts cite, in order, once each."""
    none = F.array().cast("array<string>")
    ids = F.transform(texts, lambda t: F.coalesce(F.transform(F.filter(t["evidences"], lambda v: v["source"] == "PubMed"), lambda v: v["id"]), none))
    return F.array_distinct(F.filter(F.flatten(ids), lambda x: x.rlike(r"^\d+$")))


def _reviewed(spark: SparkSession, path: str) -> DataFrame:
    """accession, features and the function comments of reviewed protein entries."""
    entries = spark.read.schema(ENTRY).option("multiLine", True).json(path).select(F.explode("results").alias("e"))
    kept = entries.where(F.lower("e.entryType").contains("reviewed") & ~F.lower("e.entryType").contains("unreviewed"))
    return kept.select(F.col("e.primaryAccession").alias("accession"), "e.features", F.filter("e.comments", lambda c: c["commentType"] == "FUNCTION").alias("comments"))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """accession, molecule, text and cited publications of the function comments of reviewed protein entries."""
    texts = _reviewed(spark, path).select("accession", F.explode("comments").alias("c"))
    return texts.select("accession", F.coalesce("c.molecule", F.lit("")).alias("molecule"), F.array_join(F.transform("c.texts", lambda t: t["value"]), " ").alias("text"), _cited("c.texts").alias("pmids"))


def _under(molecule: Column, text: Column) -> Column:
    return F.when(molecule != "", F.concat(F.lit("["), molecule, F.lit("]: "), text)).otherwise(text)


def read_host_functions(spark: SparkSession, path: str) -> DataFrame:
    """accession, function, pmids of reviewed entries: the comments that say anything, in order, without inline references,
    scoped ones under their molecule's name."""
    said = F.transform(
        "comments",
        lambda c: F.struct(
            without_citations(F.array_join(F.transform(c["texts"], lambda t: t["value"]), " ")).alias("text"), F.coalesce(c["molecule"], F.lit("")).alias("molecule"), _cited(c["texts"]).alias("pmids")
        ),
    )
    rows = _reviewed(spark, path).select("accession", F.filter(said, lambda s: s["text"] != "").alias("said")).where(F.size("said") > 0)
    function = F.array_join(F.transform("said", lambda s: _under(s["molecule"], s["text"])), " ")
    return rows.select("accession", function.alias("function"), F.array_distinct(F.flatten(F.transform("said", lambda s: s["pmids"]))).alias("pmids"))


def read_scoped_functions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Texts of whole reviewed entries (accession, comment, place, function, pmids) and of their chains (also name, start,
    stop). A text is a chain's, once for each place of it, if its molecule is a chain whose ends are known; a text of another
    molecule is the entry's, under that name. comment and place give the order."""
    texts = _reviewed(spark, path).select("accession", "features", F.posexplode("comments").alias("comment", "c"))
    texts = texts.select("accession", "features", "comment", F.coalesce("c.molecule", F.lit("")).alias("name"), F.posexplode("c.texts").alias("place", "t"))
    texts = texts.withColumns({"function": without_citations(F.col("t.value")), "pmids": _cited(F.array("t"))}).where("function <> ''")
    here = lambda f: (f["type"] == "Chain") & (F.coalesce(f["description"], F.lit("")) == F.col("name"))
    known = lambda f: f["location"]["start"]["value"].isNotNull() & f["location"]["end"]["value"].isNotNull()
    chains = F.filter("features", lambda f: here(f) & known(f))
    texts = texts.withColumn("chains", F.when(F.col("name") == "", F.lit(None)).otherwise(chains))
    whole = texts.where("coalesce(size(chains), 0) <= 0").select("accession", "comment", "place", _under(F.col("name"), F.col("function")).alias("function"), "pmids")
    located = texts.select("accession", "comment", "place", "name", "function", "pmids", F.explode("chains").alias("f"))
    return whole, located.select("accession", "comment", "place", "name", F.col("f.location.start.value").alias("start"), F.col("f.location.end.value").alias("stop"), "function", "pmids")
