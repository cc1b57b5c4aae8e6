"""Key checks, near names, sequence lookups and text search, for whole tables of requests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_check(requested: DataFrame, nodes: DataFrame) -> DataFrame:
    """requested (requested) against nodes (key, name, id): `known`, `name` (a node's name, its id as hint) or `unknown`."""
    by_key = nodes.select(F.col("key").alias("requested"), F.lit(True).alias("known"))
    by_name = nodes.select(F.col("name").alias("requested"), F.col("id").alias("hint"))
    found = requested.join(by_key, "requested", "left").join(by_name, "requested", "left")
    return found.select("requested", F.when(F.col("known"), "known").when(F.col("hint").isNotNull(), "name").otherwise("unknown").alias("status"), "hint")


def find_names(named: DataFrame, fragments: list[str]) -> DataFrame:
    """kind, key, name, fragment, exact of nodes (kind, key, name) whose name holds one of the fragments asked for, capitals and
    small letters being alike, or is it: one scan of the names. Fragments are no patterns; an empty one is in every name."""
    asked, low = F.array(*[F.lit(f) for f in dict.fromkeys(fragments)]), F.lower("name")
    met = named.withColumn("fragment", F.explode(F.filter(asked, lambda f: F.contains(low, F.lower(f)))))
    return met.select("kind", "key", "name", "fragment", (low == F.lower("fragment")).alias("exact"))


def _letters(text: Column) -> Column:
    """The letters of a text, each with its number among equal ones, so that lists share as many as the texts have in common."""
    letters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.get(F.transform(F.array(letters), lambda x: F.transform(x, lambda c, i: F.concat(c, (i - F.array_position(x, c)).cast("string")))), F.lit(0))


def name_prefixes(texts: DataFrame, text: Column, rarity: DataFrame, keys: list[str], edits: Column) -> DataFrame:
    """keys, token: the edits + 1 rarest letters of each text, by rarity (token, n), one that is in no name being the rarest."""
    each = texts.select(*keys, F.posexplode(_letters(text)).alias("at", "token"), edits.alias("edits")).drop("at").join(rarity, "token", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")))
    first = each.groupBy(*keys).agg(F.slice(order, F.lit(1), F.max("edits") + 1).alias("first"))
    return first.select(*keys, F.explode("first").alias("x")).select(*keys, "x.token")


def near_candidates(asked: DataFrame, names: DataFrame, within: str, least: float = 0.6) -> DataFrame:
    """within, asked, name of all pairs of one taxon that may be similar enough, each once. Of two texts of which the longer has n
    letters, k = (1 - least) n edits leave all but k letters in common; lists that share so many of their letters share one of the
    k + 1 rarest of each. So a text meets only those names that have a rare letter with it, whose lengths fit besides."""
    edits = lambda n: F.floor((1 - least + 5e-7) * n).cast("int")
    low = F.lower("name")
    rarity = names.select(F.explode(_letters(low)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    grown = F.length(low) != F.length("name")  # letters whose small form is longer: such a name is met by all its letters
    mine = name_prefixes(names.select(within, "name").distinct(), low, rarity, [within, "name"], F.when(grown, F.length(low)).otherwise(edits(F.length("name"))))
    theirs = name_prefixes(asked.select(within, "asked").distinct(), F.col("asked"), rarity, [within, "asked"], edits(F.length("asked")))
    longer, shorter = F.greatest(F.length("asked"), F.length("name")), F.least(F.length("asked"), F.length("name"))
    fits = shorter >= (least - 1e-6) * longer  # the distance is the difference of lengths at least
    return theirs.join(mine, [within, "token"]).where(fits).select(within, "asked", "name").distinct()


def near_names(asked: DataFrame, names: DataFrame, within: str, least: float = 0.6, most: int = 3) -> DataFrame:
    """For each asked name (within, asked) the nearest names of the same taxon by 1 - edit distance / longer length."""
    longer = F.greatest(F.length("asked"), F.length("name"))
    met = near_candidates(asked, names, within, least)
    met = met.withColumn("similarity", F.round(1 - F.levenshtein(F.col("asked"), F.lower("name")) / longer, 6)).where(F.col("similarity") >= least)
    rank = F.row_number().over(Window.partitionBy(within, "asked").orderBy(F.desc("similarity"), "name"))
    return met.withColumn("rank", rank).where(F.col("rank") <= most).select(within, "asked", "name", "similarity", "rank")


def sites(wanted: DataFrame, mature: DataFrame, entries: DataFrame) -> DataFrame:
    """Every site of wanted viral proteins (ncbi_taxon_id, name), with its entry."""
    return mature.join(wanted, ["ncbi_taxon_id", "name"], "left_semi").join(entries, "accession")


def observed(stable_ids: DataFrame, observations: DataFrame, entries: DataFrame) -> DataFrame:
    """The observed protein's entry of each description; null where it is unknown."""
    return stable_ids.join(observations, "stable_id", "left").join(entries, "accession", "left").select("stable_id", "accession", "description")


def sequences(requested: DataFrame, sequence: DataFrame) -> DataFrame:
    """requested (position, accession) with length and sequence, in the caller's order; null where unknown."""
    found = requested.join(sequence.select("accession", "sequence"), "accession", "left")
    return found.select("position", "accession", F.length("sequence").alias("length"), "sequence").orderBy("position")


def first_seen(requested: DataFrame, key: str, position: str = "position") -> DataFrame:
    """Each key once, at the first position it is asked for."""
    return requested.groupBy(key).agg(F.min(position).alias(position))


def host_sequences(requested: DataFrame, sequence: DataFrame) -> DataFrame:
    """requested (position, accession), each accession once, with length, sequence and, where it is unknown, an error."""
    found = first_seen(requested, "accession").join(sequence.select("accession", "sequence"), "accession", "left")
    error = F.when(F.col("sequence").isNull(), F.concat(F.lit("no protein "), "accession"))
    return found.select("position", "accession", F.length("sequence").alias("length"), "sequence", error.alias("error"))


def viral_sites(wanted: DataFrame, mature: DataFrame, entries: DataFrame) -> DataFrame:
    """Every site of the wanted viral proteins (ncbi_taxon_id, name), numbered in the order of accession and start: accession,
    strain, release, start, stop, length and sequence, and the error of a protein without one."""
    met = wanted.select("ncbi_taxon_id", "name").distinct().join(mature, ["ncbi_taxon_id", "name"], "left").join(entries, "accession", "left")
    place = F.row_number().over(Window.partitionBy("ncbi_taxon_id", "name").orderBy("accession", "start", "stop"))
    error = F.when(F.col("accession").isNull(), F.concat(F.lit("no protein "), "name"))
    return met.select("ncbi_taxon_id", "name", place.alias("place"), "accession", "strain", "release", "start", "stop", F.length("sequence").alias("length"), "sequence", error.alias("error"))


def observed_proteins(stable_ids: DataFrame, descriptions: DataFrame, observations: DataFrame, mature: DataFrame, entries: DataFrame) -> DataFrame:
    """For each stable_id once the observed viral protein: accession, strain, release, start, stop; else an error: an unknown id,
    one that isn't a VH description (stable_id, kind, ncbi_taxon_id, name), or an entry that holds its protein not just once."""
    sites = mature.groupBy("accession", "ncbi_taxon_id", "name").agg(F.count("*").alias("n"), F.min(F.struct("start", "stop")).alias("at"))
    met = stable_ids.select("stable_id").distinct().join(descriptions, "stable_id", "left").join(observations, "stable_id", "left")
    met = met.join(sites, ["accession", "ncbi_taxon_id", "name"], "left").join(entries, "accession", "left")
    error = (
        F.when(F.col("kind").isNull(), "no such description").when(F.col("kind") != "VH", "not a description of a viral protein")
        .when(F.col("n").isNull(), "no observed protein").when(F.col("n") > 1, "several places in the entry")
    )
    good = lambda c: F.when(error.isNull(), F.col(c)).alias(c.split(".")[-1])
    return met.select("stable_id", *map(good, ("accession", "strain", "release", "at.start", "at.stop")), error.alias("error"))


#: Parts that the terms of a text index are dealt into by a hash, and parts that the documents of a term are dealt into in each.
TERM_BUCKETS, DOCUMENT_PARTS = 64, 4


def bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def postings(docs: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """bucket, term, field, key, tf: how often each term occurs in each field of each document. Terms are the runs of a-z of a
    lower-cased text; an empty one is none. Laid out for publishing: parted by bucket, sorted by term within files."""
    texts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]))
    words = docs.select(key, texts.alias("x")).select(key, "x.field", F.explode(F.split(F.lower("x.text"), "[^a-z]+")).alias("term")).where("term <> ''")
    tf = words.groupBy(key, "field", "term").agg(F.count("*").alias("tf")).withColumn("bucket", bucket(F.col("term")))
    dealt = tf.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(DOCUMENT_PARTS)))
    return dealt.select("bucket", "term", "field", key, "tf").sortWithinPartitions("bucket", "term", "field", key)


def term_counts(index: DataFrame) -> DataFrame:
    """bucket, term, field, df: the number of documents of each term and field of an index (postings)."""
    return index.groupBy("bucket", "term", "field").agg(F.count("*").alias("df"))


def added_postings(index: DataFrame, counts: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index and counts with the postings of further documents."""
    both = counts.unionByName(term_counts(more)).groupBy("bucket", "term", "field").agg(F.sum("df").alias("df"))
    return index.unionByName(more), both


def search_postings(index: DataFrame, counts: DataFrame, n: int, key: str, terms: list[str], weights: dict[str, float]) -> DataFrame:
    """Documents (key) of n that hold a term in a weighted field, scored by the sum of weight (1 + ln tf) ln(1 + n / df). Only the
    buckets of the terms are read: they are computed here and stand in the scan's partition filter."""
    spark = index.sparkSession
    asked = sorted({t for x in terms for t in re.split("[^a-z]+", x.lower()) if t})
    empty = index.select(key).limit(0).withColumn("score", F.lit(0.0))
    if not asked:
        return empty
    buckets = [r[0] for r in spark.createDataFrame([(t,) for t in asked], "term string").select(bucket(F.col("term"))).distinct().collect()]
    wanted = F.col("bucket").isin(buckets) & F.col("term").isin(asked) & F.col("field").isin(list(weights))
    found = index.where(wanted).join(F.broadcast(counts.where(wanted).drop("bucket")), ["term", "field"])  # as many rows as terms and fields asked for
    weight = F.lit(0.0)
    for field, w in weights.items():
        weight = F.when(F.col("field") == field, F.lit(float(w))).otherwise(weight)
    return found.groupBy(key).agg(F.round(F.sum(weight * (1 + F.ln("tf")) * F.ln(1 + F.lit(n) / F.col("df"))), 6).alias("score"))


def text_search(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Documents (doc_id, text) that hold a term, scored by the sum of (1 + ln tf) ln(1 + N / df), without an index."""
    words = docs.select("doc_id", F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("term")).where(F.col("term").isin(terms))
    tf = words.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n"))
    scored = tf.join(F.broadcast(df), "term").crossJoin(F.broadcast(n))  # one row for each term, and one row
    return scored.groupBy("doc_id").agg(F.round(F.sum((1 + F.ln("tf")) * F.ln(1 + F.col("n") / F.col("df"))), 6).alias("score"))
