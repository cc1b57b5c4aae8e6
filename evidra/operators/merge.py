"""Joins, precedence, grouping and ranking that merge evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidra.operators.closure import first_by


def first_reason(reasons: list[tuple[str | Column, Column]]) -> Column:
    """The name of the first test that a row fails, null if it passes all; tests run in the given order. A name may be a column."""
    out = None
    for name, fails in reasons:
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return out


def with_reasons(df: DataFrame, reasons: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and the number of rows dropped for each reason, most common first."""
    marked = df.withColumn("drop_reason", first_reason(reasons))
    counts = marked.where("drop_reason IS NOT NULL").groupBy("drop_reason").count().orderBy(F.desc("count"), "drop_reason")
    return marked.where("drop_reason IS NULL").drop("drop_reason"), counts


def precedence(curated: DataFrame, archive: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Curated rows as they are, and distinct archive rows of keys that no curated row has, with their source."""
    left = archive.join(curated.select(key).distinct(), key, "left_anti").select(*columns).distinct()
    return curated.select(*columns, F.lit("curated").alias("source")).unionByName(left.withColumn("source", F.lit("archive")))


def lowest_of_group(rows: DataFrame, pair: list[str], group: str, publication: str) -> DataFrame:
    """Rows with `lowest`, the lowest publication of their pair and group, by number, not by text; null without a group."""
    kind = F.struct(F.col(publication).try_cast("long").alias("number"), F.col(publication).alias("text"))
    lowest = rows.where(F.col(group).isNotNull()).groupBy(*pair, group).agg(F.min(kind)["text"].alias("lowest"))
    return rows.join(lowest, [*pair, group], "left").select(*rows.columns, "lowest")


def first_of_group(rows: DataFrame, pair: list[str], group: str, publication: str) -> DataFrame:
    """Rows without a group, and of each pair and group all rows of its lowest publication."""
    found = lowest_of_group(rows, pair, group, publication)
    return found.where(F.col(group).isNull() | (F.col(publication) == F.col("lowest"))).drop("lowest")


def by_rank(wanted: DataFrame, silos: list[DataFrame], key: str) -> DataFrame:
    """Wanted keys with the row of the first silo that has them; `silo` is null where none has."""
    rows = None
    for rank, silo in enumerate(silos):
        now = silo.withColumn("silo", F.lit(rank))
        rows = now if rows is None else rows.unionByName(now)
    return wanted.join(first_by(rows, [key], ["silo"]), key, "left")


def worklist(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Every key with what to do: `cached` (wanted and known), `fetch` (wanted only), `dropped` (known only)."""
    a = wanted.select(key).distinct().withColumn("_w", F.lit(True))
    b = known.select(key).distinct().withColumn("_k", F.lit(True))
    status = F.when(F.col("_w") & F.col("_k"), "cached").when(F.col("_w"), "fetch").otherwise("dropped")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def as_of(cutoffs: DataFrame, releases: DataFrame) -> DataFrame:
    """cutoffs (cutoff) with the latest release (release) not after it, null if there is none: both in one order of dates, in
    which the last release before a cutoff is the last within its year or else that of the years before, a row a year."""
    rows = cutoffs.select(F.col("cutoff").alias("at"), F.lit(None).cast("date").alias("release"), F.lit(True).alias("asked"))
    rows = rows.unionByName(releases.select("release").distinct().select(F.col("release").alias("at"), "release", F.lit(False).alias("asked"))).withColumn("year", F.year("at"))
    within = Window.partitionBy("year").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    years = rows.groupBy("year").agg(F.max("release").alias("own")).select("year", F.max("own").over(before).alias("earlier"))
    found = rows.withColumn("own", F.max("release").over(within)).where("asked").join(years, "year")
    return found.select(F.col("at").alias("cutoff"), F.coalesce("own", "earlier").alias("release"))


def with_empty(found: DataFrame, key: str) -> DataFrame:
    """Rows by_rank with empty texts and a year of 0 for keys that no silo has."""
    empty = {c: F.coalesce(c, F.lit("" if t == "string" else 0).cast(t)) for c, t in found.dtypes if c not in (key, "silo")}
    return found.withColumns(empty)


def interval_texts(matched: DataFrame, chain_texts: DataFrame, entry_texts: DataFrame) -> DataFrame:
    """Spans as interval_best_match gives them, with their text: of the best chain (entry, c, name, text) the text; of an entry
    (entry, text) its own; of several overlapping chains each text behind its chain's name, in the order of chains; else ''."""
    said = matched.withColumn("c", F.explode_outer(F.split(F.nullif("chains", F.lit("")), ","))).join(chain_texts.withColumn("c", F.col("c").cast("string")), ["entry", "c"], "left")
    one = F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.struct(F.col("c").try_cast("long").alias("c"), F.when(F.col("kind") == "best", F.col("text")).otherwise(F.concat(F.lit("["), "name", F.lit("]: "), "text")).alias("text")))
    grouped = said.groupBy("entry", "start", "stop", "kind").agg(F.array_sort(F.collect_list(one)).alias("parts"))
    out = grouped.join(entry_texts.select("entry", F.col("text").alias("whole")), "entry", "left")
    text = F.when(F.col("kind") == "entry", F.col("whole")).otherwise(F.array_join(F.transform("parts", lambda p: p["text"]), " "))
    return out.select("entry", "start", "stop", "kind", F.coalesce(text, F.lit("")).alias("text"))


#: Entries with more chains than this are joined by position.
DIRECT = 64


def _level(start: str, stop: str) -> Column:
    """The least power of two that is no shorter than an interval, as its exponent."""
    return F.length(F.bin(F.col(stop) - F.col(start))) * (F.col(stop) > F.col(start)).cast("int")


def _bin(position: Column) -> Column:
    return F.call_function("shiftright", position.cast("long"), F.col("level"))


def _bins(rows: DataFrame, start: str, stop: str, least: str, top: Column) -> DataFrame:
    """Rows once for each bin, of 2^level positions, that they reach at every level from their own up to `top`: two at most."""
    at = rows.withColumn("level", F.explode(F.sequence(F.col(least), F.greatest(F.col(least), top))))
    first, last = (_bin(F.col(c)) for c in (start, stop))
    return at.withColumn("bin", F.explode(F.array_distinct(F.array(first, last))))


def overlaps(spans: DataFrame, chains: DataFrame) -> DataFrame:
    """entry, start, stop, c, c_start, c_stop of all spans (entry, start, stop; distinct) and chains (entry, c, c_start, c_stop) of
    one entry that share a position; both ends belong to an interval, and one whose stop lies before its start meets nothing.

    In entries of few chains every span meets every chain. In others intervals meet in bins: an interval has the level of the least
    power of two that covers it, reaches two bins of that or a higher level at most, and two intervals that overlap share the bin of
    their first common position at the higher of their levels. There they meet, once, so the rows of a long entry are spread over
    its positions and their number follows the overlaps, not the product.
    """
    spans, chains = spans.where("start <= stop"), chains.where("c_start <= c_stop")
    long = chains.groupBy("entry").agg(F.count("*").alias("n"), F.max(_level("c_start", "c_stop")).alias("c_top")).where(F.col("n") > DIRECT).drop("n")
    common = (F.col("c_start") <= F.col("stop")) & (F.col("c_stop") >= F.col("start"))
    columns = ["entry", "start", "stop", "c", "c_start", "c_stop"]
    direct = spans.join(long, "entry", "left_anti").join(chains, "entry").where(common).select(*columns)
    wide = spans.join(long, "entry").withColumn("own", _level("start", "stop"))
    tops = wide.groupBy("entry").agg(F.max(F.greatest("own", "c_top")).alias("top"))
    one = _bins(wide.drop("c_top").join(tops, "entry"), "start", "stop", "own", F.col("top"))
    two = _bins(chains.join(tops, "entry").withColumn("c_own", _level("c_start", "c_stop")), "c_start", "c_stop", "c_own", F.col("top"))
    met = one.drop("top").join(two.drop("top"), ["entry", "level", "bin"])
    there = (F.col("level") == F.greatest("own", "c_own")) & (F.col("bin") == _bin(F.greatest("start", "c_start")))
    return direct.unionByName(met.where(common & there).select(*columns))


def interval_best_match(spans: DataFrame, chains: DataFrame, entry_texts: DataFrame, least: float = 0.8) -> DataFrame:
    """spans (entry, start, stop) with the text that describes them: of the chain (entry, c, c_start, c_stop) that overlaps
    best if the shares of common positions reach `least` (the first on a tie); else the entry's own text if it has one span
    only; else the overlapping chains; else nothing."""
    chain = F.col("c").isNotNull()  # least() and greatest() skip nulls: an absent chain isn't a perfect overlap
    asked = spans.select("entry", "start", "stop").distinct()
    met = asked.join(overlaps(asked, chains), ["entry", "start", "stop"], "left")
    common = F.least("stop", "c_stop") - F.greatest("start", "c_start") + 1
    score = F.when(chain, common / (F.greatest("stop", "c_stop") - F.least("start", "c_start") + 1))
    grouped = met.withColumn("score", score).groupBy("entry", "start", "stop").agg(
        F.max_by(F.struct("score", "c"), F.struct(F.col("score"), -F.col("c"))).alias("best"),
        F.array_sort(F.collect_set("c")).alias("over"),
    )
    single = asked.groupBy("entry").agg(F.count("*").alias("n_spans"))
    found = grouped.join(single, "entry").join(entry_texts.select("entry", F.lit(True).alias("has_text")), "entry", "left")
    kind = (
        F.when(F.col("best.score") >= least, "best")
        .when((F.col("n_spans") == 1) & F.col("has_text"), "entry")
        .when(F.size("over") > 0, "overlaps")
        .otherwise("nothing")
    )
    text = F.when(kind == "best", F.col("best.c").cast("string")).when(kind == "overlaps", F.array_join(F.transform("over", lambda c: c.cast("string")), ","))
    return found.select("entry", "start", "stop", kind.alias("kind"), F.coalesce(text, F.lit("")).alias("chains"))
