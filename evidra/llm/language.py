"""Language identification by rank-order profiles.

A language's profile holds its most frequent character n-grams (n = 1, 2, 3) by rank, counted over all labelled documents. A document's own most frequent n-grams are compared with each profile: an n-gram counts the difference
of its two ranks, or the profile's size where it is missing there (the out-of-place distance). The language of least
distance wins, the alphabetically first on a tie.

N-grams are of lower-cased letters; everything else is one space. Equal counts rank by length, then code points.

Null text or text without a letter: `und`, score 0; likewise every text where no labelled document was given. A null doc_id
counts as not held out. Very long texts are counted whole; a repeated row is predicted again. An empty
table gives no rows; `predict` ignores columns other than those named, `judged` keeps them, and those named as its own go.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.llm.common import by_bytes, lean, ship, table, with_columns

#: N-grams in a profile, and of a document.
PROFILE = 300
#: Scores are counted by so many steps, and a bound is the lower end of its step.
STEPS = 10_000
#: Of a language's learned documents the share LOW scores under a bound; a text of its language scores MARGIN times that or
#: more. In the given documents the bounds are 0.508 to 0.569, so 0.22 to 0.26 is asked for: random Latin letters of 20 words and more scored
#: 0.221 at most, documents 0.366 and more, a single word of the documents 0.291 and more. A random word or a few can pass.
LOW, MARGIN = 0.05, 0.45
UNKNOWN = "und"
BASE = 1 << 21
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def coded(text: str) -> np.ndarray:
    """Code points of lower-cased letters, with a single space for everything between them and at both ends."""
    x = np.frombuffer(f" {unicodedata.normalize('NFC', text).lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    x = np.where(letters()[x], x, 32)
    space = x == 32
    return x[~(space & np.concatenate([[False], space[:-1]]))]


def every_gram(x: np.ndarray) -> np.ndarray:
    """N-grams of coded text as numbers whose order is length, then code points."""
    one = x[x != 32]
    two = (x[:-1] + 1) * BASE + x[1:]
    three = ((x[:-2] + 1) * BASE + x[1:-1]) * BASE + x[2:]
    return np.concatenate([one, two, three])


def grams(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of coded text and their counts."""
    return np.unique(every_gram(x), return_counts=True)


def top(ids: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, by rank; ids are sorted."""
    return ids[np.argsort(-counts, kind="stable")[:size]]


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles from all documents (doc_id, text, lang) whose text and lang aren't null."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, most=1 << 18):  # the n-grams of a slice take some fifty times its bytes
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, []).append(every_gram(coded(text)))
            for lang, parts in found.items():
                own, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(n)], names=["lang", "gram", "n"])

    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    counts = labelled.mapInArrow(lean(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.select("lang", "gram", rank.alias("rank")).where(F.col("rank") <= size).orderBy("lang", "rank").collect()  # size rows a language
    profiles: dict[str, list[int]] = {}
    for r in rows:
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in profiles.items()}


class Ranker:
    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.languages, self.size = sorted(profiles), size
        self.ids = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        self.ranks = np.full((len(self.ids) + 1, len(self.languages)), -1, np.int64)  # the last row: in no profile
        for k, lang in enumerate(self.languages):
            self.ranks[np.searchsorted(self.ids, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        x = coded(text or "")
        if not self.languages or not (x != 32).any():
            return UNKNOWN, 0.0
        own = top(*grams(x), self.size)
        at = np.searchsorted(self.ids, own)
        at = np.where(self.ids[np.minimum(at, len(self.ids) - 1)] == own, at, len(self.ids))
        ranks = self.ranks[at]
        away = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - np.arange(len(own))[:, None]), self.size)).sum(axis=0)
        best = int(np.argmin(away))
        return self.languages[best], 1.0 - float(away[best]) / (self.size * len(own))


def judged(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """docs with lang_pred and score, 1 less the share of the largest possible distance, after their columns."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        ranker = Ranker(profiles, size)
        found = [ranker.predict(t) for t in texts.to_pylist()]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return with_columns(docs, "lang_pred string, score double", compute)


def least_of(scored: DataFrame) -> dict[str, float]:
    """The score that a text of each language must reach, from all rows of judged that have a lang."""
    steps = scored.where((F.col("lang_pred") != UNKNOWN) & F.col("lang").isNotNull()).groupBy("lang", F.floor(F.col("score") * STEPS).alias("step")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang")  # STEPS rows a language at most
    up_to = F.sum("n").over(own.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    low = steps.withColumns({"up_to": up_to, "all": F.sum("n").over(own)}).where(F.col("up_to") >= F.col("all") * LOW).groupBy("lang").agg(F.min("step").alias("step"))
    return {r["lang"]: r["step"] / STEPS * MARGIN for r in low.collect()}  # a row a language


def least_scores(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> dict[str, float]:
    """least_of documents (doc_id, text, lang)."""
    return least_of(judged(docs.select("text", "lang"), profiles, size))


def reached(scored: DataFrame, least: dict[str, float]) -> DataFrame:
    """Rows of judged whose score reaches that of their predicted language."""
    bound = F.lit(None).cast("double")
    for lang, score in least.items():
        bound = F.when(F.col("lang_pred") == lang, F.lit(score)).otherwise(bound)
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= bound))


def known(docs: DataFrame, profiles: dict[str, np.ndarray], least: dict[str, float], size: int = PROFILE) -> DataFrame:
    """Documents of judged whose score reaches that of their predicted language."""
    return reached(judged(docs, profiles, size), least)


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """Documents (doc_id, text) as doc_id, lang_pred and score."""
    return judged(docs.select("doc_id", "text"), profiles, size).drop("text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out()))
    return predict(docs, profiles).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
