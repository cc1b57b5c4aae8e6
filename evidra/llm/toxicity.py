"""Toxicity by cumulative-link ordinal regression over sparse features: words and beginnings of words.

Grades 0 < 1 < ... share one weight for each word; the chance of a grade of k or more is sigmoid(w.x - threshold_k) with
thresholds in ascending order. The expected severity is the sum of these chances. It is fitted by full-batch gradient steps
on a bounded sample of labelled documents (chosen by a hash of doc_id), whose features are first sifted on the executors.
There are as many thresholds as the labels have grades above 0; where they only say toxic or not, that is one threshold, and
the severity is the chance of being toxic.

A feature stays if that many of its documents would be graded by chance in fewer than one of all features: with p the share
of graded documents and a that among the feature's df documents, if df * KL(a, p) >= ln(number of features in two documents
or more). So the rule asks for more in a large sample, which tests more features, and for as little as it can in a small one:
there, some five documents that are all graded will do. Where no feature stays, as in a sample of a few documents, nothing
can be learned and every severity is 0.

Null text, or text without letters: severity 0, grade 0. Very long texts are read whole; a feature counts once a text.
Without labels of two grades every severity is 0. Ties: a chance of just one half counts as reached. Repeated doc_ids are
scored each for itself; to learn from, of a repeated doc_id the smallest text counts; labels of a doc_id repeat: the highest
grade counts. Null labels are left out. `score` ignores columns other than those named; `judged` keeps them, and columns
named as its own go. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.llm.common import by_bytes, lean, ship, stored, table, with_columns

#: At most about this many labelled documents are learned from.
TRAIN_ROWS = 20_000
STEPS = 600
WORD = re.compile(r"[^\W\d_]+")
#: Beginnings of words of these lengths are features too, so that inflected and compound forms share weights.
STEMS = (4, 5, 6)


def features(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    return words.union(*[{w[:k] + "-" for w in words if len(w) > k} for k in STEMS])


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def severity(self, text: str | None) -> tuple[float, float, int]:
        """Expected severity, chance of grade 1 or more, and the highest grade that is more likely reached than not."""
        words = features(text or "")
        if not words or not self.thresholds:
            return 0.0, 0.0, 0
        score = sum(sorted(self.weights[w] for w in words & self.weights.keys()))
        chance = 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -500, 500)))
        return float(chance.sum()), float(chance[0]), int((chance >= 0.5).sum())


def fit_cumulative(rows: list[np.ndarray], grades: np.ndarray, width: int, steps: int = STEPS, decay: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of the cumulative-link model, by Adam on the mean log-likelihood."""
    k, n = int(grades.max()), len(rows)
    size = np.array([len(r) for r in rows])
    column, row = np.concatenate([np.zeros(0, np.int64), *rows]), np.repeat(np.arange(n), size)
    share = np.array([np.clip((grades >= g).mean(), 1e-4, 1 - 1e-4) for g in range(1, k + 1)])
    first = np.log(1 / share - 1)
    raw = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    p = np.concatenate([np.zeros(width), raw])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, t = p[:width], p[width] + np.concatenate([[0.0], np.cumsum(np.exp(p[width + 1 :]))])
        score = np.bincount(row, w[column], n)
        above = 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -50, 50)))
        padded = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        chance = np.maximum(padded[np.arange(n), grades] - padded[np.arange(n), grades + 1], 1e-12)
        slope = padded * (1 - padded)
        low, high = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        d_score = (low - high) / chance / n
        d_t = np.zeros(k + 2)
        np.add.at(d_t, grades, -low / chance / n)
        np.add.at(d_t, grades + 1, high / chance / n)
        d_t = d_t[1 : k + 1]
        d_raw = np.concatenate([[d_t.sum()], np.exp(p[width + 1 :]) * np.cumsum(d_t[::-1])[::-1][1:]])
        g = -np.concatenate([np.bincount(column, d_score[row], width), d_raw])
        g[:width] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:width], p[width] + np.concatenate([[0.0], np.cumsum(np.exp(p[width + 1 :]))])


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, grade), grades being integers from 0."""
    ship(docs.sparkSession)
    labels = labels.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    total = labels.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    chosen = labels.where(draw < train_rows / max(total, 1))  # at most about train_rows rows of two numbers
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").alias("grade"))  # one row a doc_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, most=1 << 20):  # the words of a slice take some fifty times its bytes
            words = [sorted(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(words, pa.list_(pa.string()))], names=["doc_id", "grade", "words"])

    kind = dict(docs.dtypes)["doc_id"]
    sample = stored(texts.select("doc_id", "grade", "text").mapInArrow(lean(run), f"doc_id {kind}, grade int, words array<string>"), "toxicity-sample")
    n, n1 = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("grade") > 0).cast("long")), F.lit(0))).first()
    if not n1 or n1 == n:
        return Model()
    words = sample.select("grade", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("df"), F.sum((F.col("grade") > 0).cast("long")).alias("df1"))
    words = stored(words.where("df >= 2").select("word", surprise(F.col("df"), F.col("df1"), n1 / n).alias("surprise")), "toxicity-words")
    bound = math.log(max(words.count(), 2))
    vocabulary = [r["word"] for r in words.where(F.col("surprise") >= bound).orderBy(F.desc("surprise"), "word").select("word").collect()]  # of the sample
    if not vocabulary:
        return Model()
    wanted = docs.sparkSession.createDataFrame(list(enumerate(vocabulary)), "index long, word string")
    hits = sample.select("doc_id", F.explode("words").alias("word")).join(F.broadcast(wanted), "word").groupBy("doc_id").agg(F.sort_array(F.collect_list("index")).alias("index"))
    rows = sample.select("doc_id", "grade").join(hits, "doc_id", "left").select("grade", "index").collect()  # at most about train_rows short rows
    met_by = [np.array(r["index"] or [], np.int64) for r in rows]
    grades = np.array([r["grade"] for r in rows])
    order = sorted(range(len(rows)), key=lambda i: (grades[i], met_by[i].tolist()))
    weights, thresholds = fit_cumulative([met_by[i] for i in order], grades[order], len(vocabulary))
    return Model(dict(zip(vocabulary, weights.tolist())), thresholds.tolist())


def surprise(df: F.Column, df1: F.Column, p: float) -> F.Column:
    """df * KL(df1 / df, p), the least it takes in nats, where the share is over p; else 0."""
    a = df1 / df
    part = lambda x, y: F.when(x > 0, x * F.ln(x / y)).otherwise(0.0)
    return F.when(a > p, df * (part(a, F.lit(p)) + part(1 - a, F.lit(1 - p)))).otherwise(0.0)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """docs with severity, p_toxic, grade and toxic (p_toxic of one half or more) after their columns."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        found = [model.severity(t) for t in texts.to_pylist()]
        severity, chance, grade = (list(x) for x in zip(*found)) if found else ([], [], [])
        return [pa.array(severity, pa.float64()), pa.array(chance, pa.float64()), pa.array(grade, pa.int32()), pa.array([c >= 0.5 for c in chance], pa.bool_())]

    return with_columns(docs, "severity double, p_toxic double, grade int, toxic boolean", compute)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Documents (doc_id, text) as doc_id, severity, p_toxic, grade and toxic."""
    return judged(docs.select("doc_id", "text"), model).drop("text")


def graded(labels: DataFrame) -> DataFrame:
    """Labels (doc_id, toxic) as grades 0 and 1."""
    return labels.select("doc_id", F.col("toxic").alias("grade"))


def fitted(spark: SparkSession, sf_dir: str) -> Model:
    return learn(table(spark, sf_dir, "documents"), graded(table(spark, sf_dir, "labels")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), fitted(spark, sf_dir))
