"""Ranked lexical search over hashed max-sketches.

An index keeps of every document a sketch: an array of bytes, some eight for each distinct term, in which every term is hashed to
four places and each place holds the largest number of occurrences among its terms. The least of a term's four places is never
below its occurrences, and the score grows with these, so the sketch alone gives an upper bound of a document's score. Queries are
looked up together, in blocks. A first scan takes the documents of the highest bounds of each query and scores them by their texts;
the k-th of these scores is a threshold that no result is below. A second scan takes all documents whose bound reaches it, and they
are scored exactly, so the result is that of scoring every document.

Terms are runs of letters and digits of ASCII and of all other characters, A-Z being lower-cased. Scores are whole numbers: of each
query's term, repeats included, w * ((1000000000 * tf) div (1000 * tf + 12 * m)), w = floor(1000 ln((2 N + 2) / (2 df + 1))),
m = 75 + (25 n N) div L, with N documents that have a term, L terms in them, n terms in the document.

Every row is a document; rows without a term are none, be their text null, empty or only marks. Rows that repeat a doc_id or a text
count and rank each for itself; a null doc_id ranks behind all others of its score. Of equal scores the smaller doc_id ranks first.
Every query row is a query of its own; one without a known term has no result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.llm.common import by_bytes, lean, met, shared_dir, ship, stored, table, text_lists

#: Places of a sketch for each distinct term, at least, and places that a term is hashed to.
PLACES, HASHES = 8, 4
#: Sketches have 64 places at least, and at most so many.
WIDEST = 1 << 22
#: An occurrence count that stands for all higher ones.
MANY = 255
#: Queries that are looked up together.
BLOCK = 256
#: Documents of the highest bounds that a query's threshold is taken from, times k.
AHEAD = 3
#: Terms whose hashes, or partial counts, a task keeps.
TERMS_KEPT = 300_000
#: Largest value of the part of a score that depends on the document.
MOST = 1_000_000
_SPLIT = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPLIT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in _SPLIT)


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_SPLIT).split()


class Hashes(dict):
    """64-bit hashes of terms, the same in every process."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= TERMS_KEPT:
            self.clear()
        self[term] = value = int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little")
        return value


def places(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """Where each of the terms is hashed to in a sketch of `width` places, a power of two."""
    high, low = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return [((high + np.uint64(k) * low) & np.uint64(width - 1)).astype(np.int64) for k in range(HASHES)]


def sketch(counts: Counter, hashes: Hashes) -> bytes:
    """The largest occurrence count of the terms at each place."""
    wanted = PLACES * len(counts)
    width = min(WIDEST, max(64, 1 << (wanted - 1).bit_length()))
    own = np.fromiter([hashes[t] for t in counts], np.uint64, len(counts))
    tf = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MANY).astype(np.uint8)
    out = np.zeros(width, np.uint8)
    order = np.argsort(tf, kind="stable")
    for value in np.unique(tf).tolist():
        some = own[order[np.searchsorted(tf[order], value) : np.searchsorted(tf[order], value, side="right")]]
        for at in places(some, width):
            out[at] = value  # values ascend, so the largest stays
    return out.tobytes()


@dataclass(frozen=True)
class Index:
    """What a search needs beside the texts: sketches (key, n, sketch), document frequencies in parts (term, df), N and L."""

    sketches: DataFrame
    frequencies: DataFrame
    n_docs: int
    n_terms: int


KEY = "xxhash64(doc_id, text) AS key"  # tells documents apart; should two share one, both are scored
ROW = "kind int, key long, n long, sketch binary, term string, df long"


def build_index(docs: DataFrame) -> Index:
    """The index of docs (doc_id, text), written to the shared folder in one pass over the texts."""
    spark = docs.sparkSession
    ship(spark)
    names = [x.split()[0] for x in ROW.split(", ")]

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        kinds = dict(kind=pa.int32(), key=pa.int64(), n=pa.int64(), sketch=pa.binary(), term=pa.string(), df=pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()], names=names)

    def counted(df: Counter) -> pa.RecordBatch:
        return rows(kind=[1] * len(df), term=[t.decode() for t in df], df=list(df.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, df = Hashes(), Counter()
        for batch in by_bytes(batches):
            keys, ns, sketches = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), text_lists(batch)):
                words = terms_of(text)
                if words:
                    counts = Counter(words)
                    df.update(counts.keys())
                    keys.append(key)
                    ns.append(len(words))
                    sketches.append(sketch(counts, hashes))
            yield rows(kind=[0] * len(keys), key=keys, n=ns, sketch=sketches)
            if len(df) > TERMS_KEPT:
                yield counted(df)
                df = Counter()
        if df:
            yield counted(df)

    path = shared_dir(spark, "sketches")
    docs.selectExpr(KEY, "text").mapInArrow(lean(run), ROW).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    read = spark.read.schema(ROW).parquet(path)
    sketches = read.where("kind = 0").select("key", "n", "sketch")
    n_docs, n_terms = sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(sketches, read.where("kind = 1").select("term", "df"), n_docs, n_terms)


class Block:
    """Queries with the weights of their terms; what tasks need to bound and to score documents."""

    def __init__(self, texts: list[str], weights: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.queries = [{t: (weights[t], c) for t, c in Counter(terms_of(x)).items() if t in weights} for x in texts]
        self.terms = list(dict.fromkeys(t for q in self.queries for t in q))
        number = {t: i for i, t in enumerate(self.terms)}
        self.factor = np.zeros((len(self.terms), len(texts)))  # weight times repeats; sums of scores stay below 2^53
        for j, q in enumerate(self.queries):
            for t, (w, c) in q.items():
                self.factor[number[t], j] = w * c
        hashes = Hashes()
        self.hashes = np.array([hashes[t] for t in self.terms], np.uint64)
        self.at: dict[int, list[np.ndarray]] = {}

    def length(self, n: int) -> int:
        return 75 + 25 * n * self.n_docs // self.n_terms

    def bounds(self, n: int, kept: bytes) -> np.ndarray:
        """Upper bounds of a document's score for every query."""
        places_of = np.frombuffer(kept, np.uint8)
        if len(places_of) not in self.at:
            self.at[len(places_of)] = places(self.hashes, len(places_of))
        most = np.minimum.reduce([places_of[p] for p in self.at[len(places_of)]]) if self.terms else np.zeros(0, np.uint8)
        some = np.flatnonzero(most)
        tf = most[some].astype(np.int64)
        part = 1_000_000_000 * tf // (1000 * tf + 12 * self.length(n))
        return np.where(tf == MANY, MOST, part).astype(np.float64) @ self.factor[some]

    def score(self, j: int, counts: Counter, n: int) -> int:
        """The exact score of a document for a query."""
        m = 12 * self.length(n)
        return sum(w * c * (1_000_000_000 * tf // (1000 * tf + m)) for t, (w, c) in self.queries[j].items() if (tf := counts.get(t)))


def highest(index: Index, block: Block, k: int) -> DataFrame:
    """item, key, bound: of each task and query the k documents of the highest bounds above 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple[float, int]]] = [[] for _ in block.queries]
        least = np.zeros(len(heaps))
        for batch in batches:
            for key, n, kept in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "sketch"))):
                bounds = block.bounds(n, kept)
                for j in np.flatnonzero(bounds > least).tolist():
                    if len(heaps[j]) < k:
                        heapq.heappush(heaps[j], (bounds[j], key))
                    else:
                        heapq.heapreplace(heaps[j], (bounds[j], key))
                    if len(heaps[j]) == k:
                        least[j] = heaps[j][0][0]
        found = [(j, key, int(bound)) for j, heap in enumerate(heaps) for bound, key in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * 3, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "key", "bound"])

    return index.sketches.mapInArrow(lean(run), "item int, key long, bound long")


def reaching(index: Index, block: Block, thresholds: np.ndarray) -> DataFrame:
    """key, items: of each document the queries of which its bound is above 0 and reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.maximum(thresholds, 1)
        for batch in batches:
            keys, items = [], []
            for key, n, kept in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "sketch"))):
                good = np.flatnonzero(block.bounds(n, kept) >= least)
                if len(good):
                    keys.append(key)
                    items.append(good.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(items, pa.list_(pa.int32()))], names=["key", "items"])

    return index.sketches.mapInArrow(lean(run), "key long, items array<int>")


def scored(docs: DataFrame, wanted: DataFrame, block: Block, k: int) -> DataFrame:
    """item, doc_id, score: exact scores above 0 of documents for the queries that `wanted` (key, items; stored) names, of each
    task and query the k first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[int, bool, int]]] = {}
        for batch in by_bytes(batches):
            for doc_id, text, items in zip(batch.column("doc_id").to_pylist(), text_lists(batch), batch.column("items").to_pylist()):
                words = terms_of(text)
                counts = Counter(words)
                for j in items:
                    score = block.score(j, counts, len(words))
                    if score > 0:
                        heap, now = heaps.setdefault(j, []), (score, doc_id is not None, -(doc_id or 0))
                        if len(heap) < k:
                            heapq.heappush(heap, now)
                        elif now > heap[0]:
                            heapq.heapreplace(heap, now)
        found = [(j, -negative if has else None, score) for j, heap in heaps.items() for score, has, negative in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found)) or [()] * 3, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    rows = met(docs.selectExpr("doc_id", "text", KEY), wanted, "key", "doc_id")
    return rows.select("doc_id", "text", "items").mapInArrow(lean(run), "item int, doc_id long, score long")


#: Parts of a query's rows that are ranked before they meet.
DEALS = 16


def first_of(rows: DataFrame, k: int, *order) -> DataFrame:
    """The k first rows of each item with their rank: first of each of DEALS parts, then of these."""
    part = Window.partitionBy("item", "deal").orderBy(*order)
    some = rows.withColumn("deal", F.spark_partition_id() % DEALS).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("deal")


def search(index: Index, docs: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of docs (doc_id, text; those of the index) that score highest for each of the
    queries (item_id, text), if their score is above 0."""
    spark = docs.sparkSession
    kinds = dict(queries.dtypes)
    empty = spark.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id long, score long")
    blocks = -(-queries.count() // BLOCK)
    if not blocks or not index.n_docs:
        return empty
    dealt = queries.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"))
    out = []
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).collect()  # a block of queries
        if rows:
            out.append(_search_block(index, docs, rows, k, kinds["item_id"]))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def _search_block(index: Index, docs: DataFrame, rows: list, k: int, id_type: str) -> DataFrame:
    spark = docs.sparkSession
    texts = [r.text or "" for r in rows]
    asked = spark.createDataFrame([(t.decode(),) for t in {t for x in texts for t in terms_of(x)}], "term string")
    known = index.frequencies.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = {r.term.encode(): math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * r.df + 1))) for r in known}
    block = Block(texts, weights, index.n_docs, index.n_terms)
    ahead = first_of(highest(index, block, AHEAD * k), AHEAD * k, F.desc("bound"), "key").groupBy("key").agg(F.collect_set("item").alias("items"))
    best = first_of(scored(docs, stored(ahead, "ahead"), block, k), k, F.desc("score"), F.asc_nulls_last("doc_id"))
    thresholds = np.zeros(len(rows))
    for r in best.where(F.col("rank") == k).select("item", "score").collect():
        thresholds[r.item] = r.score
    wanted = stored(reaching(index, block, thresholds).groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "wanted")
    found = first_of(scored(docs, wanted, block, k), k, F.desc("score"), F.asc_nulls_last("doc_id"))
    ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item int, item_id {id_type}")
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
    return search(build_index(docs), docs, table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
x AS (SELECT row_number() OVER () AS row, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM x),
i AS (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM x) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, docs),
p AS (SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS part FROM tf JOIN w USING (term) JOIN x USING (row), s),
f AS (SELECT item, item_id, row, sum(part)::BIGINT AS score FROM i JOIN p USING (term) GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM f JOIN x USING (row) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""
