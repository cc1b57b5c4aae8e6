"""Nearest neighbours by additive quantisation, with bounds that make the result exact.

A vector is coded as the sum of one full-dimensional codeword from each of several codebooks. The codebooks are trained in
turn by k-means on what the ones before leave over, on a bounded sample; a vector is encoded by beam search over all
books. With the norm of each sum stored, the squared distance of a query to it is, up to a constant, the norm less twice a
few entries of the query's lookup table. The first codeword is a vector's cell: a query looks at the coded vectors of the
PROBE cells nearest to it, and of more while these hold too few. The exact distances of the best estimates, in double
precision and in the order of the components, give a bound that the k nearest keep.

How far a vector is from its sum of codewords, and from its cell, is stored as well. By the triangle inequality a cell can be
left out if it lies beyond the bound by more than its farthest vector, and a vector if its sum does by more than its own
distance from it, rounding counted in; all others are checked exactly. So the result is that of brute force whatever the
vectors: where codes fit badly (many components, sizes that differ by magnitudes), more are checked, up to all.

Vectors and their codes are dealt by a hash into chunks and queries into blocks, both of bounded size; a chunk and a block
meet in one task, which gives the k nearest of the chunk. Vectors are shuffled once for some ten thousands of queries.

Equal vectors form a class that is coded once, under its smallest vec_id: they are equally far from any query, so they can't
crowd out others, and the nearest classes give their rows back at the end. Of a class only the k + 1
smallest vec_ids can be among the k nearest of any query, ties going to the smaller vec_id, so these are all that it keeps.

Vectors that are null, zero, of another length than most (the shorter one if as many), or hold null or non-finite
components take no part. Repeated vec_ids are rows of their own: each row that is a query has a list of its own, under its
vec_id, equal rows equal lists; and a query leaves out every row of its own vec_id. Ties go to the smaller vec_id. With fewer
candidates than asked for, all are returned. Components of any size are allowed: codes are of vectors scaled by the usual
norm, and a distance whose square overflows is scaled before it is squared. An empty table gives no rows; other columns,
whatever their names, are ignored. Texts play no part; of very long vectors a chunk holds fewer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.llm.common import ship, stored, table

BOOKS, WORDS, BEAM, ROUNDS = 32, 256, 3, 6
#: At most about this many vectors, chosen by a hash of vec_id, train the codebooks.
TRAIN_ROWS = 16_384
#: Cells that a query looks at first, and classes of equal vectors whose exact distances give its first bound in a chunk.
PROBE, RERANK = 16, 128
#: Classes of a chunk (fewer where CHUNKS wouldn't be reached or vectors are long), and the bounds of a block of queries.
CHUNK, LEAST_QUERIES, MOST_QUERIES = 1 << 17, 256, 1 << 16
#: A table of some size has so many chunks or more; a chunk or a block has at most about so many components.
CHUNKS, LEAST_CHUNK, COMPONENTS = 16, 4096, 1 << 23
#: Vectors longer than this many usual norms are shortened for coding.
LONGEST = 1e15


def usable(vectors: DataFrame, is_query: F.Column, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows (id, v, asked) that take part; v is an array of floats or doubles, all of one length."""
    kind = vectors.schema[column].dataType.elementType.simpleString()
    v = F.col(column) if kind in ("float", "double") else F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def classed(rows: DataFrame, k: int) -> DataFrame:
    """Rows (id, v) with `class` and `next`, the smallest ids of their equal vectors, and whether a row speaks for its class; of each class
    those of its k + 1 smallest ids. The filter on a rank goes before the shuffle too, so a vector that many rows share arrives
    as a few rows a task."""
    same = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("place", F.dense_rank().over(same)).where(F.col("place") <= k + 1)
    few = few.withColumns({"class": F.first("id").over(same), "speaks": F.row_number().over(same) == 1})
    return few.withColumn("next", F.min(F.when(F.col("place") == 2, F.col("id"))).over(Window.partitionBy("v"))).drop("place")


def asked_of(rows: DataFrame) -> DataFrame:
    """The queries: qkey, query_id, q and how many rows are this same query."""
    return rows.where("asked").groupBy(F.col("id").alias("query_id"), F.col("v").alias("q")).agg(F.count("*").alias("times")).withColumn("qkey", F.xxhash64("query_id", "q"))


def scaled(v: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times scale, those beyond LONGEST shortened to it, and whether they were."""
    v = v.astype(np.float64)
    top = np.maximum(np.abs(v).max(axis=1, keepdims=True), 1e-300)
    beyond = top > LONGEST / scale
    return np.where(beyond, v / top * LONGEST, v * np.where(beyond, 0.0, scale)), beyond[:, 0]


def stacked(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(n, -1)


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = np.concatenate([np.argmin((centre**2).sum(1) - 2 * part @ centre.T, axis=1) for part in np.array_split(x, max(1, len(x) // 4096))])
        count = np.bincount(near, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centre


def beam_encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes of vectors, a word of each book."""
    m, k, d = books.shape
    n = len(x)
    codes, rests = np.zeros((n, 1, 0), np.int64), x[:, None, :]
    for book in books:
        # what a rest r leaves after a codeword c: |r|^2 - 2 r.c + |c|^2; rests, unlike sums, shrink and so do rounding errors
        total = ((rests**2).sum(2)[:, :, None] + (book**2).sum(1) - 2 * (rests.reshape(-1, d) @ book.T).reshape(n, -1, k)).reshape(n, -1)
        best = np.empty((n, min(beam, total.shape[1])), np.int64)
        for j in range(best.shape[1]):  # for a few of many, faster than a partition
            best[:, j] = np.argmin(total, axis=1)
            total[np.arange(n), best[:, j]] = np.inf
        before, word = best // k, best % k
        codes = np.concatenate([np.take_along_axis(codes, before[:, :, None], 1), word[:, :, None]], axis=2)
        rests = np.take_along_axis(rests, before[:, :, None], 1) - book[word]
    return codes[np.arange(n), np.argmin((rests**2).sum(2), axis=1)]


def train(rows: DataFrame, seed: int = 7) -> tuple[np.ndarray, float] | None:
    """Codebooks (books, words, dim) from a bounded sample of rows (id, v), and the scale of what they code."""
    n = rows.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit("codebook")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(draw < TRAIN_ROWS / n).orderBy("id").limit(2 * TRAIN_ROWS)  # repeated ids are drawn together
    sample = drawn.select("v").toPandas()["v"]
    if not len(sample):
        sample = rows.orderBy("id").limit(TRAIN_ROWS).select("v").toPandas()["v"]
    x = np.stack(sample.to_list()).astype(np.float64)
    top = np.abs(x).max(axis=1, keepdims=True)
    usual = float(np.median(top[:, 0] * np.sqrt(((x / top) ** 2).sum(axis=1))))
    scale = 1 / min(max(usual, 1e-290), 1e290)
    rest = scaled(x, scale)[0].astype(np.float32)
    rng, books = np.random.default_rng(seed), []
    for _ in range(BOOKS):
        book = kmeans(rest, min(WORDS, max(1, len(rest))), ROUNDS, rng)
        near = np.concatenate([np.argmin((book**2).sum(1) - 2 * part @ book.T, axis=1) for part in np.array_split(rest, max(1, len(rest) // 4096))])
        rest = rest - book[near]
        books.append(book)
    return np.stack(books), scale


#: What is stored of a vector: the squared norm of the sum of its words and the sum of their norms, its distances from that sum
#: and from its first word.
MEASURES = ("norm", "reach", "rest", "away")


def index(rows: DataFrame, books: np.ndarray, scale: float) -> DataFrame:
    """Coded vectors: rows (id, next, v) with a byte for each book and MEASURES, of vectors times scale."""
    words, sizes = books.astype(np.float64), np.sqrt((books.astype(np.float64) ** 2).sum(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                x, beyond = scaled(stacked(batch.column("v"), batch.num_rows), scale)
                codes = beam_encode(x.astype(np.float32), books)
                total, reach = np.zeros_like(x), np.zeros(len(x))
                for book, size, code in zip(words, sizes, codes.T):
                    total += book[code]
                    reach += size[code]
                rest, away = (np.where(beyond, np.inf, np.sqrt(((x - y) ** 2).sum(1))) for y in (total, words[0][codes[:, 0]]))
                coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(books)), batch.num_rows, [None, pa.py_buffer(codes.astype(np.uint8).tobytes())])
                measures = [pa.array(a) for a in ((total**2).sum(1), reach, rest, away)]
                yield pa.RecordBatch.from_arrays([*batch.columns, coded.cast(pa.binary()), *measures], names=[*batch.schema.names, "code", *MEASURES])

    kind = rows.schema["v"].dataType.simpleString()
    return rows.select("id", "next", "v").mapInArrow(run, f"id long, next long, v {kind}, code binary, " + ", ".join(f"{m} double" for m in MEASURES))


class Lookup:
    """The nearest of a chunk of coded vectors, cell by cell."""

    def __init__(self, books: np.ndarray, scale: float, chunk: pa.Table):
        m, k, dim = books.shape
        codes = np.frombuffer(b"".join(chunk.column("code").to_pylist()), np.uint8).reshape(-1, m)
        ids = chunk.column("id").to_numpy()
        order = np.lexsort((ids, codes[:, 0]))
        self.scale, self.ids, self.v = scale, ids[order], stacked(chunk.column("v").combine_chunks(), len(ids))[order]
        self.lone = chunk.column("next").is_null().to_numpy()[order]
        self.next = chunk.column("next").fill_null(0).to_numpy()[order]
        self.norm, self.reach, self.rest, away = (chunk.column(c).to_numpy()[order] for c in MEASURES)
        self.entries = np.ascontiguousarray((codes[order].astype(np.int32) + k * np.arange(m, dtype=np.int32)).T)
        self.cells = codes[order, 0]
        self.size, self.radius = np.bincount(self.cells, minlength=k), np.full(k, -np.inf)
        np.maximum.at(self.radius, self.cells, away)
        self.flat = books.reshape(m * k, dim).astype(np.float64)
        self.first = (self.flat[:k] ** 2).sum(1)
        self.error = (dim + 2 * m + 16) * 2.3e-16  # of sums of so many products, as a share of the largest they could be

    def beyond(self, square: np.ndarray, own: float, reach: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """The least distance of a query of norm `own` to vectors within `rest` of points at a squared distance computed from numbers of size `reach`."""
        return np.sqrt(np.maximum(square - self.error * (own + reach) ** 2, 0)) - rest - self.error * (own + reach + rest)

    def estimates(self, at: np.ndarray, row: np.ndarray, own: float) -> np.ndarray:
        found = self.norm[at] + own**2
        for entries in self.entries:
            found -= 2 * row[entries[at]]
        return found

    def exact(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """As `distance` computes it, component by component."""
        found = [np.zeros(0)]
        for piece in np.array_split(at, max(1, len(at) * len(q) >> 18)):
            parts = np.ascontiguousarray((self.v[piece].astype(np.float64) - q).T)
            plain = rooted(parts)
            over = np.isinf(plain)
            if over.any():
                longest = np.abs(parts[:, over]).max(axis=0)
                plain[over] = np.nan_to_num(longest * rooted(parts[:, over] / longest), nan=np.inf)
            found.append(plain)
        return np.concatenate(found)

    def nearest(self, queries: np.ndarray, owners: np.ndarray, k: int, rerank: int, probe: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each query the k nearest classes that have a row of another id than its owner's: the classes, the smallest such ids and the distances."""
        with np.errstate(over="ignore", invalid="ignore"):
            for i in range(0, len(queries), 256):
                y, long = scaled(queries[i : i + 256], self.scale)
                for n, (row, own) in enumerate(zip(y @ self.flat.T, np.sqrt((y**2).sum(1)))):
                    yield self._nearest(queries[i + n].astype(np.float64), owners[i + n], row, np.inf if long[n] else own, k, rerank, probe)

    def _nearest(self, q: np.ndarray, owner: int, row: np.ndarray, own: float, k: int, rerank: int, probe: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        other = ~(self.lone & (self.ids == owner))
        to_cell = self.first + own**2 - 2 * row[: len(self.first)]
        near = np.argsort(self.first - 2 * row[: len(self.first)], kind="stable")
        enough = int(np.searchsorted(np.cumsum(self.size[near]), rerank)) + 1
        opened = np.zeros(len(near), bool)
        opened[near[: max(probe, enough)]] = True
        at = np.flatnonzero(opened[self.cells] & other)
        if np.isinf(own):  # too long for bounds
            at = np.flatnonzero(other)
            found = self.exact(at, q)
        else:
            estimate = self.estimates(at, row, own)
            best = np.zeros(len(at), bool)
            best[np.argpartition(estimate, rerank - 1)[:rerank] if len(at) > rerank else slice(None)] = True
            found = self.exact(at[best], q)
            bound = np.partition(found, k - 1)[k - 1] if len(found) >= k else np.inf
            # a little more, for rounding; differences whose squares are less than the smallest number count as none
            bound = (bound * (1 + 1e-9) + 2.3e-162 * np.sqrt(len(q))) * self.scale
            left = at[~best]
            left = left[self.beyond(estimate[~best], own, self.reach[left], self.rest[left]) <= bound]
            far = ~opened & (self.beyond(to_cell, own, np.sqrt(self.first), self.radius) <= bound)
            more = np.flatnonzero(far[self.cells] & other)
            more = more[self.beyond(self.estimates(more, row, own), own, self.reach[more], self.rest[more]) <= bound]
            at, found = np.concatenate([at[best], left, more]), np.concatenate([found, self.exact(np.concatenate([left, more]), q)])
        if len(found) > k:
            close = found <= np.partition(found, k - 1)[k - 1]
            at, found = at[close], found[close]
        keys = np.where(self.ids[at] == owner, self.next[at], self.ids[at])
        first = np.lexsort((keys, found))[:k]
        return self.ids[at[first]], keys[first], found[first]


def rooted(parts: np.ndarray) -> np.ndarray:
    """The roots of the sums of squares of columns, added row by row."""
    total = np.zeros(parts.shape[1])
    for p in parts:
        total += p * p
    return np.sqrt(total)


def nearest_classes(speakers: DataFrame, queries: DataFrame, books: np.ndarray, scale: float, k: int, rerank: int, probe: int) -> DataFrame:
    """For each query (qkey, query_id, q) its k nearest classes (id, next, v). The query set meets all classes, block by chunk."""
    total, asked, dim = speakers.count(), queries.count(), books.shape[2]
    chunk = min(CHUNK, max(LEAST_CHUNK, -(-total // CHUNKS)), max(1, COMPONENTS // dim))
    chunks = max(1, -(-total // chunk))
    blocks = max(1, -(-asked // min(max(asked * chunks // CHUNKS, LEAST_QUERIES), MOST_QUERIES, max(1, COMPONENTS // dim))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        names, kinds = ["qkey", "class", "least", "away"], [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        lookup, asking = Lookup(books, scale, left), stacked(right.column("q").combine_chunks(), right.num_rows)
        found = list(lookup.nearest(asking, right.column("query_id").to_numpy(), k, rerank, probe))
        owner = np.repeat(right.column("qkey").to_numpy(), [len(f[0]) for f in found])
        return pa.table([pa.array(owner), *[pa.array(np.concatenate([f[i] for f in found]), kinds[i + 1]) for i in range(3)]], names=names)

    dealt = lambda c, n: F.pmod(F.xxhash64(c, F.lit("dealt")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index(speakers, books, scale).withColumn("chunk", dealt("id", chunks)).withColumn("block", every(blocks))
    right = queries.select("qkey", "query_id", "q", dealt("qkey", blocks).alias("block"), every(chunks).alias("chunk"))
    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(meet, "qkey long, class long, least long, away double")
    rank = F.row_number().over(Window.partitionBy("qkey").orderBy("away", "least", "class"))
    return found.withColumn("place", rank).where(F.col("place") <= k).select("qkey", "class")


def distance(a: str, b: str) -> F.Column:
    """Euclidean distance in double precision, in the order of the components."""
    away = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    total = lambda parts: F.sqrt(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x))
    plain, longest = total(away), F.array_max(F.transform(away, F.abs))
    return F.when(plain != float("inf"), plain).otherwise(longest * total(F.transform(away, lambda x: x / longest)))


def nearest(vectors: DataFrame, is_query: F.Column, k: int = 10, rerank: int = RERANK, probe: int = PROBE) -> DataFrame:
    """For each vector (vec_id, embedding) that is_query chooses, its k nearest others: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, is_query)
    trained = train(rows)
    if trained is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books, scale = trained
    chosen = stored(asked_of(rows), "queries")
    members = stored(classed(rows.select("id", "v"), k), "vector-classes")
    pairs = nearest_classes(members.where("speaks"), chosen, books, scale, k, max(rerank, k), probe)
    exact = pairs.join(members.select("class", F.col("id").alias("vec_id"), "v"), "class").join(chosen, "qkey").where("query_id <> vec_id")
    scored = exact.select("qkey", "query_id", "times", "vec_id", distance("v", "q").alias("score"))
    rank = F.row_number().over(Window.partitionBy("qkey", "query_id").orderBy("score", "vec_id"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("query_id", "rank", "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH a AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, row_number() OVER () AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
v AS (SELECT * FROM a WHERE len(v) = (SELECT len(v) FROM a GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
d AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, list_distance(q.v, v.v) AS score FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
