"""Best-fit packing of documents into sequences by linear grouping.

Documents become token pieces of at most `capacity` ids. Only a histogram of piece lengths, at most `capacity` rows for
any corpus, reaches the driver, where the packing is planned on counts:

1. lengths over capacity / 6 fall into groups of equal cardinality and are rounded up to their group's longest;
2. column generation solves the linear program over configurations of these few sizes, and its solution is rounded down;
3. actual lengths take the configurations' places;
4. what is left, then the small lengths, longest first, each go where they leave least room (best fit), new sequences
   being opened only where nothing fits.

The plan says for each length which ranks go to which sequences and offsets. Ranks are given on the executors: pieces of a
length are dealt into about sqrt(count) buckets, numbered within them and shifted by the buckets before, so that a length
that a third of all pieces share is no single group.

Null or empty text: one piece with the end id only. A very long text is encoded whole by one task and cut into pieces. Repeated rows and ties are packed each for itself. An empty table
gives no rows. Columns other than doc_id and text are ignored. A null doc_id is carried through.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.llm.common import lean, ship, sliced, stored, table
from evidra.llm.token_records import with_end
from evidra.llm.word_tokens import encoder

CAPACITY = 4096
GROUPS = 28
LARGE_PARTS = 6
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """Documents (doc_id, text) as pieces of at most capacity ids, the end id included; ids_crc32 is of the piece's ids."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in sliced(batches):
            ids, bounds = with_end(*encode.encode(batch.column("text")), end_id)
            raw = memoryview(ids.astype("<u4")).cast("B")
            n = np.diff(bounds)
            parts = (n + capacity - 1) // capacity
            piece = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(np.repeat(n, parts) - start, capacity)
            first = (4 * (np.repeat(bounds[:-1], parts) + start)).tolist()
            crc = [zlib.crc32(raw[a : a + k]) for a, k in zip(first, (4 * length).tolist())]
            doc = batch.column("doc_id").cast(pa.int64()).take(pa.array(np.repeat(np.arange(len(n)), parts)))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(cut), PIECES)


def grouped(runs: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Runs (length, count), longest first, split into groups of equal cardinality."""
    total, out, room = sum(n for _, n in runs), [], 0
    for length, n in runs:
        while n:
            if not room:
                out.append([])
                room = -(-total // groups)
            take = min(n, room)
            out[-1].append((length, take))
            n, room = n - take, room - take
    return out


def best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits, by dynamic programming over the capacity."""
    best = np.zeros(capacity + 1)
    steps: list[tuple[int, np.ndarray]] = []
    for g, size in enumerate(sizes):
        if worth[g] <= 1e-12:
            continue
        for _ in range(capacity // size):
            gain = best[:-size] + worth[g]
            better = gain > best[size:] + 1e-12
            if not better.any():
                break
            best[size:] = np.where(better, gain, best[size:])
            steps.append((g, better))
    chosen, room = np.zeros(len(sizes)), capacity
    for g, better in reversed(steps):
        if room >= sizes[g] and better[room - sizes[g]]:
            chosen[g] += 1
            room -= sizes[g]
    return float(best[capacity]), chosen


def configurations(sizes: list[int], demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """A basic solution of the configuration linear program, by column generation."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    cost = np.ones(k)
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        x, dual = inverse @ demand, cost @ inverse
        low = int(np.argmin(dual))
        if dual[low] < -1e-9:
            column, price = -np.eye(k)[low], 0.0
        else:
            value, column = best_configuration(sizes, dual, capacity)
            price = 1.0
            if value <= 1 + 1e-7 or dual @ column <= 1 + 1e-7:
                break
        move = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(move > 1e-9, np.maximum(x, 0) / move, np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out], cost[out] = column, price
    x = np.linalg.solve(basis, demand)
    return [(basis[:, j], x[j]) for j in range(k) if cost[j] and x[j] >= 1]


def planned(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> pd.DataFrame:
    """Where the pieces of each length go: ranks lo..hi-1, `each` of them a sequence, from `sequence` on, at `offset`."""
    classes: dict[int, list[tuple[dict[int, int], int]]] = {}  # by room left: contents of a sequence, number of such ones
    rooms: list[int] = []

    def put(contents: dict[int, int], n: int) -> None:
        if n:
            room = capacity - sum(a * b for a, b in contents.items())
            if room not in classes:
                classes[room] = []
                bisect.insort(rooms, room)
            classes[room].append((contents, n))

    put({capacity: 1}, histogram.get(capacity, 0))
    descending = sorted(((a, n) for a, n in histogram.items() if a < capacity and n), reverse=True)
    queues = grouped([(a, n) for a, n in descending if a * LARGE_PARTS > capacity], groups)
    if queues:
        sizes, demand = [q[0][0] for q in queues], np.array([float(sum(n for _, n in q)) for q in queues])
        for config, times in configurations(sizes, demand, capacity):
            left = int(times + 1e-6)
            slots = [(g, int(c)) for g, c in enumerate(config) if c]
            while left and any(queues[g] for g, _ in slots):
                uniform = min((queues[g][0][1] // c for g, c in slots if queues[g]), default=0)
                bins, contents = min(left, max(uniform, 1)), {}
                for g, c in slots:
                    need = c
                    while need and queues[g]:
                        length, n = queues[g][0]
                        take = c if uniform else min(need, n)
                        contents[length] = contents.get(length, 0) + take
                        n -= take * bins
                        need -= take
                        queues[g][0:1] = [(length, n)] if n else []
                put(contents, bins)
                left -= bins
    rest: dict[int, int] = {a: n for a, n in descending if a * LARGE_PARTS <= capacity}
    for q in queues:
        for a, n in q:
            rest[a] = rest.get(a, 0) + n
    for length, n in sorted(rest.items(), reverse=True):
        while n:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            fit = room // length
            each = min(fit, n)
            if at < len(rooms):
                contents, have = classes[room].pop()
                if not classes[room]:
                    del classes[room]
                    rooms.pop(at)
            else:
                contents, have = {}, n // each
            bins = min(have, n // each)
            put(contents | {length: contents.get(length, 0) + each}, bins)
            put(contents, have - bins if contents else 0)
            n -= bins * each
    rows, used, sequence = [], {}, 0
    for room in rooms:
        for contents, bins in classes[room]:
            offset = 0
            for length, each in contents.items():
                lo = used.get(length, 0)
                used[length] = lo + each * bins
                rows.append((length, lo, used[length], each, sequence, offset))
                offset += length * each
            sequence += bins
    return pd.DataFrame(rows, columns=["at_length", "lo", "hi", "each", "sequence", "at"]).astype("int64")


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """pieces with `rank`, from 0, among the pieces of their length."""
    spark = pieces.sparkSession
    dealt = spark.createDataFrame([(a, int(n**0.5) + 1) for a, n in counts.items()], "length long, buckets long")
    pieces = pieces.join(F.broadcast(dealt), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "buckets"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = pieces.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return pieces.withColumn("local", F.row_number().over(within) - 1).join(bases, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("local"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with their sequence_id and offset; pieces should be a stored table."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = planned(counts, capacity)
    plan = pieces.sparkSession.createDataFrame(plan, "at_length long, lo long, hi long, each long, sequence long, at long")
    r = ranked(pieces, counts)
    placed = r.join(F.broadcast(plan), (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    return placed.select(
        *["doc_id", "piece", "start", "length", "ids_crc32"],
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    return pack(stored(token_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("word_bpe_49k.json"))
