"""Byte-level BPE: encoding by the tokenizers library over Arrow batches, with byte offsets, and decoding to bytes.

A rank file becomes a tokenizers model: each token's bytes are written with the byte-to-character table, and a token may
be merged from any two tokens that make it up, in the order of ranks. Text is cut by a pattern into matches that are
encoded separately. Runs of non-space characters with at most one space before them never share a match with their
surroundings, so each distinct run is encoded once for a batch and kept in a bounded table.

Decoding reverses the byte table: the bytes of all ids are joined before any character is read, so characters split
between tokens come back whole; `decoded_text` replaces bytes that form no character by U+FFFD.

Null or empty text: no ids, no bytes. Very long texts are encoded whole. Ties between merges go to the lower rank. Columns other
than doc_id and text, whatever their names, are ignored; repeated rows give repeated results; an empty table gives none.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.llm.common import ship, table
from evidra.llm.word_tokens import byte_characters

SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
CACHE_LIMIT = 250_000
_CODECS: dict[tuple[str, str], "ByteBpe"] = {}


def codec(path: str, pattern: str) -> "ByteBpe":
    """The codec of a rank file, one for each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


class ByteBpe:
    def __init__(self, path: str, pattern: str, limit: int = CACHE_LIMIT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        chars = byte_characters()
        shown = {t: "".join(chars[b] for b in t) for t in ranks}
        merges = [
            (shown[t[:k]], shown[t[k:]])
            for t in sorted(ranks, key=ranks.get)
            for k in range(1, len(t))
            if ranks.get(t[:k], ranks[t]) < ranks[t] and ranks.get(t[k:], ranks[t]) < ranks[t]
        ]
        self.tokenizer = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        back = {c: b for b, c in enumerate(chars)}
        self.table = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.table[i] = bytes(back[c] for c in shown[t])
        import public_tokenizers

        self.by_run = pattern == public_tokenizers.PATTERN  # what RUNS is true of; by any other pattern texts are encoded whole
        self.limit = limit
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit bytes."""
        split = [RUNS.findall(t) for t in texts] if self.by_run else [[t] if t else [] for t in texts]
        wanted = set().union(*split)
        missing = wanted - self.cache.keys()
        if len(self.cache) + len(missing) > self.limit:
            self.cache, self.older = {}, self.cache
            missing = wanted
        again = missing & self.older.keys()
        self.cache.update((p, self.older[p]) for p in again)
        new = list(missing - again)
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            for run, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.cache[run] = np.array(e.ids, "<u4").tobytes()
        get = self.cache.__getitem__
        return [b"".join(map(get, runs)) for runs in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte at which each token begins, and the end."""
        return np.cumsum([0, *(len(self.table[i]) for i in ids.tolist())])


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, 2000):
        yield batch.slice(i, 2000)


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Documents (doc_id, text) with ids and byte_offsets, both array<int>; a token may begin within a character."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks, pattern)
        for batch in (part for whole in batches for part in _batches(whole)):
            ids = [np.frombuffer(x, "<u4") for x in bpe.encode([t or "" for t in batch.column("text").to_pylist()])]
            at = [bpe.offsets(x)[:-1] for x in ids]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, kind), pa.array(at, kind)], names=["doc_id", "ids", "byte_offsets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, byte_offsets array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Rows (doc_id, ids) with decoded (binary) and decoded_text (string)."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks, pattern)
        for batch in (part for whole in batches for part in _batches(whole)):
            raw = [bpe.decode(np.asarray(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            text = [x.decode("utf-8", "replace") for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(raw, pa.binary()), pa.array(text, pa.string())], names=["doc_id", "decoded", "decoded_text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary, decoded_text string")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """For each document the number of its ids, the SHA-256 of them and that of the bytes they decode to."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, on = codec(ranks, pattern), gc.isenabled()
        gc.disable()
        try:
            for batch in (part for whole in batches for part in _batches(whole)):
                coded = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
                decoded = [bpe.decode(np.frombuffer(x, "<u4")) for x in coded]
                sha = [[hashlib.sha256(x).hexdigest() for x in side] for side in (coded, decoded)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(x) // 4 for x in coded], pa.int64()), *map(pa.array, sha)],
                    schema=pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]),
                )
        finally:  # workers live on, whether this ends, fails or is read in part
            if on:
                gc.enable()

    out = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out)


def op5_byte_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    import public_tokenizers as P

    return round_trip(table(spark, sf_dir, "documents"), ranks or P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
