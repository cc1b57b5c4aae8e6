"""What the corpus operators share: the shared folder, shipped code, columns that cannot clash, word-level helpers."""

from __future__ import annotations

import atexit
import ctypes
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
_WRITTEN: list[str] = []
_OWN: list[str] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application, so that tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="evidra-"), "evidra_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where that is unset, a temporary one, which
    only a local master may use: executors of a cluster don't see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="evidra-shared-"))
            atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
        base = "file://" + _OWN[0]
    path = f"{base.rstrip('/')}/evidra-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows of df, written as Parquet to the shared folder and read back: lineage ends here and work is done once."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._evidra_path = path
    return out


def _deleted(path: str) -> None:
    fs, inside = filesystem(path)
    if fs.get_file_info(inside).type == pafs.FileType.Directory:
        fs.delete_dir(inside)


def released(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    path = getattr(df, "_evidra_path", None)
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        _deleted(path)


def clear() -> None:
    """Delete all that this process has written to shared folders; results not yet written or collected are lost with it."""
    while _WRITTEN:
        _deleted(_WRITTEN.pop())


#: A table is broadcast only if it has at most this many rows of a few numbers (elements of lists count as rows), and joined by
#: shuffle otherwise: about 32 MB.
BROADCAST_ROWS = 500_000
#: Parts that rows of one key are dealt into for such a join.
SALTS = 16


def is_small(df: DataFrame, lists: str | None = None) -> bool:
    size = F.count("*") + (F.coalesce(F.sum(F.size(lists).cast("long")), F.lit(0)) if lists else F.lit(0))
    return df.agg(size).first()[0] <= BROADCAST_ROWS


def small(df: DataFrame, lists: str | None = None) -> DataFrame:
    """A stored table, marked for broadcast if it is small; `lists` names a column of lists."""
    return F.broadcast(df) if is_small(df, lists) else df


def met(rows: DataFrame, few: DataFrame, key: str, spread: str, how: str = "inner", fits: bool | None = None) -> DataFrame:
    """rows joined with a stored table of unique keys: by broadcast if that is small (`fits`, if known), else by shuffle, rows of
    one key dealt into SALTS parts by a hash of the column `spread`, so that a hot key is no single task."""
    if is_small(few) if fits is None else fits:
        return rows.join(F.broadcast(few), key, how)
    dealt = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(dealt, [key, "_salt"], how).drop("_salt")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder in the shared store and the path within it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_lists(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows that arrive sorted by key, as tables that never split a key."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([held, now]) if held is not None else now
        keys = now.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield now.slice(0, cut)
        held = now.slice(cut)
    if held is not None and held.num_rows:
        yield held


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what is made of their texts takes little memory at once."""
    for whole in batches:
        for i in range(0, whole.num_rows, rows):
            yield whole.slice(i, rows)


#: Texts are taken in slices of so many bytes, or one text if it has more.
SLICE_BYTES = 4 << 20


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose texts have at most so many bytes, or one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + most, side="right")))
            yield batch.slice(i, j - i)
            i = j


def lean(run):
    """A function of Arrow batches that gives back, at the end of each task, the memory its worker doesn't use: workers live on
    from stage to stage, and each would keep the most it ever took."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library

    return trimmed


def lower_ascii(column) -> F.Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(column) -> F.Column:
    """Words `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; no words of a null text."""
    return F.filter(F.split(F.coalesce(lower_ascii(column), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles_of(words, size: int) -> F.Column:
    """Distinct hashes of all runs of `size` words; with fewer words, of the whole sequence; none without words.

    The words are bound to a lambda variable, else they would be split anew for every run.
    """
    def own(w):
        long = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        short = F.array(F.xxhash64(F.concat_ws(" ", w), F.lit("short")))
        return F.when(F.size(w) >= size, F.array_distinct(long)).when(F.size(w) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words), own), F.lit(0))


def with_columns(docs: DataFrame, added: str, compute) -> DataFrame:
    """docs with columns that compute(texts: pa.Array) gives from each batch's text; same-named columns of docs go."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in added.split(", ")]
    docs = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch.column("text"))], names=[*batch.schema.names, *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{kept}, {added}")
