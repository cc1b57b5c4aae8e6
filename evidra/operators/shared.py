"""Tables on the way: written once to the folder that driver and executors share, read by what comes after, deleted at the end."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []
_WRITTEN: dict[str, str] = {}  # folder: application
_PUBLISHED: dict[tuple[str, str], str] = {}


def base(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where that is unset, a temporary folder, which only a local master may use: executors
    of a cluster don't see it."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="evidra-graph-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return "file://" + _OWN[0]


def folder(spark: SparkSession, name: str) -> str:
    path = f"{base(spark)}/evidra-{name}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark.sparkContext.applicationId
    return path


def written(df: DataFrame, name: str, parted: list[str] | None = None) -> DataFrame:
    """The rows of df as a table of the shared folder, parted by columns if given: work is done once and lineage ends here."""
    path = folder(df.sparkSession, name)
    out = df.write.partitionBy(*parted) if parted else df.write
    out.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._evidra_path = path
    return read


def deleted(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def released(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    path = getattr(df, "_evidra_path", None)
    if _WRITTEN.pop(path, None):
        deleted(df.sparkSession, path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has written; results that aren't collected yet are lost with it."""
    here = spark.sparkContext.applicationId
    for path in [p for p, app in _WRITTEN.items() if app == here]:
        del _WRITTEN[path]
        deleted(spark, path)
    for key in [k for k, path in _PUBLISHED.items() if path not in _WRITTEN]:
        del _PUBLISHED[key]


def stamp(spark: SparkSession, paths: list[str]) -> str:
    """A digest of the files below paths: their names, lengths and times; nothing of them is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length", F.col("modificationTime").cast("long").alias("at"))
    one = F.xxhash64("path", "length", "at")
    row = found.agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(F.shiftright(one, 20)).alias("s")).first()
    return hashlib.sha256(repr((sorted(paths), tuple(row))).encode()).hexdigest()[:32]


def published(spark: SparkSession, name: str, inputs: list[str], make, parted: list[str] | None = None) -> DataFrame:
    """A table derived from input files, made by make() and written the first time it is asked for, read ever after by this
    application; made anew if the files have changed since."""
    key = (spark.sparkContext.applicationId, f"{name}-{stamp(spark, inputs)}")
    if key not in _PUBLISHED or _PUBLISHED[key] not in _WRITTEN:
        _PUBLISHED[key] = written(make(), f"published-{name}", parted)._evidra_path
    return spark.read.parquet(_PUBLISHED[key])


def split(df: DataFrame, reason: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of df for which reason is null, and drop_reason, n of the others. One pass writes both apart: rows that stay with
    all their columns, of the others nothing but the reason, so that counting reads next to nothing. (Metrics observed on the
    way would count the rows of a stage twice that is computed again after the loss of an executor.)"""
    marked = df.withColumn("drop_reason", reason)
    stays = F.col("drop_reason").isNull()
    table = written(marked.select(*[F.when(stays, F.col(f"`{c}`")).alias(c) for c in df.columns], "drop_reason", stays.alias("stays")), name, ["stays"])
    counts = table.where("NOT stays").groupBy("drop_reason").agg(F.count("*").alias("n"))
    return table.where("stays").select(*df.columns), counts
