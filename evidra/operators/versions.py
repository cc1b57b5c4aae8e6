"""Versions of tables: numbered pointer files, each put once and never changed, of which readers take the highest; runs that are
published through them; and tables of fetched metadata that are kept up to date from version to version."""

from __future__ import annotations

import json
import os
import re
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidra.operators.merge import with_empty, worklist


class Overtaken(ValueError):
    """Another publisher has taken the version that followed the one this was made from."""


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of this name; of several writers at once exactly one does. It appears whole: a hidden
    file is written beside it and then renamed without overwriting, or linked on a local disk, whose rename would overwrite."""
    target, fs = _path(spark, path)
    fs.mkdirs(target.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            at = lambda p: unquote(urlparse(p.toUri().toString()).path)
            try:
                os.link(at(hidden), at(target))
            except FileExistsError:
                return False
            return True
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        never = spark._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(hidden, target, never)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                return False
            raise
        return True
    finally:
        if fs.exists(hidden):
            fs.delete(hidden, False)


def pointers(spark: SparkSession, root: str) -> dict[int, dict]:
    """What the pointer files of a root say, by number."""
    where, fs = _path(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(where):
        return {}
    names = [str(s.getPath().getName()) for s in fs.listStatus(where)]
    if not any(re.fullmatch(r"\d{10}", n) for n in names):
        return {}
    rows = spark.read.option("wholetext", True).text(f"{root.rstrip('/')}/versions").select(F.col("_metadata.file_name").alias("name"), "value").collect()  # a row a version
    return {int(r["name"]): json.loads(r["value"]) for r in rows if re.fullmatch(r"\d{10}", r["name"])}


def latest(spark: SparkSession, root: str) -> int:
    """The highest version; 0 if there is none."""
    return max(pointers(spark, root), default=0)


def point(spark: SparkSession, root: str, after: int, what: dict) -> int:
    """Make version after + 1 say `what`. Fails if another has been put there: what it was made from isn't the latest any more."""
    if not put_if_absent(spark, f"{root.rstrip('/')}/versions/{after + 1:010d}", json.dumps(what)):
        raise Overtaken(f"{root}: version {after + 1} is {pointers(spark, root)[after + 1]}")
    return after + 1


def cleaned(spark: SparkSession, root: str, keep: int = 1, unseen_for: float = 86_400) -> list[str]:
    """Delete the runs below a root that neither one of the `keep` latest versions names nor, younger than `unseen_for` seconds,
    may still be in the making; gives their folders."""
    found = pointers(spark, root)
    named = {found[n]["run"].rstrip("/").rsplit("/", 1)[-1] for n in sorted(found)[-keep:]}
    where, fs = _path(spark, root)
    oldest = spark._jvm.java.lang.System.currentTimeMillis() - int(1000 * unseen_for)
    gone = []
    for status in fs.listStatus(where):
        name = str(status.getPath().getName())
        if name.startswith("run-") and name not in named and status.getModificationTime() < oldest:
            fs.delete(status.getPath(), True)
            gone.append(f"{root.rstrip('/')}/{name}")
    return gone


def metadata(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table of a version of fetched metadata, the latest by default; None before the first. A reader keeps its version,
    whatever is put after it."""
    found = pointers(spark, root)
    if not found:
        return None
    pointer = found[version or max(found)]
    return spark.read.schema(StructType.fromJson(json.loads(pointer["schema"]))).parquet(pointer["run"])


def to_fetch(spark: SparkSession, root: str, wanted: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Wanted keys (key) that the latest version doesn't have, and its number."""
    version = latest(spark, root)
    known = metadata(spark, root, version) if version else None
    return wanted.select(key).distinct() if known is None else worklist(wanted, known, key).where("status = 'fetch'").select(key), version


def update_metadata(spark: SparkSession, root: str, wanted: DataFrame, fetched: DataFrame, key: str, after: int) -> int:
    """The version behind `after`: wanted rows it has stay as they are, the others come from `fetched`, the first by all columns
    where a key was fetched twice; keys that weren't returned get empty texts and 0, and keys no longer wanted go. Nothing changes
    before the new table is written whole and its version put; if another has put it, Overtaken."""
    keys = wanted.select(key).distinct()
    known = metadata(spark, root, after) if after else None
    rest = [c for c in fetched.columns if c != key]
    new = fetched.groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*")
    if known is not None:
        kept = known.select(*fetched.columns).join(keys, key, "left_semi")
        keys, new = keys.join(known.select(key), key, "left_anti"), new.join(known.select(key), key, "left_anti")
    added = with_empty(keys.join(new, key, "left").withColumn("silo", F.lit(0)), key).select(*fetched.columns)
    table = added if known is None else kept.unionByName(added)
    run = f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"
    table.write.parquet(run)
    return point(spark, root, after, {"run": run, "schema": table.schema.json()})
