"""WARC archives as a Spark data source in Python.

Writing: each task writes one file of gzip members, a record each, under a name of its own; every commit lists the files of
the attempts that count in a manifest of its own, so files of lost tasks are never read and what other commits wrote stays. A
commit that overwrites names the manifests and files it replaces in the same manifest, and so replaces them at once. A member's
header names its compressed and whole lengths (extra field "sl"), so that a reader can pass over it.

Reading: files are planned into partitions by size; filters on record type and on headers (equality and IN) are pushed
down; of each record the headers are parsed first, and the payload of a record that is not wanted is not inflated. Option
payload=false leaves payloads out. Archives of other writers, without manifest or lengths, are read too.

Null html: an empty payload. Null url: no target URI; control characters in it are escaped. Null page_id: no page header;
such a page is a revisit if a page with an id has its payload of LEAST_REVISIT bytes or more, else a response. Rows with one page_id and equal payloads are all responses; of a tie there is so no other. A very long payload is one record, held
by one task. An empty table gives no records. Columns other than page_id, url and html, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from evidra.llm.common import filesystem, met, shared_dir, ship, stored, table

SCHEMA = "record_id string, record_type string, target_uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, payload binary"
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]
KINDS = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
MANIFEST = re.compile(r"_MANIFEST.*\.json")
OWN_FILE = re.compile(r"[0-9a-f]{32}\.warc\.gz")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 100
PARTITION_BYTES = 64 << 20
EXTRA = struct.Struct("<BBBBIBBHBBHII")  # gzip header with one extra field of two lengths


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(row: dict, date: str) -> bytes:
    """A record's bytes: headers, HTTP headers and, for a response, the payload."""
    payload = row["payload"] or b""
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {record_id(row['page_id'], row['payload_digest'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in row["url"]))
    head += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}"]
    if row["page_id"] is not None:
        head.append(f"X-Page-Id: {row['page_id']}")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % row["payload_bytes"]
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(row['refers_to'], row['payload_digest'])}", f"X-Refers-To-Page-Id: {row['refers_to']}"]
    else:
        block += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = EXTRA.size + len(body) + 8
    return EXTRA.pack(31, 139, 8, 4, 0, 0, 255, 12, 115, 108, 8, size, len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def described(h: dict[str, str]) -> dict:
    whole = lambda k: int(h[k]) if k in h else None
    return {
        "record_id": h.get("warc-record-id"), "record_type": h.get("warc-type"), "target_uri": h.get("warc-target-uri"), "page_id": whole("x-page-id"),
        "refers_to": whole("x-refers-to-page-id"), "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha256:") or None, "payload_bytes": whole("x-payload-length"),
    }


def payload_of(block: bytes, h: dict[str, str]) -> bytes | None:
    if h.get("warc-type") == "revisit":
        return None
    return block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block


def records(stream, wanted, with_payload: bool) -> Iterator[dict]:
    """Records of an open file of gzip members that `wanted` accepts by their headers."""
    size, at = stream.size(), 0
    while at < size:
        start = stream.read_at(EXTRA.size, at)
        known = len(start) == EXTRA.size and start[3] == 4 and start[12:14] == b"sl"
        length = EXTRA.unpack(start)[-2] if known else 0
        reader, held, place = zlib.decompressobj(31), b"", at
        while b"\r\n\r\n" not in held and not reader.eof:
            raw = stream.read_at(min(4096, at + length - place) if known else 65536, place)
            if not raw:
                raise EOFError("an archive ends within a record")
            place += len(raw)
            held += reader.decompress(raw, 4096 if known else 0)
            while reader.unconsumed_tail and b"\r\n\r\n" not in held:
                held += reader.decompress(reader.unconsumed_tail, 4096)
        h = headers(held.partition(b"\r\n\r\n")[0])
        row = described(h)
        take = wanted(row)
        if not known or (take and with_payload):
            tail = reader.unconsumed_tail
            parts = [held, reader.decompress(tail) if tail else b""]
            while not reader.eof:
                raw = stream.read_at(at + length - place if known else 65536, place)
                if not raw:
                    raise EOFError("an archive ends within a record")
                place += len(raw)
                parts.append(reader.decompress(raw))
            held = b"".join(parts)
        if take:
            block = held.partition(b"\r\n\r\n")[2][: int(h.get("content-length", 0))] if with_payload else b""
            yield row | {"payload": payload_of(block, h) if with_payload else None}
        at = at + length if known else place - len(reader.unused_data)


def manifests(fs: pafs.FileSystem, root: str, names) -> dict[str, dict]:
    """What the manifests of a folder say that no other replaces: files, and the manifests and files they replace."""
    said = {}
    for name in names:
        if MANIFEST.fullmatch(name):
            with fs.open_input_stream(f"{root}/{name}") as s:
                one = json.loads(s.read())
            said[name] = one if isinstance(one, dict) else {"files": one, "replaces": []}
    replaced = {r for one in said.values() for r in one["replaces"]}
    return {name: one for name, one in said.items() if name not in replaced}


def standing(fs: pafs.FileSystem, root: str, names) -> list[str]:
    """The archives of a folder that count: those that its manifests list, and other writers' that none replaces."""
    said = manifests(fs, root, names)
    archives = [n for n in names if n.endswith(".warc.gz")]
    if not said:
        return archives
    replaced = {r for one in said.values() for r in one["replaces"]}
    return [n for one in said.values() for n in one["files"]] + [n for n in archives if not OWN_FILE.fullmatch(n) and n not in replaced]


class Files(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.with_payload = options["path"], str(options.get("payload", "true")).lower() != "false"
        self.equal: dict[str, list] = {}

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            pushable = isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in COLUMNS[:-1]
            if pushable and f.attribute[0] not in self.equal:
                self.equal[f.attribute[0]] = list(f.value) if isinstance(f, In) else [f.value]
            else:
                yield f

    def partitions(self) -> Sequence[Files]:
        fs, root = filesystem(self.path)
        found = {x.base_name: x.size for x in fs.get_file_info(pafs.FileSelector(root)) if x.is_file}
        names = standing(fs, root, found)
        out, room = [], 0
        for name in sorted(names):
            if not out or room < found[name]:
                out.append([])
                room = PARTITION_BYTES
            out[-1].append(name)
            room -= found[name]
        return [Files(x) for x in out] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(self.path)
        wanted = lambda row: all(row[k] in v for k, v in self.equal.items())
        batch: list[dict] = []
        room = 0
        for name in partition.names:
            with fs.open_input_file(f"{root}/{name}") as stream:
                for row in records(stream, wanted, self.with_payload):
                    batch.append(row)
                    room += 500 + len(row["payload"] or b"")
                    if room > 4 << 20:
                        yield self.packed(batch)
                        batch, room = [], 0
        yield self.packed(batch)

    @staticmethod
    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(COLUMNS, KINDS)], names=COLUMNS)


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Writes rows (page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to)."""

    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.date, self.overwrite = options["path"], options.get("date", "1970-01-01T00:00:00Z"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        name, stream = f"{uuid.uuid4().hex}.warc.gz", None
        for batch in iterator:
            if stream is None and batch.num_rows:
                stream = fs.open_output_stream(f"{root}/{name}", compression=None)
            for row in batch.to_pylist():
                stream.write(member(record(row, self.date)))
        if stream is None:
            return Written([])
        stream.close()
        return Written([name])

    def commit(self, messages: list) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        old: list[str] = []
        if self.overwrite:
            there = [x.base_name for x in fs.get_file_info(pafs.FileSelector(root)) if x.is_file]
            old = [n for n in there if MANIFEST.fullmatch(n)] + standing(fs, root, there)
        with fs.open_output_stream(f"{root}/_MANIFEST-{uuid.uuid4().hex}.json") as s:
            s.write(json.dumps({"files": sorted(n for m in messages if m for n in m.names), "replaces": old}).encode())
        for name in old:  # they count no more, so it may fail half way
            fs.delete_file(f"{root}/{name}")

    def abort(self, messages: list) -> None:
        fs, root = filesystem(self.path)
        for name in [n for m in messages if m for n in m.names]:
            fs.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def deduplicated(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages (page_id, url, html) as record rows: of equal payloads of `least` bytes or more, all but those of the smallest
    page_id are revisits. Digests are counted before anything moves, and only those that occur twice are met again, by broadcast
    if they are few, else dealt out over salts; shorter payloads have no key, so they meet nothing and stay where they are dealt."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    own = F.when(F.col("payload_bytes") >= least, F.col("payload_digest")).otherwise(F.concat(F.lit("short "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    shared = rows.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("key")).agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = met(rows.withColumn("key", own), stored(shared, "digests"), "key", "page_id", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archive(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Write pages as records beside those that are there (append), in their place (overwrite), or only where nothing is (error).
    Revisits refer to records of the same call."""
    if mode not in ("append", "overwrite", "error"):
        raise ValueError(f"no mode {mode}")
    register(pages.sparkSession)
    if mode == "error":
        fs, root = filesystem(path)
        if fs.get_file_info(root).type != pafs.FileType.NotFound and fs.get_file_info(pafs.FileSelector(root)):
            raise FileExistsError(path)
    deduplicated(pages).write.format("warc").mode("overwrite" if mode == "overwrite" else "append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    rows = read_archive(spark, path)
    response = F.col("record_type") == "response"
    return rows.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""
