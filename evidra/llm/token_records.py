"""Token-ID output: length-delimited binary records with masked checksums and a separate offset index.

A file is a run of records, each `length (8 bytes, little-endian) | masked CRC-32C of the length (4) | payload | masked
CRC-32C of the payload (4)`, the framing that TensorFlow's record files use. A payload is a 16-byte head (bytes per id,
whether there is a doc_id, 6 bytes 0, doc_id) and the ids, 2 bytes each where the vocabulary allows it, otherwise 4.
The index, a Parquet table, has a row for each record: its file, offset, length and number of ids, so that a reader can fetch
records in any order; those that lie together are read together.

A task writes its range of doc_ids to a file of its own name; the index rows of the attempt that Spark commits name the
files that count, so a lost executor or a second attempt leaves no trace in the result.

Null or empty text: a record with the end id only. A very long text is one record, held by one task. Repeated doc_ids: a record each, in the order of their texts. Null
doc_ids come first. An empty table gives no records. Columns other than doc_id and text, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidra.llm.common import filesystem, lean, shared_dir, ship, sliced, stored, table
from evidra.llm.word_tokens import encoder

POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
LANE = 128
HEAD = 16
#: Bytes of one read of neighbouring records.
READ_BYTES = 8 << 20
INDEX = "doc_id long, file string, record_offset long, record_bytes long, n_tokens long, start_in_file long, ordinal long"


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The CRC register after two more bytes, by their value; and after a lane of zero bytes, by each byte of the register."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ POLYNOMIAL, one >> 1).astype(np.uint32)
    x = np.arange(65536, dtype=np.uint32)
    for _ in range(2):
        x = (x >> 8) ^ one[x & 255]
    two = x.astype(np.uint32)
    shift = []
    for byte in range(4):
        r = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for _ in range(LANE // 2):
            r = (r >> 16) ^ two[r & 0xFFFF]
        shift.append(r.astype(np.uint32))
    return two, shift


TWO, SHIFT = _tables()


def masked_crc32c(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Masked CRC-32C of byte ranges of data (at least 4 bytes each, an even number), all at once.

    Ranges are padded at the front with zeros, which a register of zero ignores, to whole lanes; the lanes' registers are
    found together and then folded lane by lane.
    """
    if not len(first):
        return np.zeros(0, np.uint32)
    lanes = (length + LANE - 1) // LANE
    total, at = int(lanes.sum()), np.cumsum(lanes) - lanes
    pad = np.zeros(total * LANE, np.uint8)
    target = at * LANE + lanes * LANE - length
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    pad[np.repeat(target, length) + within] = data[np.repeat(first, length) + within]
    for k in range(4):
        pad[target + k] ^= 0xFF
    words = pad.view("<u2").reshape(total, LANE // 2)
    r = np.zeros(total, np.uint32)
    for k in range(LANE // 2):
        r = (r >> np.uint32(16)) ^ TWO[(r ^ words[:, k]) & np.uint32(0xFFFF)]
    order = np.argsort(-lanes, kind="stable")
    at, lanes = at[order], lanes[order]
    state = np.zeros(len(at), np.uint32)
    for k in range(int(lanes[0])):
        n = int(np.searchsorted(-lanes, -k, side="left"))  # ranges that have a lane k
        s = state[:n]
        state[:n] = SHIFT[0][s & 255] ^ SHIFT[1][s >> 8 & 255] ^ SHIFT[2][s >> 16 & 255] ^ SHIFT[3][s >> 24] ^ r[at[:n] + k]
    crc = np.empty(len(at), np.uint32)
    crc[order] = state ^ np.uint32(0xFFFFFFFF)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def framed(doc_ids: np.ndarray, has_id: np.ndarray, ids: np.ndarray, bounds: np.ndarray, width: int) -> tuple[bytes, np.ndarray]:
    """Records of the documents, one after another, and the offset of each."""
    n = np.diff(bounds)
    size = HEAD + width * n
    offset = np.concatenate([[0], np.cumsum(size + 16)])
    out = np.zeros(int(offset[-1]), np.uint8)
    heads = np.zeros((len(n), 8 + 4 + HEAD), np.uint8)
    heads[:, :8] = size.astype("<i8").view(np.uint8).reshape(-1, 8)
    lengths = np.ascontiguousarray(heads[:, :8]).ravel()
    eight = np.full(len(n), 8)
    heads[:, 8:12] = masked_crc32c(lengths, 8 * np.arange(len(n)), eight).astype("<u4").view(np.uint8).reshape(-1, 4)
    heads[:, 12], heads[:, 13] = width, has_id
    heads[:, 20:28] = doc_ids.astype("<i8").view(np.uint8).reshape(-1, 8)
    out[(offset[:-1, None] + np.arange(28)).ravel()] = heads.ravel()
    body = ids.astype("<u2" if width == 2 else "<u4").view(np.uint8)
    out[np.repeat(offset[:-1] + 28 - width * bounds[:-1], width * n) + np.arange(len(body))] = body
    crc = masked_crc32c(out, offset[:-1] + 12, size).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(offset[1:, None] - 4 + np.arange(4)).ravel()] = crc.ravel()
    return out.tobytes(), offset


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))


def write_records(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1) -> DataFrame:
    """Encode documents (doc_id, text) into record files below folder, in ascending doc_id order; returns their index."""
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        width = 2 if encode.tokenizer.get_vocab_size() <= 65536 else 4
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name, stream, written, ids_before, count = f"{uuid.uuid4().hex}.rec", None, 0, 0, 0
        for batch in sliced(batches):
            if stream is None:
                stream = fs.open_output_stream(f"{root}/{name}")
            doc = batch.column("doc_id")
            ids, bounds = with_end(*encode.encode(batch.column("text")), end_id)
            raw, offset = framed(doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_valid().to_numpy(zero_copy_only=False), ids, bounds, width)
            stream.write(raw)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [doc.cast(pa.int64()), pa.array([name] * k, pa.string()), pa.array(offset[:-1] + written), pa.array(np.diff(offset)), pa.array(np.diff(bounds)), pa.array(bounds[:-1] + ids_before), pa.array(np.arange(count, count + k))],
                names=["doc_id", "file", "record_offset", "record_bytes", "n_tokens", "start_in_file", "ordinal"],
            )
            written, ids_before, count = written + len(raw), ids_before + int(bounds[-1]), count + k
        if stream is not None:
            stream.close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(lean(write), INDEX), "record-index")


def runs(files: list[str], offsets: list[int], sizes: list[int]) -> Iterator[tuple[str, int, list[int]]]:
    """Records that lie one behind the other in a file, as one read (file, offset, sizes) of about READ_BYTES at most."""
    file, first, run, end = None, 0, [], 0
    for name, offset, size in zip(files, offsets, sizes):
        if run and (name != file or offset != end or end + size - first > READ_BYTES):
            yield file, first, run
            run = []
        if not run:
            file, first = name, offset
        run.append(size)
        end = offset + size
    if run:
        yield file, first, run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that rows of an index name, in any order: the index's columns and ids, checked against both checksums."""
    ship(index.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("n_tokens", pa.int64()), ("start_in_file", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        open_name, source = None, None
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                found, docs = [], []
                for name, offset, sizes in runs(*(batch.column(c).to_pylist() for c in ("file", "record_offset", "record_bytes"))):
                    if name != open_name:
                        if source is not None:
                            source.close()
                        open_name, source = name, fs.open_input_file(f"{root}/{name}")
                    data, at = source.read_at(sum(sizes), offset), 0
                    for size in sizes:
                        found.append(data[at : at + size])
                        at += size
                raw = np.frombuffer(b"".join(found), np.uint8)
                at = np.cumsum([0] + [len(x) for x in found])[:-1]
                eights = raw[(at[:, None] + np.arange(8)).ravel()].view("<i8")
                ranges = ((at, np.full(len(at), 8)), (at + 12, eights))
                for first, length in ranges:
                    stored_crc = raw[((first + length)[:, None] + np.arange(4)).ravel()].view("<u4")
                    if not np.array_equal(masked_crc32c(raw, first, length), stored_crc):
                        raise ValueError(f"a record of {open_name} fails its checksum")
                ids = []
                for start, size in zip((at + 12).tolist(), eights.tolist()):
                    width = int(raw[start])
                    docs.append(int(raw[start + 8 : start + 16].view("<i8")[0]) if raw[start + 1] else None)
                    ids.append(raw[start + HEAD : start + size].view("<u2" if width == 2 else "<u4").astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), batch.column("file"), batch.column("n_tokens"), batch.column("start_in_file"), pa.array(ids, pa.binary())], schema=schema)

    return index.mapInArrow(read, "doc_id long, file string, n_tokens long, start_in_file long, ids binary")


def file_starts(index: DataFrame) -> DataFrame:
    """For each file the number of ids in all files before it; a row a file, and files hold ranges of doc_ids."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("low"))
    before = Window.orderBy(F.col("low").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def op4_token_records(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    folder = shared_dir(spark, "records")
    index = write_records(table(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("word_bpe_49k.json"), folder)
    digest = read_records(index, folder).withColumn("n", F.octet_length("ids") / 4).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return digest.join(file_starts(index), "file").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), F.col("n").cast("long").alias("n_tokens"), "ids_crc32"
    )
