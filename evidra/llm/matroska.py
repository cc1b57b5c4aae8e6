"""Media columns: Matroska files as binary values, written and parsed with the standard library alone.

`mux` stores 8-bit mono samples losslessly as laced SimpleBlocks in clusters with cues; `demux` parses EBML elements of
variable length (unknown sizes, void and CRC elements, SimpleBlocks and BlockGroups, Xiph, EBML and fixed-size lacing)
into packets (track, timestamp, key frame, byte range) and cues. The bytes depend on the samples alone.

Null or empty text: 64 zero samples. Equal texts give equal bytes, so ties don't arise and repeated rows give repeated results. A
very long text is one file of many clusters, held by one task. A null or malformed file has no packets and an error instead; its
payload and features are null. An empty table gives no rows; columns other than those named, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.llm.common import ship, stored, table

# Element ids of the Matroska specification.
EBML, SEGMENT, INFO, TRACKS, TRACK_ENTRY = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0xAE
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
REFERENCE_BLOCK, CUES, CUE_POINT, CUE_TIME = 0xFB, 0x1C53BB6B, 0xBB, 0xB3
CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xB7, 0xF7, 0xF1
DOC_TYPE, SCALE, DURATION, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, AUDIO = 0x4282, 0x2AD7B1, 0x4489, 0xD7, 0x73C5, 0x83, 0x86, 0xE1
RATE, CHANNELS, BIT_DEPTH, LACING, DEFAULT_DURATION = 0xB5, 0x9F, 0x6264, 0x9C, 0x23E383
LEVEL_ONE = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367}

SAMPLE_RATE, FRAME, LACE, BLOCKS = 8000, 512, 8, 32


def vint(n: int) -> bytes:
    """n as an EBML size of the shortest length."""
    k = 1
    while n >= (1 << 7 * k) - 1:
        k += 1
    return (n | 1 << 7 * k).to_bytes(k, "big")


def element(kind: int, data: bytes) -> bytes:
    return kind.to_bytes((kind.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def unsigned(kind: int, n: int) -> bytes:
    return element(kind, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def laced(sizes: list[int]) -> tuple[int, bytes]:
    """Flags and header of a block whose frames have these sizes: no lacing, fixed-size or EBML lacing."""
    if len(sizes) == 1:
        return 0x80, b""
    count = bytes([len(sizes) - 1])
    if len(set(sizes)) == 1:
        return 0x84, count
    head = vint(sizes[0])
    for a, b in zip(sizes, sizes[1:-1]):
        k = 1
        while abs(b - a) >= 1 << 7 * k - 1:
            k += 1
        head += (b - a + (1 << 7 * k - 1) - 1 | 1 << 7 * k).to_bytes(k, "big")
    return 0x86, count + head


def mux(samples: bytes, rate: int = SAMPLE_RATE) -> bytes:
    """A Matroska file of one PCM track, whose frames hold 512 samples, the last one fewer."""
    frames = [samples[i : i + FRAME] for i in range(0, len(samples), FRAME)]
    info = element(INFO, unsigned(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", 1000 * len(samples) / rate)))
    audio = element(AUDIO, element(RATE, struct.pack(">d", rate)) + unsigned(CHANNELS, 1) + unsigned(BIT_DEPTH, 8))
    track = unsigned(TRACK_NUMBER, 1) + unsigned(TRACK_UID, 1) + unsigned(TRACK_TYPE, 2) + unsigned(LACING, 1)
    track += unsigned(DEFAULT_DURATION, FRAME * 1_000_000_000 // rate) + element(CODEC, b"A_PCM/INT/LIT") + audio
    body = info + element(TRACKS, element(TRACK_ENTRY, track))
    cues = b""
    for c in range(0, len(frames), LACE * BLOCKS):
        time = 1000 * c * FRAME // rate
        blocks = unsigned(TIMESTAMP, time)
        for b in range(c, min(c + LACE * BLOCKS, len(frames)), LACE):
            lace = frames[b : min(b + LACE, c + LACE * BLOCKS)]
            flags, head = laced([len(f) for f in lace])
            blocks += element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", 1000 * b * FRAME // rate - time, flags) + head + b"".join(lace))
        cues += element(CUE_POINT, unsigned(CUE_TIME, time) + element(CUE_POSITIONS, unsigned(CUE_TRACK, 1) + unsigned(CUE_CLUSTER, len(body))))
        body += element(CLUSTER, blocks)
    return element(EBML, element(DOC_TYPE, b"matroska")) + element(SEGMENT, body + element(CUES, cues))


def number(data: bytes, at: int, marker: bool) -> tuple[int, int]:
    """A variable-length number at a place, with or without its length marker, and where it ends; size -1: unknown."""
    first = data[at]
    k = 9 - first.bit_length()
    if k > 8 or at + k > len(data):
        raise ValueError(f"no variable-length number at byte {at}")
    n = int.from_bytes(data[at : at + k], "big")
    if marker:
        return n, at + k
    n &= (1 << 7 * k) - 1
    return (-1 if n == (1 << 7 * k) - 1 else n), at + k


def elements(data: bytes, at: int, end: int, stop: frozenset = frozenset()) -> Iterator[tuple[int, int, int]]:
    """(id, first byte, end) of the elements in a range; one of unknown size ends before the next sibling or parent."""
    while at < end:
        begin = at
        kind, at = number(data, at, True)
        if kind in stop:
            return
        size, at = number(data, at, False)
        if size < 0:
            stops = frozenset({CLUSTER} | LEVEL_ONE) if kind == CLUSTER else frozenset({EBML, SEGMENT})
            last = at
            for _, _, last in elements(data, at, end, stops):
                pass
            size = last - at
        if at + size > end:
            raise ValueError(f"the element at byte {begin} passes its parent's end")
        yield kind, at, at + size
        at += size


def frames_of(data: bytes, at: int, end: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Track, relative timestamp, flags and frames (offset, size) of a block."""
    track, at = number(data, at, False)
    relative, flags = struct.unpack_from(">hB", data, at)
    at += 3
    lacing = flags >> 1 & 3
    if not lacing:
        return track, relative, flags, [(at, end - at)]
    count, at, sizes = data[at] + 1, at + 1, []
    if lacing == 2:
        sizes = [(end - at) // count] * count
        if sum(sizes) != end - at:
            raise ValueError("fixed-size lacing of unequal frames")
    elif lacing == 1:
        for _ in range(count - 1):
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + data[at])
            at += 1
    else:
        size, at = number(data, at, False)
        sizes.append(size)
        for _ in range(count - 2):
            n, after = number(data, at, False)
            k = after - at
            n = (1 << 7 * k) - 1 if n < 0 else n
            sizes.append(sizes[-1] + n - ((1 << 7 * k - 1) - 1))
            at = after
    if lacing != 2:
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("a laced frame passes its block's end")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return track, relative, flags, out


def demux(data: bytes) -> tuple[list[tuple[int, int, bool, int, int]], list[tuple[int, int, int]]]:
    """Packets (track, timestamp in ns, key frame, offset, size) and cues (time in ns, track, cluster's offset)."""
    packets, cues, scale, frame_ns = [], [], 1_000_000, {}
    value = lambda a, b: int.from_bytes(data[a:b], "big")
    for top, a0, b0 in elements(data, 0, len(data)):
        if top != SEGMENT:
            continue
        for kind, a, b in elements(data, a0, b0):
            if kind == INFO:
                scale = next((value(x, y) for k, x, y in elements(data, a, b) if k == SCALE), scale)
            elif kind == TRACKS:
                for _, x, y in (e for e in elements(data, a, b) if e[0] == TRACK_ENTRY):
                    entry = {k: value(p, q) for k, p, q in elements(data, x, y) if k in (TRACK_NUMBER, DEFAULT_DURATION)}
                    frame_ns[entry.get(TRACK_NUMBER)] = entry.get(DEFAULT_DURATION, 0)
            elif kind == CLUSTER:
                time = 0
                for k, x, y in elements(data, a, b):
                    if k == TIMESTAMP:
                        time = value(x, y)
                    elif k in (SIMPLE_BLOCK, BLOCK_GROUP):
                        key = None
                        if k == BLOCK_GROUP:
                            inside = list(elements(data, x, y))
                            key = all(e[0] != REFERENCE_BLOCK for e in inside)
                            _, x, y = next(e for e in inside if e[0] == BLOCK)
                        track, relative, flags, frames = frames_of(data, x, y)
                        start = (time + relative) * scale
                        for n, (offset, size) in enumerate(frames):
                            packets.append((track, start + n * frame_ns.get(track, 0), flags >= 0x80 if key is None else key, offset, size))
            elif kind == CUES:
                for _, x, y in (e for e in elements(data, a, b) if e[0] == CUE_POINT):
                    point = list(elements(data, x, y))
                    at = next((value(p, q) for k, p, q in point if k == CUE_TIME), 0) * scale
                    for _, p, q in (e for e in point if e[0] == CUE_POSITIONS):
                        where = {k: value(s, t) for k, s, t in elements(data, p, q)}
                        cues.append((at, where.get(CUE_TRACK), a0 + where.get(CUE_CLUSTER, 0)))
    return packets, cues


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0), len(raw)


def media_column(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) as (doc_id, n_bytes, media): the UTF-8 text, padded, as a Matroska file."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                made = [padded(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([n for _, n in made], pa.int64()), pa.array([mux(p) for p, _ in made], pa.binary())],
                    names=["doc_id", "n_bytes", "media"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


PACKET = pa.struct([("track", pa.int32()), ("timestamp_ns", pa.int64()), ("key_frame", pa.bool_()), ("byte_offset", pa.int64()), ("n_bytes", pa.int64())])


def with_packets(media: DataFrame) -> DataFrame:
    """Files (doc_id, n_bytes, media) with their packets, an array of structs, and the error of those that have none."""
    ship(media.sparkSession)
    names = ["doc_id", "n_bytes", "media", "packets", "error"]

    def parsed(data: bytes | None) -> tuple[list[dict] | None, str | None]:
        if data is None:
            return None, "no media"
        try:
            return [dict(zip(PACKET.names, p)) for p in demux(data)[0]], None
        except (ValueError, IndexError, struct.error, StopIteration) as e:
            return None, str(e) or type(e).__name__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                found = [parsed(x) for x in batch.column("media").to_pylist()]
                added = [pa.array([p for p, _ in found], pa.list_(PACKET)), pa.array([e for _, e in found], pa.string())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:3]), *added], names=names)

    packet = "array<struct<track:int,timestamp_ns:bigint,key_frame:boolean,byte_offset:bigint,n_bytes:bigint>>"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id long, n_bytes long, media binary, packets {packet}, error string")


def packet_table(media: DataFrame) -> DataFrame:
    """A row for each packet of each file (doc_id, media): packet, track, timestamp_ns, key_frame, byte_offset, n_bytes; a
    null or malformed file has one row with its error."""
    sized = media.select("doc_id", F.lit(None).cast("long").alias("n_bytes"), "media")
    rows = with_packets(sized).select("doc_id", "error", F.posexplode_outer("packets").alias("packet", "p"))
    return rows.select("doc_id", "packet", *[F.col(f"p.{c}") for c in PACKET.names], "error")


def feature(samples: np.ndarray, packets: int) -> str:
    """Integer features of 8-bit samples: packets, sum, sum of squares, crossings of the middle, highest, distinct values."""
    x = samples.astype(np.int64)
    if not len(x):
        return f"packets={packets};sum=0;squares=0;crossings=0;max=0;distinct=0"
    crossings = int(np.count_nonzero(np.diff(samples >= 128)))
    return f"packets={packets};sum={int(x.sum())};squares={int((x * x).sum())};crossings={crossings};max={int(x.max())};distinct={len(np.unique(samples))}"


def media_features(files: DataFrame) -> DataFrame:
    """Files with_packets, their packets' byte ranges read back, as payload and media digests, a feature string, the number of
    packets, the time of the last one and the error."""
    ship(files.sparkSession)
    out = (
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
        "feature string, n_packets long, last_timestamp_ns long, error string"
    )
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [x.split()[0] for x in out.split(", ")]

    def row(doc: int | None, n: int | None, data: bytes | None, packets: list[dict] | None, error: str | None) -> tuple:
        whole = (None, None) if data is None else (len(data), hashlib.sha256(data).hexdigest())
        if not packets:
            return (doc, n, None, None, None, *whole, None, None, None, error or "no packets")
        payload = b"".join([data[p["byte_offset"] : p["byte_offset"] + p["n_bytes"]] for p in packets])
        told = feature(np.frombuffer(payload, np.uint8), len(packets))
        return (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *whole, told, len(packets), packets[-1]["timestamp_ns"], error)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)):
                rows = [row(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media", "packets", "error")))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names=names)

    return files.mapInArrow(run, out)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(with_packets(stored(media_column(table(spark, sf_dir, "documents")), "media")))
