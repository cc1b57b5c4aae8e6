"""Token ids by content-defined chunks: chunks that texts share are encoded once, and their joins are repaired.

A rolling hash of the last 32 bytes cuts texts where its top bits are zero, so the same passage is cut alike wherever it stands.
A worker keeps the chunks it has met, within a bound, and encodes each as a text of its own. At a cut the ids of a chunk may
differ from those of the whole text, so both its edges are looked at once: its beginning up to a gap (a space or line break) is
encoded anew and must give the very ids the chunk begins with, else the next gap but one, but three ... is tried; so with its end.
What lies between the agreed edges keeps its ids. Where two chunks join, the end of one and the beginning of the other are encoded
as one piece. A chunk without agreed edges is a piece as a whole, so a text without gaps is encoded as it is.

That is exact for tokenizers that neither keep white space nor join characters over it; texts of others are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from evidra.llm.common import by_bytes, lean, ship, table
from evidra.llm.word_tokens import TextEncoder

#: Bytes that the rolling hash sees, and the bits of it that are zero at a cut: a chunk has 256 bytes on average.
WINDOW, BITS = 32, 8
#: Chunks and pieces that a worker keeps; the older half goes when they are more.
CHUNKS, PIECES = 60_000, 200_000
#: Longer pieces are encoded, but not kept.
LONG_PIECE = 200
GAP = re.compile("[ \n]")
GEAR = np.random.default_rng(32).integers(0, 1 << 32, 256, dtype=np.uint32)
_ENCODERS: dict[str, "ChunkEncoder"] = {}


def encoder(path: str) -> "ChunkEncoder":
    """The encoder of a vocabulary file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def cuts(raw: np.ndarray, begins: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places in the bytes of texts, which begin at `begins`, at which a chunk begins: behind a window within one text whose hash
    says so, moved on to the beginning of a character."""
    h = GEAR[raw]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    at = np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1
    while len(at):
        inside = at < len(raw)
        at = at[inside]
        odd = raw[at] & 0xC0 == 0x80
        if not odd.any():
            break
        at = np.unique(at + odd)
    text = np.searchsorted(begins, at, side="right") - 1
    return at[at - begins[text] >= WINDOW]


class Kept(dict):
    """A table that forgets the older half of its entries when it has more than `most`."""

    def __init__(self, most: int):
        self.most = most

    def trim(self) -> None:
        if len(self) > self.most:
            for key in list(self)[: len(self) - self.most // 2]:
                del self[key]


class ChunkEncoder:
    """encode(texts): ids of an Arrow array of texts, unsigned 32-bit, and where each text's ids begin and end; decode(ids,
    bounds): their texts as the library gives them, special tokens kept. `encoded` counts the bytes of chunks and pieces that
    were given to the tokenizer, `met` those of all texts."""

    def __init__(self, path: str, bits: int = BITS, chunks: int = CHUNKS, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.text_encoder = TextEncoder(path)
        self.tokenizer = self.text_encoder.tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.splits = self.text_encoder.by_word
        self.bits, self.chunks, self.pieces = bits, Kept(chunks), Kept(pieces)
        self.met = self.encoded = 0
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = pa.array([self.tokenizer.id_to_token(i) for i in range(size)], pa.large_string())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not self.splits:
            return self.text_encoder.encode(texts.cast(pa.string()))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
        begins = offsets[:-1] - offsets[0]
        self.met += len(raw)
        at = np.unique(np.concatenate([begins, cuts(raw, begins, self.bits), [len(raw)]]))
        data = raw.tobytes()
        edges = at.tolist()
        names = [data[a:b] for a, b in zip(edges, edges[1:])]
        known = self._known(names)
        first = np.searchsorted(at, begins).tolist()
        last = [*first[1:], len(names)]
        whole = (offsets[1:] > offsets[:-1]).tolist()
        parts: list[bytes | None] = []  # None stands for a piece
        pieces: list[str] = []
        counts = []
        for i, j, full in zip(first, last, whole):
            before = len(parts)
            join = ""
            for head, body, tail in known[i:j] if full else ():
                if tail is None:
                    join += head
                    continue
                pieces.append(join + head)
                parts += (None, body)
                join = tail
            if join:
                pieces.append(join)
                parts.append(None)
            counts.append(len(parts) - before)
        found = iter(self._piece_ids(pieces))
        parts = [next(found) if p is None else p for p in parts]
        ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))]) // 4
        return np.frombuffer(b"".join(parts), "<u4"), ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]

    def _known(self, names: list[bytes]) -> list[tuple[str, bytes, str | None]]:
        """Of each chunk the text before the ids that stay, these ids, and the text behind; (text, b"", None) if none stay."""
        get = self.chunks.get
        known = [get(c) for c in names]
        new = list({c: None for c, k in zip(names, known) if k is None})
        if new:
            self.chunks.trim()
            made = dict(zip(new, self._agreed([c.decode() for c in new])))
            self.chunks.update(made)
            known = [made[c] if k is None else k for c, k in zip(names, known)]
        return known

    def _agreed(self, chunks: list[str]) -> list[tuple[str, bytes, str | None]]:
        """Chunks encoded each for itself, with edges that agree when encoded anew."""
        ids, bounds = self._library(chunks)
        raw = ids.tobytes()
        own = [raw[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]
        out: list = [(c, b"", None) for c in chunks]
        live, skip = [i for i, c in enumerate(chunks) if GAP.search(c)], 0
        while live:
            edges = [_edges(chunks[i], skip) for i in live]
            found = self._piece_ids([e for pair in edges for e in pair])
            again = []
            for k, i in enumerate(live):
                head, tail = found[2 * k], found[2 * k + 1]
                if own[i].startswith(head) and own[i].endswith(tail) and len(head) + len(tail) <= len(own[i]):
                    out[i] = (edges[k][0], own[i][len(head) : len(own[i]) - len(tail)], edges[k][1])
                elif 4 * skip + 3 <= len(GAP.findall(chunks[i])):
                    again.append(i)
            live, skip = again, 2 * skip + 1
        return out

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        get = self.pieces.get
        found = [get(p) for p in pieces]
        new = list({p: None for p, ids in zip(pieces, found) if ids is None})
        if new:
            self.pieces.trim()
            ids, bounds = self._library(new)
            raw = ids.tobytes()
            made = {p: raw[4 * a : 4 * b] for p, a, b in zip(new, bounds, bounds[1:])}
            self.pieces.update((p, ids) for p, ids in made.items() if len(p) <= LONG_PIECE)
            found = [made[p] if ids is None else ids for p, ids in zip(pieces, found)]
        return found

    def _library(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Texts encoded each for itself by the library, whose words are looked up once."""
        self.encoded += sum(map(len, texts))
        ids, bounds = self.text_encoder.encode(pa.array(texts, pa.string()))
        return ids, bounds.tolist()

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        if self.tokenizer.decoder is not None:
            texts = self.tokenizer.decode_batch([ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])], skip_special_tokens=False)
            return pa.array(texts, pa.large_string())
        return joined(self.tokens.take(pa.array(ids)), bounds)  # without a decoder the library joins tokens by spaces


def _edges(text: str, skip: int) -> tuple[str, str]:
    """What stands before the first gap of a text and behind the last, `skip` gaps at either end passed over."""
    if not skip:
        return text[: GAP.search(text).start()], text[max(text.rfind(" "), text.rfind("\n")) + 1 :]
    gaps = [m.start() for m in GAP.finditer(text)]
    return text[: gaps[skip]], text[gaps[-1 - skip] + 1 :]


def joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Lists of words, each as one text with single spaces."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words), pa.scalar(" ", pa.large_string()))


def _sha256(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer() if t.is_valid else b"").hexdigest() for t in texts], pa.string())


def _encoded(docs: DataFrame, path: str, schema: str, columns) -> DataFrame:
    """doc_id and what columns(encoder, ids, bounds) gives of each slice of texts."""
    ship(docs.sparkSession)
    names = ["doc_id", *[x.split()[0] for x in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            e = encoder(path)
            ids, bounds = e.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns(e, ids, bounds)], names=names)

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(lean(run), f"doc_id long, {schema}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text), by the vocabulary file at `path` on every worker.

    A null or empty text has no ids; null doc_ids and repeated rows stay as they are; other columns are left out. A text is
    encoded whole, however long."""
    def columns(e: ChunkEncoder, ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))]

    return _encoded(docs, path, "ids array<int>", columns)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids) as the library decodes them; of null ids or none an empty text."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), encoder(path).decode(ids.astype(np.uint32), bounds).cast(pa.string())], names=["doc_id", "text"])

    return encoded.selectExpr("CAST(doc_id AS LONG) AS doc_id", "ids").mapInArrow(lean(run), "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids (decimal, by spaces) and of the text they decode to."""
    def columns(e: ChunkEncoder, ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        numbers = joined(pa.array(ids).cast(pa.large_string()), bounds)
        return [pa.array(np.diff(bounds), pa.int64()), _sha256(numbers), _sha256(e.decode(ids, bounds))]

    return _encoded(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def op11_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
