"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once for a Python worker.

A tokenizer whose pre-tokenizer drops white space and never joins characters across it gives a text the ids of its
space-separated chunks, one after another. Arrow splits a batch of texts and finds its distinct chunks. A chunk of ASCII
and Latin-1 letters without an apostrophe consists of runs of letters and of other characters; any other chunk is taken
whole. These pieces are looked up in a bounded table; those not met before are encoded together by the library. Other
tokenizers get whole texts.
"""

from __future__ import annotations

import gc
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNSAFE = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-ÿ]|'")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
#: A mark after a letter and before white space begins a new piece in any case.
MARKED = "([a-z])([.,]) "
CACHE_LIMIT = 120_000
_ENCODERS: dict[str, "TextEncoder"] = {}


def encoder(path: str) -> "TextEncoder":
    """The encoder of a vocabulary file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in kept:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


class TextEncoder:
    """encode(texts): all ids of an Arrow array of texts, unsigned 32-bit, and where each text's ids begin and end."""

    def __init__(self, path: str, limit: int = CACHE_LIMIT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.by_word = spec["model"].get("end_of_word_suffix") == "</w>" and not any(re.search(r"\s", t) for t in self.added)
        if self.by_word:  # the same merges, for words that are normalised and mapped to byte characters already
            plain = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
            self.words = Tokenizer.from_str(json.dumps(plain))
            chars = byte_characters()
            self.odd = [(chr(b), chars[b]) for b in range(0x80, 0x100) if chars[b] != chr(b)]
            vocab = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            for token, i in vocab.items():
                self.ends[i] = token.endswith("</w>")
        self.limit = limit
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        on = gc.isenabled()
        gc.disable()  # many small objects that hold no cycles
        try:
            return self._encode(pc.fill_null(texts, ""))
        finally:
            if on:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            each = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.cumsum([0, *map(len, each)])
        texts = pc.replace_substring(texts, "\n", " ")
        if not any(pc.any(pc.match_substring(texts, t, ignore_case=True)).as_py() for t in self.added):
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), MARKED, r"\1 \2 ")
        split = pc.split_pattern(texts, " ")
        chunks = split.flatten().dictionary_encode()
        known = self._ids(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        length = np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = chunks.indices.to_numpy()
        n = length[codes]
        ends = np.cumsum(n)
        first = np.cumsum(length) - length
        table = np.frombuffer(b"".join(known), "<u4")
        ids = table[np.repeat(first[codes] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = split.offsets.to_numpy()
        return ids, np.concatenate([[0], ends])[bounds - bounds[0]]

    def _ids(self, chunks: list[str]) -> list[bytes]:
        known = [self.cache.get(c) for c in chunks]
        missing = [c for c, ids in zip(chunks, known) if ids is None]
        if not missing:
            return known
        if len(self.cache) + len(missing) > self.limit:
            self.cache, self.older = {c: ids for c, ids in zip(chunks, known) if ids is not None}, self.cache
        still = []
        for c in missing:
            if (ids := self.older.get(c)) is not None:
                self.cache[c] = ids
            else:
                still.append(c)
        plain, whole, words = {}, [], []
        for c in still:
            if LETTERS.fullmatch(c):
                words.append(c)
            elif UNSAFE.search(c) or any(t in c for t in self.added):
                whole.append(c)
            else:
                plain[c] = tuple(PIECES.findall(c.lower()))
        more = set().union(*plain.values()).difference(self.cache, words)
        words += [p for p in more if LETTERS.fullmatch(p)]
        whole += [p for p in more if not LETTERS.fullmatch(p)]
        for i in range(0, len(words), 8192):
            self._learn_words(words[i : i + 8192])
        for i in range(0, len(whole), 8192):
            self._learn_offsets(whole[i : i + 8192])
        get = self.cache.__getitem__
        for c, p in plain.items():
            if c not in self.cache:
                self.cache[c] = b"".join(map(get, p))
        return list(map(get, chunks))

    def _learn_words(self, words: list[str]) -> None:
        """Words of lower-case letters: each is one pre-token, so its ids end with the first one that ends a word."""
        text = " ".join(words).encode().decode("latin-1")
        for a, b in self.odd:
            text = text.replace(a, b)
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(stops) != len(words):
            self._learn_offsets(words)
            return
        raw = ids.tobytes()
        self.cache.update(zip(words, [raw[a:b] for a, b in zip([0, *stops], stops)]))

    def _learn_offsets(self, chunks: list[str]) -> None:
        """Any pieces: encoded as one text, told apart by the tokens' offsets."""
        e = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        raw = np.array(e.ids, "<u4").tobytes()
        first = np.cumsum([0] + [len(c) + 1 for c in chunks])
        cuts = (4 * np.searchsorted(np.array([a for a, _ in e.offsets], np.int64), first)).tolist()
        self.cache.update(zip(chunks, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
