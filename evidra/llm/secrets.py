"""Secret scans with a trigram inverted index.

Each rule's regular expression yields a Boolean query over trigrams that every match must contain. A batch of documents is
a segment: its postings, bitmaps by trigram, are built for the trigrams that some query names, each query intersects and
unites them, and the expression runs over the candidates only. A rule without mandatory trigrams scans all texts. Trigrams
are of UTF-8 bytes with A-Z lower-cased, so queries hold for expressions in either case.

Null or empty text: no spans. Very long texts are scanned whole. Spans that begin together are ordered by rule; `scan_documents` keeps
other columns, but those named as its own go. Repeated rows give repeated results; an empty table gives none; columns other than doc_id and
text are ignored. Spans are code points, the end exclusive, of whole matches; matches of a rule don't overlap.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.llm.common import ship, table, with_columns

MOST_STRINGS = 64
MOST_CHARACTERS = 4
SEGMENT = 2000
ALL = ("all",)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression and the least length of a group of it (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern)

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.regex.finditer(text) if len(m[self.group]) >= self.least]


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
#: A key from its header to its END line; where that is missing before the next dashes, to the end of its base64 lines (lines
#: of base64 only, or 16 characters and more of it), which newlines written as backslash and n may separate too.
_ENDED = r"[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
_LINES = (
    r"(?:(?:\s|\\[nr])++(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*+|[A-Za-z0-9+/]{16,}+=*+"
    r"|[A-Za-z0-9+/]++=*+(?=[ \t]*+(?:[\r\n]|\\[nr]|\Z))))*+"
)
MORE = (
    Rule("private_key", f"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:{_ENDED}|{_LINES})"),
    Rule("code_host_token", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("payment_key", "sk_live_[A-Za-z0-9]{16,}"),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]++:[^\s/:@]++@"),
)


def trigrams(text: str) -> set[int]:
    raw = text.encode()
    return {raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2] for i in range(len(raw) - 2)}


def both(a: tuple, b: tuple) -> tuple:
    return b if a == ALL else a if b == ALL or a == b else ("and", a, b)


def any_of(strings: set[str]) -> tuple:
    """What a text that holds one of the strings must have."""
    found = [trigrams(s) for s in sorted(strings)]
    if not found or not all(found):
        return ALL
    one = [("and", *sorted(t)) for t in found]
    return one[0] if len(one) == 1 else ("or", *one)


def lowered(code: int) -> str:
    return chr(code + 32) if 65 <= code <= 90 else chr(code)


def small_class(items: list) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(lowered(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 2 * MOST_CHARACTERS:
            out |= {lowered(c) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_CHARACTERS else None


def strings_of(op, arg) -> tuple[set[str] | None, tuple, bool]:
    """All strings a node can match, or None; else the query of what it contains; and whether it may go on after the strings."""
    if op is sre.LITERAL:
        return {lowered(arg)}, ALL, False
    if op is sre.IN:
        return small_class(arg), ALL, False
    if op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
        return {""}, ALL, False
    if op is sre.SUBPATTERN:
        return (*analysed(arg[-1]), False)
    if op is sre.BRANCH:
        parts = [analysed(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), ALL, False
        queries = [any_of(s) if s is not None else q for s, q in parts]
        return None, ALL if ALL in queries else ("or", *queries), False
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, inner = arg
        strings, query = analysed(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ALL, False
        if not least:
            return None, ALL, False
        if strings is not None and len(strings) == 1:
            return {next(iter(strings)) * min(least, 8)}, ALL, least != most or least > 8
        return (strings, ALL, least != most or least > 1) if strings is not None else (None, query, False)
    return None, ALL, False


def analysed(nodes) -> tuple[set[str] | None, tuple]:
    """All strings a sequence can match, or None and the query for what it must contain."""
    strings, query, exact = {""}, ALL, True
    for op, arg in nodes:
        own, inside, goes_on = strings_of(op, arg)
        joined = None if own is None else {a + b for a in strings for b in own}
        if joined is not None and len(joined) <= MOST_STRINGS and not goes_on:
            strings = joined
            continue
        exact = False
        if joined is not None and len(joined) <= MOST_STRINGS:
            query, strings = both(query, any_of(joined)), {""}
        elif own is not None:
            query, strings = both(both(query, any_of(strings)), any_of(own)), {""} if goes_on else own
        else:
            query, strings = both(both(query, any_of(strings)), inside), {""}
    return (strings, ALL) if exact else (None, both(query, any_of(strings)))


def trigram_query(pattern: str) -> tuple:
    strings, query = analysed(parser.parse(pattern))
    return any_of(strings) if strings is not None else query


def leaves(query) -> set[int]:
    if isinstance(query, tuple):
        return set().union(*(leaves(q) for q in query[1:]))
    return {int(query)}


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.names = np.array(sorted(set().union(*map(leaves, self.queries))), np.uint32)
        self.row = {int(t): k for k, t in enumerate(self.names)}
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[self.names] = True
        self.lower = np.arange(256, dtype=np.uint32)
        self.lower[65:91] += 32

    def postings(self, texts: pa.Array) -> np.ndarray:
        """A bitmap of the segment's documents for each trigram."""
        found = np.zeros((len(self.names), len(texts)), bool)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        if data is None or offsets[-1] - offsets[0] < 3:
            return found
        step = 1 << 20
        for a in range(int(offsets[0]), int(offsets[-1]) - 2, step):
            raw = self.lower[np.frombuffer(data, np.uint8)[a : min(a + step + 2, int(offsets[-1]))]]
            code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
            at = np.flatnonzero(self.wanted[code])
            doc = np.searchsorted(offsets, at + a, side="right") - 1
            whole = at + a + 3 <= offsets[doc + 1]
            found[np.searchsorted(self.names, code[at[whole]]), doc[whole]] = True
        return found

    def candidates(self, query, found: np.ndarray) -> np.ndarray:
        if not isinstance(query, tuple):
            return found[self.row[int(query)]]
        if query == ALL:
            return np.ones(found.shape[1], bool)
        parts = [self.candidates(q, found) for q in query[1:]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, end, rule), by start, then rule."""
        texts = texts.cast(pa.string()).fill_null("")
        found, each = self.postings(texts), texts.to_numpy(zero_copy_only=False)
        out: list[list[tuple[int, int, int]]] = [[] for _ in each]
        for k, (rule, query) in enumerate(zip(self.rules, self.queries)):
            for i in np.flatnonzero(self.candidates(query, found)).tolist():
                out[i] += [(a, b, k) for a, b in rule.spans(each[i])]
        return [sorted(spans, key=lambda s: (s[0], s[2])) for spans in out]


def digest(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, b, k in spans)


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """docs with secret_spans, array<struct<kind, start, end>>, and redacted, the text with [SECRET] for them."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    own: list[Scanner] = []

    def compute(texts: pa.Array) -> list[pa.Array]:
        if not own:
            own.append(Scanner(rules))
        found = own[0].scan(texts)
        spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, b, k in s] for s in found]
        out = [redacted(t, s) if s else t for t, s in zip(texts.to_pylist(), found)]
        return [pa.array(spans, kind), pa.array(out, pa.string())]

    return with_columns(docs, "secret_spans array<struct<kind:string,start:bigint,end:bigint>>, redacted string", compute)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """docs whose text has [SECRET] for each secret."""
    return scan_documents(docs, rules).withColumn("text", F.col("redacted")).select(*docs.columns)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, b, _ in spans:
        if b > at:
            out += [text[at:a], "[SECRET]"] if a >= at else []
            at = b
    return "".join([*out, text[at:]])


def secret_digests(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """For each document the counts and digest of the base kinds' spans and the string of all spans."""
    ship(docs.sparkSession)
    base = len(BASE)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for whole in batches:
            for batch in (whole.slice(i, SEGMENT) for i in range(0, whole.num_rows, SEGMENT)):
                rows = []
                for doc, spans in zip(batch.column("doc_id").to_pylist(), scanner.scan(batch.column("text"))):
                    own = [s for s in spans if s[2] < base]
                    n = [sum(s[2] == k for s in own) for k in range(base)]
                    rows.append((doc, *n, hashlib.sha256(digest(own, rules).encode()).hexdigest(), digest(spans, rules)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, kinds)], names=names)

    out = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(table(spark, sf_dir, "documents"))
