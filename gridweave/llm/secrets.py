"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the character trigrams that any match must contain,
after R. Cox, "Regular Expression Matching with a Trigram Index": the parse tree is folded bottom-up into exact strings,
prefixes, suffixes and a required query. Texts are indexed block by block: postings (one bit per document) of the trigrams
that some query names; a query intersects and unites postings, and only the documents that remain are verified by the
regular expression, on their whole text. A rule whose expression has no mandatory trigram (the long hexadecimal runs) scans
every document. The index of a block lives only as long as the block, so there is no shuffle and memory is bounded.

Trigrams are over ASCII-lower-cased UTF-8 bytes, so a query never misses a match of either case.

Defined results: a null text is empty; texts of any length are scanned whole; spans of different kinds may overlap and are all
reported, by start and then kind; repeated rows get equal results; a null id is an id; an empty table gives an empty table;
extra columns are ignored.
"""

from __future__ import annotations

import re
import re._constants as C
import re._parser as parser
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.textblock import blocks, in_batches, utf8

#: Strings kept exactly, and longest affix, while a query is derived.
MAX_EXACT = 16
MAX_SET = 24


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``accept`` keeps or drops a match of ``pattern``, without another try inside it."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = field(default=lambda m: True)
    flags: int = re.ASCII


def _long_value(m: re.Match) -> bool:
    return len(m.group(2)) >= 8


#: The base rules, in the order in which equal starts are listed, then the further ones.
RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _long_value, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("source_host", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"\b[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]++:[^\s/:@]++@"),
]
BASE = ("assign", "access", "hex")

# A query is True (no condition), a trigram, or ("and" | "or", frozenset of queries).


def _all(*queries):  # noqa: ANN002, ANN202
    parts: set = set()
    for q in queries:
        if q is not True:
            parts |= q[1] if isinstance(q, tuple) and q[0] == "and" else {q}
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _any(*queries):  # noqa: ANN002, ANN202
    parts: set = set()
    for q in queries:
        if q is True:
            return True
        parts |= q[1] if isinstance(q, tuple) and q[0] == "or" else {q}
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _grams(text: str):  # noqa: ANN202
    return _all(*(text[i : i + 3] for i in range(len(text) - 2)))


@dataclass
class Info:
    """exact: all strings of the expression, or None; else its prefixes and suffixes, and what every match contains."""

    exact: frozenset | None
    prefix: frozenset
    suffix: frozenset
    match: object = True

    @classmethod
    def strings(cls, values: set[str]) -> Info:
        return cls(frozenset(values), frozenset(), frozenset())

    @classmethod
    def unknown(cls) -> Info:
        return cls(None, frozenset([""]), frozenset([""]))

    def open(self) -> Info:
        """The same without exact strings."""
        if self.exact is None:
            return self
        return Info(None, frozenset(s[:3] for s in self.exact), frozenset(s[-3:] for s in self.exact), _any(*map(_grams, self.exact)))


def _small(strings: set[str], cut: slice) -> frozenset:
    """The set with shorter strings where it is large; an empty string stands for anything."""
    while len(strings) > MAX_SET:
        strings = {s[cut] for s in strings}
    return frozenset(strings)


def _concat(a: Info, b: Info) -> Info:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_EXACT:
        return Info.strings({x + y for x, y in product(a.exact, b.exact)})
    left = a.exact if a.exact is not None else a.suffix
    right = b.exact if b.exact is not None else b.prefix
    bridge = _any(*(_grams(x[-2:] + y[:2]) for x, y in product(left, right)))
    opened_a, opened_b = a.open(), b.open()
    prefix = {x + y for x, y in product(a.exact, right)} if a.exact is not None else set(a.prefix)
    suffix = {x + y for x, y in product(left, b.exact)} if b.exact is not None else set(b.suffix)
    return Info(
        None,
        _small({s[:3] for s in prefix}, slice(0, -1)),
        _small({s[-3:] for s in suffix}, slice(1, None)),
        _all(opened_a.match, opened_b.match, bridge),
    )


def _alternate(a: Info, b: Info) -> Info:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MAX_EXACT:
        return Info.strings(set(a.exact | b.exact))
    a, b = a.open(), b.open()
    return Info(None, _small(set(a.prefix | b.prefix), slice(0, -1)), _small(set(a.suffix | b.suffix), slice(1, None)), _any(a.match, b.match))


def _folded(code: int) -> str | None:
    """The lower-cased character, or None beyond ASCII."""
    return chr(code).lower() if code < 128 else None


def _class(items) -> Info:  # noqa: ANN001
    values: set[str] = set()
    for op, arg in items:
        codes = [arg] if op is C.LITERAL else range(arg[0], arg[1] + 1) if op is C.RANGE else None
        if codes is None or len(codes) > 64:
            return Info.unknown()
        values |= {_folded(c) for c in codes}
    return Info.unknown() if None in values or len(values) > MAX_EXACT else Info.strings(values)


def _derive(tree) -> Info:  # noqa: ANN001
    out = Info.strings({""})
    for op, arg in tree:
        if op is C.LITERAL:
            c = _folded(arg)
            part = Info.unknown() if c is None else Info.strings({c})
        elif op is C.IN:
            part = _class(arg)
        elif op is C.SUBPATTERN:
            part = _derive(arg[3])
        elif op is C.BRANCH:
            part = _derive(arg[1][0])
            for other in arg[1][1:]:
                part = _alternate(part, _derive(other))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, inner = arg
            once = _derive(inner)
            if low == 0:
                part = _alternate(Info.strings({""}), once) if high == 1 else Info.unknown()
            else:
                part = Info.strings({""})
                for _ in range(min(low, 3)):
                    part = _concat(part, once)
                if high > min(low, 3):
                    part = _concat(_concat(part, Info.unknown()), once) if low > 3 else _concat(part, Info.unknown())
        elif op is C.AT or op in (C.ASSERT, C.ASSERT_NOT):
            continue
        else:
            part = Info.unknown()
        out = _concat(out, part)
    return out


def trigram_query(pattern: str, flags: int = 0):  # noqa: ANN201
    """Boolean query over lower-case trigrams that the text of any match satisfies; True if none is mandatory."""
    return _derive(parser.parse(pattern, flags)).open().match


def query_trigrams(query) -> set[str]:  # noqa: ANN001
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(query_trigrams, query[1]))


class TrigramIndex:
    """Postings of a block of texts for a fixed set of trigrams."""

    def __init__(self, rules: list[Rule]) -> None:
        self.queries = [trigram_query(r.pattern, r.flags) for r in rules]
        names = sorted(set().union(*map(query_trigrams, self.queries)))
        self.number = {g: i for i, g in enumerate(names)}
        self.slot = np.full(1 << 21, -1, np.int16)
        for g, i in self.number.items():
            self.slot[(ord(g[0]) << 14) | (ord(g[1]) << 7) | ord(g[2])] = i
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def postings(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(trigram, document) bits."""
        out = np.zeros((len(self.number), len(offsets) - 1), bool)
        if len(raw) < 3:
            return out
        low = self.lower[raw].astype(np.int32)
        code = (low[:-2] << 14) | (low[1:-1] << 7) | low[2:]
        ascii_only = (low[:-2] | low[1:-1] | low[2:]) < 128
        slot = self.slot[np.where(ascii_only, code, 0)]
        at = np.flatnonzero(slot >= 0)
        row = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[row + 1]
        out[slot[at[inside]], row[inside]] = True
        return out

    def candidates(self, query, postings: np.ndarray) -> np.ndarray:  # noqa: ANN001
        """Documents that satisfy a query."""
        if query is True:
            return np.ones(postings.shape[1], bool)
        if isinstance(query, str):
            return postings[self.number[query]]
        parts = [self.candidates(q, postings) for q in query[1]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


def scan_texts(column: pa.Array, rules: list[Rule], index: TrigramIndex, compiled: list[re.Pattern]) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) of the accepted matches of each text, by start and rule, in characters."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(column))]
    postings = index.postings(*utf8(column))
    for k, rule in enumerate(rules):
        for i in np.flatnonzero(index.candidates(index.queries[k], postings)).tolist():
            found[i] += [(m.start(), k, m.end()) for m in compiled[k].finditer(column[i].as_py()) if rule.accept(m)]
    return [sorted(x) for x in found]


def secret_spans(documents: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``doc_id, spans``: spans are (kind, start, end) structs of every document, by start."""
    rules = rules or RULES
    kind = dict(documents.dtypes)["doc_id"]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, compiled = TrigramIndex(rules), [re.compile(r.pattern, r.flags) for r in rules]
        for batch in batches:
            for part in blocks(batch):
                rows = scan_texts(part.column("text"), rules, index, compiled)
                spans = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in own] for own in rows]
                yield pa.record_batch([part.column("doc_id"), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    return in_batches(documents.select("doc_id", "text"), scan, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int>>")


def op4_query(documents: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    def listed(spans):  # noqa: ANN001, ANN202
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):  # noqa: ANN202
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return secret_spans(documents).select(
        "doc_id",
        *map(count, BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
