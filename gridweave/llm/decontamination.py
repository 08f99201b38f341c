"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A benchmark item leaks into a document where a stretch of the document is within an edit budget of the item, RATE of its
length rounded down, or of a passage of it: every item of more than PASSAGE characters has passages of PASSAGE characters
every PASSAGE_STEP, each with the budget of its own length (PASSAGE_EDITS = 4). So PASSAGE + PASSAGE_STEP - 1 = 69
characters in a row of any item are found, verbatim or with four edits. Both rules hold for items of every length: an item
of more than WHOLE characters is not searched as a whole because it need not be (with k edits at most in n characters, five
or more in each of n / PASSAGE disjoint passages would exceed RATE * n, so some passage is within its budget). Upper case of
Latin-1 and white-space characters are folded one to one, so positions stay those of the text; everything else is compared
as it is.

Filter. With k edits, an occurrence of a segment of m characters shares at least m - Q + 1 - k * Q of its q-grams with the
text (the q-gram lemma), and their diagonals (place in the text minus place in the segment) span at most k. So:
1. places of the text whose q-gram occurs in the benchmark at all are marked (exact 8-byte codes, bitmap first); only
   windows with as many marks as the weakest segment of a length class needs go on;
2. the marks of these windows are expanded to (segment, diagonal) and counted in bands of 2 (k + 1) diagonals that overlap
   by half, so that any run of k + 1 diagonals lies inside a band; bands that reach the bound are retained;
3. each retained region is verified by a semi-global alignment limited to the diagonals of its band.
The filter loses no occurrence within the budget. Characters outside Latin-1 share one code in steps 1 and 2, which can
only add regions; the alignment compares them exactly.

Documents are read once and never shuffled. The benchmark is shipped in shards of at most SHARD_CHARS characters (the size
is counted first); a larger benchmark takes more passes over the documents, each with a bounded index.

An item for whose length and budget the lemma asks for no shared q-gram (below Q characters, and a few lengths above 12) is
found by pieces instead: of k + 1 pieces one occurs unchanged; all pieces are looked up in one pass of an automaton.

Defined results: null texts and items match nothing; equal items are all reported; repeated documents are each reported; a
null id is an id; texts of any length are searched whole, in blocks; of equally good places of a passage the first is
reported, overlapping regions of an item as one; empty tables give an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.textblock import blocks, in_batches

Q = 8
RATE = 0.08
PASSAGE = 60
PASSAGE_STEP = 10
PASSAGE_EDITS = int(RATE * PASSAGE)
#: Beyond this an item within its budget always has a passage within its own: (PASSAGE_EDITS + 1) * (n // PASSAGE) > RATE * n.
WHOLE = 1_500
SHARD_CHARS = 1_000_000
#: Segments whose lengths differ by less than this factor share a window test.
CLASS_RATIO = 1.3
BITMAP_BITS = 22
_MIX = np.uint64(0x9E3779B97F4A7C15)

Region = tuple[int, int, int]


def _fold_table() -> bytes:
    out = bytearray(range(256))
    for i in range(256):
        lower = chr(i).lower()
        if chr(i).isspace():
            out[i] = 32
        elif len(lower) == 1 and ord(lower) < 256:
            out[i] = ord(lower)
    return bytes(out)


FOLD = _fold_table()
_FOLD_MAP = {i: x for i, x in enumerate(FOLD) if i != x} | {c: 32 for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


def folded(text: str) -> str:
    """The text with case and white space folded, character by character."""
    return text.translate(_FOLD_MAP)


def _narrow(text: str) -> bytes:
    return text.encode("latin-1", "replace").translate(FOLD)


def _codes(raw: bytes) -> np.ndarray:
    """The 8-byte code at each place."""
    n = len(raw) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(min(Q, max(n, 0))):
        part = out[j::Q]
        part[:] = np.frombuffer(raw, "<u8", len(part), j)
    return out


def budget(length: int) -> int:
    return int(RATE * length)


def passages(item: str) -> list[str]:
    """The short stretches of a folded item whose quotation alone is a leak."""
    if len(item) <= PASSAGE:
        return []
    starts = [*range(0, len(item) - PASSAGE, PASSAGE_STEP), len(item) - PASSAGE]
    return [item[s : s + PASSAGE] for s in starts]


class QGramIndex:
    """Q-grams of a benchmark shard, and the search of texts against it."""

    def __init__(self, items: list[str]) -> None:
        """items: texts; results name them by position."""
        self.parts: list[tuple[int, str]] = []
        edits: list[int] = []
        short: dict[str, list[tuple[int, str, int, int]]] = defaultdict(list)
        for number, item in enumerate(items):
            plain = folded(item).strip()
            if not plain:
                continue
            for part in [plain] * (len(plain) <= WHOLE) + passages(plain):
                k = budget(len(part))
                if len(part) - Q + 1 - k * Q >= 1:
                    self.parts.append((number, part))
                    edits.append(k)
                    continue
                cuts = [j * len(part) // (k + 1) for j in range(k + 2)]
                for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                    short[_narrow(part[start:stop]).decode("latin-1")].append((number, part, k, start))
        self.pieces = ahocorasick.Automaton()
        for piece, owners in short.items():
            self.pieces.add_word(piece, (len(piece), owners))
        if short:
            self.pieces.make_automaton()
        self.size = np.array([len(s) for _, s in self.parts], np.int64)
        self.edits = np.array(edits, np.int64)
        self.need = self.size - Q + 1 - self.edits * Q
        each = [_codes(_narrow(s)) for _, s in self.parts]
        codes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
        place = np.concatenate([np.arange(len(x)) for x in each]) if each else np.zeros(0, np.int64)
        order = np.argsort(codes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.codes, self.first, self.count = np.unique(codes[order], return_index=True, return_counts=True)
        self.bitmap = np.zeros(1 << BITMAP_BITS, bool)
        self.bitmap[self._slot(self.codes)] = True
        self.classes = self._classes()

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return ((codes * _MIX) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)

    def _classes(self) -> list[tuple[int, int]]:
        """(window, marks needed) of each length class."""
        out, order = [], np.argsort(self.size)
        while len(order):
            own = order[self.size[order] <= CLASS_RATIO * self.size[order[0]]]
            out.append((int((self.size + self.edits)[own].max()), int(self.need[own].min())))
            order = order[len(own) :]
        return out

    def regions(self, texts: list[str]) -> dict[int, dict[int, list[Region]]]:
        """Per text with a leak: item position to (start, end, edits) of its merged regions."""
        found: dict[int, dict[int, list[Region]]] = defaultdict(lambda: defaultdict(list))
        stops = np.cumsum([len(t) for t in texts])
        raw = _narrow("".join(texts))
        for last, (size, owners) in self.pieces.iter(raw.decode("latin-1")) if len(self.pieces) else ():
            i = int(np.searchsorted(stops, last, side="right"))
            begin = int(stops[i]) - len(texts[i])
            for number, pattern, k, offset in owners:
                start = max(last + 1 - size - offset - k, begin)
                window = folded(texts[i][start - begin : start - begin + len(pattern) + 2 * k])
                if hit := align(pattern, window, k):
                    found[i][number].append((start - begin + hit[0], start - begin + hit[1], hit[2]))
        for part, low, high in self._retained(raw):
            number, pattern = self.parts[part]
            k = int(self.edits[part])
            for i in range(int(np.searchsorted(stops, max(low, 0), side="right")), len(texts)):
                begin = int(stops[i]) - len(texts[i])
                if begin >= high + len(pattern):
                    break
                start, stop = max(low, begin), min(high + len(pattern), int(stops[i]))
                if stop - start >= len(pattern) - k:
                    window = folded(texts[i][start - begin : stop - begin])
                    if hit := align(pattern, window, k):
                        found[i][number].append((start - begin + hit[0], start - begin + hit[1], hit[2]))
        return {i: {n: _merged(r) for n, r in own.items()} for i, own in found.items()}

    def _retained(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(segment, first diagonal, end of its diagonals) of the bands that meet the bound."""
        codes = _codes(raw)
        if not len(codes) or not self.classes:
            return []
        mark = self.bitmap[self._slot(codes)]
        total = np.concatenate([[0], np.cumsum(mark, dtype=np.int32)])
        inside = np.zeros(len(codes), bool)
        for window, need in self.classes:
            ends = np.minimum(np.arange(len(codes)) + window, len(codes))
            full = np.concatenate([[0], np.cumsum(total[ends] - total[:-1] >= need, dtype=np.int32)])
            if full[-1]:
                inside |= full[1:] - full[np.maximum(np.arange(len(codes)) - window + 1, 0)] > 0
        at = np.flatnonzero(mark & inside)
        if not len(at):
            return []
        slot = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        same = self.codes[slot] == codes[at]
        at, slot = at[same], slot[same]
        count = self.count[slot]
        entry = np.repeat(self.first[slot] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        part = self.owner[entry]
        diagonal = np.repeat(at, count) - self.place[entry]
        width = self.edits[part] + 1
        band = diagonal // width
        key = np.concatenate([part, part]) * (1 << 40) + np.concatenate([band, band - 1]) + (1 << 30)
        keys, counts = np.unique(key, return_counts=True)
        part, band = keys >> 40, (keys & ((1 << 40) - 1)) - (1 << 30)
        good = counts >= self.need[part]
        width = self.edits[part] + 1
        return list(zip(part[good].tolist(), (band * width)[good].tolist(), ((band + 2) * width)[good].tolist(), strict=True))


def align(pattern: str, window: str, k: int) -> Region | None:
    """Best occurrence of ``pattern`` in ``window`` with at most ``k`` edits: (start, end, edits), or None."""
    at = window.find(pattern)
    if at >= 0:
        return at, at + len(pattern), 0
    if not k:
        return None
    a = np.array([ord(c) for c in pattern])
    b = np.array([ord(c) for c in window])
    cost, end = _banded(a, b, k, free_start=True)
    if cost > k:
        return None
    _, back = _banded(a[::-1], b[:end][::-1], k, free_start=False)
    return end - back, end, cost


def _banded(a: np.ndarray, b: np.ndarray, k: int, free_start: bool) -> tuple[int, int]:
    """Least cost of all of ``a`` against a stretch of ``b``, and the first end of such a stretch.

    Only diagonals that a path within the budget can use are kept: -k to len(b) - len(a) + k with a free start, -k to k
    with the start fixed.
    """
    low, high = -k, (max(len(b) - len(a), 0) + k if free_start else k)
    slots = np.arange(low, high + 1)
    large = len(a) + len(b) + 1
    row = np.where((slots >= 0) & (slots <= len(b)), 0 if free_start else slots, large)
    padded = np.concatenate([b, [-1]])
    for i in range(1, len(a) + 1):
        column = slots + i
        inside = (column >= 1) & (column <= len(b))
        match = padded[np.where(inside, column - 1, len(b))] == a[i - 1]
        diagonal = np.where(inside, row + ~match, large)
        above = np.concatenate([row[1:], [large]]) + 1
        best = np.where((column >= 0) & (column <= len(b)), np.minimum(diagonal, above), large)
        ramp = np.arange(len(slots))
        row = np.minimum(np.minimum.accumulate(best - ramp) + ramp, large)
        row = np.where((column >= 0) & (column <= len(b)), row, large)
    at = int(row.argmin())
    return int(row[at]), int(slots[at] + len(a))


def _merged(regions: list[Region]) -> list[Region]:
    """Overlapping regions as one; its edits are the most of any part."""
    out: list[Region] = []
    for start, end, edits in sorted(set(regions)):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), max(edits, out[-1][2]))
        else:
            out.append((start, end, edits))
    return out


def _shards(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Rows (item_id, text) of the benchmark in shards of about SHARD_CHARS characters."""
    items = benchmark.select("item_id", "text").where("trim(text) <> ''")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    number = -(-total // SHARD_CHARS)
    for k in range(number):
        yield sorted(map(tuple, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).collect()), key=lambda r: (str(r[0]), r[1]))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: one row per leaked region, in characters of the text, end exclusive."""
    docs = documents.select("doc_id", "text")
    kind = dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {dict(documents.dtypes)['doc_id']}, item_id {kind}, start int, end int, edits int"
    passes = []
    for shard in _shards(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast(shard)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = QGramIndex([text for _, text in shared.value])
            names = [name for name, _ in shared.value]
            for batch in batches:
                rows = []
                for part in blocks(batch):
                    ids = part.column("doc_id").to_pylist()
                    for i, own in sorted(index.regions(part.column("text").to_pylist()).items()):
                        rows += [(ids[i], names[n], *r) for n, regions in sorted(own.items()) for r in regions]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                types = [batch.schema.field("doc_id").type, pa.from_numpy_dtype(np.int64) if kind == "bigint" else None, *[pa.int32()] * 3]
                arrays = [pa.array(c, t or (pa.int32() if kind == "int" else pa.string())) for c, t in zip(columns, types, strict=True)]
                yield pa.record_batch(arrays, ["doc_id", "item_id", "start", "end", "edits"])

        passes.append(in_batches(docs, search, schema))
    if not passes:
        return documents.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, passes)


def keep_clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leaked region, with their own columns; no shuffle."""
    out = documents
    for shard in _shards(benchmark):
        shared = documents.sparkSession.sparkContext.broadcast([text for _, text in shard])

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            index = QGramIndex(shared.value)
            for batch in batches:
                keep = []
                for part in blocks(batch):
                    leaked = index.regions(part.column("text").to_pylist())
                    keep += [i not in leaked for i in range(part.num_rows)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        out = in_batches(out, clean, documents.schema)
    return out


def op8_query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The leaked regions of every document."""
    return leaks(documents, benchmark)
