"""Personal data: base patterns, and terms that give protected entities away.

Base spans are e-mail addresses, IP addresses, payment cards (Luhn) and phone numbers in whole texts.

Information-theoretic sanitisation. Every base value is a protected entity. A term (word of at least MIN_TERM characters,
anywhere in a document that holds an entity) discloses the entity e as far as the corpus says so: with N documents, n_e that
hold e, n_t that hold the term and n_te that hold both,

    IC(e) = log2(N / n_e),     PMI(e; t) = log2(N * n_te / (n_e * n_t)).

PMI equals IC where every document with t holds e. A term of PMI >= BETA * IC is above the disclosure threshold: it
is removed at full disclosure (PMI = IC) and generalised to the kind of thing it is otherwise, at each of its places in the
documents of that entity. Support is needed: the pair must occur in at least two documents, and the entity in two different
contexts (the WINDOW words either side of it) in the documents of the pair, so an unseen word beside a private address, or
plain copies of one page, prove nothing. All counts cover all documents.

Plan: four scans, none of which moves a text. The first writes the narrow table of entities and contexts; entities that meet
the support gate alone go into a fixed-size bitmap. The second counts the pairs of these entities and the distinct terms of
their documents, added up per task before the shuffle, so a hot entity costs one row per term and task; it also counts each
term's documents with any known entity, and as n_t is at least that, most pairs (all those of common words) are seen to lie
below the threshold at once. The third counts the documents of the terms that remain, first in one document of FORETASTE: what
is too common there already is too common in all, and what is left is so rare that tasks have little to send. False hits of a bitmap (of
bounded size, whatever the corpus) fall away in the joins. The last finds the spans with the (entity, term) table, which is shipped
in shards of about SHARD_PAIRS pairs, read one after another; a larger table takes more steps over the rows in the same scan.

Defined results: a null text is empty; texts of any length are read whole; overlapping base spans of different kinds are all
reported, and of several readings of a place the longest cut wins in ``sanitise``; repeated rows get equal spans and count
as rows in the statistics; a null id is an id; an empty table gives an empty table; extra columns are ignored by the query
and kept by ``sanitise``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.llm.textblock import blocks, in_batches, utf8
from gridweave.llm.words import words
from gridweave.plans.storage import materialise, release

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8
MIN_TERM = 3
BETA = 0.95
#: A bitmap has eight bits for each of its keys, from 2^20 to 2^27 bits (16 MB).
BITMAP_BITS = (20, 27)
#: Terms, or pairs, that a task adds up before it sends their counts.
TERMS_HELD = 500_000
#: Pairs of the disclosure table that are shipped at once, about 17 bytes each.
SHARD_PAIRS = 1_000_000
#: One document in so many is counted before all are.
FORETASTE = 8
#: Stands for "any known entity" where pairs are counted; no entity has this hash.
ANY = 0
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches in order, found from each @ outwards: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_BYTES:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            # The run of local characters up to this @ cannot match; a later match starts after it.
            done = at + 1
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the base matches, by start and kind."""
    out: list[Span] = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _suspects(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can hold a base match: an @, or at least four digits."""
    digit = np.concatenate([[0], np.cumsum((raw >= 48) & (raw <= 57), dtype=np.int32)])
    at = np.concatenate([[0], np.cumsum(raw == 64, dtype=np.int32)])
    return ((digit[offsets[1:]] - digit[offsets[:-1]]) >= 4) | (at[offsets[1:]] > at[offsets[:-1]])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _entity(text: str, span: Span) -> int:
    """Hash of a protected value and its kind."""
    start, kind, end = span
    return _signed(xxhash.xxh64_intdigest(f"{kind}:{text[start:end].lower()}", 1) or 1)


def _words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (characters) and hashes (signed) of all words."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _, hashes = words(raw, np.array([0, len(raw)]))
    place = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return place[starts], place[ends], hashes.view(np.int64)


def _free(starts: np.ndarray, ends: np.ndarray, spans: list[Span]) -> np.ndarray:
    """Which words lie outside the spans."""
    covered = np.zeros(len(starts), bool)
    for s, _, e in spans:
        covered[np.searchsorted(ends, s, side="right") : np.searchsorted(starts, e)] = True
    return ~covered


def contexts(text: str, spans: list[Span], found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> dict[int, tuple[int, int]]:
    """entity -> least and greatest hash of its contexts in the text: the WINDOW words either side, outside all spans."""
    starts, ends, hashes = found or _words(text)
    free = _free(starts, ends, spans)
    starts, hashes = starts[free], hashes[free]
    out: dict[int, tuple[int, int]] = {}
    for span in spans:
        entity, middle = _entity(text, span), int(np.searchsorted(starts, span[0]))
        context = _signed(xxhash.xxh64_intdigest(hashes[max(middle - WINDOW, 0) : middle + WINDOW].tobytes(), 2))
        low, high = out.get(entity, (context, context))
        out[entity] = min(low, context), max(high, context)
    return out


def _with_spans(batch: pa.RecordBatch) -> Iterator[tuple[str, list[Span]]]:
    """Texts with a base span, and these spans."""
    for part in blocks(batch):
        column = part.column("text")
        for i in np.flatnonzero(_suspects(*utf8(column))).tolist():
            text = column[i].as_py()
            if spans := base_spans(text):
                yield text, spans


def _entity_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(e, *c) for text, spans in _with_spans(batch) for e, c in contexts(text, spans).items()]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 3)], ["e", "low", "high"])


def supported_entities(documents: DataFrame) -> DataFrame:
    """``e, n_e``: the entities of at least two documents and two different contexts, stored. No other pair has support."""
    rows = in_batches(documents.select("text").where("text <> ''"), _entity_task, "e long, low long, high long")
    counts = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n_e"), F.min("low").alias("low"), F.max("high").alias("high"))
    return materialise(counts.where("n_e >= 2 and low <> high").select("e", "n_e"), "entities")


def _bitmap(rows: DataFrame, column: str) -> bytes:
    """Bitmap of the low bits of a stored column of longs, put together from pieces of 4 kB that Spark aggregates."""
    low, high = BITMAP_BITS
    bits = min(max((8 * rows.count()).bit_length(), low), high)
    place = (F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1).alias("place")
    pieces = rows.select(place).groupBy(F.bitmap_bucket_number("place").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("piece"))
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for number, piece in pieces.collect():  # at most 4096
        bitmap[(number - 1) * len(piece) : number * len(piece)] = np.frombuffer(piece, np.uint8)
    return bitmap.tobytes()


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a bitmap may hold."""
    place = keys.astype(np.int64) & (8 * len(bitmap) - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _pair_sums(rows: list[np.ndarray]) -> np.ndarray:
    """Rows e, t, n, low, high, one for each e and t."""
    e, t, n, low, high = np.concatenate(rows, axis=1)
    order = np.lexsort((t, e))
    e, t, n, low, high = e[order], t[order], n[order], low[order], high[order]
    first = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]) | (t[1:] != t[:-1])])) if len(e) else np.zeros(0, np.int64)
    if not len(first):
        return np.zeros((5, 0), np.int64)
    return np.stack([e[first], t[first], np.add.reduceat(n, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)])


def supported_pairs(documents: DataFrame, entities: DataFrame, total: int) -> DataFrame:
    """``e, t, n_te, n_e`` of the pairs with support that may lie above the threshold, over whole documents, stored."""
    shared = documents.sparkSession.sparkContext.broadcast(_bitmap(entities, "e"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        kept, fresh, size, most = np.zeros((5, 0), np.int64), [], 0, TERMS_HELD
        names = ["e", "t", "n", "low", "high"]
        for batch in batches:
            for text, spans in _with_spans(batch):
                known = {e for e in {_entity(text, s) for s in spans} if _hits(bitmap, np.array([e]))[0]}
                if not known:
                    continue
                starts, ends, hashes = _words(text)
                terms = np.unique(hashes[ends - starts >= MIN_TERM])
                one = np.ones(len(terms), np.int64)
                for e, (low, high) in [*contexts(text, spans, (starts, ends, hashes)).items(), (ANY, (0, 0))]:
                    if e == ANY or e in known:
                        fresh.append(np.stack([e * one, terms, one, low * one, high * one]))
                        size += len(terms)
                if size > most:
                    kept, fresh, size = _pair_sums([kept, *fresh]), [], 0
                    if kept.shape[1] > most:
                        yield pa.record_batch([pa.array(c) for c in kept], names)
                        kept = kept[:, :0]
        yield pa.record_batch([pa.array(c) for c in _pair_sums([kept, *fresh])], names)

    rows = in_batches(documents.select("text").where("text <> ''"), count, "e long, t long, n long, low long, high long")
    sums = rows.groupBy("e", "t").agg(F.sum("n").alias("n_te"), F.min("low").alias("low"), F.max("high").alias("high"))
    sums = materialise(sums.where(F.col("n_te") >= 2).select("e", "t", "n_te", ((F.col("e") == ANY) | (F.col("low") != F.col("high"))).alias("good")).where("good").drop("good"), "sums")
    least = sums.where(F.col("e") == ANY).select("t", F.col("n_te").alias("least"))
    pairs = sums.where(F.col("e") != ANY).join(entities, "e").join(least, "t")
    found = materialise(pairs.where(_above(F.col("least"), total)).select("e", "t", "n_te", "n_e"), "pairs")
    release(sums)
    return found


def _above(n_t: Column, total: int) -> Column:
    """PMI >= BETA * IC for ``n_te`` and ``n_e``, where the term has ``n_t`` documents."""
    information = F.log2(F.lit(float(total)) / F.col("n_e"))
    return (information + F.log2(F.least(F.col("n_te") / n_t, F.lit(1.0))) >= BETA * information) & (information > 0)


def _term_counts(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    """``t, n_t``: in how many documents the candidate terms occur (a superset of terms may come back)."""
    shared = documents.sparkSession.sparkContext.broadcast(_bitmap(candidates, "t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        terms, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in blocks(batch):
                _, _, rows, hashes = words(*utf8(part.column("text")))
                good = _hits(bitmap, hashes)
                rows, hashes = rows[good], hashes[good]
                order = np.lexsort((rows, hashes))
                rows, hashes = rows[order], hashes[order]
                fresh = np.ones(len(rows), bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
                more, n = np.unique(hashes[fresh], return_counts=True)
                terms, back = np.unique(np.concatenate([terms, more]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([counts, n]), len(terms)).astype(np.int64)
                if len(terms) > TERMS_HELD:
                    yield pa.record_batch({"t": pa.array(terms.view(np.int64)), "n": pa.array(counts)})
                    terms, counts = terms[:0], counts[:0]
        yield pa.record_batch({"t": pa.array(terms.view(np.int64)), "n": pa.array(counts)})

    return in_batches(documents.select("text").where("text <> ''"), count, "t long, n long").groupBy("t").agg(F.sum("n").alias("n_t"))


def disclosing_terms(documents: DataFrame) -> DataFrame:
    """``e, t, full``: terms above the disclosure threshold of an entity, stored; full marks PMI = IC."""
    total = documents.count()
    entities = supported_entities(documents)
    pairs = supported_pairs(documents, entities, total)
    some = documents.where(F.pmod(F.xxhash64("text"), F.lit(FORETASTE)) == 0)
    seen = pairs.join(_term_counts(some, pairs).withColumnRenamed("n_t", "least"), "t", "left")
    rare = materialise(seen.where(F.col("least").isNull() | _above(F.col("least"), total)).select("e", "t", "n_te", "n_e"), "rare")
    known = rare.join(_term_counts(documents, rare), "t")
    found = materialise(known.where(_above(F.col("n_t"), total)).select("e", "t", (F.col("n_te") >= F.col("n_t")).alias("full")), "disclosing")
    for table in (entities, pairs, rare):
        release(table)
    return found


def term_spans(text: str, spans: list[Span], table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, full) of every place of a term that discloses an entity of the text; table: e (sorted), t, full."""
    e, t, full = table
    own = np.array(sorted({_entity(text, s) for s in spans}), np.int64)
    ranges = zip(np.searchsorted(e, own).tolist(), np.searchsorted(e, own, side="right").tolist(), strict=True)
    at = np.concatenate([np.arange(i, j) for i, j in ranges])
    if not len(at):
        return []
    removed: dict[int, bool] = {}
    for term, whole in zip(t[at].tolist(), full[at].tolist(), strict=True):
        removed[term] = removed.get(term, False) or whole
    starts, ends, hashes = _words(text)
    hit = np.isin(hashes, t[at]) & (ends - starts >= MIN_TERM) & _free(starts, ends, spans)
    return [(s, 4, x, removed[h]) for s, x, h in zip(starts[hit].tolist(), ends[hit].tolist(), hashes[hit].tolist(), strict=True)]


_SPAN = "struct<start:int,kind:int,end:int>"
_TERM = "struct<start:int,kind:int,end:int,full:boolean>"
_BASE_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_TERMS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("full", pa.bool_())]))


def _table(risky: DataFrame, shard: int, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard of the disclosure table, by entity and term."""
    rows = risky.where(F.pmod(F.xxhash64("e", "t"), F.lit(shards)) == shard).toPandas().sort_values(["e", "t"])
    return rows["e"].to_numpy(np.int64), rows["t"].to_numpy(np.int64), rows["full"].to_numpy(bool)


def all_spans(documents: DataFrame, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """``documents`` with ``__base`` and ``__terms``: spans of every row; terms are (start, kind, end, full).

    ``finish`` takes the batches of the last step to the columns of ``documents``, in the same Python worker.
    """
    rows = documents.withColumn("__base", F.lit(None).cast(f"array<{_SPAN}>")).withColumn("__terms", F.lit(None).cast(f"array<{_TERM}>"))
    risky = disclosing_terms(documents)
    shards = max(-(-risky.count() // SHARD_PAIRS), 1)
    for k in range(shards):
        last = finish if k == shards - 1 else None
        shared = documents.sparkSession.sparkContext.broadcast(_table(risky, k, shards))

        def find(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                names, base, terms = batch.schema.names, [], []
                for part in blocks(batch):
                    column, old = part.column("text"), part.column(names.index("__terms"))
                    suspect = _suspects(*utf8(column))
                    for i in range(part.num_rows):
                        text = column[i].as_py() if suspect[i] else ""
                        spans = base_spans(text) if text else []
                        before = [tuple(x.values()) for x in old[i].as_py() or []]
                        found = sorted({*before, *term_spans(text, spans, shared.value)}) if spans else []
                        base.append([dict(zip(("start", "kind", "end"), x, strict=True)) for x in spans])
                        terms.append([dict(zip(("start", "kind", "end", "full"), x, strict=True)) for x in found])
                out = batch.set_column(names.index("__base"), "__base", pa.array(base, _BASE_TYPE))
                out = out.set_column(names.index("__terms"), "__terms", pa.array(terms, _TERMS_TYPE))
                yield last(out) if last else out

        fields = documents.schema.fields if last else [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
        rows = in_batches(rows, find, T.StructType(fields))
    release(risky)
    return rows


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def op5_query(documents: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans, of every document."""
    rows = all_spans(documents.select("doc_id", "text")).drop("text")
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("long")
    plain = F.transform("__terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("__base", F.array_distinct(plain)))).alias("spans"),
        F.size(F.array_distinct(plain)).cast("long").alias("n_term"),
    )


def cleaned(text: str, base: list[Span], terms: list[tuple[int, int, int, bool]]) -> str:
    """The text with entities replaced by their kind, disclosing terms generalised or removed."""
    out, done = [], 0
    for start, kind, end, full in sorted([(*s, False) for s in base] + terms, key=lambda s: (*s[:3], not s[3])):
        if start < done:
            done = max(done, end)
            continue
        word = text[start:end]
        general = "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[TERM]"
        out += [text[done:start], "" if full else PLACEHOLDER.get(KINDS[kind], general)]
        done = end
    return "".join([*out, text[done:]])


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with personal data taken out of ``text``; ``n_chars``, where present, follows. Other columns stay."""
    names = documents.columns

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        base, terms = batch.column(batch.schema.names.index("__base")), batch.column(batch.schema.names.index("__terms"))
        values = batch.column(at).to_pylist()
        changed = pa.compute.greater(pa.compute.list_value_length(base), 0)
        for i in np.flatnonzero(changed.to_numpy(zero_copy_only=False)).tolist():
            own = [(s["start"], s["kind"], s["end"]) for s in base[i].as_py()]
            more = [(s["start"], s["kind"], s["end"], s["full"]) for s in terms[i].as_py()]
            values[i] = cleaned(values[i], own, more)
        out = batch.set_column(at, "text", pa.array(values, batch.column(at).type))
        if "n_chars" in names:
            j = out.schema.get_field_index("n_chars")
            lengths = pa.array([None if v is None else len(v) for v in values], pa.int64()).cast(out.column(j).type)
            out = out.set_column(j, "n_chars", pa.compute.if_else(changed, lengths, out.column(j)))
        return out.select(names)

    return all_spans(documents, clean)
