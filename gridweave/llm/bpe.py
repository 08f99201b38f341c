"""BPE encoding and decoding through a table of distinct words.

A text is split at ASCII white space. The tokenizer drops white space, and neither its normaliser nor its patterns reach
across it, so the ids of a text are the ids of its words in order. Words are counted in Spark over all texts; the HEAD most
frequent ones (at most HEAD words of at most WORD_BYTES bytes: a fixed bound) are encoded once, by the tasks that hold them,
and the table of word, ids and pieces is broadcast. The ids are joined back by position: each place of a text looks its word
up. Words outside the table are encoded once per task, through a dictionary of at most TAIL words, whatever the text. So the table only decides where a word is encoded, never what comes out.

Decoding joins ids to pieces through the vocabulary's id-to-piece table.

A shuffle join of all (document, position, word) rows with a table of all words would move several times the input; the
README has figures.

Defined results: a null text is empty (no ids, empty decoded text); repeated rows get equal results; a null id is an id; an
empty table gives an empty table; extra columns are ignored; any text is accepted, very long texts and words included.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.textblock import blocks, in_batches, kept_by, texts

HEAD = 3 << 16
WORD_BYTES = 48
TAIL = 150_000
#: Words encoded at once, and distinct words counted before they are sent.
SLICE = 300
COUNTED = 200_000

OWNER = "bpe"

Entry = tuple[int, str, str]


@lru_cache(maxsize=2)
def load(path: str):  # noqa: ANN201
    """The tokenizer of a file, once per process, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordTable:
    """word -> (number of ids, ids joined by a space, decoded pieces joined by a space)."""

    def __init__(self, path: str, head: dict[bytes, Entry] | None = None) -> None:
        self.tokenizer = load(path)
        self.pieces: dict[int, str] = {i: piece for piece, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.numbers: dict[int, str] = {i: str(i) for i in self.pieces}
        self.head = head or {}
        self.known = dict(self.head)

    def encode(self, words: list[bytes]) -> list[Entry]:
        """An entry for each word. Words are encoded SLICE at a time as one text and told apart by their offsets."""
        out: list[Entry] = []
        numbers, pieces = self.numbers, self.pieces
        for start in range(0, len(words), SLICE):
            texts = [w.decode() for w in words[start : start + SLICE]]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            ids = found.ids
            ends = list(accumulate([len(t) + 1 for t in texts]))
            cuts = np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), ends).tolist()
            shown, decoded, low = [numbers[i] for i in ids], [pieces[i] for i in ids], 0
            for high in cuts:
                out.append((high - low, " ".join(shown[low:high]), " ".join(decoded[low:high])))
                low = high
        return out

    def entries(self, words: set[bytes]) -> dict[bytes, Entry]:
        """The entries of ``words``; those that neither the head nor an earlier call gave are encoded."""
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > len(self.head) + TAIL:
            self.known = dict(self.head)
            missing = words.difference(self.known)
        order = list(missing)
        known = self.known
        known.update(zip(order, self.encode(order), strict=True))
        return {w: known[w] for w in words}


def word_counts(documents: DataFrame) -> DataFrame:
    """``word, n`` of the words of at most WORD_BYTES bytes, over all documents.

    Tasks count COUNTED words before they send them; a word met once by then is not sent, which can only cost it a place in
    the head.
    """

    def sent(found: Counter) -> pa.RecordBatch:
        rows = [(w, n) for w, n in found.items() if n > 1 and len(w) <= WORD_BYTES]
        return pa.record_batch({"word": pa.array([w for w, _ in rows], pa.binary()), "n": pa.array([n for _, n in rows], pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for part in blocks(batch):
                for t in texts(part.column("text")):
                    found.update(t.split())
                if len(found) > COUNTED:
                    yield sent(found)
                    found.clear()
        yield sent(found)

    return in_batches(documents.select("text"), count, "word binary, n long", OWNER).groupBy("word").agg(F.sum("n").alias("n"))


def head_table(documents: DataFrame, path: str, size: int = HEAD) -> DataFrame:
    """``word, n, ids, pieces`` of the ``size`` most frequent words, each encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(path)
        for batch in batches:
            found = table.encode(batch.column(0).to_pylist())
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [()] * 3, (pa.int32(), pa.string(), pa.string()), strict=True))], ["word", "n", "ids", "pieces"])

    head = word_counts(documents).orderBy(F.desc("n"), "word").limit(size).select("word")
    return in_batches(head, encode, "word binary, n int, ids string, pieces string", OWNER)


def encode_documents(documents: DataFrame, path: str, size: int = HEAD) -> DataFrame:
    """``doc_id, ids, decoded``: ids joined by a space, and the text that they decode to."""
    head = head_table(documents, path, size).toArrow().combine_chunks()
    shared = documents.sparkSession.sparkContext.broadcast(_packed(head))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path, shared.value)
        for batch in batches:
            for part in blocks(batch):
                split = [t.split() for t in texts(part.column("text"))]
                known = table.entries(set().union(*split))
                found = [[e for w in own if (e := known[w])[0]] for own in split]  # a word without ids leaves no blank
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([sum(e[0] for e in own) for own in found], pa.int64()),
                        pa.array([" ".join([e[1] for e in own]) for own in found], pa.string()),
                        pa.array([" ".join([e[2] for e in own]) for own in found], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    kind = dict(documents.dtypes)["doc_id"]
    return in_batches(documents.select("doc_id", "text"), encode, f"doc_id {kind}, n_tokens long, ids string, decoded string", OWNER)


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


_TABLES: dict[tuple[str, int], WordTable] = {}


def _forget() -> None:
    _TABLES.clear()
    load.cache_clear()


kept_by(OWNER, _forget)


def _table(path: str, packed: bytes) -> WordTable:
    """The word table of a broadcast, kept between the tasks of one worker."""
    key = (path, zlib.crc32(packed))
    if key not in _TABLES:
        _TABLES.clear()
        rows = pa.ipc.open_stream(packed).read_all()
        columns = [rows.column(c).to_pylist() for c in ("word", "n", "ids", "pieces")]
        _TABLES[key] = WordTable(path, {w: (n, i, p) for w, n, i, p in zip(*columns, strict=True)})
    return _TABLES[key]


def vocabulary() -> str:
    """Where the public word-level vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_query(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    done = encode_documents(documents, path or vocabulary())
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
