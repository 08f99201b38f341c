import hashlib
import random

import pytest

from gridweave.llm import bpe

PARTS = ["It's", "don't", "İstanbul", "<|endoftext|>", "é́", "\x1c", "a\x85b", " ", "ﬃ", "漢字", "한국어", "👩‍👩‍👧", "ΑΣ", "ẞ", "½", "...", "x" * 300, "12345", "​", "กำ", "A", "the", "THE"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("head", [bpe.HEAD, 5, 1])
def test_equals_the_library(spark, documents, awkward, head):
    rng = random.Random(6)
    rows = [tuple(r) for r in documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).collect()]
    rows += [(1000 + i, "".join(rng.choice(PARTS) + rng.choice(["", " ", "\n", "\t", " "]) for _ in range(30))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    tokenizer = bpe.load(bpe.vocabulary())
    want = []
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((str(d), len(ids), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))))
    from pyspark.sql import functions as F

    got = bpe.encode_documents(df, bpe.vocabulary(), head).select("doc_id", "n_tokens", F.sha2("ids", 256), F.sha2("decoded", 256))
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(want)
    assert bpe.op7_query(df.limit(0)).count() == 0


def test_tail_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "TAIL", 3)
    table = bpe.WordTable(bpe.vocabulary(), {b"the": (1, "518", "the</w>")})
    for words in ({b"one", b"two", b"the"}, {b"three", b"four"}, {b"five", b"six", b"seven", b"eight", b"one"}):
        assert set(table.entries(words)) == words
