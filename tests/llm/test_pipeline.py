"""The pipeline against its stages done by hand on a small corpus."""

import hashlib

import corpus_pipeline
from gridweave.llm import bpe, pii, quality
from tests.llm.test_decontamination import leaked
from tests.llm.test_simhash import shingle_sets
from tests.llm.test_spans import brute_terms, pii_base

SF_DIR = "/root/testdata/sf0.001"


def first_of_near_copies(rows):
    sets, root = shingle_sets(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [r for i, r in enumerate(rows) if least[find(i)] == r[0]]


def test_stages_by_hand(spark, documents, labels):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash", "decontamination", "pii", "bpe"]
    model = quality.ByteConvNet.from_bytes(quality.train(documents, labels))
    tables = model.pairs()
    rows = [(r.doc_id, r.text) for r in documents.collect() if quality.score_text((r.text or "").encode(), model, tables) >= quality.THRESHOLD]
    rows = first_of_near_copies(rows)
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    quoted = [(d, t) for d, t in rows if any(item.strip()[:40] and leaked(item, t or "") for item in items if any(p in (t or "") for p in (item[:25], item[len(item) // 2 : len(item) // 2 + 25])))]
    rows = [r for r in rows if r not in quoted]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    # Whatever else the stage drops must leak too, by the plain definition.
    assert set(out) <= {d for d, _ in rows}
    assert all(any(leaked(item, t or "") for item in items) for d, t in rows if d not in out)
    rows = [r for r in rows if r[0] in out]
    tokenizer = bpe.load(bpe.vocabulary())
    terms, private = brute_terms([t for _, t in rows]), 0
    for (d, text), own in zip(rows, terms, strict=True):
        base = pii_base(text or "")
        private += bool(base)
        ids = tokenizer.encode(pii.cleaned(text, base, own) if base else text or "", add_special_tokens=False).ids
        assert out[d].ids == " ".join(map(str, ids)) and out[d].n_tokens == len(ids)
        assert hashlib.sha256(out[d].decoded.encode()).digest() == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).digest()
    assert private and len(rows) > 50


def test_awkward_rows_pass_every_stage(spark, awkward, documents):
    docs = documents.unionByName(awkward, allowMissingColumns=True)
    columns = docs.columns
    assert "component" in columns and "fp" in columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0
