import random

import pytest

from gridweave.llm import decontamination as D


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def least(a, window):
    row = [0] * (len(window) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(window, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_alignment():
    rng = random.Random(2)
    for _ in range(400):
        a = "".join(rng.choices("abc", k=rng.randrange(2, 25)))
        w = "".join(rng.choices("abc", k=rng.randrange(1, 45)))
        k = rng.randrange(0, 6)
        best, hit = least(a, w), D.align(a, w, k)
        assert (hit is None) == (best > k)
        if hit:
            assert hit[2] == best == edits(a, w[hit[0] : hit[1]])


def noisy(rng, text, k):
    out = list(text)
    for _ in range(k):
        p, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[p] = "¤"
        elif kind == 1:
            del out[p]
        else:
            out.insert(p, "§")
    return "".join(out)


def test_every_occurrence_within_the_budget_is_found(spark):
    benchmark = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    rng = random.Random(9)
    index = D.QGramIndex([t for _, t in benchmark])
    blocks, planted = [], []
    for _ in range(150):
        n = rng.randrange(len(benchmark))
        item = benchmark[n][1].strip()
        k = rng.randrange(D.budget(len(item)) + 1)
        base = rng.choice(texts)[:3000]
        at = rng.randrange(len(base) + 1)
        blocks.append(base[:at] + " " + noisy(rng, item, k).upper() + " " + base[at:])
        planted.append(n)
    found = index.regions(blocks)
    assert all(n in found.get(i, {}) for i, n in enumerate(planted))
    exact = {i for i, t in enumerate(texts) if any(D.folded(b.strip()) in D.folded(t) for _, b in benchmark)}
    assert exact <= set(index.regions(texts))


def test_query_and_filter(spark, documents, awkward):
    benchmark = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank today."), (2, None), (3, ""), (4, "lazy"), (1, "The quick brown fox jumps over the lazy dog near the river bank today.")], "item_id long, text string")
    out = D.op8_query(awkward, benchmark)
    assert out.columns == ["doc_id", "item_id", "start", "end", "edits"]
    rows = sorted(tuple(r) for r in out.collect())
    assert {r[0] for r in rows} == {1, 7} and (1, 1, 0, 70, 0) in rows and (7, 4, 35, 39, 0) in rows
    kept = D.keep_clean(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 3
    assert D.op8_query(awkward.limit(0), benchmark).count() == 0
    assert D.op8_query(awkward, benchmark.limit(0)).count() == 0 and D.keep_clean(awkward, benchmark.limit(0)).count() == awkward.count()


def test_large_benchmarks_are_sharded(spark, documents, monkeypatch):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = sorted(tuple(r) for r in D.op8_query(documents, benchmark).collect())
    monkeypatch.setattr(D, "SHARD_CHARS", 2000)
    assert len(list(D._shards(benchmark))) > 3
    assert sorted(tuple(r) for r in D.op8_query(documents, benchmark).collect()) == want and want


def leaked(item, text):
    """The rule by plain dynamic programming: the whole item, or a passage, within its budget."""
    plain, line = D.folded(item).strip(), D.folded(text)
    return any(least(p, line) <= D.budget(len(p)) for p in [plain, *D.passages(plain)] if p)


def test_against_brute_force():
    """Items of all lengths around the places where the search changes, with leaks at random places and clean texts."""
    rng = random.Random(12)
    items, texts = [], []
    for size in (1, 5, 7, 8, 12, 13, 14, 15, 16, 25, 37, 59, 60, 61, 90, 150, 239, 240, 241, 400):
        item = "".join(rng.choices("abcdefghijklmnop", k=size))
        items.append(item)
        for k in {0, 1, D.budget(size), D.budget(size) + 1}:
            part = item if rng.random() < 0.5 else item[(at := rng.randrange(size)) : at + rng.randrange(1, 90)]
            other = "".join(rng.choices("qrstuvwxyz ", k=60))
            at = rng.randrange(60)
            texts.append(other[:at] + noisy(rng, part, min(k, len(part) - 1)) + other[at:])
    found = D.QGramIndex(items).regions(texts)
    for i, text in enumerate(texts):
        assert sorted(found.get(i, {})) == [n for n, item in enumerate(items) if leaked(item, text)], text


def test_long_items_need_no_whole_search():
    rng = random.Random(4)
    for size in (D.WHOLE + 1, D.WHOLE + 59, 2 * D.WHOLE):
        item = "".join(rng.choices("abcdefghijklmnop ", k=size - 2))
        item = "x" + item + "y"
        assert (D.PASSAGE_EDITS + 1) * (size // D.PASSAGE) > D.budget(size)
        worst = list(item)
        for n in range(D.budget(size)):
            worst[(n * size) // D.budget(size)] = "#"
        assert 0 in D.QGramIndex([item]).regions(["zz " + "".join(worst) + " zz"])[0]


@pytest.mark.parametrize("size", [81, 120, 239, 240, 241, 400])
def test_parts_of_short_and_long_items_are_found(size):
    rng = random.Random(size)
    item = "".join(rng.choices("abcdefghijklmnop ", k=size - 2)).replace("  ", " a")
    item = "x" + item + "y"
    other = "".join(rng.choices("qrstuvwz ", k=300))
    index = D.QGramIndex([item])
    length = D.PASSAGE + D.PASSAGE_STEP - 1
    texts = [other[:150] + item[s : s + length] + other[150:] for s in range(0, size - length + 1)]
    texts += [other[:150] + item[: size * 9 // 10] + other[150:], other[:150] + item[: size * 85 // 100 + 1] + other[150:]]
    found = index.regions([*texts, other])
    assert set(found) == set(range(len(texts)))
    for i in range(size - length + 1):
        (start, end, _), = found[i][0]
        assert end - start >= D.PASSAGE - D.PASSAGE_EDITS and 140 <= start and end <= 150 + length + 10
