import random

import xxhash

from gridweave.llm import simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def test_against_brute_force(spark, documents, awkward):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()] + [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.op3_query(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert simhash.op3_query(df.limit(0)).count() == 0


def test_links_of_dense_fingerprints(spark):
    rng = random.Random(3)
    values = set()
    for _ in range(30):
        centre = rng.getrandbits(64)
        for _ in range(30):
            v = centre
            for _ in range(rng.randrange(5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    edges = [(r.a, r.b) for r in simhash.fingerprint_links(spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")).collect()]

    def parts(pairs):
        root = {v: v for v in values}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a % 2**64), find(b % 2**64)))
            root[b] = a
        return {v: find(v) for v in values}

    assert parts(edges) == parts([(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2])


def test_keep_first(spark, awkward):
    kept = simhash.keep_first(awkward)
    assert kept.columns == awkward.columns
    rows = kept.select("doc_id", "text").collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "2", "4", "5", "6", "None"]
    assert simhash.keep_first(awkward.limit(0)).count() == 0


def shingle_sets(rows):
    out = []
    for _, t in rows:
        words = (t or "").lower().encode().split()
        out.append({b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    return out


def test_keep_first_removes_near_copies(spark):
    rng = random.Random(8)
    rows, copies = [], set()
    for i in range(40):
        words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
        rows.append((i, " ".join(words)))
        for k, n in enumerate((1, 2, 3, 12)):
            changed = list(words)
            for at in range(10, 10 + 15 * n, 15):
                changed[at] = "changed"
            rows.append((100 + 4 * i + k, " ".join(changed)))
    sets = shingle_sets(rows)
    for i in range(len(rows)):
        if any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(i)):
            copies.add(rows[i][0])
    assert len(copies) == 120
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(d for d, _ in rows if d not in copies)


def test_hot_shards_and_groups_give_the_same(spark, documents, awkward, monkeypatch):
    """Blocks so small that nearly every shard and group is cut: the result must not change."""
    from gridweave.llm import hot

    rng = random.Random(11)
    base = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)) for _ in range(6)]
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(60).collect()]
    for i in range(90):
        words = base[i % 6].split()
        for at in rng.sample(range(80), i % 4):
            words[at] = "changed"
        rows.append((5000 + i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints, kept = sorted(map(tuple, simhash.op3_query(df).collect())), sorted(map(tuple, simhash.keep_first(df).collect()))
    assert prints == sorted(brute(rows)) and len(kept) < 140
    monkeypatch.setattr(simhash, "SHARD_PRINTS", 2)
    monkeypatch.setattr(simhash, "COUNTED", 1)
    monkeypatch.setattr(simhash, "GROUP_SETS", 3)
    monkeypatch.setattr(hot, "SLOTS", 7)
    assert sorted(map(tuple, simhash.op3_query(df).collect())) == prints
    assert sorted(map(tuple, simhash.keep_first(df).collect())) == kept


def test_small_and_large_buckets_link_alike():
    import numpy as np

    rng = np.random.default_rng(5)
    low, high = (rng.integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64) for _ in range(2))
    for i in range(0, 300, 5):
        low[i + 1] = low[i] ^ np.uint64(rng.integers(1, 1 << 20))
        high[i + 1] = high[i]

    def parts(pairs):
        root = list(range(300))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = sorted((find(a), find(b)))
            root[b] = a
        return [find(i) for i in range(300)]

    small = parts(simhash.near_forest(low, high))
    simhash.GROUP_BITS, before = 2, simhash.GROUP_BITS
    try:
        large = parts(simhash.near_forest(low, high))
    finally:
        simhash.GROUP_BITS = before
    assert small == large and len(set(small)) <= 240


def test_unlike_small_sets_do_not_meet():
    import numpy as np

    rng = np.random.default_rng(1)
    prints = [simhash.wide_fingerprint(np.unique(rng.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64))) for n in (2, 4, 6) for _ in range(300)]
    assert simhash.near_forest(*np.ascontiguousarray(np.array(prints).T)) == []


def test_tree_of_wide_fingerprints_finds_all_within_the_radius(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    words = [rng.integers(0, 1 << 63, 400, dtype=np.int64).view(np.uint64) for _ in range(2)]
    for i in range(0, 400, 4):
        words[0][i + 1], words[1][i + 1] = words[0][i] ^ np.uint64((1 << rng.integers(1, 60)) - 1), words[1][i]
        words[0][i + 2], words[1][i + 2] = words[0][i], words[1][i]
    x, y = simhash.WideTree(*words).within(np.arange(400), simhash.KEEP_RADIUS)
    apart = sum(np.bitwise_count(w[:, None] ^ w).astype(int) for w in words)
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == set(zip(*(v.tolist() for v in np.nonzero(apart <= simhash.KEEP_RADIUS)), strict=True))
    together = len(simhash.near_forest(*words))
    monkeypatch.setattr(simhash, "BULK", 1)
    assert len(simhash.near_forest(*words)) == together >= 100
