"""Secrets and personal data against plain regular expressions; the statistics against counting by hand."""

import hashlib
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridweave.llm import pii, secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secret_base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def pii_base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub(r"\D", "", m[0])
        if 14 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out)


def listed(spans, kinds):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


@pytest.mark.parametrize(("op", "base", "kinds"), [(secrets.op4_query, secret_base, secrets.BASE), (pii.op5_query, pii_base, pii.KINDS)])
def test_base_spans(spark, documents, awkward, op, base, kinds):
    df = documents.unionByName(awkward.select(*documents.columns))
    want = sorted((str(r.doc_id), hashlib.sha256(listed(base(r.text or ""), kinds).encode()).hexdigest()) for r in df.collect())
    out = op(df).collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in out) == want
    assert op(df.limit(0)).count() == 0
    for r in out:
        own = [s for s in r.spans.split(",") if s.split(":")[0] in kinds[: 4 if op is pii.op5_query else 3]]
        assert hashlib.sha256(",".join(own).encode()).hexdigest() == r.base_sha256


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a1.2@+-( )Z3%4567é", max_size=60))
def test_pii_any_text(text):
    assert pii.base_spans(text) == pii_base(text)


PIECES = ["password", "PASSWD", "secret", "token", "api_key", "ApiKey", '"', "'", " ", "=", ":", "abc123XY", "AKIA", "ABCDEF123456", "é", "0123456789abcdef", "sk_live_", "ghp_", "-----BEGIN RSA PRIVATE KEY-----", "ſecret", "x"]


def test_index_finds_what_the_rules_find():
    import pyarrow as pa

    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(1, 12))) for _ in range(400)]
    index, compiled = secrets.TrigramIndex(secrets.RULES), [re.compile(r.pattern, r.flags) for r in secrets.RULES]
    got = secrets.scan_texts(pa.array(texts), secrets.RULES, index, compiled)
    for text, spans in zip(texts, got):
        every = sorted((m.start(), k, m.end()) for k, (r, c) in enumerate(zip(secrets.RULES, compiled)) for m in c.finditer(text) if r.accept(m))
        assert spans == every
        assert [s for s in spans if s[1] < 3] == secret_base(text)


@pytest.mark.parametrize(("pattern", "yes", "no"), [("abc(de|fg)h", "xxabcdeh", "abcxxdeh"), ("ab?cdef", "acdef", "abdef"), ("(foo|bar)+baz", "foobaz", "fobaz"), ("x{4}y", "xxxxy", "xxy")])
def test_trigram_queries(pattern, yes, no):
    query = secrets.trigram_query(pattern)

    def holds(q, text):
        if q is True or isinstance(q, str):
            return q is True or q in text
        return (all if q[0] == "and" else any)(holds(x, text) for x in q[1])

    assert query is not True and holds(query, yes) and not holds(query, no)
    assert secrets.trigram_query("[0-9a-f]{32,}") is True


def test_disclosing_terms(spark):
    mail = "jane.doe@corp.example.com"
    rows = [(i, f"alpha{i} beta{i} zorblatt wrote {mail} again gamma{i} delta{i}") for i in range(4)]
    rows += [(10 + i, f"common words again and wrote again number{i}") for i in range(30)]
    rows += [(50, None), (51, ""), (None, "again wrote")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.op5_query(df).collect()}
    total, holders = len(rows), 4
    assert math.log2(total / holders) > 1
    for i in range(4):
        text = rows[i][1]
        words = {text[int(s):int(e)] for k, s, e in (x.split(":") for x in out[i].spans.split(",")) if k == "term"}
        assert words == {"zorblatt"} and out[i].n_email == 1
    assert all(out[d].spans == "" for d in out if d is None or d >= 10)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[0] == "alpha0 beta0  wrote [EMAIL] again gamma0 delta0" and clean[50] is None and clean[10] == rows[4][1]
    assert pii.sanitise(df.limit(0)).count() == 0


def brute_terms(texts):
    """Term spans (start, kind, end, full) of each text, counted by hand: the definition without hashes, bitmaps or pruning."""
    docs, holders, holding = [], {}, {}
    for i, text in enumerate(texts):
        text = text or ""
        spans = pii_base(text)
        found = [(m.start(), m.end(), "".join(c.lower() if "A" <= c <= "Z" else c for c in m[0])) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", text)]
        free = [w for w in found if not any(w[0] < e and s < w[1] for s, _, e in spans)]
        entities = {}
        for s, k, e in spans:
            at = sum(w[0] < s for w in free)
            entities.setdefault((k, text[s:e].lower()), set()).add(tuple(w[2] for w in free[max(at - 8, 0) : at + 8]))
        terms = {w[2] for w in found if w[1] - w[0] >= 3}
        docs.append((text, free, entities, terms))
        for e in entities:
            holders.setdefault(e, set()).add(i)
        for t in terms:
            holding.setdefault(t, set()).add(i)
    total, out = len(texts), []
    for i, (_, free, entities, terms) in enumerate(docs):
        removed = {}
        for e in entities:
            information = math.log2(total / len(holders[e]))
            for t in terms:
                both = holders[e] & holding[t]
                if len(both) < 2 or len(set().union(*(docs[j][2][e] for j in both))) < 2 or information <= 0:
                    continue
                if information + math.log2(len(both) / len(holding[t])) >= pii.BETA * information:
                    removed[t] = removed.get(t, False) or both == holding[t]
        out.append([(s, 4, x, removed[w]) for s, x, w in free if x - s >= 3 and w in removed])
    return out


def test_terms_against_counting_by_hand(spark, documents):
    rng = random.Random(5)
    people = [(f"p{k}@corp.example.com", f"+49 30 {1000000 + k}", f"Surname{k}", f"Town{k}") for k in range(6)]
    texts = []
    for i in range(160):
        words = [f"word{min(int(rng.expovariate(0.02)), 200)}" for _ in range(rng.randrange(5, 60))]
        if i % 3 == 0:
            person = rng.choice(people)
            for thing in person[: rng.randrange(1, 5)] + ((person[2],) if rng.random() < 0.8 else ()):
                words.insert(rng.randrange(len(words)), thing)
        texts.append(" ".join(words))
    texts += [r.text for r in documents.collect()] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_terms(texts)
    assert sum(map(bool, want)) > 20
    base = [pii_base(t or "") for t in texts]
    for r in pii.op5_query(df).collect():
        every = sorted([(s, k, e) for s, k, e in base[r.doc_id]] + [(s, k, e) for s, k, e, _ in want[r.doc_id]])
        assert r.spans == listed(every, pii.KINDS)
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert all(clean[i] == (pii.cleaned(t, base[i], want[i]) if base[i] else t) for i, t in enumerate(texts))


def test_sanitise_keeps_columns(awkward):
    out = pii.sanitise(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    row = out.where("doc_id is null").first()
    assert row.text.startswith("Mail [EMAIL] now") and row.n_chars == len(row.text)


def test_terms_of_whole_documents(spark, monkeypatch):
    mail = "jane.doe@corp.example.com"
    filler = " ".join(f"common{i}" for i in range(20))
    rows = [(i, f"zorblatt {filler} alpha{i} {mail} beta{i} {filler} Zorblatt") for i in range(4)]
    rows += [(10 + i, f"{filler} number{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shard in (pii.SHARD_PAIRS, 1):
        monkeypatch.setattr(pii, "SHARD_PAIRS", shard)
        out = {r.doc_id: r for r in pii.op5_query(df).collect()}
        for i in range(4):
            text = rows[i][1]
            places = [text[int(s) : int(e)] for k, s, e in (x.split(":") for x in out[i].spans.split(",")) if k == "term"]
            assert places == ["Zorblatt", "zorblatt"] or places == ["zorblatt", "Zorblatt"]
            assert out[i].n_term == 2
        clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
        assert clean[1] == f" {filler} alpha1 [EMAIL] beta1 {filler} " and clean[10] == rows[4][1]


def test_long_logins_in_urls():
    import pyarrow as pa

    index, compiled = secrets.TrigramIndex(secrets.RULES), [re.compile(r.pattern, r.flags) for r in secrets.RULES]
    texts = [f"see https://{'u' * n}:{'P-' * n}@host/x" for n in (1, 32, 100, 50_000)]
    kind = [r.kind for r in secrets.RULES].index("url_login")
    for text, spans in zip(texts, secrets.scan_texts(pa.array(texts), secrets.RULES, index, compiled)):
        assert (4, kind, text.index("@") + 1) in spans
