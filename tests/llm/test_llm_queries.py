"""Queries against their SQL, and against brute force where there is none."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from helpers import SF, same

from tidewright.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"op9_jaccard"}))
def test_query_fits_its_sql(spark, duck, name):
    same(QUERIES[name](spark, SF), duck, ORACLES[name])


def shingles(text):
    w = [x.decode() for x in re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split()]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts):
    """doc_id -> (set size, smallest id reachable), by brute force over pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in texts.items()}
    holders, parent = defaultdict(list), {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for e, both in Counter(e for x in s for e in holders[x] if e > d).items():
            if 100 * both >= 75 * (len(s) + len(sets[e]) - both):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def documents(duck):
    return dict(duck.execute("select doc_id, text from documents").fetchall())


def test_op9_against_brute_force(spark, duck):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_jaccard"](spark, SF).collect()}
    assert got == components(documents(duck))


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base(text):
    spans = sorted((m.start(), i, m.end(), k) for i, k in enumerate(BASE) for m in re.finditer(BASE[k], text or "", re.A) if holds(k, m[0]))
    return [f"{k}:{a}:{b}" for a, _, b, k in spans]


def test_op1_against_brute_force(spark, duck):
    texts = documents(duck)
    for r in QUERIES["op1_pii"](spark, SF).collect():
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in BASE]
        assert set(want) <= set(r.spans.split(",")) or not want


def test_op3_on_held_out_labels(spark, duck):
    import zlib

    rows = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    import duckdb

    labels = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet'").fetchall()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in rows.items())
    held = [(rows[d].predicted, y) for d, y in labels if d in rows and rows[d].held_out and y is not None]
    found, right = sum(y for p, y in held if p), sum(p == y for p, y in held)
    assert found >= 0.8 * sum(y for _, y in held) and right >= 0.97 * len(held)


def test_op7_against_the_library(spark, duck):
    import public_tokenizers
    import tiktoken

    from tidewright.llm.bpe import load_ranks

    ranks = load_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = documents(duck)
    for r in QUERIES["op7_bpe"](spark, SF).collect():
        ids = enc.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_pipeline_by_stages(spark, duck):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in QUERIES["op3_toxicity"](spark, SF).where("predicted = 1").collect()}
    one = c.STAGES[0][1](spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.select("doc_id").collect()} == set(documents(duck)) - toxic
    two = c.STAGES[1][1](spark, docs, SF)
    assert {r.doc_id for r in two.select("doc_id").collect()} == {x[1] for x in components(documents(duck)).values()}
    three = c.STAGES[2][1](spark, docs, SF).collect()
    assert not any(base(r.text) for r in three) and all(r.n_chars == len(r.text) for r in three)
    untouched = {r.doc_id: r.text for r in three}
    assert all(untouched[d] == t for d, t in documents(duck).items() if not re.search(r"[0-9@]", t or ""))
    four = c.STAGES[3][1](spark, docs, SF)
    assert four.columns == docs.columns
    assert c.STAGES[4][1](spark, docs, SF).count() == docs.count()


def test_stages_on_odd_tables(spark):
    import corpus_pipeline as c

    ddl = "doc_id long, text string, lang string, source string, n_chars long, copy string, mix_key int, _id int, g string"
    rows = [(1, None, "en", None, 0, "c", 1, 2, "g"), (2, "", "en", "s", 0, "c", 1, 2, "g"), (3, "x@y.org " * 30, "en", "s", 0, "c", 1, 2, "g"), (3, "x@y.org " * 30, "en", "s", 0, "c", 1, 2, "g"), (None, "a b c", "en", "s", 0, None, None, None, None)]
    d = spark.createDataFrame(rows, ddl)
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == d.columns, name
        got = out.collect()
        assert name == "mixing" or {r.doc_id for r in got} == {1, 2, 3, None}
        assert all(r.copy == "c" for r in got if r.doc_id is not None)
        assert stage(spark, d.limit(0), SF).count() == 0
    assert [r.n_chars for r in c.STAGES[2][1](spark, d, SF).where("doc_id = 1").collect()] == [None]
    last = c.STAGES[-1][1]
    assert sorted((r.n_tokens for r in last(spark, d, SF).collect()))[:2] == [0, 0] and last(spark, d.limit(0), SF).count() == 0
