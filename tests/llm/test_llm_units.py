"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.llm import bpe, hashing, jaccard, mixing, pii, substring, topk, toxicity, url_reputation, vector_dedup, warc
from tidewright.llm.common import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, clash=True):
    """Rows (id, text); with columns whose names operators use themselves."""
    df = spark.createDataFrame([(i, t, "en", None if n % 3 == 0 else "s", 0) for n, (i, t) in enumerate(texts)], DOCS)
    return df.withColumns({"copy": F.lit("x"), "key": F.lit(1), "spans": F.lit(2), "node": F.lit("z"), "label": F.lit(None).cast("int")}) if clash else df


LONG = " ".join(f"w{i % 997} mail{i}@x.org" for i in range(800))
TEXTS = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE two"), (5, LONG), (6, LONG), (None, "one two"), (7, "x" * 30000), (3, "one two")]


# components


def test_components_of_chains_stars_and_loops(spark):
    e = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 130)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# op 1


def test_base_spans(spark):
    from test_llm_queries import base

    texts = ["a@b.c_d@e.f", "a@b@c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.0255", "4111 1111 1111 1111", "1  23", "4111-1111-1111-1111-0", "+49 (30) 123456-7", "+1+2345678901", "😀 a@b.co 😀 10.0.0.1", "a.b+c@d-e.f.g.", "9" * 5000, "+" + "1 " * 2000, "x@" * 1000, "a" * 2000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[1] for r in pii.find(d, pii.Model([], {})).select("doc_id", F.expr(pii.spans_text("base"))).collect()}
    assert got == {i: ",".join(base(t)) for i, t in enumerate(texts)}


def test_pii_edges_and_redaction(spark):
    d = docs(spark, [*TEXTS, (8, "call +1 555 123 4567 or a@b.co, 😀 4111 1111 1111 1111!")])
    out = pii.redact(d)
    assert out.columns == d.columns
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[0] is None and text[1] == "" and text[8] == "call [PHONE] or [EMAIL], 😀 [CARD]!"
    assert text[5] == re.sub(r"mail\d+@x.org", "[EMAIL]", LONG)
    assert pii.find(d.limit(0), pii.fit(d.limit(0))).count() == 0


def test_boosted_trees_learn_a_rule():
    cells = [(2, b, 50.0, 45.0 if b & 1 and not b & 2 else 5.0) for b in range(8)]
    m = pii.Model(trees := pii._fit(cells), pii._thresholds(cells, trees, 0.75))
    assert [m.takes(2, b) for b in range(8)] == [b & 1 == 1 and not b & 2 for b in range(8)]
    assert not m.takes(0, 1)


def wide(kind, text):
    """Candidates by Python's own engine: (start, end, text, before, after)."""
    body = pii.WIDE[kind].replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "")
    start = r"(?<![A-Za-z0-9._%+-])" if kind == "email" else ""
    at, out, found = 0, [], re.compile(start + body, re.A)
    here = re.compile(body, re.A) if kind == "email" else None
    while m := (here.match(text, at) if here else None) or found.search(text, at):
        c = m[0].rstrip(pii.TAIL.get(kind, "")) if kind in pii.TAIL else m[0]
        out.append((m.start(), m.start() + len(c), c))
        at = m.end()
    return out


def bits(kind, text, a, b, c, before):
    digits = sum(x in "0123456789" for x in c)
    pre, post = text[max(before, a - 16, 0) : a], text[b : b + 4]
    f = [
        c.startswith("+"), re.search("[ -]", c), "(" in c, re.search(r"(?s)[.].*[.].*[.]", c) and re.search(r"[.][^\n]*[.][^\n]*[.]", c), digits >= 8, digits >= 10, digits >= 14, digits == 16, digits > 16,
        re.search("[0-9]", c) and re.search("[A-Za-z]", c), not re.search("[^0-9a-f]", c), re.search(r"[.][A-Za-z]{2,}$", c), re.search(pii.WORDS, pre.lower()), re.search("[0-9A-Za-z]$", pre), re.search("^[0-9A-Za-z]", post), len(c) >= 32,
    ]
    return sum(1 << i for i, x in enumerate(f) if x) & ~pii.MASK.get(kind, 0)


def test_added_spans_against_brute_force(spark):
    from test_llm_queries import base

    from helpers import SF

    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = pii.fit(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"), precision=0.6)
    more = [(10_000, "call (017) 555-7713 now, token = \"" + "0a" * 65 + "\" and 1.2.3.4.5 or 4111.1111.1111.1111 or joe at x"), (10_001, "a" * 300 + " " + "7 " * 200)]
    d = d.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    added = 0
    for r in pii.find(d, model).select("doc_id", "text", F.expr(pii.spans_text("spans")).alias("spans")).collect():
        own = base(r.text)
        taken = {k: [(int(a), int(b)) for kk, a, b in (x.split(":") for x in own) if kk == k] for k in pii.KINDS}
        want = set(own)
        for k, kind in enumerate(pii.KINDS):
            last = 0
            for a, b, c in wide(kind, r.text):
                if model.takes(k, bits(kind, r.text, a, b, c, last)) and not any(x < b and a < y for x, y in taken[kind]):
                    want.add(f"{kind}:{a}:{b}")
                    added += 1
                last = b if kind not in pii.TAIL else b + len(r.text[b:]) - len(r.text[b:].lstrip(pii.TAIL[kind]))
        assert set(r.spans.split(",")) - {""} == want, r.doc_id
    assert added > 3
    assert pii.KINDS.index("secret") in model.thresholds and model.takes(4, bits("secret", "x", 0, 0, "0a" * 65, 0))


def test_rare_candidates_of_a_large_table_all_count(spark):
    """Eighty secrets in 120,000 texts prove the precision; a third of them would not."""
    d = spark.range(120_000).selectExpr("id as doc_id", "if(id % 1500 = 0, concat('key=', sha1(cast(id as string))), 'plain') as text")
    model = pii.fit(d)
    assert pii.KINDS.index("secret") in model.thresholds
    assert pii.find(d, model).where("size(spans) = 1").count() == 80


# op 2


def brute_top(ids, x, q_ids, k):
    s = np.floor(64 * np.asarray(x, np.float64)).astype(np.int64)
    at = {i: n for n, i in enumerate(ids)}
    return {q: [(i, int(s[at[q]] @ s[at[i]])) for i in sorted((j for j in ids if j != q), key=lambda j: (-int(s[at[q]] @ s[at[j]]), j))[:k]] for q in q_ids}


def test_top_k_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)).round(1)
    x[20:40] = x[0]
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(60)] + [(100, None, 0), (101, [float("nan")] * 8, 0), (102, [None] * 8, 0), (103, [], 0), (None, [1.0] * 8, 0), (104, [1.0] * 3, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in sorted(topk.top_k(df, df.where("vec_id % 20 = 0"), k=5).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute_top(list(range(60)), x.astype(np.float32), [0, 20, 40], 5)
    assert topk.top_k(df.limit(0), df, k=5).count() == 0


def test_top_k_of_negative_large_and_double_vectors(spark):
    down = spark.createDataFrame([(0, [1.0], 7)] + [(i, [-i / 64], 7) for i in range(1, 61)], "vec_id long, embedding array<float>, least int").withColumn("grp", F.lit("x"))
    got = [(r.rank, r.vec_id, r.score) for r in topk.top_k(down, down.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(i, i, -64 * i) for i in range(1, 21)]
    assert topk.scaled(np.array([5e6])).tolist() == [320_000_000.0]
    rng = np.random.default_rng(9)
    for scale in (5e6, 1e11, 1e200):
        x = rng.normal(size=(40, 5)) * scale
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
        whole = [[int(np.floor(64 * v)) for v in r] for r in x]
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=6).collect()
        for q in (0, 20):
            score = {i: max(-topk.LONG, min(topk.LONG, sum(a * b for a, b in zip(whole[q], whole[i], strict=True)))) for i in range(40) if i != q}
            want = sorted(score.items(), key=lambda p: (-p[1], p[0]))[:6]
            assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want


def test_blocks_that_cannot_meet_go(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(10)
    x = np.repeat(rng.normal(size=(8, 1)) * 5, 32, 0) + rng.normal(size=(256, 8)) * 0.05
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in sorted(topk.top_k(df, df.where("vec_id % 20 = 0"), k=5).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute_top(list(range(256)), x.astype(np.float32), range(0, 256, 20), 5)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_segment_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    q, x = rng.integers(-70, 70, (5, 19)).astype(float), rng.integers(-70, 70, (9, 19)).astype(float)
    for s in topk.LEVELS:
        assert (topk.statistics(q, s) @ topk.statistics(x, s).T >= q @ x.T - 1e-6).all()


def test_pruning_happens_on_clustered_vectors():
    rng = np.random.default_rng(2)
    x = np.repeat(rng.integers(-60, 60, (8, 1)), 64, 1) + rng.integers(-2, 3, (8, 64))
    s = topk.statistics(x.astype(float), 1)
    exact = x @ x.T
    assert ((s @ s.T) - exact).max() < 0.05 * np.abs(exact).max() + 64 * 8


# op 3


def brute_segments(a, lo, hi):
    best = None
    for i in range(lo, hi):
        t = 0.0
        for j in range(i, hi):
            t += a[j]
            if t > 1e-9 and (best is None or t > best[0] + 1e-9):
                best = (t, i, j)
    return [] if best is None else brute_segments(a, lo, best[1]) + [best[1:]] + brute_segments(a, best[2] + 1, hi)


def test_maximal_segments():
    random.seed(5)
    for _ in range(500):
        a = [-toxicity.DRIFT] * random.randint(0, 25)
        hits = [(i, random.choice([0.3, 0.55, 1.1]) + random.random() / 1000) for i in range(len(a)) if random.random() < 0.3]
        for i, s in hits:
            a[i] = s
        assert [x[:2] for x in toxicity.maximal_segments(hits)] == brute_segments(a, 0, len(a))


def test_toxicity_edges(spark):
    d = docs(spark, TEXTS)
    labels = spark.createDataFrame([(3, 1), (5, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    m = toxicity.fit(d, labels)
    assert toxicity.score(d, m).count() == d.count() and toxicity.score(d.limit(0), m).count() == 0
    assert toxicity.fit(d, labels.limit(0)).word == {}
    kept = toxicity.keep_clean(d, m)
    assert kept.columns == d.columns


def test_scores_against_brute_force(spark):
    import math

    from helpers import SF

    d = spark.read.parquet(f"{SF}/documents.parquet")
    more = SF.replace("0.001", "0.1")
    m = toxicity.fit(spark.read.parquet(f"{more}/documents.parquet"), spark.read.parquet(f"{more}/labels.parquet"))
    assert m.word and m.stem
    seen = 0
    for r in d.join(toxicity.score(d, m), "doc_id").collect():
        tokens = toxicity.words((r.text or "").lower())
        if len(tokens) > 90:
            continue
        a = [m.word[t] if t in m.word else m.stem.get(t[: toxicity.STEM], -toxicity.DRIFT) if t not in m.known else -toxicity.DRIFT for t in tokens]
        limit = math.log(m.k * max(1, len(a)))
        good = [(i, j, m.lam * sum(a[i : j + 1]) - limit) for i, j in brute_segments(a, 0, len(a))]
        good = [g for g in good if g[2] > 1e-9]
        assert [(p.first, p.last) for p in r.passages if p.evidence > 1e-9] == [g[:2] for g in good]
        assert abs(r.score - 1 / (1 + math.exp(-max(-50, min(50, m.base + m.slope * sum(g[2] for g in good)))))) < 1e-9
        seen += 1
    assert seen > 20
    assert toxicity.Model({}, {"clas": 3.0}, known=frozenset({"class"})).segments("class")[1] == []
    both = toxicity.maximal_segments([(0, 2.0), (1, -5.0), (2, 1.0)])
    assert [x[:2] for x in both] == [(0, 0), (2, 2)]


# op 4


def test_mixing_reaches_its_weights(spark):
    d = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "small").alias("source"), F.lit("t").alias("copy"))
    w = spark.createDataFrame([("big", 1.0), ("small", 2.0), (None, 1.0), ("absent", 9.0)], "source string, weight double")
    out = mixing.mix_sources(d, w, total=40_000)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["big"] - 10_000) < 500 and abs(n["small"] - 20_000) < 700 and abs(n[None] - 10_000) < 500
    again = mixing.mix_sources(d.repartition(7), w, total=40_000)
    assert out.agg(F.sum(F.xxhash64("doc_id", "copy").cast("decimal(38,0)"))).first() == again.agg(F.sum(F.xxhash64("doc_id", "copy").cast("decimal(38,0)"))).first()
    assert mixing.mix_sources(d.limit(0)).count() == 0
    lost = spark.createDataFrame([(None, "s", 1, 2), (None, "s", 1, 2)], "doc_id long, source string, copy int, mix_key int")
    twice = mixing.mix_sources(lost, total=60)
    assert twice.columns == [*lost.columns, "copy_", "mix_key_"] and 2 * twice.where("copy_ = 1").count() in (0, 4)
    assert twice.groupBy("mix_key_").count().select("count").distinct().collect() in ([], [(2,)])
    assert mixing.mix_sources(d, w.withColumn("weight", F.lit(-1.0))).count() == 0


def test_mixing_large_means_and_many_sources(spark, monkeypatch):
    d = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    big = mixing.mix_sources(d, total=50 * 200).groupBy("doc_id").count()
    mean, dev = big.agg(F.avg("count"), F.stddev("count")).first()
    assert abs(mean - 200) < 8 and 8 < dev < 22
    plain = mixing.mix_sources(d, total=100).count()
    limit = mixing.small
    monkeypatch.setattr(mixing, "small", lambda df, rows, most=0: limit(df, 10**9, 0))
    assert mixing.mix_sources(d, total=100).count() == plain


# op 5


def test_near_duplicates_with_bad_rows(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 6))
    v[10:20] = v[0] + rng.normal(size=(10, 6)) * 0.05
    v[20] = v[1] * 3
    v[21:24] = v[2]
    label = [None if i == 39 else i % 2 if i < 10 else 0 for i in range(40)]
    rows = [(i, [float(x) for x in v[i]], label[i]) for i in range(40)] + [(50, None, 0), (51, [0.0] * 6, 0), (52, [float("inf")] + [0.0] * 5, 0), (53, [None] * 6, 0), (54, [], 0), (None, [1.0] * 6, 0), (55, [1.0, 2.0], 0), (56, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(0))
    u = {i: np.asarray(e, np.float32).astype(float) / np.linalg.norm(np.asarray(e, np.float32).astype(float)) for i, e, _ in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)}
    lab = {r[0]: r[2] for r in rows}
    near = {i: {j for j in u if j != i and len(u[i]) == len(u[j]) and lab[i] is not None and lab[i] == lab[j] and u[i] @ u[j] >= 0.98} for i in u}

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        return min(seen)

    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(df).collect()}
    assert got.pop(None) == (0, None, False)
    assert got == {i: (len(near.get(i, ())), reach(i), reach(i) == i) for i in lab if i is not None}
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


def test_multi_sequence_visits_by_distance():
    rng = np.random.default_rng(4)
    p, q = rng.random(7), rng.random(9)
    got = list(vector_dedup.multi_sequence(p, q, 0.9))
    sums = [p[i] + q[j] for i, j in got]
    assert sums == sorted(sums) and len(got) == len(set(got)) == (p[:, None] + q[None, :] <= 0.9).sum()


# op 6


def test_url_rules_and_parts(spark):
    urls = ["http://A.Example.COM/en/7x?q", "https://example.com/en/8", "ftp://net/de/", "x://b.example.net/de/8#f", "http://org/es/1", "http://xorg/es/1", "http://e.org?x=://y/", None, "nothing", "://", "http://é.COM/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    out = {r.page_id: r for r in url_reputation.filter_urls(pages, spark.createDataFrame([], "page_id long, bad int")).collect()}
    want = [("a.example.com", "/en/7x", "example.com/en/7", "allow"), ("example.com", "/en/8", "com/en/", "block"), ("net", "/de/", "net/de/", "allow"), ("b.example.net", "/de/8", "example.net/de/8", "block"), ("org", "/es/1", "org/es/", "block"), ("xorg", "/es/1", None, "allow"), ("e.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("é.com", "/en/", "com/en/", "block")]
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(len(urls))] == want


def test_urls_of_empty_and_repeated_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/es/"), (1, "http://a.org/es/"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert sorted(r.verdict for r in url_reputation.filter_urls(pages, none).collect()) == ["allow", "block", "block"]
    assert url_reputation.filter_urls(pages.limit(0), none).count() == 0


def test_reputation_blocks_bad_hosts_and_shrinks(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 10}.dom{i % 2}.test/x") for i in range(2000)], "page_id long, url string")
    bad = spark.createDataFrame([(i, int(i % 10 == 3 or i % 97 == 0)) for i in range(1000)] + [(None, 1), (5, None)], "page_id long, bad int")
    out = {r.host: r for r in url_reputation.filter_urls(pages, bad, rules=()).collect()}
    assert {h for h, r in out.items() if r.verdict == "block"} == {"h3.dom1.test"}
    assert all(r.low <= r.rate for r in out.values())


# op 7


def test_codec_trees_fit_the_library():
    import public_tokenizers
    import tiktoken

    ranks = bpe.load_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codecs = [bpe.Codec(ranks, public_tokenizers.PATTERN, text_leaf=t, piece_leaf=p) for t, p in ((1, 1), (3, 2), (64, 32))]
    random.seed(6)
    bits = ["a", "b", "th", "e", "'", "'re", " ", "  ", "\n", "é", "ß", "中", "12", "!", "…", "\x1c", "\x85", "\u2003", "😀", "the"]
    for _ in range(400):
        s = "".join(random.choice(bits) for _ in range(random.randint(0, 50)))
        want = enc.encode_ordinary(s)
        for c in codecs:
            assert c.encode(s) == want and c.decode(want) == s.encode()
    for s in ("a" * 5000, " " * 999 + "x", "ab" * 3000, "é" * 2000):
        assert codecs[1].encode(s) == enc.encode_ordinary(s)


def test_encode_and_decode_tables(spark):
    import public_tokenizers as P

    assert bpe.round_trip(docs(spark, TEXTS).limit(0), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0

    d = docs(spark, TEXTS)
    ids = bpe.encode(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    back = bpe.decode(ids, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert sorted((bytes(r.decoded) for r in back.collect()), key=repr) == sorted(((t or "").encode() for _, t in TEXTS), key=repr)


# ops 8 and 9


def brute_substrings(texts, window):
    first = {}
    lists = {d: (t or "").encode().split() for d, t in texts}
    for d, w in lists.items():
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = {}
    for d, w in lists.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def small_corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "b", "c", "D", "é"]
    made = []
    for i in range(n):
        if made and rng.random() < 0.5:
            w = rng.choice(made).split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(words)
        else:
            w = [rng.choice(words) + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 60))]
        made.append(" ".join(w))
    return [*enumerate(made), (900, None), (901, ""), (None, made[5])]


@pytest.mark.parametrize("window", [4, 13])
def test_substrings_against_brute_force(spark, window):
    texts = small_corpus(window)
    out = substring.dedup_substrings(docs(spark, texts), window, longest=4 * window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out} == brute_substrings(texts, window)
    longest = {d: max([0, *(n for n in (window, 2 * window, 4 * window) if brute_substrings(texts, n)[d][1])]) for d, _ in texts}
    assert {r.doc_id: r.longest for r in out} == longest and (window != 4 or set(longest.values()) == {0, 4, 8, 16})


def test_substrings_without_frequent_windows(spark, monkeypatch):
    monkeypatch.setattr(substring, "FREQUENT", 10**6)
    monkeypatch.setattr(substring, "RUN", 3)
    texts = small_corpus(21)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup_substrings(docs(spark, texts), 5).collect()}
    assert got == brute_substrings(texts, 5)
    assert substring.dedup_substrings(docs(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("run", [3, 50_000])
def test_levels_go_on_until_none_survives(spark, monkeypatch, run):
    monkeypatch.setattr(substring, "RUN", run)
    monkeypatch.setattr(substring, "MANY", 3)
    texts = small_corpus(4)
    long = " ".join(f"l{i}" for i in range(150))
    texts += [(1000 + i, f"x{i} {long}" + f" y{i}" * i) for i in range(20)]
    out = substring.dedup_substrings(docs(spark, texts), 4).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out} == brute_substrings(texts, 4)
    longest = {d: max([0, *(n for n in (4, 8, 16, 32, 64, 128) if brute_substrings(texts, n)[d][1])]) for d, _ in texts}
    assert {r.doc_id: r.longest for r in out} == longest and {0, 4, 8, 16, 128} <= set(longest.values())


def test_op8_goes_through_all_levels(spark, monkeypatch, tmp_path):
    from tidewright.llm.queries import QUERIES

    seen, double = [], substring._double
    monkeypatch.setattr(substring, "_double", lambda length, *more: seen.append(length) or double(length, *more))
    long = " ".join(f"l{i}" for i in range(120))
    docs(spark, [(1, long), (2, "a " + long + " b"), (3, "c d")], clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: (r.n_words, r.n_removed, r.longest) for r in QUERIES["op8_substring_dedup"](spark, str(tmp_path)).collect()}
    assert rows == {1: (120, 0, 0), 2: (122, 120, 13), 3: (2, 0, 0)}
    assert sorted(set(seen)) == [13, 26, 52, 104]


def test_levels_carry_stretches_not_windows(spark, monkeypatch):
    """What levels beyond the first two store does not grow with the length of a stretch."""
    tables, stored = [], substring.stored

    def sized(df, *more):
        out = stored(df, *more)
        tables.append((more[0], sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(out._tidewright_path) for f in files if f.endswith(".parquet"))))
        return out

    monkeypatch.setattr(substring, "stored", sized)
    words = [f"w{i}" for i in range(20_000)]
    texts = [(1, " ".join(words)), (2, " ".join(words)), (3, " ".join([*words[:10_000], "other", *words[10_000:]])), (4, "w0 w1")]
    out = {r.doc_id: (r.n_words, r.n_removed, r.longest) for r in substring.dedup_substrings(docs(spark, texts)).collect()}
    assert out == {1: (20_000, 0, 0), 2: (20_000, 20_000, 13 << 10), 3: (20_001, 20_000, 13 << 9), 4: (2, 0, 0)}
    first = [name for name, _ in tables].index("level")
    further = [n for name, n in tables[first + 1 :] if name in ("level", "pieces")]
    assert len(further) > 10 and sum(further) < 100_000


def test_near_copies_at_all_levels(spark, monkeypatch):
    import pyarrow as pa

    met, smallest = [], substring._smallest
    text = [f"w{i}" for i in range(60)]
    rng = random.Random(8)
    texts = [(i, " ".join("x" + str(i) if j == p else w for j, w in enumerate(text))) for i in range(300) for p in [rng.randrange(60)]]
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept, r.longest) for r in substring.dedup_substrings(docs(spark, texts), 4).collect()}
    brute = {n: brute_substrings(texts, n) for n in (4, 8, 16, 32)}
    assert out == {d: (*brute[4][d], max([0, *(n for n in brute if brute[n][d][1])])) for d, _ in texts}
    names = ["key", "a", "b", "delta", "lo", "hi", "doc_id", "shift", "most"]
    rows = [(5, 1, 1, 4, 0, 9, 1, 0, 7), (5, 1, 1, 4, 3, 12, 2, 5, 2), (5, 1, 2, 4, 3, 4, 3, 0, 3), (6, 1, 1, 4, 128, 130, 9, 0, 9)]
    for b in smallest(128)([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)]):
        met += [tuple(r.values()) for r in b.to_pylist()]
    assert met == [(1, 1, 4, 0, 9, 0, 9, 1, 0), (1, 1, 4, 3, 12, 3, 9, 1, 3)]


def test_jaccard_against_brute_force(spark, monkeypatch):
    from test_llm_queries import components

    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    monkeypatch.setattr(jaccard, "LEAF", 4)
    texts = small_corpus(31, 40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts)).collect()}
    want = components({d: t for d, t in texts if d is not None})
    assert got.pop(None)[1] is None
    assert got == want
    kept = jaccard.keep_one(docs(spark, [*texts, texts[0], texts[1]]))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()}) and ids.count(None) == 1


def thue_morse(n=1024):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate({97: 98, 98: 97})


def test_words_that_a_polynomial_confuses(spark):
    import pyarrow as pa

    a, b = thue_morse()
    for n in (48, 1024):
        texts = [" ".join([w[:n]] * 13) for w in (a, b)]
        data, offsets = hashing.text_column(pa.array(texts))
        w, w2, row = jaccard.shingle_sets(data, offsets)
        for lane in (w, w2):
            assert not set(lane[row == 0].tolist()) & set(lane[row == 1].tolist())
    out = substring.dedup_substrings(spark.createDataFrame([(1, " ".join([a] * 13)), (2, " ".join([b] * 13)), (3, " ".join([a] * 14))], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == {1: 0, 2: 0, 3: 14}


def sets_of(seed, clusters=6, size=40, n=400):
    """Clusters of near copies of random sets, as sketches, with the sets."""
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(clusters):
        base = rng.integers(0, 1 << 62, n)
        for _ in range(size):
            s = base.copy()
            s[rng.integers(0, n, rng.integers(0, 70))] = rng.integers(0, 1 << 62, 1)[0] + np.arange(1)
            sets.append(np.unique(np.concatenate([s, rng.integers(0, 1 << 62, rng.integers(0, 40))])))
    n = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets).astype(np.uint64), np.repeat(np.arange(len(sets)), n)
    data, ends = jaccard.sketches(flat, row, n)
    return sets, n, [data[ends[i] : ends[i + 1]].tobytes() for i in range(len(sets))]


def test_triangle_inequality_rules_pairs_out_and_loses_none():
    sets, n, sketch = sets_of(3)
    i, j = jaccard.candidates(sketch, n, np.arange(len(n)))
    found = set(zip(i.tolist(), j.tolist(), strict=True))
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (n[a] + n[b] - both):
                assert (a, b) in found
    bits = min(map(len, sketch))
    s = np.stack([np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, bits // 8), axis=0) for x in sketch])
    x, y, work = jaccard.voronoi_pairs(s, n, np.arange(len(n)), np.ones(len(n), bool))
    assert work < 0.6 * len(n) ** 2  # the others were ruled out by distances to pivots
    h = jaccard._hamming(s, s)
    want = {(a, b) for a in range(len(n)) for b in range(len(n)) if a != b and h[a, b] <= (n[a] + n[b]) // 7 and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b])}
    assert {tuple(p) for p in zip(x.tolist(), y.tolist(), strict=True)} == want


def test_stars_cover_and_end():
    rng = random.Random(4)
    i, j = zip(*sorted({tuple(sorted(rng.sample(range(30), 2))) for _ in range(150)}), strict=True)
    i, j = np.array(i), np.array(j)
    degree = np.bincount(np.concatenate([i, j]), minlength=30)
    for cover in (1, 4, 16, 64):
        c = jaccard.stars(i, j, 30, cover)
        got = np.bincount(np.concatenate([i[c], j[c]]), minlength=30)
        assert (got >= np.minimum(cover, degree)).all() and c.sum() <= 2 * cover * 30
    assert c.all()


def test_jaccard_of_large_cells_and_repeated_ids(spark, monkeypatch):
    from test_llm_queries import components

    monkeypatch.setattr(jaccard, "CELL", 6)
    monkeypatch.setattr(jaccard, "FREQUENT", 8)
    monkeypatch.setattr(jaccard, "STAR", 3)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 5])):
            w[rng.randrange(60)] = f"x{rng.randrange(400)}"
        texts.append((i, " ".join(w)))
    texts += [(100 + i, t) for i, t in enumerate(["z" * 3000, "z" * 3000 + " y", "A a", "a A"])]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, texts)).collect()}
    assert got == components(dict(texts))
    twice = docs(spark, [*texts[-4:], (7, "second"), (7, "first"), (7, None)]).withColumns({"_id": F.col("doc_id"), "g": F.lit(1), "d": F.lit(2)})
    kept = jaccard.keep_one(twice)
    assert kept.columns == twice.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) == {100, 101, 102, 103, 7} - {103} | ({103} if shingle_apart(texts) else set())
    assert jaccard.keep_one(twice.limit(0)).count() == 0 and jaccard.jaccard_components(twice.limit(0)).count() == 0


def shingle_apart(texts):
    """Whether the last two texts differ: A to Z count as a to z, so they do not."""
    return texts[-1][1].lower() != texts[-2][1].lower()


def test_substrings_of_repeated_ids_and_long_words(spark):
    w = " ".join(f"v{i}" for i in range(20))
    out = substring.dedup_substrings(docs(spark, [(1, w), (1, w), (2, "q" * 2000 + " " + w), (3, "q" * 2000)])).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in out) == [(1, 20, 0), (1, 20, 0), (2, 21, 20), (3, 1, 0)]


def test_word_hashes_of_slices():
    import pyarrow as pa

    texts = ["a b", None, " x\ty ", "", "A\x0bb\u00a0c"]
    data, offsets = hashing.text_column(pa.array(texts))
    h, row, start, length = hashing.word_hashes(data, offsets, lower=True)
    h = h[0]
    assert row.tolist() == [0, 0, 2, 2, 4, 4] and h[0] == h[4] and len(set(h.tolist())) == 5
    w = hashing.windows(h, 2)
    assert len(w) == 5 and len(set(w.tolist())) == 5 and len(hashing.windows(h, 9)) == 0


# op 10


def test_warc_edges(spark, tmp_path):
    body = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 1200
    rows = [(1, "http://a.b/x\r\ny", body), (2, "http://a.b/", body), (2, "http://a.b/", body), (3, None, "short"), (4, "z", None), (5, "http://b.a/", "short"), (None, "http://c/", body)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, offset int")
    out = warc.round_trip(pages, str(tmp_path / "w")).collect()
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in out)
    n = len(body.encode())
    assert got == sorted([(1, n, "revisit", 2), (2, n, "response", 0), (2, n, "response", 0), (3, 5, "response", 0), (4, 0, "response", 0), (5, 5, "response", 0), (0, n, "revisit", 2)])
    assert warc.round_trip(pages.limit(0), str(tmp_path / "e")).count() == 0


def test_archives_of_large_pages_in_any_time_zone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 8000)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 4)
    rows = [(i, f"http://h/{i}", chr(97 + i) * (9000 if i % 3 == 0 else 100)) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        warc.write_warc(pages, str(tmp_path / "w"))
        got = warc.read_runs(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted((r.page_id, r.payload_bytes, r.ts) for r in got) == [(i, len(h), f"2024-01-01T00:00:{i:02d}Z") for i, _, h in rows]
    big = [r.file for r in got if r.payload_bytes == 9000]
    assert len(set(big)) == len(big) == 3 and not set(big) & {r.file for r in got if r.payload_bytes == 100}


def test_loser_tree_and_ranges(spark):
    rng = random.Random(8)
    rows = [(f"f{rng.randint(0, 6)}", f"k{rng.randint(0, 20)}", str(rng.randint(0, 9)), i, 1, "d", "response", None, i, 1) for i in range(500)]
    runs = {}
    for r in rows:
        runs.setdefault(r[0], []).append(r)
    merged = list(warc.LoserTree([sorted(x, key=warc._order) for x in runs.values()]))
    assert merged == sorted(rows, key=warc._order)
    assert list(warc.LoserTree([])) == []
    df = spark.createDataFrame(rows, warc.RUN_SQL)
    out = warc.merge_runs(df, rows_per_range=60).orderBy("range", "seq").collect()
    assert [tuple(r)[:10] for r in out] == sorted(rows, key=warc._order) and len({r["range"] for r in out}) > 3
