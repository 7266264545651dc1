"""Toxic passages by maximum-scoring segments of token log-odds.

Tokens are words and, for words that training has seen in fewer than FEW
documents, their first four letters. A token's score is its log-odds between
toxic and clean documents with an informative Dirichlet prior (Monroe et al.
2008), above or below zero, kept where it is significant and zero elsewhere;
every token pays a drift, so that random text scores below zero. One linear scan (Ruzzo and Tompa 1999) finds all maximal
segments. Their scores follow an extreme-value law in clean text (Karlin and
Altschul 1990): lambda solves sum p exp(lambda s) = 1 over clean tokens, K is
counted on clean documents. A document adds up the evidence of its significant
segments, and a logistic curve fitted on the training documents maps it to a
probability."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, small_batches, stored

#: Labelled documents that training takes, about; they are chosen by a hash. This bounds the model.
TRAIN_DOCS = 40_000
#: Prior counts as a multiple of the toxic ones, least z of a token that counts, most a token scores, drift of every token, letters of a stem, documents that make a word known.
PRIOR, LEAST_Z, MOST, DRIFT, STEM, FEW = 1.0, 3.3, 6.0, 0.25, 4, 5
#: A segment is significant when its expected number in clean texts of this size is below this.
SIGNIFICANT = 1.0
#: Evidence is binned to this step for the fit of the curve.
BIN = 0.25

words = re.compile(r"[^\W_]+").findall


def maximal_segments(scores: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """(first, last, score) of all maximal-scoring segments, left to right.
    scores: (position, score) of some tokens, in order; all other tokens score
    -DRIFT, and the given scores include their drift."""
    found: list[list] = []  # [sum before, sum after, first, last]
    total, at = 0.0, 0
    for pos, s in scores:
        total -= DRIFT * (pos - at)
        if s <= 0:
            total, at = total + s, pos + 1
            continue
        cand = [total, total + s, pos, pos]
        total, at = cand[1], pos + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= cand[0]:
                j = found[j][4]  # those between start higher and cannot be joined to
            if j < 0 or found[j][1] >= cand[1]:
                found.append([*cand, j])
                break
            cand = [found[j][0], cand[1], found[j][2], cand[3]]
            del found[j:]
    return [(x[2], x[3], x[1] - x[0]) for x in found]


class Model:
    """Scores of words and stems (drift included), the known words with a scored
    stem, which never fall back to it, the extreme-value law and the curve."""

    def __init__(self, word: dict[str, float], stem: dict[str, float], lam: float = 1.0, k: float = 1.0, slope: float = 0.0, base: float = -4.0, known: frozenset[str] = frozenset()) -> None:
        self.word, self.stem, self.lam, self.k, self.slope, self.base, self.known = word, stem, lam, k, slope, base, known

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        tokens = words(text.lower())
        word, stem, known = self.word, self.stem, self.known
        hits = []
        for i, t in enumerate(tokens):
            s = word.get(t)
            if s is None and t not in known:
                s = stem.get(t[:STEM])
            if s is not None:
                hits.append((i, s))
        return len(tokens), maximal_segments(hits)

    def evidence(self, text: str) -> float:
        """Sum over significant segments of -ln of the expected number of as good ones in clean text of this length."""
        n, found = self.segments(text)
        limit = math.log(self.k * max(n, 1))
        return sum(max(0.0, self.lam * s - limit + math.log(SIGNIFICANT)) for _, _, s in found)

    def score(self, text: str) -> float:
        x = self.base + self.slope * min(self.evidence(text), 1e4)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and stems (with a * behind) of toxic and clean texts, summed up over a partition."""
    both: tuple[Counter, Counter] = Counter(), Counter()

    def out() -> pa.RecordBatch:
        keys = list(both[0].keys() | both[1].keys())
        batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([both[y][w] for w in keys], pa.int64()) for y in (1, 0))], names=["w", "t", "c"])
        both[0].clear(), both[1].clear()
        return batch

    for b in batches:
        for text, y in zip(b.column(0), b.column(1), strict=True):
            c, tokens = both[y.as_py()], words(text.as_py().lower())
            c.update(tokens := set(tokens))  # once a document, as one that repeats itself tells no more
            c.update({t[:STEM] + "*" for t in tokens})
            c[""] += len(tokens)
            if len(both[0]) + len(both[1]) > 300_000:
                yield out()
    yield out()


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from docs (doc_id, text) and labels (doc_id, toxic 0 or 1). Rows
    with a null in either count for nothing; labels that repeat count once, a
    document labelled both ways counts for both, rows of docs that share an id
    count each. Without toxic or clean rows, as with empty tables, the model
    scores every text at the rate of toxic labels. Other columns are not read."""
    y = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("y")).where("l_id is not null and y in (0, 1)").distinct()
    n, n_toxic = y.agg(F.count("*"), F.sum("y")).first()
    rate = ((n_toxic or 0) + 0.5) / (n + 1.0)
    plain = Model({}, {}, base=math.log(rate / (1 - rate)))
    if not n or not n_toxic or n == n_toxic:
        return plain
    share = min(1.0, train_docs / n)
    y = y.where(F.pmod(F.xxhash64(F.col("l_id"), F.lit(17)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about train_docs rows of two numbers whatever the size of labels: texts are not shuffled
    y = stored(y, "labels")
    train = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(small(y, y.count(), 4 * TRAIN_DOCS), F.expr("doc_id = l_id")).select("text", "y")
    tokens = train.mapInArrow(_counts, "w string, t long, c long").groupBy("w").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    tokens = stored(tokens, "tokens")
    n_t, n_c = next(((float(r.t), float(r.c)) for r in tokens.where("w = ''").collect()), (0.0, 0.0))
    if not n_t or not n_c:
        return plain
    prior = PRIOR * n_t

    def odds(r) -> tuple[float, float]:
        a = prior * (r.t + r.c) / (n_t + n_c)
        d = math.log((r.t + a) / (n_t + prior - r.t - a)) - math.log((r.c + a) / (n_c + prior - r.c - a))
        return d, d / math.sqrt(1 / (r.t + a) + 1 / (r.c + a))

    # far from its share in toxic text and seen there, or expected there, several times: bounded by the tokens of the training documents
    share_t = n_t / (n_t + n_c)
    likely = f"w <> '' and (t >= 5 and t * {n_c!r}D > 2 * c * {n_t!r}D or (t + c) * {share_t!r}D >= 5 and 2 * t * {n_c!r}D < c * {n_t!r}D)"
    rows = [(r, *odds(r)) for r in tokens.where(F.expr(likely)).collect()]
    kept = [(r, max(-MOST, min(MOST, d)) - DRIFT) for r, d, z in rows if abs(z) >= LEAST_Z and abs(d) > 2 * DRIFT]
    word = {r.w: s for r, s in kept if not r.w.endswith("*")}
    stem = {r.w[:-1]: s for r, s in kept if r.w.endswith("*") and s > 0}
    # words with a scored stem: the known ones score zero, of the others the stem tells
    spark = docs.sparkSession
    stems = spark.createDataFrame([(w,) for w in stem], "s string")
    of = tokens.where("not w like '%*'").join(small(stems, len(stem)), F.expr(f"left(w, {STEM}) = s"))
    known = frozenset(r.w for r in of.where(F.col("t") + F.col("c") >= FEW).select("w").collect())
    few = {r.s: float(r.c or 0) for r in of.where(F.col("t") + F.col("c") < FEW).groupBy("s").agg(F.sum("c").alias("c")).collect()}
    clean = {r.w: r.c / n_c for r, _ in kept}
    law = [(s, clean[w] + 0.5 / n_c) for w, s in word.items()]
    law += [(s, few.get(w, 0.0) / n_c + 0.5 / n_c) for w, s in stem.items()]
    rest = max(0.0, 1 - sum(p for _, p in law))
    f = lambda lam: rest * math.exp(-lam * DRIFT) + sum(p * math.exp(lam * s) for s, p in law) - 1
    lo, hi = 1e-3, 20.0
    if f(lo) >= 0:
        return plain
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    model = Model(word, stem, lam=lo, known=known)

    def clean_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_tokens = n_found = 0.0
        for b in batches:
            for t in b.column(0):
                k, found = model.segments(t.as_py())
                n_tokens += k
                n_found += sum(math.exp(min(0.0, -model.lam * (MOST / 2 - s))) >= 1 for _, _, s in found)
        yield pa.RecordBatch.from_arrays([pa.array([n_tokens]), pa.array([n_found])], names=["n", "k"])

    n_tokens, n_found = train.where("y = 0").select("text").mapInArrow(clean_tail, "n double, k double").agg(F.sum("n"), F.sum("k")).first()
    model.k = max(1e-9, (n_found + 0.5) / (n_tokens + 1.0) * math.exp(model.lam * MOST / 2))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [round(min(100.0, model.evidence(t.as_py())) / BIN) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()), b.column(1)], names=["x", "y"])

    bins = [(r.x * BIN, float(r.n), float(r.y)) for r in train.mapInArrow(binned, "x int, y int").groupBy("x").agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect()]
    model.slope, model.base = _curve(bins)
    return model


def _curve(bins: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Logistic curve through (x, n, positives) by damped Newton steps with a small ridge."""
    n, y = sum(b[1] for b in bins), sum(b[2] for b in bins)
    a, b0 = 0.0, math.log((y + 0.5) / (n - y + 0.5))
    loss = lambda a, b: sum(n * math.log1p(math.exp(min(500, a * x + b))) - y * (a * x + b) for x, n, y in bins) + 0.01 * (a * a + b * b)
    for _ in range(50):
        ga, gb, haa, hab, hbb = 0.02 * a, 0.02 * b0, 0.02, 0.0, 0.02
        for x, n, y in bins:
            p = 1 / (1 + math.exp(-max(-500, min(500, a * x + b0))))
            w = n * p * (1 - p)
            ga, gb, haa, hab, hbb = ga + x * (n * p - y), gb + n * p - y, haa + w * x * x, hab + w * x, hbb + w
        det = haa * hbb - hab * hab
        da, db, step = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det, 1.0
        now = loss(a, b0)
        while step > 1e-6 and loss(a - step * da, b0 - step * db) > now:
            step /= 2
        a, b0 = a - step * da, b0 - step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return max(0.0, a), b0


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages) for each row of docs: the probability of a
    toxic label and the significant passages as array<struct<first, last,
    evidence>> in token positions. A null or empty text has no passage and the
    lowest score. Equal texts score alike, ties included; texts may be of any
    length. Other columns are not read. An empty table gives an empty one."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training documents
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("evidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            scores, passages = [], []
            for t in b.column(1):
                n, found = m.segments(t.as_py() or "")
                limit = math.log(m.k * max(n, 1)) - math.log(SIGNIFICANT)
                good = [(i, j, m.lam * s - limit) for i, j, s in found if m.lam * s > limit]
                x = m.base + m.slope * min(sum(e for _, _, e in good), 1e4)
                scores.append(1 / (1 + math.exp(-max(-50.0, min(50.0, x)))))
                passages.append([{"first": i, "last": j, "evidence": e} for i, j, e in good])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)], names=["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, passages array<struct<first: int, last: int, evidence: double>>")


def keep_clean(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whatever their names, that score
    below `least`; a null text counts as empty. Rows that repeat stay or go together."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([sent.value.score(t.as_py() or "") < least for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 on division by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
