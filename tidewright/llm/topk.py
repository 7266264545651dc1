"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments; of each its mean and its deviation (the norm of
what is left after the mean) are kept. The squared distance of two vectors is
|q|^2 + |x|^2 - 2 <q, x>, and by Cauchy and Schwarz in each segment of length L
<q, x> is at most the sum of L mean(q) mean(x) + dev(q) dev(x): a lower bound
of the distance, an upper bound of the score. From one segment to many the
bounds grow tighter. Pairs whose bound stays below the k-th best score known so
far go; exact integer products are computed for those that are left.

Queries and rows are dealt into blocks of bounded size whose vectors have like
statistics. A block keeps the range of its means and its largest deviations, so
the same bound holds for two blocks: pairs of blocks that cannot hold a result
go before any vector is sent. A task takes one block of each. The k-th best
score against a bounded sample is where pruning begins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import lengths, matrix, usable

K, SCALE = 20, 64
#: Segments by level, coarse to fine.
LEVELS = (1, 4, 16)
#: Queries and rows in a block, about; rows of the sample; queries that a task scores at once; groups of like vectors at most.
QUERY_BLOCK, ROW_BLOCK, SAMPLE, CHUNK, GROUPS = 2048, 8192, 2048, 256, 256
LONG = 2**63 - 1


def scaled(v: np.ndarray) -> np.ndarray:
    """floor(64 x), in doubles, which hold it exactly; beyond the doubles, the last one."""
    top = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * v), -top, top)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row and segment sqrt(L) * mean and deviation: the product of two rows of these bounds the inner product from above."""
    parts = np.array_split(x, min(segments, x.shape[1]), axis=1)
    with np.errstate(over="ignore", invalid="ignore"):  # what is beyond the doubles bounds nothing
        mean = np.stack([p.mean(1) for p in parts], 1)
        dev = np.stack([np.sqrt(np.maximum(0, ((p - p.mean(1, keepdims=True)) ** 2).sum(1))) for p in parts], 1)
        return np.hstack([mean * np.sqrt([p.shape[1] for p in parts]), dev])


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while all sums fit 53 bits, in 64-bit
    integers while they fit those, else in Python's, held within the range of a long."""
    with np.errstate(over="ignore"):
        top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return q @ x.T
    if top < 2**63:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = lambda m: np.array([[int(c) for c in row] for row in m], object).reshape(m.shape)
    return np.clip(whole(q) @ whole(x).T, -LONG, LONG).astype(np.int64)


def slack(sq: np.ndarray, sx: np.ndarray) -> np.ndarray:
    """How much rounding may take from a bound; a row of statistics is as long as its vector."""
    return 1e-9 * np.sqrt((sq * sq).sum(1))[:, None] * np.sqrt((sx * sx).sum(1))[None, :] + 1e-6


def best(q_id: np.ndarray, q: np.ndarray, x_id: np.ndarray, x: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row id, score) of the k best rows of x for each q that reach
    least[q]; ties go to the smaller id, a row with the query's id is left out."""
    order = np.argsort(x_id, kind="stable")
    x_id, x = x_id[order], x[order]
    stats = [(statistics(q, s), statistics(x, s)) for s in LEVELS if s < x.shape[1]]
    out: list[tuple] = []
    for a in range(0, len(q), CHUNK):
        rows, floor = np.arange(a, min(a + CHUNK, len(q))), least[a : a + CHUNK]
        cols = np.arange(len(x))
        alive = np.ones((len(rows), len(cols)), bool)
        for sq, sx in stats:
            with np.errstate(over="ignore", invalid="ignore"):
                alive &= ~(sq[rows] @ sx[cols].T + slack(sq[rows], sx[cols]) < floor[:, None])
            some = alive.any(0)
            if not some.all():
                cols, alive = cols[some], alive[:, some]
        if not len(cols):
            continue
        score = _products(q[rows], x[cols])
        alive &= (score >= floor[:, None]) & (x_id[cols][None, :] != q_id[rows][:, None])
        low = np.iinfo(np.int64).min if score.dtype == np.int64 else -np.inf
        score = np.where(alive, score, low)
        if len(cols) > k:  # the k-th best score; ties beyond it go by id below
            cut = np.partition(score, len(cols) - k, axis=1)[:, len(cols) - k]
            alive &= score >= cut[:, None]
        i, j = np.nonzero(alive)
        s = score[i, j]
        order = np.lexsort((x_id[cols[j]], -s, i))
        i, j, s = i[order], j[order], s[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        out.append((q_id[rows[i[keep]]], x_id[cols[j[keep]]], s[keep].astype(np.int64)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k rows of vectors with the highest
    scores for each row of queries, all if there are fewer; ties go to the
    smaller vec_id. A score is the inner product of floor(64 x) of the
    components, for vectors of one length only; scores beyond a long count as
    the largest or smallest one. Vectors that are null or empty, or hold null or
    non-finite components, and rows with a null id take no part. Rows with the
    query's own id are left out; a query id that repeats counts once, with the
    least of its vectors; rows of vectors that repeat are results each. Other
    columns are not read, whatever their names. Empty tables give an empty one."""
    spark = vectors.sparkSession
    rows, asks = usable(vectors, vec_id, embedding), usable(queries, vec_id, embedding)
    found = None
    for dim in lengths(rows):
        part = _one_length(rows.where(F.size("v") == dim), asks.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v")), k, dim)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: Whether two blocks can hold a result: statistics lo and hi of two blocks bound every inner product between them.
MAY_MEET = """aggregate(zip_with(zip_with(q_lo, q_hi, (l, h) -> struct(l, h)), zip_with(x_lo, x_hi, (l, h) -> struct(l, h)),
    (q, x) -> greatest(q.l * x.l, q.l * x.h, q.h * x.l, q.h * x.h)), 0D, (s, p) -> s + p + 1e-9D * abs(p)) + 1e-6D + 1e-9D * q_norm * x_norm < floor"""


def _one_length(rows: DataFrame, asks: DataFrame, k: int, dim: int) -> DataFrame:
    n, n_asks = rows.count(), asks.count()
    hashed = F.xxhash64("vec_id", F.lit(3))
    sample = rows.where(F.pmod(hashed, F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))).limit(4 * SAMPLE).collect()
    s_id = np.array([r.vec_id for r in sample], np.int64)
    s_x = scaled(np.array([r.v for r in sample], np.float64)) if sample else np.zeros((0, dim))
    level = min(LEVELS[-1], dim)
    n_groups = int(np.clip(-(-n // ROW_BLOCK), 1, min(GROUPS, max(1, len(s_x) // 8))))
    centres = np.nan_to_num(statistics(s_x[np.argsort(s_id % 1009, kind="stable")][:n_groups], level)) if len(s_x) else np.zeros((1, 2 * level))
    v_type = f"array<{dict(rows.dtypes)['v'][6:-1]}>"

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The group of each vector, the centre whose statistics are nearest; for queries the score that a result reaches at least."""
        for b in batches:
            x = scaled(matrix(b.column(1)))
            least = np.full(len(x), float(-(2**62)) * 4)
            group = np.zeros(len(x), np.int64)
            if len(x):
                s = np.nan_to_num(statistics(x, level))
                group = np.stack([np.abs(s - c).sum(1) for c in centres], 1).argmin(1)
                if len(s_id) > k:
                    score = _products(x, s_x).astype(np.float64)
                    score[s_id[None, :] == b.column(0).to_numpy()[:, None]] = -np.inf
                    least = np.partition(score, len(s_id) - k, axis=1)[:, len(s_id) - k]
                    least -= np.abs(least) * 1e-15
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(least), pa.array(group)], names=["vec_id", "v", "least", "grp"])

    def block(table: pa.Table) -> pa.Table:
        """One row: ids, vectors, thresholds, and the range of the statistics."""
        x = scaled(matrix(table.column("v")))
        s = statistics(x, level)
        lo, hi = s.min(0), s.max(0)
        lo[level:] = hi[level:]  # of deviations the largest counts
        with np.errstate(over="ignore"):
            norm = float(np.sqrt((s * s).sum(1)).max())
        fine = np.isfinite(lo).all() and np.isfinite(hi).all() and np.isfinite(norm) and norm < 1e150
        one = lambda c, t: pa.array([c], t)
        stats = pa.list_(pa.float64())
        return pa.table({
            "block": one((table.column("grp")[0].as_py() << 32) + table.column("part")[0].as_py(), pa.int64()), "ids": one(table.column("vec_id").to_pylist(), pa.list_(pa.int64())), "vs": pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), table.column("v").combine_chunks()),
            "least": one(table.column("least").to_pylist(), pa.list_(pa.float64())), "floor": one(float(table.column("least").to_numpy().min()), pa.float64()),
            "lo": one(lo.tolist() if fine else [], stats), "hi": one(hi.tolist() if fine else [], stats), "norm": one(norm if fine else 0.0, pa.float64()),
        })

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        dealt = df.mapInArrow(grouped, f"vec_id long, v {v_type}, least double, grp long")
        many = {r.grp: -(-r["count"] // size) for r in dealt.groupBy("grp").count().collect()}  # at most GROUPS rows
        parts = F.create_map(*[F.lit(x) for p in many.items() for x in p])[F.col("grp")] if many else F.lit(1)
        keyed = dealt.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(5)), parts))
        made = keyed.groupBy("grp", "part").applyInArrow(block, f"block long, ids array<long>, vs array<{v_type}>, least array<double>, floor double, lo array<double>, hi array<double>, norm double")
        return stored(made, name)

    x, q = blocks(rows, ROW_BLOCK, "row-blocks"), blocks(asks, QUERY_BLOCK, "query-blocks")
    xs, qs = (b.select(F.col("block").alias(f"{c}_block"), F.col("lo").alias(f"{c}_lo"), F.col("hi").alias(f"{c}_hi"), F.col("norm").alias(f"{c}_norm"), *extra) for b, c, extra in ((x, "x", []), (q, "q", [F.col("floor")])))
    # each block of queries meets the summary of each block of rows once, under a key of its own
    n_q = max(1, -(-q.count() // 64))
    xs = xs.withColumn("q_key", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)).cast("array<long>")))
    qs = qs.withColumn("q_key", F.pmod(F.xxhash64("q_block"), F.lit(n_q)))
    meet = xs.join(qs, "q_key").where(f"size(x_lo) = 0 or size(q_lo) = 0 or not {MAY_MEET}").select("x_block", "q_block")
    # a block of queries is sent for every block of rows that it meets, a block of rows once
    pairs = meet.join(q.select(F.col("block").alias("q_block"), F.col("ids").alias("q_id"), F.col("vs").alias("q"), "least"), "q_block").join(x.select(F.col("block").alias("x_block"), F.col("ids").alias("x_id"), F.col("vs").alias("x")), "x_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                flat = lambda c, i=i, b=b: b.column(c).slice(i, 1).flatten()
                q_id, r_id, s = best(flat(2).to_numpy(), scaled(matrix(flat(3))), flat(0).to_numpy(), scaled(matrix(flat(1))), flat(4).to_numpy(), k)
                yield pa.RecordBatch.from_arrays([pa.array(q_id), pa.array(r_id), pa.array(s)], names=["query_id", "vec_id", "score"])

    return pairs.select("x_id", "x", "q_id", "q", "least").mapInArrow(run, "query_id long, vec_id long, score long")
