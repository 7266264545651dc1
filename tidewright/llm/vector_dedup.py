"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in halves, each half has a codebook of its own (k-means on
a bounded sample), and the pairs of nearest codewords form a grid of cells. A
vector lives in one cell. To find its near copies it visits cells by the
multi-sequence algorithm (Babenko and Lempitsky 2012), nearest first, until no
cell beyond can hold a vector within reach: a vector that lives with codeword j
of a half lies on j's side of the plane between j and the nearest codeword, so
its half is at least as far away as that plane. The order is by the sum of the
squares of these distances over both halves, and the stop at the squared reach
of the wanted cosine makes the target recall one. Pairs met in a visited cell
are verified in double precision.

Equal vectors are one class. Cells of many vectors are split into blocks, and a
task compares a block of visitors with a block of residents; it returns counts
and a spanning forest, never the pairs."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, small, stored
from .vectors import components, lengths, matrix, usable

COSINE = 0.98
#: Vectors that the codebooks are fitted on, at most about; rounds of k-means; vectors of a label that a cell should hold; sampled vectors to a codeword of a half at least.
SAMPLE, ROUNDS, CELL, PER_CODEWORD = 20_000, 12, 48, 8
#: Vectors of a block.
BLOCK = 2048


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their norms, by their largest component first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def codebook(x: np.ndarray, k: int) -> np.ndarray:
    """k-means with starts drawn far from each other; empty codewords go."""
    rng = np.random.default_rng(7)
    if not x.shape[1]:
        return np.zeros((1, 0))
    c = x[[0]]
    while len(c) < k:
        d = ((x[:, None, :] - c[None, -1:, :]) ** 2).sum(2).min(1) if len(c) == 1 else np.minimum(d, ((x - c[-1]) ** 2).sum(1))  # noqa: F821
        if d.sum() <= 0:
            break
        c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum())]])
    for _ in range(ROUNDS):
        near = _squares(x, c).argmin(1)
        c = np.stack([x[near == j].mean(0) for j in range(len(c)) if (near == j).any()])
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :])


def _planes(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, squared distance to the plane between it and each other codeword)."""
    d = _squares(x, c)
    home = d.argmin(1)
    apart = np.sqrt(_squares(c, c))[home]
    h = (d - d[np.arange(len(x)), home][:, None]) / np.where(apart > 0, 2 * apart, 1)
    h[apart <= 0] = 0
    return home, np.maximum(0, h - 1e-7) ** 2


def multi_sequence(p: np.ndarray, q: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by ascending p[i] + q[j] while that is at most reach."""
    a, b = np.argsort(p, kind="stable"), np.argsort(q, kind="stable")
    heap, seen = [(p[a[0]] + q[b[0]], 0, 0)], {(0, 0)}
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(a) and n[1] < len(b) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (p[a[n[0]]] + q[b[n[1]]], *n))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row. Two vectors link when
    their labels are equal and not null, their lengths equal, and their cosine in
    doubles is at least `cosine`. n_links counts the other vectors linked
    directly, component_id is the smallest vec_id that links reach, kept says
    whether that is the row's own. Vectors that are null, empty or zero, or hold
    null or non-finite components, and rows with a null label or id link with
    nothing: no links, their own component (null for a null id, then not kept).
    Rows that repeat link with each other; rows that share an id are one vertex.
    Columns of any other name are not read. An empty table gives an empty one."""
    ids = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast(f"array<{components(vectors, embedding)}>").alias("v"), F.col(f"`{label}`").alias("label"))
    good = usable(vectors, vec_id, embedding, F.col(f"`{label}`").alias("label")).where("label is not null").where("exists(v, x -> x <> 0)")
    classes = stored(good.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    met = None
    for dim in lengths(classes):
        part = _one_length(classes.where(F.size("v") == dim), cosine)
        met = part if met is None else met.union(part)
    label_of = classes.select(F.col("label").alias("c_label"), F.col("v").alias("c_v"), "rep", "copies")
    if met is None:
        linked = label_of.withColumns({"more": F.lit(0).cast("long"), "component": F.col("rep")})
    else:
        met = stored(met, "met")
        counts = met.groupBy(F.col("rep").alias("n_rep")).agg(F.sum("n").alias("more"))
        comps = connected_components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
        linked = label_of.join(counts, F.expr("rep = n_rep"), "left").join(comps, F.expr("rep = node"), "left")
    # classes of one vector without links say nothing that a missing row does not
    linked = linked.where("copies > 1 or component is not null").select("c_label", "c_v", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = ids.join(linked, F.expr("label = c_label and v = c_v and vec_id is not null"), "left")
    component = F.expr("coalesce(c, vec_id)")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("vec_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _one_length(classes: DataFrame, cosine: float) -> DataFrame:
    """(rep, n, root): for classes of one vector length, linked vectors by class and edges to a root of each block's components."""
    n, n_labels = classes.agg(F.count("*"), F.approx_count_distinct("label")).first()
    take = min(1.0, SAMPLE / n)
    sample = classes.where(F.pmod(F.xxhash64("rep", F.lit(11)), F.lit(1 << 30)) < int(take * (1 << 30))).select("v").limit(2 * SAMPLE).collect()
    x = unit(np.array([r.v for r in sample], np.float64)) if sample else np.ones((1, len(classes.first().v)))
    half = x.shape[1] // 2
    words = int(np.clip(np.sqrt(n / max(1, n_labels) / CELL), 1, max(1, len(x) // PER_CODEWORD)))  # grows with the square root of n
    c1, c2 = codebook(x[:, :half], words), codebook(x[:, half:], words)
    reach = 2 - 2 * cosine + 1e-9

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = unit(matrix(b.column(1)))
            cell = _squares(u[:, :half], c1).argmin(1) * len(c2) + _squares(u[:, half:], c2).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int64))], names=["label", "v", "rep", "copies", "cell"])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u = unit(matrix(b.column(1)))
            (_, p), (_, q) = _planes(u[:, :half], c1), _planes(u[:, half:], c2)
            cells = [[i * len(c2) + j for i, j in multi_sequence(p[r], q[r], reach)] for r in range(len(u))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(cells, pa.list_(pa.int64()))], names=["label", "v", "rep", "cells"])

    kind, v_type = dict(classes.dtypes)["label"], dict(classes.dtypes)["v"]
    home = stored(classes.select("label", "v", "rep", "copies").mapInArrow(homes, f"label {kind}, v {v_type}, rep long, copies long, cell long"), "homes")
    lived = home.groupBy(F.col("label").alias("o_label"), F.col("cell").alias("o_cell")).agg(F.count("*").alias("residents"))
    n_cells = lived.count()
    seen = home.select("label", "v", "rep").mapInArrow(visits, f"label {kind}, v {v_type}, rep long, cells array<long>").select("label", "v", "rep", F.explode("cells").alias("cell"))
    came = seen.join(small(lived, n_cells), F.expr("label = o_label and cell = o_cell")).drop("o_label", "o_cell")  # empty cells go
    came = stored(came, "visits")
    visitors = came.groupBy(F.col("label").alias("o_label"), F.col("cell").alias("o_cell")).agg(F.count("*").alias("visitors"))
    parts = lambda c: f"cast(ceil({c} / {BLOCK}) as long)"
    each = lambda m: F.explode(F.expr(f"sequence(0L, {m} - 1)"))
    size = visitors.join(lived.withColumnsRenamed({"o_label": "l2", "o_cell": "c2"}), F.expr("o_label = l2 and o_cell = c2")).drop("l2", "c2")
    size = small(size, n_cells)
    key = ["label", "cell", "r_part", "v_part"]
    r = home.join(size, F.expr("label = o_label and cell = o_cell")).withColumn("r_part", F.expr(f"pmod(xxhash64(rep), {parts('residents')})")).withColumn("v_part", each(parts("visitors")))
    v = came.drop("residents").join(size, F.expr("label = o_label and cell = o_cell")).withColumn("v_part", F.expr(f"pmod(xxhash64(rep, 1), {parts('visitors')})")).withColumn("r_part", each(parts("residents")))

    def compare(res: pa.Table, vis: pa.Table) -> pa.Table:
        empty = pa.table({"rep": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not res.num_rows or not vis.num_rows:
            return empty
        a, b = vis.column("rep").to_numpy(), res.column("rep").to_numpy()
        u, w = unit(matrix(vis.column("v"))), unit(matrix(res.column("v")))
        c = u @ w.T
        link = c >= cosine
        i, j = np.nonzero(np.abs(c - cosine) < 1e-12)  # a product of matrices may round (a, b) and (b, a) differently
        if len(i):
            link[i, j] = (u[i] * w[j]).sum(1) >= cosine
        link &= a[:, None] != b[None, :]
        i, j = link.any(1), link.any(0)
        if not i.any():
            return empty
        link, a, b, copies = link[i][:, j], a[i], b[j], res.column("copies").to_numpy()[j]
        counts = link @ copies
        # smallest id that each side reaches inside this block
        far = np.iinfo(np.int64).max
        ra, rb = a.copy(), b.copy()
        while True:
            na = np.minimum(ra, np.where(link, rb[None, :], far).min(1))
            nb = np.minimum(rb, np.where(link, na[:, None], far).min(0))
            if (na == ra).all() and (nb == rb).all():
                break
            ra, rb = na, nb
        return pa.table({"rep": np.concatenate([a, b]), "n": np.concatenate([counts, np.zeros(len(b), np.int64)]), "root": np.concatenate([ra, rb])})

    r, v = r.select(*key, "rep", "copies", "v"), v.select(*key, "rep", "v")
    return r.groupBy(*key).cogroup(v.groupBy(*key)).applyInArrow(compare, "rep long, n long, root long")
