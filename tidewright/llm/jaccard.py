"""Exact Jaccard join of documents on word shingles, in metric regions.

Jaccard distance is a metric, but texts that share nothing are all at distance
one of each other: around pivots that are documents every triangle-inequality
window would hold nearly all of them. The outer regions therefore have single
shingles as pivots. Ordered by (frequency in a bounded sample, hash), a set
lies in the regions of its first n - ceil(t n) + 1 shingles; two sets with
similarity t or more meet in one of these. Regions with the same members are
one cell, and equal sets one member.

A cell is joined with the metric of its members' sketches. A sketch holds, for
each of B classes of shingle hashes, whether the number of shingles in it is
odd. The Hamming distance of two sketches is a metric and at most the size of
the symmetric difference of the sets, so a pair that links is no farther apart
than its reach, which both sizes bound. Inside a cell pivots are taken farthest
first, members go to the Voronoi region of the nearest pivot, and a member is
replicated to every other region whose pivot is at most twice its reach farther
away than its own (the triangle inequality); regions join recursively, and what
remains within reach in a small region is a candidate.

Candidates are compared by their words, exactly. So that no group is ever
expanded into all its pairs, a round sends the stars of a few members that cover
the others, once each at first. Links found join components; members of
different components that are still within reach form the cells of the next
round, whose stars cover each member four times as often, until all pairs that
are left have been compared."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_key, connected_components, drop_stored, key_runs, release, small, small_batches, stored
from .hashing import mix, slices, text_column, windows, word_hashes

#: Words of a shingle; a pair links when 100 * intersection >= LEAST * union.
WORDS, LEAST = 5, 75
#: Documents sampled to order shingles by frequency, and sampled documents that make one frequent.
SAMPLE_DOCS, FREQUENT = 4096, 3
#: Members up to which one task joins a cell; larger ones are dealt out in blocks. Members of a region that are compared directly.
CELL, LEAF = 4096, 48
#: Stars of a larger cell's first round.
STARS = 8
#: Least and most bits of a sketch; between, two to four times the size of the set.
BITS = (256, 1 << 16)
#: Partners of a document that one task compares with it.
STAR = 256


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first lane, second lane, row): the distinct shingles of each row, by row, then first lane.
    A row of fewer than k words has one shingle, all its words; a row without words has none."""
    h, row, _, _ = word_hashes(data, offsets, lower=True)
    w = [windows(h[lane], k, lane) for lane in (0, 1)]
    inside = np.flatnonzero(row[: len(w[0])] == row[k - 1 :]) if len(w[0]) else np.zeros(0, np.int64)
    w, r = [x[inside] for x in w], row[inside]
    count = np.bincount(row, minlength=len(offsets) - 1)
    begin = np.cumsum(count) - count
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            w = [np.concatenate([w[lane], windows(h[lane], n, lane)[begin[short]]]) for lane in (0, 1)]
            r = np.concatenate([r, short])
    order = np.lexsort((w[0], r))
    a, b, r = w[0][order], w[1][order], r[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (r[1:] != r[:-1])
    return a[new], b[new], r[new]


def prefix_length(n, least: int = LEAST):
    """Shingles of which two sets that link share one at least, for a set of n."""
    return n - (least * n + 99) // 100 + 1


def reach(n, least: int = LEAST):
    """The most that a sketch can differ from that of a set it links with, for a set of n."""
    return n * (100 - least) // least


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.view(np.int64)))


def sketches(w: np.ndarray, r: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of the sketches of rows with n shingles w each; r is the row of each shingle."""
    bits = np.clip(2 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), *BITS)
    ends = np.concatenate([[0], np.cumsum(bits)])
    odd = np.bincount(ends[r] + (w.view(np.int64) & (bits[r] - 1)), minlength=int(ends[-1])) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little"), ends // 8


def _describe(frequent: np.ndarray, often: np.ndarray, k: int, least: int):
    """(doc_id, n, h1, h2, sketch, rare, common): size, hash and sketch of each
    set, and its first shingles in the order of regions, those that are frequent in the sample apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch.column(1))
            for a, b in slices(offsets):
                w, w2, r = shingle_sets(data, offsets[a : b + 1], k)
                n = np.bincount(r, minlength=b - a)
                node = np.zeros((2, b - a), np.uint64)
                full, begin = np.flatnonzero(n), np.cumsum(n) - n
                if len(full):
                    node[0, full] = np.add.reduceat(mix(w, 98), begin[full])
                    node[1, full] = np.add.reduceat(mix(w2, 99, 1), begin[full])
                sketch, ends = sketches(w, r, n)
                rank = np.zeros(len(w), np.int64)
                if len(frequent) and len(w):
                    at = np.minimum(np.searchsorted(frequent, w), len(frequent) - 1)
                    rank = np.where(frequent[at] == w, often[at], 0)
                    some = np.flatnonzero(np.isin(r, np.unique(r[rank > 0])))  # the rows whose order that changes
                    order = some[np.lexsort((w[some], rank[some], r[some]))]
                    w, rank = w.copy(), rank.copy()
                    w[some], rank[some] = w[order], rank[order]
                first = np.arange(len(w)) - begin[r] < prefix_length(n, least)[r]
                rare, common = first & (rank == 0), first & (rank > 0)
                size = lambda m, r=r, rows=b - a: np.bincount(r[m], minlength=rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), pa.array(n, pa.int32()), pa.array(node[0].view(np.int64)), pa.array(node[1].view(np.int64)),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(sketch)]), _lists(w[rare], size(rare)), _lists(w[common], size(common)),
                    ],
                    names=["doc_id", "n", "h1", "h2", "sketch", "rare", "common"],
                )

    return run


def _members(k: int):
    """(w) of the distinct shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch.column(0))
            for a, b in slices(offsets):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(data, offsets[a : b + 1], k)[0].view(np.int64))], names=["w"])

    return run


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, size) of the runs of equal values."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return first, np.diff(np.append(first, len(key)))


def _cells(most: int):
    """Of (w, rep) sorted by both: (sig, whole, reps), a row for each region of
    two sets or more. Regions of the same sets get the same sig. A region of
    more than `most` rows comes in pieces, whole is False."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, whole in key_runs(batches, most):
            w, rep = t.column(0).to_numpy(), t.column(1).to_numpy()
            new = np.append(True, (w[1:] != w[:-1]) | (rep[1:] != rep[:-1]))
            w, rep = w[new], rep[new]
            first, size = _runs(w)
            sig = mix(np.add.reduceat(mix(rep.view(np.uint64), 7), first), 8) if whole else mix(w[first].view(np.uint64), 9)
            many = size > 1 if whole else size > 0
            kept = np.repeat(many, size)
            yield pa.RecordBatch.from_arrays([pa.array(sig[many].view(np.int64)), pa.array(np.full(int(many.sum()), whole)), _lists(rep[kept], size[many])], names=["sig", "whole", "reps"])

    return run


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (sig, whole, reps) sorted by sig: the members of each cell, (sig, rep, whole)."""
    last = None
    for b in batches:
        sig, whole = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
        if not len(sig):
            continue
        new = np.append(last is None or sig[0] != last, sig[1:] != sig[:-1])
        last = sig[-1]
        kept = b.filter(pa.array(new | ~whole))
        size = pa.compute.list_value_length(kept.column(2)).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(kept.column(0).to_numpy(), size)), kept.column(2).flatten(), pa.array(np.repeat(kept.column(1).to_numpy(zero_copy_only=False), size))], names=["sig", "rep", "whole"])


# a cell: sketches as rows of 64-bit words


def _hamming(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Distances of the rows of x from those of s, a few rows at a time."""
    out = np.empty((len(x), len(s)), np.int32)
    step = max(1, (1 << 20) // max(1, s.size))
    for a in range(0, len(x), step):
        out[a : a + step] = np.bitwise_count(x[a : a + step, None, :] ^ s[None, :, :]).sum(2, dtype=np.int32)
    return out


def voronoi_pairs(s: np.ndarray, n: np.ndarray, comp: np.ndarray, core: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, int]:
    """(i, j, distances computed): the pairs of members of one cell that have
    different components and may link by sizes and sketches, one of core at
    least. A pair may come twice, as (i, j) and (j, i)."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    far, work = reach(n, least), 0
    todo = [(np.flatnonzero(core), np.arange(len(s)))]  # (members at home in a region, all members of it)
    while todo:
        home, all_of = todo.pop()
        if not len(home) or len(all_of) < 2 or (comp[all_of] == comp[all_of[0]]).all():
            continue
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        if len(all_of) > LEAF:
            k = math.isqrt(len(all_of))
            # pivots, each the farthest from those before it
            d = [_hamming(s[home[:1]], s[all_of])[0]]
            near = d[0].copy()
            while len(d) < k and near.max() > 0:
                d.append(_hamming(s[all_of[[near.argmax()]]], s[all_of])[0])
                near = np.minimum(near, d[-1])
            work += len(d) * len(all_of)
            d = np.stack(d)
            place = d.argmin(0)
            at_home = np.isin(all_of, home)
            window = d - near[None, :] <= 2 * far[all_of][None, :]
            parts = [(all_of[at_home & (place == p)], all_of[window[p] | (place == p)]) for p in range(len(d))]
        if parts and sum(len(h) * len(a) for h, a in parts) <= 0.75 * len(home) * len(all_of):
            todo += parts
            continue
        work += len(home) * len(all_of)
        step = max(1, (1 << 20) // len(all_of))
        for a in range(0, len(home), step):
            x = home[a : a + step]
            both = n[x][:, None] + n[all_of][None, :]
            near_by = _hamming(s[x], s[all_of]) <= both * (100 - least) // (100 + least)
            near_by &= (comp[x][:, None] != comp[all_of][None, :]) & (100 * np.minimum(n[x][:, None], n[all_of][None, :]) >= least * np.maximum(n[x][:, None], n[all_of][None, :]))
            i, j = np.nonzero(near_by)
            found.append((x[i], all_of[j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), work
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), work


def candidates(sketch: list[bytes], n: np.ndarray, comp: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of a cell that may link and are in different components.
    Sets that link differ in size by a third at most, so their sketches have the same number of bits or twice as many."""
    size = np.array([len(x) for x in sketch])
    pairs = []
    for bits in np.unique(size):
        core = np.flatnonzero(size == bits)
        more = np.flatnonzero((size == 2 * bits) & (100 * n[core].max() >= least * n))
        if len(core) + len(more) < 2:
            continue
        s = np.frombuffer(b"".join([sketch[i] for i in core]), np.uint64).reshape(len(core), -1)
        if len(more):  # the class of a hash is its low bits: half as many classes are the two halves together
            wide = np.frombuffer(b"".join([sketch[i] for i in more]), np.uint64).reshape(len(more), -1)
            s = np.vstack([s, wide[:, : s.shape[1]] ^ wide[:, s.shape[1] :]])
        at = np.concatenate([core, more])
        i, j, _ = voronoi_pairs(s, n[at], comp[at], np.arange(len(at)) < len(core), least)
        pairs.append(np.stack([np.minimum(at[i], at[j]), np.maximum(at[i], at[j])], 1))
    if not pairs or not any(map(len, pairs)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = np.concatenate(pairs)
    p = np.unique(p[:, 0] * len(n) + p[:, 1])
    return p // len(n), p % len(n)


def stars(i: np.ndarray, j: np.ndarray, m: int, cover: int) -> np.ndarray:
    """Which pairs to compare now. Members are taken in order; one that has fewer
    than `cover` pairs so far becomes a centre: it gets its pairs with members
    that have fewer, and others until it has `cover` itself. So a member is in
    about `cover` pairs, and in all once `cover` is the number of its partners."""
    chosen = np.zeros(len(i), bool)
    if len(i) == 1:
        chosen[:] = True
        return chosen
    ends, other, which = np.concatenate([i, j]), np.concatenate([j, i]), np.tile(np.arange(len(i)), 2)
    order = np.lexsort((other, ends))
    ends, other, which = ends[order], other[order], which[order]
    first, size = _runs(ends)
    pairs_of = np.zeros(m, np.int64)
    for v, a, c in zip(ends[first], first, size, strict=True):
        if pairs_of[v] >= cover:
            continue
        u, w = other[a : a + c], which[a : a + c]
        free = ~chosen[w]
        take = free & (pairs_of[u] < cover)
        if (short := cover - pairs_of[v] - take.sum()) > 0:
            take[np.flatnonzero(free & ~take)[:short]] = True
        chosen[w[take]] = True
        pairs_of[u[take]] += 1
        pairs_of[v] += take.sum()
    return chosen


def _join_cells(least: int, cover: int):
    """Of (sig, rep, n, comp, sketch) sorted by sig, cells of bounded size:
    (sig, a, b) with the pairs a < b to compare (sig null), and the members
    whose pairs wait for the next round (b null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["sig", "a", "b"])
            for c in out:
                c.clear()
            return batch

        for t, _ in key_runs(batches):
            sig, rep, n, comp = (t.column(c).to_numpy() for c in range(4))
            sketch = t.column(4).to_pylist()
            for a, size in zip(*_runs(sig), strict=True):
                if size < 2:
                    continue
                part = slice(a, a + size)
                r = rep[part]
                i, j = candidates(sketch[part], n[part].astype(np.int64), comp[part], least)
                if not len(i):
                    continue
                chosen = stars(i, j, size, cover)
                x, y = r[i[chosen]], r[j[chosen]]
                out[0] += [None] * len(x)
                out[1] += np.minimum(x, y).tolist()
                out[2] += np.maximum(x, y).tolist()
                left = ~chosen
                if left.any():
                    wait = np.unique(r[np.unique(np.concatenate([i[left], j[left]]))])
                    out[0] += [int(sig[a])] * len(wait)
                    out[1] += wait.tolist()
                    out[2] += [None] * len(wait)
                if len(out[0]) > 10_000:
                    yield flush()
        if out[0]:
            yield flush()

    return run


def _within_reach(least: int):
    """(a, b) of the rows (a, n_a, s_a, b, n_b, s_b) that sizes and sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            a, na, sa, b, nb, sb = (t.column(c).to_pylist() for c in range(6))
            keep = [x != y and len(candidates([s, u], np.array([p, q]), np.array([0, 1]), least)[0]) > 0 for x, p, s, y, q, u in zip(a, na, sa, b, nb, sb, strict=True)]
            pairs = [(min(x, y), max(x, y)) for x, y, k in zip(a, b, keep, strict=True) if k]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    return run


# exact comparison by words

_ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text: str | None, k: int = WORDS) -> set[tuple[bytes, ...]]:
    """The set of a text itself: tuples of k words, or of all if there are fewer."""
    words = (text or "").encode().translate(_ASCII_LOWER).split()
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)} if words else set()


def _compare(k: int, least: int):
    """Of (a, part, side, b, text), for each (a, part) first the text of a (side 0), then its partners: the pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre = None, []
        for t in batches:
            links = []
            for a, part, side, b, text in zip(*(t.column(c).to_pylist() for c in range(5)), strict=True):
                if at != (a, part):
                    at, centre = (a, part), []
                s = shingles(text, k)
                if side == 0:
                    centre.append(s)
                    continue
                for c in centre:
                    both = len(c & s)
                    if 100 * both >= least * (len(c) + len(s) - both) and both:
                        links.append((a, b))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return run


def _linked(pairs: DataFrame, texts: DataFrame, k: int, least: int) -> DataFrame:
    """The pairs (a, b) whose texts link, compared word by word. A text goes to
    the tasks of its partners; the partners of one document are dealt to parts of about STAR."""
    heavy = stored(pairs.groupBy(F.col("a").alias("h")).agg(F.ceil(F.count("*") / STAR).alias("parts")).where("parts > 1"), "stars")
    dealt = pairs.join(small(heavy, heavy.count()), F.expr("a = h"), "left").select("a", F.expr("if(parts is null, 0L, pmod(xxhash64(b), parts))").alias("part"), "b")
    dealt = stored(dealt, "partners")
    centres = dealt.select("a", "part").distinct().select("a", "part", F.lit(0).alias("side"), F.col("a").alias("b"))
    roles = stored(centres.unionByName(dealt.select("a", "part", F.lit(1).alias("side"), "b")), "roles")
    sent = texts.join(small(roles, roles.count(), BROADCAST_IDS), F.expr("doc_id = b")).select("a", "part", "side", "b", "text")
    out = stored(sent.repartition("a", "part").sortWithinPartitions("a", "part", "side").mapInArrow(_compare(k, least), "a long, b long"), "links")
    for t in (heavy, dealt, roles):
        drop_stored(t)
    release(texts.sparkSession)
    return out


def _components(comps: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """comps (node, component) with the links joined to it. Only edges between components are worked on."""
    if comps is None:
        return stored(connected_components(links), "components") if links.head(1) else None
    of = lambda c: comps.select(F.col("node").alias(f"n_{c}"), F.col("component").alias(f"c_{c}"))
    edges = links.join(of("a"), F.expr("a = n_a"), "left").join(of("b"), F.expr("b = n_b"), "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, "contracted")
    if not edges.head(1):
        return comps
    merged = stored(connected_components(edges), "merged")
    to = merged.select(F.col("node").alias("m"), F.col("component").alias("to"))
    old = comps.join(to, F.expr("component = m"), "left").select("node", F.coalesce("to", "component").alias("component"))
    new = merged.join(comps.select(F.col("node").alias("known")), F.expr("node = known"), "left_anti")
    out = stored(old.union(new), "components")
    for t in (edges, merged, comps):
        drop_stored(t)
    return out


def _large_stars(large: DataFrame, slim: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members that wait) of a first round over cells that no single task
    joins: STARS members of each cell against all of it, by their sketches."""
    spark = large.sparkSession
    centre = large.groupBy(F.col("sig").alias("p_sig"), F.pmod(F.xxhash64("rep"), F.lit(STARS)).alias("bucket")).agg(F.min("rep").alias("p"))
    centre = stored(centre.join(slim.select(F.col("rep").alias("p_rep"), F.col("n").alias("p_n"), F.col("sketch").alias("p_s")), F.expr("p = p_rep")).select("p_sig", "p", "p_n", "p_s"), "centres")
    some = small(centre, centre.count(), 2000)
    marked = large.join(slim.select(F.col("rep").alias("s_rep"), "n", "sketch"), F.expr("rep = s_rep")).select("sig", "rep", "n", "sketch")
    pairs = stored(marked.join(some, F.expr("sig = p_sig")).select("p", "p_n", "p_s", "rep", "n", "sketch").mapInArrow(_within_reach(least), "a long, b long"), "pairs")
    waits = large.join(some.select("p_sig", "p"), F.expr("sig = p_sig and rep = p"), "left_anti").select("sig", F.col("rep").alias("a"))
    release(spark)
    return pairs, stored(waits, "waiting")


def _blocks(large: DataFrame) -> DataFrame:
    """(sig, rep, comp) of cells too large for a task, as cells of two blocks of
    half a cell each: the members of the largest component in blocks, the others
    in blocks, and every pair of blocks that is not of the largest component alone."""
    half = CELL // 2
    by = stored(large.groupBy(F.col("sig").alias("b_sig"), F.col("comp").alias("b_comp")).count(), "sizes")
    top = by.groupBy("b_sig").agg(F.max(F.struct("count", "b_comp")).alias("t"), F.sum("count").alias("all"))
    top = top.select(F.col("b_sig").alias("t_sig"), F.col("t.b_comp").alias("t_comp"), F.expr(f"cast(ceil(t.count / {half}) as long)").alias("majors"), F.expr(f"cast(ceil((all - t.count) / {half}) as long)").alias("minors"))
    top = stored(top, "blocks")
    m = large.join(small(top, top.count()), F.expr("sig = t_sig"))
    m = m.withColumn("major", F.expr("comp = t_comp")).withColumn("block", F.expr("pmod(xxhash64(rep, 2), greatest(if(comp = t_comp, majors, minors), 1L))"))
    cells = F.expr("""if(major, transform(sequence(0L, minors - 1), i -> xxhash64(sig, 'x', i, block)),
      concat(transform(sequence(0L, majors - 1), i -> xxhash64(sig, 'x', block, i)), transform(sequence(0L, minors - 1), i -> xxhash64(sig, 'y', least(i, block), greatest(i, block)))))""")
    return m.select(F.explode(cells).alias("sig"), "rep", "comp")


def keep_one(docs: DataFrame, k: int = WORDS, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose id is the smallest of its
    component. Of rows that share an id the one with the least text stays (ties
    in text by a hash of all columns), whichever task runs first. Rows with a
    null id stay. Columns of any name pass through; an empty table stays empty."""
    found = jaccard_components(docs, k, least, doc_id, text)
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("g")).distinct(), "removed")
    cols = docs.columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("d"), F.col(f"`{doc_id}`").cast("long").alias("i"), F.col(f"`{text}`").alias("t"))
    out = d.join(small(gone, gone.count(), BROADCAST_IDS), F.expr("i = g"), "left_anti")
    again = stored(docs.groupBy(F.col(f"`{doc_id}`").cast("long").alias("r")).count().where("count > 1 and r is not null").select("r"), "repeated_ids")
    n = again.count()
    if n:  # rows whose ids repeat are taken apart, so that only their texts are shuffled
        single = out.join(small(again, n, BROADCAST_IDS), F.expr("i = r"), "left_anti").select("d")
        out = single.union(out.join(small(again, n, BROADCAST_IDS), F.expr("i = r"), "left_semi").groupBy("i").agg(F.min_by("d", F.struct("t", F.xxhash64("d"))).alias("d")).select("d"))
    return out.select(*[F.col(f"d.`{c}`").alias(c) for c in cols])


def jaccard_components(docs: DataFrame, k: int = WORDS, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs. Words are runs
    other than space and 0x09 to 0x0D, with A to Z in lower case. Two documents
    link when 100 * intersection >= least * union of their shingle sets;
    component_id is the smallest doc_id that links reach. A null text, or one
    without words, has an empty set, links with nothing and is a component of
    its own; a text of fewer than k words has one shingle. A row with a null id
    has a null component and takes no part. Equal rows give equal results; rows
    that share an id but not the text link with whatever any of them links with.
    Other columns are not read. An empty table gives an empty one."""
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    count = d.where("doc_id is not null").count()
    share = min(1.0, SAMPLE_DOCS / max(1, count))
    sample = d.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30))).select("text")
    seen = sample.mapInArrow(_members(k), "w long").groupBy("w").count().where(F.col("count") >= FREQUENT).collect()  # at most the shingles of the sample
    seen = sorted((r["w"] & 0xFFFFFFFFFFFFFFFF, r["count"]) for r in seen)
    frequent, often = np.array([x[0] for x in seen], np.uint64), np.array([x[1] for x in seen], np.int64)
    described = stored(d.mapInArrow(_describe(frequent, often, k, least), "doc_id long, n int, h1 long, h2 long, sketch binary, rare array<long>, common array<long>"), "shingles")

    # equal sets are one member, which goes by its smallest doc_id
    with_id = described.where("doc_id is not null and n > 0")
    classes = with_id.groupBy(F.col("n").alias("c_n"), F.col("h1").alias("c1"), F.col("h2").alias("c2")).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
    classes = stored(classes, "classes")
    n_classes = classes.count()
    same = F.expr("n = c_n and h1 = c1 and h2 = c2")
    copies = stored(with_id.select("doc_id", "n", "h1", "h2").join(small(classes, n_classes), same).where("doc_id <> rep").select(F.col("doc_id").alias("copy")).distinct(), "copies")
    members = with_id.join(small(copies, copies.count(), BROADCAST_IDS), F.expr("doc_id = copy"), "left_anti")

    # outer regions; frequent shingles with too many members for one task do not pass through one
    common = members.select(F.explode("common").alias("w"), F.col("doc_id").alias("rep")).distinct()
    hot = stored(common.groupBy(F.col("w").alias("hot")).count().where(F.col("count") > CELL).select("hot"), "hot")
    n_hot = hot.count()
    rare = members.select(F.explode("rare").alias("w"), F.col("doc_id").alias("rep"))
    if n_hot:
        rare = rare.union(common.join(small(hot, n_hot), F.expr("w = hot"), "left_anti"))
    else:
        rare = rare.union(common)
    region = stored(by_key(rare, "w", "rep").mapInArrow(_cells(CELL), "sig long, whole boolean, reps array<long>"), "regions")
    slim = stored(described.select("doc_id", "n", "h1", "h2", "sketch"), "sets")
    cell = stored(by_key(region, "sig").mapInArrow(_distinct, "sig long, rep long, whole boolean"), "cells")
    large = cell.where("not whole").select("sig", "rep")
    if n_hot:
        large = large.union(common.join(small(hot, n_hot), F.expr("w = hot")).select(F.xxhash64("w").alias("sig"), "rep"))
    large = stored(large.distinct(), "large")
    for t in (region, described, hot, copies):
        drop_stored(t)
    release(spark)

    texts = d.where("doc_id is not null and text is not null")
    marks = slim.where("doc_id is not null and n > 0").select(F.col("doc_id").alias("rep"), "n", "sketch").dropDuplicates(["rep"])
    comps: DataFrame | None = None  # (node, component) of sets that are linked so far
    now = cell.where("whole").select("sig", "rep", F.col("rep").alias("comp"))
    pairs, wide = None, None
    if large.head(1):
        pairs, wide = _large_stars(large, marks, least)
    cover = 1
    while True:
        marked = now.join(marks.select(F.col("rep").alias("m_rep"), "n", "sketch"), F.expr("rep = m_rep")).select("sig", "rep", "n", "comp", "sketch")
        found = stored(by_key(marked, "sig").mapInArrow(_join_cells(least, cover), "sig long, a long, b long"), "candidates")
        release(spark)
        chosen = found.where("b is not null").select("a", "b")
        chosen = stored((chosen if pairs is None else chosen.union(pairs)).distinct(), "pairs")
        if chosen.head(1):
            comps = _components(comps, _linked(chosen, texts, k, least))
        waits = found.where("b is null").select("sig", "a")
        of = None if comps is None else comps.select(F.col("node").alias("c_node"), "component")
        n_comps = 0 if of is None else of.count()
        place = lambda rows: rows.select("sig", F.col("a").alias("rep"), F.col("a").alias("comp")) if of is None else rows.join(small(of, n_comps), F.expr("a = c_node"), "left").select("sig", F.col("a").alias("rep"), F.coalesce("component", "a").alias("comp"))
        still = lambda rows: rows.join(rows.groupBy(F.col("sig").alias("o_sig")).agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("o_sig"), F.expr("sig = o_sig"), "left_semi")
        now = still(stored(place(waits), "placed"))
        if wide is not None:
            now = now.union(_blocks(stored(still(stored(place(wide), "placed")), "open")))
            wide = None
        now, pairs = stored(now, "open"), None
        drop_stored(found)
        drop_stored(chosen)
        release(spark)
        if not now.head(1):
            break
        cover *= 4

    out = slim.select("doc_id", "n", "h1", "h2").join(small(classes, n_classes), same, "left")
    node = "if(n > 0, coalesce(rep, doc_id), null)"
    out = out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.expr(node).alias("node"))
    if comps is not None:
        n_comps = comps.count()
        out = out.join(small(comps.select(F.col("node").alias("l_node"), "component"), n_comps, BROADCAST_IDS), F.expr("node = l_node"), "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("long"))
    return out.select("doc_id", "n_shingles", F.expr("if(doc_id is null, null, coalesce(component, node, doc_id))").alias("component_id"))
