"""Substring dedup by level-wise doubling over word windows.

A window can only repeat if the windows of half its length inside it repeat.
The levels for windows of 13 words are 7, 13, 26, 52 and so on until no
candidate survives, or up to `longest`. At a level, candidates of equal hash meet; those
that two documents have survive, and only stretches of survivors long enough to
hold a window of the next length are extended to it.

Level one reads all texts. It sends not every half-length window but, of those
inside each full window, the one with the smallest hash, which equal full
windows share: about a quarter of them. Windows of the next level come from the
texts of documents with survivors and are compared by 128 bits, in runs of equal
keys. The rows of a key that is frequent (seen in several documents of a bounded
sample) are dealt to several runs; each finds the smallest document of every
window, and a second step compares those.

A survivor is named by a place of it in its smallest document, so a stretch of
windows that runs along a stretch of that document is one row, whatever its
length, and further levels need neither texts nor hashes: a window of twice the
length is known by the names of its halves. Stretches of such pairs are cut at
every MANYth place and met with those of other documents; the smallest document
that has a pair names it. What a level sends grows with the number of
stretches, not of windows, and a pair that any number of documents have comes
to few different rows, which are aggregated before they are sent."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, by_key, drop_stored, key_runs, release, small, small_batches, stored
from .hashing import mix, slices, text_column, windows, word_hashes

WINDOW = 13
#: Documents sampled to find frequent windows, and sampled documents that make one frequent.
SAMPLE_DOCS, FREQUENT = 4096, 3
#: Neighbouring windows that are compared together at levels beyond the first two.
MANY = 128
#: The same where names that several runs gave are made one.
NEAR = 8
#: Keys that the rows of a frequent window are dealt to.
SALTS = 16
#: Rows of a key that a task holds; of longer runs it holds the distinct windows only.
RUN = 50_000


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each n neighbours."""
    out, have, size = h, 1, 1
    while have < n:
        step = min(size, n - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
        size = have
    return out


def _each(batch: pa.RecordBatch, column: int, window: int):
    """For slices of a batch: (first row, last row, both lanes, row of each word, first words of the windows inside one row, their keys)."""
    data, offsets = text_column(batch.column(column))
    half = (window + 1) // 2
    for a, b in slices(offsets):
        h, row, _, _ = word_hashes(data, offsets[a : b + 1])
        if len(row) < window:
            continue
        at = np.flatnonzero(row[: len(row) - window + 1] == row[window - 1 :])
        yield a, b, h, row, at, _least(windows(h[0], half), window - half + 1)[at]


def _level_one(window: int, frequent: np.ndarray):
    """(key, doc_id, often): the keys of each document; neighbours that share a
    key give one row, all frequent keys together one, under a key made of the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, _, _, row, at, key in _each(batch, 1, window):
                r = row[at]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (r[1:] != r[:-1])
                key, r = key[new], r[new]
                often = np.isin(key, frequent) if len(frequent) else np.zeros(len(key), bool)
                with_often = np.unique(r[often])
                key, r = key[~often], r[~often]
                mark = mix(ids[with_often + a].astype(np.int64).view(np.uint64), 21)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([key, mark]).view(np.int64)), pa.array(ids[np.concatenate([r, with_often]) + a]), pa.array(np.arange(len(r) + len(with_often)) >= len(r))],
                    names=["key", "doc_id", "often"],
                )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, doc_id, often) sorted by key: the rows of keys that two documents
    have, and those of frequent keys; neighbours that are equal give one. (Spark
    sorts by one column much faster than by two.)"""
    held: tuple | None = None  # the last row, and whether its key has had another document
    for b in batches:
        key, doc, often = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
        if held is not None:
            key, doc, often = np.append(held[0], key), np.append(held[1], doc), np.append(held[2], often)
        if not len(key):
            continue
        new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (often[1:] != often[:-1]))
        key, doc, often = key[new], doc[new], often[new]
        same = key[1:] == key[:-1]
        before, after = np.append(held is not None and held[3], same), np.append(same, False)
        keep = before | after | often
        keep[-1] = False  # its fellows may be in the next batch
        held = key[-1:], doc[-1:], often[-1:], bool(before[-1])
        yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep]), pa.array(often[keep])], names=["key", "doc_id", "often"])
    if held is not None and (held[3] or held[2][0]):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[:3]], names=["key", "doc_id", "often"])


def _packed(x: np.ndarray, y: np.ndarray, first: np.ndarray) -> pa.Array:
    """Both lanes of windows side by side, a binary value for each stretch that begins at first."""
    both = np.ascontiguousarray(np.stack([x, y], 1))
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((np.append(first, len(x)) * 16).astype(np.int32)), pa.py_buffer(both)])


def _unpacked(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lane 0, lane 1, number of windows of each row)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    both = data[off[0] : off[-1]].copy().view(np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1], np.diff(off) // 16


def _dealt(key: np.ndarray, doc: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The keys, those of rows that are often under SALTS keys by document."""
    return np.where(often, mix(key + mix(mix(doc.astype(np.int64).view(np.uint64), 6) % np.uint64(SALTS), 5)), key)


def _extend(window: int, frequent: np.ndarray):
    """Windows under repeated keys, (key, doc_id, at, packed, often): a row for
    each stretch of windows of a document that share a key. Rows of a frequent
    key are dealt to SALTS keys by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(2)
            for a, b, h, row, at, key in _each(batch, 1, window):
                part = lists.slice(a, b - a)
                wanted = part.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(b - a), pa.compute.fill_null(pa.compute.list_value_length(part), 0).to_numpy())
                r = row[at]
                # membership in the list of the window's own document
                known = np.unique(mix(wanted) + mix(owner.astype(np.uint64), 3, 1))
                keep = np.isin(mix(key) + mix(r.astype(np.uint64), 3, 1), known)
                often = np.isin(key, frequent) if len(frequent) else np.zeros(len(key), bool)
                keep |= often
                if not keep.any():
                    continue
                base = np.searchsorted(row, np.arange(b - a))  # the first word of each row
                k, r, at, often = key[keep], r[keep], at[keep], often[keep]
                x, y, p = windows(h[0], window)[at], windows(h[1], window, 1)[at], at - base[r]
                first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1]) | (p[1:] != p[:-1] + 1)))
                k, doc, often = k[first], ids[r[first] + a], often[first]
                k = _dealt(k, doc, often)
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(doc), pa.array(p[first].astype(np.int32)), _packed(x, y, first), pa.array(often)], names=["key", "doc_id", "at", "packed", "often"])

    return run


SPANS = "doc_id long, first int, last int, of long, at int"
OUT = f"{SPANS}, kind int, packed binary"
#: Kinds of OUT rows: named for good; named within one of several runs of a key; the same of a window that gives
#: such a name, with its hashes; of one that another document of the run has too.
CLOSED, LOCAL, ALONE, SHARED = range(4)


def _found(doc: np.ndarray, pos: np.ndarray, of: np.ndarray, at: np.ndarray, kind: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """OUT rows: stretches of windows, put in order by document, kind and
    position, whose names (of, at) are neighbours as they are."""
    place = pos + (kind.astype(np.int64) << 32)
    near = not len(doc) or int(doc.max()) - int(doc.min()) < 1 << 29  # then one number has it all, and one key sorts much faster
    order = np.argsort((doc - doc.min() << 34) + place) if near and len(doc) else np.lexsort((place, doc))
    doc, pos, of, at, kind = (v[order] for v in (doc, pos, of, at, kind))
    new = np.append(True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1) | (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1) | (kind[1:] != kind[:-1])) if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    gives = kind[first] >= ALONE
    packed = pa.compute.if_else(pa.array(gives), _packed(x[order], y[order], first), pa.nulls(len(first), pa.binary())) if gives.any() else pa.nulls(len(first), pa.binary())
    ints = (v.astype(np.int32) for v in (pos[first], pos[last], at[first], kind[first]))
    low, high, place, kind = map(pa.array, ints)
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), low, high, pa.array(of[first]), place, kind, packed], names=["doc_id", "first", "last", "of", "at", "kind", "packed"])


def _groups(k: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (k, x, y) are neighbours, and where a group of them begins."""
    one = mix(x + mix(k.view(np.uint64)))
    order = np.argsort(one)  # one key sorts much faster than three
    for again in (False, True):
        if again:
            order = np.lexsort((y, x, k))
        oo, ko, xo, yo = one[order], k[order], x[order], y[order]
        group = np.append(True, (ko[1:] != ko[:-1]) | (xo[1:] != xo[:-1]) | (yo[1:] != yo[:-1])) if len(k) else np.zeros(0, bool)
        if not (group[1:] & (oo[1:] == oo[:-1])).any():  # else the one key is not enough
            break
    return order, group


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stretches (key, doc_id, at, packed, often) sorted by key and doc_id:
    OUT rows of windows that two documents of a run have, under the name of a
    place in the smallest one; all windows of a key whose rows are dealt to several runs."""
    long_key, least = None, {}  # of a key whose rows are too many to hold: window -> [smallest document, at, whether another has it]
    for t, whole in key_runs(batches, RUN):
        key, doc, at, often = (t.column(i).to_numpy() for i in (0, 1, 2, 4))
        x, y, n = _unpacked(t.column(3))
        which = np.repeat(np.arange(len(key)), n)
        pos = at[which] + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        d, dealt = doc[which], often[which].astype(bool)
        if whole:
            order, group = _groups(key[which], x, y)
            if not len(order):
                continue
            d, pos, x, y, dealt = (v[order] for v in (d, pos, x, y, dealt))
            first, nth = np.flatnonzero(group), np.cumsum(group) - 1
            smallest = np.minimum.reduceat(d, first)
            many = (np.maximum.reduceat(d, first) > smallest)[nth]
            of = smallest[nth]
            own = np.flatnonzero(d == of)
            rep = own[np.append(True, nth[own][1:] != nth[own][:-1])]  # a window of each group, in its smallest document
            gives = np.zeros(len(d), bool)
            gives[rep] = True
            kind = np.where(dealt, np.where(gives, ALONE + many, LOCAL), CLOSED)
            keep = dealt | many
            yield _found(*(v[keep] for v in (d, pos, of, pos[rep][nth], kind, x, y)))
            continue
        if long_key != key[0]:
            long_key, least = key[0], {}
        rows = []
        for dd, pp, xx, yy, hot in zip(d.tolist(), pos.tolist(), x.tolist(), y.tolist(), dealt.tolist(), strict=True):
            seen = least.get((xx, yy))
            if seen is None:
                least[xx, yy] = [dd, pp, False]
                if hot:
                    rows.append((dd, pp, dd, pp, ALONE, xx, yy))
                continue
            rows.append((dd, pp, *seen[:2], LOCAL if hot else CLOSED, xx, yy))  # of the same document, whether others have it or not: a candidate more
            if dd != seen[0] and not seen[2]:
                rows.append((*seen[:2], *seen[:2], SHARED if hot else CLOSED, xx, yy))
                seen[2] = True
        c = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64)
        yield _found(*(np.array(v, kind) for v, kind in zip(c, kinds, strict=True)))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of a stretch (doc_id, first, packed, many)."""
    for b in batches:
        x, y, n = _unpacked(b.column(2))
        which = np.repeat(np.arange(len(n)), n)
        pos = b.column(1).to_numpy()[which] + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        many = b.column(3).to_numpy(zero_copy_only=False)[which]
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.array(b.column(0).to_numpy()[which]), pa.array(pos.astype(np.int32)), pa.array(many)], names=["x", "y", "doc_id", "at", "many"])


def _renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SPANS rows of stretches (doc_id, first, last, at, names) by the names (run_at, of, at) of their places."""
    for b in batches:
        doc, first, last, at = (b.column(i).to_numpy().astype(np.int64) for i in range(4))
        names = b.column(4)
        flat = names.flatten()
        run_at, of, new = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
        which = np.repeat(np.arange(len(doc)), pa.compute.list_value_length(names).to_numpy())
        pos = first[which] + run_at - at[which]
        keep = (pos >= first[which]) & (pos <= last[which])
        none = np.zeros(int(keep.sum()), np.uint64)
        out = _found(doc[which][keep], pos[keep], of[keep], new[keep], none.view(np.int64), none, none)
        yield out.select(["doc_id", "first", "last", "of", "at"])


def _double(length: int, many: int):
    """Of survivors of one length, SPANS rows sorted by doc_id: windows of twice
    the length whose halves both survived, PIECES rows. lo to hi are the places
    that name the first halves, in document a; delta on from them in document b
    are those of the second halves; shift on from them is where the windows
    begin. No row goes over a multiple of `many`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in key_runs(batches):
            doc, first, last, of, at = (t.column(i).to_numpy().astype(np.int64) for i in range(5))
            order = np.lexsort((first, doc))
            doc, first, last, of, at = (v[order] for v in (doc, first, last, of, at))
            # all documents on one line, so far apart that no window goes over to the next one
            base = np.cumsum(np.append(False, doc[1:] != doc[:-1])) * (int(last.max()) + 2 * length + 2)
            s, e = base + first, base + last
            diagonal = at - s
            s[1:] = np.maximum(s[1:], np.maximum.accumulate(e)[:-1] + 1)  # a place has one name
            keep = s <= e
            doc, base, s, e, of, diagonal = (v[keep] for v in (doc, base, s, e, of, diagonal))
            new = np.append(True, (s[1:] != e[:-1] + 1) | (of[1:] != of[:-1]) | (diagonal[1:] != diagonal[:-1]) | (base[1:] != base[:-1]))
            begin = np.flatnonzero(new)
            e = e[np.append(begin[1:], len(new)) - 1]
            doc, base, s, of, diagonal = (v[begin] for v in (doc, base, s, of, diagonal))
            # between neighbouring borders of either half both halves are in one stretch each, or in none
            border = np.unique(np.concatenate([s, e + 1, s - length, e + 1 - length]))
            p, q = border[:-1], border[1:] - 1
            i, j = (np.searchsorted(s, v, "right") - 1 for v in (p, p + length))
            both = np.flatnonzero((i >= 0) & (p <= e[i]) & (p + length <= e[j]))
            p, q, i, j = p[both], q[both], i[both], j[both]
            lo, hi = p + diagonal[i], q + diagonal[i]
            pieces = hi // many - lo // many + 1
            k = np.repeat(np.arange(len(p)), pieces)
            block = (lo // many)[k] + np.arange(len(k)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            i, j = i[k], j[k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (of[i], of[j], length + diagonal[j] - diagonal[i], np.maximum(lo[k], block * many), np.minimum(hi[k], block * many + many - 1), doc[i], -diagonal[i] - base[i])],
                names=["a", "b", "delta", "lo", "hi", "doc_id", "shift"],
            )

    return run


def _smallest(many: int):
    """Of (key, a, b, delta, lo, hi, doc_id, shift, most) sorted by key, no two with equal a to hi:
    the parts of each lo to hi that two documents have, and their names, NAMED rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in key_runs(batches):
            a, b, delta, lo, hi, doc, shift, most = (t.column(i).to_numpy() for i in range(1, 9))
            order = np.lexsort((lo // many, delta, b, a))
            a, b, delta, lo, hi, doc, shift, most = (v[order] for v in (a, b, delta, lo, hi, doc, shift, most))
            block = lo // many
            group = np.cumsum(np.append(False, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (delta[1:] != delta[:-1]) | (block[1:] != block[:-1])))
            order = np.lexsort((shift, doc))
            new = np.append(True, (doc[order][1:] != doc[order][:-1]) | (shift[order][1:] != shift[order][:-1]))
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.cumsum(new) - 1
            name = order[new]  # a row with each rank
            n = hi - lo + 1
            which = np.repeat(np.arange(len(lo)), n)
            at = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            cell = group[which] * many + at - block[which] * many
            least, largest = np.full((int(group[-1]) + 1) * many, len(doc)), np.full((int(group[-1]) + 1) * many, np.iinfo(np.int64).min)
            np.minimum.at(least, cell, rank[which])
            np.maximum.at(largest, cell, most[which])
            by = name[least[cell]]
            keep = largest[cell] > doc[by]
            which, at, by = which[keep], at[keep], by[keep]
            if not len(which):
                continue
            first = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (at[1:] != at[:-1] + 1) | (by[1:] != by[:-1])))
            last = np.append(first[1:], len(which)) - 1
            r, by = which[first], by[first]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a[r], b[r], delta[r], lo[r], hi[r], at[first], at[last], doc[by], at[first] + shift[by])], names=["n_a", "n_b", "n_delta", "n_lo", "n_hi", "low", "high", "of", "at"])

    return run


NONE = np.zeros(0, np.uint64)
KEYS, STRETCHES = "key long, doc_id long, often boolean", "key long, doc_id long, at int, packed binary, often boolean"
PIECES = "a long, b long, delta long, lo long, hi long, doc_id long, shift long"
NAMED = "n_a long, n_b long, n_delta long, n_lo long, n_hi long, low long, high long, of long, at long"


def _frequent(keys: DataFrame) -> np.ndarray:
    """Keys that FREQUENT documents of a sample have: at most its windows."""
    seen = keys.select("key", "doc_id").distinct().groupBy("key").count().where(F.col("count") >= FREQUENT)
    return np.array(sorted(r.key for r in seen.select("key").collect()), np.int64).view(np.uint64)


def _survivors(stretches: DataFrame, dealt: bool) -> DataFrame:
    """SPANS rows of windows that two documents have; dealt: whether keys are dealt to several runs."""
    found = stored(by_key(stretches, "key", "doc_id").mapInArrow(_repeats, OUT), "level", "zstd")
    spans = [f.split()[0] for f in SPANS.split(", ")]
    closed = found.where(f"kind = {CLOSED}").select(*spans)
    release(found.sparkSession)
    if not dealt:
        return closed
    # of a window under a frequent key every run has sent the place that names it there: at most SALTS
    gives = found.where(f"kind >= {ALONE}").select("doc_id", "first", "packed", F.expr(f"kind = {SHARED}").alias("many")).mapInArrow(_unpack, "x long, y long, doc_id long, at int, many boolean")
    gives = gives.groupBy("x", "y").agg(F.collect_set(F.struct("doc_id", "at")).alias("runs"), F.max("many").alias("many")).where("many or array_max(runs).doc_id > array_min(runs).doc_id")
    names = gives.select(F.explode("runs").alias("run"), F.array_min("runs").alias("name")).select(F.col("run.doc_id").alias("run_of"), F.expr(f"run.at div {NEAR}").alias("near"), F.struct(F.col("run.at").alias("run_at"), F.col("name.doc_id").alias("of"), F.col("name.at").alias("at")).alias("name"))
    names = stored(names.groupBy("run_of", "near").agg(F.collect_list("name").alias("names")), "names", "zstd")
    local = found.where(f"kind <> {CLOSED}").select(*spans, F.explode(F.expr(f"sequence(at div {NEAR}, (at + last - first) div {NEAR})")).alias("place"))
    local = local.join(small(names, names.count()), F.expr("of = run_of and place = near")).select("doc_id", "first", "last", "at", "names")
    renamed = stored(local.mapInArrow(_renamed, SPANS), "frequent", "zstd")
    drop_stored(names)
    release(found.sparkSession)
    return closed.union(renamed)


def _doubled(found: DataFrame, length: int) -> DataFrame:
    """SPANS rows of windows of twice the length, of survivors of one length."""
    pieces = stored(by_key(found, "doc_id").mapInArrow(_double(length, MANY), PIECES), "pieces", "zstd")
    key = ["a", "b", "delta", "lo", "hi"]
    distinct = pieces.groupBy(*key).agg(F.min(F.struct("doc_id", "shift")).alias("least"), F.max("doc_id").alias("most"))
    distinct = distinct.select(F.xxhash64("a", "b", "delta", F.expr(f"lo div {MANY}")).alias("key"), *key, "least.doc_id", "least.shift", "most")
    named = by_key(distinct, "key").mapInArrow(_smallest(MANY), NAMED)
    out = pieces.join(named, F.expr(" and ".join(f"{k} = n_{k}" for k in key)))
    out = stored(out.select("doc_id", F.expr("cast(low + shift as int) first"), F.expr("cast(high + shift as int) last"), "of", F.expr("cast(at as int) at")), "level", "zstd")
    drop_stored(pieces)
    return out


def repeated_windows(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", longest: int = 0) -> DataFrame:
    """(doc_id, length, first, last): for every level from `window` on, ranges of
    positions (by first word, inclusive; a range may come in pieces) of windows
    of that length whose words also are a window of a document with a smaller
    id. Levels end when none survives, or at `longest` if it is not 0. Rows with a null id take no part."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, length int, first int, last int"
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).where("doc_id is not null and text is not null")
    n = d.count()
    if not n:
        return spark.createDataFrame([], schema)
    sampled = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) < int(min(1.0, SAMPLE_DOCS / n) * (1 << 30))
    frequent = _frequent(d.where(sampled).mapInArrow(_level_one(window, NONE), KEYS))
    again = by_key(d.mapInArrow(_level_one(window, frequent), KEYS), "key").mapInArrow(_repeated, KEYS)
    lists = stored(again.groupBy(F.col("doc_id").alias("k_id")).agg(F.collect_list(F.expr("if(often, null, key)")).alias("keys")), "lists")
    release(spark)
    n_lists = lists.count()
    some = d.join(F.broadcast(lists.select(F.col("k_id").alias("s_id"))), F.expr("doc_id = s_id"), "left_semi") if n_lists <= BROADCAST_IDS else d
    two = some.join(lists, F.expr("doc_id = k_id")).select("doc_id", "text", "keys")
    found, out, length = _survivors(two.mapInArrow(_extend(window, frequent), STRETCHES), len(frequent) > 0), None, window
    drop_stored(lists)
    while True:
        part = found.where("doc_id > of").select("doc_id", F.lit(length).alias("length"), "first", "last")
        out = part if out is None else out.union(part)
        if longest and 2 * length > longest or not found.head(1):
            return out
        found = _doubled(found, length)
        length *= 2


def _cut(window: int):
    """(doc_id, kept, n_words, n_removed) from (doc_id, text, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n_words, n_removed = [], [], []
            for text, spans in zip(b.column(1), b.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans.as_py() or ():
                    gone[s["first"]] += 1
                    gone[min(s["last"] + window, len(words))] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                out = words if stay.all() else [w for w, k in zip(words, stay, strict=True) if k]
                kept.append(b" ".join(out))
                n_words.append(len(words))
                n_removed.append(len(words) - len(out))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), b.column(3)], names=["doc_id", "kept", "n_words", "n_removed", "longest"])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", longest: int = 0) -> DataFrame:
    """(doc_id, kept, n_words, n_removed, longest) for each row of docs: its
    words, less those covered by a window that also starts in a document with a
    smaller id, joined by a space; and the longest level (0: none) at which it
    repeats words of a document with a smaller id. A null or empty text has no
    words; texts shorter than the window lose nothing; a row with a null id
    loses nothing and counts for no other. Equal rows give equal results. An id
    names one document: rows that share an id but not the text lose what is
    found at the positions of any, and levels beyond the window, of them and of
    texts like them, may join places of several. Texts and words may be of any length; other columns are not read."""
    found = repeated_windows(docs, window, doc_id, text, longest)
    most = found.groupBy(F.col("doc_id").alias("m_id")).agg(F.max("length").alias("longest"))
    found = found.where(F.col("length") == window)  # longer ones are inside
    spans = found.groupBy(F.col("doc_id").alias("s_id")).agg(F.collect_list(F.struct("first", "last")).alias("spans")).join(most, F.expr("s_id = m_id")).drop("m_id")
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ids = found.select(F.col("doc_id").alias("f_id")).distinct()
    n = ids.count()
    none = F.expr("cast(null as array<struct<first int, last int>>)")
    if n <= BROADCAST_IDS:  # only texts that lose something are shuffled
        hit = d.join(F.broadcast(ids), F.expr("doc_id = f_id"), "left_semi").join(spans, F.expr("doc_id = s_id")).select("doc_id", "text", "spans", "longest")
        both = hit.union(d.join(F.broadcast(ids), F.expr("doc_id = f_id"), "left_anti").select("doc_id", "text", none, F.lit(0)))
    else:
        both = d.join(spans, F.expr("doc_id = s_id"), "left").select("doc_id", "text", "spans", F.expr("coalesce(longest, 0)").alias("longest"))
    return both.mapInArrow(_cut(window), "doc_id long, kept string, n_words long, n_removed long, longest int")
