"""WARC archives: writing with revisit records, reading back, and a globally
ordered capture index built by external merging.

Writing goes through Spark's own text writer, so archives can live in any
store that Spark reaches. Reading yields, for each archive, a run of captures
sorted by URL key and timestamp. The runs are cut at common key boundaries; a
piece of a run is sent as one value, so it stays in order, and each key range
is merged from its k pieces by a loser tree."""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, stored

CRLF = "\r\n"
#: Payloads of fewer bytes are always stored in full.
REVISIT_BYTES = 1000
#: Records in one archive file at most, and bytes of payload in one (one record at least), which bound what a reading task holds.
RECORDS_PER_FILE, FILE_BYTES = 2000, 1 << 28
#: Index rows that a merging task is meant to take, and keys sampled to find the boundaries.
ROWS_PER_RANGE, SAMPLED_KEYS = 200_000, 20_000


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("bytes"), F.sha1(F.encode(html, "UTF-8")).alias("digest"),
    )
    same = (
        p.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
        .select(F.col("digest").alias("of_digest"), F.col("bytes").alias("of_bytes"), "rep")
    )
    same = stored(same, "payloads")
    return p.join(small(same, same.count()), F.expr("digest = of_digest and bytes = of_bytes"), "left").withColumn("refers_to", F.expr("if(not rep <=> page_id, rep, null)"))


def write_warc(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES, epoch: int = 1704067200) -> None:
    """One WARC/1.1 record for each row of pages (page_id, url, html) in gzip
    files under path. Of equal payloads of at least min_bytes bytes the one
    with the largest page_id is a response and the others are revisits of it;
    rows that share that page_id are all responses. A null html is an empty
    payload, a null page_id an empty name. A page's capture time is epoch plus
    page_id seconds, in UTC whatever the session's time zone. Line ends in a url
    are percent-encoded. Pages of more than FILE_BYTES / RECORDS_PER_FILE bytes
    go to files of fewer records, so payloads may be of any length that a string
    holds. Other columns are not read; an empty table gives an archive without records."""
    r = _records(pages, min_bytes)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(key + ": "), value, F.lit(CRLF))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    # from whole seconds, as formatting a timestamp would follow the session's time zone
    r = r.withColumn("_s", F.lit(epoch) + F.coalesce(F.col("page_id"), F.lit(0)) % F.lit(3_000_000_000))
    two = lambda n: f"lpad(cast({n} as string), 2, '0')"
    when = F.expr(f"concat(cast(date_add(date'1970-01-01', cast(floor(_s / 86400) as int)) as string), 'T', {two('pmod(_s, 86400) div 3600')}, ':', {two('pmod(_s, 3600) div 60')}, ':', {two('pmod(_s, 60)')}, 'Z')")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    record = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Target-URI", url), line("WARC-Date", when), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("refers_to"))), F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}"))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        line("Content-Length", (F.octet_length(http) + F.octet_length(payload)).cast("string")),
        F.lit(CRLF), http, payload,
    )
    limit = FILE_BYTES // RECORDS_PER_FILE
    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    put = lambda rows, n, mode: rows.select(record.alias("value")).write.mode(mode).option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", n).text(path)
    if largest <= limit:
        put(r, RECORDS_PER_FILE, "error")
    else:
        put(r.where(F.col("bytes") <= limit), RECORDS_PER_FILE, "error")
        put(r.where(F.col("bytes") > limit), max(1, FILE_BYTES // largest), "append")


class _Stream:
    """Bytes of a gzip file, a piece at a time."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at, self.gz, self.buf, self.done = data, 0, zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        self.buf += self.gz.decompress(self.data[self.at : self.at + (1 << 18)])
        self.at += 1 << 18
        return True

    def head(self) -> bytes | None:
        """The next bytes up to an empty line, that included; None at the end."""
        look = 0
        while (end := self.buf.find(b"\r\n\r\n", look)) < 0:
            look = max(0, len(self.buf) - 3)
            if not self._more():
                if self.buf.strip():
                    raise ValueError("WARC: a record without an end of its header")
                return None
        return self.take(end + 4)

    def take(self, n: int) -> bytes:
        while len(self.buf) < n:
            if not self._more():
                raise ValueError("WARC: a record is cut short")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        self.done += n
        return out


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes, int, int]]:
    """(header fields, payload, offset, length) of each record of a gzip WARC file; offsets are in the unpacked file."""
    s = _Stream(data)
    while True:
        at = s.done
        head = s.head()
        if head is None:
            return
        lines = head.decode("utf-8", "surrogateescape").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"WARC: no record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        block = s.take(int(fields["Content-Length"]))
        if s.take(4) != b"\r\n\r\n":
            raise ValueError(f"WARC: wrong length of the record at {at}")
        http, _, payload = block.partition(b"\r\n\r\n")
        fields["http"] = http.decode("ascii", "replace")
        yield fields, payload, at, s.done - at


def url_key(url: str) -> str:
    """Sort key: host labels from the last to the first, then path and query, lower-cased."""
    m = re.match(r"(?s)[^:]*://([^/?#]*)([^#]*)", url)
    if not m:
        return url.lower()
    return ",".join(reversed(m[1].lower().split("."))) + ")" + m[2].lower()


RUN = pa.schema([("file", pa.string()), ("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
RUN_SQL = "file string, urlkey string, ts string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, offset long, length long"


def _page(name: str | None) -> int | None:
    digits = (name or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for file, content in zip(batch.column(0), batch.column(1), strict=True):
            rows = []
            for f, payload, at, length in parse_warc(content.as_py()):
                kind, digest = f["WARC-Type"], f["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"WARC: the payload at {at} does not fit its digest")
                size = int(re.search(r"Content-Length: (\d+)", f["http"])[1])
                rows.append((file.as_py(), url_key(f["WARC-Target-URI"]), f["WARC-Date"], _page(f["WARC-Record-ID"]), size, digest, kind, _page(f.get("WARC-Refers-To")), at, length))
            rows.sort(key=_order)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), RUN, strict=True)], schema=RUN)


def _order(row: tuple) -> tuple:
    """URL key, timestamp; then page, file and offset, so that the order is total."""
    return row[1], row[2], -1 if row[3] is None else row[3], row[0], row[8]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under path; those of an archive are sorted."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(_runs, RUN_SQL)


class LoserTree:
    """Merges k sorted lists: each inner node keeps the loser of its match, so
    the next smallest row takes one comparison for each level."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = [r for r in runs if r]
        self.at = [0] * len(self.runs)
        k = len(self.runs)
        self.key = [_order(r[0]) for r in self.runs]
        self.tree = [-1] * max(1, k)
        for leaf in range(k):
            self._play(leaf, True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.key[a], self.key[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def _play(self, leaf: int, building: bool = False) -> None:
        winner, node = leaf, (leaf + len(self.runs)) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0 and building:
                self.tree[node] = winner
                return
            if other >= 0 and self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        for _ in range(sum(map(len, self.runs))):
            w = self.tree[0]
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.key[w] = _order(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            self._play(w)


def merge_runs(runs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The columns of runs, with range and seq (long): ordered by (range, seq),
    the captures are ordered by URL key and timestamp. A key range holds about
    rows_per_range captures; captures of one URL may span ranges, as boundaries
    are whole keys of the order, page and file included. A run that is not in
    order counts as several. Repeated captures all stay."""
    spark, n = runs.sparkSession, runs.count()
    ranges = max(1, -(-n // rows_per_range))
    cuts: list[tuple] = []
    if ranges > 1:
        part = min(1.0, SAMPLED_KEYS / n)
        sample = sorted(_order(tuple(x)) for x in runs.where(F.pmod(F.xxhash64("file", "offset"), F.lit(1 << 30)) < int(part * (1 << 30))).collect())
        cuts = [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []
    out_schema = RUN_SQL + ", range int, seq long"

    def merge(table: pa.Table) -> pa.Table:
        pieces = [[tuple(x.values()) for x in p] for p in table.column("piece").to_pylist()]
        merged = list(LoserTree(pieces))
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*merged, strict=True), RUN, strict=True)]
        return pa.table([*arrays, pa.array([table.column("range")[0].as_py()] * len(merged), pa.int32()), pa.array(range(len(merged)), pa.int64())], names=[*RUN.names, "range", "seq"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of each run: neighbours of one file and range, and in order."""
        for b in batches:
            rows = list(zip(*(b.column(f.name).to_pylist() for f in RUN), strict=True))
            if not rows:
                continue
            order = [_order(r) for r in rows]
            at = [bisect.bisect_right(cuts, o) for o in order]
            first = [0, *(i for i in range(1, len(rows)) if rows[i][0] != rows[i - 1][0] or at[i] != at[i - 1] or order[i] < order[i - 1])]
            struct = pa.StructArray.from_arrays([b.column(f.name) for f in RUN], names=RUN.names)
            pieces = pa.ListArray.from_arrays(pa.array([*first, len(rows)], pa.int32()), struct)
            yield pa.RecordBatch.from_arrays([pa.array([at[i] for i in first], pa.int32()), pieces], names=["range", "piece"])

    dealt = runs.mapInArrow(deal, f"range int, piece array<struct<{RUN_SQL.replace(' ', ': ').replace(',:', ',')}>>")
    return dealt.groupBy("range").applyInArrow(merge, out_schema)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Write pages to archives under path, read them back, and return the merged index."""
    write_warc(pages, path)
    return merge_runs(stored(read_runs(pages.sparkSession, path), "captures"))
