"""Helpers shared by the training-data operators: the shared folder, written
tables that cut lineage, checked broadcasts and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a lookup table that may be broadcast (a few MB); larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000
#: The same for tables of two or three longs (about 40 MB at most).
BROADCAST_IDS = 1_000_000
#: Bytes of an Arrow batch of texts.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only in
    local mode, where there is one machine, may it be unset; then a temporary one serves."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        context = spark.sparkContext
        if not re.match(r"local(\[[^,]*\]|\[[^,]*,[^,]*\])?$", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = getattr(context, "_tidewright_dir", None) or tempfile.mkdtemp(prefix="tidewright-")
        context._tidewright_dir = where
    return where


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get by bytes of text, unless
    the session has a bound of its own: by default one may take 64 MB, in the
    JVM, in the worker and in what is made of it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(BATCH_BYTES))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidewright/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back. The table
    outlives any executor, and what was computed is not computed again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidewright_path = path
    return out


def drop_stored(df: DataFrame) -> None:
    """Remove a table written by stored() that nothing reads any more."""
    path = getattr(df, "_tidewright_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark df for broadcast if it has at most `limit` rows; else leave the
    choice to the planner, which then shuffles and splits skewed keys."""
    return F.broadcast(df) if rows <= limit else df


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an undirected edge list; component
    is the smallest node that is reachable. Large-star / small-star rounds
    (Kiveris et al. 2014): each round is two aggregations by node with
    map-side combining and two equi-joins; it ends when a round leaves the
    edges as they are. Loops (a = b) and nulls are ignored. Nothing but counts
    and one checksum comes to the driver."""
    e = (
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e, old = stored(e, "edges"), None
    while True:
        # large-star: every neighbour above u hangs on the smallest one around u
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # small-star: every neighbour below u, and u, hangs on the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        new = stored(
            down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        mark = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        drop_stored(e)
        e = new
        if mark == old:
            break
        old = mark
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def release(spark: SparkSession) -> None:
    """Spark deletes shuffle files of finished jobs once the driver's garbage
    collection finds them unreachable; ask for it between large steps."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df dealt out by key and sorted by it, for mapInArrow over runs of equal
    keys: sorting spills, and a task holds a few Arrow batches at a time. For
    keys whose groups are known to be small; frequent ones go another way."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def key_runs(batches, most: int = 1 << 62):
    """Regroup Arrow batches that are sorted by their first column, a long:
    (table, whole), where no key is split between two tables. A key of more
    than `most` rows comes alone, in several tables (whole is False), so that
    what is held stays bounded."""
    import numpy as np
    import pyarrow as pa

    def out(pieces, whole):
        return pa.Table.from_batches(pieces).combine_chunks(), whole

    held, rows, long, key = [], 0, False, None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(0).to_numpy()
        if held or long:
            end = int(np.searchsorted(k, key, "right"))  # rows that go on with the last key
            if end:
                held.append(b.slice(0, end))
                rows += end
            if end == len(k):
                if rows > most:
                    yield out(held, False)
                    held, rows, long = [], 0, True
                continue
            if held:
                yield out(held, not long)
            held, long = [], False
            b, k = b.slice(end), k[end:]
        key = k[-1]
        cut = int(np.searchsorted(k, key, "left"))
        if cut:
            yield out([b.slice(0, cut)], True)
        held, rows = [b.slice(cut)], len(k) - cut
        if rows > most:
            yield out(held, False)
            held, rows, long = [], 0, True
    if held:
        yield out(held, not long)
