"""Recovery of abandoned phases and of rows whose deletion or re-indexing was
cut short. Data goes first, diary entries last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diary import LEASE, should_abandon
from ..schema import ENTRY, KEY, schema

PURGE_FAILED = "purge failed; retrying on the next pass"


def to_purge(diary: DataFrame, abandoned: DataFrame, specs: DataFrame) -> DataFrame:
    """(key, phase, pos, step): the first abandoned phase of a source in the
    order of registration and all later ones that have entries, last one first."""
    order = F.broadcast(specs.select(F.col("id").alias("phase"), "pos"))  # a handful of rows
    first = abandoned.select(*KEY, "phase").join(order, "phase").groupBy(*KEY).agg(F.min("pos").alias("first"))
    d = diary.select(*KEY, "phase").join(order, "phase").join(first, list(KEY)).where("pos >= first")
    return d.select(*KEY, "phase", "pos", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("pos"))).alias("step"))


def purge_failed_entry(now: float, lease: float = LEASE) -> Column:
    """An entry that runs for nobody and whose lease is over, so that the next pass takes it up."""
    values = {"state": F.lit("processing"), "reason": F.lit(PURGE_FAILED), "started_at": F.lit(now - lease - 1.0)}
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(ENTRY).fields])


def recovered(purged: DataFrame, now: float, seq: int, lease: float = LEASE) -> DataFrame:
    """Diary events after a purge (key, phase, ok): entries of purged phases go,
    those of phases that could not be purged wait for the next pass."""
    entry = F.when(~F.col("ok"), purge_failed_entry(now, lease)).otherwise(F.lit(None).cast(ENTRY))
    return purged.select(*KEY, "phase", F.lit(seq).alias("seq"), F.col("ok").alias("removed"), entry.alias("entry"))


def blocked_sources(purged: DataFrame) -> DataFrame:
    """(key) with a phase that could not be purged: they are not dispatched in this pass."""
    return purged.where("not ok").select(*KEY).distinct()


def reindex_recovery(rows: DataFrame, now: float, pod: str, boot: str, live_pids: Column, lease: float = LEASE) -> DataFrame:
    """(key, outcome) for rows (key, status, reindex entry): null if a row is not
    re-indexed, live if its owner is, reset if it is to be wiped and started again."""
    gone = should_abandon(F.col("reindex"), F.lit(now), F.lit(pod), F.lit(boot), live_pids, lease)
    return rows.select(*KEY, F.when(F.coalesce(F.col("status") == "reindexing", F.lit(False)), F.when(gone, "reset").otherwise("live")).alias("outcome"))


def legacy_tags(diary: DataFrame, tags: DataFrame, stale: DataFrame) -> DataFrame:
    """(key, phase, tag) to write onto complete entries that have no tag and are
    not stale. tags: (phase, current_tag); stale: (key, phase). Stale entries run
    again, and their run writes the tag."""
    bare = diary.where("coalesce(entry.tag, '') = ''").where(F.coalesce(F.col("entry.state"), F.lit("complete")) == "complete").select(*KEY, "phase")
    fresh = bare.join(stale.select(*KEY, "phase"), [*KEY, "phase"], "left_anti")
    return fresh.join(F.broadcast(tags.where("coalesce(current_tag, '') <> ''")), "phase").select(*KEY, "phase", F.col("current_tag").alias("tag"))


def with_tags(diary: DataFrame, tags: DataFrame) -> DataFrame:
    """diary with the tags (key, phase, tag) of legacy_tags written onto its entries."""
    t = tags.select(*KEY, "phase", F.col("tag").alias("_tag"))
    out = diary.join(t, [*KEY, "phase"], "left")
    return out.withColumn("entry", F.when(F.col("_tag").isNotNull(), F.col("entry").withField("tag", F.col("_tag"))).otherwise(F.col("entry"))).drop("_tag")
