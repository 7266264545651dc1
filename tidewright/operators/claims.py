"""Claims and locks: who may work on a source. Both are decided for all rows at
once and written as events; the store has one writer, so a decision holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY
from .lifecycle import IN_FLIGHT

#: Why a claim is refused.
REFUSALS = ("canceled", "missing", "leased", "completed", "state", "fresh")


def claims(wanted: DataFrame, status: DataFrame, now: float, stale_after: float = 0.0, lease: float = 60.0, claim_completed: bool = False, create_missing: bool = False, canceled: DataFrame | None = None) -> DataFrame:
    """(key, claimed, created, refused) for each wanted source (key).

    refused is null for a claimed one, else the first that holds: the agent is
    canceled; there is no row and none is to be created; the row was created by
    a claim, runs, and is younger than its lease; it is completed and such rows
    are not asked for; its state cannot be claimed; it is younger than stale_after."""
    s = status.select(*KEY, "status", "updated_at", "resume_created")
    rows = wanted.select(*KEY).distinct().join(s, list(KEY), "left")
    gone = F.lit(False)
    if canceled is not None:
        rows = rows.join(canceled.select("agent_id").distinct().withColumn("_canceled", F.lit(True)), "agent_id", "left")
        gone = F.col("_canceled").isNotNull()
    age = F.lit(now) - F.coalesce("updated_at", F.lit(0.0))
    state = F.col("status")
    refused = (
        F.when(gone, "canceled")
        .when(state.isNull(), F.lit(None) if create_missing else F.lit("missing"))
        .when(F.coalesce("resume_created", F.lit(False)) & state.isin(*IN_FLIGHT) & (age < (stale_after if stale_after > 0 else lease)), "leased")
        .when(state == "completed", F.lit(None) if claim_completed else F.lit("completed"))
        .when(~state.isin(*IN_FLIGHT, "error"), "state")
        .when(age < stale_after, "fresh")
    ).cast("string")
    return rows.select(*KEY, refused.isNull().alias("claimed"), (refused.isNull() & state.isNull()).alias("created"), refused.alias("refused"))


def claim_events(claimed: DataFrame, owner: str, now: float, seq: int) -> DataFrame:
    """Status events of the sources that were claimed: processing, with the
    owner; a row that the claim creates is marked, so that it is not claimed again at once."""
    extra = F.create_map(F.lit("resume_owner"), F.lit(owner), F.lit("resume_at"), F.lit(str(now)))
    url = F.when(F.startswith("source", F.lit("http")), "url").otherwise("file")
    return claimed.where("claimed").select(
        *KEY, F.lit(seq).alias("seq"), F.lit(now).alias("ts"), F.when(F.col("created"), url).alias("type"), F.when(F.col("created") & (F.col("scope") != "agent"), F.col("scope")).alias("chat_id"),
        F.lit("processing").alias("status"), F.when(F.col("created"), F.lit(True)).alias("resume_created"), extra.alias("extra"),
    )


def held_locks(events: DataFrame, now: float) -> DataFrame:
    """(name, owner, expires_at) of locks that are held. events: (name, owner,
    seq, ts, ttl); a null ttl releases a lock, and one that has expired is free."""
    last = events.groupBy("name").agg(F.max_by(F.struct("owner", "ts", "ttl"), "seq").alias("e"))
    held = last.select("name", F.col("e.owner").alias("owner"), (F.col("e.ts") + F.col("e.ttl")).alias("expires_at"))
    return held.where(F.col("expires_at") > now)


def grant_locks(wanted: DataFrame, events: DataFrame, now: float) -> DataFrame:
    """(name, owner) of the wanted locks (name, owner, seq) that are granted:
    free ones, or held by the same owner; of several owners the first by seq."""
    held = held_locks(events, now).select("name", F.col("owner").alias("holder"))
    w = Window.partitionBy("name").orderBy("seq", "owner")
    free = wanted.join(held, "name", "left").where("holder is null or holder = owner")
    return free.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("name", "owner")


def source_lock(agent, source):
    """The name of a source's lock, which is taken first."""
    return F.concat(F.lit("ingestion:"), agent, F.lit(":"), F.sha2(F.encode(source, "UTF-8"), 256))


def phase_lock(agent, source, phase):
    """The name of the lock of one phase of a source, taken inside the source's."""
    return F.concat(source_lock(agent, source), F.lit(":"), phase)
