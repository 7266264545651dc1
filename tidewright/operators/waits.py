"""Waiting: phases that are not ready yet, and heartbeats of sources in flight."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diary import retry_after
from ..schema import KEY
from .lifecycle import IN_FLIGHT

TERMINAL = ("completed", "error")


def wait_state(events: DataFrame) -> DataFrame:
    """(key, phase, since, attempts, retry_after, reason) of the spell that each
    source is in. events: (key, phase, seq, ts, retry_after string, reason), one
    for each answer `not ready`; a row with a null phase ends the spell (the
    phase ran). The clock starts anew with another phase."""
    by = Window.partitionBy(*KEY).orderBy("seq")
    e = events.withColumn("_new", F.coalesce((~F.col("phase").eqNullSafe(F.lag("phase").over(by))).cast("int"), F.lit(1)))
    e = e.withColumn("_spell", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spells = e.groupBy(*KEY, "_spell").agg(F.min("ts").alias("since"), F.count("*").alias("attempts"), F.max_by(F.struct("phase", "retry_after", "reason"), "seq").alias("l"))
    last = spells.groupBy(*KEY).agg(F.max_by(F.struct("since", "attempts", "l"), "_spell").alias("s"))
    out = last.select(*KEY, F.col("s.l.phase").alias("phase"), F.col("s.since").alias("since"), F.col("s.attempts").alias("attempts"), retry_after(F.col("s.l.retry_after")).alias("retry_after"), F.col("s.l.reason").alias("reason"))
    return out.where("phase is not null")


def wait_outcome(waits: DataFrame, status: DataFrame, budgets: DataFrame, now: float, default: float = 3600.0) -> DataFrame:
    """(key, phase, attempts, outcome, error): `wait` while the time since the
    first answer is below the phase's budget (phase, budget), else `error` with
    a text that says so; null for rows that have ended, which are left alone."""
    rows = waits.join(status.select(*KEY, "status"), list(KEY), "left").join(F.broadcast(budgets), "phase", "left")
    elapsed = F.greatest(F.lit(0.0), F.lit(now) - F.col("since"))
    bound = F.coalesce("budget", F.lit(default))
    outcome = F.when(F.coalesce(F.col("status").isin(*TERMINAL), F.lit(False)), None).when(elapsed >= bound, "error").otherwise("wait")
    whole = lambda c: F.format_string("%.0f", c.cast("double"))
    error = F.concat(F.lit("phase "), F.col("phase"), F.lit(" not ready after "), whole(elapsed), F.lit("s (max "), whole(bound), F.lit("s): "), F.coalesce("reason", F.lit("")))
    return rows.select(*KEY, "phase", "attempts", outcome.alias("outcome"), F.when(outcome == "error", error).alias("error"))


def timers(events: DataFrame) -> DataFrame:
    """(key, interval, max_seconds, started_at) of running heartbeats. events:
    (key, seq, ts, interval, max_seconds); a start replaces the timer before it,
    a null interval, or one that is not above zero, stops it."""
    last = events.groupBy(*KEY).agg(F.max_by(F.struct("interval", "max_seconds", "ts"), "seq").alias("e"))
    return last.where("e.interval > 0").select(*KEY, F.col("e.interval").alias("interval"), F.col("e.max_seconds").alias("max_seconds"), F.col("e.ts").alias("started_at"))


def heartbeats(running: DataFrame, status: DataFrame, now: float, canceled: DataFrame | None = None) -> DataFrame:
    """(key, action) for each timer: `stop` if its row has ended or is absent or
    the timer is over its bound; `error` if its agent is canceled; `beat` if the
    row is due (its last update is an interval ago); else `wait`."""
    rows = running.join(status.select(*KEY, "status", "updated_at"), list(KEY), "left")
    gone = F.lit(False)
    if canceled is not None:
        rows = rows.join(canceled.select("agent_id").distinct().withColumn("_canceled", F.lit(True)), "agent_id", "left")
        gone = F.col("_canceled").isNotNull()
    over = F.coalesce(F.lit(now) - F.col("started_at") >= F.col("max_seconds"), F.lit(False))
    ended = ~F.coalesce(F.col("status").isin(*IN_FLIGHT), F.lit(False))
    due = F.lit(now) - F.coalesce("updated_at", F.lit(0.0)) >= F.col("interval")
    return rows.select(*KEY, F.when(gone, "error").when(ended | over, "stop").when(due, "beat").otherwise("wait").alias("action"))


def beat_events(actions: DataFrame, now: float, seq: int) -> DataFrame:
    """Status events of heartbeats: an update for those that beat, an error for canceled ones."""
    a = F.col("action")
    return actions.where(a.isin("beat", "error")).select(*KEY, F.lit(seq).alias("seq"), F.lit(now).alias("ts"), F.when(a == "error", "error").alias("status"), F.when(a == "error", "the agent is being deleted").alias("error"))
