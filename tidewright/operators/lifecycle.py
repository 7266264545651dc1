"""Who may be claimed, resumed, recovered, reconciled and deleted. `now` and thresholds are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diary import phase_state
from ..schema import KEY

IN_FLIGHT = ("uploaded", "downloading", "downloaded", "processing")


def canceled(agents_wanted: DataFrame, markers: DataFrame, agents: DataFrame) -> DataFrame:
    """(agent_id) that has a delete marker or no longer exists."""
    a = agents_wanted.select("agent_id").distinct()
    return a.join(markers.where("kind = 'delete'").select("agent_id"), "agent_id", "left_semi").union(a.join(agents.select("agent_id"), "agent_id", "left_anti")).distinct()


def in_maintenance(agents_wanted: DataFrame, markers: DataFrame, now: float) -> DataFrame:
    return agents_wanted.select("agent_id").distinct().join(markers.where((F.col("kind") == "maintenance") & (F.col("expires_at") > now)), "agent_id", "left_semi")


def claimable(status: Column, updated_at: Column, resume_created: Column, now: Column, stale_after: float, claim_completed: bool = False, lease: float = 60.0) -> Column:
    """Whether a row may be claimed for another run; the order of the arms matters."""
    age = now - updated_at
    fresh = F.coalesce(resume_created, F.lit(False)) & status.isin(*IN_FLIGHT) & (age < (stale_after or lease))
    out = F.when(fresh, False).when(status == "completed", F.lit(claim_completed)).when(status.isin(*IN_FLIGHT, "error"), age >= stale_after).otherwise(False)
    return F.coalesce(out, F.lit(False))


def claim_missing(sources: DataFrame, status: DataFrame) -> DataFrame:
    """Sources without a row: they may be created, once."""
    return sources.select(*KEY).distinct().join(status.select(*KEY), list(KEY), "left_anti")


def resume_candidates(status: DataFrame, pending: DataFrame, now: float, boot: float = 60.0, download: float = 300.0) -> DataFrame:
    """Rows whose age passes the threshold of their status; failed ones only if a phase is pending."""
    age = F.lit(now) - F.col("updated_at")
    limit = F.when(F.col("status").isin("downloading", "downloaded"), max(boot, download)).when(F.col("status").isin("uploaded", "processing", "error"), boot)
    old = status.where(age >= limit)
    failed = old.where("status = 'error'").join(pending.select(*KEY).distinct(), list(KEY), "left_semi")
    return old.where("status <> 'error'").unionByName(failed)


def completed_but_stale(status: DataFrame, pending: DataFrame) -> DataFrame:
    return status.where("status = 'completed'").join(pending.select(*KEY).distinct(), list(KEY), "left_semi")


def reconcile(status: DataFrame, conversations: DataFrame, files: DataFrame, points: DataFrame, protect: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose chat, file or page is gone, once each. Rows that run or failed
    stay; protect adds states that stay. A row of a chat that is gone goes whatever its type."""
    rows = status.where(~F.col("status").isin(*IN_FLIGHT, "error", *protect) & (F.coalesce("source", F.lit("")) != ""))
    chat = rows.where("scope <> 'agent'").join(conversations.select("agent_id", F.col("chat_id").alias("scope")), ["agent_id", "scope"], "left_anti")
    file = rows.where("type = 'file'").join(files.select("agent_id", "scope", F.col("name").alias("source")), list(KEY), "left_anti")
    web = points.select("agent_id", "collection", "source").distinct()
    url = rows.where("type = 'url'").withColumn("collection", F.when(F.col("scope") == "agent", "declarative").otherwise("episodic")).join(web, ["agent_id", "collection", "source"], "left_anti").drop("collection")
    return chat.unionByName(file).unionByName(url.select(*rows.columns)).dropDuplicates(list(KEY))


def orphans(status: DataFrame, conversations: DataFrame) -> DataFrame:
    """Rows of chats that are gone."""
    return status.where("scope <> 'agent'").join(conversations.select("agent_id", F.col("chat_id").alias("scope")).distinct(), ["agent_id", "scope"], "left_anti")


def missing_files(status: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files that are gone, as errors that say so."""
    gone = status.where("type = 'file'").join(files.select("agent_id", "scope", F.col("name").alias("source")), list(KEY), "left_anti")
    return gone.withColumns({"status": F.lit("error"), "error": F.lit("Source file does not exist on disk")})


def recovery_order(diary: DataFrame, abandoned: DataFrame, specs: DataFrame) -> DataFrame:
    """(key, phase, pos, step): from the first abandoned phase on, all that have entries, the last one first."""
    d = diary.select(*KEY, "phase").join(F.broadcast(specs.select(F.col("id").alias("phase"), "pos")), "phase")
    first = abandoned.select(*KEY, "phase").join(F.broadcast(specs.select(F.col("id").alias("phase"), "pos")), "phase").groupBy(*KEY).agg(F.min("pos").alias("first"))
    w = Window.partitionBy(*KEY).orderBy(F.desc("pos"))
    return d.join(first, list(KEY)).where("pos >= first").select(*KEY, "phase", "pos", F.row_number().over(w).alias("step"))


def delete_order(phases: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """phases (key, phase, pos, depth) last first, without those that are done."""
    rows = phases if done is None else phases.join(done.select(*KEY, "phase"), [*KEY, "phase"], "left_anti")
    w = Window.partitionBy(*KEY).orderBy(F.desc("depth"), F.desc("pos"))
    return rows.withColumn("step", F.row_number().over(w))


def delete_answer(asked: DataFrame, status: DataFrame) -> DataFrame:
    """(key, deleted, reason): a row that does not exist or still runs is not deleted."""
    s = status.select(*KEY, "status")
    reason = F.when(F.col("agent_id").isNull(), "no_agent").when(F.col("status").isNull(), "not_found").when(F.col("status").isin(*IN_FLIGHT), "in_flight")
    out = asked.withColumn("scope", F.coalesce("scope", F.lit("agent"))).join(s, list(KEY), "left")
    return out.select(*KEY, reason.isNull().alias("deleted"), reason.alias("reason"))


def has_live_phase(diary: DataFrame, abandoned: DataFrame) -> DataFrame:
    """(key) with a running phase that is not abandoned."""
    running = diary.where(phase_state(F.col("entry")) == "processing").select(*KEY, "phase")
    return running.join(abandoned.select(*KEY, "phase"), [*KEY, "phase"], "left_anti").select(*KEY).distinct()
