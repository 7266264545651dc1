"""Status rows and diaries as folds of event tables. Every fold is one
aggregation by key with map-side combining; nothing is updated in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.diary import phase_state
from ..schema import KEY, LIFECYCLE


def status_catalog(spark) -> DataFrame:
    return spark.createDataFrame([(i, s, label) for i, (s, label) in enumerate(LIFECYCLE, 1)], "pos int, id string, label string")


def fold_status(events: DataFrame) -> DataFrame:
    """The current row of each source. Fields keep their last value that is not
    null; a later clear_phase takes the phase away; created_at is the first
    time and updated_at the last; error_at is the time of the last error;
    keys of extra are merged, the last value of a key wins; resume_created ends
    with completed or error."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq")))
    folded = events.groupBy(*KEY).agg(
        *[last(c).alias(c) for c in ("chat_id", "type", "status", "embedder_name", "chunker_name", "resume_created")],
        F.max_by("error", F.when(F.col("status").isNotNull(), F.col("seq"))).alias("error"),
        F.max_by("ts", F.when(F.col("status") == "error", F.col("seq"))).alias("error_at"),
        F.min("ts").alias("created_at"), F.max("ts").alias("updated_at"),
        last("phase").alias("phase"), F.max(F.when(F.col("phase").isNotNull(), F.col("seq"))).alias("_set"), F.max(F.when(F.col("clear_phase"), F.col("seq"))).alias("_cleared"),
    )
    extra = (
        events.where("extra is not null").select(*KEY, "seq", F.explode("extra"))
        .groupBy(*KEY, "key").agg(F.max_by("value", "seq").alias("value"))
        .groupBy(*KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("extra"))
    )
    terminal = F.col("status").isin("completed", "error")
    return (
        folded.join(extra, list(KEY), "left")
        .withColumn("phase", F.when(F.coalesce(F.col("_cleared") >= F.col("_set"), F.lit(False)), None).otherwise(F.col("phase")))
        .withColumn("resume_created", F.when(terminal, None).otherwise(F.col("resume_created")))
        .drop("_set", "_cleared")
    )


def fold_diary(events: DataFrame) -> DataFrame:
    """The current entry of each phase of each source; the last event wins, a removed one leaves no row."""
    return events.groupBy(*KEY, "phase").agg(F.max_by(F.struct("removed", "entry"), "seq").alias("e"), F.min("seq").alias("first_seq")).where("not coalesce(e.removed, false)").select(*KEY, "phase", F.col("e.entry").alias("entry"), "first_seq")


def diary_of_lists(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, phase, pos, entry) from rows with a position; of phases that occur twice the last wins, nameless ones go."""
    return rows.where("phase is not null").groupBy(*key, "phase").agg(F.min("pos").alias("pos"), F.max_by("entry", "pos").alias("entry"))


def backfill(status: DataFrame, diary: DataFrame, specs: DataFrame) -> DataFrame:
    """diary, and for completed sources without one an entry `complete` with an empty tag for each phase."""
    bare = status.where("status = 'completed'").select(*KEY).join(diary.select(*KEY).distinct(), list(KEY), "left_anti")
    entry = F.struct(F.lit("complete").alias("state"), F.lit("").alias("tag"))
    filled = bare.join(F.broadcast(specs.select(F.col("id").alias("phase"))))  # a handful of phases for each source
    return diary.select(*KEY, "phase", F.struct(F.col("entry.state").alias("state"), F.col("entry.tag").alias("tag")).alias("entry")).unionByName(filled.select(*KEY, "phase", entry.alias("entry")))


def derive_status(diary: DataFrame, phases: DataFrame | None = None, key: list[str] | None = None) -> DataFrame:
    """(key, derived): error if any phase failed, else processing if any is
    pending or runs, else complete. phases: (key, phase) of the phases that
    count; without it those that have entries."""
    key = key or list(KEY)
    rows = diary if phases is None else phases.join(diary, [*key, "phase"], "left")
    state = phase_state(F.col("entry"))
    any_ = lambda *s: F.coalesce(F.bool_or(state.isin(*s)), F.lit(False))
    return rows.groupBy(*key).agg(F.when(any_("error"), "error").when(any_("pending", "processing"), "processing").otherwise("complete").alias("derived"))


def refresh_status(status: DataFrame, derived: DataFrame) -> DataFrame:
    """status with the derived value, but for sources that are deleted or indexed anew."""
    value = F.when(F.col("derived") == "complete", "completed").otherwise(F.col("derived"))
    return status.join(derived, list(KEY), "left").withColumn("status", F.when(F.col("status").isin("deleting", "reindexing") | F.col("derived").isNull(), F.col("status")).otherwise(value)).drop("derived")


def warnings_of(diary: DataFrame) -> DataFrame:
    """(key, phase, pos, code, message): well-formed warnings of complete phases, in the order of the diary."""
    w = diary.where(phase_state(F.col("entry")) == "complete").select(*KEY, "phase", "first_seq", F.posexplode("entry.warnings").alias("pos", "w"))
    return w.where("w.code is not null and w.message is not null").select(*KEY, "phase", "first_seq", "pos", F.col("w.code").alias("code"), F.col("w.message").alias("message"))


def first_error(diary: DataFrame) -> DataFrame:
    return diary.where(phase_state(F.col("entry")) == "error").groupBy(*KEY).agg(F.min_by("entry.reason", "first_seq").alias("reason"))


def status_report(status: DataFrame, phase_labels: DataFrame, spark=None) -> DataFrame:
    """status with phase_label and status_label; a phase that is not in the catalog is labelled like the lifecycle state."""
    states = F.broadcast(status_catalog(status.sparkSession).select(F.col("id").alias("status"), F.col("label").alias("status_label")))
    phases = F.broadcast(phase_labels.select(F.col("id").alias("phase"), F.col("label").alias("_label")))
    out = status.join(states, "status", "left").join(phases, "phase", "left")
    return out.withColumn("phase_label", F.when(F.col("phase").isNotNull(), F.coalesce("_label", "status_label"))).drop("_label")


def reset_phases(diary: DataFrame, phases: list[str] | None = None, sources: DataFrame | None = None) -> DataFrame:
    """diary without some phases (all, if none are named), of some sources (all, if none are given)."""
    gone = F.lit(True) if phases is None else F.col("phase").isin(*phases)
    if sources is None:
        return diary.where(~gone)
    hit = sources.select(*KEY).distinct().withColumn("_hit", F.lit(True))
    return diary.join(hit, list(KEY), "left").where(~(F.col("_hit").isNotNull() & gone)).drop("_hit")


def latest(events: DataFrame, key: list[str], *order: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    return events.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
