"""Expressions over a phase's diary entry. Time, boot id and the like are parameters, never read inside a query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ENTRY, PHASE_STATES, WARNING

LEASE = 1800.0


def phase_state(e: Column) -> Column:
    """pending if there is no entry; an entry without a state, or with one that is not known, is complete."""
    s = e["state"]
    return F.when(e.isNull(), "pending").when(s.isin(*PHASE_STATES), s).when(s == "running", "processing").otherwise("complete")


def lease_expired(e: Column, now: Column, lease: float = LEASE) -> Column:
    return (phase_state(e) == "processing") & (e["started_at"].isNull() | (now - e["started_at"] > lease))


def should_abandon(e: Column, now: Column, pod: Column, boot: Column, live_pids: Column, lease: float = LEASE) -> Column:
    """Whether a running phase has lost its worker; the order of the arms matters."""
    o = e["owner"]
    expired = lease_expired(e, now, lease)
    out = (
        F.when(phase_state(e) != "processing", False)
        .when(o.isNull() | F.coalesce(o["boot"], F.lit("")).isin(""), expired)
        .when(o["boot"] == boot, False)
        .when((o["pod"] == pod) & F.coalesce(F.array_contains(live_pids, o["pid"]), F.lit(False)), False)
        .when(~F.coalesce(o["pod"] == pod, F.lit(False)), expired)
        .otherwise(True)
    )
    return F.coalesce(out, F.lit(False))


def normalize_warnings(w: Column) -> Column:
    """Warnings that have both a code and a message."""
    return F.filter(F.coalesce(w, F.array().cast(f"array<{WARNING}>")), lambda x: x["code"].isNotNull() & x["message"].isNotNull())


def normalize_entry(e: Column, current_tag: Column | None = None) -> Column:
    """An entry with defaults filled in; a fresh entry without a tag may be given the current one."""
    tag = F.coalesce(e["tag"], F.lit(""))
    if current_tag is not None:
        tag = F.when((tag == "") & (phase_state(e) == "complete"), F.coalesce(current_tag, tag)).otherwise(tag)
    w = normalize_warnings(e["warnings"])
    return F.when(
        e.isNotNull(),
        F.struct(
            phase_state(e).alias("state"), e["reason"].alias("reason"), e["started_at"].alias("started_at"), e["owner"].alias("owner"), tag.alias("tag"),
            F.coalesce(e["attempt"], F.lit(0)).alias("attempt"), e["marker"].alias("marker"), F.coalesce(e["marker_known"], F.lit(False)).alias("marker_known"),
            e["settings_version"].alias("settings_version"), e["deps"].alias("deps"), F.when(F.size(w) > 0, w).alias("warnings"),
        ),
    ).cast(ENTRY)


def next_attempt(previous: Column) -> Column:
    return F.coalesce(previous["attempt"], F.lit(0)) + 1


def carried(previous: Column, **new: Column) -> dict[str, Column]:
    """started_at, owner and tag of the new entry or else of the previous one; a previous attempt that is not zero wins."""
    out = {k: F.coalesce(new.get(k, F.lit(None)), previous[k]) for k in ("started_at", "owner", "tag")}
    return out | {"attempt": F.coalesce(F.nullif(previous["attempt"], F.lit(0)), new.get("attempt", F.lit(None).cast("int")))}


def is_stale(e: Column, blocked: Column, tag: Column, abandon: Column, deps_differ: Column, marker: Column, marker_known: Column, settings_version: Column) -> Column:
    """Whether a phase must run. blocked: a dependency is absent, running,
    failed or skipped; deps_differ: a recorded marker of a dependency is not the
    one its entry has now. Arms in order: no entry; running (stale if
    abandoned); failed or skipped (never); blocked; tags, where one is
    recorded; else the older rules by markers and settings version."""
    state = phase_state(e)
    return (
        F.when(e.isNull(), True)
        .when(state == "processing", abandon)
        .when(state.isin("error", "skipped"), False)
        .when(F.coalesce(blocked, F.lit(False)), True)
        .when(F.coalesce(e["tag"], F.lit("")) != "", ~e["tag"].eqNullSafe(tag))
        .when(F.coalesce(deps_differ, F.lit(False)), True)
        .when(F.coalesce(settings_version == e["settings_version"], F.lit(False)), False)
        .when(~F.coalesce(marker_known, F.lit(False)), True)
        .otherwise(~F.coalesce(e["marker_known"], F.lit(False)) | ~e["marker"].eqNullSafe(marker))
    )


def coerce_result(phase: Column, status: Column, reason: Column) -> tuple[Column, Column]:
    """(status, reason) of a phase's result; an unknown status is an error that says so."""
    known = F.coalesce(status.isin("done", "not_ready", "error", "skipped"), F.lit(False))
    text = F.concat(F.lit("phase "), phase, F.lit(" returned no usable result"))
    return F.when(known, status).otherwise("error"), F.when(known, reason).otherwise(text)


def retry_after(x: Column, default: float = 5.0) -> Column:
    """Seconds to wait before a phase that is not ready is asked again."""
    d = x.try_cast("double")
    return F.when((d > 0) & ~F.isnan(d), d).otherwise(default)
