"""The engine: brings sources to the state that settings and texts imply.

It works in waves. A wave takes the first pending phase of every source, runs
each phase once over all its sources, writes data first and diary entries last,
and asks again what is pending, until nothing is. A crash leaves a phase
without an entry, or one that runs for a worker that is gone; the next pass
purges what such a phase may have made, and it runs again."""

from __future__ import annotations

import logging
import os
import socket
import uuid
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import diary as D
from ..functions import tags as G
from ..operators import claims as C
from ..operators import deletion, graph, lifecycle, recovery, waits
from ..operators import points as P
from ..operators import status as S
from ..schema import DIARY_EVENT, ENTRY, KEY, schema
from ..sources.store import Store, remove_path
from .config import EngineConfig
from .hooks import Canceled, Veto
from .phases import Phase, PhaseDeleteError, Registry, results

log = logging.getLogger(__name__)


def pod_name() -> str:
    return os.environ.get("HOSTNAME") or socket.gethostname()


class Engine:
    """pod, pid and boot name this process, live_pids those of its pod that
    live. agents: (agent_id) of the agents that exist; all do if it is null.
    remove_files: takes the names of files (agent_id, scope, name) that go."""

    def __init__(
        self, spark: SparkSession, path: str, registry: Registry, settings: Mapping[str, Any] | None = None, config: EngineConfig | None = None, pod: str | None = None, boot: str | None = None,
        pid: int | None = None, live_pids: Iterable[int] | None = None, agents: DataFrame | None = None, remove_files: Callable[[DataFrame], None] | None = None,
    ) -> None:
        self.spark, self.registry, self.config = spark, registry, config or EngineConfig()
        self.store, self.settings = Store(spark, path), dict(settings or {})
        self.pod, self.boot, self.now = pod or pod_name(), boot or uuid.uuid4().hex, 0.0
        self.pid = os.getpid() if pid is None else pid
        self.live_pids = [self.pid] if live_pids is None else list(live_pids)
        self.agents, self.remove_files = agents, remove_files
        self.contents: DataFrame | None = None
        self._work = f"{self.store.path}/work/{uuid.uuid4().hex}"

    # what phases may use

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{self._work}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def in_pool(self, f: Callable, *args: Any) -> Any:
        """f(*args) with its jobs in the engine's scheduler pool, if it has one."""
        context, key = self.spark.sparkContext, "spark.scheduler.pool"
        before = context.getLocalProperty(key)
        if self.config.pool is None:
            return f(*args)
        context.setLocalProperty(key, self.config.pool)
        try:
            return f(*args)
        finally:
            context.setLocalProperty(key, before)

    def clean(self) -> None:
        """Remove the intermediate tables of earlier calls; results that were not read yet are lost."""
        remove_path(self.spark, self._work)

    def points(self) -> DataFrame:
        return self.store.points()

    def points_of(self, sources: DataFrame) -> DataFrame:
        """Points with the scope of their source."""
        p = self.points().withColumn("scope", F.coalesce("chat_id", F.lit("agent")))
        return p.join(sources.select(*KEY).distinct(), list(KEY), "left_semi")

    def replace_points(self, points: DataFrame, sources: DataFrame) -> None:
        s = sources.select("agent_id", "source", F.when(F.col("scope") == "agent", "declarative").otherwise("episodic").alias("collection"), F.when(F.col("scope") != "agent", F.col("scope")).alias("chat_id"))
        self.store.replace_points(points, s)

    def remove_images(self, sources: DataFrame) -> None:
        """Remove the files of derived images, as far as that goes."""
        if self.remove_files is not None:
            self._try("removing images", self.remove_files, deletion.images_to_remove(self.points(), sources).select("agent_id", "scope", F.col("image_file").alias("name")))

    def _try(self, what: str, f: Callable, *args: Any) -> None:
        try:
            f(*args)
        except Exception as e:  # noqa: BLE001 - the rest of a pass does not depend on it
            log.warning("%s failed: %s", what, e)

    # state

    @property
    def _live(self):
        return F.array(*map(F.lit, self.live_pids)).cast("array<int>")

    def phase_settings(self) -> dict[str, Any]:
        return {p.id: self.settings.get(p.settings_category or p.id, {}) for p in self.registry}

    def tags(self) -> dict[str, str]:
        return G.resolve_tags(self.phase_settings(), list(self.registry))

    def canceled(self, rows: DataFrame) -> DataFrame:
        """(agent_id) of rows whose agent is being deleted or is gone."""
        return lifecycle.canceled(rows, self.store.markers(), rows if self.agents is None else self.agents)

    def raise_if_canceled(self, agent_id: str) -> None:
        one = self.spark.createDataFrame([(agent_id,)], "agent_id string")
        if self.canceled(one).head(1):
            raise Canceled(agent_id)

    def abandoned(self) -> DataFrame:
        gone = D.should_abandon(F.col("entry"), F.lit(self.now), F.lit(self.pod), F.lit(self.boot), self._live, self.config.lease)
        return self.store.diary().where(gone).select(*KEY, "phase")

    def _tag_rows(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.tags().items()), "phase string, current_tag string")

    def _inputs(self) -> DataFrame:
        """What entries without a tag are held against: the marker and the version of each phase's settings."""
        rows = [(p.id, p.tag(self.phase_settings()[p.id]), True, G.digest(G.canonical_json(self.phase_settings()[p.id]))) for p in self.registry]
        return self.spark.createDataFrame(rows, "phase string, marker string, marker_known boolean, settings_version string")

    def stale(self, sources: DataFrame) -> DataFrame:
        return graph.pending(sources, self.registry.specs(self.spark), self.store.diary(), self._tag_rows(), self.abandoned(), self._inputs())

    def pending(self, sources: DataFrame) -> DataFrame:
        """(key, phase, pos) that must run: stale ones, and the parsing of sources that the store has no chunks of."""
        diary, specs = self.store.diary(), self.registry.specs(self.spark)
        parsed = diary.where("phase = 'parsing_chunking' and entry.state = 'complete'")
        chunks = P.stored_sources(self.points().where("not coalesce(image, false)")).select("agent_id", F.coalesce("chat_id", F.lit("agent")).alias("scope"), "source")
        empty = parsed.join(chunks, list(KEY), "left_anti").join(sources.select(*KEY).distinct(), list(KEY), "left_semi")
        again = empty.select(*KEY, "phase").join(F.broadcast(specs.select(F.col("id").alias("phase"), "pos")), "phase").select(*KEY, "phase", "pos")
        return self.stale(sources).union(again).distinct()

    def _write(self, rows: DataFrame, phase: str, state: Any, **entry: Any) -> None:
        """An entry for each row; what is not given is carried from the one before."""
        before = self.store.diary().where(F.col("phase") == phase).select(*KEY, F.col("entry").alias("_before"))
        old = F.col("_before")
        given = {k: v for k, v in entry.items() if k != "attempt"}
        kept = D.carried(old, **{k: v for k, v in given.items() if k in ("started_at", "owner")})
        values = {"started_at": kept["started_at"], "owner": kept["owner"], "tag": F.lit(self.tags().get(phase, ""))} | given
        values |= {"state": state, "attempt": F.coalesce(old["attempt"], F.lit(0)) + entry.get("attempt", F.lit(0))}
        e = F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(ENTRY).fields])
        out = rows.join(before, list(KEY), "left").select(*KEY, F.lit(phase).alias("phase"), F.lit(self.store.next_seq()).alias("seq"), F.lit(False).alias("removed"), e.alias("entry"))
        self.store.add_diary(out)  # an append may read the log that it adds to: what is read is fixed before

    def _status(self, rows: DataFrame, **columns: Any) -> None:
        self.store.add_status(rows.select(*KEY).withColumns({"seq": F.lit(self.store.next_seq()), "ts": F.lit(self.now)} | columns))

    # work

    def ingest(self, contents: DataFrame, now: float) -> DataFrame:
        """Bring sources (agent_id, scope, source, text or content) up to date; returns their status rows."""
        self.contents, self.now = contents, now
        sources = self.stored(contents.select(*KEY).distinct().join(self.canceled(contents), "agent_id", "left_anti"))
        if not sources.head(1):
            return self.store.status().limit(0)
        url = F.when(F.startswith("source", F.lit("http")), "url").otherwise("file")
        sources = self.stored(sources.join(self.recover(sources), list(KEY), "left_anti"))
        self._status(sources, status=F.lit("processing"), type=url)
        self.backfill(sources)
        waiting: DataFrame | None = None  # (key) with a phase that is not ready in this call
        for _ in range(2 * len(list(self.registry)) + 2):
            self._propagate(sources)
            todo = self.pending(sources) if waiting is None else self.pending(sources).join(waiting, list(KEY), "left_anti")
            todo = self.stored(todo.groupBy(*KEY).agg(F.min_by("phase", "pos").alias("phase")))
            waves = {r.phase for r in todo.select("phase").distinct().collect()}  # ids of the registry
            if not waves:
                break
            for phase in graph.execution_order([p for p in self.registry if p.id in waves]):
                late = self._run(phase, todo.where(F.col("phase") == phase.id).select(*KEY))
                waiting = late if waiting is None else self.stored(waiting.union(late).distinct())
        self._finish(sources)
        return self.store.status().join(sources, list(KEY), "left_semi")

    def _run(self, phase: Phase, sources: DataFrame) -> DataFrame:
        """Run a phase; returns the sources that it is not ready for."""
        owner = F.struct(F.lit(self.pod).alias("pod"), F.lit(self.pid).alias("pid"), F.lit(self.boot).alias("boot"))
        chunker = self.settings.get("chunker_name") if phase.id == "parsing_chunking" else None
        self._status(sources, status=F.lit("processing"), phase=F.lit(phase.id), chunker_name=F.lit(chunker))
        self._write(sources, phase.id, F.lit("processing"), started_at=F.lit(self.now), owner=owner, attempt=F.lit(1))
        why = self.stored(sources.withColumn("_why", phase.applies_to(sources)))
        out = phase.process(why.where("_why is null").select(*KEY), self)
        late = self._record(phase, self.stored(out))
        no = why.where("_why is not null")
        if no.head(1):
            self._write(no, phase.id, F.lit("skipped"), reason=F.col("_why"))
        return late

    def _record(self, phase: Phase, out: DataFrame) -> DataFrame:
        """Write entries for results; answers `not ready` are waits until the phase's budget is used up."""
        out = results(out)
        status, reason = D.coerce_result(F.lit(phase.id), F.col("status"), F.col("reason"))
        out = self.stored(out.withColumns({"status": status, "reason": reason}))
        late = self._wait(phase, out.where("status = 'not_ready'"))
        ended = out.where("status <> 'not_ready'").unionByName(late.where("outcome = 'error'").select(*KEY, F.lit("error").alias("status"), F.col("error").alias("reason")), allowMissingColumns=True)
        state = F.when(F.col("status") == "done", "complete").otherwise(F.col("status"))
        done = F.col("status") == "done"
        own, settings = self._inputs().where(F.col("phase") == phase.id).first(), self.phase_settings()
        deps = F.create_map(*[F.lit(x) for d in phase.depends_on if d in self.registry for x in (d, self.registry[d].tag(settings[d]))]).cast("map<string,string>")
        self._write(
            ended, phase.id, state, reason=F.when(done, None).otherwise(F.col("reason")), warnings=F.when(done, D.normalize_warnings(F.col("warnings"))),
            marker=F.when(done, own.marker), marker_known=done, settings_version=F.when(done, own.settings_version), deps=F.when(done, deps),
        )
        return late.where("outcome = 'wait'").select(*KEY)

    def _wait(self, phase: Phase, late: DataFrame) -> DataFrame:
        """(key, outcome, error) of sources that a phase is not ready for. Their
        entries go, so that the next pass asks again; the clock runs on."""
        if not late.head(1):
            return self.spark.createDataFrame([], "agent_id string, scope string, source string, outcome string, error string")
        self.store.add_waits(late.select(*KEY, F.lit(phase.id).alias("phase"), F.lit(self.store.next_seq()).alias("seq"), F.lit(self.now).alias("ts"), "reason"))
        budgets = self.spark.createDataFrame([(p.id, p.budget()) for p in self.registry], "phase string, budget double")
        state = waits.wait_state(self.store.waits().join(late.select(*KEY), list(KEY), "left_semi"))
        out = self.stored(waits.wait_outcome(state, self.store.status(), budgets, self.now).select(*KEY, "outcome", "error"))
        self._forget(out.where("outcome = 'wait'"), [phase.id])
        return out

    def _propagate(self, sources: DataFrame) -> None:
        """Entries for phases that a failed or skipped dependency stops. Each pass is stored, so plans do not grow with the graph."""
        for _ in self.registry:
            more = self.stored(graph.first_offender(sources, self.registry.specs(self.spark), self.store.diary()))
            if not more.head(1):
                return
            for r in more.select("phase").distinct().collect():
                self._write(more.where(F.col("phase") == r.phase), r.phase, F.col("state"), reason=F.col("reason"))

    def backfill(self, sources: DataFrame) -> None:
        """Write tags onto complete entries from before there were tags, unless
        they are stale; completed rows without any entry get complete ones."""
        diary = self.store.diary().join(sources.select(*KEY), list(KEY), "left_semi")
        if not diary.where("coalesce(entry.tag, '') = ''").head(1):
            return
        tags = recovery.legacy_tags(diary, self._tag_rows(), self.stale(sources))
        fresh = recovery.with_tags(diary, tags).join(tags.select(*KEY, "phase"), [*KEY, "phase"], "left_semi")
        self.store.add_diary(self.stored(fresh.select(*KEY, "phase", F.lit(self.store.next_seq()).alias("seq"), F.lit(False).alias("removed"), "entry")))

    def recover(self, sources: DataFrame) -> DataFrame:
        """Purge what abandoned phases and those after them made, and forget
        their entries; returns the sources (key) of which that failed."""
        diary = self.store.diary().join(sources.select(*KEY), list(KEY), "left_semi")
        plan = self.stored(recovery.to_purge(diary, self.abandoned().join(sources.select(*KEY), list(KEY), "left_semi"), self.registry.specs(self.spark)))
        purged: DataFrame | None = None
        for phase in reversed(list(self.registry)):
            rows = plan.where(F.col("phase") == phase.id).select(*KEY)
            if not rows.head(1):
                continue
            ok = True
            try:
                phase.delete(rows, self)
            except Exception as e:  # noqa: BLE001 - one phase must not stop the others
                ok = False
                log.warning("purging phase %s failed: %s", phase.id, e)
            part = rows.withColumns({"phase": F.lit(phase.id), "ok": F.lit(ok)})
            purged = part if purged is None else purged.unionByName(part)
        if purged is None:
            return sources.select(*KEY).limit(0)
        self.store.add_diary(self.stored(recovery.recovered(purged, self.now, self.store.next_seq(), self.config.lease)))
        return recovery.blocked_sources(purged)

    def refresh(self, sources: DataFrame) -> DataFrame:
        """(key, derived, reason) of sources that are not being deleted or indexed anew, by their diaries."""
        grid = sources.select(*KEY).join(F.broadcast(self.registry.specs(self.spark).select(F.col("id").alias("phase"))))  # a handful of phases
        held = self.store.status().where("status in ('deleting', 'reindexing')")
        derived = S.derive_status(self.store.diary(), grid).join(held.select(*KEY), list(KEY), "left_anti")
        return derived.join(S.first_error(self.store.diary()), list(KEY), "left")

    def _finish(self, sources: DataFrame) -> None:
        now = self.stored(self.refresh(sources))
        complete = now.where("derived = 'complete'")
        try:
            done = self.stored(self.registry.fold("before_completed", complete).select(*KEY))
        except Veto as e:
            log.info("completion was vetoed: %s", e)
            done = complete.select(*KEY).limit(0)
        self._status(done, status=F.lit("completed"), clear_phase=F.lit(True))
        held = complete.join(done, list(KEY), "left_anti").withColumn("reason", F.lit("completion was vetoed"))
        bad = now.where("derived = 'error'").unionByName(held)
        self.store.add_status(bad.select(*KEY, F.lit(self.store.next_seq()).alias("seq"), F.lit(self.now).alias("ts"), F.lit("error").alias("status"), F.coalesce("reason", F.lit("a phase failed")).alias("error")))

    # deletion

    def _delete_artifacts(self, sources: DataFrame, state: str) -> None:
        """Every phase deletes, the last one first; what is done is kept in the
        rows, so that a second try goes on with the rest. PhaseDeleteError if a phase fails."""
        self.remove_images(sources)
        specs = self.registry.specs(self.spark)
        plan = self.stored(deletion.delete_plan(sources, specs, deletion.deleted_phases(self.store.status())))
        failed = []
        for phase in reversed(graph.execution_order(list(self.registry))):
            rows = self.stored(plan.where(F.col("phase") == phase.id).select(*KEY))
            if not rows.head(1):
                continue
            try:
                phase.delete(rows, self)
            except Exception as e:  # noqa: BLE001 - the other phases still delete
                failed.append(f"{phase.id}: {e}")
                continue
            done = self.store.status().join(rows, list(KEY), "left_semi").select(*KEY, F.col("extra")["deleted_phases"].alias("_done"))
            extra = F.create_map(F.lit("deleted_phases"), F.concat_ws(",", F.nullif("_done", F.lit("")), F.lit(phase.id)))
            done = self.stored(done.withColumn("extra", extra))
            self.store.add_status(done.select(*KEY, F.lit(self.store.next_seq()).alias("seq"), F.lit(self.now).alias("ts"), F.lit(state).alias("status"), "extra"))
        if failed:
            raise PhaseDeleteError("; ".join(failed))

    def delete(self, sources: DataFrame, now: float, active: bool = True) -> DataFrame:
        """Delete sources; returns (key, route, why): phase by phase where the
        gate allows it, then the file, the row last; else the rows alone."""
        self.now = now
        gate = self.stored(deletion.delete_gate(sources, self.store.diary(), self.registry.specs(self.spark), active))
        ours = self.stored(gate.where("route = 'phases' or why = 'only built-in phases'").select(*KEY))
        self._status(ours, status=F.lit("deleting"))
        self._delete_artifacts(ours, "deleting")
        if self.remove_files is not None:
            self._try("removing files", self.remove_files, ours.where(~F.startswith("source", F.lit("http"))).select("agent_id", "scope", F.col("source").alias("name")))
        self._forget(gate)
        self.store.remove_status(gate, now)
        return gate

    def before_file_delete(self, agent_id: str, scope: str, name: str, now: float) -> bool:
        """A file manager is about to delete a file: whether the engine deleted
        its source. Not while the agent itself goes; a marker that cannot be read counts as none."""
        try:
            if self.store.has_marker(agent_id, "delete"):
                return False
        except Exception as e:  # noqa: BLE001
            log.warning("the delete marker of %s cannot be read: %s", agent_id, e)
        self.delete(self.spark.createDataFrame([(agent_id, scope, name)], "agent_id string, scope string, source string"), now)
        return True

    def clean_orphans(self, conversations: DataFrame, now: float) -> DataFrame:
        """Rows of chats that are gone: their points go, then their diary, then they are completed."""
        self.now = now
        gone = self.stored(lifecycle.orphans(self.store.status(), conversations).select(*KEY))
        self.remove_images(gone)
        self.replace_points(self.points().limit(0), gone)
        self._forget(gone)
        self._status(gone, status=F.lit("completed"), clear_phase=F.lit(True))
        return gone

    def _forget(self, rows: DataFrame, phases: list[str] | None = None) -> None:
        keep = [p.id for p in self.registry if phases is None or p.id in phases]
        kind = schema(DIARY_EVENT)["entry"].dataType
        gone = rows.select(*KEY).withColumn("phase", F.explode(F.array(*map(F.lit, keep))))
        self.store.add_diary(gone.withColumns({"seq": F.lit(self.store.next_seq()), "removed": F.lit(True), "entry": F.lit(None).cast(kind)}))

    def forget(self, sources: DataFrame, phases: list[str] | None = None) -> None:
        """Drop diary entries, so that these phases run again; a wait starts anew."""
        self._forget(sources, phases)
        self.store.add_waits(sources.select(*KEY, F.lit(self.store.next_seq()).alias("seq"), F.lit(self.now).alias("ts")))

    def reingest(self, contents: DataFrame, now: float) -> DataFrame:
        """Index sources anew; their rows are never absent."""
        self.now = now
        sources = self.stored(contents.select(*KEY).distinct())
        owner = G.canonical_json({"pod": self.pod, "pid": self.pid, "boot": self.boot})
        mark = F.create_map(F.lit("reindex"), F.lit(owner), F.lit("reindex_at"), F.lit(str(now)))
        self._status(sources, status=F.lit("reindexing"), extra=mark)
        return self._reset(contents, sources, now)

    def _reset(self, contents: DataFrame, sources: DataFrame, now: float) -> DataFrame:
        self._delete_artifacts(sources, "reindexing")
        self.forget(sources)
        none = F.create_map(*map(F.lit, ("reindex", "", "reindex_at", "", "deleted_phases", "")))
        self._status(sources, status=F.lit("processing"), clear_phase=F.lit(True), extra=none)
        return self.ingest(contents, now)

    def reindex_state(self) -> DataFrame:
        """(key, outcome) of all rows; `reset` where a re-indexing was cut short, `live` where its owner lives."""
        s = self.store.status()
        owner = F.from_json(F.nullif(F.col("extra")["reindex"], F.lit("")), "pod string, pid int, boot string")
        at = F.col("extra")["reindex_at"].try_cast("double")
        values = {"state": F.lit("processing"), "started_at": at, "owner": owner}
        entry = F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(ENTRY).fields])
        return recovery.reindex_recovery(s.select(*KEY, "status", entry.alias("reindex")), self.now, self.pod, self.boot, self._live, self.config.lease)

    # passes

    def claim(self, sources: DataFrame, owner: str | None = None, completed: bool = False, create: bool = False, stale_after: float | None = None) -> DataFrame:
        """Claim sources for this process; returns those claimed (key)."""
        stale_after = self.config.claim_after if stale_after is None else stale_after
        out = self.stored(C.claims(sources, self.store.status(), self.now, stale_after, self.config.boot_threshold, completed, create, self.canceled(sources)))
        self.store.add_status(self.stored(C.claim_events(out, owner or f"{self.pod}:{self.pid}", self.now, self.store.next_seq())))
        return out.where("claimed").select(*KEY)

    def sweep(self, contents: DataFrame, now: float, conversations: DataFrame | None = None, files: DataFrame | None = None) -> DataFrame:
        """Take up rows that were left behind or have become stale, and go on
        with what was cut short; contents: the texts of all sources. With
        conversations and files, rows whose chat, file or page is gone are deleted."""
        self.now = now
        status = self.store.status()
        status = status.join(lifecycle.in_maintenance(status, self.store.markers(), now), "agent_id", "left_anti").join(self.canceled(status), "agent_id", "left_anti")
        out = self.store.status().limit(0)
        if self.config.resume:
            again = self.stored(self.reindex_state().where("outcome = 'reset'").select(*KEY))
            if again.head(1):
                self._reset(contents.join(again, list(KEY), "left_semi"), again, now)
            pending = self.pending(status)
            left = lifecycle.resume_candidates(status, pending, now, self.config.boot_threshold, self.config.download_threshold).select(*KEY)
            todo = self.stored(left.union(lifecycle.completed_but_stale(status, pending).select(*KEY)).distinct())
            mine = self.stored(self.claim(todo, completed=True))
            out = self.ingest(contents.join(mine, list(KEY), "left_semi"), now)
        if self.config.collect_garbage and conversations is not None and files is not None:
            web = self.points().select("agent_id", "collection", "source").distinct()
            gone = self.stored(lifecycle.reconcile(self.store.status(), conversations, files, web, protect=("deleting", "reindexing")).select(*KEY))
            if gone.head(1):
                self.delete(gone, now)
        return out

    def run(self, contents: DataFrame, now: float) -> bool:
        """Bring the sources of all agents up to date after a change of settings,
        max_concurrency agents at a time; True if no source ended in an error. The hook after_run is told."""
        agents = sorted(r.agent_id for r in contents.select("agent_id").distinct().collect())  # tens, not millions
        bad = 0
        for i in range(0, len(agents), self.config.max_concurrency):
            rows = self.in_pool(self.ingest, contents.where(F.col("agent_id").isin(agents[i : i + self.config.max_concurrency])), now)
            bad += rows.where("status = 'error'").count()
        self.registry.fold("after_run", bad == 0)
        return bad == 0

    def heartbeat(self, now: float) -> DataFrame:
        """One tick of all running heartbeats: updates are written for rows that are due; returns (key, action)."""
        self.now = now
        running = waits.timers(self.store.timers())
        out = self.stored(waits.heartbeats(running, self.store.status(), now, self.canceled(running)))
        self.store.add_status(waits.beat_events(out, now, self.store.next_seq()))
        self.stop_heartbeat(out.where("action in ('stop', 'error')"), now)
        return out

    def start_heartbeat(self, sources: DataFrame, now: float, interval: float | None = None, max_seconds: float | None = None) -> None:
        every = self.config.heartbeat if interval is None else interval
        self.store.add_timers(sources.select(*KEY, F.lit(self.store.next_seq()).alias("seq"), F.lit(now).alias("ts"), F.lit(every).alias("interval"), F.lit(max_seconds).cast("double").alias("max_seconds")))

    def stop_heartbeat(self, sources: DataFrame, now: float) -> None:
        self.store.add_timers(self.stored(sources.select(*KEY, F.lit(self.store.next_seq()).alias("seq"), F.lit(now).alias("ts"))))

    # lifecycle of an upload, as events

    def uploaded(self, sources: DataFrame, now: float) -> None:
        self.now = now
        url = F.when(F.startswith("source", F.lit("http")), "url").otherwise("file")
        self._status(sources, status=F.lit("uploaded"), type=url, chat_id=F.when(F.col("scope") != "agent", F.col("scope")))

    def downloading(self, sources: DataFrame, now: float) -> None:
        """A download begins; its heartbeat ends after the bound for downloads."""
        self.now = now
        self._status(sources, status=F.lit("downloading"), type=F.lit("url"))
        self.start_heartbeat(sources, now, max_seconds=self.config.download_heartbeat)

    def downloaded(self, sources: DataFrame, now: float) -> None:
        self.now = now
        self._status(sources, status=F.lit("downloaded"))
        self.start_heartbeat(sources, now)

    def failed(self, sources: DataFrame, error: str, now: float) -> None:
        """A source failed outside any phase. A write that fails is logged and no more."""
        self.now = now
        self._try("writing an error", lambda: self._status(sources, status=F.lit("error"), error=F.lit(error)))

    # reports

    def report(self, agent_id: str | None = None, scope: str | None = None) -> DataFrame:
        return S.status_report(self.store.status(agent_id, scope), self.registry.specs(self.spark))

    def phase_catalog(self) -> DataFrame:
        """(id, label, step, depends_on), dependencies first."""
        rows = [(p.id, p.display_label, i, list(p.depends_on)) for i, p in enumerate(graph.dependency_ordered(list(self.registry)), 1)]
        return self.spark.createDataFrame(rows, "id string, label string, step int, depends_on array<string>")
