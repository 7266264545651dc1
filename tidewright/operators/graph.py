"""The graph of phases: order, closure, staleness and the spread of failures."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.diary import is_stale, phase_state
from ..schema import KEY


def merge_specs(*origins: DataFrame) -> DataFrame:
    """One row for each phase; of equal ids the first origin, and the first position in it, wins."""
    rows = None
    for i, o in enumerate(origins):
        o = o.where("id is not null and id <> ''").withColumn("origin", F.lit(i))
        rows = o if rows is None else rows.unionByName(o, allowMissingColumns=True)
    w = Window.partitionBy("id").orderBy("origin", "pos")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def execution_order(phases: Iterable[Any]) -> list[Any]:
    """Phases by depth, then position. Unknown dependencies and cycles add no edge."""
    first: dict[str, Any] = {}
    for p in phases:
        first.setdefault(p.id, p)
    known: dict[str, int] = {}

    def depth(pid: str, above: frozenset[str]) -> int:
        if pid in known:
            return known[pid]
        if pid not in first or pid in above:
            return 0
        known[pid] = max((1 + depth(d, above | {pid}) for d in first[pid].depends_on if d in first), default=0)
        return known[pid]

    return sorted(phases, key=lambda p: depth(p.id, frozenset()))


def dependency_ordered(phases: Iterable[Any]) -> list[Any]:
    """Phases after all they depend on, as near to the given order as that allows; a cycle is cut where it closes."""
    by_id = {p.id: p for p in reversed(list(phases))}
    out: list[Any] = []
    seen: set[str] = set()

    def visit(p: Any) -> None:
        if p.id in seen:
            return
        seen.add(p.id)
        for d in p.depends_on:
            if d in by_id:
                visit(by_id[d])
        out.append(p)

    for p in phases:
        visit(by_id[p.id])
    return out


def downstream(edges: DataFrame, start: str, depth: int = 64) -> DataFrame:
    """(id): phases that depend on `start` directly or not, without itself. edges: (id, dep). Ends on cycles too."""
    spark = edges.sparkSession
    return spark.sql(
        """with recursive down(id, level) as (
             select id, 1 from {e} where dep = {start}
             union all
             select e.id, d.level + 1 from down d join {e} e on e.dep = d.id where d.level < {depth})
           select distinct id from down where id <> {start}""",
        e=edges, start=start, depth=depth,
    )


def depths(specs: DataFrame, limit: int = 64) -> DataFrame:
    """(id, pos, depth) by a recursive query over specs (id, pos, depends_on)."""
    spark = specs.sparkSession
    return spark.sql(
        """with recursive edges as (select id, dep from (select id, explode(depends_on) as dep from {s}) x where dep in (select id from {s})),
             walk(id, depth) as (
               select id, 0 from {s}
               union all
               select e.id, w.depth + 1 from walk w join edges e on e.dep = w.id where w.depth < {limit})
           select s.id, s.pos, max(w.depth) as depth from {s} s join walk w on s.id = w.id group by s.id, s.pos""",
        s=specs, limit=limit,
    )


def _literal(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _graph(specs: DataFrame) -> tuple[list[Row], str]:
    """The phases, dependencies first, and the same as an SQL array. The graph is a handful of rows."""
    rows = specs.select("id", "pos", "depends_on").orderBy("pos").collect()
    rows = dependency_ordered(rows)
    one = lambda r: f"named_struct('id', {_literal(r.id)}, 'deps', cast(array({', '.join(map(_literal, r.depends_on or ()))}) as array<string>))"
    return rows, f"array({', '.join(map(one, rows))})"


def _by_source(sources: DataFrame, diary: DataFrame, key: list[str], *more: DataFrame) -> DataFrame:
    """(key, m): each wanted source with its diary as a map of phase to entry,
    in one aggregation by key. more: (key, phase) rows, collected as g0, g1 and so on."""
    kind = diary.schema["entry"].dataType
    flags = [F.lit(None).cast("string").alias(f"_g{i}") for i in range(len(more))]
    none, no = F.lit(None).cast("string").alias("phase"), F.lit(None).cast(kind).alias("entry")
    rows = sources.select(*key, none, no, F.lit(True).alias("_w"), *flags)
    rows = rows.union(diary.select(*key, "phase", "entry", F.lit(False).alias("_w"), *flags))
    for i, m in enumerate(more):
        rows = rows.union(m.select(*key, none, no, F.lit(False).alias("_w"), *[F.col("phase").alias("_g") if j == i else f for j, f in enumerate(flags)]))
    pairs = F.collect_list(F.when(F.col("phase").isNotNull(), F.struct("phase", "entry")))
    return rows.groupBy(*key).agg(F.bool_or("_w").alias("_w"), F.map_from_entries(pairs).alias("m"), *[F.collect_set(f"_g{i}").alias(f"g{i}") for i in range(len(more))]).where("_w").drop("_w")


def _offenders(sources: DataFrame, specs: DataFrame, diary: DataFrame, key: list[str], deep: bool) -> DataFrame:
    """(key, phase, state, reason): for phases without an entry the first of
    their dependencies, as declared, that failed or was skipped; deep: phases
    that get an entry in this way stop those that depend on them."""
    _, graph = _graph(specs)
    states = F.transform_values("m", lambda _, e: phase_state(e)).alias("s")
    rows = _by_source(sources, diary, key).select(*key, states)
    seen = "a.s" if deep else "s"
    fold = f"""aggregate({graph}, named_struct('s', s, 'out', cast(array() as array<struct<phase: string, dep: string, state: string>>)), (a, p) ->
      if(map_contains_key(a.s, p.id), a, transform(array(get(filter(p.deps, d -> coalesce({seen}[d] in ('error', 'skipped'), false)), 0)), d ->
        if(d is null, a, named_struct('s', map_concat(a.s, map(p.id, {seen}[d])), 'out', concat(a.out, array(named_struct('phase', p.id, 'dep', d, 'state', {seen}[d]))))))[0]), a -> a.out)"""
    found = rows.select(*key, F.explode(F.expr(fold)).alias("o"))
    return found.select(*key, F.col("o.phase").alias("phase"), F.col("o.state").alias("state"), F.concat(F.lit("dependency "), F.col("o.dep"), F.lit(" is "), F.col("o.state")).alias("reason"))


def first_offender(sources: DataFrame, specs: DataFrame, diary: DataFrame, key: list[str] | None = None) -> DataFrame:
    """(key, phase, state, reason): for each phase without an entry the first of
    its dependencies, as declared, that failed or was skipped."""
    return _offenders(sources, specs, diary, key or list(KEY), False)


def propagate(sources: DataFrame, specs: DataFrame, diary: DataFrame, key: list[str] | None = None) -> DataFrame:
    """diary (key, phase, entry) with entries for all phases that a failed or
    skipped dependency stops, directly or not: one fold along the graph in each source's row."""
    key = key or list(KEY)
    diary = diary.select(*key, "phase", "entry")
    more = _offenders(sources, specs, diary, key, True)
    entry = F.struct(*[(F.col("state") if f.name == "state" else F.col("reason") if f.name == "reason" else F.lit(None)).cast(f.dataType).alias(f.name) for f in diary.schema["entry"].dataType.fields])
    return diary.unionByName(more.select(*key, "phase", entry.alias("entry")))


def pending(sources: DataFrame, specs: DataFrame, diary: DataFrame, tags: DataFrame, abandoned: DataFrame | None = None, inputs: DataFrame | None = None) -> DataFrame:
    """(key, phase, pos) of the phases that must run. tags: (phase, current_tag);
    abandoned: (key, phase); inputs: (phase, marker, marker_known,
    settings_version) as they are now, for entries that have no tag. A source's
    entries are gathered once; every phase is judged in its row."""
    key, (phases, _) = list(KEY), _graph(specs)
    tag = {r.phase: r.current_tag for r in tags.select("phase", "current_tag").collect()}  # as many rows as phases
    now = {} if inputs is None else {r.phase: r for r in inputs.collect()}
    rows = _by_source(sources, diary, key, *([] if abandoned is None else [abandoned]))
    gone = F.lit(False) if abandoned is None else None
    found = []
    for p in phases:
        e, n = F.col("m")[p.id], now.get(p.id)
        deps = p.depends_on or []
        blocked, differs = F.lit(False), F.lit(False)
        for d in deps:
            blocked = blocked | (phase_state(F.col("m")[d]) != "complete")
            differs = differs | F.coalesce(F.map_contains_key(e["deps"], d) & ~e["deps"][d].eqNullSafe(F.col("m")[d]["marker"]), F.lit(False))
        lost = gone if gone is not None else F.array_contains("g0", p.id)
        text = lambda v: F.lit(v).cast("string")
        stale = is_stale(e, blocked, text(tag.get(p.id)), lost, differs, text(n and n.marker), F.lit(n and n.marker_known).cast("boolean"), text(n and n.settings_version))
        found.append(F.when(stale, F.struct(F.lit(p.id).alias("phase"), F.lit(p.pos).alias("pos"))))
    if not found:
        return sources.select(*key, F.lit("").alias("phase"), F.lit(0).alias("pos")).limit(0)
    return rows.select(*key, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("p")).select(*key, "p.phase", "p.pos")


def uninstalled(diary: DataFrame, specs: DataFrame) -> DataFrame:
    """(key, phase) of entries whose phase nobody declares any more."""
    return diary.select(*KEY, "phase").join(F.broadcast(specs.select(F.col("id").alias("phase"))), "phase", "left_anti").select(*KEY, "phase")
