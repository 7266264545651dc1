"""Deletion of sources through their phases, in an order that can be resumed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY
from .graph import depths

#: Phases that every engine has.
BUILT_IN = ("parsing_chunking", "embedding")


def delete_gate(sources: DataFrame, diary: DataFrame, specs: DataFrame, active: bool = True) -> DataFrame:
    """(key, route, why): `phases` if a source is deleted phase by phase, else
    `rows`: its rows go and the store's own deletion does the rest. That is so
    when this engine is not the active one, when only built-in phases are
    registered, or when the diary has a phase that no one declares any more."""
    s = sources.select(*KEY).distinct()
    declared = F.broadcast(specs.select(F.col("id").alias("phase")))  # a handful of rows
    if not active:
        return s.withColumns({"route": F.lit("rows"), "why": F.lit("not active")})
    more = specs.where(~F.col("id").isin(*BUILT_IN)).head(1)
    if not more:
        return s.withColumns({"route": F.lit("rows"), "why": F.lit("only built-in phases")})
    lost = diary.select(*KEY, "phase").join(declared, "phase", "left_anti").groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set("phase")), ",").alias("lost"))
    out = s.join(lost, list(KEY), "left")
    return out.select(*KEY, F.when(F.col("lost").isNull(), "phases").otherwise("rows").alias("route"), F.when(F.col("lost").isNotNull(), F.concat(F.lit("uninstalled: "), F.col("lost"))).alias("why"))


def deleted_phases(status: DataFrame) -> DataFrame:
    """(key, phase) that a deletion has been through, from the extra of status rows."""
    done = F.filter(F.split(F.coalesce(F.col("extra")["deleted_phases"], F.lit("")), ","), lambda p: p != "")
    return status.select(*KEY, F.explode(done).alias("phase"))


def delete_plan(sources: DataFrame, specs: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """(key, phase, step): the phases that deletion still has to go through, in
    reverse order of execution (deepest first, then the last one declared)."""
    order = F.broadcast(depths(specs).select(F.col("id").alias("phase"), "pos", "depth"))  # a handful of rows
    grid = sources.select(*KEY).distinct().join(order)
    if done is not None:
        grid = grid.join(done.select(*KEY, "phase"), [*KEY, "phase"], "left_anti")
    return grid.select(*KEY, "phase", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("depth"), F.desc("pos"))).alias("step"))


def progress(done: DataFrame) -> Column:
    """The text under which done (array of phases) is kept in extra."""
    return F.create_map(F.lit("deleted_phases"), F.array_join(done, ","))


def orphan_steps(orphans: DataFrame) -> DataFrame:
    """(key, step, action) for sources whose chat is gone: points first, then
    the diary, and only then the row is completed."""
    actions = F.array(*map(F.lit, ("delete points", "clear diary", "complete")))
    return orphans.select(*KEY, F.posexplode(actions).alias("step", "action"))


def images_to_remove(points: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, image_file) of derived images of sources; the file of a source itself is never among them."""
    p = points.where("coalesce(image, false) and coalesce(image_file, '') <> ''").withColumn("scope", F.coalesce("chat_id", F.lit("agent")))
    return p.join(sources.select(*KEY).distinct(), list(KEY), "left_semi").where("image_file <> source").select(*KEY, "image_file").distinct()


def chat_rows(status: DataFrame, agent_id: str, chat_id: str) -> DataFrame:
    """Rows of one conversation."""
    return status.where((F.col("agent_id") == agent_id) & (F.col("scope") == chat_id))


def changed_rows(diary: DataFrame, phases: list[str]) -> DataFrame:
    """(agent_id, n): rows of each agent, in any scope, that a reset of phases changes."""
    return diary.where(F.col("phase").isin(*phases)).select(*KEY).distinct().groupBy("agent_id").agg(F.count("*").alias("n"))
