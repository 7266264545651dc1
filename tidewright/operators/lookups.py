"""Lookups in the settings table (key, category, name, config, value, updated_at)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunker_name, material_settings, phase_settings_key

#: Fixed value: the name under which this engine is chosen.
ENGINE_NAME = "TidewrightIngestion"


def latest_settings(settings: DataFrame) -> DataFrame:
    """The last row of each (key, category, name)."""
    return settings.groupBy("key", "category", "name").agg(F.max_by(F.struct("config", "value"), "updated_at").alias("s")).select("key", "category", "name", F.col("s.config").alias("config"), F.col("s.value").alias("value"))


def selected(settings: DataFrame, category: str) -> DataFrame:
    """(key, name, config, value): what is chosen in a category for each key; of several names the last written."""
    s = settings.where(F.col("category") == category)
    return s.groupBy("key").agg(F.max_by(F.struct("name", "config", "value"), F.struct("updated_at", "name")).alias("s")).select("key", "s.*")


def chunker_names(agents: DataFrame, settings: DataFrame, default: str | None = None) -> DataFrame:
    """(agent_id, chunker_name): by saved settings, else the default, else null."""
    s = selected(settings, "chunker").select(F.col("key").alias("agent_id"), chunker_name(F.col("name"), F.col("config")).alias("_saved"))
    return agents.select("agent_id").distinct().join(s, "agent_id", "left").select("agent_id", F.coalesce("_saved", F.lit(default)).alias("chunker_name"))


def phase_settings(agents: DataFrame, specs: DataFrame, settings: DataFrame) -> DataFrame:
    """(agent_id, phase, value): the settings that a phase of an agent depends
    on, credentials left out. The embedder's are the system's. A phase without a
    category has none; where a category has no row, `declared` says so; where
    the row has no value, `<phase>:unknown` does."""
    grid = agents.select("agent_id").distinct().join(F.broadcast(specs.select(F.col("id").alias("phase"), "settings_category")))  # a handful of phases for each agent
    grid = grid.withColumn("key", phase_settings_key(F.col("phase"), F.col("agent_id")))
    chosen = settings.groupBy("key", "category").agg(F.max_by(F.struct("value", F.lit(True).alias("there")), F.struct("updated_at", "name")).alias("s"))
    rows = grid.join(chosen.withColumnRenamed("category", "settings_category"), ["key", "settings_category"], "left")
    mark = lambda k, v: F.create_map(F.lit(k), v)
    value = (
        F.when(F.col("settings_category").isNull(), F.create_map().cast("map<string,string>"))
        .when(F.col("s.there").isNull(), mark("declared", F.concat(F.col("phase"), F.lit(":"), F.col("settings_category"))))
        .when(F.col("s.value").isNull(), mark("marker", F.concat(F.col("phase"), F.lit(":unknown"))))
        .otherwise(material_settings(F.col("s.value")))
    )
    return rows.select("agent_id", "phase", value.alias("value"))


def settings_marker(config: Column, value: Column) -> Column:
    """The text that marks settings: an object with config and the material
    value, keys sorted, a space behind colons and commas. Null without a config."""
    text = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)  # noqa: E731  a string as JSON
    pairs = F.array_sort(F.map_entries(material_settings(value)))
    inner = F.array_join(F.transform(pairs, lambda p: F.concat(text(p["key"]), F.lit(": "), F.coalesce(text(p["value"]), F.lit("null")))), ", ")
    return F.when(config.isNotNull(), F.concat(F.lit('{"config": '), text(config), F.lit(', "value": {'), inner, F.lit("}}")))


def engine_names(agents: DataFrame, settings: DataFrame) -> DataFrame:
    """(agent_id, name, active): the ingestion engine that is chosen for an
    agent, else for the system; active if it is this one."""
    s = selected(settings, "ingestion").select(F.col("key"), "name")
    own = agents.select("agent_id").distinct().join(s.select(F.col("key").alias("agent_id"), F.col("name").alias("_own")), "agent_id", "left")
    every = F.broadcast(s.where("key = 'system:agent'").select(F.col("name").alias("_all")))  # one row at most
    name = F.coalesce("_own", "_all")
    return own.join(every, how="left").select("agent_id", name.alias("name"), F.coalesce(name == ENGINE_NAME, F.lit(False)).alias("active"))


def source_filter(source: Column, chat_id: Column, wanted: Column, wanted_chat: Column | None = None) -> Column:
    """The store's own filter of a source: unlike matches_source() it takes the
    points of all chats where no chat is asked for."""
    same = F.coalesce(source == wanted, F.lit(False))
    return same if wanted_chat is None else same & F.when(wanted_chat.isNull(), True).otherwise(F.coalesce(chat_id == wanted_chat, F.lit(False)))


def byte_origin(sources: DataFrame, memory: DataFrame, persisted: DataFrame, disk: DataFrame, url: str | None = None) -> DataFrame:
    """(agent_id, scope, source, origin): where the bytes of a source come from.
    memory, disk: (agent_id, scope, name); persisted: (agent_id, scope, name) of
    stored copies of urls, under persisted_url_name(). A url without a copy is
    downloaded. url is a boolean column of sources that tells urls; without it
    they begin with http. A null source is one of its own."""
    from ..functions.text import persisted_url_name

    def flagged(s, df, flag, on):
        there = df.select(F.col("agent_id").alias("_a"), F.col("scope").alias("_s"), F.col("name").alias("_n")).distinct().withColumn(flag, F.lit(True))
        return s.join(there, (F.col("agent_id") == F.col("_a")) & (F.col("scope") == F.col("_s")) & F.col(on).eqNullSafe(F.col("_n")), "left").drop("_a", "_s", "_n")

    is_url = F.startswith("source", F.lit("http")) if url is None else F.col(url)
    s = sources.select("agent_id", "scope", "source", F.coalesce(is_url, F.lit(False)).alias("_url")).distinct().withColumn("_copy", persisted_url_name(F.col("source")))
    s = flagged(flagged(flagged(s, memory, "_m", "source"), persisted, "_p", "_copy"), disk, "_d", "source")
    origin = F.when(F.col("_m"), "memory").when(F.col("_url") & F.col("_p"), "copy").when(F.col("_url"), "download").when(F.col("_d"), "disk").otherwise("missing")
    return s.select("agent_id", "scope", "source", origin.alias("origin"))
