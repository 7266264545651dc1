"""Words, token estimates, keys and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters at which a text is cut into words: what Unicode calls white space, and the four separators 0x1C to 0x1F.
SPACES = r"(?U)[\s\x1c-\x1f]+"
#: A setting is a credential, and no part of a phase's identity, when its name holds one of these.
CREDENTIALS = ("api_key", "apikey", "secret", "password", "token", "credential")


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("long")


def token_estimate(text: Column) -> Column:
    """A third of the characters, one at least: for embedders without a tokenizer."""
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(text, F.lit(""))) / 3)).cast("long")


def source_type(source: Column, is_url: Column | None = None) -> Column:
    url = F.startswith(source, F.lit("http"))
    return F.when(url if is_url is None else url | F.coalesce(is_url, F.lit(False)), "url").otherwise("file")


def scope_of(chat_id: Column) -> Column:
    return F.coalesce(F.nullif(chat_id, F.lit("")), F.lit("agent"))


def delete_scope(scope: Column, caller: Column) -> Column:
    return F.coalesce(F.nullif(scope, F.lit("")), caller, F.lit("agent"))


def collection_for(scope: Column) -> Column:
    return F.when(scope == "agent", "declarative").otherwise("episodic")


def storage_path(agent: Column, scope: Column) -> Column:
    return F.concat_ws("/", agent, F.when(scope != "agent", scope))


def status_key(agent: Column, scope: Column, source: Column) -> Column:
    return F.concat(F.lit("agents:"), agent, F.lit(":ingestion:"), scope, F.lit(":"), F.sha2(F.encode(source, "UTF-8"), 256))


def delete_marker_key(agent: Column) -> Column:
    return F.concat(F.lit("agents:"), agent, F.lit(":ingestion:delete"))


def maintenance_marker_key(agent: Column) -> Column:
    return F.concat(F.lit("agents:"), agent, F.lit(":ingestion:maintenance"))


def heartbeat_key(agent: Column, scope: Column, source: Column) -> Column:
    return F.concat_ws(":", agent, scope, source)


def phase_settings_key(phase: Column, agent_key: Column) -> Column:
    system = F.lit("system:agent")
    return F.when(phase == "embedding", system).otherwise(F.coalesce(agent_key, system))


def chunker_name(name: Column, config: Column) -> Column:
    """The saved name, else the configuration, trimmed, without a Settings suffix unless that is all there is."""
    given = F.coalesce(F.nullif(F.trim(name), F.lit("")), F.nullif(F.trim(config), F.lit("")))
    return F.nullif(F.regexp_replace(given, "(?<=.)Settings$", ""), F.lit(""))


def material_settings(value: Column) -> Column:
    """Settings without credentials; null is empty."""
    empty = F.create_map().cast("map<string,string>")
    hidden = lambda k: F.exists(F.array(*map(F.lit, CREDENTIALS)), lambda c: F.contains(F.lower(k), c))
    return F.coalesce(F.map_filter(value, lambda k, _: ~hidden(k)), empty)


def persisted_url_name(url: Column) -> Column:
    """url_{16 digits of its hash}_{stem}{extension}: the last part of the path,
    index if it has none, with everything but letters, digits, dot, dash and
    underscore replaced. Stems are cut at 80 characters, extensions at 12."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    last = F.coalesce(F.nullif(F.substring_index(path, "/", -1), F.lit("")), F.lit("index"))
    ext = F.regexp_extract(last, r"[^.].*?(\.[^.]*)$", 1)
    bare = F.when(F.length(ext) > 0, F.regexp_replace(last, r"\.[^.]*$", "")).otherwise(last)
    kept = F.left(F.regexp_replace(ext, r"[^\p{L}\p{N}.]", ""), F.lit(12))
    whole = F.concat(F.lit("url_"), F.left(F.sha2(F.encode(url, "UTF-8"), 256), F.lit(16)), F.lit("_"), F.left(bare, F.lit(80)), kept)
    return F.regexp_replace(whole, r"[^\p{L}\p{N}._-]", "_")


def uuid5_hex(name: Column, namespace: str = "6ba7b8119dad11d180b400c04fd430c8") -> Column:
    """Version-5 UUID (RFC 4122, URL namespace unless another is given) as 32 hex digits."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15))


def catalogue_card_id(agent: Column, chat_id: Column, source: Column, index: Column | None = None, start_index: Column | None = None) -> Column:
    """Deterministic id of a catalogue card, or of a segment of one."""
    by_index = F.lit("") if index is None else F.when(index != 0, F.concat(F.lit(":"), index.cast("string"))).otherwise("")
    tail = F.coalesce(by_index, F.lit(""))
    if start_index is not None:
        by_start = F.when(start_index == 0, "").otherwise(F.concat(F.lit(":s"), start_index.cast("string")))
        tail = F.when(start_index.isNotNull(), by_start).otherwise(tail)
    return uuid5_hex(F.concat(F.lit("catalogue_card:"), agent, F.lit(":"), F.coalesce(chat_id, F.lit("")), F.lit(":"), source, tail))


def missing_product(content_bytes: Column, chunks: Column) -> Column:
    """Why a parse that read bytes and made no chunks is an error; null if it is none."""
    return F.when((content_bytes > 0) & (chunks == 0), F.concat(F.lit("parsing produced no chunks from "), content_bytes.cast("string"), F.lit(" bytes")))


def missing_points(to_embed: Column, stored: Column) -> Column:
    return F.when((to_embed > 0) & (stored == 0), F.concat(F.lit("embedding stored no points for "), to_embed.cast("string"), F.lit(" point(s)")))
