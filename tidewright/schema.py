"""Table schemas of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

OWNER = "struct<pod:string,pid:int,boot:string>"
WARNING = "struct<code:string,message:string>"
#: One phase of one source. An absent entry means pending; marker_known parts a null marker from an unknown one.
ENTRY = f"struct<state:string,reason:string,started_at:double,owner:{OWNER},tag:string,attempt:int,marker:string,marker_known:boolean,settings_version:string,deps:map<string,string>,warnings:array<{WARNING}>>"

STATUS = (
    "agent_id string, scope string, source string, chat_id string, type string, status string, error string, error_at double, created_at double, "
    "updated_at double, phase string, embedder_name string, chunker_name string, resume_created boolean, extra map<string,string>"
)
#: Changes of a status row, in the order of seq; null means unchanged.
STATUS_EVENT = "agent_id string, scope string, source string, seq long, ts double, type string, chat_id string, status string, error string, phase string, clear_phase boolean, embedder_name string, chunker_name string, resume_created boolean, extra map<string,string>"
DIARY = f"agent_id string, scope string, source string, phase string, pos int, entry {ENTRY}"
DIARY_EVENT = f"agent_id string, scope string, source string, phase string, seq long, removed boolean, entry {ENTRY}"
SPECS = "id string, label string, pos int, settings_category string, depends_on array<string>, settings_check array<string>"
SETTINGS = "key string, category string, name string, config string, value map<string,string>, updated_at string"
POINTS = (
    "agent_id string, collection string, point_id string, payload_id string, source string, chat_id string, page_content string, hash string, `when` double, "
    "image boolean, image_file string, is_catalogue_card boolean, is_catalogue_card_segment boolean, chunk_index int, start_index int, extra map<string,string>, vector array<float>"
)
#: Events of markers: the last one of an agent and kind counts, and cleared takes it away.
MARKERS = "agent_id string, kind string, seq long, expires_at double, cleared boolean"
#: Answers `not ready` of phases, starts and stops of heartbeats, and takings and releases of locks.
WAITS = "agent_id string, scope string, source string, phase string, seq long, ts double, retry_after string, reason string"
TIMERS = "agent_id string, scope string, source string, seq long, ts double, interval double, max_seconds double"
LOCKS = "name string, owner string, seq long, ts double, ttl double"
RESULT = f"source string, status string, reason string, processed int, expected int, warnings array<{WARNING}>"
KEY = ("agent_id", "scope", "source")

#: Lifecycle states of a source with their labels, in the order of the pipeline.
LIFECYCLE = (
    ("uploaded", "Uploaded"),
    ("downloading", "Downloading"),
    ("downloaded", "Downloaded"),
    ("processing", "Processing"),
    ("reindexing", "Re-indexing"),
    ("deleting", "Deleting"),
    ("completed", "Completed"),
    ("error", "Error"),
)
#: States of a phase that are stored.
PHASE_STATES = ("processing", "complete", "error", "skipped")


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
