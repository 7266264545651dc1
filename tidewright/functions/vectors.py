"""Predicates on points and their vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_vector(v: Column) -> Column:
    """Not empty, all components finite, and longer than 1e-12."""
    d = v.cast("array<double>")
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.coalesce((F.size(d) > 0) & finite & (norm > 1e-12), F.lit(False))


def point_key(point_id: Column, payload_id: Column) -> Column:
    return F.coalesce(point_id, payload_id)


def matches_source(source: Column, chat_id: Column, wanted: Column, wanted_chat: Column) -> Column:
    """Same source, and the same chat; a point without a chat belongs to the agent."""
    same_chat = F.when(wanted_chat.isNotNull(), chat_id == wanted_chat).otherwise(F.coalesce(chat_id, F.lit("")) == "")
    return F.coalesce((source == wanted) & same_chat, F.lit(False))


def is_card(flag: Column, key: Column, card_key: Column) -> Column:
    """A catalogue card: flagged, and under its deterministic id. A flag alone may be stale."""
    return F.coalesce(flag, F.lit(False)) & F.coalesce(key == card_key, F.lit(False))
