"""Recursive configuration fingerprints. Columns build them from text that is
already canonical; the graph of phases is small and is resolved on the driver."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


class TagError(ValueError):
    """A graph of phases that has no tags: an unknown dependency."""


class TagCycleError(TagError):
    """A graph of phases that has no tags: a cycle, which the message names."""


def canonical_json(value: Any) -> str:
    """One text for equal values: sorted keys, no spaces, letters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def own_tag(kind: str, settings: Any) -> str:
    return digest(f"{kind}:{canonical_json(settings)}")


def compose_tag(own: str, depends: Iterable[str], tags: Mapping[str, str]) -> str:
    """A phase's own tag together with those of what it depends on; without dependencies the bar stays."""
    return digest(own + "|" + "|".join(f"{d}={tags[d]}" for d in sorted(depends)))


def declared_tag(phase: str, category: str | None, depends: Iterable[str]) -> str:
    return f"{phase}:{category or '-'}:{','.join(depends)}"


def fallback_tag(phase: str, category: str | None, depends: Iterable[str]) -> str:
    return compose_tag(own_tag(phase, declared_tag(phase, category, depends)), (), {})


def relevant_settings(value: Any, check: Callable[[Any], Any] | Iterable[str] | str | None = None) -> Any:
    """The part of the settings that a phase depends on: all, what a function makes of them, one key or some keys."""
    if check is None:
        return value
    if callable(check):
        return check(value)
    keys = [check] if isinstance(check, str) else list(check)
    return {k: value[k] for k in keys if k in value} if isinstance(value, Mapping) else {}


def unresolved(waiting: Mapping[str, Any]) -> TagCycleError:
    """The cycle among phases (id to phase) none of which can be resolved."""
    path = [next(iter(waiting))]
    while path[-1] not in path[:-1]:
        path.append(next(d for d in waiting[path[-1]].depends_on if d in waiting))
    return TagCycleError("phases depend on each other: " + " -> ".join(path[path.index(path[-1]) :]))


def resolve_tags(settings: Mapping[str, Any], phases: Iterable[Any]) -> dict[str, str]:
    """Tags of all phases, a fold from those without dependencies on. A phase
    says its own tag (tag(settings)); of equal ids the first counts; a phase
    without settings has empty ones."""
    waiting: dict[str, Any] = {}
    for p in phases:
        waiting.setdefault(p.id, p)
    known, tags = set(waiting), {}
    for p in waiting.values():
        if lost := [d for d in p.depends_on if d not in known]:
            raise TagError(f"phase {p.id} depends on {lost[0]}, which is not known")
    while waiting:
        ready = [p for p in waiting.values() if all(d in tags for d in p.depends_on)]
        if not ready:
            raise unresolved(waiting)
        for p in ready:
            tags[p.id] = compose_tag(p.tag(settings.get(p.id, {})), p.depends_on, tags)
            del waiting[p.id]
    return tags


def current_tag(settings: Mapping[str, Any], phases: Iterable[Any], phase: str) -> str:
    """The tag of one phase; where the graph has no tags, one of its declaration."""
    phases = list(phases)
    try:
        return resolve_tags(settings, phases)[phase]
    except TagError:
        p = next(p for p in phases if p.id == phase)
        return fallback_tag(p.id, getattr(p, "settings_category", None), p.depends_on)


def own_tag_column(kind: Column, canonical: Column) -> Column:
    return F.sha2(F.concat(kind, F.lit(":"), canonical), 256)


def compose_tag_column(own: Column, depends: Column, tags: Column) -> Column:
    """own: a tag; depends: array of ids; tags: map of their tags."""
    parts = F.transform(F.array_sort(depends), lambda d: F.concat(d, F.lit("="), tags[d]))
    return F.sha2(F.concat(own, F.lit("|"), F.array_join(parts, "|")), 256)
