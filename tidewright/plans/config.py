"""Settings of the engine, from arguments and the environment."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

#: Defaults in seconds.
HEARTBEAT, LEASE, RESUME, NOT_READY, RETRY, DOWNLOAD, LOCK = 30.0, 1800.0, 300.0, 3600.0, 5.0, 1800.0, 300.0


def number(value: object) -> float | None:
    """A finite number that is not negative, else None; a boolean is no number."""
    if isinstance(value, bool):
        return None
    try:
        x = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return x if math.isfinite(x) and x >= 0 else None


def not_ready_budget(declared: object, env: object = None, generic: object = None) -> float:
    """Seconds a phase may stay not ready: its own variable, what it declares, the general variable, the default."""
    for value in (env, declared, generic):
        if (x := number(value)) is not None:
            return x
    return NOT_READY


@dataclass(frozen=True)
class EngineConfig:
    max_concurrency: int = 5
    lease: float = LEASE
    heartbeat: float = HEARTBEAT
    boot_stale: float | None = None
    download_stale: float = RESUME
    #: Seconds after which the heartbeat of a download gives up, a claim may take a row over, and a lock is free again.
    download_heartbeat: float = DOWNLOAD
    claim_after: float = 0.0
    lock_timeout: float = LOCK
    #: Seconds between sweeps; none or 0 for no sweeps but the first.
    sweep_every: float | None = None
    resume: bool = True
    collect_garbage: bool = True
    #: Jobs run in a scheduler pool of their own where workers is above 0; niceness above 0 gives it a lower weight.
    workers: int = 0
    niceness: int = 0

    def __post_init__(self) -> None:
        if self.max_concurrency < 1:
            object.__setattr__(self, "max_concurrency", 1)

    @property
    def boot_threshold(self) -> float:
        """Age from which a row left by an earlier process may be taken up."""
        if self.boot_stale is not None:
            return self.boot_stale
        return max(30.0, 2 * self.heartbeat) if self.heartbeat > 0 else 60.0

    @property
    def pool(self) -> str | None:
        """The scheduler pool of the engine's jobs, if it has one."""
        return f"tidewright-{self.niceness}" if self.workers > 0 else None

    @property
    def download_threshold(self) -> float:
        return max(self.boot_threshold, self.download_stale)

    @classmethod
    def load(cls, values: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None) -> EngineConfig:
        """From a mapping, where the older name reembed_max_concurrency is taken if the newer one is absent, and variables TIDEWRIGHT_*."""
        values, env = dict(values or {}), os.environ if env is None else env
        if (old := values.pop("reembed_max_concurrency", None)) is not None:
            values.setdefault("max_concurrency", old)
        flag = lambda k: str(env.get(k, "true")).strip().lower() not in ("0", "false", "no", "off")
        pick = lambda k, d: x if (x := number(env.get(k))) is not None else d
        base = {
            "lease": pick("TIDEWRIGHT_LEASE", LEASE), "heartbeat": pick("TIDEWRIGHT_HEARTBEAT", HEARTBEAT), "download_stale": pick("TIDEWRIGHT_RESUME", RESUME), "boot_stale": pick("TIDEWRIGHT_BOOT", None), "download_heartbeat": pick("TIDEWRIGHT_DOWNLOAD", DOWNLOAD),
            "claim_after": pick("TIDEWRIGHT_CLAIM_AFTER", 0.0), "lock_timeout": pick("TIDEWRIGHT_LOCK", LOCK), "sweep_every": pick("TIDEWRIGHT_SWEEP", None), "workers": int(pick("TIDEWRIGHT_WORKERS", 0.0)), "niceness": int(pick("TIDEWRIGHT_NICENESS", 0.0)), "resume": flag("TIDEWRIGHT_RESUME_ENABLED"), "collect_garbage": flag("TIDEWRIGHT_GC_ENABLED"),
        }
        return cls(**(base | values))

    @staticmethod
    def engine_class() -> type:
        from .engine import Engine

        return Engine


def allowed_engines(allowed: list[type]) -> list[type]:
    """The configurations of engines that may be chosen, with this one."""
    return allowed if EngineConfig in allowed else [*allowed, EngineConfig]
