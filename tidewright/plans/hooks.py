"""Hooks: named functions that plugins register with a manager. There is one
manager for the system and one for an agent."""

from __future__ import annotations

import inspect
import logging
from collections.abc import Callable, Iterable
from typing import Any

log = logging.getLogger(__name__)


class Veto(Exception):
    """Raised by a hook to stop what it was asked about; never swallowed."""


class Canceled(Exception):
    """Raised where work goes on for an agent that is being deleted."""


class MissingHook(KeyError):
    """A manager has no function of that name."""


def accepts(function: Callable, keyword: str) -> bool:
    """Whether a function takes a keyword, by name or with all others."""
    try:
        parameters = inspect.signature(function).parameters.values()
    except (TypeError, ValueError):
        return False
    return any(p.kind is p.VAR_KEYWORD or p.name == keyword and p.kind is not p.POSITIONAL_ONLY and p.kind is not p.VAR_POSITIONAL for p in parameters)


class Manager:
    """Functions by hook name, in the order of their priority (higher first), then of registration."""

    def __init__(self, name: str = "system") -> None:
        self.name = name
        self._hooks: dict[str, list[tuple[int, Callable]]] = {}

    def add(self, hook: str, function: Callable, priority: int = 1) -> Manager:
        self._hooks.setdefault(hook, []).append((priority, function))
        self._hooks[hook].sort(key=lambda x: -x[0])
        return self

    def has(self, hook: str) -> bool:
        return bool(self._hooks.get(hook))

    def registrants(self, hook: str) -> list[Callable]:
        return [f for _, f in self._hooks.get(hook, ())]

    def _call(self, f: Callable, args: tuple, caller: Any) -> Any:
        return f(*args, **({self.caller_keyword: caller} if caller is not None and accepts(f, self.caller_keyword) else {}))

    @property
    def caller_keyword(self) -> str:
        """Under what name the caller is given: the system's is the lizard, an agent's the cat."""
        return "lizard" if self.name == "system" else "cat"

    def run(self, hook: str, *args: Any, caller: Any = None) -> Any:
        """The first answer that is not None. MissingHook if nobody registered."""
        if not self.has(hook):
            raise MissingHook(hook)
        return next((out for f in self.registrants(hook) if (out := self._call(f, args, caller)) is not None), None)

    def fold(self, hook: str, value: Any, *args: Any, caller: Any = None) -> Any:
        """value passed through all functions; None keeps it. A veto is raised, other errors are logged and keep it."""
        for f in self.registrants(hook):
            try:
                out = self._call(f, (value, *args), caller)
            except Veto:
                raise
            except Exception as e:  # noqa: BLE001 - one plugin must not stop the others
                log.warning("hook %s: %s failed: %s", hook, getattr(f, "__name__", f), e)
                continue
            value = value if out is None else out
        return value


def managers(system: Manager | None, agent: Manager | None) -> list[Manager]:
    """System, then agent, each once."""
    return [m for i, m in enumerate((system, agent)) if m is not None and not (i and m is system)]


def run_or_default(manager: Manager | None, hook: str, *args: Any, default: Any = None, caller: Any = None) -> Any:
    """The answer of a hook, or the default, with a warning, where the hook is missing."""
    if manager is None:
        return default
    try:
        return manager.run(hook, *args, caller=caller)
    except MissingHook as e:
        if e.args != (hook,):  # of another hook that was called inside
            raise
        log.warning("hook %s is missing; the default is used", hook)
        return default


def run_on_all(found: Iterable[Manager], hook: str, *args: Any, default: Any = None, caller: Any = None) -> Any:
    """Every function runs and errors are raised; the last answer that is not None."""
    out = default
    for m in found:
        for f in m.registrants(hook):
            answer = m._call(f, args, caller)
            out = out if answer is None else answer
    return out


def fold_all(found: Iterable[Manager], hook: str, value: Any, *args: Any, caller: Any = None) -> Any:
    """value passed through the functions of all managers, system first."""
    for m in found:
        value = m.fold(hook, value, *args, caller=caller)
    return value


def fold_shared(system: Manager | None, agent: Manager | None, hook: str, value: Any, *args: Any, caller: Any = None) -> Any:
    """The same with the agent's manager first."""
    return fold_all([m for m in (agent, system if system is not agent else None) if m is not None], hook, value, *args, caller=caller)


def first_compatible(manager: Manager | None, hook: str, *args: Any, caller: Any = None, default: Any = None) -> Any:
    """The answer of the first function that takes these arguments and does not fail."""
    for f in manager.registrants(hook) if manager is not None else ():
        try:
            inspect.signature(f).bind(*args, **({manager.caller_keyword: caller} if accepts(f, manager.caller_keyword) else {}))
        except (TypeError, ValueError):
            continue
        try:
            return manager._call(f, args, caller)
        except Exception as e:  # noqa: BLE001 - a marker that cannot be made is a missing one
            log.warning("hook %s: %s failed: %s", hook, getattr(f, "__name__", f), e)
    return default
