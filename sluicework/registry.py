"""Name -> function tables for sources, sinks and hooks."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class UnknownNameError(LookupError):
    """A spec names something that is not registered."""


class Registry:
    """Case-insensitive lookup with a clear error for unknown names."""

    def __init__(self, kind: str) -> None:
        self.kind = kind
        self._items: dict[str, Callable[..., Any]] = {}

    def register(self, *names: str) -> Callable[[Callable[..., Any]], Callable[..., Any]]:
        def decorate(fn: Callable[..., Any]) -> Callable[..., Any]:
            for name in names:
                self._items[name.lower()] = fn
            return fn

        return decorate

    def get(self, name: str) -> Callable[..., Any]:
        try:
            return self._items[name.lower()]
        except KeyError:
            known = ", ".join(sorted(self._items))
            raise UnknownNameError(f"unknown {self.kind} '{name}'; known: {known}") from None

    def names(self) -> list[str]:
        return sorted(self._items)

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._items
