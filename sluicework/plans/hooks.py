"""DataFrame -> DataFrame hooks named in a spec.

A hook is a registered name or ``package.module:function``.  The snippet key
wins over the file key; with neither the frame passes through unchanged.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame

from sluicework.registry import Registry

Hook = Callable[[DataFrame], DataFrame]

HOOKS = Registry("hook")


def hook(*names: str) -> Callable[[Hook], Hook]:
    return HOOKS.register(*names)


def resolve_hook(name: str) -> Hook:
    if ":" in name:
        module, _, attribute = name.partition(":")
        return getattr(importlib.import_module(module), attribute)
    return HOOKS.get(name)


def apply_hook(df: DataFrame, snippet: str = "", file: str = "") -> DataFrame:
    name = snippet or file
    return df.transform(resolve_hook(name)) if name else df
