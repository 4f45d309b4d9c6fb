"""All registered queries by name."""

from __future__ import annotations

import importlib

from sluicework.catalog.core import Query

MODULES = ("pipelines", "messages", "extracts", "quality", "records", "retries", "monitoring", "landed", "streams", "planning")


def _catalogs():
    for module in MODULES:
        try:
            yield importlib.import_module(f"{__name__}.{module}").CATALOG
        except ModuleNotFoundError as error:
            if error.name != f"{__name__}.{module}":
                raise


def queries() -> dict[str, Query]:
    return {name: fn for catalog in _catalogs() for name, fn in catalog.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for catalog in _catalogs() for name, text in catalog.sql.items()}
