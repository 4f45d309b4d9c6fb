"""Pipeline specs: JSON in, dataclasses out, plus variable substitution."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

REQUIRED_KEYS = ("class", "input", "output", "query")

# How the last part of a spec's "class" selects a runner.
RUNNER_KINDS = {
    "basicbatch": "batch",
    "basicreal": "real",
    "basicstreamingreal": "real_static",
    "batch": "batch",
    "real": "real",
    "real_static": "real_static",
}

SAVE_MODES = ("append", "overwrite", "ignore", "errorifexists")


class SpecError(ValueError):
    """A spec is missing something the runner needs."""


@dataclass(frozen=True)
class PipelineSpec:
    name: str
    kind: str
    inputs: tuple[dict[str, str], ...]
    query: str
    outputs: tuple[dict[str, str], ...]
    hook_file: str = ""
    hook_snippet: str = ""
    sql_conf: dict[str, str] = field(default_factory=dict)
    watermark: dict[str, str] = field(default_factory=dict)
    app_name: str = ""


def _as_strings(mapping: Mapping[str, object]) -> dict[str, str]:
    return {k: v if isinstance(v, str) else json.dumps(v) for k, v in mapping.items()}


def _document(config: str | Mapping) -> Mapping:
    if isinstance(config, Mapping):
        return config
    if config.lstrip().startswith("{"):
        return json.loads(config)
    with open(config, encoding="utf-8") as handle:
        return json.load(handle)


def load_pipeline(config: str | Mapping, name: str) -> PipelineSpec:
    """Read one pipeline from a spec document (mapping, JSON text or file)."""
    document = _document(config)
    try:
        body = document["process"][name]
    except KeyError:
        raise SpecError(f"pipeline '{name}' is not in the spec") from None
    missing = [key for key in REQUIRED_KEYS if key not in body]
    if missing:
        raise SpecError(f"pipeline '{name}' lacks {', '.join(missing)}")
    kind = RUNNER_KINDS.get(body["class"].rsplit(".", 1)[-1].lower())
    if kind is None:
        raise SpecError(f"pipeline '{name}': unknown class '{body['class']}'")
    return PipelineSpec(
        name=name,
        kind=kind,
        inputs=tuple(_as_strings(item) for item in body["input"]),
        query=body["query"],
        outputs=tuple(_as_strings(item) for item in body["output"]),
        hook_file=body.get("custom_process_file", ""),
        hook_snippet=body.get("custom_process_code_snippet", ""),
        sql_conf=_as_strings(body.get("sql_conf", {})),
        watermark=_as_strings(body.get("watermark", {})),
        app_name=document.get("appName", ""),
    )


def enabled_pipelines(config: str | Mapping) -> dict[str, dict[str, str]]:
    """Pipelines whose ``isEnabled`` is exactly ``"true"``, with their properties."""
    actions = _document(config)["process"]["actions"]
    return {
        name: _as_strings(body.get("properties", {}))
        for name, body in actions.items()
        if body.get("isEnabled") == "true"
    }


def run_variables(args: Iterable[str]) -> dict[str, str]:
    """``k=v`` run arguments; only the first ``=`` separates."""
    pairs = (arg.split("=", 1) for arg in args if "=" in arg)
    return {key.strip(): value for key, value in pairs}


def merge_properties(*layers: Mapping[str, str]) -> dict[str, str]:
    """Later layers win."""
    merged: dict[str, str] = {}
    for layer in layers:
        merged.update(layer)
    return merged


def substitute(text: str, variables: Mapping[str, str]) -> str:
    """Replace ``#name`` literally, longest name first.

    Longest first keeps ``#date`` from eating the front of ``#date_to``.
    """
    for name in sorted(variables, key=len, reverse=True):
        text = text.replace(f"#{name}", str(variables[name]))
    return text


def substitute_all(properties: Mapping[str, str], variables: Mapping[str, str]) -> dict[str, str]:
    return {key: substitute(value, variables) for key, value in properties.items()}


def save_mode(properties: Mapping[str, str]) -> str:
    mode = properties.get("mode", "append").lower()
    return mode if mode in SAVE_MODES else "append"


def column_list(text: str | None) -> list[str]:
    """``"a, b"`` -> ``["a", "b"]``."""
    return [part.strip() for part in text.split(",")] if text else []


def flag(properties: Mapping[str, str], key: str, default: bool = False) -> bool:
    value = properties.get(key)
    return default if value is None else value.strip().lower() == "true"


def first_of(properties: Mapping[str, str], *keys: str, default: str | None = None) -> str | None:
    """First present key; lets specs use either spelling of a setting."""
    for key in keys:
        if key in properties:
            return properties[key]
    return default
