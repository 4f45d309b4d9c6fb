import json

import pytest

from sluicework.plans import spec
from sluicework.plans.hooks import apply_hook, hook, resolve_hook
from sluicework.registry import Registry, UnknownNameError
from sluicework.sinks import SINKS
from sluicework.sources import SOURCES

DOC = {"appName": "a", "process": {"P": {
    "class": "some.package.processor.BasicBatch",
    "input": [{"format": "file", "alias": "x", "limit": 3}],
    "query": "select 1",
    "output": [{"query": "select * from #process", "action_class": "x.y.WriteToConsole"}]}}}


def test_load_pipeline_defaults(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps(DOC))
    for source in (DOC, json.dumps(DOC), str(path)):
        loaded = spec.load_pipeline(source, "P")
        assert loaded.kind == "batch"
        assert (loaded.hook_file, loaded.hook_snippet) == ("", "")
        assert loaded.inputs[0]["limit"] == "3"


@pytest.mark.parametrize("key", spec.REQUIRED_KEYS)
def test_missing_key_is_named(key):
    body = {k: v for k, v in DOC["process"]["P"].items() if k != key}
    with pytest.raises(spec.SpecError, match=key):
        spec.load_pipeline({"process": {"P": body}}, "P")


def test_unknown_pipeline_and_class():
    with pytest.raises(spec.SpecError):
        spec.load_pipeline(DOC, "Q")
    with pytest.raises(spec.SpecError, match="unknown class"):
        spec.load_pipeline({"process": {"P": {**DOC["process"]["P"], "class": "Other"}}}, "P")


def test_enabled_only_exact_true():
    actions = {"a": {"isEnabled": "true", "properties": {"window": "5 seconds"}}, "b": {"isEnabled": "True"},
               "c": {"isEnabled": "false"}, "d": {}}
    assert spec.enabled_pipelines({"process": {"actions": actions}}) == {"a": {"window": "5 seconds"}}


def test_run_variables_split_once():
    assert spec.run_variables(["date=2024-01-01", "uri=http://x/?a=b c", "flag"]) == {
        "date": "2024-01-01", "uri": "http://x/?a=b c"}


def test_substitute_longest_first_and_literal():
    assert spec.substitute("#date #date_to", {"date": "$1", "date_to": "\\2"}) == "$1 \\2"


def test_merge_right_wins():
    assert spec.merge_properties({"a": "1", "b": "1"}, {"b": "2"}, {"b": "3", "c": "3"}) == {"a": "1", "b": "3", "c": "3"}


@pytest.mark.parametrize("given,mode", [
    ("Overwrite", "overwrite"), ("IGNORE", "ignore"), ("errorifexists", "errorifexists"), ("other", "append"), (None, "append")])
def test_save_mode(given, mode):
    assert spec.save_mode({} if given is None else {"mode": given}) == mode


def test_column_list():
    assert spec.column_list(" a, b ,c") == ["a", "b", "c"]
    assert spec.column_list(None) == []


def test_registry_error_lists_known_names():
    registry = Registry("thing")
    registry.register("One")(lambda: 1)
    assert registry.get("oNE")() == 1
    with pytest.raises(UnknownNameError, match="unknown thing 'two'; known: one"):
        registry.get("two")


def test_every_format_and_action_is_registered():
    # Format and action names of specs.
    formats = (
        "kafka", "mongo", "elastic", "s3", "rdb", "redis", "bigquery", "rest", "file", "sfdc", "okta", "knowBe4", "o365",
        "snowflake", "peopleai")
    actions = (
        "WriteToConsole", "WriteToElastic", "WriteToFile", "WriteToKafka", "WriteToRDB", "WriteToRedis",
        "WriteZoomParticipantDevice")
    assert all(name in SOURCES for name in formats)
    assert all(name in SINKS for name in actions)


@hook("tests.double")
def double(df):
    return df.selectExpr("id * 2 AS id")


def test_hooks(spark):
    df = spark.range(3)
    assert apply_hook(df) is df
    assert [r[0] for r in apply_hook(df, "tests.double", "never.used").collect()] == [0, 2, 4]
    assert resolve_hook("os.path:basename")("/a/b") == "b"
    with pytest.raises(UnknownNameError):
        apply_hook(df, "no such hook")
