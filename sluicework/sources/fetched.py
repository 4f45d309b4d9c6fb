"""Sources that call out for their rows: requests, page exports, time ranges.

The calls run in Spark tasks.  What is called is pluggable: a fetcher is a
class named ``module:Class`` that the workers import, so the same source runs
against a service or against landed files.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import importlib
import json
import secrets
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Mapping
from datetime import datetime, timedelta
from urllib.parse import parse_qsl, quote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluicework.functions.dates import parse_text
from sluicework.operators.codec import expand_once
from sluicework.plans.spec import first_of
from sluicework.session import register_source, shared_dir
from sluicework.sources.core import SOURCES
from sluicework.sources.files import declared_schema


def load_class(name: str):
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


# --- one row per request ----------------------------------------------------

RESPONSE_SCHEMA = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("code", T.IntegerType()),
    T.StructField("headers", T.StringType()),
    T.StructField("location", T.StringType()),
])

# Which response part each setting returns.
RESPONSE_PARTS = {
    "BODY": "body", "BODY-BYTES": "body", "CODE": "code", "HEADERS": "headers", "LOCATION": "location",
}


def with_query(uri: str, data: str) -> str:
    if not data:
        return uri
    return f"{uri}&{data}" if "?" in uri else f"{uri}?{data}"


def request_row(properties: Mapping[str, str]) -> dict[str, str]:
    """Source properties -> one request."""
    method = properties.get("method", "GET").upper()
    data = properties.get("data", "")
    headers = dict(json.loads(properties.get("custom_headers") or "{}"))
    oauth, credentials = properties.get("oauthCredStr", ""), properties.get("userCredStr", "")
    if credentials and not oauth:
        headers["Authorization"] = "Basic " + base64.b64encode(credentials.encode()).decode()
    timeouts = properties.get("timeouts", "1000:5000").split(":")
    return {
        "method": "POST" if method == "POST" else "GET",
        "uri": properties["uri"] if method == "POST" else with_query(properties["uri"], data),
        "data": data if method == "POST" else "",
        "headers": json.dumps(headers),
        "oauth": oauth,
        "timeout_ms": str(sum(int(t) for t in timeouts)),
    }


def oauth_header(request: Mapping[str, str], nonce: str, timestamp: int) -> str:
    """OAuth 1.0a header (RFC 5849, HMAC-SHA1) for ``key:secret:token:token_secret``."""
    key, secret, token, token_secret = request["oauth"].split(":")
    fields = {
        "oauth_consumer_key": key, "oauth_nonce": nonce, "oauth_signature_method": "HMAC-SHA1",
        "oauth_timestamp": str(timestamp), "oauth_token": token, "oauth_version": "1.0",
    }
    address = urlsplit(request["uri"])
    sent = [*fields.items(), *parse_qsl(address.query, True), *parse_qsl(request["data"], True)]
    escaped = sorted((quote(k, safe="~"), quote(v, safe="~")) for k, v in sent)
    base = "&".join(quote(part, safe="~") for part in (
        request["method"], f"{address.scheme}://{address.netloc}{address.path}", "&".join(f"{k}={v}" for k, v in escaped)))
    signing_key = f"{quote(secret, safe='~')}&{quote(token_secret, safe='~')}"
    digest = hmac.new(signing_key.encode(), base.encode(), hashlib.sha1).digest()
    fields["oauth_signature"] = base64.b64encode(digest).decode()
    return "OAuth " + ", ".join(f'{k}="{quote(v, safe="~")}"' for k, v in sorted(fields.items()))


def http_fetch(request: Mapping[str, str]) -> dict:
    """Plain HTTP call with the standard library."""
    body = request["data"].encode() if request["method"] == "POST" else None
    headers = json.loads(request["headers"])
    if request.get("oauth"):
        headers["Authorization"] = oauth_header(request, secrets.token_hex(16), int(time.time()))
    call = urllib.request.Request(request["uri"], data=body, headers=headers, method=request["method"])
    with urllib.request.urlopen(call, timeout=int(request["timeout_ms"]) / 1000) as response:
        return {
            "body": response.read().decode("utf-8"),
            "code": response.status,
            "headers": json.dumps(dict(response.headers)),
            "location": response.headers.get("Location"),
        }


def fetch_responses(requests: DataFrame, fetch: Callable[[Mapping[str, str]], dict]) -> DataFrame:
    """Request table -> request columns plus the response, one call per row."""
    schema = T.StructType([*requests.schema.fields, *RESPONSE_SCHEMA.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [fetch(row) for row in batch.to_dict("records")]
            parts = pd.DataFrame(answers, columns=RESPONSE_SCHEMA.fieldNames(), index=batch.index)
            yield pd.concat([batch, parts], axis=1)

    return requests.mapInPandas(run, schema)


def response_rows(responses: DataFrame, part: str = "BODY", schema: T.StructType | str | None = None) -> DataFrame:
    """The chosen response part as JSON rows.

    With a schema the text is parsed in place.  Without one it is written to
    the shared folder first, so inference does not repeat the calls.
    """
    text = responses.select(F.col(RESPONSE_PARTS[part.upper()]).cast("string").alias("value"))
    if schema is not None:
        return expand_once(text, F.from_json("value", schema))
    spark = responses.sparkSession
    path = shared_dir(spark, "responses")
    text.filter("value IS NOT NULL").write.text(path)
    return spark.read.json(path)


@SOURCES.register("rest")
def read_rest(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    fetch = load_class(properties["fetcher"]) if "fetcher" in properties else http_fetch
    requests = (
        spark.read.json(properties["requests_path"]) if "requests_path" in properties
        else spark.createDataFrame([request_row(properties)])
    )
    if "parallelism" in properties:
        requests = requests.repartition(int(properties["parallelism"]))
    return response_rows(
        fetch_responses(requests, fetch), properties.get("respType", "BODY"), declared_schema(properties))


# --- numbered pages ---------------------------------------------------------


class PageFetcher:
    """Numbered pages of records, counted from 1; the first empty page ends them."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = options
        self.page_size = int(first_of(options, "page_size", "page-size", default="500"))

    def page(self, number: int) -> list[dict]:
        raise NotImplementedError

    def pages(self, first: int, last: int) -> Iterable[tuple[int, list[dict]]]:
        for number in range(first, last + 1):
            yield number, self.page(number)

    def last_page(self) -> int:
        """Last page with rows: double until empty, then halve the gap."""
        if not self.page(1):
            return 0
        full, empty = 1, 2
        while self.page(empty):
            full, empty = empty, empty * 2
        while empty - full > 1:
            middle = (full + empty) // 2
            if self.page(middle):
                full = middle
            else:
                empty = middle
        return full


class JsonFilePages(PageFetcher):
    """Landed pages ``<path>/page-<n>.json``, each a JSON array."""

    def page(self, number: int) -> list[dict]:
        try:
            with open(f"{self.options['path']}/page-{number}.json", encoding="utf-8") as handle:
                return json.load(handle)
        except FileNotFoundError:
            return []


class Span(InputPartition):
    def __init__(self, first, last) -> None:
        super().__init__((first, last))


class PagedExport(DataSource):
    """``format("paged_export")``: ``page INT, value STRING`` (one JSON record per row)."""

    @classmethod
    def name(cls) -> str:
        return "paged_export"

    def schema(self) -> str:
        return "page INT, value STRING"

    def reader(self, schema) -> DataSourceReader:
        return PagedExportReader(dict(self.options))


class PagedExportReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = options

    def _fetcher(self) -> PageFetcher:
        return load_class(self.options["fetcher"])(self.options)

    def partitions(self) -> list[Span]:
        last = self._fetcher().last_page()
        step = int(self.options.get("pages_per_task", "10"))
        return [Span(first, min(first + step - 1, last)) for first in range(1, last + 1, step)] or [Span(1, 0)]

    def read(self, partition: Span) -> Iterator[tuple]:
        for number, records in self._fetcher().pages(*partition.value):
            for record in records:
                yield number, json.dumps(record, default=str)


def staged_json(frame: DataFrame, schema: T.StructType | str | None, location: str | None) -> DataFrame:
    """``value`` JSON rows -> typed rows; staged once when types are inferred."""
    if schema is not None:
        return expand_once(frame, F.from_json("value", schema))
    path = location or shared_dir(frame.sparkSession, "pages")
    frame.select("value").write.mode("overwrite").text(path)
    return frame.sparkSession.read.json(path)


@SOURCES.register("knowBe4", "paged")
def read_pages(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    rows = spark.read.format(register_source(spark, PagedExport)).options(**properties).load()
    return staged_json(rows, declared_schema(properties), first_of(properties, "tmp_storage", "tmp-storage"))


# --- time ranges ------------------------------------------------------------


class RangeFetcher:
    """Records of a half-open time range."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = options

    def records(self, start: datetime, end: datetime) -> Iterable[dict]:
        raise NotImplementedError


def slices(start: datetime, end: datetime, minutes: int) -> list[tuple[datetime, datetime]]:
    """Cut ``[start, end)`` into consecutive slices of the given length, the last as long as the rest."""
    if end <= start:
        return []
    step = timedelta(minutes=minutes)
    result, left = [], start
    while left < end:
        result.append((left, min(left + step, end)))
        left += step
    return result


class RangedLog(DataSource):
    """``format("ranged_log")``: ``value STRING`` JSON rows of ``[start, end)``."""

    @classmethod
    def name(cls) -> str:
        return "ranged_log"

    def schema(self) -> str:
        return "value STRING"

    def reader(self, schema) -> DataSourceReader:
        return RangedLogReader(dict(self.options))


class RangedLogReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Span]:
        bounds = slices(
            parse_text(self.options["start"]), parse_text(self.options["end"]),
            int(self.options.get("slice_minutes", "60")))
        return [Span(left, right) for left, right in bounds] or [Span(None, None)]

    def read(self, partition: Span) -> Iterator[tuple]:
        left, right = partition.value
        if left is None:
            return
        fetcher = load_class(self.options["fetcher"])(self.options)
        for record in fetcher.records(left, right):
            yield (json.dumps(record, default=str),)


@SOURCES.register("okta", "ranged")
def read_range(spark: SparkSession, properties: Mapping[str, str]) -> DataFrame:
    """Audit log of ``[start, end)`` typed by the declared schema."""
    rows = spark.read.format(register_source(spark, RangedLog)).options(**properties).load()
    return staged_json(rows, declared_schema(properties), first_of(properties, "tmp_storage", "tmp-storage"))
