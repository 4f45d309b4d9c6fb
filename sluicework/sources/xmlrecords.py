"""XML documents to rows: records by path, one column per path, namespaces by prefix map.

Documents are rows of a frame, so Spark splits the work over them; each is walked
once by an event parser that keeps the open elements as a stack.  An element whose
place matches the record path opens a record, inside another record too, and every
element and attribute is offered to the records it lies in.  What a path of
elements means for the record and its columns is worked out once per task.

Paths are made of ``/`` (child) and ``//`` (at any depth) steps: ``name``,
``prefix:name``, ``*``, and at the end of a column's path ``@name``, ``text()`` or
``.``; a path without a leading slash starts at the document.  For a column the
record is the document.  A prefix of the namespace map stands for its URI,
whatever prefix the document uses; without the map, or for a prefix it lacks, only
local names count.

Defined results: a column is the text of the first match in document order, null
if there is none or it is empty; records without any value are dropped; null and
empty documents have no records; a document that is not well-formed is an error,
or is left out as a whole with ``malformed="drop"``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluicework.session import ship_package

# Paths of elements a task remembers the meaning of.
REMEMBERED = 20_000
STEP = re.compile(r"(//|/|^)(@?)(\*|text\(\)|\.|[^\W\d][\w.-]*(?::(?:\*|[^\W\d][\w.-]*))?)")
Name = tuple[str, str]


class Path:
    """A compiled path: steps of (any depth, URI or None, local name or None), and what it takes at its end."""

    def __init__(self, text: str, namespaces: Mapping[str, str]) -> None:
        self.steps: list[tuple[bool, str | None, str | None]] = []
        self.attribute: tuple[str | None, str | None] | None = None
        at = 0
        while at < len(text):
            found = STEP.match(text, at)
            if not found or self.attribute is not None or (at and not found[1]):
                raise ValueError(f"not a path of steps: {text!r}")
            deep, is_attribute, name = found[1] == "//", bool(found[2]), found[3]
            at = found.end()
            if name in (".", "text()"):
                if at < len(text) or is_attribute or deep:
                    raise ValueError(f"{name} may only end a path: {text!r}")
                continue
            prefix, _, local = name.rpartition(":")
            test = (namespaces.get(prefix) if prefix else None, None if local == "*" else local)
            if is_attribute:
                self.attribute = test
            else:
                self.steps.append((deep, *test))
        if not self.steps:
            raise ValueError(f"a path names at least one element: {text!r}")

    def matches(self, place: Sequence[Name]) -> bool:
        """Whether the elements from the document's root down to one are what the path says."""
        # ``open``: numbers of steps that may be done when so many elements are read.
        reached = {0}
        for at, (uri, local) in enumerate(place):
            after = set()
            for done in reached:
                if done < len(self.steps):
                    deep, wanted_uri, wanted = self.steps[done]
                    if deep:
                        after.add(done)
                    if wanted in (None, local) and wanted_uri in (None, uri):
                        after.add(done + 1)
            reached = after
            if not reached:
                return False
            if at + 1 < len(place):
                reached.discard(len(self.steps))
        return len(self.steps) in reached


def split_name(name: str) -> Name:
    uri, _, local = name.rpartition(" ")
    return uri, local


class Walk:
    """Records of documents, by one parse each."""

    def __init__(self, record: str, columns: Mapping[str, str], namespaces: Mapping[str, str]) -> None:
        self.record = Path(record, namespaces)
        if self.record.attribute is not None:
            raise ValueError(f"a record is an element: {record!r}")
        self.columns = [Path(text, namespaces) for text in columns.values()]
        self.opens: dict[tuple[Name, ...], bool] = {}
        self.takes: dict[tuple[Name, ...], tuple[list[int], list[int]]] = {}

    def opened(self, place: tuple[Name, ...]) -> bool:
        if place not in self.opens:
            if len(self.opens) >= REMEMBERED:
                self.opens.clear()
            self.opens[place] = self.record.matches(place)
        return self.opens[place]

    def taken(self, place: tuple[Name, ...]) -> tuple[list[int], list[int]]:
        """The columns an element of a record gives by its text, and those it gives by an attribute."""
        if place not in self.takes:
            if len(self.takes) >= REMEMBERED:
                self.takes.clear()
            match = [i for i, path in enumerate(self.columns) if path.matches(place)]
            self.takes[place] = ([i for i in match if self.columns[i].attribute is None],
                                 [i for i in match if self.columns[i].attribute is not None])
        return self.takes[place]

    def __call__(self, document: str) -> list[list[str | None]]:
        """The columns of every record with a value, in document order; an expat.ExpatError if not well-formed."""
        stack: list[Name] = []
        records: list[list[str | None]] = []
        # Open records as (depth, values), open texts as (depth, pieces, values, column).
        inside: list[tuple[int, list[str | None]]] = []
        texts: list[tuple[int, list[str], list[str | None], int]] = []

        def start(name: str, attributes: dict[str, str]) -> None:
            stack.append(split_name(name))
            place = tuple(stack)
            if self.opened(place):
                values: list[str | None] = [None] * len(self.columns)
                records.append(values)
                inside.append((len(stack) - 1, values))
            for depth, values in inside:
                by_text, by_attribute = self.taken(place[depth:])
                for column in by_text:
                    if values[column] is None:
                        values[column] = ""
                        texts.append((len(stack), [], values, column))
                for column in by_attribute:
                    uri, local = self.columns[column].attribute
                    for key, value in attributes.items():
                        key_uri, key_local = split_name(key)
                        if values[column] is None and local in (None, key_local) and uri in (None, key_uri):
                            values[column] = value

        def end(name: str) -> None:
            while texts and texts[-1][0] == len(stack):
                _, pieces, values, column = texts.pop()
                values[column] = "".join(pieces)
            stack.pop()
            if inside and inside[-1][0] == len(stack):
                inside.pop()

        def said(data: str) -> None:
            for _, pieces, _, _ in texts:
                pieces.append(data)

        parser = expat.ParserCreate("utf-8", " ")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, said
        parser.Parse(document.encode(), True)
        given = ([value or None for value in values] for values in records)
        return [values for values in given if any(value is not None for value in values)]


def xml_rows(
    documents: DataFrame, column: str, record: str, columns: Mapping[str, str], namespaces: Mapping[str, str] | None = None,
    keep: Sequence[str] = (), malformed: str = "fail",
) -> DataFrame:
    """One row per record: the ``keep`` columns of its document, then a text column per path."""
    if malformed not in ("fail", "drop"):
        raise ValueError(f"malformed is fail or drop, not {malformed!r}")
    Walk(record, columns, namespaces or {})
    ship_package(documents.sparkSession)
    source = documents.select(*keep, column)
    schema = T.StructType([*(source.schema[name] for name in keep), *(T.StructField(name, T.StringType()) for name in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(record, columns, namespaces or {})
        for batch in batches:
            found, of = [], []
            for at, document in enumerate(batch.column(len(keep)).to_pylist()):
                if not document or not document.strip():
                    continue
                try:
                    rows = walk(document)
                except expat.ExpatError as error:
                    if malformed == "drop":
                        continue
                    raise ValueError(f"XML document not well-formed: {error}") from error
                found += rows
                of += [at] * len(rows)
            kept = batch.take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(i) for i in range(len(keep))),
                 *(pa.array([row[i] for row in found], pa.string()) for i in range(len(columns)))], schema.names)

    return source.mapInArrow(run, schema)
