"""Sources; importing the package registers every format."""

from sluicework.sources import changes, fetched, files, kafka, reports, stores  # noqa: F401
from sluicework.sources.core import SOURCES, STREAMS, read_input, read_stream

__all__ = ["SOURCES", "STREAMS", "read_input", "read_stream"]
