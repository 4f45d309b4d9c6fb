"""Sinks; importing the package registers every action."""

from sluicework.sinks import files, kafka, participants, rdb, stores  # noqa: F401
from sluicework.sinks.core import SINKS, write_output

__all__ = ["SINKS", "write_output"]
