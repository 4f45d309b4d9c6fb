"""Incident suppression on a stream: keyed state with timers.

The state of an application is the time of its last incident.  An alert that comes
more than an hour after it (or first) is raised and becomes the last one; others
are dropped.  An event-time timer at the end of that hour removes the state when
the watermark passes it, so state is kept only for applications that were raised
lately.  The alerts of one application inside a micro-batch are taken in time order,
whatever order they arrive in; over micro-batches an alert is judged when it arrives.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluicework.operators.monitor import SUPPRESS_SECONDS
from sluicework.plans.hooks import hook

# Stateful operators with timers need this state store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Suppression(StatefulProcessor):
    """Passes an application's alerts that are due and remembers the last one passed, in epoch microseconds."""

    def __init__(self, columns: list[str], time: str, suppress_seconds: int) -> None:
        self.columns, self.time, self.suppress = columns, time, suppress_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A micro-batch holds few alerts of one application, or the source caps it.
        alerts = pd.concat(list(rows)).sort_values([self.time, *(c for c in self.columns if c != self.time)], kind="stable")
        times = alerts[self.time].astype("datetime64[us]").astype("int64").tolist()
        found = self.last.get()
        last, raised = found[0] if found else None, []
        for at, time in enumerate(times):
            if last is None or last < time - self.suppress:
                last = time
                raised.append(at)
        if raised:
            self.last.update((last,))
            # Timers are in milliseconds; the state may go once no alert in time can fall into the hour.
            self.handle.registerTimer((last + self.suppress) // 1000 + 1)
            yield alerts.iloc[raised][self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self.last.get()
        if found and (found[0] + self.suppress) // 1000 + 1 <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


def suppressed(
    alerts: DataFrame, name: str = "name", time: str = "alert_time", suppress_seconds: int = SUPPRESS_SECONDS,
    delay: str = "1 hour",
) -> DataFrame:
    """The alerts of a stream that raise an incident; columns as they are.

    ``time`` is a timestamp; alerts later than ``delay`` behind the newest one, and alerts without a name or a time,
    are dropped.  The session must use the state store :data:`STATE_STORE`.
    """
    # The process that prepares a stateful operator sees no shipped files, so the processor travels whole.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    known = alerts.where(F.col(name).isNotNull() & F.col(time).isNotNull())
    if not known.isStreaming:
        raise ValueError("suppressed() takes a stream; for a frame see monitor.incidents_to_raise")
    return known.withWatermark(time, delay).groupBy(name).transformWithStateInPandas(
        statefulProcessor=Suppression(alerts.columns, time, suppress_seconds), outputStructType=alerts.schema,
        outputMode="Append", timeMode="EventTime")


@hook("incidents.suppressed")
def suppressed_hook(df: DataFrame) -> DataFrame:
    """For specs: a stream with the columns ``name`` and ``alert_time``."""
    return suppressed(df)


def folded(times: list[datetime], suppress_seconds: int = SUPPRESS_SECONDS) -> list[datetime]:
    """What an application's sorted alert times raise, for one key at a time."""
    raised: list[datetime] = []
    for time in times:
        if not raised or (time - raised[-1]).total_seconds() > suppress_seconds:
            raised.append(time)
    return raised
