"""Queue watchers with state of their own: when to notify workers again, and when failures have become a streak.

They need the RocksDB state store: set ``spark.sql.streaming.stateStore.providerClass`` to ``ROCKS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from visitgraph.operators.dispatch import NEW, SCHEMA, step

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAK = 3


class Backoff(StatefulProcessor):
    """One state a queue: the fingerprint last seen, when workers were last notified, and how often."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("queue", "fingerprint string, last double, attempts int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = tuple(self.state.get()) if self.state.exists() else NEW
        shots = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        done = []
        for at, fingerprint, fresh, changed in zip(shots["ts"], shots["fingerprint"], shots["has_input"], shots["changed_later"], strict=True):
            now, action = step(now, at.timestamp(), None if pd.isna(fingerprint) else fingerprint, bool(fresh), bool(changed))
            done.append((action, now[2]))
        if now == NEW:
            self.state.clear()
        else:
            self.state.update(now)
        yield shots[["queue", "event_id", "ts"]].assign(action=[a for a, _ in done], attempts=[n for _, n in done])

    def close(self) -> None:
        pass


class Streak(StatefulProcessor):
    """Counts a source's failures since its last success; one alert when they reach ``STREAK``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("failures", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = int(self.state.get()[0]) if self.state.exists() else 0
        events = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        alert = []
        for failed in events["failed"]:
            n = n + 1 if failed else 0
            alert.append(n == STREAK)
        if n:
            self.state.update((n,))
        else:
            self.state.clear()
        yield events.loc[alert, ["user_id", "event_id", "ts"]]

    def close(self) -> None:
        pass


def backoff_stream(snapshots: DataFrame) -> DataFrame:
    """(queue, event_id, ts, action, attempts) of a stream of snapshots, as ``operators.dispatch.backoff`` of a table.

    A queue's snapshots count in order of (ts, event_id) within a micro-batch; between micro-batches in order of arrival.
    A task holds one queue's rows of one micro-batch, and the queue's state; an empty queue's state is dropped.
    """
    return snapshots.groupBy("queue").transformWithStateInPandas(Backoff(), SCHEMA, "Append", "None")


def streak_alerts(events: DataFrame) -> DataFrame:
    """(user_id, event_id, ts): the third failure in a row of each source, once a streak; other events don't count.

    ``events`` has user_id, event_id, ts and failed (null: neither failure nor success).
    """
    counted = events.where("failed IS NOT NULL").select("user_id", "event_id", "ts", "failed")
    return counted.groupBy("user_id").transformWithStateInPandas(Streak(), "user_id long, event_id long, ts timestamp", "Append", "None")
