"""When to notify workers about a queue: at once if it is new, else after doubling waits."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: The first wait and the longest, in seconds.
BASE, LONGEST = 20 * 60, 6 * 3600
SCHEMA = "queue long, event_id long, ts timestamp, action string, attempts int"
#: (fingerprint, time of the last notice in seconds, notices so far) of a queue never seen.
NEW = (None, None, 0)


def step(state: tuple, at: float, fingerprint: str | None, has_input: bool, changed_later: bool) -> tuple[tuple, str]:
    """The state after one snapshot, and what is done: idle, wait or dispatch.

    An empty queue (no fingerprint) forgets all. Another fingerprint starts the count anew; the last notice is forgotten
    only if new input is there. A queue that changes while it settles counts as new once notified.
    """
    known, last, n = state
    if fingerprint is None:
        return NEW, "idle"
    same = fingerprint == known
    if not same:
        n = 0
        if has_input:
            last = None
    if last is not None and 0 <= at - last < min(BASE * 2 ** (max(1, n) - 1), LONGEST):
        return (fingerprint, last, n), "wait"
    return (fingerprint, at, (n if same and not changed_later else 0) + 1), "dispatch"


def backoff(snapshots: DataFrame) -> DataFrame:
    """(queue, event_id, ts, action, attempts) for snapshots (queue, event_id, ts, fingerprint, has_input, changed_later).

    A queue's snapshots are read in order of (ts, event_id) by one task as its state allows no other way, but as a
    stream of batches: only the state of the queue at hand is held, however many snapshots it has.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue, state = None, NEW
        for b in batches:
            done = []
            for q, at, f, i, c in zip(b["queue"], b["ts"], b["fingerprint"], b["has_input"], b["changed_later"]):
                if q != queue:
                    queue, state = q, NEW
                state, action = step(state, at.timestamp(), None if pd.isna(f) else f, bool(i), bool(c))
                done.append((action, state[2]))
            yield b[["queue", "event_id", "ts"]].assign(action=[a for a, _ in done], attempts=[n for _, n in done])

    return snapshots.repartition("queue").sortWithinPartitions("queue", "ts", "event_id").mapInPandas(run, SCHEMA)
