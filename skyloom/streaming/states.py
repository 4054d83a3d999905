"""The state of runs over a stream of events: what is open, ended or lost, with custom state and timeouts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "run_id string, status string, n_events long, n_failures long, last_event string"
_STATE = "n_events long, n_failures long, status string, last_event string, last_ms long"
#: Fixed names of the event that ends a run, and of statuses.
END, OPEN, LOST = "run_end", "open", "lost"


def run_states(events: DataFrame, silent: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """One row for each run and batch in which its state changes: open, the status of its end, or lost.

    A run without an end is lost when event time goes ``silent`` past its last event; an event that comes
    for it later opens it again.  Use with output mode update.
    """
    silent_ms = int(pd.Timedelta(silent).total_seconds() * 1000)

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, bad, status, last, at = state.get if state.exists else (0, 0, OPEN, None, 0)
        if state.hasTimedOut:
            status = LOST
        else:
            for b in batches:
                b = b.sort_values("at", kind="stable")
                n += len(b)
                bad += int((b["status"] == "failure").sum())
                if status not in (OPEN, LOST):  # an end stays the end
                    continue
                ends = b[b["event"] == END]
                row = ends.iloc[0] if len(ends) else b.iloc[-1]
                status, last = (row["status"] if len(ends) else OPEN), row["event"]
                at = max(at, int(b["at"].max().value // 1_000_000))
        state.update((n, bad, status, last, at))
        if status == OPEN:
            state.setTimeoutTimestamp(max(at + silent_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"run_id": [key[0]], "status": [status], "n_events": [n], "n_failures": [bad], "last_event": [last]})

    rows = events.where("at IS NOT NULL AND run_id IS NOT NULL").select("run_id", "event", "status", "at").withWatermark("at", late)
    return rows.groupBy("run_id").applyInPandasWithState(follow, OUT, _STATE, "update", GroupStateTimeout.EventTimeTimeout)
