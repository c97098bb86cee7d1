"""Stateful alerts: silence per source and cooldown per rule.

Both need a memory across batches and one of them a timer without input, which no
aggregate offers; the per-key state is a single number.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ALERTS = "source string, kind string, last_write_ms bigint, at_ms bigint"


def silence_alerts(writes: DataFrame, limit_ms: int = 600_000) -> DataFrame:
    """(source, at_ms) writes to one alert per silence and one recovery notice.

    A source that stays away is reported by its timer; one that returns within the
    same batch is reported from the gap between its writes. Run it under a processing
    time trigger: a timer keeps an available-now query from ever being done.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        (source,) = key
        last, silent = state.get if state.exists else (None, False)
        out = []
        if state.hasTimedOut:
            if not silent and last is not None:
                out.append((source, "silent", last, last + limit_ms))
            state.update((last, True))
        else:
            instants = sorted(at for pdf in batches for at in pdf["at_ms"].unique())
            for at in instants:
                if last is not None and at - last > limit_ms:
                    if not silent:
                        out.append((source, "silent", int(last), int(last) + limit_ms))
                    out.append((source, "recovered", int(last), int(at)))
                    silent = False
                elif silent:
                    out.append((source, "recovered", int(last), int(at)))
                    silent = False
                last = int(at) if last is None else max(int(at), int(last))
            state.update((int(last), silent))
            state.setTimeoutDuration(limit_ms)
        yield pd.DataFrame(out, columns=["source", "kind", "last_write_ms", "at_ms"])

    return writes.groupBy("source").applyInPandasWithState(
        step, ALERTS, "last bigint, silent boolean", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def cooled_down_alerts(candidates: DataFrame, cooldown_ms: int = 1_800_000) -> DataFrame:
    """(rule, at_ms) candidates to the ones sent: at most one per rule and cooldown."""

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        (rule,) = key
        last = state.get[0] if state.exists else None
        sent = []
        for at in sorted(int(a) for pdf in batches for a in pdf["at_ms"].unique()):
            if last is None or at - last >= cooldown_ms:
                sent.append((rule, at))
                last = at
        if last is not None:
            state.update((last,))
        yield pd.DataFrame(sent, columns=["rule", "at_ms"])

    return candidates.groupBy("rule").applyInPandasWithState(
        step, "rule string, at_ms bigint", "last bigint", "append", GroupStateTimeout.NoTimeout
    )
