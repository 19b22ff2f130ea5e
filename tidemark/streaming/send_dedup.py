"""Repeated sends removed from a stream without losing a late original.

Which sends have been seen is kept in managed state, one entry for each (run, sequence), and expires by processing
time.  Event time plays no part: a record that arrives hours late is passed on if its send is new, and a replay of it
is removed.  A window on event time would drop both.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SEND_KEY = ["producer_run_id", "producer_sequence"]
STATE_NAME = "seen_sends"
KEEP_MS = 24 * 3_600_000


class FirstOfSend(StatefulProcessor):
    """Passes on the first record of a send; repeats within ``keep_ms`` of processing time go."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState(STATE_NAME, "seen boolean", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = not self.seen.exists()
        for chunk in rows:
            if new and len(chunk):
                new = False
                self.seen.update((True,))
                yield chunk.head(1)

    def close(self) -> None:
        pass


def distinct_sends(records: DataFrame, keep_ms: int = KEEP_MS) -> DataFrame:
    """A stream of records with one row for each send, all columns kept; needs RocksDB as state store.

    State that expires by processing time keeps the query busy, so ``processAllAvailable`` does not end on it; use an
    available-now trigger to work off what waits.  Of repeats in one micro-batch any one stays.  ``keep_ms`` bounds the state and must exceed the time after
    which a sender or a recovery still repeats sends.
    """
    return records.groupBy(*SEND_KEY).transformWithStateInPandas(
        statefulProcessor=FirstOfSend(keep_ms), outputStructType=records.schema, outputMode="Append", timeMode="ProcessingTime"
    )
