"""Running the pipeline with the tenant-state query switched on or off beside it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.streaming.pipeline import Paths, start_pipeline
from tidemark.streaming.tenant_state import start_tenant_state, stored_totals

Arrivals = Callable[[], DataFrame]
# Opens the source of the state query for a generation, at the given offset of each source partition if there are any.
SideArrivals = Callable[[int, dict[str, int] | None], DataFrame]


class TelemetryJob:
    """One main query and, when wanted, one state query with a checkpoint of its own.

    Switching the state query never touches the main query's positions.  Switching it off drains and
    stops it.  Switched on again it goes on from the totals and the positions it had, so records that came in
    between are counted too.  With another number of tasks it cannot use its old checkpoint: a new generation
    takes the totals over as initial state and opens the source where the old one stopped, for which
    ``side_arrivals`` is needed.
    """

    def __init__(
        self, spark: SparkSession, arrivals: Arrivals, paths: Paths, config: PipelineConfig,
        side_arrivals: SideArrivals | None = None,
    ) -> None:
        self.spark = spark
        self.arrivals = arrivals
        self.paths = paths
        self.config = config
        self.side_arrivals = side_arrivals
        self.generation = 0
        self.partitions: int | None = None
        self.position: dict[str, int] | None = None
        self.main: StreamingQuery | None = None
        self.side: StreamingQuery | None = None

    @property
    def tenant_state(self) -> bool:
        return self.side is not None

    def start(self) -> None:
        if self.main is not None and self.main.isActive:
            raise RuntimeError("the pipeline is already running")
        self.main = start_pipeline(self.spark, self.arrivals(), self.paths, self.config)
        if self.config.tenant_state:
            self.switch_tenant_state(True)

    def switch_tenant_state(self, on: bool, parallelism: int | None = None) -> bool:
        """Bring the state query to the wanted mode; False when it was there already.

        ``parallelism`` is how many tasks it is to have, by default as many as before or as configured.
        """
        if on == self.tenant_state:
            return False
        if on:
            self._start_side(parallelism or self.partitions or self.config.parallelism)
        else:
            self.side.processAllAvailable()
            progress = self.side.lastProgress
            if progress is not None and self.side_arrivals is not None:
                self.position = json.loads(progress.json)["sources"][0]["endOffset"]
            self.side.stop()
            self.side = None
        return True

    def _start_side(self, partitions: int) -> None:
        carried = start = None
        if self.partitions not in (None, partitions):
            if self.side_arrivals is None or self.position is None:
                raise ValueError("another number of tasks needs a source that can be opened at a position")
            carried, start = stored_totals(self.spark, self.paths.tenant_state(self.generation)), self.position
            self.generation += 1
        checkpoint = self.paths.tenant_state(self.generation)
        source = self.side_arrivals(self.generation, start) if self.side_arrivals else self.arrivals()
        self.side = start_tenant_state(
            self.spark, source, checkpoint, f"{checkpoint}-output",
            trigger=self.config.trigger, partitions=partitions, carried=carried,
        )
        self.partitions = partitions

    def stop(self) -> None:
        """Finish what has arrived, then stop both queries."""
        for running in (self.main, self.side):
            if running is not None and running.isActive:
                running.processAllAvailable()
                running.stop()
        self.main = self.side = None
