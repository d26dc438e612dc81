"""The routing configuration as a running job sees it."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import changes
from ..schemas import ROUTING


class RoutingConfig:
    """Routing rows, read again when older than `every` seconds.

    A reload adds and replaces rows and removes none. A configuration without rows is an error.
    """

    def __init__(self, read: Callable[[], DataFrame], every: float = 5.0, clock: Callable[[], float] = time.monotonic):
        self._read, self._every, self._clock = read, every, clock
        self._rows: dict[tuple, tuple] = {}
        self._read_at: float | None = None

    def current(self, spark: SparkSession) -> DataFrame:
        now = self._clock()
        if self._read_at is None or now - self._read_at >= self._every:
            # One row for each table and operation of the shop's database, whatever the number of its changes.
            self._rows = changes.merged_routing(self._rows, self._read().select(*ROUTING.names).collect())
            self._read_at = now
        if not self._rows:
            raise RuntimeError("the routing configuration has no rows")
        return changes.routing_rows(spark, list(self._rows.values()))
