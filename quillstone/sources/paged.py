"""A paged service as a data source: page ranges as partitions, filters that the service applies, retries, a shared rate, and a stream of what is new."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..shipping import ship

#: Filters that a service may be asked to apply, and their names in its conditions.
CONDITIONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
Condition = tuple[str, str, object]


@dataclass
class Pages(InputPartition):
    """Rows from first to end of what the service gives under the conditions; ``end`` None: until a page is not full."""

    first: int
    end: int | None
    conditions: tuple[Condition, ...]
    share: int = 1


@dataclass(frozen=True)
class Service:
    """``fetch(conditions, offset, size)`` gives rows as tuples in a fixed order, ``count(conditions)`` their number if the service knows it.

    A page that fails is asked for again after a pause that doubles from ``base`` seconds up to ``longest``, ``tries`` times; the
    pages before it are not. ``rate`` requests a second are shared by the partitions of a scan, of which there are at most ``most``: a
    larger service has more pages in each.
    """

    fetch: Callable[[list[Condition], int, int], list[tuple]]
    count: Callable[[list[Condition]], int] | None = None
    filters: tuple[str, ...] = ()
    size: int = 100
    pages_per_task: int = 10
    most: int = 1000
    tries: int = 5
    base: float = 1.0
    longest: float = 30.0
    rate: float | None = None

    def page(self, conditions: list[Condition], offset: int, size: int) -> list[tuple]:
        for k in range(self.tries):
            try:
                return self.fetch(conditions, offset, size)
            except Exception:  # noqa: BLE001  whatever the service raises is tried again
                if k + 1 == self.tries:
                    raise
                time.sleep(min(self.longest, self.base * 2**k))
        return []

    def rows(self, part: Pages) -> Iterator[tuple]:
        at, conditions = part.first, list(part.conditions)
        while part.end is None or at < part.end:
            began = time.monotonic()
            page = self.page(conditions, at, self.size if part.end is None else min(self.size, part.end - at))
            yield from map(tuple, page)
            at += len(page)
            if not page or part.end is None and len(page) < self.size:
                return
            if self.rate:
                time.sleep(max(0.0, part.share / self.rate - (time.monotonic() - began)))

    def split(self, conditions: list[Condition], first: int = 0, end: int | None = None) -> list[Pages]:
        if end is None and self.count:
            end = self.count(conditions)
        if end is None:
            return [Pages(first, None, tuple(conditions))]
        step = self.size * max(self.pages_per_task, -(-(end - first) // (self.size * self.most)))
        starts = range(first, end, step)
        return [Pages(s, min(s + step, end), tuple(conditions), len(starts)) for s in starts]


def register_paged(spark: SparkSession, name: str, service: Service, ddl: str) -> None:
    """Make the service readable as ``spark.read.format(name)`` and, if it counts its rows, as ``spark.readStream.format(name)``.

    Comparisons of the service's ``filters`` with constants go to the service; others stay with Spark. A stream's
    offset is the number of rows that the service has; its rows must be in the order of their arrival.
    """
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")

    class Reader(DataSourceReader):
        def __init__(self) -> None:
            self.conditions: list[Condition] = []

        def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
            for f in filters:
                if type(f) in CONDITIONS and len(f.attribute) == 1 and f.attribute[0] in service.filters:
                    self.conditions.append((f.attribute[0], CONDITIONS[type(f)], f.value))
                else:
                    yield f

        def partitions(self) -> list[Pages]:
            return service.split(self.conditions)

        def read(self, partition: Pages) -> Iterator[tuple]:
            return service.rows(partition)

    class StreamReader(DataSourceStreamReader):
        def initialOffset(self) -> dict:  # noqa: N802
            return {"rows": 0}

        def latestOffset(self) -> dict:  # noqa: N802
            return {"rows": service.count([])}

        def partitions(self, start: dict, end: dict) -> list[Pages]:
            return service.split([], start["rows"], end["rows"])

        def read(self, partition: Pages) -> Iterator[tuple]:
            return service.rows(partition)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ddl

        def reader(self, schema) -> DataSourceReader:
            return Reader()

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
            if service.count is None:
                raise ValueError("a stream needs a service that counts its rows")
            return StreamReader()

    spark.dataSource.register(Source)
