"""Operational events as streams: state per attempt, delivery once by a log of keys, outbox, incremental runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.ids import idempotency_key
from ..operators import state
from ..operators.state import TERMINAL
from ..shipping import ship
from ..sources.readers import exists
from ..sources.sinks import deliver, kept
from ..sources.tables import Store, Table

EVENT_DDL = "event_id string, attempt string, paper_id string, stage string, status string, event_type string, message string, event_at timestamp"
#: What the state of a key holds, in the order of its columns; times are microseconds since 1970.
STATE_FIELDS = "status string, stage string, error_code string, error_message string, started_at long, ended_at long, updated_at long, event_id string"
_FIELDS = [x.split()[0] for x in STATE_FIELDS.split(", ")]
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def event_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The append-only event log as it grows."""
    return spark.readStream.schema(EVENT_DDL).option("maxFilesPerTrigger", max_files).json(path)


def once(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each event once, by its key, as long as the watermark keeps it. ``run_once`` has no such end."""
    return keyed(events).withWatermark("event_at", delay).dropDuplicatesWithinWatermark(["key"])


def keyed(events: DataFrame) -> DataFrame:
    return events.withColumn("key", idempotency_key(F.col("attempt"), F.col("event_id")))


# State


class StateFold(StatefulProcessor):
    """The fold of a key's events: the last status and error, the first start, the last end.

    Events may come late, repeated or in any order: a state is the same whatever the order, and rows leave only when it changes. A
    timer in event time forgets a key ``keep_ms`` after its last event; the table has its state by then.
    """

    def __init__(self, keys: list[str], keep_ms: int) -> None:
        self.names, self.keep_ms = [*keys, *_FIELDS], keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("state", STATE_FIELDS)

    def _due(self, values: tuple) -> int:
        return values[6] // 1000 + self.keep_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        old = tuple(self.held.get()) if self.held.exists() else None
        new = old
        for r in rows:
            new = folded(new, r)
        if new is None or new == old:
            return
        self.held.update(new)
        if old is None or self._due(old) != self._due(new):
            if old is not None:
                self.handle.deleteTimer(self._due(old))
            self.handle.registerTimer(self._due(new))
        yield Row(**dict(zip(self.names, (*key, *new))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def folded(old: tuple | None, e: Row) -> tuple | None:
    """State fields after one event row (status, stage, event_type, message, at, event_id); an event without a time changes nothing."""
    if e.at is None:
        return old
    status = "running" if e.status == "started" else e.status
    failed = status == "failed"
    start, end = (e.at if status == "running" else None), (e.at if status in TERMINAL else None)
    if old is None:
        old_at, started, ended = None, start, end
    else:
        old_at, started, ended = (old[6], old[7] or ""), *old[4:6]
        started = min((x for x in (started, start) if x is not None), default=None)
        ended = max((x for x in (ended, end) if x is not None), default=None)
    if old_at is not None and old_at >= (e.at, e.event_id or ""):
        return (*old[:4], started, ended, *old[6:])
    return (status, e.stage, e.event_type if failed else None, e.message if failed else None, started, ended, e.at, e.event_id)


def state_changes(events: DataFrame, keys: tuple[str, ...] = ("attempt", "paper_id"), delay: str = "7 days", keep_ms: int = 30 * 86_400_000) -> DataFrame:
    """A stream of (keys, state fields): the state of each key that changes. Events that lag more than ``delay`` behind the newest are dropped."""
    ship(events.sparkSession)
    own = [f"__key{n}" for n in range(len(keys))]
    rows = events.withColumns({o: F.col(k) for o, k in zip(own, keys)} | {"at": F.unix_micros("event_at")})
    rows = rows.select(*own, "status", "stage", "event_type", "message", "at", "event_id", "event_at").withWatermark("event_at", delay)
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    ddl = ", ".join([*[f"{o} {kinds[k]}" for o, k in zip(own, keys)], STATE_FIELDS])
    out = rows.groupBy(*own).transformWithState(StateFold(own, keep_ms), ddl, "Update", "EventTime")
    field = lambda x: F.timestamp_micros(x).alias(x) if x.endswith("_at") else F.col(x)
    return out.select(*[F.col(o).alias(k) for o, k in zip(own, keys)], *[field(x) for x in _FIELDS if x not in keys])


def states_table(keys: tuple[str, ...] = ("attempt", "paper_id")) -> Table:
    return Table(tuple(keys))


def merge_states(store: Store, name: str, changes: DataFrame, keys: list[str]) -> None:
    """Fold states into the table: of a key that is there only its row is written anew. A batch that is delivered again leaves the same state."""

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        rows = old.unionByName(new, allowMissingColumns=True)
        return state.fold(rows, keys).drop("n_events").join(rows.groupBy(*keys).agg(F.max(F.struct("updated_at", "event_id"))["event_id"].alias("event_id")), keys)

    store.commit(store.upsert(name, changes, merge=merge))


def run_state(events: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("attempt", "paper_id"), delay: str = "7 days", keep_ms: int = 30 * 86_400_000):
    """Start a query that keeps the state table (``states`` of the store at ``path``) up to date with what is there, then stops.

    State per key is in RocksDB on the executors and in the checkpoint; each micro-batch writes the keys that changed.
    """
    spark = events.sparkSession
    store = Store(spark, path, {"states": states_table(keys)})

    def batch(df: DataFrame, _: int) -> None:
        rows = kept(df, "changes")
        if not rows.isEmpty():
            merge_states(store, "states", rows, list(keys))

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return state_changes(events, keys, delay, keep_ms).writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def states(spark: SparkSession, path: str, keys: tuple[str, ...] = ("attempt", "paper_id")) -> DataFrame | None:
    return Store(spark, path, {"states": states_table(keys)}).read("states")


# Delivery

#: The log of delivered keys: a key never changes, so its layers need no merge, and its hash is what is read first.
DELIVERED = {"delivered": Table(("key",), grows=True)}


def unseen(store: Store, rows: DataFrame) -> DataFrame:
    """Rows (with ``key``) that the log does not hold, each key once, written.

    Whole rows are dealt and sorted once, only those of keys that are new; what is compared with the log are keys alone, for which
    the batch is read once more. First their 64-bit hashes are joined with the hashes in the touched buckets, one short column; only if
    some meet are the keys themselves read, and only keys that are equal are left out.
    """
    alone = lambda df: kept(df.repartition("key").dropDuplicates(["key"]), "fresh")
    if not store.has("delivered"):
        return alone(rows)
    keys = kept(rows.select("key").distinct().withColumn("__h", F.xxhash64("key")), "keys")
    log = store.near("delivered", keys)
    met = kept(keys.select("__h").join(log.select(F.col("hash").alias("__h")), "__h", "left_semi").distinct(), "met")
    if met.isEmpty():
        return alone(rows)
    maybe = kept(keys.join(met, "__h", "left_semi").select("key"), "maybe")
    held = maybe.join(store.near("delivered", maybe).select("key"), "key", "left_semi")
    new = kept(keys.select("key").join(held, "key", "left_anti"), "new")
    return alone(rows.join(new, "key", "left_semi"))


def run_once(events: DataFrame, sink: Callable[[DataFrame], None], outbox: str, log: str, checkpoint: str):
    """Deliver each event's key once, at any distance in time and over restarts, also with a new checkpoint; what the sink refuses lands in the outbox.

    The keys are logged after the sink or the outbox has the rows. A crash between the two delivers that batch
    again: the sink should take a batch's rows twice.
    """
    store = Store(events.sparkSession, log, DELIVERED)

    def batch(df: DataFrame, n: int) -> None:
        rows = unseen(store, df)
        if not rows.isEmpty():
            deliver(rows.drop("key"), sink, outbox, f"{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex}-{n}")
            store.commit(store.upsert("delivered", rows.select("key", F.xxhash64("key").alias("hash")), settled=True))

    return keyed(events).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_delivery(events: DataFrame, sink: Callable[[DataFrame], None], outbox: str, checkpoint: str):
    """Deliver at least once: what the sink refuses lands in the outbox."""
    return events.writeStream.foreachBatch(lambda df, n: deliver(df, sink, outbox, n) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def incremental(spark: SparkSession, source: DataFrame, process: Callable[[DataFrame], DataFrame], done: str, key: str = "paper_id") -> DataFrame:
    """Rows not done before, processed and recorded: a run that stopped goes on where it was. What is returned is read back, not made again."""
    left = source.join(spark.read.parquet(done).select(key).distinct(), key, "left_anti") if exists(spark, done) else source
    run = uuid.uuid4().hex
    out = process(left).withColumn("run", F.lit(run))
    out.write.mode("append").partitionBy("run").parquet(done)
    return spark.read.schema(out.schema).parquet(done).filter(F.col("run") == run).drop("run")
