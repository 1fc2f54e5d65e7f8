import json
import random

from pyspark.sql import functions as F

from quillstone.operators import state
from quillstone.sources.sinks import deliver
from quillstone.streaming import events as S


def put(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def event(n, status, at, attempt="a"):
    return {"event_id": f"e{n}", "attempt": attempt, "paper_id": "p", "stage": "s", "status": status, "event_type": "t", "message": "m", "event_at": f"2024-01-01T00:00:{at:02d}Z"}


def test_state_stream(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    states, check = str(tmp_path / "state"), str(tmp_path / "check")
    put(log, "1.json", [event(1, "started", 1), event(2, "succeeded", 5, "b")])
    S.run_state(S.event_stream(spark, str(log)), states, check).awaitTermination()
    put(log, "2.json", [event(3, "failed", 3)])
    S.run_state(S.event_stream(spark, str(log)), states, check).awaitTermination()
    got = {r.attempt: (r.status, r.started_at is not None, r.ended_at is not None, r.error_code) for r in S.states(spark, states).collect()}
    assert got == {"a": ("failed", True, True, "t"), "b": ("succeeded", False, True, None)}


def test_stream_equals_batch(spark, tmp_path):
    """Events late, repeated and shuffled over many files: the table is what the batch fold gives, and each change writes its keys."""
    rng, log = random.Random(4), tmp_path / "log"
    log.mkdir()
    events = [{**event(n, rng.choice(["started", "running", "failed", "succeeded", "skipped", "odd"]), rng.randrange(60), f"a{rng.randrange(9)}"), "paper_id": f"p{rng.randrange(5)}"} for n in range(300)]
    given = events + rng.sample(events, 100)
    rng.shuffle(given)
    states, check = str(tmp_path / "state"), str(tmp_path / "check")
    for k in range(0, 400, 100):
        put(log, f"{k}.json", given[k : k + 100])
        S.run_state(S.event_stream(spark, str(log), 1), states, check).awaitTermination()
    rows = spark.read.schema(S.EVENT_DDL).json(str(log)).distinct()
    want = state.fold(state.events_to_states(rows), ["attempt", "paper_id"])
    columns = ["attempt", "paper_id", "status", "stage", "error_code", "error_message", "started_at", "ended_at", "updated_at"]
    got = S.states(spark, states).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*columns).collect()))
    again = S.run_state(S.event_stream(spark, str(log), 1), states, check)
    again.awaitTermination()
    assert sorted(map(str, S.states(spark, states).select(*columns).collect())) == sorted(map(str, got.collect()))


def test_state_is_forgotten_and_still_right(spark, tmp_path):
    """A timer in event time empties old state; an event that comes later still is folded with the table's row."""
    log = tmp_path / "log"
    log.mkdir()
    states, check = str(tmp_path / "state"), str(tmp_path / "check")
    at = lambda n, status, day, attempt="a": {**event(n, status, 0, attempt), "event_at": f"2024-01-{day:02d}T00:00:00Z"}
    counts = []
    for name, rows in (("1", [at(1, "started", 1), at(2, "failed", 2)]), ("2", [at(3, "started", 20, "b")]), ("3", [at(4, "running", 21, "b")]), ("4", [at(5, "succeeded", 21)])):
        put(log, f"{name}.json", rows)
        q = S.run_state(S.event_stream(spark, str(log)), states, check, delay="1 day", keep_ms=3 * 86_400_000)
        q.awaitTermination()
        counts.append(sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"]))
    got = {r.attempt: (r.status, r.started_at.day, r.ended_at and r.ended_at.day) for r in S.states(spark, states).collect()}
    assert got == {"a": ("succeeded", 1, 21), "b": ("running", 20, None)}
    assert counts[1:3] == [1, 1]  # two attempts came: the state of the first is gone, the table has it


def test_delivered_once_over_restarts(spark, tmp_path, monkeypatch):
    log = tmp_path / "log"
    log.mkdir()
    seen, outbox, keys = [], str(tmp_path / "outbox"), str(tmp_path / "keys")
    sink = lambda df: seen.extend(r.event_id for r in df.collect())

    def run(check):
        S.run_once(S.event_stream(spark, str(log)), sink, outbox, keys, str(tmp_path / check)).awaitTermination()

    put(log, "1.json", [event(1, "started", 1), event(1, "started", 1), event(2, "failed", 2)])
    run("c1")
    put(log, "2.json", [event(2, "failed", 2), {**event(3, "failed", 2), "event_at": "2031-01-01T00:00:00Z"}])
    run("c1")
    put(log, "3.json", [event(1, "started", 1), event(1, "started", 1, "b")])  # years behind the newest
    run("c1")
    run("c2")
    assert sorted(seen) == ["e1", "e1", "e2", "e3"]
    rows = spark.createDataFrame([("x",), ("y",)], "key string")
    store = S.Store(spark, str(tmp_path / "other"), S.DELIVERED)
    store.commit(store.upsert("delivered", rows.filter("key = 'x'").select("key", F.xxhash64(F.lit("y")).alias("hash"))))  # a hash that is another key's
    monkeypatch.setattr(store, "near", lambda name, df: store.read(name))
    assert sorted(r.key for r in S.unseen(store, rows).collect()) == ["x", "y"]


def test_once_and_outbox(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    put(log, "1.json", [event(1, "started", 1), event(1, "started", 1), event(2, "failed", 2)])
    seen = []

    def sink(df):
        seen.append(df.count())
        raise OSError("down")

    outbox = str(tmp_path / "outbox")
    S.run_delivery(S.once(S.event_stream(spark, str(log))), sink, outbox, str(tmp_path / "check")).awaitTermination()
    assert sum(seen) == 2 and spark.read.json(outbox).count() == 2


def test_incremental(spark, tmp_path):
    done = str(tmp_path / "done")
    df = spark.createDataFrame([("a",), ("b",)], "paper_id string")
    counts = []

    def process(left):
        counts.append(left.count())
        return left

    assert S.incremental(spark, df, process, done).count() == 2
    again = S.incremental(spark, df.union(spark.createDataFrame([("c",)], "paper_id string")), process, done)
    assert counts == [2, 1] and [r.paper_id for r in again.collect()] == ["c"]
    assert [r.paper_id for r in again.collect()] == ["c"]  # read back: nothing is processed twice


def test_redelivered_batch_is_stored_once(spark, tmp_path):
    rows, outbox = spark.createDataFrame([("a",), ("b",)], "k string"), str(tmp_path / "outbox")

    def down(_):
        raise OSError("down")

    for _ in range(2):
        assert not deliver(rows, down, outbox, batch=7)
    assert spark.read.json(outbox).count() == 2


def test_rows_delivered_before_are_compared_by_key_alone(spark, tmp_path, monkeypatch):
    written = []
    real = S.kept
    monkeypatch.setattr(S, "kept", lambda df, tag: written.append((tag, set(df.columns), real(df, tag))) or written[-1][2])
    store = S.Store(spark, str(tmp_path / "log"), S.DELIVERED)
    rows = spark.range(300).select((F.col("id") % 100).cast("string").alias("key"), F.lit("wide").alias("payload"))
    fresh = S.unseen(store, rows)
    assert fresh.count() == 100 and [tag for tag, _, _ in written] == ["fresh"]  # the rows are written once
    store.commit(store.upsert("delivered", fresh.select("key", F.xxhash64("key").alias("hash")), settled=True))
    written.clear()
    more = rows.union(spark.createDataFrame([("new", "wide"), ("new", "wide")], rows.schema))
    assert [r.key for r in S.unseen(store, more).collect()] == ["new"]
    wide = {tag: df.count() for tag, columns, df in written if "payload" in columns}
    assert wide == {"fresh": 1}  # what was delivered before is never dealt as whole rows
