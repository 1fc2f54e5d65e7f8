import hashlib
import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillstone.operators import store as O
from quillstone.operators.metadata import upsert
from quillstone.plans import files
from quillstone.sources import sinks as K
from quillstone.sources import tables as T
from quillstone.sources.tables import BrokenRulesError, Store, Table


def size(root, since=()):
    return {p: p.stat().st_size for p in Path(root).rglob("*.parquet") if p not in since}


def rows(spark, first, end, at, text="x"):
    return spark.range(first, end).select(F.col("id").alias("k"), F.lit(at).alias("at"), F.concat(F.lit(text), F.sha2(F.col("id").cast("string"), 512)).alias("v"))


def test_changed_rows_alone_are_written(spark, tmp_path):
    root = str(tmp_path / "s")
    store = Store(spark, root, {"t": Table(("k",), buckets=4)})
    store.commit(store.upsert("t", rows(spark, 0, 20_000, 1), "at"))
    before = size(root)
    changed = rows(spark, 0, 20_000, 2, "y").filter("k % 100 = 7")
    store.commit(store.upsert("t", changed, "at"))
    assert 0 < sum(size(root, before).values()) < 0.02 * sum(before.values())
    found = store.read("t")
    assert found.count() == 20_000 and found.filter("at = 2").count() == 200 and found.filter("startswith(v, 'y')").agg(F.sum("k")).first()[0] == sum(range(7, 20_000, 100))
    store.commit(store.upsert("t", rows(spark, 7, 8, 1, "old"), "at"))  # an older row does not win
    assert store.read("t").filter("k = 7").first().at == 2


def test_columns_that_nobody_asks_for_are_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("k",), buckets=4), "keys": Table(("k",), buckets=2)})
    for first, at in ((0, 1), (50, 2)):
        store.commit(store.upsert("t", rows(spark, first, first + 100, at), "at"))
        store.commit(store.upsert("keys", rows(spark, first, first + 100, at).select("k"), settled=True))
    found = store.read("t").select("k", "at")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,at:int>" in plan and "v:string" not in plan
    assert found.count() == 150 and found.filter("at = 2").count() == 100
    assert store.read("keys").count() == 150 and store.read("t").columns == ["k", "at", "v"]


def test_filled_values_move_the_rows_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("k",), buckets=2)})
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, None, "z")], "k int, made string, v string")
    fill = spark.createDataFrame([(1, "old"), (2, None), (9, "other")], "k int, made string")
    gone = spark.createDataFrame([(4,), (1,)], "k int")
    store.commit(store.upsert("t", new.withColumn("k", F.col("k") + 3)))
    store.commit(store.upsert("t", new, fill=fill, gone=gone, settled=True))
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "old", "x"), (2, "b", "y"), (3, None, "z"), (5, "b", "y"), (6, None, "z")]
    assert store.read("t").columns == ["k", "made", "v"]


def test_a_bucket_with_many_layers_is_written_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "LAYERS", 3)
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("k",), buckets=2)})
    for at in range(1, 9):
        store.commit(store.upsert("t", rows(spark, at, at + 30, at), "at"))
        assert max(map(len, store.latest()[1]["tables"]["t"]["labels"].values())) <= 3
    got = {r.k: r.at for r in store.read("t").collect()}
    assert got == {k: min(8, k) for k in range(1, 38)}
    assert store.vacuum(older_than=-1) > 0 and {r.k: r.at for r in store.read("t").collect()} == got
    assert store.vacuum(older_than=-1) == 0 and store.vacuum(older_than=3600) == 0


def test_new_columns_and_merge(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("k",), buckets=2)})
    assert store.read("t") is None
    store.commit(store.upsert("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")))
    add = lambda old, new: new.join(old.select("k", F.col("v").alias("o")), "k", "left").select("k", F.concat(F.coalesce("o", F.lit("")), "v").alias("v"), "w")
    store.commit(store.upsert("t", spark.createDataFrame([(2, "c", 5), (3, "d", 6)], "k int, v string, w int"), merge=add))
    assert sorted(map(tuple, store.read("t").collect()), key=str) == [(1, "a", None), (2, "bc", 5), (3, "d", 6)]


def test_lost_race_is_tried_again(spark, tmp_path):
    root = str(tmp_path / "s")
    table = {"t": Table(("k",), buckets=2), "u": Table(("k",), buckets=2)}
    count = lambda old, new: new.join(old.select("k", F.col("n").alias("o")), "k", "left").select("k", (F.coalesce("o", F.lit(0)) + F.col("n")).alias("n"))
    one = spark.createDataFrame([(1, 1)], "k int, n int")
    errors = []

    def add():
        try:
            own = Store(spark, root, table)
            own.commit(own.upsert("t", one, merge=count))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=add) for _ in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and [tuple(r) for r in Store(spark, root, table).read("t").collect()] == [(1, 5)]
    assert Store(spark, root, table).latest()[0] == 5


def test_untouched_labels_are_kept_as_written(spark, tmp_path, monkeypatch):
    """Another writer changes another table between a change and its version: the rows are not written twice."""
    root = str(tmp_path / "s")
    tables = {"t": Table(("k",)), "u": Table(("k",))}
    a, b = Store(spark, root, tables), Store(spark, root, tables)
    made, calls = a._made, []

    def overtaken(number, version):
        if not calls:
            b.commit(b.upsert("u", rows(spark, 0, 3, 1), "at"))
        calls.append(number)
        return made(number, version)

    monkeypatch.setattr(a, "_made", overtaken)
    assert a.commit(a.upsert("t", rows(spark, 0, 5, 1), "at")) == 2 and calls == [1, 2]
    assert a.read("t").count() == 5 and a.read("u").count() == 3 and len([p for p in (tmp_path / "s/data").iterdir()]) == 2


PARTS = {
    "names": Table(("id",), unique=("name",), required=("name",), checks={"n is not negative": "n >= 0"}),
    "a": Table(("a",), part="build"), "b": Table(("a", "x"), part="build", refers={"a": ("a", "a")}), "plain": Table(("p",), part="build"),
}


def test_builds_and_rules(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), PARTS)
    a = lambda build, *keys: spark.createDataFrame([(k, build) for k in keys], "a string, build string")
    b = lambda build, *keys: spark.createDataFrame([(k, "x", build) for k in keys], "a string, x string, build string")
    p = lambda build, *keys: spark.createDataFrame([(k, build) for k in keys], "p string, build string")
    O.publish(store, {"a": a("1", "k1", "k2"), "b": b("1", "k1"), "plain": p("1", "q")}, "1")
    O.publish(store, {"a": a("2", "m1"), "b": b("2", "m1")}, "2")
    folders = store.latest()[1]["tables"]["a"]["labels"]
    O.publish(store, {"a": a("1", "k1")}, "1")  # b and plain are not passed, and stay
    after = store.latest()[1]["tables"]["a"]["labels"]
    assert after["2"] == folders["2"] and after["1"] != folders["1"]
    state = lambda: {n: sorted(map(tuple, store.read(n).collect())) for n in store.latest()[1]["tables"]}
    kept = state()
    assert kept == {"a": [("k1", "1"), ("m1", "2")], "b": [("k1", "x", "1"), ("m1", "x", "2")], "plain": [("q", "1")]}
    broken = [
        ({"a": a("1")}, "a: a is still named in b"), ({"b": b("1", "none")}, "b: a is not in a"), ({"a": a("1", "k1", "k1")}, "a: key repeats"), ({"a": a("1", "k1", "m1")}, "a: key is in another part"),
        ({"a": a("1", "k1", None)}, "a: a is null"), ({"a": a("2", "k1")}, "a: rows of other parts"),
    ]
    for tables, rule in broken:
        with pytest.raises(BrokenRulesError) as e:
            O.publish(store, {"plain": p("1", "lost"), **tables}, "1")
        assert rule in e.value.counts and state() == kept
    names = lambda *x: spark.createDataFrame(list(x), "id int, name string, n int")
    store.commit(store.upsert("names", names((1, "a", 0), (2, "b", None))))
    for given, rule in (((3, "a", 1), "name repeats"), ((3, None, 1), "name is null"), ((1, "a", -1), "n is not negative")):
        with pytest.raises(BrokenRulesError) as e:
            store.commit(store.upsert("names", names(given)))
        assert f"names: {rule}" in e.value.counts
    store.commit(store.upsert("names", names((1, "c", 0), (3, "a", 0))))  # a name that goes over to another row
    assert sorted((r.id, r.name) for r in store.read("names").collect()) == [(1, "c"), (2, "b"), (3, "a")]
    O.publish(store, {"a": a("2"), "b": b("2")}, "2")  # a build emptied
    assert state()["a"] == [("k1", "1")]


def test_metadata_upsert_keeps_created(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), {"lake": Table(("metadata_id",))})
    old = spark.createDataFrame([("m1", "d1", "v1", "old"), ("m2", "d2", "v1", "old")], "metadata_id string, doi string, version string, created_at string")
    store.commit(store.upsert("lake", old))
    store.commit(store.upsert("lake", old.filter("metadata_id = 'm1'").withColumns({"version": F.lit("v2"), "created_at": F.lit("new")}), merge=upsert))
    assert sorted((r.metadata_id, r.version, r.created_at) for r in store.read("lake").collect()) == [("m1", "v2", "old"), ("m2", "v1", "old")]


def test_removed_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "LAYERS", 2)
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("k",), buckets=2, required=("v",))})
    put = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    keys = lambda *x: spark.createDataFrame([(k,) for k in x], "k int")
    state = lambda: sorted(map(tuple, store.read("t").collect()))
    store.commit(store.upsert("t", put((1, "a"), (2, "b"), (3, "c"))))
    store.commit(store.upsert("t", put((4, "d")), gone=keys(2, 9)))
    assert state() == [(1, "a"), (3, "c"), (4, "d")] and store.read("t").columns == ["k", "v"]
    store.commit(store.upsert("t", put((2, "e"), (3, "f")), gone=keys(3, 4)))  # a key that is given too stays
    assert state() == [(1, "a"), (2, "e"), (3, "f")]
    for k in range(3):  # through buckets written anew
        store.commit(store.upsert("t", put((2, f"g{k}")), gone=keys(1)))
    assert state() == [(2, "g2"), (3, "f")]


def test_staged_rows_are_published_where_they_lie(spark, tmp_path):
    root = str(tmp_path / "s")
    store = Store(spark, root, PARTS)
    a = lambda build, *keys: spark.createDataFrame([(k, build) for k in keys], "a string, build string")
    b = lambda build, *keys: spark.createDataFrame([(k, "x", build) for k in keys], "a string, x string, build string")
    state = lambda: {n: sorted(map(tuple, store.read(n).collect())) for n in store.latest()[1]["tables"]}
    keep = O.staging(store, "1")
    tables = {"a": keep("a", a("1", "k1", "k2")), "b": keep("b", b("1", "k1"))}
    assert store.latest()[0] == 0 and tables["a"].count() == 2
    before = size(root)
    O.publish(store, tables, "1")
    O.publish(store, tables, "1")
    assert size(root) == before and state() == {"a": [("k1", "1"), ("k2", "1")], "b": [("k1", "x", "1")]}
    with pytest.raises(BrokenRulesError):  # rows of another build than they are published as
        O.publish(store, {"a": tables["a"]}, "2")
    with pytest.raises(BrokenRulesError) as e:
        O.publish(store, {"a": keep("a", a("1", "k2"))}, "1")
    assert e.value.counts == {"a: a is still named in b": 1}
    with pytest.raises(BrokenRulesError) as e:  # b is there as it was, but what it refers to changes
        O.publish(store, {"a": a("1", "k2"), "b": tables["b"]}, "1")
    assert e.value.counts == {"b: a is not in a": 1}
    O.publish(store, {"a": a("2", "k3"), "b": b("2", "k3")}, "2")
    with pytest.raises(BrokenRulesError) as e:  # of the other parts too
        O.publish(store, {"a": a("2", "k4"), "b": b("2", "k4"), "plain": spark.createDataFrame([("q", "2")], "p string, build string")}, "1")
    assert e.value.counts == {"a: rows of other parts": 1}
    store.commit(store.replace("b", b("1", "k3").union(b("2", "k3")).withColumn("x", F.col("build")), ["1", "2"]))
    with pytest.raises(BrokenRulesError) as e:
        O.publish(store, {"a": a("2", "k4"), "b": b("2", "k4")}, "2")
    assert e.value.counts == {"a: a is still named in b": 1}
    store.commit(store.replace("b", b("1", "k1"), ["1", "2"]), store.replace("a", a("2").limit(0), ["2"]))
    assert state() == {"a": [("k1", "1"), ("k2", "1")], "b": [("k1", "x", "1")]}
    O.publish(store, {"a": tables["a"].filter("a = 'k1'"), "b": tables["b"]}, "1")  # another frame than the staged one is written
    assert state() == {"a": [("k1", "1")], "b": [("k1", "x", "1")]}
    wide = O.staging(store, "1")("a", a("1", "k1").withColumn("n", F.lit(1)))
    O.publish(store, {"a": wide}, "1")
    O.publish(store, {"a": tables["a"]}, "1")  # columns are never lost
    assert state()["a"] == [("k1", "1", None), ("k2", "1", None)]


def test_keys_of_equal_hash_are_compared(spark, tmp_path):
    """(k, null) and (null, k) have one hash, and are not one key."""
    store = Store(spark, str(tmp_path / "s"), {"t": Table(("a", "b"), part="build")})
    with pytest.raises(BrokenRulesError) as e:
        store.commit(store.replace("t", spark.createDataFrame([("k", None, "1"), (None, "k", "1")], "a string, b string, build string"), ["1"]))
    assert e.value.counts == {"t: a is null": 1, "t: b is null": 1}


def test_packed_ids(spark):
    digest = hashlib.sha256(b"x").hexdigest()
    texts = [None, "", "a", "é", f"p_{digest}", f"q_{digest}", digest, f"{digest}\n", f"é{digest}", digest.upper(), digest[1:], f"0{digest}", f"{digest}\x01", "\x01", "0" * 64, "\0" * 32]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "n int, t string")
    got = rows.select("n", "t", T.packed(rows, "t").alias("p"), T.packed(rows, "n").alias("m"))
    got = got.select("*", T.unpacked(got, "p").alias("u"), T.unpacked(got, "m").alias("v")).collect()
    assert [(r.u, r.v) for r in got] == [(r.t, r.n) for r in got] and len({r.p for r in got}) == len(texts)
    assert all(len(r.p) <= 37 for r in got if r.t in (digest, f"p_{digest}"))


def test_shuffle_files_go_with_the_query(spark):
    env = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    held = lambda: {p for d in env.localDirs() for p in Path(d.getPath()).rglob("shuffle_*.data")}
    setting, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    assert K.kept(rows(spark, 0, 5000, 1).repartition(3, "k"), "swept").count() == 5000
    for _ in range(50):
        left = [p for p in held() - before if p.stat().st_size > 100_000]
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(setting) == "false"
    with pytest.raises(ZeroDivisionError), K.swept(spark), K.swept(spark):
        assert spark.conf.get(setting) == "true"
        1 / 0
    assert spark.conf.get(setting) == "false"


def test_a_published_build_is_written_once(spark, sf_dir):
    """Of the query's tables each row is written once, besides a tenth for the earlier build and one table that is published again."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    found = files.published_build(spark, sf_dir)
    want = found.filter("name = 'evidence_projections'").count()
    written = [p for d in set(folder.iterdir()) - before for p in d.rglob("*.parquet") if "evidence_projections" in str(p)]
    assert want < sum(pq.read_metadata(p).num_rows for p in written) < 1.2 * want
