"""Operators that must not hold a whole table, group or dictionary in one place."""

import hashlib
import json
import random
import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstone.functions import ids
from quillstone.functions import text as T
from quillstone.operators import blocks as B
from quillstone.operators import evidence as E
from quillstone.operators import metadata as D
from quillstone.operators.ordering import numbered, tuple_text
from quillstone.plans import registry
from quillstone.sources import readers as R
from quillstone.sources import sinks as K
from quillstone.sources.paged import Service, register_paged
from quillstone.sources.tables import Store, Table

c = F.col
TEXTS = ["", "plain", 'a "quote"', "back\\slash", "tab\tline\nfeed\r\b\f", "clinic é", "ward \U0001f600", "\x01\x1f\x7f\x80", "it's", 'both \' and "', "\\u00e9", "/slash", "日本", None]


def test_json_text_is_pythons(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", ids.json_text(c("t")).alias("j")).collect()
    assert {r.t: r.j for r in rows} == {t: None if t is None else json.dumps(t) for t in TEXTS}


def test_context_and_ids_are_pythons(spark):
    contexts = [{"setting": t, "b é": "x", "a": "1"} for t in TEXTS if t is not None] + [{}, {"k": None}]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(contexts)], "n int, context_identity map<string, string>")
    got = rows.select("n", E.context_json().alias("j")).withColumn("id", ids.stable_id("g", F.lit("b"), F.lit(None).cast("string"), c("j"))).collect()
    for r in got:
        want = json.dumps(contexts[r.n], sort_keys=True, separators=(",", ":"))
        whole = json.dumps(["b", None, want], ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        assert r.j == want and r.id == "g_" + hashlib.sha256(whole.encode()).hexdigest()
    nested = ['{"n": 1.0, "m": 1e22, "l": [1, {"z": null, "a": "é"}], "b": true}', None, "{}"]
    got = spark.createDataFrame([(x,) for x in nested], "context_identity string").select(E.context_json(nested=True).alias("j")).collect()
    assert [r.j for r in got] == ['{"b":true,"l":[1,{"a":"\\u00e9","z":null}],"m":1e+22,"n":1.0}', "{}", "{}"]


def test_tuple_text(spark):
    texts = [t for t in TEXTS if t is None or not re.search(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", t)]
    rows = [(a, b) for a in texts for b in texts]
    got = spark.createDataFrame(rows, "a string, b string").select(tuple_text(["a", "b"]).alias("t")).collect()
    assert sorted(r.t for r in got) == sorted(str(x) for x in rows)


def test_numbered(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(50)) for k in range(3000)]
    found = numbered(spark.createDataFrame(rows, "k int, v int"), [c("v"), c("k")], start=0)
    assert {(r.k, r.place) for r in found.collect()} == {(k, n) for n, (k, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert numbered(spark.createDataFrame([], "k int, v int"), [c("k")]).count() == 0
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "Window" not in plan and "SinglePartition" not in plan


def test_keywords_at_dictionary_size(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5)))
    keywords = list(dict.fromkeys(" ".join(word() for _ in range(rng.choice([1, 1, 2, 3]))) for _ in range(4000)))
    texts = [" ".join(word() for _ in range(rng.randrange(40))) for _ in range(150)] + ["", None]
    table = [(k, n) for n, k in enumerate(keywords)] + [("", -1), ("  ", -2), (keywords[0], 99_999)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, normalised string")
    want = {n: [k for k in keywords if t and (k in t if " " in k else f" {k}" in f" {t}")] for n, t in enumerate(texts)}
    found = D.match_keywords(rows, spark.createDataFrame(table, "keyword string, place int"))
    assert found.columns == ["n", "normalised", "matched_keywords"] and {r.n: r.matched_keywords for r in found.collect()} == want


def test_keywords_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "KEYWORD_BLOCK", 3)
    keywords = spark.createDataFrame([(k, n) for n, k in enumerate(["b", "a", "c d", "e", "x", "d e f", "zz", "ab"])], "keyword string, place int")
    rows = spark.createDataFrame([(1, "ab c d e f"), (2, "nothing")], "n int, normalised string")
    assert {r.n: r.matched_keywords for r in D.match_keywords(rows, keywords).collect()} == {1: ["a", "c d", "e", "d e f", "ab"], 2: []}
    assert [r.matched_keywords for r in D.match_keywords(rows, keywords.limit(0)).collect()] == [[], []]


def test_many_keywords(spark):
    """100,000 keywords; each text holds its own."""
    keywords = spark.range(100_000).select(F.concat(F.lit("k"), F.conv("id", 10, 16), F.lit("q")).alias("keyword"), c("id").alias("place"))
    rows = spark.range(500).select((c("id") * 199).alias("id"), F.concat(F.lower(F.concat(F.lit("some k"), F.conv(c("id") * 199, 10, 16), F.lit("q text")))).alias("normalised"))
    found = D.match_keywords(rows, keywords.withColumn("keyword", F.lower("keyword")))
    assert found.filter((F.size("matched_keywords") != 1)).count() == 0 and found.count() == 500


def test_clustered_lookup_opens_one_file(spark, tmp_path):
    rows = spark.range(5000).select((c("id") * 7 % 5000).alias("k"), F.sha2(c("id").cast("string"), 256).alias("v"))
    K.write_clustered(rows, str(tmp_path / "t"), "k", 20)
    every = spark.read.parquet(str(tmp_path / "t/rows"))
    assert len(every.inputFiles()) == 20
    for k in (0, 17, 4999):
        found = R.lookup_clustered(spark, str(tmp_path / "t"), "k", k)
        assert len(found.inputFiles()) == 1 and [tuple(r) for r in found.collect()] == [tuple(r) for r in rows.filter(c("k") == k).collect()]
    assert R.lookup_clustered(spark, str(tmp_path / "t"), "k", 10_000).count() == 0


def test_sequential_port_streams_and_resumes(spark):
    """One long key beside short ones; a run that stopped goes on after each key's last answer."""
    rows = spark.range(30_000).select(F.when(c("id") % 10 > 0, "long").otherwise(F.concat(F.lit("k"), c("id") % 70)).alias("k"), c("id").alias("i"))
    port = lambda r, b: {"k": r["k"], "i": r["i"], "s": r["i"] + (b["s"] if b else 0), "n": 1 + (b["n"] if b else 0)}
    ddl = "k string, i long, s long, n long"
    found = K.kept(R.call_port_in_order(rows, "k", "i", port, ddl), "answers")
    last = {r.k: (r.s, r.n) for r in found.groupBy("k").agg(F.max("s").alias("s"), F.max("n").alias("n")).collect()}
    assert last == {r.k: (r.s, r.n) for r in rows.groupBy("k").agg(F.sum("i").alias("s"), F.count("*").alias("n")).collect()}
    rest = R.call_port_in_order(rows, "k", "i", port, ddl, done=found.filter("i < 20000"))
    assert rest.filter("i < 20000").count() == 0
    assert rest.unionByName(found.filter("i < 20000")).exceptAll(found).count() == 0 and rest.count() == 10_000


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_paged_source(spark, tmp_path):
    """The filter of the year goes to the service; a page that fails twice is asked for again alone."""
    mark = str(tmp_path / "asked")

    def fetch(conditions, offset, size):
        with open(mark, "a") as f:
            f.write(f"{conditions} {offset} {size}\n")
        with open(mark) as f:
            if offset == 300 and sum(" 300 " in x for x in f) < 3:
                raise OSError("busy")
        least = max([x for _, op, x in conditions if op == ">="], default=0)
        return [(i, 1990 + i % 36) for i in range(1000) if 1990 + i % 36 >= least][offset : offset + size]

    count = lambda conditions: len(fetch(conditions, 0, 10_000))
    register_paged(spark, "paged_test", Service(fetch, count, ("year",), size=100, pages_per_task=2, base=0.01, rate=1000), "item long, year long")
    found = spark.read.format("paged_test").load().filter("year >= 2005 and item % 2 = 0")
    assert found.rdd.getNumPartitions() == 3
    assert sorted(r.item for r in found.collect()) == [i for i in range(1000) if 1990 + i % 36 >= 2005 and i % 2 == 0]
    asked = open(mark).read().splitlines()
    assert any("('year', '>=', 2005)" in x for x in asked) and sum(" 300 " in x for x in asked) == 3 and sum(" 200 " in x for x in asked) >= 1
    plan = plan_of(found)
    assert "2005" not in plan.split("Filter [")[-1].split("Condition")[-1].split("\n")[0] and "item" in plan  # Spark has no more to test of the year than null
    endless = Service(lambda x, offset, size: [(i, 0) for i in range(offset, min(offset + size, 250))], size=100)
    register_paged(spark, "paged_endless", endless, "item long, year long")
    assert spark.read.format("paged_endless").load().count() == 250


def test_paged_stream(spark, tmp_path):
    have = tmp_path / "have"
    have.write_text("150")
    count = lambda x: int(have.read_text())
    register_paged(spark, "paged_stream", Service(lambda x, offset, size: [(i,) for i in range(offset, min(offset + size, count(x)))], count, size=40), "item long")

    def run():
        q = spark.readStream.format("paged_stream").load().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(once=True).start()
        q.awaitTermination()
        return sorted(r.item for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == list(range(150))
    have.write_text("170")
    assert run() == list(range(170))


def test_paged_service_that_stays_down(spark):
    def down(*_):
        raise OSError("down")

    register_paged(spark, "paged_down", Service(down, tries=2, base=0.001), "item long")
    with pytest.raises(Exception, match="down"):
        spark.read.format("paged_down").load().collect()


def test_clean_and_hash_text_are_pythons(spark):
    """Any white space, and characters that NFKC changes or joins, alone and beside others."""
    rng = random.Random(3)
    blanks = [*" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        　"]
    others = [*"aB.é", "é", "́", "ﬁ", "ﬃ", "½", "Å", "¨", "Σ", "​", "が", "한", "가", "Å", "…", "日", "\U0001d400", "ı", "ﬄx"]
    texts = ["", " ", "a b", "a  b", " a", "a ", "a\tb", "a\t", "a \t b", None, *["".join(rng.choice(rng.choice([blanks, others, others])) for _ in range(rng.randrange(12))) for _ in range(3000)]]
    spaced = lambda t: re.sub(f"[{''.join(blanks)}]+", " ", t or "").strip(" ")
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.clean_text(c("t")).alias("clean"), T.hash_text(c("t")).alias("h")).collect()
    assert [r.clean for r in found] == [spaced(r.t) for r in found]
    assert [r.h for r in found if r.t and "Σ" not in r.t] == [spaced(unicodedata.normalize("NFKC", r.t).lower()) for r in found if r.t and "Σ" not in r.t]


def test_blocks_are_dealt_once(spark):
    """One exchange for all windows of the contract; blocks joined of texts that NFKC changes hash as the whole text does."""
    rows = [("p", k, ["S"], "S", "methods", "paragraph", t) for k, t in enumerate(["the ﬁrst and", "½ of", "", "́ e of", "all.", "Next ﬂow.", "plain"])]
    rows += [("q", k, ["A"], "A", "abstract", "paragraph", t) for k, t in enumerate(["The ﬁsh.", "The  fish.", "Other."])]
    found = B.enforce_contract(spark.createDataFrame(rows, "paper_id string, ord int, section_path array<string>, section_title string, section_type string, content_kind string, text string"))
    got = found.withColumn("whole", T.content_hash(c("text"))).collect()
    assert [(r.paper_id, r.ord, r.text) for r in sorted(got)] == [("p", 0, "the ﬁrst and ½ of ́ e of all."), ("p", 1, "Next ﬂow."), ("p", 2, "plain"), ("q", 0, "The ﬁsh."), ("q", 1, "Other.")]
    assert all(r.whole == r.content_hash for r in got) and "__nfkc" not in found.columns
    plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert plan.count("Exchange") == 1


def test_paged_requests_share_frames(spark):
    rows = spark.range(3000).coalesce(1).select("id", (c("id") % 130).alias("n"))
    calls = lambda r, offset, size: [{"item": k} for k in range(r["n"])[offset : offset + size]]
    requests = type("Requests", (), {"sparkSession": spark, "mapInPandas": staticmethod(lambda run, ddl: run)})
    frames = list(R.read_paged(requests, calls, "id long, item long")(iter([rows.toPandas()])))
    assert R.read_paged(rows, calls, "id long, item long").count() == sum(k % 130 for k in range(3000))
    assert R.read_paged(rows.limit(0), calls, "id long, item long").count() == 0
    assert len(frames) < 100 and sum(map(len, frames)) == sum(k % 130 for k in range(3000))


def test_evidence_is_not_dealt_by_term(spark, sf_dir):
    """Registries are broadcast by their count, so that rows are not shuffled by the few terms there are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = registry.projections(spark, sf_dir)
        plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(exposure_name" not in plan and "hashpartitioning(outcome_name" not in plan


def test_partitions_of_a_large_service():
    parts = Service(lambda *x: [], lambda x: 54_000_007, size=500, pages_per_task=4).split([])
    assert len(parts) <= 1000 and parts[0].first == 0 and parts[-1].end == 54_000_007 and all(a.end == b.first for a, b in zip(parts, parts[1:]))
    assert len(Service(lambda *x: [], lambda x: 8001, size=500, pages_per_task=4).split([])) == 5


def test_a_part_is_written_by_many_tasks(spark, tmp_path):
    stored = Store(spark, str(tmp_path), {"t": Table(("k",), part="build")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored.commit(stored.replace("t", spark.range(20_000).select(c("id").alias("k"), F.lit("b").alias("build")), ["b"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = stored.read("t").groupBy("_metadata.file_path").count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 15_000 and stored.read("t").count() == 20_000


def test_python_gets_bounded_batches(spark):
    """Texts reach Python in batches bounded by rows and bytes, plain ones not at all, and matches leave in parts."""
    for name in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{name}")
    T.keyword_text(c("t"))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000" and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(4 << 20)
    keywords = spark.createDataFrame([("a", 1), ("b", 2), ("c d", 3)], "keyword string, place int")
    rows = spark.range(950).coalesce(1).select("id", F.when(c("id") % 7 == 0, None).when(c("id") % 2 == 0, "a c d").otherwise("b a").alias("normalised"))
    want = {k: [] if k % 7 == 0 else ["a", "c d"] if k % 2 == 0 else ["a", "b"] for k in range(950)}
    assert {r.id: r.matched_keywords for r in D.match_keywords(rows, keywords).collect()} == want
