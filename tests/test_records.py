import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quillstone.functions import text as T
from quillstone.operators import records as O

c = F.col


def test_nested_cleaning(spark):
    df = spark.createDataFrame([(("a ¶ b", ["*x*  y", None], 3),), (None,)], "v struct<t: string, xs: array<string>, n: int>")
    got = df.select(O.cleaned(c("v"), df.schema["v"].dataType).alias("v")).collect()
    assert got[0].v.t == "a b" and got[0].v.xs == ["x y", None] and got[0].v.n == 3 and got[1].v is None


def test_pruned_quality(spark):
    df = spark.createDataFrame([(("high", True, False),), ((None, True, None),), (None,)], "q struct<confidence: string, is_truncated: boolean, is_duplicate: boolean>")
    got = [r.q for r in df.select(O.pruned_quality(c("q"), df.schema["q"].dataType).alias("q")).collect()]
    assert got[0].asDict() == {"confidence": "high"} and got[1:] == [None, None]
    bare = spark.createDataFrame([((True,),)], "q struct<is_truncated: boolean>")
    assert bare.select(O.pruned_quality(c("q"), bare.schema["q"].dataType).alias("q")).first().q is None


def test_author_names_of_strings(spark):
    df = spark.createDataFrame([([" A ", "", None, "B"],), (None,)], "a array<string>")
    assert [r.x for r in df.select(O.author_names(c("a"), df.schema["a"].dataType).alias("x")).collect()] == [["A", "B"], []]


def test_lookup(spark):
    lake = spark.createDataFrame([("m1", 1), ("m1", 2), ("m2", 3)], "metadata_id string, n int")
    assert O.lookup(lake, "m1").count() == 1
    with pytest.raises(LookupError):
        O.lookup(lake, "m9")


def test_workspace_without_gaps(spark):
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "paper_id string")
    assert O.require_all(O.workspace(ids("a"), ids("a", "a"), ids("a"))).count() == 1
    with pytest.raises(Exception, match="missing_markdown of b"):
        O.require_all(O.workspace(ids("a", "b"), ids("a", "b"), ids("a"))).collect()


def test_batches_that_fail(spark):
    rows = [("p", 0, 0, 5, "text.", ["Methods"], "Methods", "", False, None), ("p", 1, 5, 9, "more", [], None, "text.", True, "ValueError: no: JSON " + "w " * 300)]
    b = spark.createDataFrame(rows, "paper_id string, index int, start_char int, end_char int, text string, previous_section_path array<string>, last_heading string, last_300_chars string, oversized_unit boolean, error string")
    failed = O.failures(b)
    assert failed.count() == 1 and failed.first().error_type == "ValueError" and failed.first().error.startswith("no: JSON")
    description = O.failed_status(failed).first().error_description
    assert description.startswith("ValueError: no: JSON") and len(description.split()) == 200
    assert [r.chars for r in O.batch_debug(b).orderBy("batch_index").collect()] == [5, 4]
    message = O.batch_messages(b, "Do").orderBy("index").first().message
    head, rest = message.split("# BATCH STRUCTURAL CONTEXT\n\n")
    context, text = rest.split("\n\n# MARKDOWN BATCH 0\n\n")
    assert head == "Do\n\n" and text == "text."
    assert json.loads(context) == {"previous_section_path": ["Methods"], "last_heading": "Methods", "last_300_chars": "", "oversized_unit": False}
    asked = b.select(O.input_message("Do", blocks=F.array("text")).alias("m")).orderBy("m").first().m
    assert asked == 'Do\n\n# INPUT\n\n{"blocks":["more"]}'


def test_manifest_and_finish(spark):
    start = spark.createDataFrame([("r1", "running", 1), ("r2", "running", 1)], "run_id string, status string, at int")
    end = spark.createDataFrame([("r1", "succeeded", 2, "ok")], "run_id string, status string, at int, summary string")
    got = {r.run_id: r for r in O.finish(start, end).collect()}
    assert got["r1"].status == "succeeded" and got["r1"].summary == "ok" and got["r2"].status == "running"
    assert json.loads(O.manifest(start).filter("run_id = 'r1'").first().manifest) == {"at": 1, "run_id": "r1", "status": "running"}


GENERAL = "general_evidence_id string, conclusion_claim string, plain_language_conclusion string, evidence_balance_summary string, recommendation_interpretation string, caveats array<string>, conclusion_status string, causal_language_allowed boolean, recommendation_use string, consensus_level string, dominant_direction string"


def test_conclusions(spark):
    row = lambda i: (i, "t", "p", "b", None, ["x"], "active", False, "usable_with_caveat", "weak", "increase")
    general = spark.createDataFrame([row("a"), row("b"), row("c"), row("d")], GENERAL)
    answers = [("a", {"conclusion_claim": "Is associated with more.", "conclusion_status": "active", "conclusion_caveats": ["y"]}), ("b", {"conclusion_claim": "It reduces weight.", "conclusion_status": "active"}), ("c", {"conclusion_claim": "", "conclusion_status": "odd"})]
    got = {r.general_evidence_id: r for r in O.apply_conclusions(general, spark.createDataFrame([(i, json.dumps(a)) for i, a in answers], "general_evidence_id string, answer string")).collect()}
    assert (got["a"].conclusion_claim, got["a"].conclusion_status, got["a"].caveats) == ("Is associated with more.", "active", ["y"])
    assert got["b"].conclusion_status == "needs_review" and got["b"].caveats == ["x"]
    assert got["c"].conclusion_claim == "t" and got["c"].conclusion_status == "needs_review"
    assert got["d"].conclusion_status == "active" and got["d"].conclusion_generation_method == "template"


def test_attached_context(spark):
    items = spark.createDataFrame([("p", "m", 0, "s1", "e1", 'say "x"', None), ("p", "m", 1, "", "e1", "y", "own"), ("p", "m", 2, None, None, "z", None)], "paper_id string, experiment_map_id string, item_index int, packet_study_id string, packet_scope_id string, evidence_text string, canonical_evidence_id string")
    got = {r.evidence_text: r for r in O.attach_context(items, ["evidence_text"]).collect()}
    item = {"evidence_text": 'say "x"', "experiment_map_id": "m", "experiment_scope_id": "e1", "paper_id": "p", "study_id": "s1"}
    text = json.dumps(["canonical_evidence", "p", "s1", 0, item], sort_keys=True, separators=(",", ":"))
    assert got['say "x"'].canonical_evidence_id == "canonical_evidence_" + hashlib.sha256(text.encode()).hexdigest()
    assert got["y"].canonical_evidence_id == "own" and got["y"].study_id == "e1"
    assert got["z"].study_id == "unclear" and got["z"].experiment_scope_id == "unclear"


@pytest.mark.parametrize("response, want", [({"output": [{"content": [{"text": " "}]}, {"content": [{"text": "t"}]}]}, "t"), ({"output": [{}, {"content": [{"text": "u"}]}]}, "u"), ({"output": []}, None), ({}, None)])
def test_response_text(spark, response, want):
    df = spark.createDataFrame([(json.dumps(response),)], "r string")
    assert df.select(O.response_text(c("r")).alias("t")).first().t == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "metadata_id string, doi string, title string, decision string, created_at string")
    fetched = spark.createDataFrame([], "doi string, source_paper_id string, title string, error string")
    rows = O.refreshed(none, fetched, "now")
    assert rows.count() == 0 and O.refresh_summary(rows).first().n_read == 0


def test_int_or_zero(spark):
    rows = spark.createDataFrame([(x,) for x in ("12", " -3 ", "+4", "", "  ", None, "12.7", "x", "9" * 30)], "v string")
    assert [r[0] for r in rows.select(T.int_or_zero(F.col("v"))).collect()] == [12, -3, 4, 0, 0, 0, 0, 0, 0]
