import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quillstone import commands as C
from quillstone.operators import state as S
from quillstone.sources.sinks import kept
from quillstone.sources.tables import BrokenRulesError

from .test_operators import evidence, item

c = F.col
LAKE = "metadata_id string, doi string, title string, created_at string"


@pytest.fixture
def store(spark, tmp_path):
    return C.open_store(spark, str(tmp_path / "store"))


def lake(store):
    return sorted((r.metadata_id, r.doi, r.title, r.created_at) for r in store.read("paper_metadata").collect())


def test_upsert_metadata_by_id_or_doi(spark, store):
    rows = lambda *x: spark.createDataFrame(list(x), LAKE)
    said = lambda df: {r.metadata_id: r.status for r in df.collect()}
    assert said(C.upsert_metadata(store, rows(("m1", "d1", "a", "old"), ("m2", "d2", "b", "old"), ("m3", None, "c", "old"), ("m4", None, "d", "old")))) == dict.fromkeys(["m1", "m2", "m3", "m4"], "created")
    new = rows(("m1", "d1", "a2", "new"), ("n2", "d2", "b2", "new"), ("m3", None, "c2", "new"), ("m5", None, "e", "new"))
    assert said(C.upsert_metadata(store, new, overwrite=False)) == {"m1": "skipped", "n2": "skipped", "m3": "skipped", "m5": "created"}
    assert said(C.upsert_metadata(store, new)) == {"m1": "updated", "n2": "updated", "m3": "updated", "m5": "updated"}
    assert lake(store) == [("m1", "d1", "a2", "old"), ("m3", None, "c2", "old"), ("m4", None, "d", "old"), ("m5", None, "e", "new"), ("n2", "d2", "b2", "old")]


def test_upsert_metadata_of_repeated_records(spark, store):
    rows = lambda *x: spark.createDataFrame(list(x), LAKE)
    C.upsert_metadata(store, rows(("m1", "d1", "a", "old"), ("m1", "d1", "b", "old"), ("m1", "d0", "z", "old"), ("m2", None, "c", "old")))
    assert lake(store) == [("m1", "d1", "b", "old"), ("m2", None, "c", "old")]
    said = C.upsert_metadata(store, rows(("m2", None, "d", "new"), ("m2", None, "e", "new"), ("m3", "d1", "f", "new"), ("m3", "d1", "f", "new")))
    assert sorted(map(tuple, said.collect())) == [("m2", "updated"), ("m3", "updated")]
    assert lake(store) == [("m2", None, "e", "old"), ("m3", "d1", "f", "old")]
    before = store.latest()[0]
    with pytest.raises(BrokenRulesError):
        C.upsert_metadata(store, rows((None, "d9", "x", "new")))
    assert store.latest()[0] == before


def test_metadata_from_dois(spark, store):
    def fetch(row):
        if row["doi"].endswith("down"):
            raise OSError("no answer")
        return {"title": None if row["doi"].endswith("untitled") else f"about {row['doi']}", "citation_count": "3"}

    dois = lambda *x: spark.createDataFrame([(d,) for d in x], "doi string")
    said = lambda df: {r.doi: (r.status, r.error) for r in df.collect()}
    first = said(C.metadata_from_dois(store, dois("https://doi.org/10.1/A", "10.1/a", "10.1/down", "10.1/untitled", " ", None), fetch, "now"))
    assert first == {"10.1/a": ("created", None), "10.1/down": ("failed", "OSError: no answer"), "10.1/untitled": ("failed", "no title or id"), " ": ("invalid", "no DOI"), None: ("invalid", "no DOI")}
    assert said(C.metadata_from_dois(store, dois("10.1/a", "10.1/b"), fetch, "later")) == {"10.1/a": ("skipped", None), "10.1/b": ("created", None)}
    assert said(C.metadata_from_dois(store, dois("10.1/a"), fetch, "later", overwrite=True)) == {"10.1/a": ("updated", None)}
    assert [(r.doi, r.created_at, r.decision, r.is_seed) for r in store.read("paper_metadata").orderBy("doi").collect()] == [("10.1/a", "now", "keep", True), ("10.1/b", "later", "keep", True)]


SCOPES = "paper_id string, study_id string, experiment_scope_id string, ordinal int, study_design string"


def test_derive_and_one_paper(spark, store, tmp_path):
    scopes = spark.createDataFrame([("p1", "s1", None, 0, "rct")], SCOPES)
    rows = evidence(spark, [item(1), item(2)])
    assert C.derive(store, rows, scopes, "b1") == 1 and C.derive(store, rows, scopes, "b1") == 2
    assert store.read("evidence_projections").count() == 2 and {r.build_id for r in store.read("general_evidence").collect()} == {"b1"}
    paths = C.derive_paper(rows, scopes, "p1", "b2", str(tmp_path / "p1"))
    lines = [json.loads(x) for x in open(paths[0]).read().split("\n")]
    assert {x["table"] for x in lines} == {"exposure_registry", "outcome_registry", "evidence_projections", "general_evidence", "general_evidence_support"} and sum(x["table"] == "evidence_projections" for x in lines) == 1
    assert open(paths[1]).read() == "" or all(json.loads(x)["build_id"] == "b2" for x in open(paths[1]).read().split("\n"))
    with pytest.raises(FileNotFoundError, match="experiment map"):
        C.derive_paper(rows, scopes.limit(0), "p1", "b2", str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_refresh_states(spark, store):
    files = spark.createDataFrame([("p1", True, True), ("p2", True, False)], "paper_id string, has_pdf boolean, has_markdown boolean")
    at = F.timestamp_seconds(F.lit(5))
    first = C.refresh_states(store, files, at)
    assert {r.paper_id for r in first.collect()} == {"p1", "p2"}
    store.commit(store.upsert("structured_papers", spark.createDataFrame([("p1", "{}"), ("p3", "{}")], "paper_id string, payload string")))
    states = spark.createDataFrame([("p1", "pdf.process", 1, "failed", "e", "m", 1), ("p1", "pdf.process", 2, "succeeded", None, None, 2)], "paper_id string, stage string, attempt int, status string, error_code string, error_message string, t int")
    store.commit(store.upsert("paper_pipeline_state", states.select("*", F.timestamp_seconds("t").alias("updated_at")).drop("t")))
    rows = C.refresh_states(store, files, at)
    got = {r.paper_id: r for r in store.read("paper_processing_state").collect()}
    assert got["p1"].has_structured_paper and got["p3"].has_structured_paper and not got["p2"].has_structured_paper and got["p1"].latest_pipeline_status == "succeeded"
    facts = S.processing_facts(store.read("paper_pipeline_state"), {"structured_paper": store.read("structured_papers"), **{k: files.limit(0) for k in ("structured_blocks", "experiment_map", "canonical_evidence")}}, spark.createDataFrame([], "paper_id string, paper_family string, updated_at timestamp"))
    want = S.processing_state(files, facts)
    assert sorted(map(str, rows.drop("updated_at").collect())) == sorted(map(str, want.collect()))


def test_replay(spark, store):
    schemas = {"structured_papers": "paper_id string, payload string", "experiment_maps": "experiment_map_id string, paper_id string"}
    outbox = spark.createDataFrame(
        [("o1", "structured_papers", '{"paper_id": "p1", "payload": "x"}', 0), ("o2", "structured_papers", "{}", 0), ("o3", "experiment_maps", '{"experiment_map_id": "m1"}', 0), ("o4", "odd", '{"a": 1}', 0)],
        "outbox_id string, record_type string, payload string, attempt_count int",
    )
    told = lambda df: {r.outbox_id: r.outcome for r in df.collect()}
    assert told(C.replay(store, outbox, schemas, dry_run=True)) == {"o1": "pending", "o2": "failed", "o3": "pending", "o4": "pending"} and store.latest()[0] == 0
    report = kept(C.replay(store, outbox, schemas), "t")
    assert told(report) == {"o1": "delivered", "o2": "failed", "o3": "failed", "o4": "failed"} and "paper_id is null" in report.filter("outbox_id = 'o3'").first().error
    assert told(C.replay(store, outbox, schemas)) == {"o1": "skipped", "o2": "failed", "o3": "failed", "o4": "failed"}
    assert [r.paper_id for r in store.read("structured_papers").collect()] == ["p1"]


def test_link_pdfs(spark, tmp_path):
    for name, content in (("a.pdf", b"%PDF-1 a"), ("b.pdf", b"text")):
        (tmp_path / name).write_bytes(content)
    links = spark.createDataFrame([("m1", "d1", str(tmp_path / "a.pdf")), ("m2", "d2", str(tmp_path / "b.pdf")), ("m3", None, str(tmp_path / "none.pdf"))], "metadata_id string, doi string, source_pdf_path string")
    got = {r.metadata_id: r for r in C.link_pdfs(links, str(tmp_path / "artifacts"), "now").collect()}
    assert {k: r.outcome for k, r in got.items()} == {"m1": "copied", "m2": "failed", "m3": "missing"} and "another kind" in got["m2"].error
    assert (tmp_path / "artifacts" / f"{hashlib.sha256(b'm1').hexdigest()}.pdf").read_bytes() == b"%PDF-1 a" and got["m1"].link_method == "manual"
    moved = {r.metadata_id: r.outcome for r in C.link_pdfs(links, str(tmp_path / "artifacts"), "now", move=True).collect()}
    assert moved["m1"] == "same" and not (tmp_path / "a.pdf").exists() and (tmp_path / "b.pdf").exists()


def test_sample_bundle(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p1.pdf").write_bytes(b"%PDF-1")
    sample = spark.createDataFrame([("p1",), ("p2",), ("p2",), ("p3",), (None,)], "paper_id string")
    rows = spark.createDataFrame([("p1", "a", ["b1"]), ("p1", 'c,"d"', None), ("p2", None, []), ("p9", "x", ["b2"]), (None, "y", None)], "paper_id string, text string, blocks array<string>")
    out = tmp_path / "out"
    for _ in range(2):  # a second bundle takes the first one's place
        got = {r.paper_id: (r.evidence_rows, r.pdf_copied, r.missing_pdf) for r in C.write_sample_bundle(sample, rows, str(tmp_path / "in"), str(out), "now", "s").collect()}
        assert got == {"p1": (2, True, False), "p2": (1, False, True), "p3": (0, False, True)}
    assert (out / "pdfs" / "p1.pdf").read_bytes() == b"%PDF-1" and not (out / "pdfs" / "p2.pdf").exists()
    assert sorted(str(r.text) for r in spark.read.json(str(out / "canonical_evidence.json")).collect()) == ["None", "a", 'c,"d"']
    assert spark.read.option("header", True).csv(str(out / "canonical_evidence.csv")).count() == 3
    about = json.loads((out / "sample_metadata.json").read_text())
    assert (about["requested_papers"], about["evidence_rows"], about["seed"]) == (3, 3, "s")
