import hashlib
import json
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from quillstone.functions import ids, rules
from quillstone.functions import text as T
from quillstone.operators import blocks as B
from quillstone.operators import evidence as E
from quillstone.operators import metadata as D
from quillstone.operators import state as S
from quillstone.operators.store import TABLES, publish
from quillstone.operators import validation as V
from quillstone.sources import config as C
from quillstone.sources import readers as R
from quillstone.sources import sinks as K
from quillstone.sources.tables import Store

c = F.col


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(c("x")).alias("y")).first().y


@pytest.mark.parametrize("given, want", [("https://doi.org/10.1/AB", "10.1/ab"), ("DOI: 10.1/x ", "10.1/x"), ("http://dx.doi.org/10.2/Y", "10.2/y"), ("  ", None), (None, None)])
def test_doi(spark, given, want):
    assert one(spark, T.normalize_doi, given) == want


def test_text_functions(spark):
    assert [one(spark, T.canonical_name, x) for x in ("Egg intake", "egg consumption", "Whole egg intake", "__", None)] == ["egg", "egg", "egg", "", ""]
    assert [one(spark, T.display_name, x) for x in ("2h_glucose", "crohn's", "été_x")] == ["2H Glucose", "Crohn'S", "Été X"]
    assert one(spark, T.slugify_doi, "10.1/A (b)") == "10.1-a-b" and one(spark, T.slugify_doi, "") == "unknown-doi"
    assert tuple(one(spark, T.parse_base_name, "d1__doi-10.1-x")) == ("10.1-x", "d1") and tuple(one(spark, T.parse_base_name, "doi-10.1")) == ("10.1", None)
    assert one(spark, T.section_title, " 3.1.  Methods  used") == "Methods used"
    assert one(spark, T.clean_text, " a \x1cb\n\tc ") == "a b c"
    assert one(spark, T.keyword_text, "Café-Olé, 2 ﬁsh") == "cafe ole 2 fish"
    assert one(spark, T.recitation_clean, "a ¶ *b c*  d\n_X_ e<!-- z -->") == "a b c d\ne"
    assert [one(spark, T.safe_int, x) for x in ("12", " -3", "12.7", "", None)] == [12, -3, None, None, None]
    assert one(spark, T.is_pdf, bytearray(b"%PDF-1.7"), "binary") and not one(spark, T.is_pdf, bytearray(b"PK"), "binary")
    assert [one(spark, T.line_kind, x) for x in ("# a", "|a|", "- b", "12. c", "Table 1: d", "```", " ", "text")] == ["heading", "table", "list", "list", "caption", "fence", "blank", "paragraph"]
    assert one(spark, lambda x: T.source_slug(x, F.lit("dir/My File.pdf")), " ") == "my-file"
    assert one(spark, lambda x: T.quality(x, F.lit(None).cast("boolean"), F.lit(True)), "odd") == ("medium", False, True)


def test_section_type(spark):
    got = [one(spark, lambda k, t=t: T.section_type(k, F.lit(t)), k) for k, t in [("Materials and Methods", "x"), ("method", ""), ("odd", ""), (None, "Ethics approval"), ("results", "List of abbreviations"), ("front-matter", "")]]
    assert got == ["methods", "methods", "unknown", "ethics", "supplementary", "front_matter"]


def test_content_hash(spark):
    for x in ["Plain  Text", "ﬁne ﬀect ②", "Ärger", "", None]:
        t = " ".join(unicodedata.normalize("NFKC", x or "").lower().split())
        assert one(spark, T.content_hash, x) == hashlib.sha256(t.encode()).hexdigest()


def test_ids(spark):
    got = one(spark, lambda x: ids.stable_id("projection", F.lit("b"), x, F.lit(None)), 'é"q')
    assert got == "projection_" + hashlib.sha256(json.dumps(["b", 'é"q', None], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    scopes = F.array(F.struct(F.lit("rct").alias("study_design"), F.lit(None).cast("string").alias("study_id")))
    body = {"experiment_scopes": [{"study_design": "rct", "study_id": None}], "unmapped_block_ids": ["b"]}
    want = json.dumps(("experiment_map", "p1", body), sort_keys=True, separators=(",", ":"))
    assert one(spark, lambda x: ids.map_id(x, scopes, F.array(F.lit("b"))), "p1") == "experiment_map_" + hashlib.sha256(want.encode()).hexdigest()
    assert ids.config_hash({"a": 1, "api_key": "x"}) == ids.config_hash({"a": 1, "api_key": "y"}) != ids.config_hash({"a": 2})
    assert ids.public_config({"a": 1, "db": {"password": "x", "b": 2}}) == {"a": 1, "db": {"b": 2}}


def fold_blocks(rows):
    out = []
    for key, text in rows:
        text = " ".join(text.split())
        if out and out[-1][0] == key:
            t = out[-1][1]
            if t and (re.search(T.BAD_ENDING, t.lower()) or not re.search(T.SENTENCE_END, t)):
                out[-1][1] = f"{t} {text}".strip()
                continue
        out.append([key, text])
    return [tuple(x) for x in out]


def test_repair_against_fold(spark):
    r = random.Random(4)
    papers = {f"p{n}": [(r.choice("AB"), r.choice(["x.", "y and", "z", " ", "w (", 'q."'])) for _ in range(r.randrange(12))] for n in range(150)}
    rows = [(p, i, ["t"], k, "methods", "paragraph", t) for p, own in papers.items() for i, (k, t) in enumerate(own)]
    df = spark.createDataFrame(rows, "paper_id string, ord int, section_path array<string>, section_title string, section_type string, content_kind string, text string")
    got = {}
    for x in B.repair_splits(df).orderBy("paper_id", "ord").collect():
        got.setdefault(x.paper_id, []).append((x.section_title, x.text))
    assert got == {p: fold_blocks(own) for p, own in papers.items() if own}


def test_packets_fail_on_unknown(spark):
    blocks = spark.createDataFrame([("p", "p:b0", "x")], "paper_id string, block_id string, text string")
    scope = lambda *b: spark.createDataFrame([("p", "s", list(b))], "paper_id string, experiment_scope_id string, source_block_ids array<string>")
    assert len(B.packets(scope("p:b0"), blocks).first().blocks) == 1
    for bad in (scope("p:b9"), scope()):
        with pytest.raises(Exception, match="unknown or missing block"):
            B.packets(bad, blocks).collect()


def evidence(spark, rows):
    names = "canonical_evidence_id string, paper_id string, study_id string, raw_exposure string, raw_outcomes array<string>, effect_direction string, organism string, evidence_role_in_paper string, assertion_type string, has_quant boolean, has_grounding boolean, canonical_evidence_status string, population_scope string, ordinal int"
    return spark.createDataFrame(rows, names)


def item(n, **over):
    base = dict(id=f"c{n}", paper=f"p{n}", study="s1", exposure="Egg intake", outcomes=["LDL cholesterol"], direction="decrease", organism="human", role="primary_result", assertion="causal_effect", quant=True, ground=True, status="accepted", population=None, n=n)
    return tuple((base | over).values())


def derive(spark, items, design="rct"):
    ev = evidence(spark, items)
    scopes = spark.createDataFrame([(p, "s1", None, 0, design) for p in {i[1] for i in items}], "paper_id string, study_id string, experiment_scope_id string, ordinal int, study_design string")
    tables = E.build(ev, scopes, "b1")
    return tables["exposure_registry"], tables["evidence_projections"], tables["general_evidence"]


def test_derivation(spark):
    ex, rows, general = derive(spark, [item(1), item(2, exposure="Whole egg consumption"), item(3, outcomes=["LDL cholesterol", "BMI"]), item(4, outcomes=None)])
    assert [(r.exposure_id, r.exposure_type) for r in ex.collect()] == [("exposure.egg", "food")]
    assert rows.count() == 5
    by = {r.canonical_evidence_id: r for r in rows.collect()}
    assert by["c1"].evidence_rank == "A" and by["c1"].causal_language_allowed and not by["c1"].requires_caveat
    assert by["c4"].projection_status == "rejected" and by["c4"].rank_reason == "unresolved exposure or outcome"
    g = {r.outcome_id: r for r in general.collect()}
    assert (g["outcome.ldl_cholesterol"].paper_count, g["outcome.ldl_cholesterol"].consensus_level, g["outcome.bmi"].consensus_level) == (3, "weak", "insufficient")


def test_animal_and_counts(spark):
    _, rows, general = derive(spark, [item(1, organism="animal")])
    r = rows.first()
    assert (r.evidence_rank, r.rag_use) == ("C", "mechanistic_only")
    assert general.first().recommendation_use == "mechanistic_only"
    _, _, twice = derive(spark, [item(1), item(2, paper="p1")])
    assert (twice.first().study_count, twice.first().evidence_count) == (1, 2)
    _, _, strong = derive(spark, [item(n, study="s1") for n in range(10)])
    s = strong.first()
    assert (s.consensus_level, s.recommendation_use, s.causal_language_allowed, s.dominant_direction) == ("strong", "directly_usable", True, "decrease")


def test_context_and_equal_outcomes(spark):
    """The context parts groups and votes, whatever the order of its keys; outcomes with one canonical name are one projection."""
    ev = evidence(spark, [item(1, outcomes=["BMI intake", "bmi", "LDL"]), item(2, outcomes=["bmi"]), item(3, outcomes=["bmi"])])
    maps = {"c1": {"b": "x", "a": "\u00e9"}, "c2": {"a": "\u00e9", "b": "x"}, "c3": None}
    contexts = spark.createDataFrame(list(maps.items()), "canonical_evidence_id string, context_identity map<string,string>")
    scopes = spark.createDataFrame([(f"p{n}", "s1", None, 0, "rct") for n in (1, 2, 3)], "paper_id string, study_id string, experiment_scope_id string, ordinal int, study_design string")
    tables = E.build(ev.join(contexts, "canonical_evidence_id"), scopes, "b1")
    assert tables["evidence_projections"].count() == tables["evidence_projections"].select("projection_id").distinct().count() == 4
    got = {(r.outcome_id, r.context_json): r for r in tables["general_evidence"].collect()}
    text = json.dumps(maps["c1"], sort_keys=True, separators=(",", ":"))
    assert {k: r.paper_count for k, r in got.items()} == {("outcome.bmi", text): 2, ("outcome.bmi", "{}"): 1, ("outcome.ldl", text): 1}
    want = json.dumps(["b1", "exposure.egg", "outcome.bmi", "human", None, text], ensure_ascii=False, separators=(",", ":"))
    assert got["outcome.bmi", text].general_evidence_id == "general_evidence_" + hashlib.sha256(want.encode()).hexdigest()
    first = {r.canonical_name: r.aliases for r in tables["outcome_registry"].collect()}
    assert first["bmi"] == ["BMI intake"]  # first in scan order, also within a list
    empty = E.build(ev.limit(0), scopes, "b1")
    assert all(df.count() == 0 for df in empty.values())


def test_published_build_id(spark):
    items = [{"canonical_evidence_id": "c2", "z": [1, {"b": 1, "a": None}], "t": "\u00e9 \\"}, {"canonical_evidence_id": "c1", "n": 1.5}]
    maps = [{"paper_id": "p", "experiment_scopes": []}]
    body = [sorted(items, key=lambda x: x["canonical_evidence_id"]), maps]
    want = "evidence_build_" + hashlib.sha256(json.dumps(body, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    frame = lambda rows, key: spark.createDataFrame([(r[key], json.dumps(r)) for r in rows], "id string, item string").repartition(3)
    assert E.published_build_id(frame(items, "canonical_evidence_id"), frame(maps, "paper_id")) == want


def test_quantitative_and_items(spark):
    rows = spark.createDataFrame([(None, None, None), ("", "", []), ("x", None, None), (None, "s", None), (None, None, [1.0])], "a string, b string, v array<double>")
    assert [r.y for r in rows.select(rules.has_quantitative(c("a"), c("b"), c("v")).alias("y")).collect()] == [False, False, True, True, True]
    papers = spark.createDataFrame([("p", [("e1", 1), None, ("e2", 2)]), ("q", None), ("r", [])], "paper_id string, canonical_evidence array<struct<id: string, n: int>>")
    assert sorted(map(tuple, E.evidence_items(papers).collect())) == [("e1", 1), ("e2", 2)]


def test_published_tables(spark, tmp_path):
    """A build is replaced in all tables by one pointer; other builds and registry rows stay."""
    store = Store(spark, str(tmp_path / "store"), TABLES)
    scopes = spark.createDataFrame([("p1", "s1", None, 0, "rct")], "paper_id string, study_id string, experiment_scope_id string, ordinal int, study_design string")
    tables = lambda b, **over: E.build(evidence(spark, [item(1, **over)]), scopes, b)
    for b, over in (("b1", {}), ("b2", {"exposure": "Sleep"}), ("b1", {"outcomes": ["BMI", "glucose"]})):
        publish(store, tables(b, **over), b)
    rows = store.read("evidence_projections")
    assert sorted((r.build_id, r.outcome_id) for r in rows.collect()) == [("b1", "outcome.bmi"), ("b1", "outcome.glucose"), ("b2", "outcome.ldl_cholesterol")]
    assert sorted(r.exposure_id for r in store.read("exposure_registry").collect()) == ["exposure.egg", "exposure.sleep"]
    assert store.vacuum(older_than=-1) == 4 and store.read("general_evidence").count() == 3


def test_replay_delivers(spark, tmp_path):
    rows = spark.createDataFrame([("o1", "paper", '{"a": 1}', 1), ("o2", "paper", "{}", 0), ("o3", "event", '{"b": 2}', 0), ("o4", "odd", '{"c": 3}', 0), ("o5", "paper", '{"d": 4}', 2)], "outbox_id string, record_type string, payload string, attempt_count int")
    got = []

    def down(_):
        raise OSError("down")

    sinks = {"paper": lambda df: got.extend(r.payload for r in df.collect()), "event": down}
    seen = rows.filter("outbox_id = 'o5'")
    dry = {r.outbox_id: (r.outcome, r.attempt_count) for r in K.replay_outbox(rows, seen, sinks, dry_run=True).collect()}
    assert not got and dry["o1"] == ("pending", 1) and dry["o2"] == ("failed", 1)
    done = {r.outbox_id: (r.outcome, r.error, r.attempt_count) for r in K.replay_outbox(rows, seen, sinks).collect()}
    assert got == ['{"a": 1}']
    assert done == {"o1": ("delivered", None, 2), "o2": ("failed", "empty payload", 1), "o3": ("failed", "down", 1), "o4": ("failed", "no sink for odd", 1), "o5": ("skipped", None, 2)}


def test_citekeys_that_are_taken(spark):
    """Against the loop over rows in order, with natural keys that look like successors."""
    r = random.Random(3)
    rows = [f"{r.choice(['a', 'a:1', 'a 1', 'a_1_1', 'b', 'b:2', 'c d', 'c:d', 'e_7'])}{r.choice(['', ':', '::'])}" for _ in range(60)]
    lake = spark.createDataFrame([(x, "keep", "10.1/x") for x in set(rows)], "metadata_id string, decision string, doi string")
    used, want = set(), {}
    for x in sorted(set(rows)):
        base = re.sub("[^A-Za-z0-9]+", "_", x).strip("_") or "paper"
        key, n = base, 0
        while key in used:
            n += 1
            key = f"{base}_{n}"
        used.add(key)
        want[x] = key
    assert {r.metadata_id: r.citekey for r in D.bibliography(lake).collect()} == want


def test_last_decision(spark):
    found = spark.createDataFrame([("a", "keep", 1), ("a", "drop", 2), ("b", "drop", 1), ("b", "odd", 2)], "candidate_id string, decision string, n int")
    got = {r.candidate_id: r.decision for r in D.decisions(spark.createDataFrame([("a",), ("b",), ("c",)], "candidate_id string"), found, "n").collect()}
    assert got == {"a": "drop", "b": "drop", "c": "uncertain"}


def test_conclusion_guard(spark):
    row = spark.createDataFrame([(False, "usable_with_caveat", "mixed", "decrease", "It reduces risk.")], "causal_language_allowed boolean, recommendation_use string, consensus_level string, dominant_direction string, t string")
    assert row.select(rules.conclusion_faults(c("t")).alias("x")).first().x == ["causal wording is not allowed", "mixed evidence conclusion must mention conflict"]


def test_upsert_and_last_wins(spark):
    ddl = "metadata_id string, doi string, created_at string"
    lake = spark.createDataFrame([("a", "d1", "t0"), ("b", None, "t0"), ("c", "d3", "t0")], ddl)
    new = spark.createDataFrame([("a", "d1", "t1"), ("x", "d3", "t1"), ("y", None, "t1")], ddl)
    assert sorted(map(tuple, D.upsert(lake, new).collect()), key=str) == [("a", "d1", "t0"), ("b", None, "t0"), ("x", "d3", "t0"), ("y", None, "t1")]
    assert sorted(r.metadata_id for r in D.upsert(lake, new, overwrite=False).collect()) == ["a", "b", "c", "y"]


def test_fold_and_metadata(spark):
    ddl = "attempt string, status string, artifact_path string, started_at int, ended_at int, updated_at int"
    got = S.fold(spark.createDataFrame([("a", "running", "p", 1, None, 1), ("a", "failed", None, None, 2, 2), ("a", "running", None, 3, None, 3)], ddl), ["attempt"]).first()
    assert (got.status, got.artifact_path, got.started_at, got.ended_at, got.n_events) == ("running", "p", 1, 2, 3)
    meta = spark.createDataFrame([("a", 1, {"x": "1", "y": "1"}), ("a", 2, {"y": "2"})], "attempt string, t int, metadata map<string,string>")
    assert S.merge_metadata(meta, ["attempt"], "t").first().metadata == {"x": "1", "y": "2"}


def test_validators(spark):
    df = spark.createDataFrame([("b1", "methods", "p", "x"), ("b2", "references", "p", " ")], "block_id string, section_type string, content_kind string, text string")
    got = V.block_input(df, excluded=T.ADMINISTRATIVE_SECTIONS)
    assert [r.errors for r in got.collect()] == [[], ["text is required", "section_type is excluded"]]
    with pytest.raises(Exception, match="text is required"):
        V.strict(got).collect()
    scopes = V.experiment_scopes(spark.createDataFrame([(0, None, "rct", "main_study", ["b"]), (1, "s", "odd", "main_study", [])], "ordinal int, study_id string, study_design string, study_role_in_paper string, source_block_ids array<string>"))
    assert [(r.study_id, r.errors) for r in scopes.collect()] == [("study_1", []), ("s", ["study_design is invalid: odd", "source_block_ids is empty"])]


def test_sources_and_sinks(spark, tmp_path):
    p = str(tmp_path)
    (tmp_path / "good.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\nnope\n')
    assert R.read_jsonl(spark, f"{p}/good.jsonl", "a int").count() == 2
    assert R.read_jsonl(spark, f"{p}/none.jsonl", "a int", missing_ok=True).count() == 0
    assert R.read_jsonl_lenient(spark, f"{p}/bad.jsonl", "a int").collect()[0].a == 1
    with pytest.raises(Exception):
        R.read_jsonl(spark, f"{p}/bad.jsonl", "a int").collect()
    (tmp_path / "dois.txt").write_text('# comment\n10.1/A\n{"doi": "https://doi.org/10.1/b"}\n10.1/a\n')
    assert [r.doi for r in R.read_doi_list(spark, f"{p}/dois.txt").collect()] == ["10.1/a", "10.1/b"]
    assert [r.doi for r in R.load_seeds(spark, f"{p}/none", f"{p}/dois.txt").collect()] == ["10.1/a", "10.1/b"]
    (tmp_path / "words.txt").write_text("Café\n# x\nwhole grain\ncafe\n")
    assert R.read_keywords(spark, f"{p}/words.txt") == ["cafe", "whole grain"]
    (tmp_path / "pdfs").mkdir()
    (tmp_path / "pdfs/x.pdf").write_bytes(b"%PDF-1")
    f = R.list_files(spark, f"{p}/pdfs", "*.pdf").first()
    assert (f.stem, f.hash) == ("x", "sha256:" + hashlib.sha256(b"%PDF-1").hexdigest())
    rows = spark.createDataFrame([("k1", "b1", 1, ["x"]), ("k2", "b2", 1, ["y"])], "k string, build_id string, t int, l array<string>")
    K.replace_build(rows, f"{p}/builds")
    K.replace_build(rows.filter("build_id = 'b1'").withColumn("t", F.lit(9)), f"{p}/builds")
    assert sorted((r.build_id, r.t) for r in spark.read.parquet(f"{p}/builds").collect()) == [("b1", 9), ("b2", 1)]
    K.guarded_overwrite(rows, f"{p}/guarded")
    with pytest.raises(ValueError):
        K.guarded_overwrite(rows.limit(0), f"{p}/guarded")
    assert K.current(spark, f"{p}/guarded").count() == 2
    papers = rows.select(c("k").alias("paper_id"), F.to_json(F.struct("t")).alias("payload"))
    assert [K.write_per_paper(papers, f"{p}/papers") for _ in range(2)] == [2, 0]
    assert K.write_bibliography(spark.createDataFrame([("a", "a", "x"), ("a_1", "a", "y")], "citekey string, base string, entry string"), f"{p}/bib") == {"entries": 2, "renamed": 1}
    (tmp_path / "two").mkdir()
    for n, lines in (("b.txt", "3\n4\n"), ("a.txt", "1\n2\n")):
        (tmp_path / "two" / n).write_text(lines)
    assert [r.line for r in R.ordered_lines(spark, f"{p}/two").orderBy("pos").collect()] == ["1", "2", "3", "4"]
    K.export_table(rows, p, "export")
    assert spark.read.option("header", True).csv(f"{p}/csv/export").orderBy("k").first().l == '["x"]'
    assert K.write_jsonl(rows, f"{p}/out") == 2

    def broken(_):
        raise OSError("down")

    assert not K.deliver(rows, broken, f"{p}/outbox") and spark.read.json(f"{p}/outbox").count() == 2
    old = R.status_index(spark.createDataFrame([("p", "done", 1), ("p", "failed", 2), ("q", "running", 1)], "paper_id string, status string, line int"))
    assert [tuple(r) for r in old.collect()] == [("p", "failed")]


def test_ports(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "k string, n int")
    got = {r.k: (r.m, r.error) for r in R.call_port(df, lambda r: {"k": r["k"], "m": 10 // r["n"]}, "k string, m int").collect()}
    assert got["a"] == (10, None) and got["b"][1].startswith("ZeroDivisionError")
    steps = spark.createDataFrame([("p", 2, 5), ("p", 1, 3)], "k string, i int, n int")
    assert sorted(r.s for r in R.call_port_in_order(steps, "k", "i", lambda r, b: {"k": r["k"], "s": r["n"] + (b["s"] if b else 0)}, "k string, s long").collect()) == [3, 8]
    payload = json.dumps({"doi": "10.1/A", "best_oa_location": {"url_for_pdf": " "}, "oa_locations": [{"url_for_pdf": None}, {"url_for_pdf": "u"}]})
    core = json.dumps({"results": [{"doi": None, "identifiers": [{"type": "DOI", "identifier": "10.1/a"}], "downloadUrl": "c"}]})
    rows = spark.createDataFrame([("10.1/a", "unpaywall", payload), ("10.1/b", "unpaywall", payload), ("10.1/a", "core", core)], "doi string, provider string, payload string")
    assert [r.url for r in R.provider_urls(rows).collect()] == ["u", None, "c"]


def test_config(tmp_path):
    (tmp_path / "a.json").write_text('{"x": {"y": 1, "z": 2}}')
    (tmp_path / "b.json").write_text('{"x": {"y": 3}}')
    assert C.load_config(tmp_path, {"q": 1}) == {"x": {"y": 3, "z": 2}, "q": 1}
    assert C.compile_template("{{a}} {b} {{c}}", {"a": 1, "b": "{x}", "c": 3}) == "1 {x} 3"
    with pytest.raises(ValueError, match="b"):
        C.compile_template("{b}", {})
    assert C.extract_json('```json\n{"a": {"b": "}"}} tail\n```') == {"a": {"b": "}"}}
    (tmp_path / "p.md").write_text("prompt")

    def down(_):
        raise OSError

    assert C.Prompts(tmp_path, down).get("p") == C.Prompts(tmp_path).get("p") == "prompt"
    assert C.first_setting(None, " ", "x", default="y") == "x" and C.selection_mode(" a ", {"a": "b"}) == "b"


def test_metadata_small(spark):
    plan = D.migration_plan(spark.createDataFrame([("a", "1"), ("b", "1")], "name string, hash string"), spark.createDataFrame([("b", "2"), ("c", "3")], "name string, hash string"))
    assert {r.name: r.action for r in plan.collect()} == {"a": "copy", "b": "conflict", "c": "only_new"}
    cands, checked = spark.createDataFrame([("a",), ("b",), ("d",)], "metadata_id string"), spark.createDataFrame([("a", "u"), ("b", None)], "metadata_id string, url string")
    assert [D.retry_set(cands, checked, m).count() for m in ("none", "without_url", "all")] == [1, 2, 3]
