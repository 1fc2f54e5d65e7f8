"""Queries of sources, sinks, stores, streams and ports: each writes what it reads to a folder of its own; they join those of ``registry``."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import commands
from ..functions import text as T
from ..operators import blocks as B
from ..operators import evidence as E
from ..operators import markdown as M
from ..operators import metadata as D
from ..operators import records as O
from ..operators import state as S
from ..operators import store
from ..operators.ordering import numbered, tuple_text
from ..operators import validation as V
from ..sources import config as C
from ..sources import moves
from ..sources import readers as R
from ..sources import sinks as K
from ..sources.paged import Service, register_paged
from ..sources.tables import BrokenRulesError, Store, Table
from ..streaming import events as X
from . import views as v
from .registry import ORACLE_SQL, _BL, _EV, _FACTS, _LK, _PS, _blocks, _facts, _general, _grouped, _lake, _projections, query

c = F.col


def _made(spark, tag: str, write) -> str:
    path = K.scratch(spark, tag)
    write(path)
    return path


# Sources and plain sinks


@query("src01_src02_snk01_snk02_jsonl", "SELECT doc_id, source, n_chars FROM documents")
def jsonl(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    path = K.scratch(spark, "jsonl")
    K.write_jsonl(docs.filter("doc_id % 2 = 0"), path)
    K.append_jsonl(docs.filter("doc_id % 2 <> 0"), path)
    ddl = "doc_id long, source string, n_chars long"
    return R.read_jsonl(spark, path, ddl).unionByName(R.read_jsonl(spark, f"{path}-none", ddl, missing_ok=True))


@query("src03_lenient_jsonl", "SELECT doc_id, source FROM documents WHERE doc_id % 5 <> 0")
def lenient(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents")
    line = F.when(c("doc_id") % 5 != 0, F.to_json(F.struct("doc_id", "source"))).otherwise(F.concat(F.lit('{"doc_id": '), "doc_id"))
    path = _made(spark, "lines", lambda p: docs.select(line.alias("value")).write.text(p))
    return R.read_jsonl_lenient(spark, path, "doc_id long, source string")


@query("src05_src08_set06_doi_lists", _LK + " SELECT DISTINCT doi FROM lk WHERE doi IS NOT NULL")
def doi_lists(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    as_json = F.to_json(F.struct(c("raw_doi").alias("doi")))
    line = F.explode(F.array(F.lit("# note"), F.coalesce("raw_doi", F.lit("")), F.when(c("doc_id") % 2 == 0, as_json).otherwise(F.coalesce("raw_doi", F.lit("")))))
    path = _made(spark, "dois", lambda p: lake.select(line.alias("value")).write.text(p))
    return R.load_seeds(spark, path, f"{path}-none").select("doi")


@query("src06_keyword_dictionary", "SELECT k AS keyword, row_number() OVER (ORDER BY min(p_partkey)) AS place FROM (SELECT p_partkey, array_to_string(regexp_extract_all(lower(p_name), '[a-z0-9]+'), ' ') AS k FROM part) WHERE k <> '' GROUP BY k")
def keyword_dictionary(spark, sf_dir):
    """The names of parts as a dictionary with notes and blank lines."""
    parts = v.table(spark, sf_dir, "part").orderBy("p_partkey")
    path = _made(spark, "words", lambda p: parts.select(F.explode(F.array(F.lit("# note"), F.concat(F.lit(" "), "p_name"), F.lit(""), F.initcap("p_name"))).alias("value")).write.text(p))
    return numbered(R.keyword_lines(spark, path), [c("pos")]).select("keyword", "place")


@query("src09_snk16_aux24_paper_files", "SELECT 'sha256:' || sha256(chr(123) || '\"name\":\"' || s_name || '\"}' || chr(10)) AS hash, count(*) AS n FROM supplier GROUP BY 1")
def paper_files(spark, sf_dir):
    papers = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("p"), "s_suppkey").alias("paper_id"), F.to_json(F.struct(c("s_name").alias("name"))).alias("payload"))
    path = K.scratch(spark, "papers")
    K.write_per_paper(papers.filter("hash(paper_id) % 2 = 0"), path)
    K.write_per_paper(papers, path)  # the rest: what is there stays
    return R.list_files(spark, path, "*.txt", deep=True).groupBy("hash").agg(F.count("*").alias("n"))


@query("src11_src12_src13_aux09_tables", "SELECT 'one' AS part, 'paper_7' AS paper_id, count(*) AS n FROM orders WHERE o_custkey = 7 UNION ALL SELECT 'first', paper_id, 1 FROM (SELECT DISTINCT 'paper_' || o_custkey AS paper_id FROM orders ORDER BY 1 LIMIT 10) UNION ALL SELECT 'all', 'any', count(*) FROM orders")
def tables(spark, sf_dir):
    rows = v.table(spark, sf_dir, "orders").select(F.concat(F.lit("paper_"), "o_custkey").alias("paper_id"), "o_orderkey")
    folder = _made(spark, "tables", lambda p: rows.write.parquet(f"{p}/canonical_evidence"))
    found = R.read_table(spark, folder, "canonical_evidence")
    part = lambda df, name, who, n: df.agg(n.alias("n")).select(F.lit(name).alias("part"), F.lit(who).alias("paper_id"), "n")
    first = R.ordered_ids(found, "paper_id", 10).select(F.lit("first").alias("part"), "paper_id", F.lit(1).cast("long").alias("n"))
    return part(R.point_lookup(found, "paper_id", "paper_7"), "one", "paper_7", F.count("*")).unionByName(first).unionByName(part(found, "all", "any", F.count("*")))


@query("src14_aux01_sibling_maps", "SELECT s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 'design ' || s_suppkey % 4 END AS design FROM supplier")
def sibling_maps(spark, sf_dir):
    rows = v.table(spark, sf_dir, "supplier").withColumn("paper_id", c("s_suppkey").cast("string"))
    folder = K.scratch(spark, "siblings")
    K.write_per_paper(rows.select("paper_id", F.to_json(F.struct(c("s_name").alias("name"))).alias("payload")), f"{folder}/evidence")
    designs = rows.filter("s_suppkey % 3 <> 0").select("paper_id", F.concat(F.lit("design "), (c("s_suppkey") % 4).cast("string")).alias("design"))
    K.write_per_paper(designs.select("paper_id", F.to_json(F.struct("design")).alias("payload")), f"{folder}/maps")
    evidence, maps = R.read_json_documents(spark, f"{folder}/evidence", "name string"), R.read_json_documents(spark, f"{folder}/maps", "design string")
    return R.join_siblings(evidence, maps, ["design"]).select("name", "design")


def _pages_of(request: dict, offset: int, size: int) -> list[dict]:
    every = [y for y in range(request["n"]) if 1990 + y % 36 >= request["min_year"]]
    return [{"item": y} for y in every[offset : offset + size]]


@query("src15_paged_source", "SELECT c_custkey, count(*) AS n, CAST(sum(i) AS BIGINT) AS items FROM (SELECT c_custkey, unnest(range(c_custkey * 37 % 330)) AS i FROM customer) WHERE 1990 + i % 36 >= 2005 GROUP BY 1")
def paged(spark, sf_dir):
    requests = v.table(spark, sf_dir, "customer").select("c_custkey", (c("c_custkey") * 37 % 330).alias("n"), F.lit(2005).alias("min_year"))
    rows = R.read_paged(requests, _pages_of, "c_custkey long, item long")
    return rows.groupBy("c_custkey").agg(F.count("*").alias("n"), F.sum("item").alias("items"))


def _fetched(row: dict) -> dict:
    if row["doc_id"] % 11 == 0:
        raise ValueError("not found")
    return {"doc_id": row["doc_id"], "title": f"paper {row['doc_id']}", "pages": row["doc_id"] % 7}


@query("src16_src18_aux15_ports", "SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN 'paper ' || doc_id END AS title, CASE WHEN doc_id % 11 <> 0 THEN doc_id % 7 END AS pages, CASE WHEN doc_id % 11 = 0 THEN 'ValueError: not found' END AS error FROM documents")
def ports(spark, sf_dir):
    return R.call_port(v.table(spark, sf_dir, "documents").select("doc_id"), _fetched, "doc_id long, title string, pages double").withColumn("pages", c("pages").cast("long"))


@query("aux02_flt02_metadata_from_doi", _LK + " SELECT 'meta:crossref:' || doi AS metadata_id, doi, 'paper ' || doc_id AS title FROM lk WHERE doi IS NOT NULL AND doc_id % 11 <> 0")
def from_doi(spark, sf_dir):
    lake = _lake(spark, sf_dir).filter("doi is not null").select("doc_id", "doi")
    fetched = R.call_port(lake, lambda r: {**_fetched(r), "doi": r["doi"]}, "doc_id long, doi string, title string").filter("error is null")
    papers = fetched.select(F.lit(None).cast("string").alias("source_paper_id"), "doi", "title", *[F.lit(None).cast("string").alias(x) for x in ("year", "citation_count", "pdf_url", "decision")])
    return D.lake_records(papers).select("metadata_id", "doi", "title")


@query("src17_scl31_scl32_provider_urls", _LK + """ SELECT metadata_id, CASE doc_id % 3 WHEN 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'best' || doc_id ELSE 'other' || doc_id END WHEN 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'core' || doc_id END ELSE 'pmc' || doc_id END AS url FROM lk WHERE doi IS NOT NULL""")
def provider_url(spark, sf_dir):
    lake = _lake(spark, sf_dir).filter("doi is not null").withColumn("even", c("doc_id") % 2 == 0)
    named = lambda name: F.concat(F.lit(name), "doc_id")
    place = lambda x: F.struct(x.alias("url_for_pdf"))
    unpaywall = F.to_json(F.struct(c("raw_doi").alias("doi"), place(F.when(c("even"), named("best")).otherwise(" ")).alias("best_oa_location"), F.array(place(F.lit("")), place(named("other"))).alias("oa_locations")))
    wrong = F.struct(F.array(F.struct(F.lit("DOI").alias("type"), F.lit("10.9/none").alias("identifier"))).alias("identifiers"), F.lit("wrong").alias("downloadUrl"))
    right = F.struct(F.array(F.struct(F.lit("DOI").alias("type"), c("doi").alias("identifier"))).alias("identifiers"), named("core").alias("downloadUrl"))
    core = F.to_json(F.struct(F.when(c("even"), F.array(wrong, right)).otherwise(F.array(wrong)).alias("results")))
    links = F.array(F.struct(F.lit("html").alias("documentStyle"), F.lit("page").alias("url")), F.struct(F.lit("pdf").alias("documentStyle"), named("pmc").alias("url")))
    pmc = F.to_json(F.struct(F.struct(F.array(F.struct("doi", F.struct(links.alias("fullTextUrl")).alias("fullTextUrlList"))).alias("result")).alias("resultList")))
    k = c("doc_id") % 3
    asked = lake.select("metadata_id", "doi", F.when(k == 0, "unpaywall").when(k == 1, "core").otherwise("europe_pmc").alias("provider"), F.when(k == 0, unpaywall).when(k == 1, core).otherwise(pmc).alias("payload"))
    return R.provider_urls(asked).select("metadata_id", "url")


@query("src19_src20_scl27_scl35_scl36_scl47_aux33_settings", """SELECT c_custkey, '{"a": {"b": "}' || c_custkey || '"}}' AS answer, c_name || ' {x} ' || c_custkey AS compiled, '{"seen": ' || c_custkey || ', "x": {"y": 3, "z": 2}}' AS merged,
CASE WHEN c_custkey % 2 = 0 THEN 'full_text' ELSE 'abstract' END AS mode, CASE WHEN c_custkey % 3 = 0 THEN 'from the folder' ELSE 'remote ' || c_custkey END AS prompt, '{"model": "' || c_mktsegment || '"}' AS public, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'unset' END AS value FROM customer""")
def settings(spark, sf_dir):
    """Settings, prompts and answers for each customer: files are read once, by Spark, and overlaid with the row's values."""
    from ..functions.ids import public_config

    cust = v.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    files = spark.createDataFrame([("a.json", '{"x": {"y": 1, "z": 2}}'), ("b.json", '{"x": {"y": 3}}'), ("p.md", "from the folder")], "name string, value string")
    folder = _made(spark, "settings", lambda p: files.coalesce(1).write.partitionBy("name").text(p))
    texts = {k: C.texts_in(spark, f"{folder}/name={k}") for k in ("a.json", "b.json", "p.md")}
    texts = {k: next(iter(t.values())).rstrip("\n") for k, t in texts.items()}

    def settled(row: dict) -> dict:
        k = row["c_custkey"]

        def remote(_: str) -> str:
            if k % 3 == 0:
                raise OSError("the registry is down")
            return f"remote {k}"

        return {
            "c_custkey": k, "answer": json.dumps(C.extract_json(f'```json\n{{"a": {{"b": "}}{k}"}}}} tail\n```')), "compiled": C.compile_template("{{name}} {b} {{key}}", {"name": row["c_name"], "b": "{x}", "key": k}),
            "merged": json.dumps(C.load_config(texts, {"seen": k}), sort_keys=True), "mode": C.selection_mode(" full " if k % 2 == 0 else "short", {"full": "full_text", "short": "abstract"}), "prompt": C.Prompts(texts, remote).get("p"),
            "public": json.dumps(public_config({"api_key": str(k), "model": row["c_mktsegment"]})), "value": C.first_setting(None, " ", row["c_name"] if k % 2 == 0 else None, default="unset"),
        }

    names = ["answer", "compiled", "merged", "mode", "prompt", "public", "value"]
    return R.call_port(cust, settled, "c_custkey long, " + ", ".join(f"{x} string" for x in names)).filter("error is null").drop("error")


# Stores


def _upserted(spark, name: str, rows: DataFrame) -> DataFrame:
    """A table after two upserts: of the earlier rows, then of the later ones."""
    stored = Store(spark, K.scratch(spark, name), {name: store.TABLES[name]})
    for part in (rows.filter("updated_at <= 1"), rows.filter("not (updated_at <= 1)")):
        stored.commit(stored.upsert(name, part, "updated_at"))
    return stored.read(name)


@query("snk05_aux10_structured_papers", "SELECT 'paper_' || o_custkey AS paper_id, '{\"paper_id\":\"paper_' || o_custkey || '\",\"title\":\"t' || max(o_orderkey) || '\"}' AS payload FROM orders GROUP BY o_custkey")
def structured_papers(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select(F.concat(F.lit(" paper_"), "o_custkey").alias("paper_id"), F.concat(F.lit("t"), "o_orderkey").alias("title"), F.lit("x.pdf").alias("source_pdf"), c("o_orderkey").alias("at"))
    rows = store.structured_papers(o.select("paper_id", "title", "source_pdf"), F.regexp_extract("title", "([0-9]+)", 1).cast("long"))
    return _upserted(spark, "structured_papers", rows).select("paper_id", "payload")


@query("snk06_structured_blocks", _BL + " SELECT block_id, paper_id, ord AS block_order, section_type, content_kind, text FROM bk")
def structured_blocks(spark, sf_dir):
    b = _blocks(spark, sf_dir).select("paper_id", F.struct("block_id", c("ord").alias("order"), "section_type", "content_kind", "text").alias("b"))
    papers = b.groupBy("paper_id").agg(F.collect_list("b").alias("blocks"))
    stored = _upserted(spark, "structured_blocks", store.structured_blocks(papers, F.pmod(F.hash("paper_id"), F.lit(3)).cast("long")))
    return stored.select("block_id", "paper_id", c("block_order").cast("long").alias("block_order"), "section_type", "content_kind", "text")


@query("snk07_classifications", "SELECT 'paper_' || o_custkey AS paper_id, CASE WHEN o_orderkey % 2 = 0 THEN 'run_1' ELSE 'unknown' END AS pipeline_run_id, arg_max(CASE o_orderstatus WHEN 'F' THEN 'primary_research' ELSE 'methodological' END, o_orderkey) AS paper_family FROM orders GROUP BY 1, 2")
def classifications(spark, sf_dir):
    family = F.when(c("o_orderstatus") == "F", "primary_research").otherwise("methodological")
    o = v.table(spark, sf_dir, "orders").select(F.concat(F.lit("paper_"), "o_custkey").alias("paper_id"), F.when(c("o_orderkey") % 2 == 0, "run_1").when(c("o_orderkey") % 3 == 0, " ").alias("pipeline_run_id"), family.alias("paper_family"), "o_orderkey")
    return _upserted(spark, "paper_classifications", store.classifications(o, c("o_orderkey"))).select("paper_id", "pipeline_run_id", "paper_family")


@query("snk08_scl48_experiment_maps", "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'map_' || c_custkey ELSE 'experiment_map_' || sha256('[\"experiment_map\",\"paper_' || c_custkey || '\",{\"experiment_scopes\":[\"s' || c_custkey || '\"],\"unmapped_block_ids\":[]}]') END AS experiment_map_id, 'paper_' || c_custkey AS paper_id FROM customer")
def experiment_maps(spark, sf_dir):
    cust = v.table(spark, sf_dir, "customer")
    rows = cust.select(F.concat(F.lit("paper_"), "c_custkey").alias("paper_id"), F.array(F.concat(F.lit("s"), "c_custkey")).alias("experiment_scopes"), F.array().cast("array<string>").alias("unmapped_block_ids"), F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("map_"), "c_custkey")).alias("experiment_map_id"))
    return _upserted(spark, "experiment_maps", store.experiment_maps(rows, F.length("paper_id").cast("long") - 6)).select("experiment_map_id", "paper_id")


@query("snk09_nst03_canonical_evidence", f"WITH ev AS ({v.duck(v.EVIDENCE)}) SELECT CASE WHEN ordinal % 3 = 0 THEN 'canonical_evidence_' || sha256(CAST(to_json(list_value(paper_id, study_id, '{{\"effect_direction\":\"' || effect_direction || '\",\"evidence_type\":null,\"ordinal\":' || ordinal || ',\"paper_id\":\"' || paper_id || '\",\"study_id\":\"' || study_id || '\"}}')) AS VARCHAR)) ELSE canonical_evidence_id END AS canonical_evidence_id, paper_id, study_id, 'unclear' AS evidence_type, effect_direction FROM ev")
def stored_evidence(spark, sf_dir):
    ev = v.view(spark, sf_dir, v.EVIDENCE)
    item = F.struct(F.when(c("ordinal") % 3 != 0, c("canonical_evidence_id")).alias("canonical_evidence_id"), "paper_id", "study_id", F.lit(None).cast("string").alias("evidence_type"), "effect_direction", "ordinal")
    papers = ev.groupBy("paper_id").agg(F.concat(F.collect_list(item), F.array(F.lit(None).cast("struct<canonical_evidence_id: string, paper_id: string, study_id: string, evidence_type: string, effect_direction: string, ordinal: bigint>"))).alias("canonical_evidence"))
    rows = store.canonical_evidence(E.evidence_items(papers), F.pmod("ordinal", F.lit(3)))
    return _upserted(spark, "canonical_evidence", rows).select("canonical_evidence_id", "paper_id", "study_id", "evidence_type", "effect_direction")


_STATUS = _FACTS + """, fi AS (SELECT 'paper_' || s_suppkey AS paper_id, s_suppkey % 2 = 0 AS has_pdf, s_suppkey % 3 > 0 AS has_markdown FROM supplier)
SELECT paper_id, coalesce(has_pdf, false) AS has_pdf, coalesce(has_structured_paper, false) AS has_structured_paper, paper_family FROM fi FULL JOIN fa USING (paper_id)"""


def _processing(spark, sf_dir):
    files = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("paper_"), "s_suppkey").alias("paper_id"), (c("s_suppkey") % 2 == 0).alias("has_pdf"), (c("s_suppkey") % 3 > 0).alias("has_markdown"))
    return S.processing_state(files, _facts(spark, sf_dir))


@query("snk11_aux11_processing_states", _STATUS)
def processing_states(spark, sf_dir):
    rows = _processing(spark, sf_dir).withColumn("updated_at", F.pmod(F.hash("paper_id"), F.lit(3)).cast("long"))
    return _upserted(spark, "paper_processing_state", rows).select("paper_id", "has_pdf", "has_structured_paper", "paper_family")


@query("snk14_aux13_state_csv", _STATUS)
def state_csv(spark, sf_dir):
    path = _made(spark, "state", lambda p: K.write_state_csv(_processing(spark, sf_dir).withColumn("extra", F.lit("ignored")), p))
    found = spark.read.option("header", True).csv(path)
    assert found.columns == [x for x in K.STATE_COLUMNS if x in found.columns] and "extra" not in found.columns
    return found.select("paper_id", c("has_pdf").cast("boolean").alias("has_pdf"), c("has_structured_paper").cast("boolean").alias("has_structured_paper"), "paper_family")


@query("snk10_val10_published_build", _EV + " SELECT 'evidence_projections' AS name, projection_id AS id FROM pr UNION ALL SELECT 'general_evidence', general_evidence_id FROM ge UNION ALL SELECT 'outcome_registry', 'outcome.' || n FROM our")
def published_build(spark, sf_dir):
    """A build that holds a tenth of the rows, under other ids, is replaced by the whole one, which is published twice.

    Its rows are there once, and all of its build. A publication that breaks a rule, and one of a single table, change no other rows.
    """
    stored = Store(spark, K.scratch(spark, "store"), store.TABLES)
    tables = E.build(v.evidence(spark, sf_dir), v.view(spark, sf_dir, v.SCOPES), v.BUILD, store.staging(stored, v.BUILD))
    earlier = dict(tables)
    for name, ids in {"evidence_projections": ["projection_id"], "general_evidence": ["general_evidence_id"], "general_evidence_support": ["general_evidence_id", "projection_id"]}.items():
        for k in ids:
            earlier[name] = earlier[name].filter(F.crc32(k) % 10 == 0).withColumn(k, F.concat(F.lit("earlier_"), k))
    store.publish(stored, earlier, v.BUILD)
    store.publish(stored, tables, v.BUILD)
    store.publish(stored, tables, v.BUILD)
    try:
        store.publish(stored, {"evidence_projections": tables["evidence_projections"].limit(0)}, v.BUILD)
        raise AssertionError("edges were left without their projections")
    except BrokenRulesError:
        store.publish(stored, {"retrieval_export": stored.read("retrieval_export")}, v.BUILD)
    key = {"evidence_projections": "projection_id", "general_evidence": "general_evidence_id", "outcome_registry": "outcome_id"}
    parts = []
    for name, k in key.items():
        rows = stored.read(name)
        rows = V.one_build(rows, v.BUILD).filter(F.size("errors") == 0) if "build_id" in rows.columns else rows
        parts.append(rows.select(F.lit(name).alias("name"), c(k).alias("id")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("snk03_metadata_store", ORACLE_SQL["snk03_upsert_lake"])
def metadata_store(spark, sf_dir):
    papers = v.view(spark, sf_dir, v.PAPERS).withColumn("doi", T.normalize_doi(c("raw_doi")))
    stored = commands.open_store(spark, K.scratch(spark, "store"))
    for cond, version, at in (("doc_id % 3 <> 0", "v1", "old"), ("doc_id % 3 <> 1", "v2", "new")):
        commands.upsert_metadata(stored, papers.filter(cond).select("metadata_id", "doi", "title", F.lit(version).alias("version"), F.lit(at).alias("created_at")))
    return stored.read("paper_metadata").select("metadata_id", "doi", "version", "created_at")


@query("aux02_from_doi_store", _LK + " SELECT doi, CASE WHEN doc_id % 2 = 0 AND doc_id % 11 <> 0 THEN 'skipped' WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'created' END AS status FROM lk WHERE doi IS NOT NULL")
def from_doi_store(spark, sf_dir):
    """DOIs of even documents are fetched first, then all: what the store has is not asked for again."""
    lake, stored = _lake(spark, sf_dir).filter("doi is not null"), commands.open_store(spark, K.scratch(spark, "store"))

    def fetch(row: dict) -> dict:
        if int(row["doi"].rpartition("doc")[2]) % 11 == 0:
            raise ValueError("not found")
        return {"title": f"paper {row['doi']}"}

    K.kept(commands.metadata_from_dois(stored, lake.filter("doc_id % 2 = 0").select("doi"), fetch, "now"), "first")
    return commands.metadata_from_dois(stored, lake.select("doi"), fetch, "later").select("doi", "status")


@query("snk12_aux14_status_file", _PS + " SELECT paper_id, CASE s WHEN 'succeeded' THEN 'done' ELSE s END AS status FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY event_at DESC) AS n FROM se) WHERE n = 1 AND s IN ('succeeded', 'failed')")
def status_file(spark, sf_dir):
    log = S.events_to_states(v.view(spark, sf_dir, v.EVENTS)).select("paper_id", F.when(c("status") == "succeeded", "done").otherwise(c("status")).alias("status"), c("event_at").alias("line"))
    stored, cut = Store(spark, K.scratch(spark, "status"), {"status": Table(("paper_id",))}), log.agg(F.expr("percentile(unix_micros(cast(line as timestamp)), 0.5)")).first()[0]
    late = F.unix_micros(c("line").cast("timestamp")) > cut
    for part in (log.filter(~late), log.filter(late)):
        stored.commit(stored.upsert("status", part.groupBy("paper_id").agg(F.max(F.struct("line", "status")).alias("r")).select("paper_id", "r.status", "r.line"), "line"))
    return R.status_index(stored.read("status")).orderBy("paper_id")


@query("snk15_bibliography_file", _LK + " SELECT count(*) AS entries, 0 AS renamed, count(*) AS in_file FROM lk WHERE decision = 'keep' AND doi IS NOT NULL")
def bibliography_file(spark, sf_dir):
    path = K.scratch(spark, "bib")
    counts = K.write_bibliography(D.bibliography(_lake(spark, sf_dir)), path)
    return spark.read.text(path).filter("value like '@article%'").agg(F.lit(counts["entries"]).cast("long").alias("entries"), F.lit(counts["renamed"]).alias("renamed"), F.count("*").alias("in_file"))


@query("snk17_snk18_str03_str04_outbox", "SELECT CASE WHEN c_custkey % 4 = 0 THEN 'skipped' WHEN c_custkey % 3 = 0 THEN 'failed' ELSE 'delivered' END AS outcome, count(*) AS n, CAST(sum(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS attempts FROM customer GROUP BY 1")
def outbox(spark, sf_dir):
    def down(_):
        raise OSError("the store is down")

    cust, path = v.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), K.scratch(spark, "outbox")
    for _ in range(2):  # the same batches come again: they are stored once
        K.deliver(cust.filter("c_custkey % 3 <> 0"), down, path, batch=1, record_type="customer")
        K.deliver(cust.filter("c_custkey % 3 = 0"), down, path, batch=2, record_type="unknown")
    rows = spark.read.schema("outbox_id string, record_type string, payload string, error string, attempt_count int, batch int").json(path).drop("error")
    arrived = []
    report = K.replay_outbox(rows, rows.filter("get_json_object(payload, '$.c_custkey') % 4 = 0"), {"customer": lambda df: arrived.append(df.count())})
    return report.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("attempt_count").alias("attempts"))


@query("snk19_guarded_overwrite", "SELECT n_nationkey, n_name FROM nation")
def guarded(spark, sf_dir):
    path, rows = K.scratch(spark, "guarded"), v.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    K.guarded_overwrite(rows, path)
    try:
        K.guarded_overwrite(rows.limit(0), path)
    except ValueError:
        return K.current(spark, path)
    raise AssertionError("rows were replaced by none")


@query("snk20_sample_bundle", "SELECT 'paper_' || c_custkey AS paper_id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_evidence, c_custkey % 3 <> 0 AS missing_pdf FROM customer WHERE c_custkey % 2 = 0")
def sample_bundle(spark, sf_dir):
    named = lambda k: F.concat(F.lit("paper_"), k).alias("paper_id")
    cust, evidence = v.table(spark, sf_dir, "customer"), v.table(spark, sf_dir, "orders").select(named("o_custkey"))
    return K.sample_bundle(cust.filter("c_custkey % 2 = 0").select(named("c_custkey")), evidence, cust.filter("c_custkey % 3 = 0").select(named("c_custkey")))


@query("snk20_bundle_files", "SELECT 'paper_' || s_suppkey AS paper_id, n AS evidence_rows, n AS in_csv, n AS in_json, s_suppkey % 3 <> 0 AS missing_pdf FROM (SELECT s_suppkey, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS n FROM supplier WHERE s_acctbal > 0)")
def bundle_files(spark, sf_dir):
    """A bundle of the suppliers with money, their items as evidence, read back from its files."""
    named = lambda k: F.concat(F.lit("paper_"), k).alias("paper_id")
    papers, root = v.table(spark, sf_dir, "supplier"), K.scratch(spark, "bundle")
    evidence = v.table(spark, sf_dir, "lineitem").select(named("l_suppkey"), "l_orderkey", F.array(F.concat(F.lit("b"), "l_linenumber")).alias("source_block_ids"))
    moves.write_files(papers.filter("s_suppkey % 3 = 0").select(F.concat(F.lit(f"{root}/in/"), named("s_suppkey"), F.lit(".pdf")).alias("path"), c("s_name").cast("binary").alias("content")))
    commands.write_sample_bundle(papers.filter("s_acctbal > 0").select(named("s_suppkey")), evidence, f"{root}/in", f"{root}/out", "now")
    manifest = spark.read.option("header", True).csv(f"{root}/out/manifest.csv")
    rows = spark.read.option("header", True).csv(f"{root}/out/canonical_evidence.csv").filter("source_block_ids like '[\"b%\"]'").groupBy("paper_id").agg(F.count("*").alias("in_csv"))
    items = R.read_jsonl(spark, f"{root}/out/canonical_evidence.json", "paper_id string, source_block_ids array<string>").groupBy("paper_id").agg(F.count("*").alias("in_json"))
    j = manifest.join(rows, "paper_id", "left").join(items, "paper_id", "left")
    return j.select("paper_id", c("evidence_rows").cast("long").alias("evidence_rows"), F.coalesce("in_csv", F.lit(0)).alias("in_csv"), F.coalesce("in_json", F.lit(0)).alias("in_json"), c("missing_pdf").cast("boolean").alias("missing_pdf"))


@query("snk21_aux31_link_rows", _LK + " SELECT metadata_id, sha256(metadata_id) AS paper_id, 'artifacts/pdfs/' || sha256(metadata_id) || '.pdf' AS artifact_pdf_path FROM lk")
def link_rows(spark, sf_dir):
    return D.link_rows(_lake(spark, sf_dir).withColumn("source_pdf_path", F.lit("in.pdf")), "now").select("metadata_id", "paper_id", "artifact_pdf_path")


@query("snk21_snk23_aux31_moved_files", "SELECT 's' || s_suppkey AS name, CASE WHEN s_suppkey % 5 = 0 THEN 'missing' WHEN s_suppkey % 3 = 0 THEN 'conflict' WHEN s_suppkey % 7 = 0 THEN 'same' ELSE 'copied' END AS outcome, s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 AS equal FROM supplier")
def moved_files(spark, sf_dir):
    """A file per supplier copied to its new place: some are there already, alike or not, and some sources are missing. A second run finds all done."""
    rows = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("name"), "s_suppkey", "s_name")
    root = K.scratch(spark, "moves")
    at = lambda side: F.concat(F.lit(f"{root}/{side}/name="), "name", F.lit("/x.pdf"))
    moves.write_files(rows.filter("s_suppkey % 5 <> 0").select(at("old").alias("path"), c("s_name").cast("binary").alias("content")))
    there = rows.filter("s_suppkey % 5 <> 0 and (s_suppkey % 3 = 0 or s_suppkey % 7 = 0)")
    moves.write_files(there.select(at("new").alias("path"), F.when(c("s_suppkey") % 3 == 0, "other").otherwise(c("s_name")).cast("binary").alias("content")))
    plan = rows.select(at("old").alias("source"), at("new").alias("target"), "name")
    first = K.kept(moves.copy_files(plan), "report")
    again = moves.copy_files(plan).select("target", c("outcome").alias("second"), c("sha256").alias("now"))
    done = first.join(again, "target").filter("second = if(outcome = 'copied', 'same', outcome)")
    return done.select("name", "outcome", (c("second") == "same").alias("equal"))


# Filters, nested values, scalars, validators


@query("flt09_primary_research", "SELECT o_orderkey, 'paper_' || o_custkey AS paper_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def primary_research(spark, sf_dir):
    named = lambda k: F.concat(F.lit("paper_"), k).alias("paper_id")
    families = v.table(spark, sf_dir, "customer").select(named("c_custkey"), F.when(c("c_mktsegment") == "BUILDING", "primary_research").when(c("c_mktsegment") != "MACHINERY", "review").alias("paper_family"))
    return store.primary_research(v.table(spark, sf_dir, "orders").select("o_orderkey", named("o_custkey")), families)


@query("flt13_retry_sets", _LK + " SELECT m AS mode, metadata_id FROM lk, (SELECT unnest(['none', 'without_url', 'all']) AS m) WHERE m = 'all' OR doc_id % 3 <> 0 OR (m = 'without_url' AND doc_id % 2 <> 0)")
def retry_sets(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    checked = lake.filter("doc_id % 3 = 0").select("metadata_id", F.when(c("doc_id") % 2 == 0, "u").alias("url"))
    parts = [D.retry_set(lake.select("metadata_id"), checked, m).select(F.lit(m).alias("mode"), "metadata_id") for m in ("none", "without_url", "all")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("agg13_section_registry", f"WITH raw AS ({v.duck(v.BLOCKS)}), r AS (SELECT paper_id, ord, row_number() OVER (PARTITION BY paper_id, lower(section_title), lower(section_type), paper_id ORDER BY ord) AS n FROM raw) SELECT paper_id, ord FROM r WHERE n = 1")
def section_registry(spark, sf_dir):
    raw = v.view(spark, sf_dir, v.BLOCKS).select("paper_id", c("section_title").alias("title"), c("section_type").alias("type"), c("paper_id").alias("parent"), F.floor(c("ord") / 5).alias("batch"), c("ord").cast("long").alias("ord"))
    return B.merge_registries(raw).select("paper_id", "ord")


@query("nst04_nst08_scl20_cleaned_records", "SELECT doc_id, source || ' b' AS first, 'x' AS second, CASE WHEN doc_id % 2 = 0 THEN 'high' END AS confidence FROM documents")
def cleaned_records(spark, sf_dir):
    marked = F.concat(F.lit("¶ *"), "source", F.lit("*   b_X_"))
    rows = v.table(spark, sf_dir, "documents").select("doc_id", F.struct(F.array(marked, F.lit("x<!-- z -->")).alias("texts")).alias("value"), F.struct(F.when(c("doc_id") % 2 == 0, "high").alias("confidence"), F.lit(True).alias("is_truncated")).alias("quality"))
    rows = rows.withColumns({"value": O.cleaned(c("value"), rows.schema["value"].dataType), "quality": O.pruned_quality(c("quality"), rows.schema["quality"].dataType)})
    return rows.select("doc_id", c("value.texts")[0].alias("first"), c("value.texts")[1].alias("second"), c("quality.confidence").alias("confidence"))


@query("scl14_scl16_scl17_section_keys", _BL + " SELECT paper_id, ord AS source_ord, section_title, k AS section_key FROM b0")
def section_keys(spark, sf_dir):
    raw = v.view(spark, sf_dir, v.BLOCKS)
    title = T.section_title(c("section_title"))
    return raw.select("paper_id", c("ord").cast("long").alias("source_ord"), title.alias("section_title"), F.lower(title).alias("section_key"))


@query("scl19_scl22_scl23_scl30_val09_scalars", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'paper-' || doc_id ELSE 'my-file-' || doc_id END AS slug, CASE WHEN doc_id % 3 = 0 THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS number, doc_id % 7 = 0 AS is_pdf FROM documents")
def scalars(spark, sf_dir):
    i = c("doc_id")
    q = T.quality(F.when(i % 3 == 0, "high").when(i % 3 == 1, "odd"), F.lit(None).cast("boolean"), F.lit(None).cast("boolean"))
    number = F.when(i % 5 == 0, F.concat(i.cast("string"), F.lit(".7"))).otherwise(F.concat(F.lit(" "), i.cast("string")))
    content = F.concat(F.when(i % 7 == 0, "%PDF-1").otherwise("PK"), i.cast("string")).cast("binary")
    slug = T.source_slug(F.when(i % 2 == 0, F.concat(F.lit("Paper "), i)).otherwise(" "), F.concat(F.lit("dir/My File "), i, F.lit(".pdf")))
    return v.table(spark, sf_dir, "documents").select("doc_id", slug.alias("slug"), q["confidence"].alias("confidence"), T.safe_int(number).cast("long").alias("number"), T.is_pdf(content).alias("is_pdf"))


@query("set05_val05_unknown_blocks", f"WITH ev AS ({v.duck(v.EVIDENCE)}) SELECT canonical_evidence_id, 'unknown source blocks: b9' AS errors FROM ev WHERE ordinal % 4 = 0")
def unknown_source_blocks(spark, sf_dir):
    one = lambda b: F.struct(b.alias("source_block_id"), F.lit("quote").alias("source_quote"), F.lit("primary_finding").alias("observation_role"))
    ev = v.view(spark, sf_dir, v.EVIDENCE).withColumns({"evidence_text": F.lit("t"), "evidence_type": F.lit("other"), "known": F.array(F.lit("b1"), F.lit("b2")), "observations": F.array(one(F.lit("b1")), one(F.when(c("ordinal") % 4 == 0, "b9").otherwise("b2")))})
    return V.evidence(ev, "known").filter(F.size("errors") > 0).select("canonical_evidence_id", F.array_join("errors", "|").alias("errors"))


@query("scl38_quantitative", f"WITH ev AS ({v.duck(v.EVIDENCE)}) SELECT canonical_evidence_id, coalesce(comparator <> '', false) OR coalesce(quantitative_summary <> '', false) OR coalesce(len(quantitative_values) > 0, false) AS has_quant FROM ev")
def quantitative(spark, sf_dir):
    from ..functions.rules import has_quantitative

    return v.view(spark, sf_dir, v.EVIDENCE).select("canonical_evidence_id", has_quantitative(c("comparator"), c("quantitative_summary"), c("quantitative_values")).alias("has_quant"))


@query("val01_val03_scl50_block_input_faults", _BL + " SELECT block_id, concat_ws('|', CASE WHEN text = '' THEN 'text is required' END, CASE WHEN section_type NOT IN ('methods', 'results', 'discussion', 'conclusion', 'abstract') THEN 'section_type is invalid: ' || section_type END, CASE WHEN section_type = 'abstract' THEN 'section_type is excluded' END) AS errors FROM bk")
def block_input_faults(spark, sf_dir):
    found = V.block_input(_blocks(spark, sf_dir), ["methods", "results", "discussion", "conclusion", "abstract"], ["abstract"])
    return found.select("block_id", F.array_join("errors", "|").alias("errors"))


@query("val04_scope_faults", f"WITH sc AS ({v.duck(v.SCOPES)}) SELECT paper_id, ordinal, CASE WHEN ordinal = 0 THEN 'study_1' ELSE study_id END AS study_id, concat_ws('|', CASE WHEN study_design = 'cross_sectional' THEN 'study_design is invalid: odd' END, CASE WHEN ordinal = 2 THEN 'source_block_ids is empty' END) AS errors FROM sc")
def scope_faults(spark, sf_dir):
    sc = v.view(spark, sf_dir, v.SCOPES)
    sc = sc.withColumns({"study_id": F.when(c("ordinal") != 0, c("study_id")).otherwise(" "), "study_design": F.when(c("study_design") == "cross_sectional", "odd").otherwise(c("study_design")), "study_role_in_paper": F.lit(V.STUDY_ROLES[0]), "source_block_ids": F.when(c("ordinal") != 2, F.array(F.lit("b1")))})
    return V.experiment_scopes(sc).select("paper_id", "ordinal", "study_id", F.array_join("errors", "|").alias("errors"))


# Streams


def _event_log(spark, sf_dir, files: int = 4) -> str:
    e = v.view(spark, sf_dir, v.EVENTS).select("event_id", "attempt", "paper_id", "stage", "status", "event_type", "message", F.date_format("event_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("event_at"))
    return _made(spark, "events", lambda p: e.repartition(files, "event_id").write.json(p))


@query("str01_str02_streamed_states", _PS + " SELECT paper_id, arg_max(s, event_at) AS status, count(*) FILTER (false) AS none, max(event_at) AS updated_at FROM se GROUP BY 1")
def streamed_states(spark, sf_dir):
    log, state, checkpoint = _event_log(spark, sf_dir), K.scratch(spark, "states"), K.scratch(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        X.run_state(X.event_stream(spark, log, 2), state, checkpoint, ("paper_id",)).awaitTermination()
    return X.states(spark, state, ("paper_id",)).select("paper_id", "status", F.lit(0).cast("long").alias("none"), "updated_at")


@query("str03_once_delivered", "SELECT event_id, count(*) AS n FROM events GROUP BY 1")
def once_delivered(spark, sf_dir):
    """A log of which each event comes twice in one run, again in a later run, and all again with a new checkpoint: delivered once each."""
    first = _event_log(spark, sf_dir, max(4, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spark.read.text(first).write.mode("append").text(first)
    target, outbox, log, checkpoint = K.scratch(spark, "delivered"), K.scratch(spark, "outbox"), K.scratch(spark, "keys"), K.scratch(spark, "stream")
    sink = lambda df: df.select("event_id").write.mode("append").parquet(target)
    X.run_once(X.event_stream(spark, first), sink, outbox, log, checkpoint).awaitTermination()
    spark.read.text(first).limit(100).write.mode("append").text(first)
    for place in (checkpoint, K.scratch(spark, "stream")):
        X.run_once(X.event_stream(spark, first), sink, outbox, log, place).awaitTermination()
    return spark.read.parquet(target).groupBy(c("event_id").cast("long").alias("event_id")).agg(F.count("*").alias("n"))


@query("str05_incremental", "SELECT 'paper_' || c_custkey AS paper_id, c_custkey % 2 = 0 AS first_run FROM customer")
def incremental(spark, sf_dir):
    done = K.scratch(spark, "done")
    cust = v.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("paper_"), "c_custkey").alias("paper_id"))
    first = X.incremental(spark, cust.filter("c_custkey % 2 = 0"), lambda df: df, done)
    second = X.incremental(spark, cust, lambda df: df, done)
    return first.select("paper_id", F.lit(True).alias("first_run")).unionByName(second.select("paper_id", F.lit(False).alias("first_run")))


# Ports of language models, with deterministic answers


def _selected(row: dict) -> dict:
    kept = [{"id": i, "decision": "keep" if len(t) % 2 else "maybe", "reason": "length"} for i, t in zip(row["ids"], row["titles"]) if len(t) % 3]
    return {"batch": row["batch"], "response": json.dumps({"output": [{"content": [{"text": json.dumps({"decisions": kept})}]}]})}


@query("udf01_paper_selector", "SELECT p_partkey, CASE WHEN length(p_name) % 3 > 0 AND length(p_name) % 2 = 1 THEN 'keep' ELSE 'uncertain' END AS decision FROM part")
def paper_selector(spark, sf_dir):
    parts = D.candidate_batches(v.table(spark, sf_dir, "part").select("p_partkey", "p_name", F.lit("seed").alias("seed"), F.pmod("p_partkey", F.lit(50)).alias("group")), "group", "p_partkey")
    parts = parts.withColumns({"batch": F.concat_ws("-", "group", "batch"), "candidate_id": F.concat_ws("/", "group", "batch", "candidate_id")})
    asked = parts.groupBy("batch").agg(F.collect_list("candidate_id").alias("ids"), F.collect_list("p_name").alias("titles"))
    answers = O.parsed_decisions(R.call_port(asked, _selected, "batch string, response string").filter("error is null"))
    return D.decisions(parts, answers).select("p_partkey", "decision")


@query("udf02_blocks_in_order", "SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS chars, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations")
def blocks_in_order(spark, sf_dir):
    """What a batch gives goes on to the next one of its paper."""
    turns = v.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("size"))
    answer = lambda r, before: {"conv_id": r["conv_id"], "turn": r["turn"], "chars": r["size"] + (before["chars"] if before else 0), "role": r["role"], "previous": before["role"] if before else None}
    return R.call_port_in_order(turns, "conv_id", "turn", answer, "conv_id long, turn long, chars long, role string, previous string").select("conv_id", "turn", "chars", "previous")


@query("udf03_udf04_aux18_classified", _BL + " SELECT paper_id, CASE WHEN count(*) % 2 = 0 THEN 'primary_research' ELSE 'methodological' END AS paper_family, count(*) AS n_blocks FROM bk WHERE section_type NOT IN ('front_matter', 'references', 'acknowledgements', 'funding', 'disclosure', 'ethics', 'appendix', 'supplementary') GROUP BY 1")
def classified(spark, sf_dir):
    blocks = B.classifier_input(_blocks(spark, sf_dir)).groupBy("paper_id").agg(F.sort_array(F.collect_list("block_id")).alias("blocks"))
    message = blocks.select("paper_id", O.input_message("classify", blocks=c("blocks")).alias("message"))

    def answer(row: dict) -> dict:
        n = len(json.loads(row["message"].split("# INPUT\n\n", 1)[1])["blocks"])
        return {"paper_id": row["paper_id"], "paper_family": "methodological" if n % 2 else "primary_research", "n_blocks": n}

    return R.call_port(message, answer, "paper_id string, paper_family string, n_blocks long").filter("error is null").drop("error")


_SCOPED = "(SELECT paper_id, list(block_id ORDER BY ord) AS own FROM bk WHERE section_type IN ('methods', 'results') GROUP BY 1)"


@query("udf05_udf07_extracted", _BL + f" SELECT paper_id, 'scope_1' AS experiment_scope_id, 'scope_1' AS study_id, i AS item_index, own[i + 1] AS block_id FROM (SELECT paper_id, own, unnest(range(len(own))) AS i FROM {_SCOPED})")
def extracted(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    own = b.filter(c("section_type").isin("methods", "results")).groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "block_id"))), lambda x: x["block_id"]).alias("source_block_ids"))
    packets = B.packets(own.withColumn("experiment_scope_id", F.lit("scope_1")), b)
    asked = packets.select("paper_id", "experiment_scope_id", F.transform("blocks", lambda x: x["block_id"]).alias("ids"))
    answers = R.call_port(asked, lambda r: {"paper_id": r["paper_id"], "packet_scope_id": r["experiment_scope_id"], "items": [str(x) for x in r["ids"]]}, "paper_id string, packet_scope_id string, items array<string>")
    items = answers.filter("error is null").select("paper_id", "packet_scope_id", F.lit("").alias("packet_study_id"), F.lit("m").alias("experiment_map_id"), F.posexplode("items").alias("item_index", "block_id"))
    found = O.attach_context(items.withColumn("index", c("item_index").cast("long")), ["block_id"])
    return found.filter("canonical_evidence_id is not null").select("paper_id", "experiment_scope_id", "study_id", c("index").alias("item_index"), "block_id")


@query("udf06_rewritten_conclusions", _EV + " SELECT general_evidence_id, CASE WHEN study_count % 2 = 0 THEN 'rewritten ' || study_count ELSE 'template' END AS conclusion_claim, CASE WHEN study_count % 2 = 0 THEN 'llm' ELSE 'template' END AS conclusion_generation_method FROM ge")
def rewritten(spark, sf_dir):
    general = _general(spark, sf_dir)[1].withColumns({"conclusion_claim": F.lit("template"), **{n: F.lit("") for n in ("plain_language_conclusion", "evidence_balance_summary", "recommendation_interpretation", "conclusion_status")}})
    answers = R.call_port(general.filter("study_count % 2 = 0").select("general_evidence_id", "study_count"), lambda r: {"general_evidence_id": r["general_evidence_id"], "answer": json.dumps({"conclusion_claim": f"rewritten {r['study_count']}", "conclusion_status": "active"})}, "general_evidence_id string, answer string")
    return O.apply_conclusions(general, answers.filter("error is null")).select("general_evidence_id", "conclusion_claim", "conclusion_generation_method")


# Records of runs and batches


@query("aux07_lookup", _LK + " SELECT metadata_id, doi FROM lk WHERE metadata_id = 'meta:s2:8'")
def lookup(spark, sf_dir):
    return O.lookup(_lake(spark, sf_dir), "meta:s2:8").select("metadata_id", "doi")


@query("aux16_failures", "SELECT CAST(conv_id AS VARCHAR) AS paper_id, turn AS batch_index, 'ValueError' AS error_type, 'turn ' || turn AS error, 'ValueError: turn ' || turn AS error_description FROM conversations WHERE turn % 2 = 1")
def batch_failures(spark, sf_dir):
    def answer(row: dict) -> dict:
        if row["index"] % 2:
            raise ValueError(f"turn {row['index']}")
        return row

    turns = v.table(spark, sf_dir, "conversations").select(c("conv_id").cast("string").alias("paper_id"), c("turn").cast("long").alias("index"), F.lit(0).alias("start_char"), F.length("text").alias("end_char"))
    failed = O.failures(R.call_port(turns, answer, "paper_id string, index long, start_char int, end_char int"))
    told = O.failed_status(failed).select(c("paper_id").alias("p"), "error_description")
    each = failed.withColumn("error_description", F.concat_ws(": ", "error_type", "error"))
    return each.join(told, (c("p") == c("paper_id")) & (told["error_description"] == each["error_description"]), "left_semi").select("paper_id", "batch_index", "error_type", "error", "error_description").distinct()


@query("aux22_run_manifests", "SELECT 'run_' || n_nationkey AS run_id, '{\"n\":' || n_nationkey || ',\"name\":\"' || n_name || '\",\"run_id\":\"run_' || n_nationkey || '\"}' AS manifest FROM nation")
def run_manifests(spark, sf_dir):
    return O.manifest(v.table(spark, sf_dir, "nation").select(F.concat(F.lit("run_"), "n_nationkey").alias("run_id"), c("n_name").alias("name"), c("n_nationkey").alias("n")))


_REPR = "'''' || replace(replace({0}, '\\', '\\\\'), '''', '\\''') || ''''"
_KEY = " || ', ' || ".join(f"coalesce({_REPR.format(k)}, 'None')" for k in E.GROUP)


@query("srt03_general_order", _EV + f" SELECT general_evidence_id, row_number() OVER (ORDER BY '(' || {_KEY} || ')') AS place FROM ge")
def general_order(spark, sf_dir):
    """Places in the order of the text of the key tuple."""
    general = _general(spark, sf_dir)[1].select("general_evidence_id", tuple_text(E.GROUP).alias("key"))
    return numbered(general, [c("key"), c("general_evidence_id")]).select("general_evidence_id", "place")


# Keywords, lookups, services at size


@query("jon18_src06_keyword_table", _LK + """, bw AS (SELECT item_id, regexp_extract_all(lower(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '[a-z0-9]+') AS w FROM benchmark),
bi AS (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM bw), ky AS (SELECT DISTINCT k FROM (SELECT w[i] AS k FROM bi UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM bi WHERE i < len(w)))
SELECT metadata_id, coalesce(string_agg(k, ',' ORDER BY k), '') AS matched FROM kw LEFT JOIN ky ON CASE WHEN contains(k, ' ') THEN contains(kt, k) ELSE contains(' ' || kt, ' ' || k) END GROUP BY 1""")
def keyword_table(spark, sf_dir):
    """Each word and pair of words of the benchmark as a keyword."""
    items = K.kept(v.table(spark, sf_dir, "benchmark").select(F.split(T.keyword_text(c("text")), " ").alias("words")), "items")
    words = c("words")
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, i: F.concat(x, F.lit(" "), F.get(words, i + 1)))
    keywords = items.select(F.explode(F.concat(words, pairs)).alias("keyword")).withColumn("place", c("keyword"))
    lake = _lake(spark, sf_dir).select("metadata_id", T.keyword_text(c("title")).alias("normalised"))
    return D.match_keywords(lake, keywords).select("metadata_id", F.array_join("matched_keywords", ",").alias("matched"))


@query("src11_aux09_clustered_lookup", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = (SELECT max(o_custkey) FROM orders)")
def clustered_lookup(spark, sf_dir):
    orders = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    path = _made(spark, "clustered", lambda p: K.write_clustered(orders, p, "o_custkey", 16))
    last = orders.agg(F.max("o_custkey")).first()[0]
    return R.lookup_clustered(spark, path, "o_custkey", last)


@query("src15_paged_data_source", "SELECT i AS item, 1990 + i % 36 AS year, i % 97 AS citations FROM (SELECT unnest(range((SELECT count(*) FROM orders))) AS i) WHERE 1990 + i % 36 >= 2005 AND i % 97 > 3")
def paged_data_source(spark, sf_dir):
    """A service with one item per order; it applies the limit of the year, Spark that of the citations."""
    n = v.table(spark, sf_dir, "orders").count()

    def places(conditions: list) -> list[int]:
        """Places in each 36 items whose year is late enough: the service finds a page without reading what is before it."""
        least = max([x for _, op, x in conditions if op == ">="], default=0)
        return [k for k in range(36) if 1990 + k >= least]

    def count(conditions: list) -> int:
        return sum((n - k + 35) // 36 for k in places(conditions))

    def fetch(conditions: list, offset: int, size: int) -> list[tuple]:
        every = places(conditions)
        found = [k // len(every) * 36 + every[k % len(every)] for k in range(offset, min(offset + size, count(conditions)))]
        return [(i, 1990 + i % 36, i % 97) for i in found]

    register_paged(spark, "papers_service", Service(fetch, count, ("year",), size=500, pages_per_task=4), "item long, year long, citations long")
    return spark.read.format("papers_service").load().filter("year >= 2005 and citations > 3")
