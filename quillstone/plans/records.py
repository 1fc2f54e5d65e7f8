"""Queries of the record operators; they join those of ``registry``."""

from __future__ import annotations

from pyspark.sql import functions as F


from ..functions import text as T
from ..operators import records as O
from ..sources import readers as R
from ..sources import sinks as K
from . import views as v
from .registry import _EV, _LK, _grouped, _lake, query

c = F.col
NOW = "2024-01-01T00:00:00Z"


@query("aux26_src04_metadata_entries", _LK + " SELECT source_paper_id AS document_id, doi, replace(doi, '/', '-') AS doi_slug, 'doi-' || replace(doi, '/', '-') AS base_name, source_paper_id || '__doi-' || replace(doi, '/', '-') AS legacy_base_name FROM lk WHERE doi IS NOT NULL")
def metadata_entries(spark, sf_dir):
    wrapped = _lake(spark, sf_dir).select(F.struct(c("source_paper_id").alias("document_id"), c("raw_doi").alias("doi")).alias("metadata"))
    return O.entries(R.unwrap_record(wrapped))


@query("aux04_aux06_identifiers", _LK + " SELECT metadata_id, CASE WHEN doi IS NOT NULL THEN 'doi-' || replace(doi, '/', '-') ELSE source_paper_id END AS stem, source_paper_id || CASE WHEN doi IS NOT NULL THEN '|doi-' || replace(doi, '/', '-') ELSE '' END AS identifiers FROM lk")
def identifiers(spark, sf_dir):
    doi, own = c("raw_doi"), c("source_paper_id")
    return _lake(spark, sf_dir).select("metadata_id", O.file_stem(doi, own).alias("stem"), F.array_join(O.identifiers(doi, own), "|").alias("identifiers"))


@query("scl03_jon19_src21_identity_recovery", _LK + " SELECT metadata_id, CASE WHEN doc_id % 2 = 0 THEN doi WHEN doc_id % 3 = 0 THEN NULL ELSE doi END AS doi FROM lk WHERE doi IS NOT NULL")
def identity_recovery(spark, sf_dir):
    lake = _lake(spark, sf_dir).filter("doi is not null")
    unknown = F.concat(F.lit("missing"), "doc_id")
    name = F.when(c("doc_id") % 2 == 0, T.base_name(c("doi"))).when(c("doc_id") % 3 == 0, F.concat(unknown, F.lit("__doi-none"))).otherwise(F.concat("source_paper_id", F.lit("__doi-none")))
    files = lake.select("metadata_id", name.alias("stem"))
    return R.resolve_identity(files, lake.select(c("source_paper_id").alias("document_id"), "doi"), lake).select("metadata_id", "doi")


@query("aux05_seed_completion", _LK + " SELECT 'queue' AS part, doi FROM lk WHERE doi IS NOT NULL AND doc_id % 5 <> 0 AND doc_id % 7 <> 0 UNION ALL SELECT 'completed', doi FROM (SELECT DISTINCT doi FROM lk WHERE doi IS NOT NULL AND (doc_id % 5 = 0 OR doc_id % 7 = 0))")
def seed_completion(spark, sf_dir):
    lake = _lake(spark, sf_dir).filter("doi is not null")
    completed, queue = O.complete(lake.select("doi"), lake.filter("doc_id % 5 = 0").select("doi"), lake.filter("doc_id % 7 = 0").select(c("raw_doi").alias("doi")))
    return queue.select(F.lit("queue").alias("part"), "doi").unionByName(completed.select(F.lit("completed").alias("part"), "doi"))


@query("aux03_screened_candidates", _LK + ", s AS (SELECT metadata_id, CASE WHEN doc_id % 4 = 0 THEN 'keep' WHEN doc_id % 4 = 1 THEN 'uncertain' ELSE 'drop' END AS decision FROM lk) SELECT metadata_id, decision FROM s UNION ALL SELECT 'parent', 'keep'")
def screened(spark, sf_dir):
    said = F.when(c("doc_id") % 4 == 0, "keep").when(c("doc_id") % 4 == 1, "uncertain").when(c("doc_id") % 4 == 2, "odd")
    candidates = _lake(spark, sf_dir).select("metadata_id", said.alias("decision"), c("doc_id").alias("ordinal"))
    return O.screened(candidates.select(F.lit("parent").alias("metadata_id"), "ordinal"), candidates)


_REFRESH = _LK + f""", r AS (SELECT *, CASE WHEN doi IS NULL THEN 'missing_doi' WHEN doc_id % 5 = 0 THEN 'failed' WHEN doc_id % 7 = 0 THEN 'not_found' ELSE 'refreshed' END AS outcome FROM lk),
rf AS (SELECT CASE outcome WHEN 'refreshed' THEN 'meta:s2:n' || doc_id ELSE metadata_id END AS metadata_id, doi, CASE outcome WHEN 'refreshed' THEN 'title ' || doc_id ELSE trim(title) END AS title, coalesce(decision, 'uncertain') AS decision,
  CASE WHEN doc_id % 2 = 0 THEN 'then' ELSE '{NOW}' END AS created_at, '{NOW}' AS updated_at, outcome FROM r)"""


def _refreshed(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    fetched = lake.filter("doi is not null").select("doi", F.when(c("doc_id") % 7 != 0, F.concat(F.lit("n"), "doc_id")).alias("source_paper_id"), F.concat(F.lit("title "), "doc_id").alias("title"), F.when(c("doc_id") % 5 == 0, "timeout").alias("error"))
    records = lake.select("metadata_id", "title", "decision", c("raw_doi").alias("doi"), F.when(c("doc_id") % 2 == 0, "then").alias("created_at"))
    return O.refreshed(records, fetched, NOW)


@query("aux08_refreshed_metadata", _REFRESH + " SELECT * FROM rf")
def refreshed(spark, sf_dir):
    return _refreshed(spark, sf_dir)


@query("agg19_refresh_summary", _REFRESH + " SELECT count(*) AS n_read, count(*) FILTER (outcome = 'refreshed') AS refreshed, count(*) FILTER (outcome = 'missing_doi') AS missing_doi, count(*) FILTER (outcome = 'not_found') AS not_found, count(*) FILTER (outcome = 'failed') AS failed FROM rf")
def refresh_summary(spark, sf_dir):
    return O.refresh_summary(_refreshed(spark, sf_dir))


@query("aux25_snk22_srt08_registry", "SELECT '10.1/' || p_size AS doi, 'd' || max(p_partkey) AS document_id, max(p_partkey) AS ordinal FROM part GROUP BY p_size")
def registry(spark, sf_dir):
    rows = v.table(spark, sf_dir, "part").select(F.concat(F.lit("doi:10.1/"), "p_size").alias("doi"), F.concat(F.lit("d"), "p_partkey").alias("document_id"), c("p_partkey").alias("ordinal"))
    return O.registry(rows).withColumn("doi", T.normalize_doi(c("doi")))


@query("aux27_stage_status", "SELECT 'b' || p_partkey AS base_name, p_partkey % 2 = 0 AS metadata, p_partkey % 3 = 0 AND p_partkey % 4 <> 0 AS pdf, p_partkey % 3 = 0 AND p_partkey % 4 <> 0 AS docling, p_partkey % 5 < 2 AND p_partkey % 4 <> 0 AS heuristics, p_partkey % 4 = 0 AS evidence, false AS completed FROM part")
def stage_status(spark, sf_dir):
    p = v.table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("b"), "p_partkey").alias("base_name"), (c("p_partkey") % 4 == 0).alias("has_mirror"))
    no = F.lit(False)
    there = [("metadata", c("p_partkey") % 2 == 0, no), ("pdf", c("p_partkey") % 3 == 0, no), ("docling", c("p_partkey") % 3 == 0, no), ("filtered", c("p_partkey") % 5 < 2, no), ("final", c("p_partkey") % 5 < 3, no), ("evidence", F.lit(True), F.lit(True))]
    files = p.select("base_name", F.inline(F.array_compact(F.array(*[F.when(has, F.struct(F.lit(kind).alias("kind"), mirrored.alias("mirrored"))) for kind, has, mirrored in there]))))
    return O.stage_status(p.select("base_name", "has_mirror"), files)


@query("aux28_flt12_test_workspace", "SELECT 's' || s_suppkey AS paper_id, CASE WHEN s_suppkey % 3 = 0 THEN 'missing_pdf' WHEN s_suppkey % 2 = 0 THEN 'missing_markdown' END AS reason FROM supplier")
def workspace(spark, sf_dir):
    s = v.table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("s"), "s_suppkey").alias("paper_id"))
    return O.workspace(s.select("paper_id"), s.filter("s_suppkey % 3 <> 0"), s.filter("s_suppkey % 2 <> 0"))


@query("jon16_srt02_conclusion_payload", _EV + " SELECT general_evidence_id, position, projection_id, evidence_rank, effect_direction FROM rp WHERE evidence_rank IN ('A', 'B', 'C')")
def conclusion_payload(spark, sf_dir):
    return O.conclusion_payload(_grouped(spark, sf_dir)).withColumn("position", c("position").cast("long"))


@query("aux21_val07_finished_runs", "SELECT 'run_' || o_custkey AS run_id, arg_max(CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'succeeded' ELSE 'running' END, o_orderkey) AS status, max(o_orderkey) AS at FROM orders GROUP BY 1")
def finished_runs(spark, sf_dir):
    status = F.when(c("o_orderstatus") == "F", "failed").when(c("o_orderstatus") == "O", "succeeded").otherwise("running")
    log = v.table(spark, sf_dir, "orders").select(F.concat(F.lit("run_"), "o_custkey").alias("run_id"), status.alias("status"), c("o_orderkey").alias("at"))
    return O.finish(log.filter("status = 'running'"), log.filter("status <> 'running'"))


@query("aux19_aux20_response_decisions", "SELECT c_custkey AS batch, 'cand_' || lpad(CAST(i AS VARCHAR), 3, '0') AS candidate_id, CASE WHEN c_custkey % 2 = 0 THEN 'keep' ELSE 'drop' END AS decision, c_mktsegment AS reason FROM customer, (SELECT 1 AS i UNION ALL SELECT 2) WHERE c_custkey % 5 <> 0")
def response_decisions(spark, sf_dir):
    said = F.when(c("c_custkey") % 2 == 0, "keep").otherwise("drop")
    inner = F.to_json(F.struct(F.array(*[F.struct(F.lit(f"cand_00{i}").alias("id"), said.alias("decision"), c("c_mktsegment").alias("reason")) for i in (1, 2)]).alias("decisions")))
    item = lambda t: F.struct(F.array(F.struct(t.alias("text"))).alias("content"))
    response = F.to_json(F.struct(F.array(item(F.lit(" ")), item(F.when(c("c_custkey") % 5 != 0, inner))).alias("output")))
    return O.parsed_decisions(v.table(spark, sf_dir, "customer").select(c("c_custkey").alias("batch"), response.alias("response")))


@query("nst05_scl24_author_names", "SELECT conv_id, array_to_string(list_filter(list_transform(list(trim(CASE WHEN turn % 3 = 1 THEN '  ' ELSE ' ' || role || ' ' END) ORDER BY turn), lambda x: nullif(x, '')), lambda x: x IS NOT NULL), '|') AS names FROM conversations GROUP BY 1")
def author_names(spark, sf_dir):
    name = F.when(c("turn") % 3 == 1, "  ").otherwise(F.concat(F.lit(" "), "role", F.lit(" ")))
    papers = v.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", name.alias("name")))).alias("authors"))
    return papers.select("conv_id", F.array_join(O.author_names(c("authors"), papers.schema["authors"].dataType), "|").alias("names"))


@query("scl46_snk13_json_export", "SELECT n_nationkey, '{\"k\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' AS payload FROM nation")
def json_export(spark, sf_dir):
    n = v.table(spark, sf_dir, "nation").select("n_nationkey", F.struct(c("n_nationkey").alias("k"), c("n_name").alias("name")).alias("payload"))
    return K.flat(n)


@query("scl49_aux30_iso_times", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS seconds, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS micros FROM events")
def iso_times(spark, sf_dir):
    e = v.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return e.select("event_id", "user_id", T.iso_time(c("ts")).alias("seconds"), T.iso_time(c("ts"), micros=True).alias("micros"))


@query("jon15_srt04_srt07_selected_evidence", "SELECT DISTINCT 'paper_' || o_custkey AS paper_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3) ORDER BY 1 LIMIT 100")
def selected_evidence(spark, sf_dir):
    wanted = v.table(spark, sf_dir, "customer").filter("c_nationkey = 3").select(c("c_custkey").alias("o_custkey"))
    rows = v.table(spark, sf_dir, "orders").join(wanted, "o_custkey", "left_semi").select(F.concat(F.lit("paper_"), "o_custkey").alias("paper_id"))
    return R.ordered_ids(rows, "paper_id", 100)


@query("aux12_wrapped_records", "SELECT 'nation' AS record_type, CAST(n_nationkey AS VARCHAR) AS record_id, 'unknown' AS producer_run_id, 'v1' AS schema_version, '{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}' AS payload FROM nation")
def wrapped_records(spark, sf_dir):
    return O.wrapped(v.table(spark, sf_dir, "nation"), "nation", "n_nationkey")
