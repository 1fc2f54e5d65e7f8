"""The driver's tables seen as the engine's entities: one text for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUILD = "build_1"

#: {list} is the engine's function that makes a list of its arguments.
EVIDENCE = """
SELECT 'ce_' || o_orderkey AS canonical_evidence_id, 'paper_' || o_custkey AS paper_id, 'study_' || (o_orderkey % 2) AS study_id,
  lower(c_mktsegment) || CASE o_orderkey % 3 WHEN 0 THEN ' intake' WHEN 1 THEN ' Consumption' ELSE '' END AS raw_exposure,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN {list}('bmi  Intake', o_orderpriority, 'BMI') WHEN o_orderkey % 5 = 0 THEN {list}(o_orderpriority, 'BMI') ELSE {list}(o_orderpriority) END AS raw_outcomes,
  CASE WHEN o_orderkey % 23 = 0 THEN 'unclear'
       WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN CASE WHEN o_orderkey % 50 = 0 THEN 'decrease' ELSE 'increase' END
       WHEN c_mktsegment = 'FURNITURE' THEN CASE WHEN o_orderkey % 4 = 0 THEN 'no_effect' ELSE 'decrease' END
       WHEN o_orderstatus = 'F' THEN 'increase' WHEN o_orderstatus = 'O' THEN 'decrease' ELSE 'no_effect' END AS effect_direction,
  CASE c_nationkey % 5 WHEN 0 THEN 'animal' WHEN 1 THEN NULL ELSE 'human' END AS organism,
  CASE WHEN o_orderkey % 11 = 0 THEN 'method_detail' WHEN o_orderkey % 7 = 0 THEN 'secondary_result' ELSE 'primary_result' END AS evidence_role_in_paper,
  CASE o_orderkey % 4 WHEN 0 THEN 'association' WHEN 1 THEN 'causal_effect' ELSE 'comparative_effect' END AS assertion_type,
  CASE WHEN o_totalprice > 150000 THEN 'control' WHEN o_orderkey % 2 = 0 THEN '' END AS comparator, CASE WHEN o_totalprice > 100000 THEN 'n = 3' END AS quantitative_summary,
  CASE WHEN o_totalprice > 50000 THEN {list}(o_totalprice) END AS quantitative_values, o_orderkey % 31 <> 0 AS has_grounding,
  CASE WHEN o_orderkey % 10 = 3 THEN 'clinic \u00e9' WHEN o_orderkey % 50 = 4 THEN 'ward \U0001f600 \"b\"' END AS setting, CASE WHEN o_orderkey % 6 = 1 THEN 'dose ' || (o_orderkey % 2) END AS amount,
  CASE WHEN o_orderkey % 37 = 0 THEN 'rejected' ELSE 'accepted' END AS canonical_evidence_status,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'cohort_' || (o_orderkey % 997) ELSE n_name END AS population_scope,
  o_orderkey AS ordinal
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
SCOPES = """
SELECT 'paper_' || c_custkey AS paper_id, 'study_' || s AS study_id, CAST(NULL AS {text}) AS experiment_scope_id, o AS ordinal,
  CASE (c_nationkey + o) % 4 WHEN 0 THEN 'rct' WHEN 1 THEN 'prospective_cohort' WHEN 2 THEN 'cross_sectional' ELSE 'animal_experiment' END AS study_design
FROM customer CROSS JOIN (SELECT 0 AS s, 0 AS o UNION ALL SELECT 1, 1 UNION ALL SELECT 1, 2) x WHERE c_custkey % 19 <> 0
"""
BLOCKS = """
SELECT CAST(doc_id AS {text}) AS paper_id, pos AS ord, line AS text,
  CASE (doc_id + pos - pos % 3) % 8 WHEN 0 THEN 'Methods' WHEN 1 THEN 'results' WHEN 2 THEN 'abstract' WHEN 3 THEN 'material-and-methods' WHEN 4 THEN 'front matter' WHEN 5 THEN 'odd' WHEN 6 THEN 'discussion' ELSE NULL END AS section_type,
  CASE (doc_id + pos - pos % 3) % 8 WHEN 0 THEN '3.1 Methods' WHEN 1 THEN '4. Results' WHEN 2 THEN 'Abstract' WHEN 3 THEN '2 Materials' WHEN 4 THEN 'Ethics statement' WHEN 5 THEN 'Abbreviations' WHEN 6 THEN '5.2.1 Discussion' ELSE 'Other' END AS section_title,
  CASE WHEN pos % 4 = 0 THEN ' ' ELSE 'paragraph' END AS content_kind
FROM lines WHERE trim(line) <> ''
"""
EVENTS = """
SELECT event_id, 'attempt_' || (user_id % 40) || '_' || CAST(user_id AS {text}) AS attempt, 'paper_' || user_id AS paper_id,
  CASE WHEN value < 5 THEN 'pdf.process' WHEN value < 20 THEN 'classification.classify' ELSE 'evidence.extract' END AS stage,
  CASE event_type WHEN 'view' THEN 'started' WHEN 'click' THEN 'running' WHEN 'error' THEN 'failed' ELSE 'succeeded' END AS status,
  event_type, 'value ' || CAST(CAST(floor(value) AS INT) AS {text}) AS message, ts AS event_at,
  CASE WHEN event_type = 'purchase' THEN 'out/' || event_id END AS artifact_path, user_id
FROM events
"""
_PAPER = """
SELECT 'meta:s2:' || d.doc_id AS metadata_id, CAST(d.doc_id AS {text}) AS source_paper_id,
  CASE d.doc_id % 4 WHEN 0 THEN 'https://doi.org/10.1000/Doc' || d.doc_id WHEN 1 THEN 'doi: 10.1000/Doc' || d.doc_id WHEN 2 THEN 'http://dx.doi.org/10.1000/Doc' || d.doc_id ELSE CASE WHEN d.doc_id % 8 = 3 THEN '  ' ELSE '10.1000/Doc' || d.doc_id END END AS raw_doi,
  text AS title, n_chars AS citation_count, 1990 + d.doc_id % 36 AS year,
"""
LAKE = _PAPER + """
  CASE quality WHEN 1 THEN 'keep' WHEN 0 THEN 'drop' END AS decision, d.doc_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
#: The lake before any decision.
PAPERS = _PAPER + "d.doc_id FROM documents d"
LINKS = """
SELECT CASE WHEN doc_id % 3 = 0 THEN 'meta:s2:' || doc_id ELSE 'other:' || doc_id END AS metadata_id,
  CASE WHEN doc_id % 5 = 0 THEN '10.1000/doc' || doc_id END AS doi, doc_id
FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0
"""
SPARK = {"list": "array", "text": "string"}
DUCK = {"list": "list_value", "text": "VARCHAR"}
TABLES = {EVIDENCE: ("orders", "customer", "nation"), SCOPES: ("customer",), EVENTS: ("events",), LAKE: ("documents", "labels"), PAPERS: ("documents",), LINKS: ("documents",)}
LINES_SPARK = "(SELECT doc_id, posexplode(split(text, '\n')) AS (pos, line) FROM {documents})"
LINES_DUCK = "(SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    if text is BLOCKS:
        return spark.sql(text.format(**SPARK).replace("FROM lines", f"FROM {LINES_SPARK}"), documents=table(spark, sf_dir, "documents"))
    sql = text.format(**SPARK)
    for name in TABLES[text]:
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in TABLES[text]})


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evidence view with its context as a map, its keys out of order."""
    named = F.map_filter(F.create_map(F.lit("setting"), "setting", F.lit("amount"), "amount"), lambda k, x: x.isNotNull())
    return view(spark, sf_dir, EVIDENCE).withColumn("context_identity", named).drop("setting", "amount")


def duck(text: str) -> str:
    return text.format(**DUCK).replace("FROM lines", f"FROM {LINES_DUCK}").strip()
