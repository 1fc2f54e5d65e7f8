"""Queries of the analytics operators over the driver's tables, and their SQL for DuckDB.

A key begins with the ids of the operators it applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, rules
from ..functions import text as T
from ..operators import blocks as B
from ..operators import evidence as E
from ..operators import markdown as M
from ..operators import metadata as D
from ..operators import state as S
from ..operators import validation as V
from ..sources import readers as R
from ..sources.sinks import kept
from . import views as v

c = F.col
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "agg01_general_evidence"
KEYWORDS = ["the", "of the", "une", "der", "zzz"]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


# Evidence

_NAME = "replace(regexp_replace(regexp_replace(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_'), '_consumption$', ''), '_intake$', ''), 'whole_egg', 'egg')"
_ASCII = "array_to_string(list_transform(string_split(setting, ''), lambda x: CASE WHEN x = '\"' THEN '\\\"' WHEN ord(x) < 127 THEN x WHEN ord(x) < 65536 THEN '\\u' || printf('%04x', ord(x)) ELSE '\\u' || printf('%04x', 55296 + (ord(x) - 65536) // 1024) || '\\u' || printf('%04x', 56320 + (ord(x) - 65536) % 1024) END), '')"
_EV = f"""
WITH ev AS ({v.duck(v.EVIDENCE)}), sc AS ({v.duck(v.SCOPES)}),
o0 AS (SELECT ordinal, unnest(range(len(raw_outcomes))) AS pos, unnest(raw_outcomes) AS term FROM ev WHERE raw_outcomes IS NOT NULL),
outs AS (SELECT ordinal, pos, term FROM (SELECT *, row_number() OVER (PARTITION BY ordinal, {_NAME.format('term')} ORDER BY pos) AS rn FROM o0) WHERE rn = 1),
exr AS (SELECT {_NAME.format('raw_exposure')} AS n, arg_min(raw_exposure, ordinal) AS term FROM ev GROUP BY 1),
our AS (SELECT {_NAME.format('term')} AS n, arg_min(term, ordinal * 100 + pos) AS term FROM o0 GROUP BY 1),
ls AS (SELECT paper_id, study_id, arg_max(study_design, ordinal) AS d FROM sc GROUP BY 1, 2),
fan AS (SELECT ev.*, o.term AS raw_outcome FROM ev LEFT JOIN outs o ON ev.ordinal = o.ordinal),
pj AS (SELECT canonical_evidence_id, f.paper_id, f.study_id, 'exposure.' || e.n AS exposure_id, 'outcome.' || o.n AS outcome_id,
    coalesce(organism, CASE d WHEN 'animal_experiment' THEN 'animal' WHEN 'in_vitro' THEN 'in_vitro' ELSE 'unclear' END) AS organism,
    population_scope, effect_direction, coalesce(d, 'unclear') AS study_design, evidence_role_in_paper, assertion_type, coalesce(comparator <> '', false) OR coalesce(quantitative_summary <> '', false) OR coalesce(len(quantitative_values) > 0, false) AS has_quant, has_grounding, canonical_evidence_status,
    '{{' || concat_ws(',', '"amount":"' || amount || '"', '"setting":"' || {_ASCII} || '"') || '}}' AS context_json
  FROM fan f LEFT JOIN exr e ON e.n = {_NAME.format('raw_exposure')} LEFT JOIN our o ON o.n = {_NAME.format('raw_outcome')}
  LEFT JOIN ls ON ls.paper_id = f.paper_id AND ls.study_id = f.study_id),
pf AS (SELECT *, concat_ws('; ', CASE WHEN NOT has_grounding THEN 'missing source grounding' END,
    CASE WHEN exposure_id IS NULL OR outcome_id IS NULL THEN 'unresolved exposure or outcome' END,
    CASE WHEN effect_direction IN ('unclear', 'not_applicable') THEN 'unclear effect direction' END,
    CASE WHEN canonical_evidence_status = 'rejected' THEN 'canonical evidence rejected' END) AS faults FROM pj),
pk AS (SELECT *, CASE WHEN faults <> '' THEN 0 WHEN evidence_role_in_paper IN ('method_detail', 'background_context', 'limitation') OR assertion_type = 'methodological' THEN 1
    WHEN organism IN ('animal', 'in_vitro') OR evidence_role_in_paper IN ('mechanistic_result', 'descriptive_result') OR assertion_type = 'mechanistic_link' THEN 2
    WHEN evidence_role_in_paper IN ('secondary_result', 'subgroup_result', 'sensitivity_result') THEN 3
    WHEN organism = 'human' AND evidence_role_in_paper = 'primary_result' AND study_design IN ('rct', 'meta_analysis', 'systematic_review', 'prospective_cohort') AND has_quant THEN 4
    WHEN organism = 'human' THEN 5 ELSE 6 END AS k FROM pf),
pr AS (SELECT 'projection_' || sha256(CAST(to_json(list_value('{v.BUILD}', canonical_evidence_id, exposure_id, outcome_id)) AS VARCHAR)) AS projection_id,
    '{v.BUILD}' AS build_id, canonical_evidence_id, paper_id, study_id, exposure_id, outcome_id, organism, population_scope, context_json, effect_direction, study_design, evidence_role_in_paper, assertion_type,
    ['Reject', 'D', 'C', 'B', 'A', 'B', 'C'][k + 1] AS evidence_rank, CAST([0, 0, 0.25, 0.6, 1, 0.6, 0.25][k + 1] AS DOUBLE) AS aggregation_weight,
    ['reject', 'audit_only', 'mechanistic_only', 'supporting', 'primary', 'supporting', 'supporting'][k + 1] AS rag_use,
    k = 4 AND assertion_type IN ('causal_effect', 'comparative_effect') AS causal_language_allowed,
    k <> 4 OR evidence_role_in_paper = 'subgroup_result' OR assertion_type IN ('association', 'no_association', 'mechanistic_link') AS requires_caveat,
    CASE WHEN k = 0 THEN faults ELSE ['', 'method/background/limitation evidence', 'mechanistic, descriptive, animal, or in vitro evidence', 'human secondary/subgroup/sensitivity result', 'strong human primary evidence', 'human evidence with caveat', 'indirect or unclear-context evidence'][k + 1] END AS rank_reason,
    CASE k WHEN 0 THEN 'rejected' WHEN 6 THEN 'needs_review' ELSE 'accepted' END AS projection_status FROM pk),
ok AS (SELECT * FROM pr WHERE projection_status <> 'rejected'),
un AS (SELECT paper_id, study_id, exposure_id, outcome_id, organism, population_scope, context_json,
    count(*) FILTER (evidence_rank IN ('A', 'B')) AS ab_rows,
    CASE WHEN count(*) FILTER (evidence_rank IN ('A', 'B')) > 0
      THEN CASE WHEN count(DISTINCT effect_direction) FILTER (evidence_rank IN ('A', 'B')) = 1 THEN max(effect_direction) FILTER (evidence_rank IN ('A', 'B')) ELSE 'mixed' END
      ELSE CASE WHEN count(DISTINCT effect_direction) = 1 THEN max(effect_direction) ELSE 'mixed' END END AS direction,
    least(1.0, CASE WHEN count(*) FILTER (evidence_rank IN ('A', 'B')) > 0 THEN max(aggregation_weight) FILTER (evidence_rank IN ('A', 'B')) ELSE max(aggregation_weight) END) AS weight
  FROM ok GROUP BY ALL),
gv AS (SELECT exposure_id, outcome_id, organism, population_scope, context_json, count(*) AS study_count,
    {', '.join(f"count(*) FILTER (direction = '{d}') AS votes_{d}, coalesce(sum(weight) FILTER (direction = '{d}'), 0) AS support_{d}" for d in rules.DIRECTIONS)} FROM un GROUP BY ALL),
gr AS (SELECT exposure_id, outcome_id, organism, population_scope, context_json, count(*) AS evidence_count, count(DISTINCT paper_id) AS paper_count, count(*) FILTER (evidence_rank IN ('A', 'B')) AS ab_rows,
    {', '.join(f"count(*) FILTER (effect_direction = '{d}') AS rows_{d}" for d in rules.DIRECTIONS)}, {', '.join(f"count(*) FILTER (evidence_rank = '{r}') AS rank_{r}" for r in rules.RANKS)},
    bool_or(projection_status = 'needs_review') AS any_review, bool_and(rag_use = 'mechanistic_only') AS all_mech, bool_or(requires_caveat) AS any_caveat, bool_and(causal_language_allowed) AS all_causal,
    bool_or(assertion_type IN ('association', 'no_association')) AS any_assoc FROM ok GROUP BY ALL),
g0 AS (SELECT gr.*, gv.* EXCLUDE (exposure_id, outcome_id, organism, population_scope, context_json), greatest({', '.join(f'votes_{d}' for d in rules.DIRECTIONS)}) AS top
  FROM gr JOIN gv ON gr.exposure_id IS NOT DISTINCT FROM gv.exposure_id AND gr.outcome_id IS NOT DISTINCT FROM gv.outcome_id AND gr.organism IS NOT DISTINCT FROM gv.organism AND gr.population_scope IS NOT DISTINCT FROM gv.population_scope AND gr.context_json = gv.context_json),
g1 AS (SELECT *, CASE WHEN top / study_count < 0.55 THEN 'mixed' {' '.join(f"WHEN votes_{d} = top THEN '{d}'" for d in rules.DIRECTIONS)} END AS dominant_direction FROM g0),
g2 AS (SELECT *, (CASE dominant_direction {' '.join(f"WHEN '{d}' THEN votes_{d}" for d in rules.DIRECTIONS)} END) AS dom_n FROM g1),
g3 AS (SELECT *, dom_n / study_count AS share, (study_count - dom_n - CASE WHEN dominant_direction = 'unclear' THEN 0 ELSE votes_unclear END) / study_count AS against FROM g2),
g4 AS (SELECT *, CASE WHEN paper_count < 2 OR study_count < 2 OR dominant_direction = 'unclear' THEN 'insufficient' WHEN against > 0.30 OR share < 0.55 THEN 'mixed'
    WHEN paper_count >= 8 AND study_count >= 10 AND share >= 0.70 AND against <= 0.15 AND 2 * ab_rows >= evidence_count THEN 'strong'
    WHEN paper_count >= 4 AND study_count >= 5 THEN 'moderate' ELSE 'weak' END AS consensus_level FROM g3),
g5 AS (SELECT *, CASE WHEN any_review THEN 'needs_review' WHEN organism IN ('animal', 'in_vitro') OR all_mech THEN 'mechanistic_only' WHEN consensus_level IN ('insufficient', 'mixed') THEN 'not_recommendable'
    WHEN consensus_level IN ('moderate', 'strong') AND rank_A > 0 THEN 'directly_usable' ELSE 'usable_with_caveat' END AS recommendation_use FROM g4),
g6 AS (SELECT *, recommendation_use <> 'directly_usable' OR any_caveat AS requires_caveat, all_causal AND consensus_level IN ('moderate', 'strong') AS causal_language_allowed,
    CASE WHEN any_review THEN 'needs_review' ELSE 'active' END AS status,
    'general_evidence_' || sha256(CAST(to_json(list_value('{v.BUILD}', exposure_id, outcome_id, organism, population_scope, context_json)) AS VARCHAR)) AS general_evidence_id FROM g5),
ge AS (SELECT *, 'What is the evidence linking ' || upper(substr(exposure_id, 10, 1)) || substr(exposure_id, 11) || ' to ' ||
    list_aggregate(list_transform(string_split(replace(substr(outcome_id, 9), '_', ' '), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', ' ') || '?' AS question FROM g6),
inn AS (SELECT ok.*, ge.general_evidence_id, ge.dominant_direction FROM ok JOIN ge ON ok.exposure_id IS NOT DISTINCT FROM ge.exposure_id AND ok.outcome_id IS NOT DISTINCT FROM ge.outcome_id AND ok.organism IS NOT DISTINCT FROM ge.organism AND ok.population_scope IS NOT DISTINCT FROM ge.population_scope AND ok.context_json = ge.context_json),
rp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY general_evidence_id ORDER BY list_position(['A', 'B', 'C', 'D', 'Reject'], evidence_rank), projection_id) AS position FROM inn) WHERE position <= 5)
"""


def _registries(spark: SparkSession, sf_dir: str):
    ev = v.evidence(spark, sf_dir)
    exposures, outcomes = E.terms(ev)
    return ev, E.registry(exposures, "exposure", T.EXPOSURE_KINDS), E.registry(outcomes, "outcome", T.OUTCOME_KINDS)


def _projections(spark: SparkSession, sf_dir: str):
    ev, exposures, outcomes = _registries(spark, sf_dir)
    return E.projections(ev, v.view(spark, sf_dir, v.SCOPES), exposures, outcomes, v.BUILD), exposures, outcomes


def _general(spark: SparkSession, sf_dir: str):
    """Projections, written once as a build does, and consensus."""
    rows = kept(_projections(spark, sf_dir)[0], "projections")
    return rows, E.general_evidence(rows, v.BUILD)


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, general = _general(spark, sf_dir)
    return kept(E.in_groups(rows, general), "grouped")


@query("agg12_scl04_scl07_scl08_exposure_registry", _EV + """SELECT 'exposure.' || n AS exposure_id, n AS canonical_name, upper(substr(n, 1, 1)) || substr(n, 2) AS display_name, term,
CASE WHEN regexp_matches(lower(term), 'diet|egg|fiber|starch|food') THEN 'food' WHEN regexp_matches(lower(term), 'exercise|training') THEN 'exercise' WHEN contains(lower(term), 'sleep') THEN 'sleep' ELSE 'other' END AS exposure_type FROM exr""")
def exposure_registry(spark, sf_dir):
    return _registries(spark, sf_dir)[1].select("exposure_id", "canonical_name", "display_name", c("aliases")[0].alias("term"), "exposure_type")


@query("agg12_scl09_outcome_registry", _EV + """SELECT 'outcome.' || n AS outcome_id, n AS canonical_name, term,
CASE WHEN regexp_matches(lower(term), 'cholesterol|glucose|insulin|biomarker') THEN 'biomarker' WHEN regexp_matches(lower(term), 'weight|bmi|waist') THEN 'anthropometric' WHEN regexp_matches(lower(term), 'microbiome|taxa|bacteria') THEN 'microbiome' ELSE 'other' END AS outcome_type FROM our""")
def outcome_registry(spark, sf_dir):
    return _registries(spark, sf_dir)[2].select("outcome_id", "canonical_name", c("aliases")[0].alias("term"), "outcome_type")


@query("jon01_jon02_jon03_nst01_projections", _EV + "SELECT * FROM pr")
def projections(spark, sf_dir):
    return _projections(spark, sf_dir)[0].drop("exposure_display", "outcome_display")


@query("agg02_support_unit_votes", _EV + "SELECT * FROM un")
def support_votes(spark, sf_dir):
    units = E.votes(_projections(spark, sf_dir)[0].filter("projection_status <> 'rejected'"))
    return units.select("paper_id", "study_id", *E.GROUP, "ab_rows", "direction", "weight")


_MEASURES = ["general_evidence_id", *E.GROUP, "paper_count", "study_count", "evidence_count", "dominant_direction", "consensus_level", "recommendation_use", "requires_caveat", "causal_language_allowed", "status", "question"]


@query(FLAGSHIP, _EV + f"SELECT {', '.join(_MEASURES)} FROM ge")
def general_evidence(spark, sf_dir):
    return E.general_evidence(_projections(spark, sf_dir)[0], v.BUILD).select(*_MEASURES)


_DIST = [f"{p}_{d}" for p in ("votes", "rows", "support") for d in rules.DIRECTIONS] + [f"rank_{r}" for r in rules.RANKS]


@query("agg03_agg04_agg05_distributions", _EV + f"SELECT general_evidence_id, {', '.join(f'CAST({x} AS BIGINT) AS {x}' if not x.startswith('support') else f'round({x}, 6) AS {x}' for x in _DIST)} FROM ge")
def distributions(spark, sf_dir):
    g = _general(spark, sf_dir)[1]
    return g.select("general_evidence_id", *[F.round(x, 6).alias(x) if x.startswith("support") else c(x) for x in _DIST])


@query("agg06_histograms", _EV + "SELECT general_evidence_id, 'study_design' AS kind, study_design AS value, count(*) AS n FROM inn GROUP BY ALL UNION ALL SELECT general_evidence_id, 'assertion_type', assertion_type, count(*) FROM inn GROUP BY ALL")
def histograms(spark, sf_dir):
    rows = _grouped(spark, sf_dir)
    parts = [E.histogram(rows, k).select("general_evidence_id", F.lit(k).alias("kind"), "value", "n") for k in ("study_design", "assertion_type")]
    return parts[0].unionByName(parts[1])


@query("win02_srt02_representatives", _EV + "SELECT general_evidence_id, projection_id, evidence_rank, position FROM rp")
def representatives(spark, sf_dir):
    return E.representatives(_grouped(spark, sf_dir)).select("general_evidence_id", "projection_id", "evidence_rank", c("position").cast("long").alias("position"))


@query("nst02_agg11_support_edges", _EV + """SELECT general_evidence_id, projection_id, role FROM (
SELECT general_evidence_id, projection_id, unnest([CASE WHEN effect_direction = dominant_direction THEN 'supporting' END, CASE WHEN effect_direction = 'no_effect' THEN 'null' END,
  CASE WHEN dominant_direction NOT IN ('mixed', 'unclear') AND effect_direction <> dominant_direction AND effect_direction NOT IN ('unclear', 'mixed') THEN 'opposing' END,
  CASE WHEN effect_direction = 'mixed' THEN 'mixed' END]) AS role FROM inn) WHERE role IS NOT NULL UNION ALL SELECT general_evidence_id, projection_id, 'representative' FROM rp""")
def support_edges(spark, sf_dir):
    rows = _grouped(spark, sf_dir)
    return E.support_edges(rows, E.representatives(rows))


@query("flt10_set04_retrieval_export", _EV + """SELECT 'general_evidence' AS document_type, general_evidence_id AS id FROM ge WHERE status = 'active' AND consensus_level <> 'insufficient' AND recommendation_use NOT IN ('not_recommendable', 'needs_review')
UNION ALL SELECT 'evidence_support', projection_id FROM pr WHERE evidence_rank IN ('A', 'B') AND projection_status = 'accepted' AND rag_use IN ('primary', 'supporting')""")
def retrieval_export(spark, sf_dir):
    rows, general = _general(spark, sf_dir)
    return E.retrieval_export(general, rows).select("document_type", "id")


@query("scl39_scl40_scl41_conclusions", _EV + """, cc AS (SELECT *, question || ' ' || CASE WHEN consensus_level = 'insufficient' THEN 'The available evidence is insufficient for a firm conclusion.' WHEN consensus_level = 'mixed' THEN 'The evidence is mixed, with conflicting findings across studies.'
WHEN recommendation_use = 'mechanistic_only' THEN 'The evidence is mechanistic or preclinical and suggests ' || dominant_direction || ', not direct human recommendation evidence.'
ELSE 'The current evidence ' || CASE WHEN causal_language_allowed THEN 'shows' ELSE 'is associated with' END || ' ' || dominant_direction || ' with ' || consensus_level || ' consensus.' END AS conclusion_claim FROM ge)
SELECT general_evidence_id, conclusion_claim, concat_ws('|', CASE WHEN consensus_level IN ('weak', 'insufficient') THEN 'Evidence is limited.' END, CASE WHEN consensus_level = 'mixed' THEN 'Evidence is conflicting.' END,
CASE WHEN recommendation_use = 'mechanistic_only' THEN 'Evidence is mechanistic or preclinical and not direct human recommendation evidence.' END, CASE WHEN any_assoc THEN 'Association evidence should not be interpreted as causal.' END) AS caveats,
concat_ws('|', CASE WHEN recommendation_use = 'mechanistic_only' AND NOT regexp_matches(lower(conclusion_claim), '\\b(mechanistic|preclinical|animal|in vitro)\\b') THEN 'mechanistic-only conclusion must state evidence type' END) AS faults FROM cc""")
def conclusions(spark, sf_dir):
    g = _general(spark, sf_dir)[1]
    return g.select("general_evidence_id", "conclusion_claim", F.array_join("caveats", "|").alias("caveats"), F.array_join(rules.conclusion_faults(c("conclusion_claim")), "|").alias("faults"))


@query("flt11_agg17_rows_per_paper", _EV + "SELECT paper_id, count(*) AS n FROM ok GROUP BY 1")
def rows_per_paper(spark, sf_dir):
    return _projections(spark, sf_dir)[0].filter("projection_status <> 'rejected'").groupBy("paper_id").agg(F.count("*").alias("n"))


@query("val11_duplicates_orphans", _EV + "SELECT 'duplicate_projection' AS kind, count(*) AS n FROM (SELECT projection_id FROM pr GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'orphan_exposure', count(*) FROM pr WHERE exposure_id NOT IN (SELECT 'exposure.' || n FROM exr)")
def ddl_checks(spark, sf_dir):
    rows, exposures, _ = _projections(spark, sf_dir)
    n = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return n(V.duplicate_keys(rows, "projection_id"), "duplicate_projection").unionByName(n(V.orphans(rows, exposures, "exposure_id"), "orphan_exposure"))


# Blocks

_CLEAN = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_TITLE = "trim(regexp_replace(section_title, '^\\d+(?:\\.\\d+)*\\.?\\s+', ''))"
_BL = f"""
WITH raw AS ({v.duck(v.BLOCKS)}),
b0 AS (SELECT paper_id, ord, {_CLEAN.format('text')} AS text, {_TITLE} AS section_title, coalesce(nullif(trim(content_kind), ''), 'paragraph') AS content_kind, lower(trim(coalesce(section_type, ''))) AS st, lower(trim(content_kind)) AS ck,
  lower({_TITLE}) AS k FROM raw),
b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, st, ck, lower(text) ORDER BY ord) AS rn FROM b0) WHERE st NOT IN ('abstract', 'frontmatter', 'front_matter', 'metadata') OR rn = 1),
b2 AS (SELECT *, sum(ch) OVER (PARTITION BY paper_id ORDER BY ord) AS run FROM (SELECT *, CASE WHEN k IS DISTINCT FROM lag(k) OVER (PARTITION BY paper_id ORDER BY ord) THEN 1 ELSE 0 END AS ch FROM b1)),
b3 AS (SELECT *, CASE WHEN lag(regexp_matches(lower(text), '(and|of|with|,|;|\\()$') OR NOT regexp_matches(text, '[.!?]["'')\\]]?$')) OVER (PARTITION BY paper_id, run ORDER BY ord) THEN 0 ELSE 1 END AS st1 FROM b2),
b4 AS (SELECT *, sum(st1) OVER (PARTITION BY paper_id, run ORDER BY ord) AS part FROM b3),
b5 AS (SELECT paper_id, run, part, min(ord) AS ord, string_agg(text, ' ' ORDER BY ord) AS text, arg_min(section_title, ord) AS section_title, arg_min(st, ord) AS st, arg_min(content_kind, ord) AS content_kind FROM b4 GROUP BY 1, 2, 3),
b6 AS (SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY ord) - 1 AS ord, text, section_title, content_kind,
  CASE WHEN contains(lower(section_title), 'ethic') THEN 'ethics' WHEN contains(lower(section_title), 'abbreviation') THEN 'supplementary'
    WHEN replace(replace(st, '-', '_'), ' ', '_') = 'material_and_methods' THEN 'methods' WHEN replace(replace(st, '-', '_'), ' ', '_') IN ('methods', 'results', 'abstract', 'discussion', 'front_matter') THEN replace(replace(st, '-', '_'), ' ', '_') ELSE 'unknown' END AS section_type FROM b5),
bk AS (SELECT paper_id, ord, paper_id || ':b' || ord AS block_id, section_title, trim(regexp_replace(lower(section_title), '[^a-z0-9]+', '-', 'g'), '-') AS section_slug, section_type, content_kind, text, sha256(lower(text)) AS content_hash FROM b6)
"""


def _blocks(spark, sf_dir):
    raw = v.view(spark, sf_dir, v.BLOCKS)
    raw = raw.withColumn("section_path", F.array("section_title"))
    return B.enforce_contract(raw)


@query("win01_win05_agg16_scl10_scl15_block_contract", _BL + "SELECT * FROM bk")
def block_contract(spark, sf_dir):
    return _blocks(spark, sf_dir).select("paper_id", c("ord").cast("long").alias("ord"), "block_id", "section_title", "section_slug", "section_type", "content_kind", "text", "content_hash")


@query("flt06_final_blocks", _BL + "SELECT paper_id, paper_id || ':b' || n AS block_id, n AS ord, section_type FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY ord) - 1 AS n FROM bk WHERE section_type IN ('abstract', 'methods', 'results', 'discussion', 'conclusion', 'supplementary'))")
def final_blocks(spark, sf_dir):
    return B.final_blocks(_blocks(spark, sf_dir)).select("paper_id", "block_id", c("ord").cast("long").alias("ord"), "section_type")


@query("agg15_sections", _BL + "SELECT paper_id, section_title AS title, section_type AS type, row_number() OVER (PARTITION BY paper_id ORDER BY f) - 1 AS ord FROM (SELECT paper_id, section_title, section_type, min(ord) AS f FROM bk GROUP BY ALL)")
def sections(spark, sf_dir):
    return B.sections(_blocks(spark, sf_dir)).select("paper_id", "title", "type", c("ord").cast("long").alias("ord"))


@query("flt04_flt05_routing", _BL + "SELECT block_id, section_type NOT IN ('front_matter', 'references', 'acknowledgements', 'funding', 'disclosure', 'ethics', 'appendix', 'supplementary') AS to_classifier, section_type IN ('methods', 'results', 'discussion', 'conclusion') AS to_evidence FROM bk")
def routing(spark, sf_dir):
    b = _blocks(spark, sf_dir).select("block_id", "section_type")
    yes = lambda df, n: df.select("block_id", F.lit(True).alias(n))
    j = b.join(yes(B.classifier_input(b), "a"), "block_id", "left").join(yes(B.evidence_blocks(b), "e"), "block_id", "left")
    return j.select("block_id", c("a").isNotNull().alias("to_classifier"), c("e").isNotNull().alias("to_evidence"))


@query("val06_contract_faults", _BL + "SELECT block_id, 'missing text' AS errors FROM bk WHERE text = ''")
def contract_faults(spark, sf_dir):
    return B.contract_faults(_blocks(spark, sf_dir)).select("block_id", F.array_join("errors", "|").alias("errors"))


@query("agg14_scl21_merge_batches", f"WITH raw AS ({v.duck(v.BLOCKS)}), r AS (SELECT paper_id, ord, row_number() OVER (PARTITION BY paper_id, section_title, coalesce(section_type, ''), content_kind, lower({_CLEAN.format('text')}) ORDER BY ord) AS n FROM raw) SELECT paper_id, ord AS source_ord, row_number() OVER (PARTITION BY paper_id ORDER BY ord) - 1 AS ord FROM r WHERE n = 1")
def merge_batches(spark, sf_dir):
    raw = v.view(spark, sf_dir, v.BLOCKS).withColumns({"batch": F.floor(c("ord") / 5), "source_ord": c("ord").cast("long")})
    return B.merge_batches(raw).select("paper_id", "source_ord", c("ord").cast("long").alias("ord"))


_SCOPE_IDS = "SELECT paper_id, list(block_id ORDER BY ord) AS own FROM (SELECT * FROM bk WHERE section_type IN ('methods', 'results')) GROUP BY 1"


@query("jon05_packets", _BL + f"SELECT paper_id, 'scope_1' AS experiment_scope_id, array_to_string(own, ',') AS block_ids, len(own) AS n FROM ({_SCOPE_IDS})")
def packets(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    own = b.filter(c("section_type").isin("methods", "results")).groupBy("paper_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "block_id"))), lambda x: x["block_id"]).alias("source_block_ids"))
    found = B.packets(own.withColumn("experiment_scope_id", F.lit("scope_1")), b)
    return found.select("paper_id", "experiment_scope_id", F.array_join(F.transform("blocks", lambda x: x["block_id"]), ",").alias("block_ids"), F.size("blocks").cast("long").alias("n"))


@query("jon17_unknown_blocks", _BL + "SELECT paper_id, 'scope_1' AS experiment_scope_id, paper_id || ':b5' AS block_id FROM (SELECT paper_id, max(ord) AS m FROM bk GROUP BY 1) WHERE m < 5")
def unknown_blocks(spark, sf_dir):
    b = _blocks(spark, sf_dir)
    scopes = b.select("paper_id").distinct().select("paper_id", F.lit("scope_1").alias("experiment_scope_id"), F.array(F.concat("paper_id", F.lit(":b0")), F.concat("paper_id", F.lit(":b5"))).alias("source_block_ids"))
    return B.unknown_block_ids(scopes, b).select("paper_id", "experiment_scope_id", "block_id")


@query("nst06_scl33_markdown_units")
def markdown_units(spark, sf_dir):
    return M.structural_units(v.table(spark, sf_dir, "documents"), "doc_id", "text")


@query("win06_win07_win08_markdown_batches")
def markdown_batches(spark, sf_dir):
    return M.without_oversized(M.markdown_batches(v.table(spark, sf_dir, "documents"), "doc_id", "text"))


# Metadata

_DOI = "nullif(lower(trim(regexp_replace(regexp_replace(trim(raw_doi), '^https?://(dx\\.)?doi\\.org/', '', 'i'), '^doi:\\s*', '', 'i'))), '')"
_LK = f"""WITH lk0 AS ({v.duck(v.LAKE)}), lk AS (SELECT *, {_DOI} AS doi FROM lk0), ln AS ({v.duck(v.LINKS)}),
kw AS (SELECT *, array_to_string(regexp_extract_all(lower(regexp_replace(strip_accents(title), '[^\\x00-\\x7F]', '', 'g')), '[a-z0-9]+'), ' ') AS kt FROM lk)"""


def _lake(spark, sf_dir):
    lake = v.view(spark, sf_dir, v.LAKE)
    return lake.withColumn("doi", T.normalize_doi(c("raw_doi")))


@query("scl01_scl02_scl26_scl29_identities", _LK + " SELECT metadata_id, doi, 'doi-' || coalesce(nullif(trim(regexp_replace(coalesce(doi, ''), '[^a-z0-9._-]+', '-', 'g'), '-'), ''), 'unknown-doi') AS base_name, sha256(metadata_id) AS paper_id FROM lk")
def identities(spark, sf_dir):
    return _lake(spark, sf_dir).select("metadata_id", "doi", T.base_name(c("raw_doi")).alias("base_name"), ids.paper_id(c("metadata_id")).alias("paper_id"))


@query("flt01_flt03_lake_records", _LK + " SELECT metadata_id, doi, title, CAST(year AS BIGINT) AS year, citation_count FROM (SELECT * REPLACE (trim(title) AS title) FROM lk) WHERE citation_count >= 500 AND year >= 2000 AND title <> ''")
def lake_records(spark, sf_dir):
    papers = _lake(spark, sf_dir).withColumn("pdf_url", F.lit(None).cast("string"))
    return D.citation_filter(D.lake_records(papers), 500, 2000).select("metadata_id", "doi", "title", "year", "citation_count")


@query("jon18_scl05_scl06_keyword_match", _LK + f" SELECT metadata_id, array_to_string(list_filter({KEYWORDS}, lambda k: CASE WHEN contains(k, ' ') THEN contains(kt, k) ELSE contains(' ' || kt, ' ' || k) END), ',') AS matched FROM kw")
def keyword_match(spark, sf_dir):
    lake = _lake(spark, sf_dir).select("metadata_id", T.keyword_text(c("title")).alias("normalised"))
    return lake.select("metadata_id", F.array_join(T.matched_keywords(c("normalised"), KEYWORDS), ",").alias("matched"))


@query("srt01_flt07_seed_top_k", _LK + f" SELECT doi, title, citation_count FROM kw WHERE doi IS NOT NULL AND citation_count >= 100 AND len(list_filter({KEYWORDS}, lambda k: CASE WHEN contains(k, ' ') THEN contains(kt, k) ELSE contains(' ' || kt, ' ' || k) END)) > 0 ORDER BY citation_count DESC, lower(title), doi LIMIT 200")
def seeds(spark, sf_dir):
    return D.seed_candidates(_lake(spark, sf_dir), KEYWORDS, 100).drop("matched_keywords")


@query("jon06_flt07_missing_pdfs", _LK + " SELECT metadata_id, sha256(metadata_id) AS paper_id, doi, title, 'no_matching_record_in_paper_pdf_links' AS reason FROM lk WHERE (decision IS NULL OR decision = 'keep') AND metadata_id NOT IN (SELECT metadata_id FROM ln) AND (doi IS NULL OR doi NOT IN (SELECT doi FROM ln WHERE doi IS NOT NULL))")
def missing_pdfs(spark, sf_dir):
    return D.missing_pdfs(_lake(spark, sf_dir), v.view(spark, sf_dir, v.LINKS))


@query("jon09_set03_pending_seeds", _LK + " SELECT doi FROM lk WHERE doi IS NOT NULL AND doi NOT IN (SELECT doi FROM ln WHERE doi IS NOT NULL)")
def pending(spark, sf_dir):
    queue = _lake(spark, sf_dir).filter("doi is not null").select("doi", c("doc_id").alias("pos"))
    return D.pending(queue, v.view(spark, sf_dir, v.LINKS).filter("doi is not null")).select("doi")


@query("jon08_src07_known_papers", _LK + " SELECT id FROM (SELECT source_paper_id AS id FROM lk UNION SELECT 'doi-' || replace(doi, '/', '-') FROM lk WHERE doi IS NOT NULL)")
def known(spark, sf_dir):
    return R.known_ids(_lake(spark, sf_dir))


@query("flt08_scl28_win09_bibliography", _LK + " SELECT metadata_id, replace(metadata_id, ':', '_') AS citekey, '@article{' || replace(metadata_id, ':', '_') || ',' || chr(10) || '  doi = {' || doi || '}' || chr(10) || '}' AS entry FROM lk WHERE decision = 'keep' AND doi IS NOT NULL")
def bibliography(spark, sf_dir):
    return D.bibliography(_lake(spark, sf_dir)).drop("base")


@query("snk03_upsert_lake", _LK + """, old AS (SELECT metadata_id, doi, 'v1' AS version, 'old' AS created_at FROM lk WHERE doc_id % 3 <> 0), new AS (SELECT metadata_id, doi, 'v2' AS version, 'new' AS created_at FROM lk WHERE doc_id % 3 <> 1)
SELECT n.metadata_id, n.doi, n.version, coalesce(o.created_at, n.created_at) AS created_at FROM new n LEFT JOIN old o USING (metadata_id) UNION ALL SELECT * FROM old WHERE metadata_id NOT IN (SELECT metadata_id FROM new)""")
def upsert_lake(spark, sf_dir):
    lake = _lake(spark, sf_dir)
    side = lambda cond, version, at: lake.filter(cond).select("metadata_id", "doi", F.lit(version).alias("version"), F.lit(at).alias("created_at"))
    return D.upsert(side("doc_id % 3 <> 0", "v1", "old"), side("doc_id % 3 <> 1", "v2", "new"))


@query("jon07_backfill_links", _LK + " SELECT sha256(l.metadata_id) AS paper_id, l.doi, k.metadata_id, k.metadata_id IS NOT NULL AS linked FROM ln l LEFT JOIN lk k ON k.doi = l.doi")
def backfill(spark, sf_dir):
    links = v.view(spark, sf_dir, v.LINKS).withColumn("paper_id", ids.paper_id(c("metadata_id")))
    return D.backfill_links(links.select("paper_id"), links.select("paper_id", "doi", c("doc_id").alias("ordinal")), _lake(spark, sf_dir))


@query("jon13_val08_flt14_decisions", _LK + " SELECT metadata_id AS candidate_id, coalesce(decision, 'uncertain') AS decision, coalesce(decision, 'uncertain') = 'drop' AS discarded FROM lk")
def decisions(spark, sf_dir):
    lake = _lake(spark, sf_dir).withColumnRenamed("metadata_id", "candidate_id")
    found = lake.select("candidate_id", "decision").unionByName(lake.select(F.concat(F.lit("other:"), "candidate_id").alias("candidate_id"), F.lit("keep").alias("decision")))
    return D.decisions(lake.select("candidate_id"), found).select("candidate_id", "decision", "discarded")


@query("win10_str06_candidate_batches", "SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS batch, 'cand_' || lpad(CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 20 + 1 AS VARCHAR), 3, '0') AS candidate_id FROM documents")
def candidate_batches(spark, sf_dir):
    return D.candidate_batches(v.table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")


@query("srt05_agg20_seeded_sample", "SELECT paper_id FROM (SELECT DISTINCT 'paper_' || o_custkey AS paper_id FROM orders) ORDER BY md5(paper_id || 'seed') LIMIT 50")
def sample(spark, sf_dir):
    return D.seeded_sample(v.table(spark, sf_dir, "orders").select(F.concat(F.lit("paper_"), "o_custkey").alias("paper_id")), "seed", 50)


@query("aux32_agg18_resolution", "WITH a AS (SELECT p_partkey, p_size, p_retailprice FROM part) SELECT 'p' || p_partkey AS metadata_id, CASE WHEN p_size % 3 = 0 THEN 'downloaded' WHEN p_size % 5 = 0 THEN 'url_only' ELSE 'not_found' END AS resolution_status, CASE WHEN p_size % 3 = 0 THEN 'europe_pmc' WHEN p_size % 5 = 0 THEN 'unpaywall' END AS source FROM a")
def resolution(spark, sf_dir):
    p = v.table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("metadata_id"), "p_size")
    tries = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("source"), u.alias("url"), d.alias("downloaded")) for i, (n, u, d) in enumerate([("unpaywall", F.when(c("p_size") % 5 == 0, "u1"), F.lit(False)), ("europe_pmc", F.when(c("p_size") % 3 == 0, "u2"), c("p_size") % 3 == 0), ("core", F.lit(None).cast("string"), F.lit(False))])])
    return D.resolve_attempts(p.select("metadata_id", F.inline(tries))).drop("url")


@query("snk23_aux29_migration_plan", "SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.h IS NULL THEN 'copy' WHEN a.h IS NULL THEN 'only_new' WHEN a.h = b.h THEN 'same' ELSE 'conflict' END AS action FROM (SELECT 'f' || p_partkey AS name, p_brand AS h FROM part WHERE p_partkey % 3 <> 0) a FULL JOIN (SELECT 'f' || p_partkey AS name, CASE WHEN p_partkey % 7 = 0 THEN 'x' ELSE p_brand END AS h FROM part WHERE p_partkey % 2 = 0) b ON a.name = b.name")
def migration(spark, sf_dir):
    p = v.table(spark, sf_dir, "part").withColumn("name", F.concat(F.lit("f"), "p_partkey"))
    new = p.filter("p_partkey % 2 = 0").select("name", F.when(c("p_partkey") % 7 == 0, "x").otherwise(c("p_brand")).alias("hash"))
    return D.migration_plan(p.filter("p_partkey % 3 <> 0").select("name", c("p_brand").alias("hash")), new).select("name", "action")


# State

_PS = f"WITH pe AS ({v.duck(v.EVENTS)}), se AS (SELECT *, CASE WHEN status = 'started' THEN 'running' ELSE status END AS s FROM pe)"
_LAST = "arg_max({0}, event_at)"


def _states(spark, sf_dir):
    return S.events_to_states(v.view(spark, sf_dir, v.EVENTS))


@query("snk04_str02_scl45_state_fold", _PS + """, z AS (SELECT paper_id, max(event_at) AS updated_at FROM se GROUP BY 1)
SELECT se.paper_id, max(s) FILTER (event_at = updated_at) AS status, max(stage) FILTER (event_at = updated_at) AS stage, max(CASE WHEN s = 'failed' THEN event_type END) FILTER (event_at = updated_at) AS error_code,
max(CASE WHEN s = 'failed' THEN message END) FILTER (event_at = updated_at) AS error_message, arg_max(artifact_path, event_at) AS artifact_path, max(event_at) FILTER (s IN ('succeeded', 'failed', 'skipped')) AS ended_at,
min(event_at) FILTER (s = 'running') AS started_at, max(event_at) AS updated_at, count(*) AS n_events FROM se JOIN z ON se.paper_id = z.paper_id GROUP BY 1""")
def state_fold(spark, sf_dir):
    return S.fold(_states(spark, sf_dir), ["paper_id"])


@query("win04_agg_latest_per_stage", _PS + " SELECT paper_id, stage, arg_max(s, event_at) AS status, max(event_at) AS event_at FROM se GROUP BY 1, 2")
def latest_stage(spark, sf_dir):
    return S.latest(_states(spark, sf_dir).select("paper_id", "stage", "status", "event_at"), ["paper_id", "stage"], ["event_at"])


_FACTS = _PS + """, sp AS (SELECT 'paper_' || c_custkey AS paper_id FROM customer WHERE c_custkey % 3 = 0), sb AS (SELECT 'paper_' || c_custkey AS paper_id FROM customer WHERE c_custkey % 4 = 0),
pc AS (SELECT 'paper_' || o_custkey AS paper_id, CASE WHEN o_orderkey % 2 = 0 THEN 'primary_research' ELSE 'methodological' END AS paper_family, o_orderkey AS updated_at FROM orders WHERE o_custkey % 2 = 0),
em AS (SELECT 'paper_' || c_custkey AS paper_id FROM customer WHERE c_custkey % 5 = 0), ce AS (SELECT 'paper_' || c_custkey AS paper_id FROM customer WHERE c_custkey % 8 = 0),
ids AS (SELECT paper_id FROM se UNION SELECT paper_id FROM sp UNION SELECT paper_id FROM sb UNION SELECT paper_id FROM pc UNION SELECT paper_id FROM em UNION SELECT paper_id FROM ce),
lc AS (SELECT paper_id, arg_max(paper_family, updated_at) AS paper_family FROM pc GROUP BY 1),
ls AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY event_at DESC) AS rn FROM se) WHERE rn = 1),
fa AS (SELECT i.paper_id, i.paper_id IN (SELECT paper_id FROM sp) AS has_structured_paper, i.paper_id IN (SELECT paper_id FROM sb) AS has_structured_blocks, i.paper_id IN (SELECT paper_id FROM em) AS has_experiment_map,
  i.paper_id IN (SELECT paper_id FROM ce) AS has_canonical_evidence, lc.paper_id IS NOT NULL AS has_paper_classification, paper_family, ls.stage AS latest_pipeline_stage, ls.s AS latest_pipeline_status,
  CASE WHEN ls.s = 'failed' THEN event_type END AS last_error_code, CASE WHEN ls.s = 'failed' THEN message END AS last_error_message FROM ids i LEFT JOIN lc USING (paper_id) LEFT JOIN ls USING (paper_id))"""


def _facts(spark, sf_dir):
    cust = v.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("paper_"), "c_custkey").alias("paper_id"))
    every = {"structured_paper": 3, "structured_blocks": 4, "experiment_map": 5, "canonical_evidence": 8}
    family = F.when(c("o_orderkey") % 2 == 0, "primary_research").otherwise("methodological")
    classes = v.table(spark, sf_dir, "orders").filter("o_custkey % 2 = 0").select(F.concat(F.lit("paper_"), "o_custkey").alias("paper_id"), family.alias("paper_family"), c("o_orderkey").alias("updated_at"))
    return S.processing_facts(_states(spark, sf_dir), {n: cust.filter(c("c_custkey") % k == 0) for n, k in every.items()}, classes)


@query("set01_jon10_jon11_jon12_win03_processing_facts", _FACTS + " SELECT * FROM fa")
def processing_facts(spark, sf_dir):
    return _facts(spark, sf_dir)


@query("jon14_scl44_set02_processing_state", _FACTS + """, fi AS (SELECT 'paper_' || s_suppkey AS paper_id, s_suppkey % 2 = 0 AS has_pdf, s_suppkey % 3 > 0 AS has_markdown FROM supplier),
j AS (SELECT paper_id, coalesce(has_pdf, false) AS has_pdf, coalesce(has_markdown, false) AS has_markdown, coalesce(has_structured_paper, false) AS sp, coalesce(has_structured_blocks, false) AS sb, coalesce(has_paper_classification, false) AS pc,
 coalesce(has_experiment_map, false) AS em, coalesce(has_canonical_evidence, false) AS ce, paper_family, latest_pipeline_stage AS ls, latest_pipeline_status AS st FROM fi FULL JOIN fa USING (paper_id)),
k AS (SELECT *, CASE WHEN NOT has_pdf AND NOT has_markdown THEN 0 WHEN NOT has_markdown THEN 1 WHEN NOT sp THEN 2 WHEN st IN ('failed', 'blocked') THEN 3 WHEN NOT pc THEN 4 WHEN paper_family <> 'primary_research' THEN 5 WHEN NOT sb THEN 6 WHEN NOT em THEN 7 WHEN NOT ce THEN 8 ELSE 9 END AS r FROM j)
SELECT paper_id, ['blocked', 'pending', 'pending', 'failed', 'pending', 'succeeded', 'pending', 'pending', 'pending', 'succeeded'][r + 1] AS overall_status,
 CASE WHEN r = 3 THEN ls ELSE ['input.discovery', 'pdf.markdown', 'pdf.process', '', 'classification.classify', 'classification.classify', 'pdf.process', 'evidence.map', 'evidence.extract', 'export.ready'][r + 1] END AS current_stage,
 CASE WHEN r IN (0, 5, 9) THEN NULL WHEN r = 3 THEN ls ELSE ['', 'pdf.markdown', 'pdf.process', '', 'classification.classify', '', 'pdf.process', 'evidence.map', 'evidence.extract', ''][r + 1] END AS next_stage,
 r IN (5, 9) AS is_complete, r <> 0 AS is_processable FROM k""")
def processing_state(spark, sf_dir):
    files = v.table(spark, sf_dir, "supplier").select(F.concat(F.lit("paper_"), "s_suppkey").alias("paper_id"), (c("s_suppkey") % 2 == 0).alias("has_pdf"), (c("s_suppkey") % 3 > 0).alias("has_markdown"))
    return S.processing_state(files, _facts(spark, sf_dir)).select("paper_id", "overall_status", "current_stage", "next_stage", "is_complete", "is_processable")


@query("src10_str07_status_index", _PS + " SELECT paper_id, CASE s WHEN 'succeeded' THEN 'done' ELSE s END AS status FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY event_at DESC) AS n FROM se) WHERE n = 1 AND s IN ('succeeded', 'failed')")
def status_index(spark, sf_dir):
    log = _states(spark, sf_dir).select("paper_id", F.when(c("status") == "succeeded", "done").otherwise(c("status")).alias("status"), c("event_at").alias("line"))
    return R.status_index(log)


@query("snk18_agg21_outbox_replay", "SELECT outcome, count(*) AS n, CAST(sum(a) AS BIGINT) AS attempts FROM (SELECT CASE WHEN c_custkey % 4 = 0 THEN 'skipped' WHEN c_custkey % 5 = 0 THEN 'failed' ELSE 'delivered' END AS outcome, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 2 END AS a FROM customer) GROUP BY 1")
def outbox_replay(spark, sf_dir):
    cust = v.table(spark, sf_dir, "customer").select(ids.nul_joined("outbox", F.lit("store"), F.lit("customer"), c("c_custkey")).alias("outbox_id"), F.when(c("c_custkey") % 5 == 0, "{}").otherwise(c("c_name")).alias("payload"), F.lit(1).alias("attempt_count"), "c_custkey")
    r = S.replay(cust, cust.filter("c_custkey % 4 = 0"))
    return r.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("attempt_count").alias("attempts"))


_ID = "substr(sha256('run' || chr(0) || paper_id || chr(0) || stage || chr(0) || '1'), 1, 24)"


@query("scl48_aux23_stable_ids", _PS + f" SELECT DISTINCT paper_id, stage, 'attempt_' || {_ID} AS attempt_id, 'idm_' || sha256('run' || chr(0) || stage || chr(0) || 'write' || chr(0) || paper_id) AS idempotency_key FROM se")
def stable_ids(spark, sf_dir):
    e = _states(spark, sf_dir).select("paper_id", "stage").distinct()
    return e.select("paper_id", "stage", ids.nul_joined("attempt", F.lit("run"), c("paper_id"), c("stage"), F.lit("1")).alias("attempt_id"), ids.idempotency_key(F.lit("run"), c("stage"), F.lit("write"), c("paper_id")).alias("idempotency_key"))


# Validation

_VIEW = f"WITH ev AS ({v.duck(v.EVIDENCE)})"


@query("val05_evidence_faults", _VIEW + " SELECT canonical_evidence_id, concat_ws('|', CASE WHEN ordinal % 9 = 0 THEN 'evidence_text is required' END, CASE WHEN ordinal % 4 = 0 THEN 'evidence_type is invalid: odd' END, CASE WHEN ordinal % 6 = 0 THEN 'observations is empty' END, CASE WHEN ordinal % 6 <> 0 AND ordinal % 10 = 0 THEN 'source_quote is blank' END) AS errors FROM ev WHERE ordinal % 9 = 0 OR ordinal % 4 = 0 OR ordinal % 6 = 0 OR ordinal % 10 = 0")
def evidence_faults(spark, sf_dir):
    n = c("ordinal")
    one = F.struct(F.lit("b1").alias("source_block_id"), F.when(n % 10 == 0, " ").otherwise("quote").alias("source_quote"), F.lit("primary_finding").alias("observation_role"))
    ev = v.view(spark, sf_dir, v.EVIDENCE).withColumns({"evidence_text": F.when(n % 9 == 0, " ").otherwise("text"), "evidence_type": F.when(n % 4 == 0, "odd").otherwise("other"), "observations": F.filter(F.array(one), lambda x: n % 6 != 0)})
    return V.evidence(ev).filter(F.size("errors") > 0).select("canonical_evidence_id", F.array_join("errors", "|").alias("errors"))


@query("scl42_scl43_normalised_evidence", _VIEW + ", k AS (SELECT canonical_evidence_id, effect_direction AS d, CASE ordinal % 3 WHEN 0 THEN 'between_group_result' WHEN 1 THEN 'specificity_or_selectivity_result' ELSE 'other' END AS t FROM ev) SELECT canonical_evidence_id, t AS evidence_type, CASE WHEN t = 'specificity_or_selectivity_result' THEN 'mechanistic_result' ELSE 'primary_result' END AS evidence_role_in_paper, CASE WHEN d = 'no_effect' THEN 'no_association' WHEN t = 'specificity_or_selectivity_result' THEN 'mechanistic_link' WHEN t = 'between_group_result' THEN 'comparative_effect' ELSE 'unclear' END AS assertion_type FROM k")
def normalised_evidence(spark, sf_dir):
    n = c("ordinal")
    ev = v.view(spark, sf_dir, v.EVIDENCE).withColumns({"evidence_type": F.when(n % 3 == 0, "between_group_result").when(n % 3 == 1, "specificity_or_selectivity_result").otherwise("association"), "evidence_role_in_paper": F.lit(None).cast("string"), "assertion_type": F.lit(None).cast("string"), "canonical_evidence_status": F.lit(None).cast("string")})
    return V.normalise_evidence(ev).select("canonical_evidence_id", "evidence_type", "evidence_role_in_paper", "assertion_type")


@query("val02_classification_faults", "SELECT o_orderkey AS id, concat_ws('|', CASE WHEN o_orderstatus = 'P' THEN 'paper_family is invalid: odd' END, CASE WHEN o_orderkey % 5 = 0 THEN 'classification_confidence must lie in 0 to 1' END) AS errors FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 5 = 0")
def classification_faults(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), F.lit("p").alias("paper_id"), F.lit("t").alias("paper_type"), F.when(c("o_orderstatus") == "P", "odd").otherwise("methodological").alias("paper_family"), F.lit("unclear").alias("evidence_generation_mode"), F.when(c("o_orderkey") % 5 == 0, 1.5).otherwise(0.5).alias("classification_confidence"))
    return V.classification(o).filter(F.size("errors") > 0).select("id", F.array_join("errors", "|").alias("errors"))


@query("val07_event_faults", _PS + " SELECT status, count(*) AS n FROM pe WHERE status NOT IN ('running', 'succeeded', 'failed') GROUP BY 1")
def event_faults(spark, sf_dir):
    e = V.operational(v.view(spark, sf_dir, v.EVENTS), {"status": ["running", "succeeded", "failed"]}, ["attempt", "paper_id"])
    return e.filter(F.size("errors") > 0).groupBy("status").agg(F.count("*").alias("n"))


# Text

@query("scl13_scl20_scl25_text", "SELECT doc_id, trim(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '-') AS slug, CASE WHEN len(string_split(t, ' ')) > 20 THEN array_to_string(list_slice(string_split(t, ' '), 1, 20), ' ') || '...' ELSE t END AS preview FROM (SELECT doc_id, source, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS t FROM documents)")
def text_functions(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", T.slugify(c("source")).alias("slug"), T.truncate_words(c("text"), 20).alias("preview"))


@query("scl11_scl12_content_hash", "SELECT doc_id, sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return v.table(spark, sf_dir, "documents").select("doc_id", T.content_hash(c("text")).alias("content_hash"))


@query("scl18_win_open_ends", "SELECT doc_id, count(*) AS n_lines, count(*) FILTER (regexp_matches(lower(l), '(and|of|with|,|;|\\()$') OR NOT regexp_matches(l, '[.!?][\"'')\\]]?$')) AS n_open FROM (SELECT doc_id, trim(regexp_replace(unnest(string_split(text, chr(10))), '\\s+', ' ', 'g')) AS l FROM documents) WHERE l <> '' GROUP BY 1")
def open_ends(spark, sf_dir):
    lines = v.table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("l")).filter(T.clean_text(c("l")) != "")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(T.is_open_ended(c("l"))).alias("n_open"))


@query("src10_first_seen_turns", "SELECT role, min(conv_id) AS conv_id, count(*) AS n FROM conversations GROUP BY 1")
def first_turns(spark, sf_dir):
    t = v.table(spark, sf_dir, "conversations")
    return t.groupBy("role").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))


@query("agg07_counts_per_exposure", _EV + " SELECT exposure_id, count(*) AS evidence_count, count(DISTINCT paper_id) AS paper_count, count(DISTINCT study_id) AS study_names FROM ok GROUP BY 1")
def counts(spark, sf_dir):
    rows = _projections(spark, sf_dir)[0].filter("projection_status <> 'rejected'")
    return rows.groupBy("exposure_id").agg(F.count("*").alias("evidence_count"), F.countDistinct(F.nullif("paper_id", F.lit(""))).alias("paper_count"), F.countDistinct("study_id").alias("study_names"))


@query("win11_line_offsets", "SELECT doc_id, pos, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char FROM " + v.LINES_DUCK)
def line_offsets(spark, sf_dir):
    lines = v.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return lines.select("doc_id", c("pos").cast("long").alias("pos"), F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0)).alias("start_char"))


@query("scl45_aux_last_messages", _PS + " SELECT paper_id, arg_max(message, event_at) AS message FROM se GROUP BY 1")
def last_messages(spark, sf_dir):
    return S.latest(_states(spark, sf_dir).select("paper_id", "message", "event_at"), ["paper_id"], ["event_at"]).select("paper_id", "message")
