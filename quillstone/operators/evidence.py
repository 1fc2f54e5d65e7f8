"""Evidence derivation: registries, projections, votes, consensus, support edges, retrieval export."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import rules
from ..functions.ids import canonical_json, json_text, stable_id
from ..functions.text import EXPOSURE_KINDS, OUTCOME_KINDS, canonical_name, display_name, kind_of
from ..sources.sinks import bounded, kept

GROUP = ["exposure_id", "outcome_id", "organism", "population_scope", "context_json"]
c = F.col


def registry(terms: DataFrame, prefix: str, kinds: list[tuple[str, str]]) -> DataFrame:
    """One active row per canonical name of (term, ordinal); the first spelling in scan order names it.

    Terms are first reduced to the distinct ones, by a number, which aggregates in hash tables; names are made of what is left.
    """
    kind = terms.schema["ordinal"].dataType
    scan, rest = ("ordinal." + kind.names[0], [f"ordinal.{x}" for x in kind.names[1:]]) if isinstance(kind, StructType) else ("ordinal", [])
    rest = [c(x).alias(f"o{k}") for k, x in enumerate(rest, 1)]
    distinct = terms.groupBy("term", *rest).agg(F.min(scan).alias("o0"))
    named = distinct.select(F.trim("term").alias("term"), F.struct(*[f"o{k}" for k in range(len(rest) + 1)]).alias("ordinal"), canonical_name(c("term")).alias("canonical_name")).filter("canonical_name <> ''")
    first = named.groupBy("canonical_name").agg(F.min_by("term", "ordinal").alias("term"))
    return first.select(
        F.concat(F.lit(f"{prefix}."), "canonical_name").alias(f"{prefix}_id"), "canonical_name", display_name(c("canonical_name")).alias("display_name"),
        kind_of(c("term"), kinds).alias(f"{prefix}_type"), F.array("term").alias("aliases"), F.lit("active").alias("status"), F.lit("deterministic").alias("created_by"), F.lit("medium").alias("confidence"),
    )


def evidence_items(papers: DataFrame, items: str = "canonical_evidence") -> DataFrame:
    """One row per evidence item of the papers' lists; null lists and null items give none."""
    return papers.select(F.explode(items).alias("item")).filter("item is not null").select("item.*")


def fan_out(evidence: DataFrame) -> DataFrame:
    """One row per outcome and its canonical name, of which the first of an item counts. Without outcomes it is one row with a null outcome."""
    named = evidence.withColumn("__names", F.transform("raw_outcomes", canonical_name))
    pairs = F.arrays_zip(c("raw_outcomes").alias("term"), c("__names").alias("name"))
    first = F.when(F.size("__names") == F.size(F.array_distinct("__names")), pairs).otherwise(F.filter(pairs, lambda x, k: F.array_position(c("__names"), x["name"]) == k + 1))
    return named.select("*", F.explode_outer(first).alias("__one")).select(*evidence.columns, c("__one.term").alias("raw_outcome"), c("__one.name").alias("outcome_name"))


def terms(evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, ordinal) of exposures and of outcomes; ordinal is the place in the scan, of outcomes also that in the list."""
    exposures = evidence.select(c("raw_exposure").alias("term"), "ordinal")
    outcomes = evidence.select("ordinal", F.posexplode("raw_outcomes").alias("pos", "term"))
    return exposures, outcomes.select("term", F.struct("ordinal", "pos").alias("ordinal"))


def context_json(nested: bool = False) -> Column:
    """Canonical JSON of the column context_identity: keys in order, compact, in ASCII, {} for none.

    A map of text is written by built-in functions; of ``nested`` contexts, given as JSON text, numbers get Python's form.
    """
    if nested:
        return F.coalesce(canonical_json(c("context_identity"), ascii_only=True), F.lit("{}"))
    entries = F.sort_array(F.map_entries("context_identity"))
    plain = F.to_json(F.map_from_entries(entries))
    pairs = F.transform(entries, lambda e: F.concat(json_text(e["key"]), F.lit(":"), F.coalesce(json_text(e["value"]), F.lit("null"))))
    escaped = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    written = F.when(plain.rlike("^[ -~]*$") & ~F.contains(plain, F.lit("\\u")), plain).otherwise(escaped)
    return F.when(F.size("context_identity") > 0, F.coalesce(written, F.lit("{}"))).otherwise("{}")


def last_scopes(scopes: DataFrame) -> DataFrame:
    """Scopes by (paper, study); of repeated ones the last counts."""
    keyed = scopes.withColumn("study_id", F.coalesce("study_id", "experiment_scope_id"))
    return keyed.groupBy("paper_id", "study_id").agg(F.max_by("study_design", "ordinal").alias("scope_design"))


def projections(evidence: DataFrame, scopes: DataFrame, exposures: DataFrame, outcomes: DataFrame, build_id: str) -> DataFrame:
    """Ranked projections. Registries hold one row per distinct term; they are written, and broadcast within a counted bound.

    Scopes are joined before the outcomes fan out: evidence moves once, to its paper and study, and stays there.
    """

    def active(r: DataFrame, p: str) -> DataFrame:
        names = kept(r.filter("status = 'active'").select(c("canonical_name").alias(f"{p}_name"), f"{p}_id", c("display_name").alias(f"{p}_display")), p)
        return bounded(names)

    evidence = evidence.withColumn("context_json", context_json(evidence.schema["context_identity"].dataType.typeName() == "string") if "context_identity" in evidence.columns else F.lit("{}"))
    if "has_quant" not in evidence.columns:
        evidence = evidence.withColumn("has_quant", rules.has_quantitative(c("comparator"), c("quantitative_summary"), c("quantitative_values")))
    scoped = evidence.withColumns({"exposure_name": canonical_name(c("raw_exposure")), "study_id": F.coalesce("study_id", F.lit("unclear"))}).join(last_scopes(scopes), ["paper_id", "study_id"], "left")
    rows = fan_out(scoped).withColumn("outcome_name", F.coalesce("outcome_name", F.lit("")))
    rows = rows.join(active(exposures, "exposure"), "exposure_name", "left").join(active(outcomes, "outcome"), "outcome_name", "left")
    unclear = lambda name: F.coalesce(name, F.lit("unclear"))
    rows = rows.withColumns({"study_design": unclear("scope_design"), "effect_direction": unclear("effect_direction"), "evidence_role_in_paper": unclear("evidence_role_in_paper"), "assertion_type": unclear("assertion_type"), "organism": F.coalesce("organism", rules.organism_of_design(c("scope_design"))), "build_id": F.lit(build_id)})
    rows = rows.withColumn("rank", rules.ranking())
    return rows.select(
        stable_id("projection", c("build_id"), c("canonical_evidence_id"), c("exposure_id"), c("outcome_id")).alias("projection_id"),
        "build_id", "canonical_evidence_id", "paper_id", "study_id", *GROUP, "effect_direction", "study_design", "evidence_role_in_paper", "assertion_type", "exposure_display", "outcome_display", "rank.*",
    )


def votes(rows: DataFrame) -> DataFrame:
    """One row per support unit: its direction and weight, and what the group's measures need of its rows.

    The first of two aggregations: both combine on the map side, and no join follows.
    """
    strong = c("evidence_rank").isin("A", "B")
    n_strong = F.count_if(strong)
    any_, all_ = F.bool_or, F.bool_and
    unit = rows.groupBy("paper_id", "study_id", *GROUP).agg(
        n_strong.alias("ab_rows"), F.count("*").alias("n_rows"),
        F.min(F.when(strong, c("effect_direction"))).alias("lo_s"), F.max(F.when(strong, c("effect_direction"))).alias("hi_s"),
        F.min("effect_direction").alias("lo"), F.max("effect_direction").alias("hi"),
        F.max(F.when(strong, c("aggregation_weight"))).alias("w_s"), F.max("aggregation_weight").alias("w"),
        *[F.count_if(c("effect_direction") == d).alias(f"rows_{d}") for d in rules.DIRECTIONS],
        *[F.count_if(c("evidence_rank") == r).alias(f"rank_{r}") for r in rules.RANKS],
        any_(c("projection_status") == "needs_review").alias("any_review"), all_(c("rag_use") == "mechanistic_only").alias("all_mechanistic"),
        any_("requires_caveat").alias("any_caveat"), all_("causal_language_allowed").alias("all_causal"),
        any_(c("assertion_type").isin("association", "no_association")).alias("any_association"),
        *[F.max(f"{p}_display").alias(f"{p}_display") for p in ("exposure", "outcome")],
    )
    has = c("ab_rows") > 0
    lo, hi = F.when(has, c("lo_s")).otherwise(c("lo")), F.when(has, c("hi_s")).otherwise(c("hi"))
    weight = F.least(F.lit(1.0), F.when(has, c("w_s")).otherwise(c("w")))
    return unit.withColumns({"direction": F.when(lo == hi, lo).otherwise("mixed"), "weight": weight}).drop("lo_s", "hi_s", "lo", "hi", "w_s", "w")


def general_evidence(rows: DataFrame, build_id: str) -> DataFrame:
    """Consensus per group, of the projections that are not rejected. Their join with the registries brought the names to display."""
    units = votes(rows.filter("projection_status <> 'rejected'"))
    sums = [F.sum(x).alias(x) for x in ["ab_rows", "n_rows", *[f"rows_{d}" for d in rules.DIRECTIONS], *[f"rank_{r}" for r in rules.RANKS]]]
    groups = units.groupBy(*GROUP).agg(
        F.countDistinct(F.nullif("paper_id", F.lit(""))).alias("paper_count"), F.count("*").alias("study_count"), *sums,
        *[F.count_if(c("direction") == d).alias(f"votes_{d}") for d in rules.DIRECTIONS],
        *[F.sum(F.when(c("direction") == d, c("weight")).otherwise(0.0)).alias(f"support_{d}") for d in rules.DIRECTIONS],
        *[F.max(f"{p}_display").alias(f"{p}_display") for p in ("exposure", "outcome")],
        *[F.bool_or(x).alias(x) for x in ("any_review", "any_caveat", "any_association")], *[F.bool_and(x).alias(x) for x in ("all_mechanistic", "all_causal")],
    )
    counts = {d: c(f"votes_{d}") for d in rules.DIRECTIONS}
    g = groups.withColumn("dominant_direction", rules.dominant_direction(counts, c("study_count")))
    g = g.withColumn("consensus_level", rules.consensus_level(counts, c("paper_count"), c("study_count"), c("n_rows"), c("ab_rows"), c("dominant_direction")))
    g = g.withColumn("recommendation_use", rules.recommendation_use(c("consensus_level"), c("organism"), c("any_review"), c("all_mechanistic"), c("rank_A") > 0))
    g = g.withColumns({"requires_caveat": (c("recommendation_use") != "directly_usable") | c("any_caveat"), "causal_language_allowed": c("all_causal") & c("consensus_level").isin("moderate", "strong"), "status": F.when(c("any_review"), "needs_review").otherwise("active"), "build_id": F.lit(build_id)})
    g = g.withColumn("general_evidence_id", stable_id("general_evidence", c("build_id"), *map(c, GROUP)))
    label = lambda p: F.coalesce(f"{p}_display", f"{p}_id", F.lit("None"))
    g = g.withColumn("question", F.concat(F.lit("What is the evidence linking "), label("exposure"), F.lit(" to "), label("outcome"), F.lit("?")))
    return g.withColumns({
        "conclusion_claim": rules.conclusion(c("question"), c("dominant_direction"), c("consensus_level"), c("recommendation_use"), c("causal_language_allowed")),
        "caveats": rules.caveats(c("consensus_level"), c("recommendation_use"), c("any_association")),
    }).withColumnRenamed("n_rows", "evidence_count").drop("any_review", "any_caveat", "any_association", "all_mechanistic", "all_causal", "exposure_display", "outcome_display")


def in_groups(rows: DataFrame, general: DataFrame) -> DataFrame:
    """Accepted projections with their group's id and dominant direction. The id is that of the keys, null ones too, so one key joins them."""
    keyed = rows.filter("projection_status <> 'rejected'").withColumn("general_evidence_id", stable_id("general_evidence", c("build_id"), *map(c, GROUP)))
    return keyed.join(general.select("general_evidence_id", "dominant_direction"), "general_evidence_id")


def rank_order(rank: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, rules.RANKS)), rank) - 1, F.lit(9))


def representatives(joined: DataFrame, k: int = 5) -> DataFrame:
    """The k best projections of each group; Spark limits the window's groups before the shuffle."""
    w = Window.partitionBy("general_evidence_id").orderBy(rank_order(c("evidence_rank")), "projection_id")
    return joined.withColumn("position", F.row_number().over(w)).filter(c("position") <= k)


def support_edges(joined: DataFrame, chosen: DataFrame) -> DataFrame:
    """(general_evidence_id, projection_id, role) of the five roles, without collecting a group's ids."""
    direction, dominant = c("effect_direction"), c("dominant_direction")
    opposing = ~dominant.isin("mixed", "unclear") & (direction != dominant) & ~direction.isin("unclear", "mixed")
    roles = F.array_compact(F.array(F.when(direction == dominant, "supporting"), F.when(direction == "no_effect", "null"), F.when(opposing, "opposing"), F.when(direction == "mixed", "mixed")))
    edges = joined.select("general_evidence_id", "projection_id", F.explode(roles).alias("role"))
    return edges.unionByName(chosen.select("general_evidence_id", "projection_id", F.lit("representative").alias("role")))


def histogram(joined: DataFrame, column: str) -> DataFrame:
    """Open-key histogram: rows per group and value."""
    return joined.groupBy("general_evidence_id", c(column).alias("value")).agg(F.count("*").alias("n"))


def retrieval_export(general: DataFrame, rows: DataFrame) -> DataFrame:
    keep = (c("status") == "active") & (c("consensus_level") != "insufficient") & ~c("recommendation_use").isin("not_recommendable", "needs_review")
    docs = general.filter(keep).select(F.lit("general_evidence").alias("document_type"), c("general_evidence_id").alias("id"), F.to_json(F.struct("conclusion_claim", "consensus_level")).alias("payload"))
    good = c("evidence_rank").isin("A", "B") & (c("projection_status") == "accepted") & c("rag_use").isin("primary", "supporting")
    return docs.unionByName(rows.filter(good).select(F.lit("evidence_support").alias("document_type"), c("projection_id").alias("id"), F.to_json(F.struct("evidence_rank", "effect_direction")).alias("payload")))


def published_build_id(evidence: DataFrame, maps: DataFrame) -> str:
    """Build id of the items (id, item) and experiment maps (id, item), JSON texts: the hash over all of them in the order of their ids.

    The published id is one SHA-256 over one text, so it is read in order through the driver, a partition
    at a time and never held whole. For a large corpus give ``build`` an id of your own.
    """
    digest = hashlib.sha256(b"[")
    for k, rows in enumerate((evidence, maps)):
        digest.update(b"[" if k == 0 else b",[")
        ordered = rows.select(F.coalesce("id", F.lit("")).alias("id"), canonical_json(c("item")).alias("item")).orderBy("id", "item")
        for n, row in enumerate(ordered.toLocalIterator()):
            digest.update((b"," if n else b"") + row["item"].encode())
        digest.update(b"]")
    digest.update(b"]")
    return f"evidence_build_{digest.hexdigest()}"


def build(evidence: DataFrame, scopes: DataFrame, build_id: str, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """All tables of a derivation by name. ``keep`` writes a table and returns what to read on, so that none is made twice.

    Evidence (of all papers, with ``ordinal``) and scopes as for ``projections``. Empty evidence gives empty tables.
    """
    exposure_terms, outcome_terms = terms(evidence)
    exposures = keep("exposure_registry", registry(exposure_terms, "exposure", EXPOSURE_KINDS))
    outcomes = keep("outcome_registry", registry(outcome_terms, "outcome", OUTCOME_KINDS))
    rows = keep("evidence_projections", projections(evidence, scopes, exposures, outcomes, build_id))
    general = keep("general_evidence", general_evidence(rows, build_id))
    joined = in_groups(rows, bounded(general.select("general_evidence_id", "dominant_direction")))
    support = keep("general_evidence_support", support_edges(joined, representatives(joined)).withColumn("build_id", F.lit(build_id)))
    export = keep("retrieval_export", retrieval_export(general, rows).withColumn("build_id", F.lit(build_id)))
    return {"exposure_registry": exposures, "outcome_registry": outcomes, "evidence_projections": rows, "general_evidence": general, "general_evidence_support": support, "retrieval_export": export}
