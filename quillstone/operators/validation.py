"""Validators: each gives the rows with an array of errors, empty if they hold; ``strict`` makes a job fail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col

# The vocabularies of the records.
PAPER_FAMILIES = ["primary_research", "evidence_synthesis", "methodological", "case_based", "opinion_or_theory", "unknown"]
GENERATION_MODES = ["generates_original_data", "synthesizes_existing_evidence", "proposes_method", "reports_cases", "argues_or_interprets", "unclear"]
EVIDENCE_TYPES = ["between_group_result", "within_group_change", "dose_response", "time_course", "feasibility_result", "specificity_or_selectivity_result", "other", "unclear"]
OLD_TYPES = {"association": "other", "correlation": "other", "subgroup_result": "other", "mechanistic_result": "other", "null_result": "other", "adverse_effect": "other", "descriptive_result": "other"}
ORGANISMS = ["human", "animal", "in_vitro", "mixed", "unclear"]
DIRECTIONS = ["increase", "decrease", "no_effect", "mixed", "not_applicable", "unclear"]
OLD_DIRECTIONS = {"no_change": "no_effect", "positive_association": "increase", "negative_association": "decrease"}
STUDY_DESIGNS = ["rct", "prospective_cohort", "retrospective_cohort", "case_control", "cross_sectional", "meta_analysis", "systematic_review", "animal_experiment", "in_vitro", "mechanistic_experiment", "descriptive_microbiome", "method_validation", "unclear"]
STUDY_ROLES = ["main_study", "secondary_analysis", "subgroup_analysis", "sensitivity_analysis", "mechanistic_substudy", "external_meta_analysis", "method_validation", "unclear"]
EVIDENCE_ROLES = ["primary_result", "secondary_result", "subgroup_result", "sensitivity_result", "mechanistic_result", "descriptive_result", "adverse_event", "limitation", "method_detail", "background_context", "unclear"]
ASSERTIONS = ["causal_effect", "comparative_effect", "association", "no_association", "descriptive_comparison", "mechanistic_link", "methodological", "safety_signal", "unclear"]
STATUSES = ["accepted", "needs_review", "rejected"]
OBSERVATION_ROLES = ["primary_finding", "quantitative_support", "context_support", "limitation_or_caution"]
UNEXTRACTED_REASONS = ["background_only", "method_only", "unsupported_interpretation", "insufficient_context", "duplicate_finding_pattern", "not_scientific_finding", "unknown"]


def blank(x: Column) -> Column:
    return F.coalesce(F.trim(x.cast("string")), F.lit("")) == ""


def required(*names: str) -> list[Column]:
    return [F.when(blank(c(n)), f"{n} is required") for n in names]


def one_of(name: str, values: list[str], nullable: bool = False) -> Column:
    bad = c(name).isNotNull() & ~c(name).isin(values)
    return F.when(bad if nullable else bad | c(name).isNull(), F.concat(F.lit(f"{name} is invalid: "), F.coalesce(c(name), F.lit("null"))))


def with_errors(df: DataFrame, *checks: Column) -> DataFrame:
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def strict(df: DataFrame) -> DataFrame:
    """The rows without ``errors``; the job fails on the first row that has some."""
    return df.filter(F.when(F.size("errors") > 0, F.raise_error(F.array_join("errors", "; "))).otherwise(F.lit(True))).drop("errors")


def old_values(name: str, mapping: dict[str, str]) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for p in mapping.items() for x in p])[c(name)], c(name))


def normalise_evidence(items: DataFrame) -> DataFrame:
    """Old names of types and directions carried forward; role and assertion inferred where they are missing."""
    items = items.withColumns({"evidence_type": old_values("evidence_type", OLD_TYPES), "effect_direction": old_values("effect_direction", OLD_DIRECTIONS)})
    kind = c("evidence_type")
    role = F.when(kind == "specificity_or_selectivity_result", "mechanistic_result").when(kind == "feasibility_result", "secondary_result").otherwise("primary_result")
    assertion = F.when(c("effect_direction") == "no_effect", "no_association").when(kind == "specificity_or_selectivity_result", "mechanistic_link").when(kind == "between_group_result", "comparative_effect").otherwise("unclear")
    return items.withColumns({"evidence_role_in_paper": F.coalesce("evidence_role_in_paper", role), "assertion_type": F.coalesce("assertion_type", assertion), "canonical_evidence_status": F.coalesce("canonical_evidence_status", F.lit("accepted"))})


def classification(df: DataFrame) -> DataFrame:
    confidence = F.when(~c("classification_confidence").between(0, 1) | c("classification_confidence").isNull(), "classification_confidence must lie in 0 to 1")
    return with_errors(df, *required("paper_id", "paper_type"), one_of("paper_family", PAPER_FAMILIES), one_of("evidence_generation_mode", GENERATION_MODES), confidence)


def experiment_scopes(df: DataFrame) -> DataFrame:
    """Scopes, with study ids filled as study_<n>; ids of blocks are checked by ``blocks.unknown_block_ids``."""
    filled = df.withColumn("study_id", F.coalesce(F.nullif(F.trim("study_id"), F.lit("")), F.concat(F.lit("study_"), c("ordinal") + 1)))
    return with_errors(filled, one_of("study_design", STUDY_DESIGNS), one_of("study_role_in_paper", STUDY_ROLES), F.when(F.size(F.coalesce("source_block_ids", F.array().cast("array<string>"))) == 0, "source_block_ids is empty"))


def evidence(df: DataFrame, known_blocks: str | None = None) -> DataFrame:
    """Canonical evidence; ``known_blocks`` names an array column with the packet's block ids."""
    o = F.coalesce("observations", F.array().cast(df.schema["observations"].dataType))
    checks = [
        *required("evidence_text"), one_of("evidence_type", EVIDENCE_TYPES), one_of("effect_direction", DIRECTIONS), one_of("organism", ORGANISMS, nullable=True), one_of("evidence_role_in_paper", EVIDENCE_ROLES),
        one_of("assertion_type", ASSERTIONS), one_of("canonical_evidence_status", STATUSES), F.when(F.size(o) == 0, "observations is empty"),
        F.when(F.exists(o, lambda x: blank(x["source_quote"])), "source_quote is blank"), F.when(F.exists(o, lambda x: ~F.coalesce(x["observation_role"], F.lit("")).isin(OBSERVATION_ROLES)), "observation_role is invalid"),
    ]
    if known_blocks:
        unknown = F.array_except(F.transform(o, lambda x: x["source_block_id"]), F.col(known_blocks))
        checks.append(F.when(F.size(unknown) > 0, F.concat(F.lit("unknown source blocks: "), F.array_join(unknown, ","))))
    return with_errors(df, *checks)


def block_input(df: DataFrame, allowed: list[str] | None = None, excluded: list[str] = ()) -> DataFrame:
    checks = [*required("block_id", "section_type", "content_kind", "text")]
    if allowed:
        checks.append(one_of("section_type", allowed))
    checks.append(F.when(c("section_type").isin(list(excluded)), "section_type is excluded"))
    return with_errors(df, *checks)


def operational(df: DataFrame, enums: dict[str, list[str]], needed: list[str], positive: list[str] = ()) -> DataFrame:
    """Run, event, artifact, stage-state and outbox records: required fields, vocabularies, counts of at least 1."""
    return with_errors(df, *required(*needed), *[one_of(k, v) for k, v in enums.items()], *[F.when(F.coalesce(c(n), F.lit(0)) < 1, f"{n} must be at least 1") for n in positive])


def one_build(df: DataFrame, build_id: str) -> DataFrame:
    return with_errors(df, F.when(~c("build_id").eqNullSafe(F.lit(build_id)), "build_id differs"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti")
