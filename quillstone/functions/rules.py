"""Decision tables of evidence and of processing state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and thresholds of the published tables.
DIRECTIONS = ["increase", "decrease", "no_effect", "mixed", "unclear"]
RANKS = ["A", "B", "C", "D", "Reject"]
WEIGHTS = {"A": 1.0, "B": 0.6, "C": 0.25, "D": 0.0, "Reject": 0.0}
STRONG_DESIGNS = ["rct", "meta_analysis", "systematic_review", "prospective_cohort"]

c = F.col


def organism_of_design(design: Column) -> Column:
    return F.when(design == "animal_experiment", "animal").when(design == "in_vitro", "in_vitro").otherwise("unclear")


def is_one_of(x: Column, *values: str) -> Column:
    return F.coalesce(x.isin(*values), F.lit(False))


def ranking() -> Column:
    """Struct of rank, use, causal, caveat, reason and status, of a projection's columns.

    Reads has_grounding, exposure_id, outcome_id, effect_direction, canonical_evidence_status,
    evidence_role_in_paper, assertion_type, organism, study_design and has_quant.
    """

    def result(rank: str, use: str, reason: str, status: str = "accepted", causal: Column | None = None, caveat: Column | None = None) -> Column:
        no, yes = F.lit(False), F.lit(True)
        return F.struct(F.lit(rank).alias("evidence_rank"), F.lit(WEIGHTS[rank]).alias("aggregation_weight"), F.lit(use).alias("rag_use"), (no if causal is None else causal).alias("causal_language_allowed"), (yes if caveat is None else caveat).alias("requires_caveat"), (F.lit(reason)).alias("rank_reason"), F.lit(status).alias("projection_status"))

    role, assertion, organism = c("evidence_role_in_paper"), c("assertion_type"), c("organism")
    human = is_one_of(organism, "human")
    faults = F.concat_ws(
        "; ",
        F.when(~c("has_grounding"), "missing source grounding"),
        F.when(c("exposure_id").isNull() | c("outcome_id").isNull(), "unresolved exposure or outcome"),
        F.when(is_one_of(c("effect_direction"), "unclear", "not_applicable"), "unclear effect direction"),
        F.when(is_one_of(c("canonical_evidence_status"), "rejected"), "canonical evidence rejected"),
    )
    rejected = result("Reject", "reject", "", "rejected").withField("rank_reason", faults)
    primary = human & is_one_of(role, "primary_result") & is_one_of(c("study_design"), *STRONG_DESIGNS) & c("has_quant")
    causal = is_one_of(assertion, "causal_effect", "comparative_effect") & human
    caveat = is_one_of(role, "subgroup_result") | is_one_of(assertion, "association", "no_association", "mechanistic_link")
    return (
        F.when(faults != "", rejected)
        .when(is_one_of(role, "method_detail", "background_context", "limitation") | is_one_of(assertion, "methodological"), result("D", "audit_only", "method/background/limitation evidence"))
        .when(is_one_of(organism, "animal", "in_vitro") | is_one_of(role, "mechanistic_result", "descriptive_result") | is_one_of(assertion, "mechanistic_link"), result("C", "mechanistic_only", "mechanistic, descriptive, animal, or in vitro evidence"))
        .when(is_one_of(role, "secondary_result", "subgroup_result", "sensitivity_result"), result("B", "supporting", "human secondary/subgroup/sensitivity result"))
        .when(primary, result("A", "primary", "strong human primary evidence", causal=causal, caveat=caveat))
        .when(human, result("B", "supporting", "human evidence with caveat"))
        .otherwise(result("C", "supporting", "indirect or unclear-context evidence", "needs_review"))
    )


def dominant_direction(counts: dict[str, Column], studies: Column) -> Column:
    """The direction with at least 0.55 of the votes; below that, no order of ties matters."""
    top = F.greatest(*counts.values())
    name = F.coalesce(*[F.when(n == top, d) for d, n in counts.items()])
    return F.when(studies < 1, "unclear").when(top / studies < 0.55, "mixed").otherwise(name)


def consensus_level(counts: dict[str, Column], papers: Column, studies: Column, rows: Column, ab_rows: Column, dominant: Column) -> Column:
    share = sum((F.when(dominant == d, n).otherwise(0) for d, n in counts.items()), F.lit(0)) / studies
    against = sum((F.when((dominant != d) & F.lit(d != "unclear"), n).otherwise(0) for d, n in counts.items()), F.lit(0)) / studies
    return (
        F.when((papers < 2) | (studies < 2) | (dominant == "unclear"), "insufficient")
        .when((against > 0.30) | (share < 0.55), "mixed")
        .when((papers >= 8) & (studies >= 10) & (share >= 0.70) & (against <= 0.15) & (2 * ab_rows >= rows), "strong")
        .when((papers >= 4) & (studies >= 5), "moderate")
        .otherwise("weak")
    )


def recommendation_use(level: Column, organism: Column, any_review: Column, all_mechanistic: Column, any_a: Column) -> Column:
    return (
        F.when(any_review, "needs_review")
        .when(is_one_of(organism, "animal", "in_vitro") | all_mechanistic, "mechanistic_only")
        .when(level.isin("insufficient", "mixed"), "not_recommendable")
        .when(level.isin("moderate", "strong") & any_a, "directly_usable")
        .otherwise("usable_with_caveat")
    )


def caveats(level: Column, use: Column, any_association: Column) -> Column:
    return F.array_compact(
        F.array(
            F.when(level.isin("weak", "insufficient"), "Evidence is limited."),
            F.when(level == "mixed", "Evidence is conflicting."),
            F.when(use == "mechanistic_only", "Evidence is mechanistic or preclinical and not direct human recommendation evidence."),
            F.when(any_association, "Association evidence should not be interpreted as causal."),
        )
    )


def has_quantitative(comparator: Column, summary: Column, values: Column) -> Column:
    """Whether evidence compares or measures: a comparator, a summary or any values that are not empty."""
    return F.coalesce(F.length(comparator) > 0, F.lit(False)) | F.coalesce(F.length(summary) > 0, F.lit(False)) | F.coalesce(F.size(values) > 0, F.lit(False))


def conclusion(question: Column, dominant: Column, level: Column, use: Column, causal: Column) -> Column:
    tail = (
        F.when(level == "insufficient", "The available evidence is insufficient for a firm conclusion.")
        .when(level == "mixed", "The evidence is mixed, with conflicting findings across studies.")
        .when(use == "mechanistic_only", F.concat(F.lit("The evidence is mechanistic or preclinical and suggests "), dominant, F.lit(", not direct human recommendation evidence.")))
        .otherwise(F.concat(F.lit("The current evidence "), F.when(causal, "shows").otherwise("is associated with"), F.lit(" "), dominant, F.lit(" with "), level, F.lit(" consensus.")))
    )
    return F.concat(question, F.lit(" "), tail)


def conclusion_faults(text: Column) -> Column:
    """Wording that the evidence does not carry; reads causal_language_allowed and the group's labels."""
    t = F.lower(text)
    word = lambda *w: t.rlike(rf"\b({'|'.join(w)})\b")
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(c("causal_language_allowed"), F.lit(False)) & word("causes", "prevents", "cures", "reduces"), "causal wording is not allowed"),
            F.when((c("recommendation_use") == "mechanistic_only") & ~word("mechanistic", "preclinical", "animal", "in vitro"), "mechanistic-only conclusion must state evidence type"),
            F.when((c("consensus_level") == "insufficient") & word("clear", "strong", "supports", "shows"), "insufficient evidence conclusion sounds definitive"),
            F.when((c("dominant_direction") == "no_effect") & word("improvement", "worsening", "improves", "worsens"), "no-effect conclusion claims change"),
            F.when((c("consensus_level") == "mixed") & ~word("conflicting", "inconsistent", "mixed"), "mixed evidence conclusion must mention conflict"),
        )
    )


def processing_status() -> Column:
    """Struct of status columns, of a paper's facts; the first rule that holds decides."""

    def status(overall: str | Column, stage: str | Column, following: str | Column | None, last: str | None, processable: Column | None = None, complete: bool = False, blocked: Column | None = None, code: Column | None = None, message: Column | None = None) -> Column:
        text = lambda x: F.lit(x).cast("string") if x is None or isinstance(x, str) else x
        blocked = text(None) if blocked is None else blocked
        fields = {"overall_status": text(overall), "current_stage": text(stage), "last_successful_stage": text(last), "next_stage": text(following), "is_processable": F.lit(True) if processable is None else processable, "is_complete": F.lit(complete), "is_ready_for_export": F.lit(complete), "blocked_reason": blocked, "last_error_code": F.coalesce(text(None) if code is None else code, blocked), "last_error_message": F.coalesce(text(None) if message is None else message, blocked)}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    blocked = c("latest_pipeline_status") == "blocked"
    stage = F.coalesce(F.nullif(c("latest_pipeline_stage"), F.lit("")), F.lit("pipeline"))
    stopped = status(F.when(blocked, "blocked").otherwise("failed"), stage, F.when(~blocked, stage), None, ~blocked, False, F.when(blocked, c("last_error_code")), c("last_error_code"), c("last_error_message"))
    return (
        F.when(~c("has_pdf") & ~c("has_markdown"), status("blocked", "input.discovery", None, None, F.lit(False), False, F.lit("missing_pdf_and_markdown")))
        .when(~c("has_markdown"), status("pending", "pdf.markdown", "pdf.markdown", "pdf.available"))
        .when(~c("has_structured_paper"), status("pending", "pdf.process", "pdf.process", "pdf.markdown"))
        .when(is_one_of(c("latest_pipeline_status"), "failed", "blocked"), stopped)
        .when(~c("has_paper_classification"), status("pending", "classification.classify", "classification.classify", "pdf.process"))
        .when(~is_one_of(c("paper_family"), "primary_research"), status("succeeded", "classification.classify", None, "classification.classify", complete=True))
        .when(~c("has_structured_blocks"), status("pending", "pdf.process", "pdf.process", "pdf.markdown"))
        .when(~c("has_experiment_map"), status("pending", "evidence.map", "evidence.map", "classification.classify"))
        .when(~c("has_canonical_evidence"), status("pending", "evidence.extract", "evidence.extract", "evidence.map"))
        .otherwise(status("succeeded", "export.ready", None, "evidence.extract", complete=True))
    )
