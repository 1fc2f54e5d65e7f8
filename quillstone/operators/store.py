"""Records as the store's typed rows: keys, derived ids, rules and nulls of each table. ``tables.Store`` keeps them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as T
from ..sources.sinks import kept
from ..sources.tables import Store, Table

c = F.col
#: Roles of a support edge and statuses of a stage, as the tables' checks have them.
SUPPORT_ROLES = ["supporting", "null", "opposing", "mixed", "representative"]
STAGE_STATUSES = ["pending", "running", "succeeded", "failed", "skipped", "blocked", "warning"]


def one_of(column: str, values: list[str]) -> dict[str, str]:
    return {f"{column} is none of its values": f"{column} IN ({', '.join(map(repr, values))})"}


#: The store's tables and the rules of their rows.
TABLES = {
    "paper_metadata": Table(("metadata_id",)),
    "delivered_outbox": Table(("outbox_id",), grows=True),
    "structured_papers": Table(("paper_id",)),
    "structured_blocks": Table(("block_id",), required=("paper_id",)),
    "paper_classifications": Table(("paper_id", "pipeline_run_id")),
    "experiment_maps": Table(("experiment_map_id",), required=("paper_id",)),
    "canonical_evidence": Table(("canonical_evidence_id",), required=("paper_id", "study_id")),
    "paper_processing_state": Table(("paper_id",)),
    "paper_pipeline_state": Table(("paper_id", "stage", "attempt"), required=("status",), checks=one_of("status", STAGE_STATUSES)),
    "exposure_registry": Table(("exposure_id",), required=("canonical_name",), unique=("canonical_name",)),
    "outcome_registry": Table(("outcome_id",), required=("canonical_name",), unique=("canonical_name",)),
    "evidence_projections": Table(("projection_id",), part="build_id", required=("canonical_evidence_id", "paper_id", "effect_direction", "evidence_rank")),
    "general_evidence": Table(("general_evidence_id",), part="build_id", required=("dominant_direction", "consensus_level"), checks={"counts are not negative": "paper_count >= 0 AND study_count >= 0 AND evidence_count >= 0"}),
    "general_evidence_support": Table(
        ("general_evidence_id", "projection_id", "role"), part="build_id", checks=one_of("role", SUPPORT_ROLES),
        refers={"general_evidence_id": ("general_evidence", "general_evidence_id"), "projection_id": ("evidence_projections", "projection_id")},
    ),
    "retrieval_export": Table(("document_type", "id"), part="build_id"),
}


def payload(rows: DataFrame, *without: str) -> Column:
    """The row as JSON text, fields in order of name, without some."""
    return F.to_json(F.struct(*sorted(x for x in rows.columns if x not in without)), {"ignoreNullFields": "false"})


def run_id(rows: DataFrame) -> Column:
    return F.coalesce(T.safe_string(c("pipeline_run_id")), F.lit("unknown")) if "pipeline_run_id" in rows.columns else F.lit("unknown")


def structured_papers(papers: DataFrame, updated_at: Column) -> DataFrame:
    """(paper_id, payload, updated_at); the paper's source PDF is not stored. Papers without an id go."""
    rows = papers.withColumn("paper_id", T.safe_string(c("paper_id"))).filter("paper_id is not null")
    return rows.select("paper_id", payload(rows, "source_pdf").alias("payload"), updated_at.alias("updated_at"))


def structured_blocks(papers: DataFrame, updated_at: Column) -> DataFrame:
    """One row per block of (paper_id, blocks): typed columns and the whole block as payload. Blocks without an id go."""
    each = papers.select("paper_id", F.posexplode("blocks").alias("pos", "b")).filter("b is not null and trim(b.block_id) <> ''")
    typed = [F.coalesce(T.safe_string(c(f"b.{x}")), F.lit("unknown")).alias(x) for x in ("section_type", "content_kind")]
    return each.select(c("b.block_id").alias("block_id"), "paper_id", F.coalesce(c("b.order").cast("int"), c("pos")).alias("block_order"), *typed, F.coalesce(c("b.text"), F.lit("")).alias("text"), F.to_json("b").alias("payload"), updated_at.alias("updated_at"))


def classifications(rows: DataFrame, updated_at: Column) -> DataFrame:
    """Keyed by paper and run; a run that is not named is 'unknown'."""
    return rows.select("paper_id", run_id(rows).alias("pipeline_run_id"), "paper_family", payload(rows).alias("payload"), updated_at.alias("updated_at"))


def experiment_maps(rows: DataFrame, updated_at: Column) -> DataFrame:
    """Maps (paper_id, experiment_scopes, unmapped_block_ids), with the id of their contents where they bring none."""
    own = ids.map_id(c("paper_id"), c("experiment_scopes"), c("unmapped_block_ids"))
    given = T.safe_string(c("experiment_map_id")) if "experiment_map_id" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.coalesce(given, own).alias("experiment_map_id"), "paper_id", payload(rows).alias("payload"), updated_at.alias("updated_at"))


def canonical_evidence(rows: DataFrame, updated_at: Column) -> DataFrame:
    """Evidence with the id of its paper, study and contents where it brings none; missing labels are 'unclear'."""
    own = ids.stable_id("canonical_evidence", c("paper_id"), c("study_id"), payload(rows, "canonical_evidence_id"))
    label = [F.coalesce(T.safe_string(c(x)), F.lit("unclear")).alias(x) for x in ("evidence_type", "effect_direction")]
    return rows.select(F.coalesce(T.safe_string(c("canonical_evidence_id")), own).alias("canonical_evidence_id"), "paper_id", "study_id", *label, payload(rows).alias("payload"), updated_at.alias("updated_at"))


def primary_research(rows: DataFrame, latest_classification: DataFrame) -> DataFrame:
    """Rows of papers whose classification is primary research; all other papers stop here with no row."""
    primary = latest_classification.filter("paper_family = 'primary_research'").select("paper_id").distinct()
    return rows.join(primary, "paper_id", "left_semi")


def staging(store: Store, build_id: str) -> Callable[[str, DataFrame], DataFrame]:
    """A ``keep`` for ``evidence.build``: tables of parts are written into the store, once, where ``publish`` names them; registries, which are upserted, aside."""
    return lambda name, df: store.staged(name, df, [build_id]) if store.tables[name].part else kept(df, name)


def publish(store, tables: dict[str, DataFrame], build_id: str) -> int:
    """Replace one build in the given tables at once: registries are upserted by id, of the others the build's rows are replaced.

    Other tables, and other builds of these, stay as they are. A row that breaks a rule leaves the store as it was.
    """
    return store.commit(*[store.replace(name, rows, [build_id]) if store.tables[name].part else store.upsert(name, rows) for name, rows in tables.items()])
