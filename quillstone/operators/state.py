"""Operational state: event folds, latest records, processing facts and status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules

c = F.col
TERMINAL = ["succeeded", "failed", "skipped"]


def events_to_states(events: DataFrame) -> DataFrame:
    """Event rows (attempt, paper_id, stage, status, event_type, message, event_at) as state rows."""
    status = F.when(c("status") == "started", "running").otherwise(c("status"))
    e = events.withColumn("status", status)
    failed = c("status") == "failed"
    return e.withColumns({"error_code": F.when(failed, c("event_type")), "error_message": F.when(failed, c("message")), "started_at": F.when(c("status") == "running", c("event_at")), "ended_at": F.when(c("status").isin(TERMINAL), c("event_at")), "updated_at": c("event_at")})


def stage_states(rows: DataFrame) -> DataFrame:
    failed = c("status") == "failed"
    return rows.withColumns({"error_code": F.when(failed, "stage_failed"), "error_message": c("error_summary"), "started_at": F.when(c("status") == "running", c("updated_at")), "ended_at": F.when(c("status").isin(*TERMINAL, "blocked"), c("updated_at"))})


def fold(states: DataFrame, keys: list[str], order: str = "updated_at") -> DataFrame:
    """What upserts in order leave: the last status and error, the last known artifact and end, the first known start.

    One aggregation with map-side combination; nothing is sorted. Of equal times the larger event_id is the later one.
    """
    name, at = order, c(order)
    if "event_id" in states.columns:
        states, order = states.withColumn("__at", F.struct(at, "event_id")), "__at"
    last = lambda x: F.max_by(x, order).alias(x)
    known = lambda x: F.max_by(F.when(c(x).isNotNull(), c(x)), F.when(c(x).isNotNull(), c(order))).alias(x)
    first = lambda x: F.min_by(F.when(c(x).isNotNull(), c(x)), F.when(c(x).isNotNull(), c(order))).alias(x)
    kinds = {"status": last, "stage": last, "error_code": last, "error_message": last, "artifact_path": known, "ended_at": known, "started_at": first}
    return states.groupBy(*keys).agg(*[f(x) for x, f in kinds.items() if x in states.columns and x not in keys], F.max(at).alias(name), F.count("*").alias("n_events"))


def merge_metadata(states: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Shallow merge of map<string,string> metadata: per key the last value wins."""
    pairs = states.select(*keys, order, F.explode("metadata").alias("k", "v")).groupBy(*keys, "k").agg(F.max_by("v", order).alias("v"))
    return pairs.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("metadata"))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order; of equal ones the largest row, so that the outcome does not hang on the plan."""
    others = [x for x in rows.columns if x not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct(F.struct(*order).alias("o"), F.struct(*others).alias("r")))["r"].alias("r")).select(*keys, "r.*")


def processing_facts(states: DataFrame, tables: dict[str, DataFrame], classifications: DataFrame) -> DataFrame:
    """Facts per paper of any table: flags of presence, latest classification, latest state.

    Presence is one union with a tag and one aggregation, in place of a join for each table.
    """
    tagged = [df.select("paper_id", F.lit(name).alias("tag")) for name, df in {**tables, "paper_classification": classifications, "state": states}.items()]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t)
    flags = union.groupBy("paper_id").agg(*[F.bool_or(c("tag") == n).alias(f"has_{n}") for n in [*tables, "paper_classification"]])
    family = classifications.groupBy("paper_id").agg(F.max_by("paper_family", F.struct("updated_at", "paper_family")).alias("paper_family"))
    told = F.struct("stage", "status", "error_code", "error_message")
    last = states.groupBy("paper_id").agg(F.max_by(told, F.struct("updated_at", "event_id") if "event_id" in states.columns else F.struct("updated_at", told)).alias("s"))
    out = flags.join(family, "paper_id", "left").join(last, "paper_id", "left")
    return out.select(*flags.columns, "paper_family", c("s.stage").alias("latest_pipeline_stage"), c("s.status").alias("latest_pipeline_status"), c("s.error_code").alias("last_error_code"), c("s.error_message").alias("last_error_message"))


FLAGS = ["has_pdf", "has_markdown", "has_structured_paper", "has_structured_blocks", "has_paper_classification", "has_experiment_map", "has_canonical_evidence"]


def processing_state(files: DataFrame, facts: DataFrame) -> DataFrame:
    """Status of each paper that has a file (paper_id, has_pdf, has_markdown) or a fact."""
    j = files.join(facts, "paper_id", "full_outer")
    j = j.withColumns({f: F.coalesce(c(f), F.lit(False)) if f in j.columns else F.lit(False) for f in FLAGS})
    errors = [x for x in ("last_error_code", "last_error_message") if x in j.columns]
    return j.withColumn("s", rules.processing_status()).drop(*errors).select("paper_id", *FLAGS, "paper_family", "latest_pipeline_stage", "latest_pipeline_status", "s.*")


def replay(outbox: DataFrame, delivered: DataFrame) -> DataFrame:
    """Outcome of each outbox row at a replay: skipped if delivered, failed if empty, else delivered; attempts count up."""
    seen = delivered.select("outbox_id", F.lit(True).alias("seen")).distinct()
    r = outbox.join(seen, "outbox_id", "left")
    empty = F.coalesce(c("payload"), F.lit("")).isin("", "{}")
    r = r.withColumn("outcome", F.when(c("seen"), "skipped").when(empty, "failed").otherwise("delivered"))
    return r.withColumn("attempt_count", c("attempt_count") + F.when(c("outcome") == "skipped", 0).otherwise(1)).drop("seen")
