"""Records around the lake: identifiers, refreshes, the artefact registry, runs, model payloads and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ..functions import rules
from ..functions import text as T
from .evidence import representatives
from .metadata import last_wins

c = F.col
DECISIONS = ["keep", "drop", "uncertain"]
CONCLUSION_STATUSES = ["active", "needs_review", "rejected"]


def author_names(authors: Column, kind: DataType) -> Column:
    """Names of an array of strings or of structs with a name, trimmed, blanks dropped; null counts as none."""
    named = isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)
    names = F.transform(authors, lambda a: T.safe_string(a["name"] if named else a))
    return F.coalesce(F.filter(names, lambda x: x.isNotNull()), F.array().cast("array<string>"))


def cleaned(value: Column, kind: DataType) -> Column:
    """Recitation marks removed from every string of a nested value, by its type."""
    if isinstance(kind, StringType):
        return T.recitation_clean(value)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: cleaned(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[cleaned(value[f.name], f.dataType).alias(f.name) for f in kind]))
    return value


def pruned_quality(quality: Column, kind: StructType) -> Column:
    """Quality without the flags of truncation and duplication; null when nothing is left."""
    left = [f.name for f in kind if f.name not in ("is_truncated", "is_duplicate")]
    if not left:
        return F.lit(None).cast("string")
    return F.when(F.coalesce(*[quality[n].cast("string") for n in left]).isNotNull(), F.struct(*[quality[n].alias(n) for n in left]))


def entries(records: DataFrame) -> DataFrame:
    """Identities of records (document_id, doi) that have a DOI, under the present name and the older one."""
    doc = F.coalesce(T.safe_string(c("document_id")), F.lit(""))
    r = records.select(doc.alias("document_id"), T.normalize_doi(c("doi")).alias("doi")).filter("doi is not null")
    older = F.when(c("document_id") != "", F.concat(c("document_id"), F.lit("__"), T.base_name(c("doi")))).otherwise("")
    return r.select("document_id", "doi", T.slugify_doi(c("doi")).alias("doi_slug"), T.base_name(c("doi")).alias("base_name"), older.alias("legacy_base_name"))


def file_stem(doi: Column, source_id: Column) -> Column:
    """Name of a paper's files: by DOI, else its id; null where it has neither."""
    return F.when(T.normalize_doi(doi).isNotNull(), T.base_name(doi)).otherwise(T.safe_string(source_id))


def identifiers(doi: Column, source_id: Column) -> Column:
    return F.array_compact(F.array(T.safe_string(source_id), F.when(T.normalize_doi(doi).isNotNull(), T.base_name(doi))))


def lookup(lake: DataFrame, metadata_id: str) -> DataFrame:
    """The row of an id; none is an error."""
    row = lake.filter(c("metadata_id") == metadata_id).limit(1)
    if row.isEmpty():
        raise LookupError(f"no metadata for {metadata_id}")
    return row


def complete(queue: DataFrame, completed: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(completed DOIs with the new ones, queue without any completed one)."""
    now = completed.select("doi").union(done.select(T.normalize_doi(c("doi")))).filter("doi is not null").distinct()
    return now, queue.join(now, "doi", "left_anti")


def screened(parents: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows to upsert for candidates (metadata_id, decision, ordinal) and their parents, which are kept; a later row wins.

    A decision outside the vocabulary counts as drop.
    """
    known = F.when(c("decision").isin(DECISIONS), c("decision")).otherwise("drop")
    both = parents.select("metadata_id", F.lit("keep").alias("decision"), "ordinal", F.lit(0).alias("step"))
    both = both.unionByName(candidates.select("metadata_id", known.alias("decision"), "ordinal", F.lit(1).alias("step")))
    return last_wins(both, ["metadata_id"], ["ordinal", "step"]).select("metadata_id", "decision")


def refreshed(records: DataFrame, fetched: DataFrame, now: str, on_missing: str = "keep") -> DataFrame:
    """Records rebuilt from what their DOIs fetched, with ``outcome``: refreshed, missing_doi, not_found or failed.

    ``fetched`` holds one row per DOI (doi, source_paper_id, title, error), where a DOI was asked for in vain
    without a paper id. A decision not made is uncertain; created_at stays.
    """
    got = fetched.select(T.normalize_doi(c("doi")).alias("doi"), c("source_paper_id").alias("new_id"), c("title").alias("new_title"), c("error"))
    j = records.withColumn("doi", T.normalize_doi(c("doi"))).join(got, "doi", "left")
    outcome = F.when(c("doi").isNull(), "missing_doi").when(c("error").isNotNull(), "failed").when(T.safe_string(c("new_id")).isNull(), "not_found").otherwise("refreshed")
    j = j.withColumn("outcome", outcome)
    fresh = c("outcome") == "refreshed"
    out = j.select(
        F.when(fresh, F.concat(F.lit("meta:s2:"), T.safe_string(c("new_id")))).otherwise(c("metadata_id")).alias("metadata_id"), "doi",
        F.coalesce(T.safe_string(F.when(fresh, c("new_title")).otherwise(c("title"))), F.lit("")).alias("title"),
        F.coalesce(F.nullif("decision", F.lit("")), F.lit("uncertain")).alias("decision"), F.coalesce(T.safe_string(c("created_at")), F.lit(now)).alias("created_at"), F.lit(now).alias("updated_at"), "outcome",
    )
    return out if on_missing == "keep" else out.filter("outcome = 'refreshed'")


def refresh_summary(refreshed_rows: DataFrame) -> DataFrame:
    kinds = ["refreshed", "missing_doi", "not_found", "failed"]
    return refreshed_rows.agg(F.count("*").alias("n_read"), *[F.count_if(c("outcome") == k).alias(k) for k in kinds])


def registry(rows: DataFrame) -> DataFrame:
    """Registry (doi, document_id, ordinal) as it is saved: the last row of each normalised DOI, in order of DOI and id."""
    keyed = rows.withColumn("key", T.normalize_doi(c("doi"))).filter("key is not null")
    return last_wins(keyed, ["key"], ["ordinal"]).drop("key").orderBy("doi", "document_id")


STAGES = {"metadata": ["metadata"], "pdf": ["pdf"], "docling": ["docling"], "heuristics": ["filtered", "final"], "evidence": ["evidence"], "completed": ["docling", "filtered", "final", "evidence"]}


def stage_status(names: DataFrame, files: DataFrame) -> DataFrame:
    """Flags per base name, of files (base_name, kind, mirrored).

    A name with a mirror (``names.has_mirror``) is judged by its mirrored files alone, except that metadata may stand in either.
    """
    used = (c("mirrored") == c("has_mirror")) | (c("kind") == "metadata")
    kinds = {k for parts in STAGES.values() for k in parts}
    j = names.join(files, "base_name", "left").withColumn("used", F.coalesce(used, F.lit(False)))
    found = j.groupBy("base_name").agg(*[F.bool_or(c("used") & F.coalesce(c("kind") == k, F.lit(False))).alias(f"f_{k}") for k in sorted(kinds)])
    every = lambda parts: F.expr(" and ".join(f"f_{k}" for k in parts))
    return found.select("base_name", *[every(parts).alias(stage) for stage, parts in STAGES.items()])


def workspace(selected: DataFrame, pdfs: DataFrame, markdown: DataFrame) -> DataFrame:
    """Papers to copy into a test workspace; reason is null for those that can be, else names the first file missing."""
    flag = lambda df, name: df.select("paper_id", F.lit(True).alias(name)).distinct()
    j = selected.join(flag(pdfs, "pdf"), "paper_id", "left").join(flag(markdown, "md"), "paper_id", "left")
    return j.select("paper_id", F.when(c("pdf").isNull(), "missing_pdf").when(c("md").isNull(), "missing_markdown").alias("reason"))


def require_all(found: DataFrame) -> DataFrame:
    """A workspace without skipped papers; the job fails on the first."""
    return found.filter(F.when(c("reason").isNotNull(), F.raise_error(F.concat("reason", F.lit(" of "), "paper_id"))).otherwise(F.lit(True)))


def failures(batches: DataFrame) -> DataFrame:
    """Failure records of batches whose port call gave an error."""
    return batches.filter("error is not null").select("paper_id", c("index").alias("batch_index"), "start_char", "end_char", F.regexp_extract("error", "^([A-Za-z_]+):", 1).alias("error_type"), F.regexp_replace("error", "^[A-Za-z_]+: ", "").alias("error"))


def failed_status(failed: DataFrame) -> DataFrame:
    """Status rows of failed papers, the description cut at 200 words."""
    words = F.split(T.clean_text(F.concat_ws(": ", "error_type", "error")), " ")
    return failed.select("paper_id", F.lit("failed").alias("status"), F.array_join(F.slice(words, 1, 200), " ").alias("error_description"))


def batch_debug(batches: DataFrame) -> DataFrame:
    return batches.select("paper_id", c("index").alias("batch_index"), "start_char", "end_char", F.length("text").cast("long").alias("chars"), "previous_section_path", "last_heading", "last_300_chars", "oversized_unit")


def finish(runs: DataFrame, finished: DataFrame) -> DataFrame:
    """Current row of each run, of its log of starts and ends (run_id, status, summary, ended_at, at)."""
    return last_wins(runs.unionByName(finished, allowMissingColumns=True), ["run_id"], ["at"])


def manifest(run: DataFrame) -> DataFrame:
    return run.select("run_id", F.to_json(F.struct(*sorted(run.columns)), {"ignoreNullFields": "false"}).alias("manifest"))


def wrapped(rows: DataFrame, record_type: str, key: str, producer_run_id: str | None = None) -> DataFrame:
    """Rows as stored: (record_type, record_id, producer_run_id, schema_version, payload)."""
    return rows.select(F.lit(record_type).alias("record_type"), c(key).cast("string").alias("record_id"), F.lit(producer_run_id or "unknown").alias("producer_run_id"), F.lit("v1").alias("schema_version"), json_text(rows).alias("payload"))


def json_text(rows: DataFrame) -> Column:
    """Row as JSON text, its fields in order of name, time stamps in ISO form."""
    return F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})


def batch_messages(batches: DataFrame, prompt: str) -> DataFrame:
    """User message of each Markdown batch: prompt, structural context, text."""
    context = F.to_json(F.struct("previous_section_path", "last_heading", "last_300_chars", "oversized_unit"), {"ignoreNullFields": "false"})
    content = F.concat(F.lit(f"{prompt}\n\n# BATCH STRUCTURAL CONTEXT\n\n"), context, F.lit("\n\n# MARKDOWN BATCH "), c("index").cast("string"), F.lit("\n\n"), c("text"))
    return batches.withColumn("message", content)


def input_message(prompt: str, **parts: Column) -> Column:
    """Message of a prompt and its input as JSON: blocks, metadata with blocks, or an experiment packet."""
    body = F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]), {"ignoreNullFields": "false"})
    return F.concat(F.lit(f"{prompt}\n\n# INPUT\n\n"), body)


def conclusion_payload(joined: DataFrame, k: int = 5) -> DataFrame:
    """Evidence that stands for each group in a conclusion prompt: its representatives of the ranks A to C, in order."""
    best = representatives(joined, k).filter(c("evidence_rank").isin("A", "B", "C"))
    return best.select("general_evidence_id", "position", "projection_id", "evidence_rank", "effect_direction")


ANSWER = "conclusion_claim string, plain_language_conclusion string, evidence_balance_summary string, recommendation_interpretation string, conclusion_caveats array<string>, conclusion_status string"


def apply_conclusions(general: DataFrame, answers: DataFrame) -> DataFrame:
    """Groups with a model's conclusion (general_evidence_id, answer JSON); blank parts keep the template's text.

    A status outside the vocabulary, or wording that the evidence does not carry, needs review. A group without an answer stays.
    """
    a = answers.select("general_evidence_id", F.from_json("answer", ANSWER).alias("a"))
    j = general.join(a, "general_evidence_id", "left")
    answered = c("a").isNotNull()
    texts = {n: F.coalesce(F.nullif(c(f"a.{n}"), F.lit("")), c(n)) for n in ("conclusion_claim", "plain_language_conclusion", "evidence_balance_summary")}
    j = j.withColumns({**texts, "recommendation_interpretation": F.when(answered, c("a.recommendation_interpretation")).otherwise(c("recommendation_interpretation")), "caveats": F.coalesce("a.conclusion_caveats", "caveats")})
    whole = F.concat_ws(" ", "conclusion_claim", "plain_language_conclusion", "evidence_balance_summary", "recommendation_interpretation")
    status = F.when(c("a.conclusion_status").isin(CONCLUSION_STATUSES) & (F.size(rules.conclusion_faults(whole)) == 0), c("a.conclusion_status")).otherwise("needs_review")
    return j.withColumns({"conclusion_status": F.when(answered, status).otherwise(c("conclusion_status")), "conclusion_generation_method": F.when(answered, "llm").otherwise("template")}).drop("a")


RESPONSE = "output array<struct<content: array<struct<text: string>>>>"


def response_text(response: Column) -> Column:
    """First text of a model's response that is not blank; null where there is none."""
    texts = F.flatten(F.transform(F.from_json(response, RESPONSE)["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<text: string>>"))))
    return F.get(F.filter(F.transform(texts, lambda x: x["text"]), lambda t: F.trim(t) != ""), 0)


def parsed_decisions(responses: DataFrame) -> DataFrame:
    """(batch, candidate_id, decision, reason) of responses (batch, response); ``metadata.decisions`` then checks them."""
    found = F.from_json(response_text(c("response")), "decisions array<struct<id: string, decision: string, reason: string>>")["decisions"]
    return responses.select("batch", F.inline(found)).withColumnRenamed("id", "candidate_id")


def attach_context(items: DataFrame, item_columns: list[str], packet_study: str = "packet_study_id", packet_scope: str = "packet_scope_id") -> DataFrame:
    """Extracted items with the study and scope of their packet, and an id where they bring none.

    Items hold paper_id, experiment_map_id, item_index, the packet's two ids and ``item_columns``. The id hashes
    paper, study, place and the whole item; nested fields must be declared in alphabetical order.
    """
    study = F.coalesce(F.nullif(c(packet_study), F.lit("")), F.nullif(c(packet_scope), F.lit("")), F.lit("unclear"))
    out = items.withColumn("study_id", study).withColumn("experiment_scope_id", F.coalesce(F.nullif(c(packet_scope), F.lit("")), c("study_id")))
    fields = sorted({*item_columns, "paper_id", "study_id", "experiment_map_id", "experiment_scope_id"} - {"canonical_evidence_id"})
    quoted = lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1)
    body = F.concat(F.lit('["canonical_evidence",'), quoted(c("paper_id")), F.lit(","), quoted(c("study_id")), F.lit(","), c("item_index").cast("string"), F.lit(","), F.to_json(F.struct(*fields)), F.lit("]"))
    own = F.concat(F.lit("canonical_evidence_"), F.sha2(body, 256))
    given = T.safe_string(c("canonical_evidence_id")) if "canonical_evidence_id" in items.columns else F.lit(None).cast("string")
    return out.withColumn("canonical_evidence_id", F.coalesce(given, own)).drop(packet_study, packet_scope, "item_index")
