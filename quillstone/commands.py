"""What a user runs daily, composed of the library's operators over one store. Services are ports: functions that the caller gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import ids
from .functions import text as T
from .operators import evidence as E
from .operators import metadata as D
from .operators import state as S
from .operators import store as O
from .sources import moves
from .sources import readers as R
from .sources import sinks
from .sources.sinks import kept, replay_outbox
from .sources.tables import Store

c = F.col
PAPER = "source_paper_id string, doi string, title string, year string, citation_count string, pdf_url string"


def open_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, O.TABLES)


def upsert_metadata(store: Store, records: DataFrame, overwrite: bool = True) -> DataFrame:
    """Put lake records (metadata_id, doi, created_at, ...) over those of their id or else DOI: (metadata_id, status), created, updated or skipped.

    A replaced record keeps its created_at; one that had another id under the same DOI goes. Without ``overwrite`` a record
    that is there by id or DOI is skipped. Of repeated records the last by DOI and title counts. ``records`` are read
    several times and must be the same each time: a table, or what expressions make of one. Matches are found on ids and DOIs
    alone, of the lake and of the records; whole records are moved once, into their buckets.
    """
    repeated = kept(records.groupBy("metadata_id").count().filter("count > 1").select("metadata_id"), "repeated")
    new = records
    if not repeated.isEmpty():
        last = D.last_wins(records.join(repeated, "metadata_id", "left_semi"), ["metadata_id"], ["doi", "title"])
        new = records.join(repeated, "metadata_id", "left_anti").unionByName(last)
    lake = store.read("paper_metadata")
    if lake is None:
        store.commit(store.upsert("paper_metadata", new, settled=True))
        return new.select("metadata_id", F.lit("created").alias("status"))
    held, asked = lake.select("metadata_id", "doi", "created_at"), new.select("metadata_id", "doi")
    by_id = held.select("metadata_id", c("created_at").alias("__by_id"), F.lit(True).alias("__same"))
    by_doi = held.filter("doi is not null").groupBy("doi").agg(F.min("created_at").alias("__by_doi"), F.lit(True).alias("__other"))
    own = asked.withColumn("__doi", F.coalesce("doi", F.concat(F.lit("\0"), "metadata_id")))  # records without a DOI match none, and stay apart
    matched = own.join(by_id, "metadata_id", "left").join(by_doi.withColumnRenamed("doi", "__doi"), "__doi", "left")
    found = kept(matched.select("metadata_id", F.coalesce("__by_id", "__by_doi").alias("__created"), (c("__same").isNotNull() | c("__other").isNotNull()).alias("__known")), "found")
    known = found.filter("__known")
    if overwrite:
        created = known.select("metadata_id", c("__created").alias("created_at"))
        moved = held.join(asked.filter("doi is not null").withColumnRenamed("metadata_id", "__new"), "doi").filter("metadata_id <> __new").select("metadata_id")
        store.commit(store.upsert("paper_metadata", new, gone=kept(moved, "moved"), settled=True, fill=created))
    else:
        store.commit(store.upsert("paper_metadata", new.join(known.select("metadata_id"), "metadata_id", "left_anti"), settled=True))
    return found.select("metadata_id", F.when(~c("__known"), "created").when(F.lit(overwrite), "updated").otherwise("skipped").alias("status"))


def metadata_from_dois(store: Store, dois: DataFrame, fetch: Callable[[dict], dict], at: str, overwrite: bool = False) -> DataFrame:
    """Fetch each DOI's paper, make it a kept seed record and put it into the lake: (doi, status, error).

    DOIs that the lake has are not asked for, unless ``overwrite``. ``fetch`` takes {"doi": ...} and gives the fields of PAPER; what it raises is the
    row's error. Unusable DOIs are invalid; a paper without title or id is failed.
    """
    asked = dois.select(T.normalize_doi(c("doi")).alias("doi"), c("doi").alias("given")).dropDuplicates(["doi", "given"])
    invalid = asked.filter("doi is null").select(c("given").alias("doi"), F.lit("invalid").alias("status"), F.lit("no DOI").alias("error"))
    due, lake = kept(asked.filter("doi is not null").select("doi").distinct(), "dois"), store.read("paper_metadata")
    have = due.limit(0) if lake is None or overwrite else due.join(lake.select("doi"), "doi", "left_semi")
    answers = kept(R.call_port(due.join(have, "doi", "left_anti"), lambda row: {**fetch(row), "doi": row["doi"]}, PAPER), "fetched")
    good = D.lake_records(answers.filter("error is null").withColumn("decision", F.lit("keep"))).withColumns({"is_seed": F.lit(True), "created_at": F.lit(at)})
    done = upsert_metadata(store, good, overwrite).join(good.select("metadata_id", "doi"), "metadata_id")
    failed = answers.join(done.select("doi"), "doi", "left_anti").select("doi", F.lit("failed").alias("status"), F.coalesce("error", F.lit("no title or id")).alias("error"))
    none = F.lit(None).cast("string").alias("error")
    return invalid.unionByName(have.select("doi", F.lit("skipped").alias("status"), none)).unionByName(failed).unionByName(done.select("doi", "status", none))


def derive(store: Store, evidence: DataFrame, scopes: DataFrame, build_id: str) -> int:
    """Derive all tables of a build and publish them at once; the store's version. A row that breaks a rule publishes nothing."""
    return O.publish(store, E.build(evidence, scopes, build_id, lambda name, df: kept(df, name)), build_id)


def derive_paper(evidence: DataFrame, scopes: DataFrame, paper_id: str, build_id: str, folder: str) -> list[str]:
    """Derive one paper by itself and write its artefacts beside its inputs in ``folder``: the paths.

    Evidence and scopes (of any papers) as for ``derive``; a paper without one of the two is an error, and nothing is
    written. ``general_evidence_artifacts.json`` holds a JSON line per row of each table, with the table's name, and
    ``rag_export.json`` the retrieval rows; each replaces that of an earlier run in one step.
    """
    own, maps = (kept(df.filter(c("paper_id") == paper_id), "paper") for df in (evidence, scopes))
    for rows, what in ((own, "evidence"), (maps, "experiment map")):
        if rows.isEmpty():
            raise FileNotFoundError(f"{paper_id} has no {what}")
    built = E.build(own, maps, build_id, lambda name, df: kept(df, name))
    line = lambda name: built[name].select(F.lit(name).alias("table"), F.to_json(F.struct(F.lit(name).alias("table"), *built[name].columns)).alias("line"))
    whole = lambda rows: rows.agg(F.array_join(F.array_sort(F.collect_list(F.struct("table", "line")))["line"], "\n").alias("content"))
    every = line("exposure_registry")
    for name in ("outcome_registry", "evidence_projections", "general_evidence", "general_evidence_support"):
        every = every.unionByName(line(name))
    files = {"general_evidence_artifacts.json": whole(every), "rag_export.json": whole(line("retrieval_export"))}
    paths = {f: f"{folder.rstrip('/')}/{f}" for f in files}
    for f, content in files.items():
        moves.write_files(content.select(F.lit(paths[f]).alias("path"), c("content").cast("binary").alias("content")))
    return list(paths.values())


def refresh_states(store: Store, files: DataFrame, updated_at) -> DataFrame:
    """Status of each paper that has a file (paper_id, has_pdf, has_markdown) or a row in the store, put into paper_processing_state; the rows."""
    spark = files.sparkSession
    latest = store.latest()[1]
    empty = {"paper_pipeline_state": "paper_id string, stage string, status string, error_code string, error_message string, updated_at timestamp", "paper_classifications": "paper_id string, paper_family string, updated_at timestamp"}

    def rows(name: str) -> DataFrame:
        found = store.read(name, latest)
        return spark.createDataFrame([], empty.get(name, "paper_id string")) if found is None else found

    tables = {"structured_paper": "structured_papers", "structured_blocks": "structured_blocks", "experiment_map": "experiment_maps", "canonical_evidence": "canonical_evidence"}
    facts = S.processing_facts(rows("paper_pipeline_state"), {k: rows(name) for k, name in tables.items()}, rows("paper_classifications"))
    out = kept(S.processing_state(files, facts).withColumn("updated_at", updated_at), "states")
    store.commit(store.upsert("paper_processing_state", out))
    return out


def replay(store: Store, outbox: DataFrame, schemas: dict[str, str], dry_run: bool = False) -> DataFrame:
    """Deliver the outbox rows (outbox_id, record_type, payload, attempt_count) into the tables that ``schemas`` names, and log them: the report.

    A record type is a table; its payload is JSON of the given columns. Rows that are in the log are skipped; a table whose rows break a rule fails as one.
    """
    log = store.read("delivered_outbox")
    seen = outbox.select("outbox_id").limit(0) if log is None else log
    put = lambda name: lambda df: store.commit(store.upsert(name, df.select(F.from_json("payload", schemas[name]).alias("r")).select("r.*").dropDuplicates(list(store.tables[name].key))))
    report = kept(replay_outbox(outbox, seen, {name: put(name) for name in schemas}, dry_run), "report")
    done = report.filter("outcome = 'delivered'").select("outbox_id").distinct()
    if not dry_run and not done.isEmpty():
        store.commit(store.upsert("delivered_outbox", done))
    return report


def write_sample_bundle(sample: DataFrame, evidence: DataFrame, pdf_dir: str, folder: str, created_at: str, seed: str | None = None) -> DataFrame:
    """Bundle of the sampled papers (paper_id) in ``folder``, for review by hand: the manifest.

    canonical_evidence.csv (nested values as JSON text) and canonical_evidence.json hold their rows of evidence, a row each, so that
    a paper of any size is never one row; pdfs/ their PDFs, copied from ``pdf_dir``; manifest.csv a row per paper with its rows of
    evidence and whether its PDF was there; sample_metadata.json the totals. A paper without evidence stays in the
    manifest; repeated papers and null ids go. The tables of an earlier bundle are replaced; its PDFs stay beside the new ones.
    """
    root = folder.rstrip("/")
    papers = kept(sample.select("paper_id").filter("paper_id is not null").distinct(), "sample")
    rows = kept(evidence.join(papers, "paper_id", "left_semi"), "evidence")
    sinks.flat(rows).write.mode("overwrite").option("header", True).csv(f"{root}/canonical_evidence.csv")
    rows.write.mode("overwrite").json(f"{root}/canonical_evidence.json")
    at = lambda where: F.concat(F.lit(where.rstrip("/") + "/"), "paper_id", F.lit(".pdf"))
    copied = kept(moves.copy_files(papers.select("paper_id", at(pdf_dir).alias("source"), at(f"{root}/pdfs").alias("target")), overwrite=True), "pdfs")
    counts = rows.groupBy("paper_id").agg(F.count("*").alias("evidence_rows"))
    have = c("outcome").isin("copied", "same")
    manifest = copied.join(counts, "paper_id", "left").select(
        "paper_id", F.coalesce("evidence_rows", F.lit(0)).alias("evidence_rows"), c("source").alias("source_pdf_path"), F.when(have, c("target")).otherwise("").alias("sample_pdf_path"), have.alias("pdf_copied"), (~have).alias("missing_pdf"),
    )
    manifest.write.mode("overwrite").option("header", True).csv(f"{root}/manifest.csv")
    totals = manifest.agg(F.count("*").alias("requested_papers"), F.coalesce(F.sum("evidence_rows"), F.lit(0)).alias("evidence_rows"))
    about = F.to_json(F.struct(F.lit(created_at).alias("created_at"), F.lit(seed).alias("seed"), "requested_papers", "evidence_rows", F.lit(root).alias("sample_dir"), F.lit(pdf_dir).alias("pdf_dir")), {"ignoreNullFields": "false"})
    moves.write_files(totals.select(F.lit(f"{root}/sample_metadata.json").alias("path"), about.cast("binary").alias("content")))
    return manifest


def link_pdfs(links: DataFrame, artifacts: str, linked_at: str, move: bool = False) -> DataFrame:
    """Copy or move each PDF (metadata_id, doi, source_pdf_path) to its place under ``artifacts``: the link rows with outcome and error.

    Only files whose first bytes are those of a PDF go; a place that holds another file is a conflict and stays.
    """
    rows = D.link_rows(links, linked_at)
    plan = rows.withColumns({"source": c("source_pdf_path"), "target": F.concat(F.lit(artifacts.rstrip("/") + "/"), ids.paper_id(c("metadata_id")), F.lit(".pdf"))})
    done = kept(moves.copy_files(plan, move=move, starts=b"%PDF-"), "links")
    return done.select(*rows.columns, "outcome", "sha256", "error")
