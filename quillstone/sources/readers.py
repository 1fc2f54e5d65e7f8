"""Sources: JSONL, text lists, binary files, Parquet tables, Markdown folders."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions import text as T
from ..shipping import ship
from .moves import contents, listed

c = F.col


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, missing_ok: bool = False) -> DataFrame:
    """Strict scan: a line that is no object fails the job. A missing file is empty if allowed."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_lenient(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scan in which bad lines are skipped."""
    df = spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return df.filter("_corrupt is null").drop("_corrupt")


def read_json_documents(spark: SparkSession, folder: str, schema: str, glob: str = "*") -> DataFrame:
    """One JSON document per file at any depth, with its folder, by which siblings are joined. Files are listed and read by tasks.

    A list gives a row for each of its objects; what is no JSON, a row of nulls; an empty file, none.
    """
    kind = ArrayType(StructType.fromDDL(schema))
    files = contents(listed(spark, folder, glob, deep=True)).select("path", c("content").cast("string").alias("text")).filter(F.btrim("text", F.lit(" \t\r\n")) != "")
    rows = F.coalesce(F.from_json("text", kind), F.array(F.lit(None).cast(kind.elementType)))
    return files.select(F.explode(rows).alias("d"), "path").select("d.*", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))


def join_siblings(documents: DataFrame, siblings: DataFrame, columns: list[str]) -> DataFrame:
    """Documents with the columns of the sibling in the folder of the same name; null where there is none."""
    name = lambda df: F.regexp_extract(df["folder"], r"([^/]*)$", 1).alias("__name")
    other = siblings.select(name(siblings), *columns).dropDuplicates(["__name"])
    return documents.select(*[x for x in documents.columns if x not in columns], name(documents)).join(other, "__name", "left").drop("__name")


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) without blank lines and comments; pos orders the lines by file, by place of the split and within it."""
    pos = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select(pos.alias("pos"), F.trim("value").alias("line"))
    return lines.filter("line <> '' and not startswith(line, '#')")


def read_doi_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, doi) of plain or JSON lines, normalised, each DOI at its first place."""
    line = c("line")
    doi = F.when(line.startswith("{"), F.coalesce(F.get_json_object(line, "$.doi"), F.get_json_object(line, "$.source_metadata.doi"))).otherwise(line)
    rows = ordered_lines(spark, path).select("pos", T.normalize_doi(doi).alias("doi")).filter("doi is not null")
    return rows.groupBy("doi").agg(F.min("pos").alias("pos")).select("pos", "doi").orderBy("pos")


def load_seeds(spark: SparkSession, path: str, fallback: str) -> DataFrame:
    """The queue if its file exists, empty or not; else the fallback."""
    return read_doi_list(spark, path if exists(spark, path) else fallback)


def keyword_lines(spark: SparkSession, path: str) -> DataFrame:
    """(keyword, pos) of a dictionary: normalised, each at its first place; pos orders them."""
    rows = ordered_lines(spark, path).select("pos", T.keyword_text(c("line")).alias("keyword")).filter("keyword <> ''")
    return rows.groupBy("keyword").agg(F.min("pos").alias("pos"))


def read_keywords(spark: SparkSession, path: str) -> list[str]:
    """Normalised keywords in order, each once; an empty dictionary is an error. For one of any size take ``keyword_lines``."""
    words = [r.keyword for r in keyword_lines(spark, path).orderBy("pos").collect()]
    if not words:
        raise ValueError("the keyword dictionary is empty")
    return words


def unwrap_record(df: DataFrame) -> DataFrame:
    """The first of the columns metadata and source_metadata that is a struct, else the row itself."""
    for name in ("metadata", "source_metadata"):
        if name in df.columns:
            return df.select(f"{name}.*")
    return df


def known_ids(lake: DataFrame) -> DataFrame:
    names = lake.select(c("source_paper_id").alias("id")).union(lake.filter("doi is not null").select(T.base_name(c("doi"))))
    return names.filter("id is not null").distinct()


def list_files(spark: SparkSession, folder: str, glob: str, deep: bool = False) -> DataFrame:
    """(stem, path, content, hash) of a folder's files, with ``deep`` also of those under it. They are listed and read by tasks."""
    files = contents(listed(spark, folder, glob, deep))
    return files.select(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("stem"), "path", "content", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("hash"))


def status_index(log: DataFrame) -> DataFrame:
    """Last record per paper in file order, of those done or failed."""
    rows = log.groupBy("paper_id").agg(F.max_by(F.struct("status", "line"), "line").alias("r"))
    return rows.select("paper_id", "r.status").filter(c("status").isin("done", "failed"))


def point_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.filter(c(key) == value)


def lookup_clustered(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """Rows of one key of a table that ``sinks.write_clustered`` wrote: only files whose range holds it are opened, and Bloom filters skip their row groups."""
    files = [r.file for r in spark.read.parquet(f"{path}/ranges").filter((c("first") <= F.lit(value)) & (c("last") >= F.lit(value))).select("file").collect()]
    schema = spark.read.parquet(f"{path}/rows").schema
    return spark.read.schema(schema).parquet(*files).filter(c(key) == value) if files else spark.createDataFrame([], schema)


def ordered_ids(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    out = df.select(key).distinct().orderBy(key)
    return out if limit is None else out.limit(limit)


#: Tables that may be scanned or exported by name.
TABLES = ["structured_papers", "structured_blocks", "paper_classifications", "experiment_maps", "canonical_evidence", "exposure_registry", "outcome_registry", "evidence_projections", "general_evidence", "general_evidence_support", "paper_pipeline_state", "paper_processing_state"]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{folder}/{name}")


def resolve_identity(files: DataFrame, registry: DataFrame, lake: DataFrame) -> DataFrame:
    """Identity of base names: by DOI slug in the registry, then in the lake, then by document id."""
    f = files.withColumn("p", T.parse_base_name(c("stem"))).select("*", "p.*").drop("p")
    by_slug = registry.groupBy(T.slugify_doi(c("doi")).alias("slug")).agg(F.min("doi").alias("doi_registry"))
    in_lake = lake.filter("doi is not null").groupBy(T.slugify_doi(c("doi")).alias("slug")).agg(F.min("doi").alias("doi_lake"))
    by_id = registry.groupBy("document_id").agg(F.min("doi").alias("doi_document"))
    j = f.join(by_slug, "slug", "left").join(in_lake, "slug", "left").join(by_id, "document_id", "left")
    return j.withColumn("doi", F.coalesce("doi_registry", "doi_lake", "doi_document")).drop("doi_registry", "doi_lake", "doi_document")


def call_port(df: DataFrame, port: Callable[[dict], dict], ddl: str) -> DataFrame:
    """Each row through an external service: HTTP, a converter or a language model. A failure is a row with ``error``.

    ``port`` takes and gives plain dicts; tests give a deterministic one.
    """
    ship(df.sparkSession)
    names = [f.name for f in df.sparkSession.createDataFrame([], ddl).schema]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in it:
            out = []
            for row in frame.to_dict("records"):
                try:
                    out.append({**dict.fromkeys(names), **port(row), "error": None})
                except Exception as e:  # noqa: BLE001  the service's failure is data
                    out.append({**dict.fromkeys(names), **{k: v for k, v in row.items() if k in names}, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*names, "error"])

    return df.mapInPandas(run, f"{ddl}, error string")


#: Rows after which a frame of pages is passed on.
FRAME = 5_000


def read_paged(requests: DataFrame, fetch: Callable[[dict, int, int], list[dict]], ddl: str, size: int = 100) -> DataFrame:
    """All rows of a paged service for each request: ``fetch(request, offset, size)`` is called until a page is not full.

    The request's columns, limits of a filter among them, go to the service, which applies them. Rows leave in frames of some
    pages: requests with few rows share one.
    """
    ship(requests.sparkSession)
    names = [f.name for f in requests.sparkSession.createDataFrame([], ddl).schema]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[dict] = []
        for frame in it:
            for request in frame.to_dict("records"):
                offset, page = 0, None
                while page is None or len(page) == size:
                    page = fetch(request, offset, size)
                    offset += len(page)
                    out.extend({**request, **row} for row in page)
                    if len(out) >= FRAME:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        yield pd.DataFrame(out, columns=names)

    return requests.mapInPandas(run, ddl)


def call_port_in_order(df: DataFrame, key: str, order: str, port: Callable[[dict, dict | None], dict], ddl: str, done: DataFrame | None = None) -> DataFrame:
    """Rows of a key one after another, each with what the one before gave: batches that carry context.

    Rows are dealt by key, sorted, and streamed: a task holds one batch of rows and the last answer of one key. ``done`` are
    answers of a run that stopped (the columns of ``ddl``, with key and order): a key goes on after its last one.
    """
    spark = df.sparkSession
    ship(spark)
    names = [f.name for f in spark.createDataFrame([], ddl).schema]
    rows = df.withColumn("__before", F.lit(None).cast("string"))
    if done is not None:
        last = done.groupBy(key).agg(F.max_by(F.to_json(F.struct(*names)), order).alias("__before"), F.max(order).alias("__done"))
        rows = df.join(last, key, "left").filter(c("__done").isNull() | (c(order) > c("__done"))).drop("__done").select(*df.columns, "__before")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, before = None, None
        for frame in it:
            out = []
            for row in frame.to_dict("records"):
                mark = row.pop("__before")
                if before is None or row[key] != now and not (pd.isna(row[key]) and pd.isna(now)):
                    now, before = row[key], ({**dict.fromkeys(names), **json.loads(mark)} if isinstance(mark, str) else None)
                before = {**dict.fromkeys(names), **port(row, before)}
                out.append(before)
            yield pd.DataFrame(out, columns=names)

    return rows.repartition(c(key)).sortWithinPartitions(key, order).mapInPandas(run, ddl)


PROVIDER_SCHEMAS = {
    "unpaywall": "doi string, best_oa_location struct<url_for_pdf: string>, oa_locations array<struct<url_for_pdf: string>>",
    "europe_pmc": "resultList struct<result: array<struct<doi: string, fullTextUrlList: struct<fullTextUrl: array<struct<documentStyle: string, url: string>>>>>>",
    "core": "results array<struct<doi: string, identifiers: array<struct<type: string, identifier: string>>, downloadUrl: string>>",
}


def provider_urls(payloads: DataFrame) -> DataFrame:
    """PDF URL of each landed payload (doi, provider, payload), where its DOI is exactly the one asked for."""
    doi = T.normalize_doi(c("doi"))
    j = lambda name: F.from_json("payload", PROVIDER_SCHEMAS[name])
    u, e, k = j("unpaywall"), j("europe_pmc"), j("core")
    unpaywall = F.when(T.normalize_doi(u["doi"]).eqNullSafe(doi), T.best_pdf_url(u["best_oa_location"]["url_for_pdf"], F.transform(u["oa_locations"], lambda x: x["url_for_pdf"])))
    hit = F.filter(e["resultList"]["result"], lambda r: T.normalize_doi(r["doi"]) == doi)
    pdf = F.flatten(F.transform(hit, lambda r: F.filter(r["fullTextUrlList"]["fullTextUrl"], lambda x: x["documentStyle"] == "pdf")))
    same = lambda r: (T.normalize_doi(r["doi"]) == doi) | F.coalesce(F.exists(r["identifiers"], lambda x: T.normalize_doi(x["identifier"]) == doi), F.lit(False))
    core = F.get(F.filter(k["results"], lambda r: same(r)), 0)["downloadUrl"]
    url = F.when(c("provider") == "unpaywall", unpaywall).when(c("provider") == "europe_pmc", F.get(pdf, 0)["url"]).when(c("provider") == "core", core)
    return payloads.withColumn("url", T.safe_string(url))


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("n = 1").drop("n")
