"""Metadata lake: normalise, upsert, seeds, candidates, links, bibliography."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import ids
from ..functions import text as T
from ..shipping import ship
from ..sources import sinks

c = F.col


def lake_records(papers: DataFrame) -> DataFrame:
    """API papers as lake rows; those without an id or a title go."""
    r = papers.select(
        ids.metadata_id(T.safe_string(c("source_paper_id")), T.normalize_doi(c("doi"))).alias("metadata_id"), T.normalize_doi(c("doi")).alias("doi"), T.safe_string(c("title")).alias("title"),
        T.safe_int(c("year")).alias("year"), T.safe_int(c("citation_count")).alias("citation_count"), T.safe_string(c("pdf_url")).alias("pdf_url"), "decision",
    )
    return r.filter("metadata_id is not null and title is not null")


def citation_filter(papers: DataFrame, min_citations: int, min_year: int) -> DataFrame:
    return papers.filter((F.coalesce("citation_count", F.lit(0)) >= min_citations) & (F.coalesce("year", F.lit(0)) >= min_year) & c("metadata_id").isNotNull())


def upsert(lake: DataFrame, new: DataFrame, overwrite: bool = True) -> DataFrame:
    """Lake after an upsert by metadata_id or else DOI; a replaced row keeps its created_at.

    Two hash joins, one per key, take the place of a join on 'either key'; null DOIs never match.
    """
    if not overwrite:
        fresh = new.join(lake.select("metadata_id"), "metadata_id", "left_anti")
        return lake.unionByName(fresh.join(lake.filter("doi is not null").select("doi"), "doi", "left_anti").select(*lake.columns))
    by_id = lake.select("metadata_id", c("created_at").alias("created_by_id"))
    by_doi = lake.filter("doi is not null").groupBy("doi").agg(F.min("created_at").alias("created_by_doi"))
    merged = new.join(by_id, "metadata_id", "left").join(by_doi, "doi", "left").withColumn("created_at", F.coalesce("created_by_id", "created_by_doi", "created_at")).select(*lake.columns)
    kept = lake.join(new.select("metadata_id"), "metadata_id", "left_anti").join(new.filter("doi is not null").select("doi"), "doi", "left_anti")
    return kept.select(*lake.columns).unionByName(merged)


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: what a sequence of upserts leaves. Aggregates on the map side, without a window."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(whole, F.struct(*order)).alias("r")).select("r.*")


def should_keep(decision: Column) -> Column:
    return decision.isNull() | (F.lower(F.trim(decision)) == "keep")


def seed_candidates(lake: DataFrame, keywords: list[str], min_citations: int, explored: DataFrame | None = None, limit: int = 200) -> DataFrame:
    """Top unexplored seeds by citations, title and DOI, with the keywords that their titles and abstracts match."""
    words = [" ".join(k.lower().split()) for k in keywords]
    rows = lake.filter((F.coalesce("citation_count", F.lit(0)) >= min_citations) & c("doi").isNotNull() & c("title").isNotNull())
    if explored is not None:
        rows = rows.join(explored.select("doi"), "doi", "left_anti")
    whole = F.concat_ws("\n", *[c(x) for x in ("title", "abstract") if x in lake.columns])
    m = rows.withColumn("normalised", T.keyword_text(whole)).withColumn("matched_keywords", T.matched_keywords(c("normalised"), list(dict.fromkeys(words)))).filter(F.size("matched_keywords") > 0)
    return m.orderBy(c("citation_count").desc(), F.lower("title"), "doi").limit(limit).select("doi", "title", "citation_count", "matched_keywords")


def _matcher(patterns):
    """Adds to ``found`` the (place, keyword) of the patterns that a batch's texts hold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        words, automaton = patterns.value, ahocorasick.Automaton()
        for n, (keyword, _) in enumerate(words):
            automaton.add_word(keyword if " " in keyword else f" {keyword}", n)
        automaton.make_automaton()
        for whole in it:
            at = whole.schema.get_field_index("__found")
            kind = whole.column(at).type
            entries = [pa.array([w[1] for w in words], kind.value_type.field("place").type), pa.array([w[0] for w in words], kind.value_type.field("keyword").type)]
            every = pa.StructArray.from_arrays(entries, fields=[kind.value_type.field(k) for k in range(2)])
            for start in range(0, whole.num_rows, MATCH_ROWS):  # what a text matches may be far larger than the text
                b = whole.slice(start, MATCH_ROWS)
                hits = [sorted({n for _, n in automaton.iter(f" {t}")}) if t else [] for t in b.column("__text").to_pylist()]
                ends = list(accumulate(map(len, hits), initial=0))
                found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), every.take(pa.array([n for own in hits for n in own], pa.int64())))
                if len(b.column(at).flatten()):  # of the blocks before
                    found = pa.array([[*o, *n] for o, n in zip(b.column(at).to_pylist(), found.to_pylist())], kind)
                yield pa.RecordBatch.from_arrays([found.cast(kind) if k == at else x for k, x in enumerate(b.columns)], names=b.schema.names)

    return run


#: Texts of a batch whose matches are passed on together.
MATCH_ROWS = 100
#: Keywords of one automaton; more are matched in blocks, one after the other.
KEYWORD_BLOCK = 200_000


def match_keywords(rows: DataFrame, keywords: DataFrame, text: str = "normalised") -> DataFrame:
    """The rows with matched_keywords, in order of place: of a table (keyword, place) those in a column of normalised text.

    As ``matched_keywords``: a phrase as a substring, a word as the beginning of a token. One automaton over all keywords of a block
    reads each text once, whatever their number. Blank keywords match nothing, repeated ones count once at their first place.
    """
    spark = rows.sparkSession
    ship(spark)
    T.bound_batches(spark)
    words = sinks.kept(keywords.filter("trim(keyword) <> ''").groupBy("keyword").agg(F.min("place").alias("place")), "keywords")
    kind = words.schema["place"].dataType.simpleString()
    blocks = -(-words.count() // KEYWORD_BLOCK)
    out = rows.withColumns({"__text": c(text), "__found": F.array().cast(f"array<struct<place: {kind}, keyword: string>>")})
    for k in range(blocks):
        own = spark.sparkContext.broadcast([tuple(r) for r in words.filter(F.pmod(F.xxhash64("keyword"), F.lit(blocks)) == k).select("keyword", "place").collect()])
        out = out.mapInArrow(_matcher(own), out.schema)
        out = out if blocks == 1 else sinks.kept(out, "matched")
    return out.withColumn("matched_keywords", F.transform(F.array_sort("__found"), lambda x: x["keyword"])).drop("__text", "__found")


def missing_pdfs(lake: DataFrame, links: DataFrame) -> DataFrame:
    """Lake rows to keep without a link by metadata_id or by DOI: two anti-joins, in which null never matches."""
    rows = lake.filter(should_keep(c("decision"))).join(links.select("metadata_id"), "metadata_id", "left_anti")
    rows = rows.join(links.filter("doi is not null").select("doi").distinct(), "doi", "left_anti")
    return rows.select("metadata_id", ids.paper_id(c("metadata_id")).alias("paper_id"), "doi", "title", F.lit("no_matching_record_in_paper_pdf_links").alias("reason"))


def pending(queue: DataFrame, completed: DataFrame) -> DataFrame:
    """Queue without what is completed, in order."""
    return queue.join(completed.select("doi").distinct(), "doi", "left_anti").orderBy("pos")


def backfill_links(artifacts: DataFrame, legacy: DataFrame, lake: DataFrame) -> DataFrame:
    """Links for artifacts, over the last legacy link of the paper and the first lake row of its DOI; unmatched ones have no metadata_id."""
    last = legacy.groupBy("paper_id").agg(F.max_by("doi", "ordinal").alias("doi"))
    first = lake.filter("doi is not null").groupBy("doi").agg(F.min("metadata_id").alias("metadata_id"))
    return artifacts.join(last, "paper_id", "left").join(first, "doi", "left").select("paper_id", "doi", "metadata_id", c("metadata_id").isNotNull().alias("linked"))


def link_rows(artifacts: DataFrame, linked_at: str) -> DataFrame:
    return artifacts.select("metadata_id", ids.paper_id(c("metadata_id")).alias("paper_id"), "doi", "source_pdf_path", F.concat(F.lit("artifacts/pdfs/"), ids.paper_id(c("metadata_id")), F.lit(".pdf")).alias("artifact_pdf_path"), F.lit("manual").alias("link_method"), F.lit(linked_at).alias("linked_at"))


def bibliography(lake: DataFrame) -> DataFrame:
    """BibTeX entries of kept rows with a DOI; a key that is taken gets _1, _2 and so on, in order, until one is free."""
    rows = lake.filter((c("decision") == "keep") & c("doi").isNotNull()).select("metadata_id", "doi", T.citekey(c("metadata_id")).alias("base"))
    keyed = citekeys(rows)
    return keyed.select("metadata_id", "citekey", F.concat(F.lit("@article{"), "citekey", F.lit(",\n  doi = {"), "doi", F.lit("}\n}")).alias("entry"), "base")


def citekeys(rows: DataFrame) -> DataFrame:
    """Adds citekey to (metadata_id, base, ...). Only keys that are given twice, and those that look like one of their
    successors, depend on each other: each such family is dealt in order by one task, all others keep their key."""
    twice = rows.groupBy("base").count().filter("count > 1").select(c("base").alias("family"))
    stems = F.transform(F.sequence(F.lit(0), F.size(F.split("base", "_")) - 1), lambda k: F.array_join(F.slice(F.split("base", "_"), 1, F.size(F.split("base", "_")) - k), "_"))
    numbered = F.filter(stems, lambda x: F.substr(c("base"), F.length(x) + 1).rlike(r"^(_\d+)*$"))
    near = rows.select("base", F.explode(numbered).alias("family")).distinct().join(twice, "family").groupBy("base").agg(F.min_by("family", F.length("family")).alias("family"))
    names = rows.columns

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("metadata_id", kind="stable")
        used, following, keys = set(), {}, []
        for base in group["base"]:
            key, n = base, following.get(base, 0)
            while key in used:
                n += 1
                key = f"{base}_{n}"
            following[base] = n
            used.add(key)
            keys.append(key)
        return group[names].assign(citekey=keys)

    schema = StructType([*rows.schema.fields, StructField("citekey", StringType())])
    tied = rows.join(near, "base").groupBy("family").applyInPandas(deal, schema)
    return tied.unionByName(rows.join(near.select("base"), "base", "left_anti").select(*names, c("base").alias("citekey")))


def decisions(candidates: DataFrame, found: DataFrame, order: str | None = None) -> DataFrame:
    """Decision of each candidate; unknown ids and values are dropped, missing ones are 'uncertain'; only 'drop' discards.

    Of repeated decisions the last in ``order`` counts; without an order the smallest, so that it does not hang on the plan.
    """
    valid = found.filter(c("decision").isin("keep", "drop", "uncertain")).groupBy("candidate_id")
    valid = valid.agg((F.max_by("decision", order) if order else F.min("decision")).alias("decision"))
    j = candidates.join(valid, "candidate_id", "left").withColumn("decision", F.coalesce("decision", F.lit("uncertain")))
    return j.withColumn("discarded", c("decision") == "drop")


def candidate_batches(papers: DataFrame, seed: str, order: str, size: int = 20) -> DataFrame:
    """Candidates numbered in batches, which begin anew with each seed."""
    n = F.row_number().over(Window.partitionBy(seed).orderBy(order)) - 1
    return papers.withColumns({"batch": F.floor(n / size), "candidate_id": F.format_string("cand_%03d", n % size + 1)})


def resolve_attempts(attempts: DataFrame) -> DataFrame:
    """Outcome per paper of its attempts in resolver order: the first download, else the first URL, else not found."""
    a = attempts.groupBy("metadata_id").agg(F.min(F.when(c("downloaded"), F.struct("rank", "source", "url"))).alias("d"), F.min(F.when(c("url").isNotNull(), F.struct("rank", "source", "url"))).alias("u"))
    return a.select("metadata_id", F.when(c("d").isNotNull(), "downloaded").when(c("u").isNotNull(), "url_only").otherwise("not_found").alias("resolution_status"), F.coalesce("d.source", "u.source").alias("source"), F.coalesce("d.url", "u.url").alias("url"))


def retry_set(candidates: DataFrame, statuses: DataFrame, mode: str = "none") -> DataFrame:
    """Candidates left to check: 'none' skips all checked ones, 'without_url' those with a URL, 'all' skips none."""
    done = {"none": statuses, "without_url": statuses.filter("url is not null"), "all": statuses.limit(0)}[mode]
    return candidates.join(done.select("metadata_id").distinct(), "metadata_id", "left_anti")


def seeded_sample(papers: DataFrame, seed: str, n: int) -> DataFrame:
    """n papers in an order that the seed decides; the k least of a hash, without a full sort."""
    return papers.select("paper_id").distinct().orderBy(F.md5(F.concat("paper_id", F.lit(seed)).cast("binary"))).limit(n)


def migration_plan(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per file name: copy, same, conflict (contents differ) or only_new, of two listings (name, hash)."""
    j = old.select("name", c("hash").alias("old_hash")).join(new.select("name", c("hash").alias("new_hash")), "name", "full_outer")
    return j.withColumn("action", F.when(c("new_hash").isNull(), "copy").when(c("old_hash").isNull(), "only_new").when(c("old_hash") == c("new_hash"), "same").otherwise("conflict"))
