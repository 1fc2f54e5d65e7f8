"""Structured blocks: normalise, repair, dedupe, number, filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

c = F.col
#: Block columns: paper_id, ord, section_path, section_title, section_type, content_kind, text.
#: Within ``enforce_contract`` the NFKC form of a text that it changes; texts with this column are clean.
NFKC = "__nfkc"


def _hash(blocks: DataFrame, text: Column) -> Column:
    return T.content_hash(text, c(NFKC)) if NFKC in blocks.columns else T.content_hash(text)


def _clean(blocks: DataFrame) -> Column:
    return c("text") if NFKC in blocks.columns else T.clean_text(c("text"))


def normalise(blocks: DataFrame) -> DataFrame:
    """Cleaned text, canonical section columns, slug and content hash; no shuffle."""
    b = blocks.withColumn("section_path", T.section_path(c("section_path"), c("section_title")))
    b = b.withColumn("section_title", T.section_title(F.coalesce(F.nullif("section_title", F.lit("")), F.try_element_at("section_path", F.lit(-1)))))
    return b.withColumns({
        "section_slug": T.slugify(c("section_title")),
        "section_type": T.section_type(c("section_type"), c("section_title")),
        "content_kind": F.coalesce(F.nullif(F.trim("content_kind"), F.lit("")), F.lit("paragraph")),
        "text": _clean(b),
        "content_hash": _hash(b, c("text")),
    })


def dedupe_abstracts(blocks: DataFrame) -> DataFrame:
    """Repeats of a text within the abstract or front matter go; the first in order stays. Texts elsewhere are not hashed."""
    front = F.coalesce(F.lower(F.trim("section_type")).isin("abstract", "frontmatter", "front_matter", "metadata"), F.lit(False))
    kind = [F.when(front, F.lower(F.trim(x))) for x in ("section_type", "content_kind")]
    w = Window.partitionBy("paper_id", *kind, F.when(front, _hash(blocks, F.when(front, c("text"))))).orderBy("ord")
    return blocks.withColumn("n", F.row_number().over(w)).filter(~front | (c("n") == 1)).drop("n")


def repair_splits(blocks: DataFrame) -> DataFrame:
    """Neighbours of one section are joined while what is joined so far ends within a sentence.

    Runs of one section are islands. Within a run a new group begins where the last fragment with text
    ended its sentence, or where there was none. One partitioning by paper serves all windows.
    """
    w = Window.partitionBy("paper_id").orderBy("ord")
    key = T.section_key(c("section_path"), c("section_title"))
    b = blocks.withColumns({"text": _clean(blocks), "key": key})
    b = b.withColumns({"open": F.when(c("text") != "", T.stops_within(c("text"))), "changed": F.coalesce((c("key") != F.lag("key").over(w)).cast("int"), F.lit(1))})
    b = b.withColumn("run", F.sum("changed").over(w))
    before = Window.partitionBy("paper_id", "run").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    open_ended = F.last("open", ignorenulls=True).over(before)
    b = b.withColumn("starts", (~F.coalesce(open_ended, F.lit(False))).cast("int"))
    b = b.withColumn("part", F.sum("starts").over(Window.partitionBy("paper_id", "run").orderBy("ord")))
    texts = [x for x in ("text", NFKC) if x in blocks.columns]
    others = [x for x in blocks.columns if x not in ("paper_id", "ord", *texts)]
    joined = b.groupBy("paper_id", "run", "part").agg(F.min("ord").alias("ord"), F.collect_list(F.struct("ord", *texts)).alias("pieces"), F.min_by(F.struct(*others), "ord").alias("first"))
    joined = joined.withColumn("pieces", F.filter(F.when(F.size("pieces") > 1, F.sort_array("pieces")).otherwise(c("pieces")), lambda x: x["text"] != ""))
    whole = {"text": F.array_join("pieces.text", " ")}
    if NFKC in texts:  # a space parts what NFKC may join, so the form of the whole is that of its pieces
        whole[NFKC] = F.when(F.exists("pieces", lambda x: x[NFKC].isNotNull()), F.array_join(F.transform("pieces", lambda x: F.coalesce(x[NFKC], x["text"])), " "))
    return joined.withColumns(whole).select("paper_id", "ord", *texts, "first.*").select(*blocks.columns)


def number(blocks: DataFrame) -> DataFrame:
    """Order from 0 within a paper, and block ids made of it."""
    w = Window.partitionBy("paper_id").orderBy("ord")
    b = blocks.withColumn("ord", F.row_number().over(w) - 1)
    slug = F.coalesce(F.nullif(T.slugify(c("paper_id")), F.lit("")), F.lit("paper"))
    return b.withColumn("block_id", F.concat(slug, F.lit(":b"), "ord"))


def enforce_contract(blocks: DataFrame) -> DataFrame:
    """The steps one after another, over blocks dealt by paper once: all of their windows and groups lie within a paper.

    What Python does is done before, since Spark deals rows anew after it.
    """
    b = blocks.withColumn("text", T.clean_text(c("text"))).withColumn(NFKC, T.changed_by_nfkc(c("text"))).repartition("paper_id")
    return number(normalise(repair_splits(dedupe_abstracts(b)))).drop(NFKC)


def contract_faults(blocks: DataFrame) -> DataFrame:
    """Blocks with what they lack, as an array of messages; none if the contract holds."""
    needed = ["block_id", "content_hash", "section_type", "content_kind", "text"]
    faults = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c(x)), F.lit("")) == "", f"missing {x}") for x in needed], F.when(c("section_path").isNull(), "missing section_path"), F.when(~c("section_type").isin(T.SECTION_TYPES), "unknown section_type")))
    return blocks.withColumn("errors", faults).filter(F.size("errors") > 0)


def final_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks of the sections that end in the final paper, numbered anew; an id keeps what stands before its last ':b'."""
    kept = blocks.filter(c("section_type").isin(T.FINAL_SECTIONS))
    w = Window.partitionBy("paper_id").orderBy("ord")
    prefix = F.when(c("block_id").contains(":b"), F.regexp_extract("block_id", r"^(.*):b", 1)).otherwise("paper")
    return kept.withColumn("ord", F.row_number().over(w) - 1).withColumn("block_id", F.concat(prefix, F.lit(":b"), "ord"))


def sections(blocks: DataFrame) -> DataFrame:
    """Sections of each paper in the order in which they are first seen."""
    s = blocks.groupBy("paper_id", F.coalesce("section_title", F.lit("")).alias("title"), F.coalesce("section_type", F.lit("unknown")).alias("type")).agg(F.min("ord").alias("first"))
    return s.withColumn("ord", F.row_number().over(Window.partitionBy("paper_id").orderBy("first")) - 1).drop("first")


def merge_batches(blocks: DataFrame) -> DataFrame:
    """Blocks of all batches: repeats by (title, type, kind, text) go, the first stays; order is given anew."""
    sig = [*[F.coalesce(c(x), F.lit("")) for x in ("section_title", "section_type", "content_kind")], F.lower(T.clean_text(c("text")))]
    first = blocks.withColumn("n", F.row_number().over(Window.partitionBy("paper_id", *sig).orderBy("batch", "ord"))).filter("n = 1").drop("n")
    w = Window.partitionBy("paper_id").orderBy("batch", "ord")
    return first.withColumn("ord", F.row_number().over(w) - 1)


def merge_registries(registry: DataFrame) -> DataFrame:
    key = [F.lower(T.clean_text(c(x))) for x in ("title", "type", "parent")]
    return registry.withColumn("n", F.row_number().over(Window.partitionBy("paper_id", *key).orderBy("batch", "ord"))).filter("n = 1").drop("n")


def classifier_input(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("section_type", F.coalesce("section_type", F.lit("unknown"))).filter(~c("section_type").isin(T.ADMINISTRATIVE_SECTIONS))


def evidence_blocks(blocks: DataFrame) -> DataFrame:
    return blocks.filter(c("section_type").isin(T.EVIDENCE_SECTIONS))


def packets(scopes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Blocks of each scope in the scope's order. Fails if a scope names an unknown block or none."""
    ids = scopes.select("paper_id", "experiment_scope_id", F.posexplode_outer("source_block_ids").alias("pos", "block_id"))
    found = ids.join(blocks.select("paper_id", "block_id", "text", F.lit(True).alias("known")), ["paper_id", "block_id"], "left")
    message = F.concat(F.lit("unknown or missing block in scope "), c("experiment_scope_id"))
    found = found.withColumn("text", F.when(c("known"), c("text")).otherwise(F.raise_error(message)))
    return found.groupBy("paper_id", "experiment_scope_id").agg(F.array_sort(F.collect_list(F.struct("pos", "block_id", "text"))).alias("blocks"))


def unknown_block_ids(scopes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(paper_id, experiment_scope_id, block_id) that no block has: the check without failing."""
    ids = scopes.select("paper_id", "experiment_scope_id", F.explode("source_block_ids").alias("block_id"))
    return ids.join(blocks.select("paper_id", "block_id"), ["paper_id", "block_id"], "left_anti")
