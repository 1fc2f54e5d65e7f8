"""Scalar text functions as Column expressions."""

from __future__ import annotations

import unicodedata
from itertools import count, groupby

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..shipping import ship

# They decide results and must equal the published contract.
SECTION_TYPES = ["front_matter", "abstract", "introduction", "related_work", "methods", "results", "discussion", "conclusion", "references", "appendix", "supplementary", "acknowledgements", "funding", "disclosure", "ethics", "unknown"]
FINAL_SECTIONS = ["abstract", "methods", "results", "discussion", "conclusion", "supplementary"]
EVIDENCE_SECTIONS = ["methods", "results", "discussion", "conclusion"]
ADMINISTRATIVE_SECTIONS = ["front_matter", "references", "acknowledgements", "funding", "disclosure", "ethics", "appendix", "supplementary"]
SECTION_ALIASES = {"frontmatter": "front_matter", "metadata": "front_matter", "material_and_methods": "methods", "materials_and_methods": "methods", "method": "methods", "publisher_note": "disclosure", "author_contributions": "acknowledgements", "abbreviations": "supplementary"}
EXPOSURE_KINDS = [("food", "diet|egg|fiber|starch|food"), ("exercise", "exercise|training"), ("sleep", "sleep")]
OUTCOME_KINDS = [("biomarker", "cholesterol|glucose|insulin|biomarker"), ("anthropometric", "weight|bmi|waist"), ("microbiome", "microbiome|taxa|bacteria")]
BAD_ENDING = r"(and|of|with|,|;|\()$"
SENTENCE_END = r"[.!?][\"')\]]?$"

#: White space of Unicode and the four separators; the first ranges pass over most characters at once, as (?U) does not.
_BLANK = r"\x09-\x20\x85-\u3000&&[\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]"
#: A run of white space that is not one plain space: clean text has none, and is not built anew.
_SPACE = rf"[{_BLANK}(?:(?<! )[{_BLANK}*|[{_BLANK}+)"
_ASCII = r"^[\x00-\x7F]*$"


def _unsettled() -> str:
    """A class of characters such that a text without them is its own NFKC form: others are theirs, and none joins with one before it."""
    spans = [(0x80, 0x300), (0x370, 0x483), (0x48A, 0x530), (0x2010, 0x2060), (0x3041, 0x3097), (0x30A1, 0x30FB), (0x4E00, 0xA000)]
    good = [x for a, b in spans for x in range(a, b) if unicodedata.is_normalized("NFKC", chr(x)) and not unicodedata.combining(chr(x))]
    runs = [list(run) for _, run in groupby(good, lambda x, n=count(): x - next(n))]
    return rf"[\x{{80}}-\x{{10FFFF}}&&[^{''.join(rf'\x{{{run[0]:X}}}-\x{{{run[-1]:X}}}' for run in runs)}]]"


_NOT_NFKC = _unsettled()


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean_text(c), F.lit(""))


def clean_text(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed; null counts as empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _SPACE, " "))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that Python gets by rows and by bytes, so that its memory does not grow with a partition's texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def changed_by_nfkc(c: Column) -> Column:
    """The NFKC form of a text that it may change; null of others, of which Python gets a null, too."""
    ship()
    bound_batches(SparkSession.active())
    return nfkc(F.when(c.rlike(_NOT_NFKC), c))


def hash_text(c: Column, folded: Column | None = None) -> Column:
    """Text as it is hashed: NFKC, which spells ligatures out, lower case, white space collapsed. ``folded``: what ``changed_by_nfkc`` gave of clean text."""
    if folded is not None:
        return F.when(folded.isNull(), F.lower(c)).otherwise(clean_text(F.lower(folded)))
    return clean_text(F.lower(F.coalesce(changed_by_nfkc(c), c)))


def content_hash(c: Column, folded: Column | None = None) -> Column:
    return F.sha2(hash_text(c, folded), 256)


def slugify(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", "-"), F.lit("-"))


def normalize_doi(c: Column) -> Column:
    """Bare lower-case DOI; null when nothing is left."""
    bare = F.regexp_replace(F.trim(c), r"(?i)^https?://(dx\.)?doi\.org/", "")
    return F.nullif(F.lower(F.trim(F.regexp_replace(bare, r"(?i)^doi:\s*", ""))), F.lit(""))


def slugify_doi(c: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.coalesce(normalize_doi(c), F.lit("")), "[^a-z0-9._-]+", "-"), "-+", "-")
    return F.coalesce(F.nullif(F.trim(slug, F.lit("-")), F.lit("")), F.lit("unknown-doi"))


def base_name(doi: Column) -> Column:
    return F.concat(F.lit("doi-"), slugify_doi(doi))


def parse_base_name(c: Column) -> Column:
    """(slug, document_id) of ``doi-<slug>`` or of the older ``<document id>__doi-<slug>``; nulls for other names."""
    got = lambda pattern, g: F.nullif(F.regexp_extract(c, pattern, g), F.lit(""))
    older = "^([^_]+)__doi-(.+)$"
    return F.struct(F.coalesce(got("^doi-(.+)$", 1), got(older, 2)).alias("slug"), F.when(~c.startswith("doi-"), got(older, 1)).alias("document_id"))


def canonical_name(c: Column) -> Column:
    """Key under which the spellings of one term meet."""
    name = F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "_"), F.lit("_"))
    for suffix in ("_consumption$", "_intake$"):
        name = F.regexp_replace(name, suffix, "")
    return F.replace(name, F.lit("whole_egg"), F.lit("egg"))


def display_name(c: Column) -> Column:
    """Words in title case, where a letter after any non-letter is upper case."""
    spaced = F.trim(F.replace(c, F.lit("_"), F.lit(" ")))
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(spaced), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1), lambda w: F.initcap(w)), "")


def kind_of(c: Column, kinds: list[tuple[str, str]]) -> Column:
    out = F.lit("other")
    for name, pattern in reversed(kinds):
        out = F.when(F.lower(c).rlike(pattern), name).otherwise(out)
    return out


def section_title(c: Column) -> Column:
    """Title without leading numbering."""
    return F.trim(F.regexp_replace(clean_text(c), r"^\d+(?:\.\d+)*\.?\s+", ""))


def section_type(kind: Column, title: Column) -> Column:
    """Canonical section type; some titles decide, whatever the type says."""
    raw = F.lower(F.trim(F.coalesce(F.nullif(kind, F.lit("")), F.lit("unknown"))))
    name = F.coalesce(F.nullif(F.translate(raw, "- ", "__"), F.lit("")), F.lit("unknown"))
    aliases = F.create_map(*[F.lit(x) for pair in SECTION_ALIASES.items() for x in pair])
    name = F.coalesce(aliases[name], name)
    t = F.lower(F.coalesce(title, F.lit("")))
    return (
        F.when(t.contains("ethic"), "ethics")
        .when(t.contains("contributions") | t.contains("author contribution"), "acknowledgements")
        .when(t.contains("publisher note"), "disclosure")
        .when(t.contains("abbreviation"), "supplementary")
        .when(name.isin(SECTION_TYPES), name)
        .otherwise("unknown")
    )


def section_path(path: Column, title: Column) -> Column:
    kept = F.transform(F.filter(F.coalesce(path, F.array().cast("array<string>")), lambda x: clean_text(x) != ""), section_title)
    return F.when(F.size(kept) > 0, kept).when(clean_text(title) != "", F.array(section_title(title))).otherwise(F.array().cast("array<string>"))


def section_key(path: Column, title: Column) -> Column:
    return F.struct(F.array_join(F.transform(path, lambda x: F.lower(section_title(x))), " > ").alias("path"), F.lower(section_title(title)).alias("title"))


def is_open_ended(text: Column) -> Column:
    """Text that stops within a sentence: it joins with what follows in its section."""
    return stops_within(clean_text(text))


def stops_within(t: Column) -> Column:
    """``is_open_ended`` of clean text. Endings are of four characters at most, so that only these are looked at."""
    return (t != "") & (F.lower(F.right(t, F.lit(4))).rlike(BAD_ENDING) | ~F.right(t, F.lit(2)).rlike(SENTENCE_END))


def source_slug(paper_id: Column, pdf: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(F.coalesce(pdf, F.lit("paper")), r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.coalesce(F.nullif(slugify(F.coalesce(F.nullif(F.trim(paper_id), F.lit("")), stem)), F.lit("")), F.lit("paper"))


def keyword_text(c: Column) -> Column:
    """ASCII tokens, lower case, joined by one space."""
    ship()
    bound_batches(SparkSession.active())
    as_is = F.coalesce(c, F.lit("")).rlike(_ASCII)
    folded = F.when(as_is, c).otherwise(ascii_fold(F.when(~as_is, c)))
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(folded, F.lit(""))), F.lit("([a-z0-9]+)"), 1), " ")


def matched_keywords(text: Column, keywords: list[str]) -> Column:
    """Keywords in a column of normalised text: a phrase as a substring, a word as the beginning of a token."""
    words = F.array(*map(F.lit, keywords)) if keywords else F.array().cast("array<string>")
    return F.filter(words, lambda k: F.when(F.instr(k, " ") > 0, F.contains(text, k)).otherwise(F.contains(F.concat(F.lit(" "), text), F.concat(F.lit(" "), k))))


def safe_int(c: Column) -> Column:
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(r"^[+-]?\d+$"), F.expr("1").cast("int") * s.try_cast("bigint"))


def int_or_zero(c: Column) -> Column:
    """Whole number of a text or a number; 0 of null, blank or anything else."""
    return F.coalesce(safe_int(c), F.lit(0).cast("bigint"))


def safe_string(c: Column) -> Column:
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def truncate_words(c: Column, n: int) -> Column:
    words = F.split(clean_text(c), " ")
    return F.when(F.size(words) > n, F.concat(F.array_join(F.slice(words, 1, n), " "), F.lit("..."))).otherwise(clean_text(c))


def citekey(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(c, "[^A-Za-z0-9]+", "_"), F.lit("_")), F.lit("")), F.lit("paper"))


def recitation_clean(c: Column) -> Column:
    """Marks of recitation removed, each line's white space collapsed, line breaks kept."""
    for pattern, to in ((r"¶", ""), (r"_X_", ""), (r"<!--\s*z\s*-->", ""), (r"\*([A-Za-z0-9][^*\n]*?)\*", "$1")):
        c = F.regexp_replace(c, pattern, to)
    return F.array_join(F.transform(F.split(c, "\n"), clean_text), "\n")


def quality(confidence: Column, truncated: Column, duplicate: Column) -> Column:
    """Quality of a block: an unknown confidence counts as medium, missing flags as false."""
    no = F.lit(False)
    level = F.when(confidence.isin("high", "medium", "low"), confidence).otherwise("medium")
    return F.struct(level.alias("confidence"), F.coalesce(truncated, no).alias("is_truncated"), F.coalesce(duplicate, no).alias("is_duplicate"))


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 5) == F.lit(bytearray(b"%PDF-"))


def best_pdf_url(best: Column, locations: Column) -> Column:
    """The best location's URL, else the first non-empty one."""
    return F.coalesce(safe_string(best), F.get(F.filter(F.transform(locations, safe_string), lambda u: u.isNotNull()), 0))


def iso_time(ts: Column, micros: bool = False) -> Column:
    """ISO form of a UTC time, in seconds or microseconds, with a Z."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" if micros else "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))


def line_kind(line: Column) -> Column:
    """heading, table, list, caption, fence, blank or paragraph, of one Markdown line."""
    s = F.trim(line)
    return (
        F.when(s == "", "blank")
        .when(s.startswith("```"), "fence")
        .when(s.rlike(r"^#+ "), "heading")
        .when(s.startswith("|") & s.endswith("|"), "table")
        .when(s.rlike(r"^([-*+] |\d+\. )"), "list")
        .when(F.lower(s).rlike(r"^(figure |fig\. |table )") & F.contains(F.substring(s, 1, 30), F.lit(":")), "caption")
        .otherwise("paragraph")
    )
