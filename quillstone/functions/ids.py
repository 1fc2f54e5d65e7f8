"""Stable identifiers."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and the SHA-256 of the parts as a compact JSON array; nulls stay."""
    return F.concat(F.lit(f"{prefix}_"), F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256))


def nul_joined(prefix: str, *parts: Column, digits: int | None = 24) -> Column:
    whole = F.sha2(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    return F.concat(F.lit(f"{prefix}_"), F.substring(whole, 1, digits) if digits else whole)


def idempotency_key(*parts: Column) -> Column:
    return nul_joined("idm", *parts, digits=None)


def paper_id(metadata_id: Column) -> Column:
    return F.sha2(F.trim(metadata_id), 256)


def metadata_id(source_id: Column, doi: Column) -> Column:
    return F.when(source_id.isNotNull(), F.concat(F.lit("meta:s2:"), source_id)).when(doi.isNotNull(), F.concat(F.lit("meta:crossref:"), doi))


#: Characters with a short escape in JSON.
SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_text(text: Column) -> Column:
    """A text as a JSON string in ASCII: other characters as their UTF-16 units, \\u and four lower-case digits. Null stays."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(.{4})"), 1)

    def one(unit: Column) -> Column:
        out = F.when(unit == "0022", SHORT_ESCAPES['"'])
        for x, escape in SHORT_ESCAPES.items():
            out = out.when(unit == f"{ord(x):04X}", escape)
        return out.when(unit.between("0020", "007E"), F.char(F.conv(unit, 16, 10).cast("int"))).otherwise(F.concat(F.lit("\\u"), F.lower(unit)))

    return F.when(text.rlike(r"^[ !#-\[\]-~]*$"), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.concat(F.lit('"'), F.array_join(F.transform(units, one), ""), F.lit('"')))


def python_repr(text: Column) -> Column:
    """A text as Python writes it in a tuple: in single quotes, or double ones around a text with single ones only. Null stays.

    Backslashes, line ends and tabs are escaped; other control characters stay as they are.
    """
    plain = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for x in "\n\r\t":
        plain = F.replace(plain, F.lit(x), F.lit(SHORT_ESCAPES[x]))
    single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)


def canonical_json(text: Column, ascii_only: bool = False) -> Column:
    """JSON text with keys in order, without spaces, numbers in Python's form, characters as they are or all in ASCII; null and text that is no JSON stay."""

    @F.pandas_udf("string")
    def ordered(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            try:
                return t if t is None else json.dumps(json.loads(t), ensure_ascii=ascii_only, sort_keys=True, separators=(",", ":"))
            except ValueError:
                return t

        return texts.map(one)

    return ordered(text)


def file_hash(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content, 256))


#: Parts of a name that mark a secret setting.
SECRET_PARTS = ("secret", "token", "key", "password", "dsn")


def public_config(value):
    """Settings without secret keys, nested too, and with paths reduced to names."""
    if isinstance(value, dict):
        return {k: public_config(v) for k, v in value.items() if not any(p in str(k).lower() for p in SECRET_PARTS)}
    if isinstance(value, (list, tuple)):
        return [public_config(v) for v in value]
    return value.name if hasattr(value, "name") and hasattr(value, "parts") else value


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(public_config(config), sort_keys=True, default=str).encode()).hexdigest()


def map_id(paper: Column, scopes: Column, unmapped: Column) -> Column:
    """Experiment map id: of the paper and its scopes, whose fields must be declared in alphabetical order."""
    body = F.to_json(F.struct(scopes.alias("experiment_scopes"), unmapped.alias("unmapped_block_ids")), {"ignoreNullFields": "false"})
    return F.concat(F.lit("experiment_map_"), F.sha2(F.concat(F.lit('["experiment_map",'), F.to_json(F.array(paper)).substr(F.lit(2), F.length(F.to_json(F.array(paper))) - 2), F.lit(","), body, F.lit("]")), 256))
