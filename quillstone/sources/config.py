"""Driver-side settings, prompts and model answers."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def deep_merge(base: Mapping, more: Mapping) -> dict:
    """Settings of ``base`` overlaid by ``more``, mappings merged at each level."""
    out = dict(base)
    for k, v in more.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out


def texts_in(spark: SparkSession, folder: str) -> dict[str, str]:
    """The texts of a folder's files by name, from any store that Spark reads; for settings and prompts, which are few and small."""
    rows = spark.read.text(folder, wholetext=True).select(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("name"), "value")
    return {r["name"]: r["value"] for r in rows.collect()}


def load_config(folder: Path | Mapping[str, str], override: Mapping | None = None, parse=json.loads) -> dict:
    """All files of a folder, or texts by file name, in order of name, then the override; ``parse`` reads YAML where a parser is at hand."""
    texts = folder if isinstance(folder, Mapping) else {p.name: p.read_text(encoding="utf-8") for p in folder.iterdir() if p.is_file()}
    out: dict = {}
    for name in sorted(n for n in texts if n.endswith((".json", ".yaml", ".yml"))):
        out = deep_merge(out, parse(texts[name]) or {})
    return deep_merge(out, override or {})


def first_setting(*values, default=None):
    """First value that is not blank: environment, settings, default."""
    return next((v for v in values if v is not None and str(v).strip()), default)


def compile_template(template: str, values: Mapping[str, object]) -> str:
    """``{{x}}`` and ``{x}`` filled in; a variable without a value is an error."""

    slots = re.compile(r"\{\{\s*(\w+)\s*\}\}|(?<!\{)\{([A-Za-z_]\w*)\}(?!\})")
    names = {m[1] or m[2] for m in slots.finditer(template)}
    if missing := names - values.keys():
        raise ValueError(f"no value for {', '.join(sorted(missing))}")
    return slots.sub(lambda m: str(values[m[1] or m[2]]), template)


class Prompts:
    """Prompts of a remote registry, or of a folder (or texts by file name) where that fails."""

    def __init__(self, folder: Path | Mapping[str, str], remote=None) -> None:
        self.folder, self.remote = folder, remote

    def get(self, name: str) -> str:
        if self.remote is not None:
            try:
                return self.remote(name)
            except Exception:  # noqa: BLE001  any failure of the registry falls back
                pass
        return self.folder[f"{name}.md"] if isinstance(self.folder, Mapping) else (self.folder / f"{name}.md").read_text(encoding="utf-8")


def extract_json(answer: str) -> dict:
    """The first balanced JSON object of a model's answer, without code fences around it."""
    text = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", answer)
    start = text.find("{")
    if start < 0:
        raise ValueError("the answer holds no JSON object")
    value, _ = json.JSONDecoder().raw_decode(text, start)
    return value


def selection_mode(name: str, aliases: Mapping[str, str]) -> str:
    """Canonical name of a selection mode; an unknown one is an error."""
    try:
        return aliases[name.strip()]
    except KeyError:
        raise ValueError(f"unknown selection mode {name}") from None
