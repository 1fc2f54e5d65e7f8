import re

import corpus_pipeline as cp
import public_tokenizers as P

from quillstone.llm.common import table, written

from .helpers import AWKWARD, docs, low
from .test_operators import JSON, brute, check_packing


def test_stages_on_documents(spark, sf_dir):
    stage = dict(cp.STAGES)
    source = table(spark, sf_dir, "documents")
    kept = written(stage["language_id"](spark, source, sf_dir), "t")
    assert kept.columns == source.columns
    assert {r.doc_id for r in source.collect() if any(c.isalpha() for c in r.text)} == {r.doc_id for r in kept.collect()}
    unique = written(stage["exact_dedup"](spark, kept, sf_dir), "t")
    first = {}
    for r in sorted(kept.collect(), key=lambda r: r.doc_id):
        first.setdefault(low(r.text), r.doc_id)
    assert {r.doc_id for r in unique.collect()} == set(first.values())
    apart = written(stage["near_dedup"](spark, unique, sf_dir), "t")
    want = brute([(r.doc_id, r.text) for r in unique.collect()], 5)
    assert {r.doc_id for r in apart.collect()} == {i for i, (n, c) in want.items() if i == c}
    clean = written(stage["secret_scan"](spark, apart, sf_dir), "t")
    key = re.compile(r'((?i:token) = ")[0-9a-fA-F]{40}"')
    texts = {r.doc_id: key.sub(r'\1[SECRET]"', r.text) for r in apart.collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {i: (t, len(t)) for i, t in texts.items()}
    pieces = stage["packing"](spark, clean, sf_dir)
    assert check_packing(list(texts.items()), pieces.collect()) <= 1


def test_stages_on_awkward_rows(spark, sf_dir):
    for rows in (AWKWARD, []):
        found = docs(spark, rows) if rows else docs(spark, AWKWARD).limit(0)
        columns = found.columns
        for name, stage in cp.STAGES:
            found = written(stage(spark, found, sf_dir), "t")
            if name != "packing":
                assert found.columns == columns
        assert bool(found.count()) == bool(rows)


def test_language_stage_without_labels(spark, sf_dir):
    from pyspark.sql import functions as F

    rows = docs(spark, [(1, "some words"), (2, "123"), (3, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert dict(cp.STAGES)["language_id"](spark, rows, sf_dir).count() == 3


def test_near_dedup_drops_rows_not_identifiers(spark, sf_dir):
    """A repeated identifier with a copy and a unique text, and copies without one."""
    copy, unique = " ".join(f"w{k}" for k in range(60)), " ".join(f"u{k}" for k in range(60))
    rows = [(3, copy), (7, copy + " more"), (7, unique), (None, copy + " end"), (None, "n " + unique + " n"), (None, None), (None, None), (8, ""), (8, "")]
    kept = sorted(((r.doc_id, r.text) for r in dict(cp.STAGES)["near_dedup"](spark, docs(spark, rows), sf_dir).collect()), key=str)
    assert kept == sorted([(3, copy), (7, unique), (None, None), (None, None), (8, ""), (8, "")], key=str)


def test_run(spark, sf_dir):
    assert cp.run(spark, sf_dir).count() > 0
