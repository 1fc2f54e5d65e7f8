import random

import pytest

from quillstone.llm import near

from .helpers import docs


@pytest.fixture
def tables(monkeypatch):
    """Name of each table that near writes, and the aggregations and joins of its plan."""
    found, plain = [], near.written

    def written(df, tag):
        found.append((tag, df._jdf.queryExecution().sparkPlan().toString().count("Aggregate"), df._jdf.queryExecution().sparkPlan().toString().count("Join")))
        return plain(df, tag)

    monkeypatch.setattr(near, "written", written)
    return found


def smallest(pairs):
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def test_components_against_brute_force(spark, tables):
    rng = random.Random(5)
    chain, ring, hub = [(k, k + 1) for k in range(40)], [(100 + k, 100 + (k + 1) % 9) for k in range(9)], [(250, k) for k in range(200, 300)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    for pairs in (chain, ring, hub, loose, chain[::-1] + hub + loose, [(1, 1)]):
        rows = near.components(spark.createDataFrame(pairs + pairs[:3], "a long, b long")).collect()
        assert len(rows) == len({r.id for r in rows})
        assert {r.id: r.component for r in rows} == smallest(pairs)
    assert max(joins for _, _, joins in tables) <= 1  # a star at a time


def test_components_of_stars_take_no_round(spark, tables):
    pairs = [(10 * k, 10 * k + j) for k in range(5) for j in range(1, 9)]
    assert {(r.id, r.component) for r in near.components(spark.createDataFrame(pairs, "a long, b long")).collect()} == {(b, a) for a, b in pairs}
    assert [tag for tag, _, _ in tables] == ["edges"]
    del tables[:]
    assert near.components(spark.createDataFrame([], "a long, b long")).collect() == []
    assert [tag for tag, _, _ in tables] == ["edges"]


def test_representatives_are_found_once(spark, tables):
    rows = [(k, " ".join(f"w{k % 7}x{j}" for j in range(20 + k % 3))) for k in range(40)]
    near.near_duplicates(docs(spark, rows)).collect()
    assert [tag for tag, _, _ in tables].count("representatives") == 1
