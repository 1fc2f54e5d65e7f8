import pytest

from quillstone.plans import files, records, registry

from .conftest import against_sql


assert records.NOW and files.c  # they add their queries


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    got, want = against_sql(registry.QUERIES[name](spark, sf_dir), registry.ORACLE_SQL[name], sf_dir)
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
