"""Every core query with SQL gives the rows of its SQL; the others run."""

import pytest

from oracle import compare
from vigilake.plans import reference, training

QUERIES, SQL = reference.QUERIES | training.QUERIES, reference.SQL | training.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, name):
    compare(spark, small, QUERIES, SQL, name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    df = QUERIES[name](spark, small)
    assert df.count() >= 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_nothing_in_the_core_imports_the_llm_subpackage():
    from pathlib import Path

    root = Path(reference.__file__).resolve().parent.parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "vigilake.llm" not in p.read_text(), p
