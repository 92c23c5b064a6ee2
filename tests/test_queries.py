"""Every core query: against its SQL where there is one, else it must run and have rows."""

from __future__ import annotations

import pytest
from parity import compare

from tagloom.plans import annotation, formats, groups, problems, reads, signals, stats

MODULES = (problems, reads, groups, stats, signals, annotation, formats)
QUERIES = {n: q for m in MODULES for n, q in m.QUERIES.items()}
ORACLE = {n: q for m in MODULES for n, q in m.ORACLE.items()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, data, name):
    compare(QUERIES[name], ORACLE[name], spark, data)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"q_refine_rounds"}))
def test_runs(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.count() >= 0
    assert len(set(df.columns)) == len(df.columns)
