"""Every registered query against its DuckDB SQL on the smallest tables."""

import pytest

from conftest import SF_SMALL
from quarry.plans import catalog
from tools_compare import same_rows

WITH_SQL = sorted(n for n, q in catalog.REGISTRY.items() if q.sql is not None)
WITHOUT_SQL = sorted(n for n, q in catalog.REGISTRY.items() if q.sql is None)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_duckdb(spark, duck, name):
    q = catalog.REGISTRY[name]
    df = q.run(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(q.oracle())
    dcols = [d[0] for d in rel.description]
    ok, why = same_rows(df.columns, rows, dcols, rel.fetchall())
    assert ok, why


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_runs_with_stable_schema(spark, name):
    q = catalog.REGISTRY[name]
    a = q.run(spark, SF_SMALL)
    rows = a.collect()
    assert a.columns and rows and all(len(r) == len(a.columns) for r in rows)
