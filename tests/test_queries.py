"""Every query of the panel library against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from panelforge.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        connection.execute(f"create view {name[:-8]} as select * from '{sf_dir}/{name}'")
    return connection


def canonical(rows, columns):
    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    found = registry.queries()[name](spark, sf_dir)
    wanted = duck.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert canonical(found.collect(), found.columns) == canonical(wanted.fetchall(), columns)
