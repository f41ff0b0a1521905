"""Every registered query with an oracle equals its DuckDB twin (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.oracle_check import TABLES, canon

SQL = entry.oracle_sql()


@pytest.fixture(scope="module", autouse=True)
def one_point_grids():
    """The values compared here hold for any tuned model, so one grid point per classifier will do."""
    from demandlens.ml import models

    whole = dict(models.CLASSIFIERS)
    for name, spec in whole.items():
        models.CLASSIFIERS[name] = models.Classifier(spec.make, spec.scaled, {k: v[:1] for k, v in spec.grid.items()})
    yield
    models.CLASSIFIERS.update(whole)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    rel = con.sql(SQL[key])
    s = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    d = canon(rel.columns, rel.fetchall())
    assert s[0] == d[0]
    assert len(s[1]) == len(d[1])
    assert s[2] == d[2]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["search_position", "posting_count", "company_count", "country_count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
