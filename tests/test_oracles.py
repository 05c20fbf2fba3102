"""Every query with an oracle, compared with DuckDB at sf0.001; the rest must run."""

import datetime
import decimal
import math

import duckdb
import pytest

from attesta.plans import catalog, registry  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if v is None or isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if math.isnan(float(v)) else round(float(v), 6)
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


def rows(columns, found):
    return sorted([tuple(norm(r[c]) for c in columns) for r in found], key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = rows(columns, df.collect())
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == columns
        assert got == rows(columns, [dict(zip(names, r)) for r in want.fetchall()])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
