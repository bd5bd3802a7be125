"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from wattframe import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    other = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in other.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, other.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"ct_10b_variant_backtest", "ct_10c_variant_savings", "ct_10d_invariances", "ct_16_sensitivity_batch", "dq_16_assertion_suite"}))
def test_query_without_sql_gives_rows(spark, name):
    df = registry.queries()[name](spark, SF)
    assert df.columns and not df.isEmpty()
