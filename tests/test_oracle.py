"""Every registered query with an oracle: Spark result == DuckDB result.

Runs on sf0.001 (fast); the driver repeats the comparison at sf0.01.
Row count, column names and all values (doubles within 1e-9 after the
shared ``q4`` quantisation) must agree.
"""

import math

import duckdb
import pandas as pd
import pytest

from paths import SF_SMALL
from pricelens.plans.registry import load_all
from pricelens.sources.tables import TABLES

QUERIES = load_all()
WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(df):
    df = df.copy()
    for c in df.columns:
        if df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else str(v))
        elif str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype(str)
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="last").reset_index(drop=True)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, duck, name):
    q = QUERIES[name]
    sdf = q.build(spark, SF_SMALL)
    rel = duck.sql(q.sql)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert stypes == dtypes
    s = _norm(sdf.toPandas())
    d = _norm(rel.df())
    assert list(s.columns) == list(d.columns)
    assert len(s) == len(d)
    for c in s.columns:
        try:
            a, b = pd.to_numeric(s[c]), pd.to_numeric(d[c])
            ok = (a == b) | (a.isna() & b.isna())
        except (ValueError, TypeError):
            ok = s[c].astype(str) == d[c].astype(str)
        assert ok.all(), f"{name}.{c}: {int((~ok).sum())} differing rows"


def test_every_query_has_inventory_and_builds(spark):
    for name, q in QUERIES.items():
        assert q.inventory, name
