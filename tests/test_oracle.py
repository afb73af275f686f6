"""Every registered query against its DuckDB SQL at sf0.01 (the driver's correctness gate),
plus the smoke entry and schema types."""

import os

import pytest

import __spark_entry__ as E
from liftkit.plans.oracle import DOUBLE_COLUMNS
from tests.oracle_check import canon, duck

SF = "/root/testdata/sf0.01"
HAVE_DATA = os.path.exists(SF)
SQL = E.oracle_sql()

DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not HAVE_DATA, reason="test tables absent")
@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    rel = con.sql(SQL[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    stypes = dict(sdf.dtypes)
    for name, dtype in zip(rel.columns, rel.dtypes):
        want = DUCK_TO_SPARK.get(str(dtype))
        if want:
            assert stypes[name] == want, (name, stypes[name], str(dtype))
    doubles = sorted(c for c, t in sdf.dtypes if t in ("double", "float"))
    assert doubles == sorted(DOUBLE_COLUMNS.get(key, [])), "update DOUBLE_COLUMNS in liftkit/plans/oracle.py"
    a = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    b = canon(rel.columns, rel.fetchall())
    assert len(a) == len(b)
    assert a == b


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(E.SMOKE_DIR), reason="smoke tables absent")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "estimated_incremental_margin" in df.columns
