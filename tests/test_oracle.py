"""Every registered query against its DuckDB oracle on the smallest tables,
the same comparison the correctness gate runs at sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest, duck  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from transitlens import plans  # noqa: E402

NAMES = sorted(plans.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(NAMES) == set(plans.oracle_sql())
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "bearing"]
    assert df.count() == 263
