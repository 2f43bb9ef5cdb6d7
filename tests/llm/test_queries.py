import os

import duckdb
import pyarrow as pa
import pytest

from transitlens.llm import oracle_sql, queries
from transitlens.llm.common import slices

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(oracle_sql()[name]).df()
    got = queries()[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    text = lambda df: sorted(map(tuple, df[columns].astype(str).values.tolist()))
    assert text(got) == text(want)


def test_slices_are_cut_by_rows_and_bytes():
    texts = ["x" * 900, "y" * 5000, *["z" * k for k in range(700)], "", None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    cut = list(slices(iter([batch]), rows=256, size=4000))
    assert [t for b in cut for t in b.column("text").to_pylist()] == texts
    assert all(b.num_rows <= 256 and (b.num_rows == 1 or b.nbytes <= 4000) for b in cut)
    assert max(b.num_rows for b in cut) > 10


def test_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in queries()} == set(range(1, 14))
