"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import pytest

from tests.check import digest, duck_connect
from newsmart.plans import load_queries

SF = "/root/testdata/sf0.001"

# Spark simple type -> DuckDB type name, for the schema half of the gate.
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(load_queries()))
def test_query_matches_oracle(spark, con, name):
    q = load_queries()[name]
    df = q.fn(spark, SF)
    s_cols, s_n, s_h = digest(df.columns, [tuple(r) for r in df.collect()])
    if q.oracle is None:
        pytest.skip("no SQL equivalent")
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {q.oracle}").fetchall()}
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == duck_types
    cur = con.execute(q.oracle)
    d_cols, d_n, d_h = digest([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert s_n == d_n
    assert s_h == d_h


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["source_name", "author", "number_articles"]
    assert df.count() > 0
