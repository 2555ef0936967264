"""Every query with an oracle equals DuckDB on the same parquet tables."""

import pytest

from quarry.plans.compare import compare, duck, type_diff
from quarry.plans.registry import load_all

from conftest import SF_SMALL

QUERIES = {n: q for n, q in load_all().items() if q.sql}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    q = QUERIES[name]
    sdf = q.fn(spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(q.sql)
    dcols = [d[0] for d in rel.description]
    assert not type_diff(sdf.schema, rel.description), type_diff(sdf.schema, rel.description)
    res = compare(sdf.columns, srows, dcols, rel.fetchall())
    assert res in ("exact", "close"), res
