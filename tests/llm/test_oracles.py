"""Queries of the training-data operators against their SQL, and their registration."""
import pytest

import __spark_entry__ as E
from regiolake.llm import queries as Q

from .conftest import SF


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    res = duck.execute(Q.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted(tuple(r[names.index(c)] for c in cols) for r in res.fetchall())
    assert got == want
