"""Labels outside the test data: years before and after, a sixth priority, a new status.  The queries that build wide
or cube layouts take their labels from the data, so they match their oracles here as well."""
import duckdb
import pytest

from regiolake import plans
from regiolake.sources.catalog import DRIVER_TABLES
from test_oracle import _key, _norm

SF = "/root/testdata/sf0.001"
NAMES = ["rsh_melt_years", "rsh_melt_split", "rsh_pivot_first", "rsh_header_parse", "agg_first_pivot", "src_px_cube",
         "job_activity_rates", "job_population_nationality", "job_detentions", "job_detentions_total", "job_elections",
         "job_ecp", "job_ecp_pairing", "snk_csv_parts", "snk_split_even"]


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    top, con = tmp_path_factory.mktemp("shifted"), duckdb.connect()
    for t in DRIVER_TABLES:
        src = f"SELECT * FROM read_parquet('{SF}/{t}.parquet')"
        if t == "orders":
            src = f"""SELECT * REPLACE (
                CASE o_orderkey % 7 WHEN 0 THEN o_orderdate - INTERVAL 3 YEAR WHEN 1 THEN o_orderdate + INTERVAL 7 YEAR
                                    ELSE o_orderdate END AS o_orderdate,
                CASE WHEN o_orderkey % 11 = 0 THEN '6-NEW' ELSE o_orderpriority END AS o_orderpriority) FROM ({src})"""
        con.execute(f"COPY ({src}) TO '{top}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{top}/{t}.parquet')")
    return str(top), con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_on_other_labels(spark, shifted, name):
    plans.load_all()
    top, con = shifted
    df = plans.QUERIES[name](spark, top)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = con.execute(plans.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(r[names.index(c)]) for c in cols) for r in res.fetchall()), key=_key)
    assert got == want
