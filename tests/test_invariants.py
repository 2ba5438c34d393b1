"""Invariants of SURVEY §5 on the registered queries (smallest driver tables)."""
from collections import defaultdict

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
Q = E.queries()


def test_shares_of_a_partition_sum_to_100(spark):
    rows_ = Q["win_group_total"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows_:
        by[(r.r_name, r.year)].append(r)
    for grp in by.values():
        assert abs(sum(r.revenue for r in grp) - grp[0].group_total) < 1e-6 * max(1.0, grp[0].group_total)
        assert abs(sum(r.share_pct for r in grp) - 100.0) <= 0.005 * len(grp) + 1e-9   # rounded to 2 decimals


def test_priority_merge_keys_unique(spark):
    keys = [(r.n_name, r.year) for r in Q["ts_priority_merge"](spark, SF).collect()]
    assert len(keys) == len(set(keys))
    fp = [(r.province_std, r.year) for r in Q["mdl_foreign_pct_real"](spark, SF).collect()]
    assert len(fp) == len(set(fp))


def test_residual_part_plus_rest_is_total(spark):
    res = defaultdict(dict)
    for r in Q["ts_residual"](spark, SF).collect():
        res[(r.r_name, r.year)][r.cat] = r.n
    totals = {(r.r_name, r.year): r.n_orders for r in Q["agg_sum"](spark, SF).collect()}
    for k, v in res.items():
        if "Rest" in v:
            assert v["Fast"] + v["Rest"] == totals[k]


def test_index_is_100_at_the_base_period(spark):
    first = {}
    for r in Q["win_index100"](spark, SF).collect():
        if r.n_name not in first or r.year < first[r.n_name][0]:
            first[r.n_name] = (r.year, r.revenue_index)
    assert all(v[1] == 100.0 for v in first.values())


def test_spliced_series_equals_old_series_on_old_periods(spark):
    sp = {(r.n_name, r.year): r.v for r in Q["ts_splice"](spark, SF).collect() if r.source == "old"}
    merged = {(r.n_name, r.year): r.v for r in Q["ts_priority_merge"](spark, SF).collect() if r.source == 1}
    # every O-source point that survived the merge is an old point of the splice, with the same value
    for k, v in merged.items():
        assert sp[k] == float(v)
