"""Registered data-quality queries (DQ-*) over the driver tables.

The oracle SQL is written per check from the same contract values (an
independent SQL formulation of each check, not a translation of the
DataFrame code)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..session import scratch_path
from .common import cat
from .registry import query

# Contracts on the driver tables.  year_min / reference_year are parameters
# (the reference uses 1990 and the current year); fixed here so the result
# does not depend on the day the check runs.
CONTRACTS = [
    Q.Contract("lineitem", required_columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipmode"],
               pk=["l_orderkey", "l_linenumber"], non_negative=["l_quantity", "l_discount"],
               year_col="year", year_min=1996, reference_year=1999, not_null=["l_orderkey"],
               accepted_values={"l_returnflag": ["A", "N"]}),
    Q.Contract("customer", required_columns=["c_custkey", "c_acctbal"], pk=["c_custkey"],
               non_negative=["c_acctbal"], year_col=None, unique=["c_custkey", "c_nationkey"]),
    Q.Contract("orders", required_columns=["o_orderkey", "o_orderdate"], pk=["o_orderkey"],
               non_negative=["o_totalprice"], year_col="year", year_min=1996, reference_year=1999,
               not_null=["o_custkey"], accepted_values={"o_orderstatus": ["F", "O", "P"],
                                                        "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}),
]

TABLE_SQL = {
    "lineitem": "(SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem)",
    "customer": "customer",
    "orders": "(SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)",
}

TABLE_COLS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "year"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "year"],
}


def _frames(spark, sf_dir):
    c = cat(spark, sf_dir)
    return {"lineitem": c["lineitem"].withColumn("year", F.year("l_shipdate").cast("int")),
            "customer": c["customer"],
            "orders": c["orders"].withColumn("year", F.year("o_orderdate").cast("int"))}


def _sev(n: str, level: str) -> str:
    return f"CASE WHEN {n} > 0 THEN '{level}' ELSE 'OK' END"


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def contract_sql(c: Q.Contract, checks: set[str] | None = None, table: str | None = None, columns=None) -> list[str]:
    """SQL SELECTs (dataset, check_name, column_name, n_failed, severity) for one contract, on a driver table or
    on ``table`` with ``columns``."""
    t = table or TABLE_SQL[c.dataset]
    cols = columns or TABLE_COLS[c.dataset]
    d = _q(c.dataset)
    out = []

    def want(name):
        return checks is None or name in checks

    if want("required_columns"):
        missing = [x for x in c.required_columns if x not in cols]
        out.append(f"SELECT {d} AS dataset, 'required_columns' AS check_name, "
                   f"{_q(','.join(missing)) if missing else 'CAST(NULL AS VARCHAR)'} AS column_name, "
                   f"CAST({len(missing)} AS BIGINT) AS n_failed, {_q('ERROR' if missing else 'OK')} AS severity")
    if want("rows"):
        out.append(f"SELECT {d}, 'rows', CAST(NULL AS VARCHAR), CAST(COUNT(*) AS BIGINT), 'OK' FROM {t}")
    if want("empty"):
        out.append(f"SELECT {d}, 'empty', CAST(NULL AS VARCHAR), CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT), "
                   f"CASE WHEN COUNT(*) = 0 THEN 'ERROR' ELSE 'OK' END FROM {t}")
    for k in c.pk:
        if want("null_pk"):
            out.append(f"SELECT {d}, 'null_pk', {_q(k)}, CAST(COUNT(*) FILTER (WHERE {k} IS NULL) AS BIGINT), "
                       f"{_sev(f'COUNT(*) FILTER (WHERE {k} IS NULL)', 'WARNING')} FROM {t}")
    for k in c.non_negative:
        if want("negative"):
            out.append(f"SELECT {d}, 'negative', {_q(k)}, CAST(COUNT(*) FILTER (WHERE {k} < 0) AS BIGINT), "
                       f"{_sev(f'COUNT(*) FILTER (WHERE {k} < 0)', 'WARNING')} FROM {t}")
    if c.check_year_range and c.year_col and want("year_range"):
        p = f"{c.year_col} < {c.year_min} OR {c.year_col} > {c.year_max}"
        out.append(f"SELECT {d}, 'year_range', {_q(c.year_col)}, CAST(COUNT(*) FILTER (WHERE {p}) AS BIGINT), "
                   f"{_sev(f'COUNT(*) FILTER (WHERE {p})', 'WARNING')} FROM {t}")
    for k in c.not_null:
        if want("not_null"):
            out.append(f"SELECT {d}, 'not_null', {_q(k)}, CAST(COUNT(*) FILTER (WHERE {k} IS NULL) AS BIGINT), "
                       f"{_sev(f'COUNT(*) FILTER (WHERE {k} IS NULL)', 'ERROR')} FROM {t}")
    for k, vals in c.accepted_values.items():
        if want("accepted_values"):
            lst = ", ".join(_q(v) for v in vals)
            p = f"{k} IS NOT NULL AND {k} NOT IN ({lst})"
            out.append(f"SELECT {d}, 'accepted_values', {_q(k)}, CAST(COUNT(*) FILTER (WHERE {p}) AS BIGINT), "
                       f"{_sev(f'COUNT(*) FILTER (WHERE {p})', 'ERROR')} FROM {t}")
    if c.pk:
        key = ", ".join(c.pk)
        g = f"(SELECT {key}, COUNT(*) AS n FROM {t} GROUP BY {key})"
        if want("dup_rows"):
            out.append(f"SELECT {d}, 'dup_rows', {_q(','.join(c.pk))}, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT), "
                       f"{_sev('COALESCE(SUM(n - 1), 0)', 'WARNING')} FROM {g}")
        if want("dup_groups"):
            out.append(f"SELECT {d}, 'dup_groups', {_q(','.join(c.pk))}, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT), "
                       f"{_sev('COUNT(*) FILTER (WHERE n > 1)', 'WARNING')} FROM {g}")
    for k in c.unique:
        if want("unique"):
            g = f"(SELECT {k}, COUNT(*) AS n FROM {t} WHERE {k} IS NOT NULL GROUP BY {k})"
            out.append(f"SELECT {d}, 'unique', {_q(k)}, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT), "
                       f"{_sev('COUNT(*) FILTER (WHERE n > 1)', 'ERROR')} FROM {g}")
    return out


def all_checks_sql(checks: set[str] | None = None) -> str:
    """Every branch is wrapped so that it names its columns itself."""
    return union_checks([s for c in CONTRACTS for s in contract_sql(c, checks)])


def union_checks(parts: list[str]) -> str:
    cols = "dataset, check_name, column_name, n_failed, severity"
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p}) AS b{i}({cols})" for i, p in enumerate(parts))


def _checks(spark, sf_dir, only=None):
    return Q.check_many(_frames(spark, sf_dir), CONTRACTS, spark, only)


@query("dq_checks", covers=("DQ-1", "DQ-2", "DQ-3", "DQ-4", "DQ-5", "DQ-6", "DQ-8", "DQ-9", "DQ-10", "DQ-12"),
       sql=all_checks_sql())
def dq_checks(spark, sf_dir):
    return _checks(spark, sf_dir)


def _subset(name, checks, covers):
    sql = all_checks_sql(set(checks))

    @query(name, covers=covers, sql=sql)
    def fn(spark, sf_dir):
        return _checks(spark, sf_dir, checks)
    fn.__name__ = name
    return fn


_subset("dq_nulls", ["null_pk"], ("DQ-2",))
_subset("dq_dup_pk", ["dup_rows", "dup_groups"], ("DQ-3",))
_subset("dq_negative", ["negative"], ("DQ-4",))
_subset("dq_year_range", ["year_range"], ("DQ-5",))
_subset("dq_required_columns", ["required_columns"], ("DQ-1",))
_subset("dq_presence", ["rows", "empty"], ("DQ-6",))
_subset("dq_not_null", ["not_null"], ("DQ-8",))
_subset("dq_unique", ["unique"], ("DQ-9",))
_subset("dq_accepted", ["accepted_values"], ("DQ-10",))


@query("dq_status", covers=("DQ-7",), sql=f"""
WITH c AS ({all_checks_sql()})
SELECT dataset,
       CASE MAX(CASE severity WHEN 'ERROR' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)
            WHEN 2 THEN 'ERROR' WHEN 1 THEN 'WARNING' ELSE 'OK' END AS status,
       CAST(COUNT(*) FILTER (WHERE severity = 'WARNING') AS BIGINT) AS n_warnings,
       CAST(COUNT(*) FILTER (WHERE severity = 'ERROR') AS BIGINT) AS n_errors
FROM c GROUP BY dataset
""")
def dq_status(spark, sf_dir):
    return Q.status(_checks(spark, sf_dir))


@query("dq_failing_rows", covers=("DQ-8", "DQ-9", "DQ-10"), sql="""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
""")
def dq_failing_rows(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    return Q.failing_rows(o, "accepted_values", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).select(
        "o_orderkey", "o_orderpriority")


@query("dq_profile", covers=("DQ-13", "AGG-11"), sql="""
SELECT 'orders' AS dataset, CAST(COUNT(*) AS BIGINT) AS rows,
       CAST(COUNT(DISTINCT year(o_orderdate)) AS BIGINT) AS n_years,
       CAST(MIN(year(o_orderdate)) AS INTEGER) AS first_year, CAST(MAX(year(o_orderdate)) AS INTEGER) AS last_year,
       list_sort(list(DISTINCT CAST(year(o_orderdate) AS INTEGER))) AS years
FROM orders
""")
def dq_profile(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int"))
    return Q.profile(o, "orders")


@query("dq_smoke", covers=("DQ-11",), sql="""
SELECT 'orders' AS dataset, (SELECT COUNT(*) FROM orders) > 0 AS has_rows
UNION ALL SELECT 'lineitem', (SELECT COUNT(*) FROM lineitem) > 0
UNION ALL SELECT 'customer', (SELECT COUNT(*) FROM customer) > 0
UNION ALL SELECT 'events', (SELECT COUNT(*) FROM events) > 0
""")
def dq_smoke(spark, sf_dir):
    c = cat(spark, sf_dir)
    return Q.smoke({n: c[n] for n in ["orders", "lineitem", "customer", "events"]})


@query("dq_unreadable", covers=("DQ-6", "DQ-12"), sql="""
SELECT * FROM (VALUES ('broken', 'unreadable', NULL, CAST(1 AS BIGINT), 'ERROR'), ('changed', 'schema', 'c_acctbal', 1, 'ERROR'),
                      ('changed', 'schema', 'c_name', 1, 'ERROR'), ('empty', 'empty', NULL, 1, 'ERROR'), ('good', 'readable', NULL, 0, 'OK'),
                      ('missing', 'missing', NULL, 1, 'ERROR'))
AS t(dataset, check_name, column_name, n_failed, severity) WHERE EXISTS (SELECT 1 FROM customer)
""")
def dq_unreadable(spark, sf_dir):
    """The customers written five times: whole, with a file that isn't Parquet beside them, without rows, with other columns, and
    not at all."""
    cu = cat(spark, sf_dir)["customer"]
    base = scratch_path(spark, "probed")
    for name in ("good", "broken"):
        cu.write.parquet(f"{base}/{name}")
    cu.agg(F.concat_ws(",", F.lit("no footer"), F.count(F.lit(1))).alias("value")).write.mode("append").text(f"{base}/broken")
    cu.limit(0).write.parquet(f"{base}/empty")
    cu.drop("c_name").withColumn("c_acctbal", F.col("c_acctbal").cast("string")).write.parquet(f"{base}/changed")
    names = ("good", "broken", "empty", "changed", "missing")
    return Q.probe(spark, {n: f"{base}/{n}" for n in names}, {n: cu.schema for n in names})
