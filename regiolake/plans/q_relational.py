"""Registered queries for projection, filters, joins, aggregations, windows, sets and sorts
(PRJ-*, FLT-*, JN-*, AGG-*, WIN-*, SET-*, SRT-*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..operators import relational as R
from ..operators import reshape as RS
from ..session import materialize
from .common import cat, customer_geo, geo_orders, GEO_SQL, labels_of
from .registry import query, sql_fixed, sql_money_sum, sql_pct, sql_ratio


def msum(c):
    """Exact money sum reported as double."""
    return F.sum(N.money(c)).cast("double")


W = f"WITH {GEO_SQL.strip()}"

# --------------------------------------------------------------------------- PRJ / FLT

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("prj_headline_slice", covers=("PRJ-1", "PRJ-2", "FLT-1", "FLT-2", "FLT-3", "FLT-7"), sql="""
SELECT o_orderkey AS order_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS category,
       o_totalprice AS amount, 'F' AS source, 2024 AS load_year
FROM orders
WHERE o_orderstatus = 'F'
  AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  AND o_orderpriority != '5-LOW'
  AND year(o_orderdate) <= 2000
""")
def prj_headline_slice(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    return (o.where((F.col("o_orderstatus") == "F")
                    & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
                    & (F.col("o_orderpriority") != "5-LOW")
                    & N.year_between("o_orderdate", last=2000))   # range form: pushed to the Parquet scan
             .select(F.col("o_orderkey").alias("order_id"), F.year("o_orderdate").cast("int").alias("year"),
                     F.col("o_orderpriority").alias("category"), F.col("o_totalprice").alias("amount"),
                     F.lit("F").alias("source"), F.lit(2024).alias("load_year")))


TYPE_RULES = [("prefix", "eco", "budget"), ("prefix", "sma", "compact"), ("prefix", "lar", "bulk"),
              ("contains", "promo", "promo")]


@query("flt_prefix_regex", covers=("FLT-4", "FLT-5", "FN-1", "FN-13"), sql="""
SELECT CASE WHEN lower(p_type) LIKE 'eco%' THEN 'budget'
            WHEN lower(p_type) LIKE 'sma%' THEN 'compact'
            WHEN lower(p_type) LIKE 'lar%' THEN 'bulk'
            WHEN lower(p_type) LIKE '%promo%' THEN 'promo' END AS type_label,
       regexp_matches(p_brand, '^Brand#1\\d$') AS brand_teen,
       CAST(COUNT(*) AS BIGINT) AS n_parts,
       CAST(SUM(CASE WHEN regexp_matches(p_name, '(?i)^(red|blue) ') THEN 1 ELSE 0 END) AS BIGINT) AS n_red_blue
FROM part
WHERE lower(p_type) LIKE 'eco%' OR lower(p_type) LIKE 'sma%' OR lower(p_type) LIKE 'lar%'
   OR lower(p_type) LIKE '%promo%' OR regexp_matches(p_brand, '^Brand#1\\d$')
GROUP BY 1, 2
""")
def flt_prefix_regex(spark, sf_dir):
    p = cat(spark, sf_dir)["part"]
    keep = L.matches_any("p_type", [(k, pat) for k, pat, _ in TYPE_RULES]) | F.col("p_brand").rlike(r"^Brand#1\d$")
    return (p.where(keep)
             .groupBy(L.standardise("p_type", TYPE_RULES).alias("type_label"),
                      F.col("p_brand").rlike(r"^Brand#1\d$").alias("brand_teen"))
             .agg(F.count(F.lit(1)).alias("n_parts"),
                  F.sum(F.col("p_name").rlike(r"(?iu)^(red|blue) ").cast("int")).cast("long").alias("n_red_blue")))


@query("flt_regex_rows", covers=("FLT-5", "FN-13", "FN-16"), sql="""
SELECT o_orderpriority AS category, CAST(regexp_extract(o_orderpriority, '^(\\d+)-', 1) AS INTEGER) AS code,
       CAST(COUNT(*) AS BIGINT) AS n
FROM orders WHERE regexp_matches(o_orderpriority, '^\\d+-') AND regexp_matches(o_orderpriority, '(?i)urgent|high')
GROUP BY 1, 2
""")
def flt_regex_rows(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    return (o.where(F.col("o_orderpriority").rlike(r"^\d+-") & F.col("o_orderpriority").rlike("(?iu)urgent|high"))
             .groupBy(F.col("o_orderpriority").alias("category"),
                      F.regexp_extract("o_orderpriority", r"^(\d+)-", 1).cast("int").alias("code"))
             .agg(F.count(F.lit(1)).alias("n")))


@query("flt_dropna", covers=("FLT-6", "JN-4"), sql="""
WITH p AS (SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_pending FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
     u AS (SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
     j AS (SELECT c.c_custkey, c.c_mktsegment, p.n_pending, u.n_urgent FROM customer c
           LEFT JOIN p ON c.c_custkey = p.o_custkey LEFT JOIN u ON c.c_custkey = u.o_custkey)
SELECT 'any' AS how, c_mktsegment, CAST(COUNT(*) AS BIGINT) AS n FROM j
WHERE n_pending IS NOT NULL AND n_urgent IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'all' AS how, c_mktsegment, CAST(COUNT(*) AS BIGINT) AS n FROM j
WHERE n_pending IS NOT NULL OR n_urgent IS NOT NULL GROUP BY 2
""")
def flt_dropna(spark, sf_dir):
    c = cat(spark, sf_dir)
    o = c["orders"]
    p = o.where(F.col("o_orderstatus") == "P").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_pending"))
    u = o.where(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_urgent"))
    cu = c["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    j = R.left_enrich(cu, (p, ["o_custkey"]), (u, ["o_custkey"]))
    sub = ["n_pending", "n_urgent"]
    a = j.dropna(how="any", subset=sub).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("any").alias("how"), "c_mktsegment", "n")
    b = j.dropna(how="all", subset=sub).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("all").alias("how"), "c_mktsegment", "n")
    return R.union_all([a, b])


@query("flt_latest_year", covers=("FLT-8", "AGG-14", "SRT-1"), sql=f"""
SELECT event_type, CAST(COUNT(*) AS BIGINT) AS n_events, {sql_money_sum('value')} AS total_value
FROM events
WHERE CAST(month(ts) AS INTEGER) = (SELECT MAX(CAST(month(ts) AS INTEGER)) FROM events)
GROUP BY event_type
""")
def flt_latest_year(spark, sf_dir):
    ev = cat(spark, sf_dir)["events"].withColumn("mon", F.month("ts").cast("int"))
    # uncorrelated scalar subquery: planned once as a Subquery and fed to the filter
    latest = ev.select(F.max("mon")).scalar()
    out = (ev.where(F.col("mon") == latest).groupBy("event_type")
             .agg(F.count(F.lit(1)).alias("n_events"), msum("value").alias("total_value")))
    return out.orderBy(F.col("total_value").desc(), "event_type")


@query("flt_latest_order_year", covers=("FLT-8", "AGG-14", "SRT-1"), sql=f"""
SELECT o_orderpriority AS category, {sql_money_sum('o_totalprice')} AS total
FROM orders WHERE year(o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders)
GROUP BY 1
""")
def flt_latest_order_year(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("yr", F.year("o_orderdate"))
    mx = o.agg(F.max("yr").alias("mx"))
    # one-row side of a proven size: broadcast join on the scalar
    f = o.join(F.broadcast(mx), o["yr"] == mx["mx"], "left_semi")
    return (f.groupBy(F.col("o_orderpriority").alias("category")).agg(msum("o_totalprice").alias("total"))
             .orderBy(F.col("total").desc(), "category"))


# --------------------------------------------------------------------------- JN

@query("jn_inner_keys", covers=("JN-1", "JN-10", "AGG-1"), sql=f"""
{W},
a AS (SELECT r_name, yr, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1, 2),
b AS (SELECT r_name, yr, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS customers FROM geo
      WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT a.r_name, a.yr AS year, a.revenue, b.customers,
       {sql_fixed(sql_ratio('a.revenue', 'b.customers'), 2)} AS revenue_per_customer
FROM a JOIN b ON a.r_name = b.r_name AND a.yr = b.yr
""")
def jn_inner_keys(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "yr").agg(msum("o_totalprice").alias("revenue"))
    b = (g.where(F.col("o_orderstatus") == "F").select("r_name", "yr", "o_custkey").distinct()
          .groupBy("r_name", "yr").agg(F.count(F.lit(1)).alias("customers")))
    return (a.join(b, on=["r_name", "yr"]).select(
        "r_name", F.col("yr").alias("year"), "revenue", "customers",
        N.fixed(N.safe_ratio("revenue", "customers"), 2).alias("revenue_per_customer")))


@query("jn_using3", covers=("JN-3",), sql=f"""
{W},
a AS (SELECT r_name, yr, CAST(COUNT(*) AS BIGINT) AS n_orders FROM geo GROUP BY 1, 2),
b AS (SELECT g.r_name, g.yr, {sql_money_sum('l.l_extendedprice')} AS line_revenue
      FROM lineitem l JOIN geo g ON l.l_orderkey = g.o_orderkey GROUP BY 1, 2),
c AS (SELECT r_name, yr, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS n_customers FROM geo GROUP BY 1, 2)
SELECT r_name, yr AS year, n_orders, line_revenue, n_customers
FROM a JOIN b USING (r_name, yr) JOIN c USING (r_name, yr)
""")
def jn_using3(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = geo_orders(c)
    # one row per customer first, so that orders and customers come from one aggregate of the star
    a = (g.groupBy("r_name", "yr", "o_custkey").agg(F.count(F.lit(1)).alias("n")).groupBy("r_name", "yr")
          .agg(F.sum("n").cast("long").alias("n_orders"), F.count("o_custkey").alias("n_customers")))
    # lineitem is pre-aggregated per order before it meets the order dimension
    li = c["lineitem"].groupBy("l_orderkey").agg(F.sum(N.money("l_extendedprice")).alias("rev"))
    b = (li.join(g.select(F.col("o_orderkey").alias("l_orderkey"), "r_name", "yr"), on="l_orderkey")
           .groupBy("r_name", "yr").agg(F.sum("rev").cast("double").alias("line_revenue")))
    return (a.join(b, on=["r_name", "yr"])
             .select("r_name", F.col("yr").alias("year"), "n_orders", "line_revenue", "n_customers"))


@query("jn_left_chain", covers=("JN-4", "JN-10", "FN-8"), sql=f"""
{W},
base AS (SELECT r_name, yr, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1, 2),
reg AS (SELECT r.r_name, CAST(COUNT(*) AS BIGINT) AS region_customers
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        GROUP BY 1),
yt AS (SELECT yr, {sql_money_sum('o_totalprice')} AS year_revenue FROM geo WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT base.r_name, base.yr AS year, base.revenue, reg.region_customers, yt.year_revenue,
       {sql_pct('base.revenue', 'yt.year_revenue')} AS share_of_f_year_pct
FROM base LEFT JOIN reg ON base.r_name = reg.r_name LEFT JOIN yt ON base.yr = yt.yr
""")
def jn_left_chain(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = geo_orders(c)
    base = g.groupBy("r_name", "yr").agg(msum("o_totalprice").alias("revenue"))
    reg = (c["customer"].select("c_custkey")
           .join(customer_geo(c), on="c_custkey").groupBy("r_name")
           .agg(F.count(F.lit(1)).alias("region_customers")))
    yt = g.where(F.col("o_orderstatus") == "F").groupBy("yr").agg(msum("o_totalprice").alias("year_revenue"))
    j = R.left_enrich(base, (reg, ["r_name"]), (yt, ["yr"]))
    return j.select("r_name", F.col("yr").alias("year"), "revenue", "region_customers", "year_revenue",
                    N.pct("revenue", "year_revenue").alias("share_of_f_year_pct"))


@query("jn_left_default", covers=("JN-5", "FN-19"), sql=f"""
{W},
base AS (SELECT n_name, yr, CAST(COUNT(*) AS BIGINT) AS n_orders FROM geo GROUP BY 1, 2),
ratio AS (SELECT n_name, AVG(CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS DOUBLE)) AS f_ratio
          FROM geo WHERE o_orderpriority = '1-URGENT' GROUP BY 1 HAVING COUNT(*) >= 3)
SELECT base.n_name, base.yr AS year, base.n_orders,
       {sql_fixed('COALESCE(ratio.f_ratio, 1)', 6)} AS f_ratio,
       {sql_fixed('base.n_orders * COALESCE(ratio.f_ratio, 1)', 2)} AS scaled_orders
FROM base LEFT JOIN ratio ON base.n_name = ratio.n_name
""")
def jn_left_default(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    base = g.groupBy("n_name", "yr").agg(F.count(F.lit(1)).alias("n_orders"))
    ratio = (g.where(F.col("o_orderpriority") == "1-URGENT")
              .groupBy("n_name")
              .agg(F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("nf"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= 3)
              .select("n_name", N.exact_mean("nf", "n").alias("f_ratio")))
    j = R.left_default(base, ratio, ["n_name"], "f_ratio", 1.0)
    return j.select("n_name", F.col("yr").alias("year"), "n_orders", N.fixed("f_ratio", 6).alias("f_ratio"),
                    N.fixed(F.col("n_orders") * F.col("f_ratio"), 2).alias("scaled_orders"))


@query("jn_anti_composite", covers=("JN-6",), sql=f"""
{W}
SELECT n_name, yr AS year, mon AS month, CAST(COUNT(*) AS BIGINT) AS n_f_orders
FROM geo f
WHERE o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM geo o WHERE o.o_orderstatus = 'O' AND o.n_name = f.n_name
                  AND o.yr = f.yr AND o.mon = f.mon)
GROUP BY 1, 2, 3
""")
def jn_anti_composite(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    keys = ["n_name", "yr", "mon"]
    f = g.where(F.col("o_orderstatus") == "F")
    o = g.where(F.col("o_orderstatus") == "O").select(*keys).distinct()
    return (R.not_covered(f, o, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_f_orders"))
             .select("n_name", F.col("yr").alias("year"), F.col("mon").alias("month"), "n_f_orders"))


@query("jn_anti_on_join", covers=("JN-7",), sql=f"""
{W},
op AS (SELECT DISTINCT o.n_name, o.yr, o.mon FROM geo o JOIN geo p
       ON o.n_name = p.n_name AND o.yr = p.yr AND o.mon = p.mon
       WHERE o.o_orderstatus = 'O' AND p.o_orderstatus = 'P')
SELECT n_name, yr AS year, mon AS month, CAST(COUNT(*) AS BIGINT) AS n_f_orders
FROM geo f
WHERE o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM op WHERE op.n_name = f.n_name AND op.yr = f.yr AND op.mon = f.mon)
GROUP BY 1, 2, 3
""")
def jn_anti_on_join(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    keys = ["n_name", "yr", "mon"]
    # the coverage is itself a join result; joining distinct keys keeps it key-sized
    o = g.where(F.col("o_orderstatus") == "O").select(*keys).distinct()
    p = g.where(F.col("o_orderstatus") == "P").select(*keys).distinct()
    op = o.join(p, on=keys)
    f = g.where(F.col("o_orderstatus") == "F")
    return (R.not_covered(f, op, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_f_orders"))
             .select("n_name", F.col("yr").alias("year"), F.col("mon").alias("month"), "n_f_orders"))


@query("jn_self_residual", covers=("JN-8", "FN-11"), sql=f"""
{W},
agg AS (SELECT r_name, yr, 'Total' AS cat, CAST(COUNT(*) AS BIGINT) AS n FROM geo GROUP BY 1, 2
        UNION ALL
        SELECT r_name, yr, 'Urgent' AS cat, CAST(COUNT(*) AS BIGINT) AS n FROM geo
        WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)
SELECT t.r_name, t.yr AS year, t.n AS total, u.n AS urgent, t.n - u.n AS rest
FROM agg t JOIN agg u ON t.r_name = u.r_name AND t.yr = u.yr AND u.cat = 'Urgent'
WHERE t.cat = 'Total'
""")
def jn_self_residual(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    # hand-rewritten self-join: one conditional aggregation, one shuffle
    a = g.groupBy("r_name", "yr").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("long")).alias("urgent"))
    return (a.where(F.col("urgent") > 0)
             .select("r_name", F.col("yr").alias("year"), "total", "urgent",
                     N.complement("total", "urgent").alias("rest")))


PRIORITY_GROUP = {"1-URGENT": "Fast", "2-HIGH": "Fast", "3-MEDIUM": "Normal"}


@query("jn_lookup_default", covers=("JN-11", "FN-2"), sql="""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Fast' WHEN '2-HIGH' THEN 'Fast'
                            WHEN '3-MEDIUM' THEN 'Normal' ELSE 'Others' END AS priority_group,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS n
FROM orders GROUP BY 1, 2
""")
def jn_lookup_default(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    return (o.groupBy(L.lookup("o_orderpriority", PRIORITY_GROUP, "Others").alias("priority_group"),
                      F.year("o_orderdate").cast("int").alias("year"))
             .agg(F.count(F.lit(1)).alias("n")))


@query("jn_lookup_inner", covers=("JN-11", "JN-2"), sql="""
SELECT s.s_suppkey, n.n_name, s.s_acctbal FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
WHERE n.n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))
""")
def jn_lookup_inner(spark, sf_dir):
    c = cat(spark, sf_dir)
    reg = c["region"].where(F.col("r_name").isin("ASIA", "EUROPE")).select(F.col("r_regionkey").alias("n_regionkey"))
    nr = c["nation"].join(F.broadcast(reg), on="n_regionkey", how="left_semi")
    # a missing dictionary key drops the row (inner join)
    return (c["supplier"].join(F.broadcast(nr.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")),
                               on="s_nationkey")
             .select("s_suppkey", "n_name", "s_acctbal"))


# --------------------------------------------------------------------------- AGG

@query("agg_sum", covers=("AGG-1",), sql=f"""
{W}
SELECT r_name, yr AS year, CAST(COUNT(*) AS BIGINT) AS n_orders, {sql_money_sum('o_totalprice')} AS revenue
FROM geo GROUP BY 1, 2
""")
def agg_sum(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    return g.groupBy("r_name", F.col("yr").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"),
                                                             msum("o_totalprice").alias("revenue"))


@query("agg_avg", covers=("AGG-2", "FN-20"), sql=f"""
{W}
SELECT r_name, yr AS year,
       {sql_fixed('CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(o_totalprice) AS DOUBLE)', 2)} AS avg_price
FROM geo GROUP BY 1, 2
""")
def agg_avg(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "yr").agg(F.sum(N.money("o_totalprice")).alias("s"), F.count("o_totalprice").alias("n"))
    return a.select("r_name", F.col("yr").alias("year"), N.fixed(N.exact_mean("s", "n"), 2).alias("avg_price"))


@query("agg_pivot_sum0", covers=("AGG-3", "FN-19"), sql=f"""
{W}
SELECT r_name, yr AS year,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS status_f,
       CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS status_o,
       CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS status_p,
       CAST(SUM(CASE WHEN o_orderstatus = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS status_x
FROM geo GROUP BY 1, 2
""")
def agg_pivot_sum0(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir)).withColumn("one", F.lit(1))
    p = R.conditional_pivot(g, ["r_name", "yr"], "o_orderstatus", "one",
                            {"status_f": "F", "status_o": "O", "status_p": "P", "status_x": "X"},
                            agg="sum", else_value=0)
    return p.select("r_name", F.col("yr").alias("year"),
                    *[F.col(c).cast("long").alias(c) for c in ["status_f", "status_o", "status_p", "status_x"]])


@query("agg_pivot_max", covers=("AGG-4",), sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
       MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS max_urgent,
       MAX(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS max_low,
       MAX(CASE WHEN o_orderpriority = '9-NONE' THEN o_totalprice END) AS max_none
FROM orders GROUP BY 1
""")
def agg_pivot_max(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int"))
    return R.conditional_pivot(o, ["year"], "o_orderpriority", "o_totalprice",
                               {"max_urgent": "1-URGENT", "max_low": "5-LOW", "max_none": "9-NONE"}, agg="max")


@query("agg_pivot_avg", covers=("AGG-5", "FN-20"), sql=f"""
{W}
SELECT r_name, yr AS year,
       {sql_fixed("SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) / CAST(COUNT(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS DOUBLE)", 1)} AS avg_f,
       {sql_fixed("SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) / CAST(COUNT(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS DOUBLE)", 1)} AS avg_o
FROM geo GROUP BY 1, 2
""")
def agg_pivot_avg(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir)).withColumn("m", N.money("o_totalprice"))
    # sums and counts of one aggregate
    j = g.groupBy("r_name", "yr").agg(*[f(F.when(F.col("o_orderstatus") == v, F.col("m"))).alias(k + v.lower())
                                        for k, f in (("s", F.sum), ("n", F.count)) for v in ("F", "O")])
    return j.select("r_name", F.col("yr").alias("year"),
                    N.fixed(N.exact_mean("sf", F.when(F.col("nf") > 0, F.col("nf"))), 1).alias("avg_f"),
                    N.fixed(N.exact_mean("so", F.when(F.col("no") > 0, F.col("no"))), 1).alias("avg_o"))


@query("agg_cond_membership", covers=("AGG-6", "FLT-2", "FN-6"), sql="""
SELECT c_mktsegment AS segment,
       CAST(COALESCE(SUM(CASE WHEN c_nationkey NOT IN (0, 1, 2, 3) THEN CAST(c_acctbal AS DECIMAL(18,2)) ELSE 0 END), 0) AS BIGINT) AS other_balance,
       CAST(COALESCE(SUM(CASE WHEN c_nationkey NOT IN (0, 1, 2, 3) THEN 1 ELSE 0 END), 0) AS BIGINT) AS other_customers
FROM customer GROUP BY 1
""")
def agg_cond_membership(spark, sf_dir):
    cu = cat(spark, sf_dir)["customer"]
    other = ~F.col("c_nationkey").isin(0, 1, 2, 3)
    # sum in exact decimal so the final integer cast does not depend on summation order
    return cu.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        N.round_to_long(F.coalesce(F.sum(F.when(other, N.money("c_acctbal")).otherwise(F.lit(0))), F.lit(0)))
        .alias("other_balance"),
        F.coalesce(F.sum(F.when(other, 1).otherwise(0)), F.lit(0)).cast("long").alias("other_customers"))


# month names as they appear in the composition headers (8 = agosto maps to the default, N14)
_MONTH_NAMES = ["enero", "feb.", "marzo", "abril", "mayo", "junio", "julio", "agosto", "sept.", "oct.", "nov.", "dic."]


@query("agg_latest_snapshot", covers=("AGG-7", "JN-9", "FN-3"), sql="""
WITH m AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority, o_orderkey,
         CASE lower(trim(list_extract(['enero','feb.','marzo','abril','mayo','junio','julio','agosto','sept.','oct.','nov.','dic.'], month(o_orderdate))))
              WHEN 'enero' THEN 1 WHEN 'ene.' THEN 1 WHEN 'feb.' THEN 2 WHEN 'febr.' THEN 2 WHEN 'marzo' THEN 3
              WHEN 'abril' THEN 4 WHEN 'mayo' THEN 5 WHEN 'junio' THEN 6 WHEN 'julio' THEN 7 WHEN 'sept.' THEN 9
              WHEN 'oct.' THEN 10 WHEN 'nov.' THEN 11 WHEN 'dic.' THEN 12 ELSE 6 END AS month_num
  FROM orders),
l AS (SELECT year, MAX(month_num) AS mx FROM m GROUP BY year)
SELECT m.year, m.month_num, m.o_orderpriority AS category, CAST(COUNT(*) AS BIGINT) AS n_orders
FROM m JOIN l ON m.year = l.year AND m.month_num = l.mx
GROUP BY 1, 2, 3
""")
def agg_latest_snapshot(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    names = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    m = (o.withColumn("year", F.year("o_orderdate").cast("int"))
          .withColumn("month_name", F.element_at(names, F.month("o_orderdate")))
          .withColumn("month_num", L.month_number("month_name")))
    snap = R.latest_snapshot(m, ["year"], "month_num")
    return snap.groupBy("year", "month_num", F.col("o_orderpriority").alias("category")).agg(
        F.count(F.lit(1)).alias("n_orders"))


SEGMENT_BUCKETS = [("Industry", ["MACHINERY", "AUTOMOBILE"]), ("Consumer", ["HOUSEHOLD", "FURNITURE"])]


@query("agg_bucket_group", covers=("AGG-8", "FN-2"), sql=f"""
{W}
SELECT yr AS year,
       CASE WHEN c.c_mktsegment IN ('MACHINERY', 'AUTOMOBILE') THEN 'Industry'
            WHEN c.c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Consumer' ELSE 'Other' END AS bucket,
       {sql_money_sum('o_totalprice')} AS revenue
FROM geo JOIN customer c ON geo.o_custkey = c.c_custkey
GROUP BY 1, 2
""")
def agg_bucket_group(spark, sf_dir):
    c = cat(spark, sf_dir)
    o = c["orders"].withColumn("yr", F.year("o_orderdate").cast("int"))
    cu = c["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment",
                              F.col("c_nationkey"))
    # geo in the oracle also requires the customer's nation to exist; keep the same inner joins
    nat = c["nation"].select(F.col("n_nationkey").alias("c_nationkey"))
    j = o.join(cu, on="o_custkey").join(F.broadcast(nat), on="c_nationkey")
    return (j.withColumn("bucket", L.bucket("c_mktsegment", SEGMENT_BUCKETS, "Other"))
             .groupBy(F.col("yr").alias("year"), "bucket").agg(msum("o_totalprice").alias("revenue")))


@query("agg_share_of_total", covers=("AGG-9", "SET-1", "FN-7"), sql=f"""
WITH p AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS cat, {sql_money_sum('o_totalprice')} AS v
  FROM orders GROUP BY 1, 2
  UNION ALL
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Total' AS cat, {sql_money_sum('o_totalprice')} AS v
  FROM orders GROUP BY 1)
SELECT year,
       {sql_fixed(sql_ratio("MAX(CASE WHEN cat = '1-URGENT' THEN v END)", "MAX(CASE WHEN cat = 'Total' THEN v END)") + ' * 100.0', 2)} AS pct_urgent,
       {sql_fixed(sql_ratio("MAX(CASE WHEN cat = '5-LOW' THEN v END)", "MAX(CASE WHEN cat = 'Total' THEN v END)") + ' * 100.0', 2)} AS pct_low
FROM p GROUP BY year
""")
def agg_share_of_total(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int"))
    per = o.groupBy("year", F.col("o_orderpriority").alias("cat")).agg(msum("o_totalprice").alias("v"))
    tot = per.groupBy("year").agg(F.lit("Total").alias("cat"), F.sum(F.col("v").cast("decimal(28,2)")).cast("double").alias("v"))
    p = R.union_all([per, tot.select("year", "cat", "v")])
    mx = R.conditional_pivot(p, ["year"], "cat", "v", {"u": "1-URGENT", "l": "5-LOW", "t": "Total"}, agg="max")
    return mx.select("year", N.pct("u", "t").alias("pct_urgent"), N.pct("l", "t").alias("pct_low"))


@query("agg_global", covers=("AGG-10",), sql=f"""
SELECT CAST(COUNT(*) AS BIGINT) AS n, {sql_money_sum('o_totalprice')} AS total,
       MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price,
       {sql_fixed('CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(o_totalprice) AS DOUBLE)', 4)} AS mean_price
FROM orders
""")
def agg_global(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    a = o.agg(F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("s"),
              F.count("o_totalprice").alias("k"), F.min("o_totalprice").alias("min_price"),
              F.max("o_totalprice").alias("max_price"))
    return a.select("n", F.col("s").cast("double").alias("total"), "min_price", "max_price",
                    N.fixed(N.exact_mean("s", "k"), 4).alias("mean_price"))


@query("agg_nunique", covers=("AGG-11", "DQ-13"), sql="""
SELECT CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS n_customers,
       CAST(COUNT(DISTINCT o_orderstatus) AS BIGINT) AS n_status,
       CAST(COUNT(DISTINCT o_orderpriority) AS BIGINT) AS n_priority,
       CAST(COUNT(DISTINCT year(o_orderdate)) AS BIGINT) AS n_years
FROM orders
""")
def agg_nunique(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    return o.agg(F.countDistinct("o_custkey").alias("n_customers"),
                 F.countDistinct("o_orderstatus").alias("n_status"),
                 F.countDistinct("o_orderpriority").alias("n_priority"),
                 F.countDistinct(F.year("o_orderdate")).alias("n_years"))


@query("agg_first_pivot", covers=("AGG-12", "RSH-3"), sql=f"""
{W},
f AS (SELECT n_name, yr, arg_min(o_orderstatus, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 20, '0')) AS s
      FROM geo WHERE o_orderstatus IS NOT NULL GROUP BY 1, 2)
SELECT n_name, string_agg(yr || '=' || s, ' ' ORDER BY yr) AS cells, CAST(COUNT(*) AS INTEGER) AS n_cells FROM f GROUP BY 1
""")
def agg_first_pivot(spark, sf_dir):
    """The first status by date that isn't NULL, one cell a year."""
    g = geo_orders(cat(spark, sf_dir))
    p = RS.pivot_map(g, ["n_name"], "yr", "o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    return p.select("n_name", _cells_text().alias("cells"), F.size("cells").alias("n_cells"))


def _cells_text():
    return F.array_join(F.transform(F.map_entries("cells"), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")


@query("agg_dup_groups", covers=("AGG-13", "DQ-3"), sql="""
WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(COUNT(*) AS BIGINT) AS n_groups,
       CAST(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS dup_groups,
       CAST(SUM(n - 1) AS BIGINT) AS surplus_rows
FROM g
""")
def agg_dup_groups(spark, sf_dir):
    li = cat(spark, sf_dir)["lineitem"]
    g = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("n") > 1).alias("dup_groups"),
                 F.sum(F.col("n") - 1).cast("long").alias("surplus_rows"))


# --------------------------------------------------------------------------- WIN

@query("win_group_total", covers=("WIN-1", "FN-8"), sql=f"""
{W},
a AS (SELECT r_name, yr, o_orderpriority, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1, 2, 3)
SELECT r_name, yr AS year, o_orderpriority AS category, revenue,
       CAST(SUM(CAST(revenue AS DECIMAL(18,2))) OVER (PARTITION BY r_name, yr) AS DOUBLE) AS group_total,
       {sql_pct('revenue', 'SUM(CAST(revenue AS DECIMAL(18,2))) OVER (PARTITION BY r_name, yr)')} AS share_pct
FROM a
""")
def win_group_total(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "yr", "o_orderpriority").agg(F.sum(N.money("o_totalprice")).alias("rev"))
    t = R.group_total(a, ["r_name", "yr"], "rev", "tot")
    return t.select("r_name", F.col("yr").alias("year"), F.col("o_orderpriority").alias("category"),
                    F.col("rev").cast("double").alias("revenue"), F.col("tot").cast("double").alias("group_total"),
                    N.pct("rev", "tot").alias("share_pct"))


@query("win_top1_share", covers=("WIN-2", "WIN-1", "FN-8"), sql=f"""
{W},
a AS (SELECT r_name, yr, o_orderpriority, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue FROM geo GROUP BY 1, 2, 3),
r AS (SELECT *, SUM(revenue) OVER (PARTITION BY r_name, yr) AS tot,
             ROW_NUMBER() OVER (PARTITION BY r_name, yr ORDER BY revenue DESC NULLS LAST, o_orderpriority) AS rk
      FROM a)
SELECT r_name, yr AS year, o_orderpriority AS top_category, {sql_pct('revenue', 'tot')} AS top_share_pct
FROM r WHERE rk = 1
""")
def win_top1_share(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "yr", "o_orderpriority").agg(F.sum(N.money("o_totalprice")).alias("rev"))
    t = R.group_total(a, ["r_name", "yr"], "rev", "tot")
    top = R.top1_per_group(t, ["r_name", "yr"], "rev", ["o_orderpriority", "rev", "tot"],
                           tie_break=["o_orderpriority"])
    return top.select("r_name", F.col("yr").alias("year"), F.col("o_orderpriority").alias("top_category"),
                      N.pct("rev", "tot").alias("top_share_pct"))


@query("win_ffill", covers=("WIN-3",), sql="""
SELECT conv_id, turn, role,
       last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS)
         OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_user_turn
FROM conversations
""")
def win_ffill(spark, sf_dir):
    cv = cat(spark, sf_dir)["conversations"].select("conv_id", "turn", "role")
    x = cv.withColumn("last_user_turn", F.when(F.col("role") == "user", F.col("turn")))
    # blocked prefix scan: parallel even when one conversation is huge
    return R.forward_fill(x, ["conv_id"], "turn", ["last_user_turn"], block=64)


@query("win_carry_down", covers=("WIN-4", "WIN-3"), sql="""
WITH x AS (
  SELECT conv_id, turn, role, length(text) AS n_chars,
         last_value(CASE WHEN role IN ('user', 'system') THEN turn END IGNORE NULLS)
           OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS parent_turn
  FROM conversations)
SELECT conv_id, turn, n_chars, parent_turn FROM x WHERE role NOT IN ('user', 'system')
""")
def win_carry_down(spark, sf_dir):
    cv = cat(spark, sf_dir)["conversations"]
    x = cv.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars"))
    is_header = F.col("role").isin("user", "system")
    out = R.carry_down(x, ["conv_id"], "turn", is_header, F.col("turn"), name="parent_turn", block=64)
    return out.select("conv_id", "turn", "n_chars", "parent_turn")


def _nation_year_revenue(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    return g.groupBy("n_name", "yr").agg(msum("o_totalprice").alias("revenue"))


NYR_SQL = f"{W},\nny AS (SELECT n_name, yr, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1, 2)"


@query("win_growth", covers=("WIN-5",), sql=f"""
{NYR_SQL}
SELECT n_name, yr AS year, revenue,
       {sql_fixed('(revenue - LAG(revenue) OVER (PARTITION BY n_name ORDER BY yr)) / NULLIF(LAG(revenue) OVER (PARTITION BY n_name ORDER BY yr), 0)', 6)} AS revenue_growth
FROM ny
""")
def win_growth(spark, sf_dir):
    ny = _nation_year_revenue(spark, sf_dir)
    g = R.pct_change(ny, ["n_name"], "yr", "revenue")
    return g.select("n_name", F.col("yr").alias("year"), "revenue",
                    N.fixed("revenue_growth", 6).alias("revenue_growth"))


@query("win_index100", covers=("WIN-6",), sql=f"""
{NYR_SQL}
SELECT n_name, yr AS year,
       {sql_fixed('revenue / NULLIF(FIRST_VALUE(revenue) OVER (PARTITION BY n_name ORDER BY yr), 0) * 100.0', 4)} AS revenue_index
FROM ny
""")
def win_index100(spark, sf_dir):
    ny = _nation_year_revenue(spark, sf_dir)
    i = R.index_base100(ny, ["n_name"], "yr", "revenue")
    return i.select("n_name", F.col("yr").alias("year"), N.fixed("revenue_index", 4).alias("revenue_index"))


@query("win_first_per_key", covers=("WIN-7",), sql="""
SELECT o_custkey, o_orderkey AS first_order, o_orderdate AS first_date, o_totalprice AS first_price
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def win_first_per_key(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    f = R.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return f.select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderdate").alias("first_date"),
                    F.col("o_totalprice").alias("first_price"))


@query("win_latest_kpi", covers=("WIN-8", "TS-11"), sql=f"""
{NYR_SQL}
SELECT n_name, MIN(yr) AS first_yr, MAX(yr) AS latest_yr,
       arg_min(revenue, yr) AS first_revenue, arg_max(revenue, yr) AS latest_revenue,
       CAST(arg_max(CAST(revenue AS DECIMAL(18,2)), yr) - arg_min(CAST(revenue AS DECIMAL(18,2)), yr) AS DOUBLE) AS delta_revenue
FROM ny GROUP BY n_name
""")
def win_latest_kpi(spark, sf_dir):
    ny = _nation_year_revenue(spark, sf_dir).withColumn("revenue", N.money("revenue"))
    k = R.latest_values(ny, ["n_name"], "yr", ["revenue"])
    return k.select("n_name", "first_yr", "latest_yr",
                    *[F.col(c).cast("double").alias(c) for c in ["first_revenue", "latest_revenue", "delta_revenue"]])


# --------------------------------------------------------------------------- SET / SRT

@query("set_union_all", covers=("SET-1", "SET-2"), sql=f"""
{W}
SELECT 'orders' AS source, r_name, yr AS year, CAST(COUNT(*) AS BIGINT) AS n, NULL::DOUBLE AS balance FROM geo GROUP BY 2, 3
UNION ALL
SELECT 'customers' AS source, r.r_name, NULL::INTEGER AS year, CAST(COUNT(*) AS BIGINT) AS n,
       {sql_money_sum('c.c_acctbal')} AS balance
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 2
""")
def set_union_all(spark, sf_dir):
    c = cat(spark, sf_dir)
    a = (geo_orders(c).groupBy("r_name", F.col("yr").alias("year")).agg(F.count(F.lit(1)).alias("n"))
         .withColumn("source", F.lit("orders")))
    b = (c["customer"].select("c_custkey", "c_acctbal").join(customer_geo(c), on="c_custkey")
         .groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), msum("c_acctbal").alias("balance"))
         .withColumn("source", F.lit("customers")))
    return R.union_all([a, b], allow_missing=True).select("source", "r_name", "year", "n", "balance")


@query("srt_multi_limit", covers=("SRT-1", "SRT-2"), sql=f"""
{NYR_SQL}
SELECT n_name, yr AS year, revenue FROM ny ORDER BY revenue DESC, n_name ASC, yr ASC LIMIT 10
""")
def srt_multi_limit(spark, sf_dir):
    ny = _nation_year_revenue(spark, sf_dir)
    # top-k report: the limit is the feature; Spark plans TakeOrderedAndProject (per-partition top-k)
    return (ny.orderBy(F.col("revenue").desc(), F.col("n_name").asc(), F.col("yr").asc()).limit(10)
              .select("n_name", F.col("yr").alias("year"), "revenue"))
