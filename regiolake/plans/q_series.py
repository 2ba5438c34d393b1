"""Registered queries for the series analytics (TS-*) on nation/region x year series.

Sources for the merge/splice family (SURVEY §7.4): F orders up to 1997, O orders
up to 1999, P orders for all years, each counted per (nation, year).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..operators import series as S
from ..session import materialize
from .common import GEO_SQL, cat, geo_orders
from .q_relational import PRIORITY_GROUP, msum
from .registry import query, sql_fixed, sql_money_sum, sql_ratio

W = f"WITH {GEO_SQL.strip()}"

SRC_SQL = f"""{W},
s1 AS (SELECT n_name, yr, CAST(COUNT(*) AS BIGINT) AS v FROM geo WHERE o_orderstatus = 'F' AND yr <= 1997 GROUP BY 1, 2),
s2 AS (SELECT n_name, yr, CAST(COUNT(*) AS BIGINT) AS v FROM geo WHERE o_orderstatus = 'O' AND yr <= 1999 GROUP BY 1, 2),
s3 AS (SELECT n_name, yr, CAST(COUNT(*) AS BIGINT) AS v FROM geo WHERE o_orderstatus = 'P' GROUP BY 1, 2)"""


def _sources(spark, sf_dir):
    """The three sources, from one pass over the order star: the (nation, year, status)
    counts are written once and each source is a filtered read of that table."""
    g = geo_orders(cat(spark, sf_dir))
    base = materialize(g.groupBy("n_name", "yr", "o_orderstatus").agg(F.count(F.lit(1)).alias("v")), "nys_counts")

    def src(status, max_yr=None):
        d = base.where(F.col("o_orderstatus") == status)
        if max_yr is not None:
            d = d.where(F.col("yr") <= max_yr)
        return d.select("n_name", "yr", "v")
    return src("F", 1997), src("O", 1999), src("P")


@query("ts_priority_merge", covers=("TS-1", "JN-6", "SET-1"), sql=f"""
{SRC_SQL}
SELECT n_name, yr AS year, v, 0 AS source FROM s1
UNION ALL
SELECT n_name, yr, v, 1 FROM s2 WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.n_name = s2.n_name AND s1.yr = s2.yr)
UNION ALL
SELECT n_name, yr, v, 2 FROM s3
WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.n_name = s3.n_name AND s1.yr = s3.yr)
  AND NOT EXISTS (SELECT 1 FROM s2 WHERE s2.n_name = s3.n_name AND s2.yr = s3.yr)
""")
def ts_priority_merge(spark, sf_dir):
    s1, s2, s3 = _sources(spark, sf_dir)
    m = S.priority_merge([(s1, None), (s2, None), (s3, None)], ["n_name", "yr"], priority_col="source")
    return m.select("n_name", F.col("yr").alias("year"), "v", "source")


RATIO_SQL = f"""
ratio AS (SELECT s2.n_name, AVG(CAST(s2.v AS DOUBLE) / NULLIF(CAST(s3.v AS DOUBLE), 0)) AS ratio
          FROM s2 JOIN s3 ON s2.n_name = s3.n_name AND s2.yr = s3.yr GROUP BY s2.n_name)"""


@query("ts_chain_ratio", covers=("TS-2", "JN-1"), sql=f"""
{SRC_SQL},
{RATIO_SQL.strip()}
SELECT n_name, {sql_fixed('ratio', 6)} AS ratio FROM ratio
""")
def ts_chain_ratio(spark, sf_dir):
    _, s2, s3 = _sources(spark, sf_dir)
    r = S.chain_ratio(s2, s3, ["n_name", "yr"], ["n_name"], "v", "v")
    return r.select("n_name", N.fixed("ratio", 6).alias("ratio"))


@query("ts_splice", covers=("TS-3", "JN-5", "JN-6", "SET-1"), sql=f"""
{SRC_SQL},
{RATIO_SQL.strip()}
SELECT n_name, yr AS year, CAST(v AS DOUBLE) AS v, 'old' AS source FROM s2
UNION ALL
SELECT s3.n_name, s3.yr, {sql_fixed('s3.v * COALESCE(ratio.ratio, 1)', 4)}, 'new' FROM s3
LEFT JOIN ratio ON s3.n_name = ratio.n_name
WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.n_name = s3.n_name AND s2.yr = s3.yr)
  AND NOT EXISTS (SELECT 1 FROM s1 WHERE s1.n_name = s3.n_name AND s1.yr = s3.yr)
""")
def ts_splice(spark, sf_dir):
    s1, s2, s3 = _sources(spark, sf_dir)
    r = S.chain_ratio(s2, s3, ["n_name", "yr"], ["n_name"], "v", "v")
    sp = S.splice(s2.withColumn("v", F.col("v").cast("double")), s3, r, ["n_name", "yr"], ["n_name"], "v",
                  covered=[s1])
    return sp.select("n_name", F.col("yr").alias("year"),
                     F.when(F.col("source") == "new", N.fixed("v", 4)).otherwise(F.col("v")).alias("v"), "source")


@query("ts_splice_after", covers=("TS-3", "TS-2"), sql=f"""
{SRC_SQL},
ratio AS (SELECT AVG(CAST(s2.v AS DOUBLE) / NULLIF(CAST(s3.v AS DOUBLE), 0)) AS ratio
          FROM s2 JOIN s3 ON s2.n_name = s3.n_name AND s2.yr = s3.yr),
last AS (SELECT n_name, MAX(yr) AS last_yr FROM s2 GROUP BY 1)
SELECT n_name, yr AS year, CAST(v AS DOUBLE) AS v, 'old' AS source FROM s2
UNION ALL
SELECT s3.n_name, s3.yr, {sql_fixed('s3.v * COALESCE((SELECT ratio FROM ratio), 1)', 4)}, 'new'
FROM s3 LEFT JOIN last ON s3.n_name = last.n_name
WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.n_name = s3.n_name AND s2.yr = s3.yr)
  AND (last.last_yr IS NULL OR s3.yr > last.last_yr)
""")
def ts_splice_after(spark, sf_dir):
    """Dashboard form: one overall ratio, new periods only after the last old period."""
    _, s2, s3 = _sources(spark, sf_dir)
    r = S.chain_ratio(s2, s3, ["n_name", "yr"], [], "v", "v")
    sp = S.splice(s2.withColumn("v", F.col("v").cast("double")), s3, r, ["n_name", "yr"], [], "v",
                  period="yr", only_after=True, after_by=["n_name"])
    return sp.select("n_name", F.col("yr").alias("year"),
                     F.when(F.col("source") == "new", N.fixed("v", 4)).otherwise(F.col("v")).alias("v"), "source")


@query("ts_residual", covers=("TS-4", "JN-8", "SET-1"), sql=f"""
{W},
c AS (SELECT r_name, yr, o_orderpriority AS cat, CAST(COUNT(*) AS BIGINT) AS n,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS rev FROM geo GROUP BY 1, 2, 3
      UNION ALL
      SELECT r_name, yr, 'Total', CAST(COUNT(*) AS BIGINT), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM geo GROUP BY 1, 2),
part AS (SELECT r_name, yr, SUM(n) AS n, SUM(rev) AS rev FROM c WHERE cat IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2)
SELECT r_name, yr AS year, 'Fast' AS cat, CAST(n AS BIGINT) AS n, CAST(rev AS DOUBLE) AS rev FROM part
UNION ALL
SELECT t.r_name, t.yr, 'Rest', CAST(t.n - p.n AS BIGINT), CAST(t.rev - p.rev AS DOUBLE)
FROM c t JOIN part p ON t.r_name = p.r_name AND t.yr = p.yr WHERE t.cat = 'Total'
""")
def ts_residual(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    per = materialize(g.groupBy("r_name", "yr", F.col("o_orderpriority").alias("cat")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev")), "residual_categories")
    # the 'Total' category is the sum of the category rows (read back from the written table)
    tot = per.groupBy("r_name", "yr").agg(F.lit("Total").alias("cat"), F.sum("n").alias("n"),
                                           F.sum("rev").alias("rev"))
    res = S.residual(per.unionByName(tot), ["r_name", "yr"], "cat", ["n", "rev"], "Total",
                     ["1-URGENT", "2-HIGH"], "Fast", "Rest")
    return res.select("r_name", F.col("yr").alias("year"), "cat", F.col("n").cast("long").alias("n"),
                      F.col("rev").cast("double").alias("rev"))


def _nation_year(spark, sf_dir):
    """The (nation, year) series, written once: the series operators read it several times
    (group sizes, base values, fits joined back)."""
    g = geo_orders(cat(spark, sf_dir))
    return materialize(g.groupBy("n_name", "yr").agg(
        msum("o_totalprice").alias("revenue"), F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_pending")), "nation_year")


NY_SQL = f"""{W},
ny AS (SELECT n_name, yr, {sql_money_sum('o_totalprice')} AS revenue, CAST(COUNT(*) AS BIGINT) AS n_orders,
              CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_pending
       FROM geo GROUP BY 1, 2)"""


@query("ts_break_cut", covers=("TS-5", "WIN-5"), sql=f"""
{NY_SQL},
g AS (SELECT *, (n_pending - LAG(n_pending) OVER (PARTITION BY n_name ORDER BY yr))
                / NULLIF(CAST(LAG(n_pending) OVER (PARTITION BY n_name ORDER BY yr) AS DOUBLE), 0) AS gr FROM ny),
b AS (SELECT n_name, MIN(yr) AS brk FROM g WHERE gr > 0.25 GROUP BY 1)
SELECT g.n_name, g.yr AS year, g.n_pending FROM g LEFT JOIN b ON g.n_name = b.n_name
WHERE b.brk IS NULL OR g.yr < b.brk
""")
def ts_break_cut(spark, sf_dir):
    ny = _nation_year(spark, sf_dir)
    out = S.break_cut(ny, ["n_name"], "yr", "n_pending", threshold=0.25)
    return out.select("n_name", F.col("yr").alias("year"), "n_pending")


@query("ts_growth_pair", covers=("TS-6", "WIN-5"), sql=f"""
{NY_SQL},
g AS (SELECT n_name, yr,
        (revenue - LAG(revenue) OVER w) / NULLIF(LAG(revenue) OVER w, 0) * 100.0 AS revenue_chg,
        (n_orders - LAG(n_orders) OVER w) / NULLIF(CAST(LAG(n_orders) OVER w AS DOUBLE), 0) * 100.0 AS n_orders_chg
      FROM ny WHERE n_name IN (SELECT n_name FROM ny GROUP BY 1 HAVING COUNT(*) >= 3)
      WINDOW w AS (PARTITION BY n_name ORDER BY yr))
SELECT n_name, yr AS year, {sql_fixed('revenue_chg', 4)} AS revenue_chg, {sql_fixed('n_orders_chg', 4)} AS n_orders_chg
FROM g WHERE revenue_chg IS NOT NULL AND n_orders_chg IS NOT NULL
""")
def ts_growth_pair(spark, sf_dir):
    ny = _nation_year(spark, sf_dir)
    g = S.growth_pair(ny, ["n_name"], "yr", "revenue", "n_orders", min_points=3)
    return g.select("n_name", F.col("yr").alias("year"), N.fixed("revenue_chg", 4).alias("revenue_chg"),
                    N.fixed("n_orders_chg", 4).alias("n_orders_chg"))


@query("ts_index_pair", covers=("TS-7", "WIN-6"), sql=f"""
{NY_SQL}
SELECT n_name, yr AS year,
       {sql_fixed('revenue / NULLIF(FIRST_VALUE(revenue) OVER w, 0) * 100.0', 1)} AS revenue_index,
       {sql_fixed('n_orders / NULLIF(CAST(FIRST_VALUE(n_orders) OVER w AS DOUBLE), 0) * 100.0', 1)} AS n_orders_index
FROM ny WHERE n_name IN (SELECT n_name FROM ny GROUP BY 1 HAVING COUNT(*) >= 3)
WINDOW w AS (PARTITION BY n_name ORDER BY yr)
""")
def ts_index_pair(spark, sf_dir):
    ny = _nation_year(spark, sf_dir)
    i = S.index_pair(ny, ["n_name"], "yr", "revenue", "n_orders", min_points=3)
    return i.select("n_name", F.col("yr").alias("year"), N.fixed("revenue_index", 1).alias("revenue_index"),
                    N.fixed("n_orders_index", 1).alias("n_orders_index"))


@query("ts_corr_group", covers=("TS-8",), sql=f"""
{NY_SQL}
SELECT n_name, CAST(COUNT(*) AS BIGINT) AS n_points,
       CASE WHEN COUNT(*) >= 3 AND stddev_pop(revenue) > 0 AND stddev_pop(n_orders) > 0
            THEN {sql_fixed('corr(revenue, n_orders)', 6)} END AS r
FROM ny GROUP BY n_name
""")
def ts_corr_group(spark, sf_dir):
    ny = _nation_year(spark, sf_dir)
    c = S.corr_by_group(ny, ["n_name"], "revenue", "n_orders")
    return c.select("n_name", "n_points", N.fixed("r", 6).alias("r"))


@query("ts_corr_mean", covers=("TS-8", "AGG-10"), sql=f"""
{W},
rg AS (SELECT r_name, n_name, yr, CAST(COUNT(*) AS BIGINT) AS n_orders,
              CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_f FROM geo GROUP BY 1, 2, 3),
c AS (SELECT r_name, CASE WHEN COUNT(*) >= 3 AND stddev_pop(n_orders) > 0 AND stddev_pop(n_f) > 0
                          THEN corr(n_orders, n_f) END AS r FROM rg GROUP BY 1)
SELECT {sql_fixed('COALESCE(AVG(r), 0)', 6)} AS mean_r, CAST(COUNT(r) AS BIGINT) AS n_groups FROM c
""")
def ts_corr_mean(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    rg = g.groupBy("r_name", "n_name", "yr").agg(F.count(F.lit(1)).alias("n_orders"),
                                                  F.count_if(F.col("o_orderstatus") == "F").alias("n_f"))
    m = S.mean_corr(S.corr_by_group(rg, ["r_name"], "n_orders", "n_f"))
    return m.select(N.fixed("mean_r", 6).alias("mean_r"), "n_groups")


@query("ts_fit_group", covers=("TS-9",), sql=f"""
{NY_SQL},
f AS (SELECT n_name, regr_slope(revenue, n_orders) AS slope, regr_intercept(revenue, n_orders) AS intercept
      FROM ny GROUP BY 1 HAVING COUNT(*) >= 3)
SELECT ny.n_name, ny.yr AS year, {sql_fixed('f.slope', 4)} AS slope,
       {sql_fixed('f.slope * ny.n_orders + f.intercept', 2)} AS fitted
FROM ny JOIN f ON ny.n_name = f.n_name
""")
def ts_fit_group(spark, sf_dir):
    ny = _nation_year(spark, sf_dir)
    f = S.fit_by_group(ny, ["n_name"], "n_orders", "revenue")
    return f.select("n_name", F.col("yr").alias("year"), N.fixed("slope", 4).alias("slope"),
                    N.fixed("fitted", 2).alias("fitted"))


@query("ts_gap", covers=("TS-10", "FN-11"), sql=f"""
WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS st,
                  {sql_fixed('SUM(CAST(o_totalprice AS DECIMAL(18,2))) / CAST(COUNT(*) AS DOUBLE)', 2)} AS avg_price
           FROM orders GROUP BY 1, 2)
SELECT year, MAX(CASE WHEN st = 'F' THEN avg_price END) AS "F", MAX(CASE WHEN st = 'O' THEN avg_price END) AS "O",
       {sql_fixed("MAX(CASE WHEN st = 'F' THEN avg_price END) - MAX(CASE WHEN st = 'O' THEN avg_price END)", 2)} AS gap
FROM a GROUP BY year
""")
def ts_gap(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    a = o.groupBy(F.year("o_orderdate").cast("int").alias("year"), F.col("o_orderstatus").alias("st")).agg(
        F.sum(N.money("o_totalprice")).alias("s"), F.count(F.lit(1)).alias("n"))
    a = a.withColumn("avg_price", N.fixed(N.exact_mean("s", "n"), 2))
    g = S.category_gap(a, ["year"], "st", "avg_price", "F", "O")
    return g.withColumn("gap", N.fixed("gap", 2))


@query("ts_bucket_share", covers=("TS-12", "FN-2", "WIN-1"), sql=f"""
WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'Fast' WHEN '2-HIGH' THEN 'Fast'
                                       WHEN '3-MEDIUM' THEN 'Normal' ELSE 'Others' END AS bucket,
                  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1, 2)
SELECT year, bucket, CAST(total AS DOUBLE) AS total,
       {sql_fixed(sql_ratio('total', 'SUM(total) OVER (PARTITION BY year)') + ' * 100.0', 2)} AS share_pct
FROM s
""")
def ts_bucket_share(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int")) \
        .withColumn("m", N.money("o_totalprice"))
    b = S.bucket_share(o, "year", L.lookup("o_orderpriority", PRIORITY_GROUP, "Others"), "m")
    return b.select("year", "bucket", F.col("total").cast("double").alias("total"),
                    N.fixed("share_pct", 2).alias("share_pct"))


@query("ts_ratio_of_sums", covers=("TS-13", "FN-8"), sql=f"""
{W}
SELECT yr AS year, {sql_money_sum("CASE WHEN r_name = 'EUROPE' THEN o_totalprice END")} AS part,
       {sql_money_sum('o_totalprice')} AS total,
       {sql_fixed(sql_ratio("SUM(CASE WHEN r_name = 'EUROPE' THEN CAST(o_totalprice AS DECIMAL(18,2)) END)", "SUM(CAST(o_totalprice AS DECIMAL(18,2)))") + ' * 100.0', 2)} AS pct
FROM geo GROUP BY yr
""")
def ts_ratio_of_sums(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    g = g.select(F.col("yr").alias("year"), N.money("o_totalprice").alias("total"),
                 F.when(F.col("r_name") == "EUROPE", N.money("o_totalprice")).alias("part"))
    r = S.ratio_of_sums(g, ["year"], "part", "total")
    return r.select("year", F.col("part").cast("double").alias("part"), F.col("total").cast("double").alias("total"),
                    N.fixed("pct", 2).alias("pct"))


@query("ts_fallback", covers=("TS-14",), sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(COUNT(*) AS BIGINT) AS n, 'fallback' AS source
FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
""")
def ts_fallback(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    # the primary source is empty on these tables (no status 'X'), so the fallback is used
    prim = o.where(F.col("o_orderstatus") == "X").groupBy(F.year("o_orderdate").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("primary"))
    fb = o.where(F.col("o_orderstatus") == "P").groupBy(F.year("o_orderdate").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("source", F.lit("fallback"))
    return S.with_fallback(prim, fb)
