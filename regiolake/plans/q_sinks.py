"""Registered sink queries (SNK-1, SNK-3..6): each writes to a fresh folder below the
shared ``spark.checkpoint.dir``, reads the result back and aggregates it."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numbers as N
from ..operators import relational as R
from ..session import scratch_path
from ..sources import sinks as K
from .common import GEO_SQL, cat, geo_orders
from .registry import query, sql_money_sum

W = f"WITH {GEO_SQL.strip()}"


@query("snk_reload_roundtrip", covers=("SNK-3", "SRC-10"), sql=f"""
{W}
SELECT yr AS year, CAST(COUNT(*) AS BIGINT) AS n, {sql_money_sum('o_totalprice')} AS revenue,
       2 AS tables_loaded, 1 AS tables_skipped
FROM geo GROUP BY 1
""")
def snk_reload_roundtrip(spark, sf_dir):
    c = cat(spark, sf_dir)
    ny = geo_orders(c).groupBy("n_name", "yr").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sum(N.money("o_totalprice")).alias("rev"))
    frames = {"nation_year": ny, "region": c["region"], "absent": None}
    base = scratch_path(spark, "reload")
    cols = {"nation_year": ["yr", "n_name", "n", "rev"]}
    K.reload(spark, frames, base, columns=cols)                 # first load
    rep = K.reload(spark, frames, base, columns=cols)           # full refresh: same content, not doubled
    loaded = rep.agg(F.count_if(F.col("status") == "loaded").alias("tables_loaded"),
                     F.count_if(F.col("status") == "skipped").alias("tables_skipped")).first()
    back = K.read_table(spark, base, "nation_year")
    return back.groupBy(F.col("yr").alias("year")).agg(
        F.sum("n").alias("n"), F.sum("rev").cast("double").alias("revenue")).select(
        "year", "n", "revenue", F.lit(loaded["tables_loaded"]).alias("tables_loaded"),
        F.lit(loaded["tables_skipped"]).alias("tables_skipped"))


@query("snk_failed_load", covers=("SNK-3", "SNK-4"), sql=f"""
{W},
ny AS (SELECT yr AS year, COUNT(*) AS n, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1)
SELECT step, year, CAST(n AS BIGINT) AS n, revenue, step <> 'failed' AS loaded
FROM ny, (VALUES ('first'), ('failed'), ('second')) AS s(step) WHERE step <> 'second' OR year > 1994
""")
def snk_failed_load(spark, sf_dir):
    """A load, one that fails while its last rows are written, and one more: after each, what a reader gets."""
    star = geo_orders(cat(spark, sf_dir)).select(F.col("yr").alias("year"), N.money("o_totalprice").alias("price"))
    base, schema = scratch_path(spark, "failed"), T.StructType([T.StructField("year", T.IntegerType()), T.StructField("price", T.DecimalType(18, 2))])
    spoilt = star.withColumn("year", F.when(F.col("year") > 1994, F.raise_error(F.lit("spoilt")).cast("int")).otherwise(F.col("year")))
    steps = []
    for step, load in (("first", K.reload(spark, {"t": star}, base)), ("failed", K.publish(spark, {"t": spoilt}, {"t": schema}, base)),
                       ("second", K.publish(spark, {"t": star.where("year > 1994")}, {"t": schema}, base))):
        loaded = load.first()["status"] == "loaded"
        steps.append(K.read_table(spark, base, "t").groupBy("year").agg(
            F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("revenue"))
            .select(F.lit(step).alias("step"), "year", "n", "revenue", F.lit(loaded).alias("loaded")))
    return R.union_all(steps)


PUBLISH_SCHEMA = T.StructType([T.StructField("year", T.LongType()), T.StructField("category", T.StringType()),
                               T.StructField("orders", T.IntegerType()), T.StructField("revenue", T.DecimalType(18, 2)),
                               T.StructField("loaded_at", T.TimestampType())])


@query("snk_publish_schema", covers=("SNK-4",), sql=f"""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS category, CAST(COUNT(*) AS INTEGER) AS orders,
       {sql_money_sum('o_totalprice')} AS revenue, TRUE AS loaded_at_is_null
FROM orders GROUP BY 1, 2
""")
def snk_publish_schema(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    a = o.groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("category")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(N.money("o_totalprice")).alias("revenue"))
    base = scratch_path(spark, "publish")
    K.publish(spark, {"orders_by_year": a}, {"orders_by_year": PUBLISH_SCHEMA}, base)
    back = K.read_table(spark, base, "orders_by_year")
    return back.select("year", "category", "orders", F.col("revenue").cast("double").alias("revenue"),
                       F.col("loaded_at").isNull().alias("loaded_at_is_null"))


@query("snk_csv_parts", covers=("SNK-1", "SNK-6", "SNK-2"), sql=f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS nr, COUNT(*) OVER () // 3 AS size FROM orders),
p AS (SELECT *, CASE WHEN size = 0 THEN 2 ELSE LEAST(nr // size, 2) END AS part FROM r)
SELECT CAST(part AS INTEGER) AS part, CAST(COUNT(*) AS BIGINT) AS n, MIN(o_orderkey) AS min_key, MAX(o_orderkey) AS max_key,
       CAST(COUNT(DISTINCT o_orderstatus) AS BIGINT) AS n_status, {sql_money_sum('o_totalprice')} AS total
FROM p GROUP BY part
""")
def snk_csv_parts(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    parts = R.split_even(o, ["o_orderkey"], parts=3)
    base = scratch_path(spark, "csvparts")
    # one parallel write, one folder per part (the three load files of the reference)
    K.write_csv(parts.select("part", "o_orderkey", "o_orderstatus", "o_totalprice"), base, partition_by=["part"])
    # every part read back from its own folder, payload and all
    schema = "o_orderkey long, o_orderstatus string, o_totalprice double"
    back = R.union_all([K.append_parts(spark, [f"{base}/part={i}"], schema).withColumn("part", F.lit(i)) for i in range(3)])
    return back.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key"),
        F.countDistinct("o_orderstatus").alias("n_status"), F.sum(N.money("o_totalprice")).cast("double").alias("total"))


@query("snk_enforce", covers=("SNK-5",), sql="""
SELECT CASE WHEN abs(c_acctbal) > 999.99 THEN 'overflow:c_acctbal' END AS reject_reason,
       CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(*) FILTER (WHERE c_mktsegment IS NOT NULL) AS BIGINT) AS n_segment,
       MIN(c_acctbal) AS min_balance, MAX(c_acctbal) AS max_balance
FROM customer GROUP BY 1
""")
def snk_enforce(spark, sf_dir):
    cu = cat(spark, sf_dir)["customer"]
    contract = K.ColumnContract(not_null=["c_custkey", "c_mktsegment"], defaults={"c_mktsegment": "UNKNOWN"},
                                decimals={"c_acctbal": (5, 2)})
    ok, bad = K.load_enforced(spark, cu, contract, scratch_path(spark, "enforce"))
    # a rejected row keeps the value that it was rejected for
    both = (ok.withColumn("reject_reason", F.lit(None).cast("string")).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))
            .unionByName(bad))
    return both.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"), F.count("c_mktsegment").alias("n_segment"),
                                             F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"))
