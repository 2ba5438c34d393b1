"""Shared building blocks for the registered queries: the "geo" star over the driver tables.

Role mapping used throughout (see SURVEY §7.4): ``yr = year(o_orderdate)``;
``r_name`` plays province/region, ``o_orderstatus`` plays source or sex,
``o_orderpriority`` plays nationality/category, ``event_type`` plays crime type.

Join strategy: ``nation`` (25 rows) and ``region`` (5 rows) have a size fixed
by the schema, so they are broadcast explicitly.  ``customer`` and ``orders``
grow with the data; their join is left to the planner, which broadcasts only
when the runtime size is under ``autoBroadcastJoinThreshold`` and otherwise
shuffles both sides on the key (AQE splits skewed partitions).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.catalog import Catalog

# SQL fragment equivalent to geo_orders(): orders with year, region and nation names.
GEO_SQL = """
geo AS (
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
           o.o_orderdate, CAST(year(o.o_orderdate) AS INTEGER) AS yr,
           CAST(month(o.o_orderdate) AS INTEGER) AS mon,
           n.n_name, r.r_name
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n   ON c.c_nationkey = n.n_nationkey
    JOIN region r   ON n.n_regionkey = r.r_regionkey
)"""


def cat(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir)


def nation_region(c: Catalog) -> DataFrame:
    """25-row dimension: nation key -> nation and region names (fixed size, safe to broadcast)."""
    n = c["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = c["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return n.join(F.broadcast(r), on="n_regionkey").drop("n_regionkey")


def customer_geo(c: Catalog) -> DataFrame:
    """customer -> (c_custkey, n_name, r_name)."""
    cu = c["customer"].select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return cu.join(F.broadcast(nation_region(c)), on="n_nationkey").drop("n_nationkey")


def geo_orders(c: Catalog) -> DataFrame:
    """orders ⋈ customer ⋈ nation ⋈ region with ``yr`` and ``mon``."""
    o = c["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                           "o_orderdate")
    g = customer_geo(c).withColumnRenamed("c_custkey", "o_custkey")
    return (o.join(g, on="o_custkey")
             .withColumn("yr", F.year("o_orderdate").cast("int"))
             .withColumn("mon", F.month("o_orderdate").cast("int")))


def geo_star(c: Catalog) -> DataFrame:
    """The orders star by (region, nation, status, priority, year, month): number of orders and exact
    revenue.  Its size follows the dimensions, not the orders."""
    return geo_orders(c).groupBy("r_name", "n_name", "o_orderstatus", "o_orderpriority", "yr", "mon").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("rev"))


def with_yr(df: DataFrame, ts: str = "o_orderdate") -> DataFrame:
    return df.withColumn("yr", F.year(ts).cast("int"))


def labels_of(df: DataFrame, *cols: str) -> list[list]:
    """Sorted distinct values of dimension columns, from one aggregate: a wide or cube layout names its
    columns after them.  The columns must be dimensions, with a few members."""
    row = df.agg(*[F.array_sort(F.collect_set(c)) for c in cols]).first()
    return [list(v) for v in row]


def write_files(lines: DataFrame, key: str, order: list[str], name: str, sep: str = "\n") -> str:
    """Text files in the shared folder, one for each value of ``key``, each written by one task in ``order``; the column
    ``line`` is the text.  Returns the folder."""
    path = scratch_path(lines.sparkSession, name)
    lines.repartition(key).sortWithinPartitions(key, *order).select(key, "line").write.partitionBy(key).text(path, lineSep=sep)
    return path
