"""Registered queries for the readers over files.

Each query writes raw files from the driver tables into the shared folder (a line for each order or customer, so files grow
with the tables), with the faults that such files have, and reads them back with the library's file readers.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import file_quality as FQ
from ..operators.quality import Contract
from ..session import materialize, scratch_path
from ..sources import html as H
from ..sources import json_series as J
from ..sources import text_tables as TT
from ..sources.sinks import write_csv
from .common import GEO_SQL, cat, geo_orders, write_files
from .q_quality import contract_sql, union_checks
from .registry import query, sql_money_sum

W = f"WITH {GEO_SQL.strip()}"


def _quoted(x):
    return F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))


@query("src_files_titled", covers=("SRC-5", "SRC-7", "PRJ-3"), sql=f"""
{W}
SELECT r_name AS region, yr AS year, CAST(COUNT(*) AS BIGINT) AS n_orders,
       CAST(COUNT(*) FILTER (WHERE o_orderkey % 10 = 0) AS BIGINT) AS n_notes,
       CAST(COALESCE(SUM(CASE WHEN o_orderkey % 10 = 0 THEN length(o_orderpriority) + 21 END), 0) AS BIGINT) AS note_chars,
       {sql_money_sum('o_totalprice')} AS revenue, CAST(COUNT(*) FILTER (WHERE o_orderkey % 97 = 3) AS BIGINT) AS n_rejected
FROM geo GROUP BY 1, 2
""")
def src_files_titled(spark, sf_dir):
    """A file for each region and year: title, header (two orders of columns), a line for each order.  Every tenth order has a note
    with separators, quotes and line breaks; some lines are followed by one with too many cells."""
    g = geo_orders(cat(spark, sf_dir)).select(F.concat_ws("_", "r_name", "yr").alias("name"), "r_name", "yr", "o_orderkey",
                                              "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"))
    note = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit('first, "one";\n\n'), F.col("o_orderpriority"), F.lit("\nlast,"))).otherwise(F.lit(""))
    key = F.col("o_orderkey").cast("string")
    cells = [key, _quoted(note), F.col("price"), _quoted(F.col("r_name")), F.col("yr").cast("string")]
    even = F.col("yr") % 2 == 0
    line = F.when(even, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells[::-1]))
    body = g.select("name", F.col("o_orderkey").alias("k"), F.explode(F.filter(F.array(
        F.struct(F.lit(0).alias("i"), line.alias("line")),
        F.when(F.col("o_orderkey") % 97 == 3, F.struct(F.lit(1).alias("i"), F.concat(line, F.lit(",more,")).alias("line")))),
        lambda x: x.isNotNull())).alias("l")).select("name", "k", "l.i", "l.line")
    names = ["key", "note", "price", "region", "year"]
    heads = g.select("name", "yr").distinct().select("name", F.lit(-1).cast("long").alias("k"), F.posexplode(F.array(
        F.concat(F.lit("Orders of "), F.col("name"), F.lit(", all")),
        F.when(even, ",".join(names)).otherwise(",".join(names[::-1])))).alias("i", "line"))
    path = write_files(body.unionByName(heads.withColumn("k", F.lit(-1).cast("long"))), "name", ["k", "i"], "titled")
    lines = materialize(TT.read_lines(spark, path, skip=1), "titled_lines")      # parsed once: for the rows and the rejects
    rows = TT.columns(lines, infer=True)
    bad = TT.rejects(lines).groupBy("file").agg(F.sum("n_lines").alias("n_rejected"))
    by_file = rows.groupBy("file", "region", "year").agg(
        F.count("key").alias("n_orders"), F.count("note").alias("n_notes"), F.coalesce(F.sum(F.length("note")), F.lit(0)).alias("note_chars"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"))
    return by_file.join(bad, "file", "left").select(
        "region", F.col("year").cast("int").alias("year"), "n_orders", "n_notes", F.col("note_chars").cast("long").alias("note_chars"), "revenue",
        F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected"))


@query("src_files_delimited", covers=("SRC-6", "FN-4"), sql="""
SELECT c_mktsegment AS segment, CAST(c_nationkey AS INTEGER) AS nation, CAST(COUNT(*) AS BIGINT) AS n,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY 1, 2
""")
def src_files_delimited(spark, sf_dir):
    """A ``;`` file for each segment with Spanish numbers, one short line for each customer whose key is a multiple of seven."""
    c = cat(spark, sf_dir)["customer"].withColumn("k", F.col("c_custkey").cast("long"))
    loc = F.translate(F.format_number(F.col("c_acctbal").cast("decimal(18,2)"), 2), ",.", ".,")
    line = F.concat_ws(";", "c_mktsegment", "c_nationkey", loc)
    body = c.select("c_mktsegment", "k", F.explode(F.when(F.col("k") % 7 == 0, F.array(line, F.lit("short;line"))).otherwise(F.array(line))).alias("line"))
    heads = c.select("c_mktsegment").distinct().select("c_mktsegment", F.lit(-1).cast("long").alias("k"), F.lit("segment;nation;balance").alias("line"))
    path = write_files(body.unionByName(heads), "c_mktsegment", ["k"], "delimited")
    t = TT.read_delimited(spark, path, "segment string, nation int, balance string", min_fields=3)
    return t.groupBy("segment", "nation").agg(F.count(F.lit(1)).alias("n"), F.sum(N.locale_number("balance").cast("decimal(18,2)"))
                                              .cast("double").alias("balance"))


@query("src_html_tables", covers=("SRC-9",), sql=f"""
{W},
y AS (SELECT n_name, yr, ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY yr) - 1 AS r, COUNT(*) AS n FROM geo GROUP BY 1, 2),
s AS (SELECT n_name, yr, o_orderstatus AS st, ROW_NUMBER() OVER (PARTITION BY n_name, yr ORDER BY o_orderstatus) - 1 AS k, COUNT(*) AS n
      FROM geo GROUP BY 1, 2, 3)
SELECT n_name, 0 AS table_idx, CAST(r AS INTEGER) AS row_idx, c AS col_idx,
       CASE c WHEN 0 THEN yr::VARCHAR WHEN 1 THEN 'P&R: ' || n ELSE '' END AS text FROM y, (VALUES (0), (1), (2)) AS v(c)
UNION ALL
SELECT s.n_name, CAST(y.r + 1 AS INTEGER), CAST(k AS INTEGER), c, CASE c WHEN 0 THEN st ELSE '<' || s.n || '>' END
FROM s JOIN y ON s.n_name = y.n_name AND s.yr = y.yr, (VALUES (0), (1)) AS v(c)
""")
def src_html_tables(spark, sf_dir):
    """A page for each nation: a table of years whose last cell holds a table of statuses."""
    g = geo_orders(cat(spark, sf_dir)).groupBy("n_name", "yr", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))

    def rows(x, line):
        return F.array_join(F.transform(F.array_sort(F.collect_list(x)), line), "\n")
    inner = g.groupBy("n_name", "yr").agg(F.sum("n").alias("total"), rows(F.struct("o_orderstatus", "n"), lambda z: F.concat(
        F.lit("<TR><td>"), z["o_orderstatus"], F.lit("</td><td>&lt;<b>"), z["n"].cast("string"), F.lit("</b>&gt</td></TR>"))).alias("body"))
    pages = inner.groupBy("n_name").agg(rows(F.struct("yr", "total", "body"), lambda z: F.concat(
        F.lit("<tr><th>"), z["yr"].cast("string"), F.lit("</th><td>P&amp;R:\n "), z["total"].cast("string"), F.lit("</td><td><table>"),
        z["body"], F.lit("</table></td></tr>"))).alias("body"))
    pages = pages.select("n_name", F.concat(F.lit("</table><!-- <table> --><table class='y'>"), F.col("body"), F.lit("</table>")).alias("html"))
    return H.nested_table_cells(materialize(pages, "table_pages"), "n_name")


@query("src_files_json", covers=("SRC-1", "SRC-3", "FN-21"), sql=f"""
{W}
SELECT r_name AS region, o_custkey AS customer, CAST(COUNT(*) AS BIGINT) AS n_points,
       {sql_money_sum('o_totalprice')} AS revenue, MAX(yr) AS last_year
FROM geo GROUP BY 1, 2
""")
def src_files_json(spark, sf_dir):
    """A file for each region: one line, a list with a series for each customer and a point for each order; names hold braces and
    quotes.  The files grow with the orders and are read in splits."""
    g = geo_orders(cat(spark, sf_dir)).select("r_name", "o_custkey", "yr", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("v"))
    s = g.groupBy("r_name", "o_custkey").agg(F.collect_list(F.struct(F.col("yr").cast("string").alias("Anyo"), F.col("v").alias("Valor"))).alias("Data"))
    text = F.to_json(F.struct(F.concat(F.col("o_custkey").cast("string"), F.lit(' }{"\\')).alias("Nombre"),
                              F.array(F.struct(F.lit("Región").alias("T3_Variable"), F.col("r_name").alias("Nombre"))).alias("MetaData"), "Data"))
    ends = s.select("r_name").distinct().select("r_name", F.inline(F.array(F.struct(F.lit(-1).cast("long").alias("k"), F.lit("[").alias("line")),
                                                                          F.struct(F.lit(2 ** 62).alias("k"), F.lit("{}]").alias("line")))))
    body = s.select("r_name", F.col("o_custkey").cast("long").alias("k"), F.concat(text, F.lit(",")).alias("line"))
    path = write_files(body.unionByName(ends), "r_name", ["k"], "series", sep=" ")
    p = J.read_series_splits(spark, path).where(F.col("Nombre").isNotNull())
    p = J.points(p.select("Data", *J.meta_exact(F.col("MetaData"), {"region": "Región"}),
                          F.substring_index("Nombre", " ", 1).cast("long").alias("customer")), ["region", "customer"])
    return p.groupBy("region", "customer").agg(F.count(F.lit(1)).alias("n_points"), F.sum(F.col("Valor").cast("decimal(18,2)")).cast("double")
                                               .alias("revenue"), F.max("year").alias("last_year"))


# Contracts of files; the columns that each file really has, and what its good records hold, as SQL.
_FILE_CONTRACTS = [
    Contract("accounts", required_columns=["key", "balance"], pk=["key"], non_negative=["balance"], year_col=None),
    Contract("sales", required_columns=["key", "total", "year", "channel"], pk=["key"], non_negative=["total"], year_min=1996, reference_year=1999),
    Contract("lists", required_columns=["key", "segment"], pk=["segment", "nation"], year_col=None),
    Contract("nothing", required_columns=["a"], pk=["b"], non_negative=["b"], year_col=None),
    Contract("absent", required_columns=["key"]),
]
_FILE_ROWS = {
    "accounts": (["key", "balance"], "(SELECT NULLIF(c_custkey, 3) AS key, IF(c_custkey % 7 = 0, NULL, c_acctbal) AS balance FROM customer)"),
    "sales": (["key", "total", "year"], """(SELECT o_orderkey AS key, IF(o_orderkey % 10 = 0, NULL, o_totalprice) AS total, year(o_orderdate) AS year
               FROM orders, UNNEST(range(IF(o_orderkey % 97 = 3, 2, 1))))"""),
    "lists": (["key", "segment", "nation"], "(SELECT c_custkey AS key, c_mktsegment AS segment, c_nationkey AS nation FROM customer WHERE c_custkey % 11 <> 0)"),
    "nothing": (["a", "b"], "(SELECT 1 AS a, 1 AS b FROM customer WHERE false)"),
}


def _file_check(dataset, check, column, n):
    return (f"SELECT '{dataset}', '{check}', {f"'{column}'" if column else 'CAST(NULL AS VARCHAR)'}, CAST(n AS BIGINT), "
            f"IF(n > 0, 'ERROR', 'OK') FROM (SELECT {n} AS n)")


@query("dq_csv_files", covers=("DQ-1", "DQ-2", "DQ-3", "DQ-4", "DQ-5", "DQ-6", "DQ-12", "SRC-7"), sql=union_checks([
    *[x for c in _FILE_CONTRACTS if c.dataset in _FILE_ROWS for x in contract_sql(c, table=_FILE_ROWS[c.dataset][1], columns=_FILE_ROWS[c.dataset][0])],
    _file_check("accounts", "over_long", None, "0"), _file_check("accounts", "not_numeric", "balance", "0"),
    _file_check("sales", "over_long", None, "0"), _file_check("sales", "not_numeric", "year", "0"),
    _file_check("sales", "not_numeric", "total", "(SELECT COUNT(*) FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 97 <> 3) + "
                "2 * (SELECT COUNT(*) FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 97 = 3)"),
    _file_check("lists", "over_long", None, "(SELECT COUNT(*) FROM customer WHERE c_custkey % 11 = 0)"),
    _file_check("nothing", "over_long", None, "0"), _file_check("nothing", "not_numeric", "b", "0"),
    _file_check("absent", "missing", None, "1")]))
def dq_csv_files(spark, sf_dir):
    """Contracts on CSV files before a load: a sound one with empty cells in two spellings; one with repeated records, a total in words and a
    column missing; files with over-long lines; a header without records; and no file at all."""
    c = cat(spark, sf_dir)
    base = scratch_path(spark, "csv_checked")
    cu, o = c["customer"], c["orders"]
    write_csv(cu.select(F.when(F.col("c_custkey") != 3, F.col("c_custkey").cast("string")).otherwise("n/a").alias("key"),
                        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance")), f"{base}/accounts")
    write_csv(o.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 10 == 0, "some").otherwise(F.col("o_totalprice").cast("string"))
                       .alias("total"), F.year("o_orderdate").alias("year"),
                       F.explode(F.array_repeat(F.lit("shop, web"), F.when(F.col("o_orderkey") % 97 == 3, 2).otherwise(1))).alias("way")), f"{base}/sales")
    line = F.concat_ws(",", "c_custkey", "c_mktsegment", "c_nationkey", F.when(F.col("c_custkey") % 11 == 0, F.lit("more")))
    heads = cu.select("c_mktsegment").distinct().select("c_mktsegment", F.lit(-1).cast("long").alias("k"), F.lit("key,segment,nation").alias("line"))
    lists = write_files(cu.select("c_mktsegment", F.col("c_custkey").cast("long").alias("k"), line.alias("line")).unionByName(heads),
                        "c_mktsegment", ["k"], "lists")
    cu.limit(1).select(F.lit("a,b").alias("value")).write.text(f"{base}/nothing")
    paths = {"lists": lists, "absent": f"{base}/absent", **{n: f"{base}/{n}" for n in ("accounts", "sales", "nothing")}}
    return FQ.check_csv_files(spark, paths, _FILE_CONTRACTS)
