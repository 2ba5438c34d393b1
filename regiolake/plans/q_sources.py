"""Registered queries for the readers (SRC-*), reshape (RSH-*) and split sink (SNK-2).

Each reader query first renders a raw shape (JSON series, titled CSV, PX cube,
header-parsed table, ...) from the driver tables with Spark, then parses it
back with the reader under test; the oracle is the direct group-by.  Group
sizes inside the renderers are bounded by the number of periods or dimension
cells, never by the number of rows.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..functions import text as X
from ..operators import quality as Q
from ..operators import relational as R
from ..operators import reshape as RS
from ..sources import html as H
from ..sources import json_series as J
from ..sources import px as PX
from ..sources import text_tables as TT
from ..session import materialize
from .common import cat, geo_orders, GEO_SQL, labels_of
from .q_relational import _MONTH_NAMES, _cells_text
from .registry import query, sql_money_sum

W = f"WITH {GEO_SQL.strip()}"
_REJECTED = "(SELECT COUNT(DISTINCT (n_name, o_orderstatus)) FROM geo WHERE yr = 2001) AS n_rejected"


def _nsy(spark, sf_dir):
    """(n_name, status, yr) -> n orders, revenue (exact)."""
    g = geo_orders(cat(spark, sf_dir))
    return g.groupBy("n_name", "o_orderstatus", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"))


def _series_json(nsy, meta_fn, title_fn=None, bad_year=2001):
    """Render one JSON list per nation: one series per status, one data point per year.
    Points of ``bad_year`` carry the text ``'..'`` as value (dropped on parse)."""
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == bad_year, F.lit("..")).otherwise(F.col("rev").cast("string")).alias("Valor"),
                     F.lit("Anual").alias("NombrePeriodo"), F.lit("Definitivo").alias("T3_TipoDato"),
                     F.lit("A").alias("T3_Periodo"))
    s = nsy.groupBy("n_name", "o_orderstatus").agg(F.array_sort(F.collect_list(point)).alias("Data"))
    title = title_fn() if title_fn else F.concat_ws(". ", "n_name", "o_orderstatus")
    series = F.struct(title.alias("Nombre"), F.lit("Euros").alias("T3_Unidad"), meta_fn().alias("MetaData"),
                      F.col("Data"))
    return s.groupBy("n_name").agg(F.to_json(F.collect_list(series)).alias("content"))


def _m(var, val):
    return F.struct(F.lit(var).alias("T3_Variable"), val.alias("Nombre"))


NSY_SQL = f"""{W}
SELECT n_name, o_orderstatus AS status, yr AS year, {sql_money_sum('o_totalprice')} AS value, {_REJECTED}
FROM geo WHERE yr <> 2001 GROUP BY 1, 2, 3"""


def _counted(points, *cols):
    """The points with a year and a value, and the number of the others beside them."""
    good, bad = Q.by_outcome(points, F.col("value").isNotNull() & F.col("year").isNotNull(), "points")
    return good.select(*cols, bad.agg(F.count(F.lit(1))).scalar().alias("n_rejected"))


@query("src_json_series", covers=("SRC-1", "FN-5", "FN-21", "FLT-9"), sql=NSY_SQL)
def src_json_series(spark, sf_dir):
    nsy = _nsy(spark, sf_dir)
    blobs = _series_json(nsy, lambda: F.array(_m("Nación", F.col("n_name")), _m("Estado", F.lit("x")),
                                              _m("Estado", F.col("o_orderstatus"))))
    s = J.parse_series(blobs, "content")
    s = s.select("series_idx", "Data", *J.meta_exact(F.col("MetaData"), {"n_name": "Nación", "status": "Estado"}))
    p = J.points(s, ["n_name", "status"])
    return _counted(p, "n_name", "status", "year", "value")


@query("src_json_substring_meta", covers=("SRC-2", "FN-19"), sql=NSY_SQL)
def src_json_substring_meta(spark, sf_dir):
    nsy = _nsy(spark, sf_dir)
    # status F uses a 'SECTORES ...' variable, the others a 'CNAE ...' variable; empty names are skipped
    meta = lambda: F.array(_m("Nación de residencia del titular", F.col("n_name")),
                           _m("SECTORES económicos", F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus"))
                              .otherwise(F.lit(""))),
                           _m("Clasificación CNAE 2009", F.col("o_orderstatus")))
    s = J.parse_series(_series_json(nsy, meta), "content")
    s = s.select("Data", J.meta_substring(F.col("MetaData"), ["Nación"]).alias("n_name"),
                 J.meta_substring(F.col("MetaData"), ["SECTORES", "CNAE"]).alias("status"))
    return _counted(J.points(s, ["n_name", "status"]), "n_name", "status", "year", "value")


@query("src_json_rules_level", covers=("SRC-3", "FLT-9", "FN-18"), sql=f"""
{W},
nat AS (SELECT 'province' AS level, n_name AS territory, yr AS year, o_orderstatus AS sex,
               {sql_money_sum('o_totalprice')} AS value FROM geo WHERE yr <> 2001 GROUP BY 2, 3, 4),
reg AS (SELECT 'ccaa' AS level, r_name AS territory, yr AS year, o_orderstatus AS sex,
               {sql_money_sum('o_totalprice')} AS value FROM geo WHERE yr <> 2001 GROUP BY 2, 3, 4),
glo AS (SELECT 'national' AS level, 'España' AS territory, yr AS year, o_orderstatus AS sex,
               {sql_money_sum('o_totalprice')} AS value FROM geo WHERE yr <> 2001 GROUP BY 3, 4),
bad AS (SELECT COUNT(DISTINCT (n_name, o_orderstatus)) + COUNT(DISTINCT (r_name, o_orderstatus)) + COUNT(DISTINCT o_orderstatus) AS n
        FROM geo WHERE yr = 2001)
SELECT level, territory, year, sex, 'Todas las edades' AS age_group, value, bad.n AS n_rejected
FROM (SELECT * FROM nat UNION ALL SELECT * FROM reg UNION ALL SELECT * FROM glo), bad
""")
def src_json_rules_level(spark, sf_dir):
    # one pass over the star; the levels are roll-ups of a table that follows the dimensions
    g = materialize(geo_orders(cat(spark, sf_dir)).groupBy("r_name", "n_name", "o_orderstatus", "yr").agg(
        F.sum(N.money("o_totalprice")).alias("rev")), "levels")
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == 2001, F.lit(None)).otherwise(F.col("rev").cast("string")).alias("Valor"))

    def level(keys, meta):
        a = g.groupBy(*keys, "o_orderstatus", "yr").agg(F.sum("rev").alias("rev"))
        s = a.groupBy(*keys, "o_orderstatus").agg(F.array_sort(F.collect_list(point)).alias("Data"))
        return s.select(F.to_json(F.array(F.struct(F.lit("serie").alias("Nombre"), meta.alias("MetaData"),
                                                   F.col("Data")))).alias("content"))
    sex = _m("Sexo", F.col("o_orderstatus"))
    age = _m("Edad simple", F.lit("Total"))
    blobs = R.union_all([
        level(["n_name"], F.array(_m("Provincias", F.col("n_name")), sex, age, _m("Comunidades y Ciudades Autónomas", F.lit("X")))),
        level(["r_name"], F.array(_m("Comunidades y Ciudades Autónomas", F.col("r_name")), sex, age)),
        level([], F.array(_m("Total Nacional", F.lit("Total Nacional")), sex, age)),
    ])
    s = J.parse_series(blobs, "content")
    m = J.meta_rules(F.col("MetaData"), J.POPULATION_META_RULES)
    lvl, terr = J.level_territory(m)
    s = s.select("Data", lvl.alias("level"), terr.alias("territory"), m["sex"].alias("sex"),
                 F.coalesce(m["age_group"], F.lit(J.POPULATION_DEFAULTS["age_group"])).alias("age_group"))
    p = J.points(s, ["level", "territory", "sex", "age_group"])
    return _counted(p, "level", "territory", "year", "sex", "age_group", "value")


@query("src_json_title", covers=("SRC-4", "FN-17"), sql=f"""
{W}
SELECT n_name AS territory, o_orderstatus || ' price. Base 2013.' AS indicator, yr AS year,
       {sql_money_sum('o_totalprice')} AS value, {_REJECTED}
FROM geo WHERE yr <> 2001 GROUP BY 1, 2, 3
""")
def src_json_title(spark, sf_dir):
    nsy = _nsy(spark, sf_dir)
    title = lambda: F.concat(F.col("n_name"), F.lit(". "), F.col("o_orderstatus"), F.lit(" price. Base 2013."))  # noqa
    s = J.parse_series(_series_json(nsy, lambda: F.array(), title_fn=title), "content")
    terr, ind = J.split_title(F.col("Nombre"))
    s = s.select("Data", terr.alias("territory"), ind.alias("indicator"))
    return _counted(J.points(s, ["territory", "indicator"]), "territory", "indicator", "year", "value")


@query("src_props_json", covers=("FN-21",), sql="""
SELECT event_type, CAST(SUM(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
       CAST(COUNT(json_extract_string(props, '$.k')) AS BIGINT) AS k_count
FROM events GROUP BY 1
""")
def src_props_json(spark, sf_dir):
    ev = cat(spark, sf_dir)["events"]
    k = X.json_get("props", "$.k", cast="int")
    return ev.groupBy("event_type").agg(F.sum(k).cast("long").alias("k_sum"), F.count(k).alias("k_count"))


def _ny_text(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    return g.groupBy("n_name", "yr").agg(F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"))


NY_SQL = f"""{W}
SELECT n_name, yr AS year, CAST(COUNT(*) AS BIGINT) AS n_orders, {sql_money_sum('o_totalprice')} AS revenue
FROM geo GROUP BY 1, 2"""


def _render(ny, line, header, title=None):
    body = ny.groupBy("n_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("yr", line.alias("l")))), lambda s: s["l"]), "\n").alias("body"))
    parts = ([title] if title is not None else []) + [F.lit(header), F.col("body")]
    return body.select("n_name", F.concat_ws("\n", *parts).alias("content"))


@query("src_titled_csv", covers=("SRC-5", "SRC-7"), sql=NY_SQL)
def src_titled_csv(spark, sf_dir):
    ny = _ny_text(spark, sf_dir)
    files = _render(ny, F.concat_ws(",", "yr", "n", "rev"), "year,n_orders,revenue",
                    title=F.concat(F.lit("﻿Orders by year, "), F.col("n_name")))
    t = TT.parse_delimited(files, "content", ["year", "n_orders", "revenue"], skip=1, keep=["n_name"])
    return t.select("n_name", F.col("year").cast("int").alias("year"), F.col("n_orders").cast("long").alias("n_orders"),
                    N.safe_double("revenue").alias("revenue"))


@query("src_delimited", covers=("SRC-6", "FN-4"), sql=NY_SQL)
def src_delimited(spark, sf_dir):
    ny = _ny_text(spark, sf_dir)
    # Spanish locale: thousands '.', decimal ','; each file also carries a short (bad) line
    loc = F.translate(F.format_number(F.col("rev"), 2), ",.", ".,")
    files = _render(ny, F.concat_ws(";", "n_name", "yr", "n", loc), "nation;year;orders;revenue")
    files = files.withColumn("content", F.concat("content", F.lit("\nshort;line")))
    t = TT.parse_delimited(files, "content", ["nation", "year", "orders", "revenue"], sep=";", min_fields=4)
    return t.select(F.col("nation").alias("n_name"), F.col("year").cast("int").alias("year"),
                    F.col("orders").cast("long").alias("n_orders"), N.locale_number("revenue").alias("revenue"))


@query("src_csv_positional", covers=("SRC-7", "PRJ-3"), sql=NY_SQL)
def src_csv_positional(spark, sf_dir):
    ny = _ny_text(spark, sf_dir)
    files = _render(ny, F.concat_ws(",", "n_name", "yr", "n", "rev"), "Provincia,Periodo,Total,Importe")
    t = TT.parse_delimited(files, "content", ["a", "b", "c", "d"], header=True)
    # rename the first k columns by position, whatever the header said
    t = t.select("a", "b", "c", "d").toDF("n_name", "year", "n_orders", "revenue")
    return t.select("n_name", F.col("year").cast("int").alias("year"), F.col("n_orders").cast("long").alias("n_orders"),
                    N.safe_double("revenue").alias("revenue"))


@query("src_px_cube", covers=("SRC-8", "FN-4"), sql=f"""
{W},
c AS (SELECT n_name, o_orderstatus, yr, COUNT(*) AS n FROM geo GROUP BY 1, 2, 3),
grid AS (SELECT n.n_name, s.st, y.yr FROM nation n, (SELECT DISTINCT o_orderstatus AS st FROM c WHERE o_orderstatus IS NOT NULL) s,
         (SELECT DISTINCT yr FROM c WHERE yr IS NOT NULL) y)
SELECT grid.n_name, grid.st AS status, CAST(grid.yr AS INTEGER) AS year, CAST(COALESCE(c.n, 0) AS DOUBLE) AS value
FROM grid LEFT JOIN c ON grid.n_name = c.n_name AND grid.st = c.o_orderstatus AND grid.yr = c.yr
""")
def src_px_cube(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = geo_orders(c)
    counts = g.groupBy("n_name", F.col("o_orderstatus").alias("st"), "yr").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "px_counts")
    states, years = labels_of(counts, "st", "yr")
    # the cube grid per nation: the dimension lists exploded inside each nation row (no cross join)
    grid = (c["nation"].select("n_name")
            .withColumn("st_i", F.explode(F.sequence(F.lit(0), F.lit(len(states) - 1))))
            .withColumn("yr_i", F.explode(F.sequence(F.lit(0), F.lit(len(years) - 1))))
            .withColumn("st", F.element_at(F.array(*[F.lit(s) for s in states]), F.col("st_i") + 1))
            .withColumn("yr", F.element_at(F.array(*[F.lit(y) for y in years]), F.col("yr_i") + 1)))
    cells = grid.join(counts, on=["n_name", "st", "yr"], how="left").withColumn(
        "tok", F.when(F.col("n") >= 1000, F.translate(F.format_number("n", 0), ",", "."))
        .otherwise(F.coalesce(F.col("n"), F.lit(0)).cast("string")))
    pos = F.col("st_i") * len(years) + F.col("yr_i")
    files = cells.groupBy("n_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct(pos.alias("p"), F.col("tok").alias("t")))), lambda s: s["t"]), " ").alias("data"))
    vals = lambda xs: ",".join(f'"{x}"' for x in xs)
    files = files.select("n_name", F.concat(
        F.lit(f'CHARSET="ANSI";\nSTUB="estado";\nHEADING="periodo";\nVALUES("estado")={vals(states)};\n'
              f'VALUES("periodo")={vals(years)};\nDATA=\n'), F.col("data"), F.lit(";\n")).alias("content"))
    cube = PX.dims_to_columns(PX.parse_px(files, "content", keep=["n_name"]), ["status", "year"], keep=["n_name"])
    return cube.select("n_name", "status", F.col("year").cast("int").alias("year"), "value")


_WS = r"[\s\x{00A0}]+"


@query("src_html_records", covers=("SRC-9",), sql=f"""
WITH li AS (
  SELECT page_id, UNNEST(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)) AS item,
         UNNEST(generate_series(0, len(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)) - 1)) AS pos
  FROM pages)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       trim(regexp_replace(replace(replace(replace(replace(replace(replace(
            regexp_replace(item, '(?s)<[^>]*>', ' ', 'g'),
            '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
            '{_WS}', ' ', 'g')) AS text,
       NULLIF(regexp_extract(item, 'href="([^"]*)"', 1), '') AS href
FROM li
""")
def src_html_records(spark, sf_dir):
    pages = cat(spark, sf_dir)["pages"]
    return H.list_items(pages, "html", keep=["page_id"]).select("page_id", "pos", "text", "href")


@query("src_catalog_counts", covers=("SRC-10", "SRC-11"), sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {t}"
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")))
def src_catalog_counts(spark, sf_dir):
    return cat(spark, sf_dir).row_counts()


# --------------------------------------------------------------------------- SNK-2

@query("snk_split_even", covers=("SNK-2",), sql="""
WITH r AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn, COUNT(*) OVER () AS n FROM orders),
p AS (SELECT o_orderkey, CASE WHEN n // 3 = 0 THEN 2 ELSE LEAST((rn - 1) // (n // 3), 2) END AS part FROM r)
SELECT CAST(part AS INTEGER) AS part, CAST(COUNT(*) AS BIGINT) AS n_rows, MIN(o_orderkey) AS min_key, MAX(o_orderkey) AS max_key
FROM p GROUP BY part
""")
def snk_split_even(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].select("o_orderkey")
    s = R.split_even(o, ["o_orderkey"], parts=3)
    return s.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("min_key"),
                                 F.max("o_orderkey").alias("max_key"))


# --------------------------------------------------------------------------- RSH

def _wide_years(spark, sf_dir):
    ny = _ny_text(spark, sf_dir).withColumn("rev", F.col("rev").cast("double"))
    ny = materialize(ny, "wide_years")
    years, = labels_of(ny, "yr")
    return ny.groupBy("n_name").pivot("yr", years).agg(F.first("rev")).select(
        "n_name", *[F.col(str(y)) for y in years], F.lit("x").alias("note"))


@query("rsh_melt_years", covers=("RSH-1",), sql=f"""
{W}
SELECT n_name, yr AS year, {sql_money_sum('o_totalprice')} AS revenue FROM geo GROUP BY 1, 2
""")
def rsh_melt_years(spark, sf_dir):
    long = RS.melt_years(_wide_years(spark, sf_dir), ["n_name"], "revenue")
    return long.select("n_name", "year", N.safe_double("revenue").alias("revenue")).dropna(subset=["revenue"])


@query("rsh_melt_split", covers=("RSH-2", "FN-17"), sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'status_' || o_orderstatus AS grp, 'orders' AS measure,
       CAST(COUNT(*) AS BIGINT) AS value FROM orders GROUP BY 1, 2
UNION ALL
SELECT CAST(year(o_orderdate) AS INTEGER), 'status_' || o_orderstatus, 'customers', CAST(COUNT(DISTINCT o_custkey) AS BIGINT)
FROM orders GROUP BY 1, 2
""")
def rsh_melt_split(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int"))
    aggs = []
    for s in labels_of(o, "o_orderstatus")[0]:
        aggs += [F.count_if(F.col("o_orderstatus") == s).alias(f"status_{s}_orders"),
                 F.count_distinct(F.when(F.col("o_orderstatus") == s, F.col("o_custkey"))).alias(f"status_{s}_customers")]
    wide = o.groupBy("year").agg(*aggs)
    cols = [c for c in wide.columns if c != "year"]
    long = RS.melt_split(wide, ["year"], cols, "_", ("grp", "measure"))
    return long.select("year", "grp", "measure", F.col("value").cast("long").alias("value"))


@query("rsh_pivot_first", covers=("RSH-3", "AGG-12"), sql=f"""
{W},
f AS (SELECT r_name, yr, arg_min(n_name, o_orderkey) AS first_nation, COUNT(DISTINCT n_name) AS n FROM geo GROUP BY 1, 2)
SELECT r_name, string_agg(yr || '=' || first_nation, ' ' ORDER BY yr) AS cells, MIN(yr) AS first_year, MAX(yr) AS last_year
FROM f GROUP BY 1
""")
def rsh_pivot_first(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    p = RS.pivot_map(g, ["r_name"], "yr", "n_name", F.col("o_orderkey"))
    keys = F.map_keys("cells")
    return p.select("r_name", _cells_text().alias("cells"), F.array_min(keys).alias("first_year"), F.array_max(keys).alias("last_year"))


@query("rsh_header_parse", covers=("RSH-4", "FN-16", "FN-3", "AGG-7"), sql=f"""
{W}
SELECT r_name, o_orderpriority AS label,
       CASE WHEN mon = 8 THEN 6 ELSE mon END AS month_num, yr AS year, CAST(COUNT(*) AS BIGINT) AS n
FROM geo GROUP BY r_name, o_orderpriority, mon, yr
""")
def rsh_header_parse(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    names = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    col_idx = (F.col("yr") * 12 + F.col("mon")).cast("int")
    row_idx = F.regexp_extract("o_orderpriority", r"^(\d+)", 1).cast("int")
    counts = materialize(g.groupBy("r_name", "o_orderpriority", "yr", "mon").agg(F.count(F.lit(1)).alias("n")),
                         "header_counts")
    body = counts.select("r_name", row_idx.alias("row_idx"), col_idx.alias("col_idx"), F.col("n").cast("string").alias("text"))
    head = counts.select("r_name", "yr", "mon").distinct().select(
        "r_name", F.lit(0).alias("row_idx"), col_idx.alias("col_idx"),
        F.concat(F.element_at(names, F.col("mon")), F.lit(" "), F.col("yr").cast("string")).alias("text"))
    lab = counts.select("r_name", "o_orderpriority").distinct().select(
        "r_name", row_idx.alias("row_idx"), F.lit(0).alias("col_idx"), F.col("o_orderpriority").alias("text"))
    cells = R.union_all([body, head, lab])
    long = RS.melt_with_header(cells, ["r_name"])
    return long.select("r_name", "label", L.month_number("month").alias("month_num"),
                       F.col("year").cast("int").alias("year"), F.col("text").cast("long").alias("n"))


@query("rsh_column_year_map", covers=("RSH-5", "FN-16"), sql="""
SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(quarter(o.o_orderdate) AS INTEGER) AS col_pos,
       CAST(COUNT(*) AS BIGINT) AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2, 3
""")
def rsh_column_year_map(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir)).withColumn("q", F.quarter("o_orderdate"))
    wide = g.groupBy("n_name", "yr").agg(*[F.count_if(F.col("q") == i).alias(f"q{i}") for i in range(1, 5)])
    # the sheet name carries the year; four quarter columns share it (last year repeats)
    wide = wide.withColumn("sheet", F.concat(F.lit("Precios vivienda "), F.col("yr").cast("string")))
    long = RS.melt_year_map(wide, ["n_name"], ["q1", "q2", "q3", "q4"], X.years_in(F.col("sheet")))
    return long.select("n_name", "year", "col_pos", F.col("value").cast("long").alias("value")).where(F.col("value") > 0)


@query("rsh_stack_groups", covers=("RSH-6",), sql=f"""
{W}
SELECT n_name, yr AS year, o_orderstatus AS label, CAST(COUNT(*) AS BIGINT) AS n, {sql_money_sum('o_totalprice')} AS rev
FROM geo WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2, 3
""")
def rsh_stack_groups(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    wide = g.groupBy("n_name", "yr").agg(
        *[F.count_if(F.col("o_orderstatus") == s).alias(f"{s}_n") for s in ("F", "O")],
        *[F.sum(F.when(F.col("o_orderstatus") == s, N.money("o_totalprice"))).alias(f"{s}_rev") for s in ("F", "O")])
    st = RS.stack_groups(wide, ["n_name", "yr"], [("F", {"n": "F_n", "rev": "F_rev"}), ("O", {"n": "O_n", "rev": "O_rev"})])
    return st.where(F.col("n").cast("long") > 0).select(
        "n_name", F.col("yr").alias("year"), "label", F.col("n").cast("long").alias("n"),
        F.col("rev").cast("decimal(18,2)").cast("double").alias("rev"))


@query("rsh_row_records", covers=("RSH-7",), sql=f"""
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
     l AS (SELECT * FROM (VALUES ('urgent', '1-URGENT'), ('high', '2-HIGH'), ('none', '9-NONE')) t(label, prio)),
     c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS prio, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT y.year, l.label, CAST(COALESCE(c.n, 0) AS DOUBLE) AS value
FROM y CROSS JOIN l LEFT JOIN c ON c.year = y.year AND c.prio = l.prio
""")
def rsh_row_records(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"].withColumn("year", F.year("o_orderdate").cast("int"))
    wide = o.groupBy("year").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
                                 F.count_if(F.col("o_orderpriority") == "2-HIGH").alias("high"),
                                 F.lit(None).cast("long").alias("none"))
    return RS.row_records(wide, ["urgent", "high", "none"], ids=["year"])


@query("rsh_flatten_header", covers=("RSH-8",), sql="""
SELECT r_regionkey * 2 AS col_idx, r_name || '_orders' AS column_name FROM region
UNION ALL
SELECT r_regionkey * 2 + 1, r_name || '_customers' FROM region
""")
def rsh_flatten_header(spark, sf_dir):
    r = cat(spark, sf_dir)["region"]
    top = r.select(F.lit("t").alias("tbl"), F.lit(0).alias("row_idx"), (F.col("r_regionkey") * 2).alias("col_idx"),
                   F.col("r_name").alias("text"))
    top_blank = r.select(F.lit("t").alias("tbl"), F.lit(0).alias("row_idx"),
                         (F.col("r_regionkey") * 2 + 1).alias("col_idx"), F.lit("").alias("text"))
    bot = r.select(F.lit("t").alias("tbl"), F.lit(1).alias("row_idx"), (F.col("r_regionkey") * 2).alias("col_idx"),
                   F.lit("orders").alias("text"))
    bot2 = r.select(F.lit("t").alias("tbl"), F.lit(1).alias("row_idx"), (F.col("r_regionkey") * 2 + 1).alias("col_idx"),
                    F.lit("customers").alias("text"))
    f = RS.flatten_header(R.union_all([top, top_blank, bot, bot2]), ["tbl"])
    return f.select(F.col("col_idx").cast("int").alias("col_idx"), "column_name")


@query("src_latest_file", covers=("SRC-12", "SNK-1"), sql="""
SELECT n.n_name, CAST(COUNT(*) AS BIGINT) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE year(o.o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders)
GROUP BY 1
""")
def src_latest_file(spark, sf_dir):
    """Write one small CSV per year (nation counts), then read back only the file whose path
    sorts last: the latest year."""
    from ..session import scratch_path
    from ..sources.catalog import latest_file
    from ..sources.sinks import write_csv
    g = geo_orders(cat(spark, sf_dir))
    agg = g.groupBy("yr", "n_name").agg(F.count(F.lit(1)).alias("n_orders"))
    base = scratch_path(spark, "yearly")
    # one file per year folder: the per-year aggregate is small (one row per nation)
    write_csv(agg.repartition("yr"), base, partition_by=["yr"])
    last = latest_file(spark, f"{base}/yr=*/*.csv", fmt="csv", by="file_path",
                       options={"header": "true", "inferSchema": "false"})
    return last.select("n_name", F.col("n_orders").cast("long").alias("n_orders"))
