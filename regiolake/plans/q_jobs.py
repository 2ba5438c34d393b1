"""Registered queries for the clean-table jobs (JOB-*).

Each query renders the job's raw input shape from the driver tables with Spark
(one raw "file" per region or per nation), runs the job function itself, and
returns its output; the oracle is the direct SQL aggregate.  Renderers group
rows only by dimension values, so every rendered file is bounded by the
number of dimension members and periods, not by the data volume.
"""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import relational as R
from ..session import materialize, scratch_path
from ..sources import px as PX
from ..sources.sinks import append_parts
from . import jobs as JB
from .common import GEO_SQL, cat, geo_orders, labels_of, nation_region, write_files
from .q_relational import _MONTH_NAMES
from .registry import query, sql_money_sum

W = f"WITH {GEO_SQL.strip()}"


def _m(var, val):
    return F.struct(F.lit(var).alias("T3_Variable"), val.alias("Nombre"))


def _json_files(agg, file_keys, series_keys, point, meta, title=None):
    """Render one JSON list per ``file_keys`` group with one series per ``series_keys`` group."""
    s = agg.groupBy(*file_keys, *series_keys).agg(F.array_sort(F.collect_list(point)).alias("Data"))
    fields = [meta.alias("MetaData"), F.col("Data"), F.lit("Euros").alias("T3_Unidad")]
    if title is not None:
        fields.append(title.alias("Nombre"))
    return s.groupBy(*file_keys).agg(F.to_json(F.collect_list(F.struct(*fields))).alias("content"))


def _rev_str(c="rev"):
    return F.col(c).cast("string")


def _nsy(c):
    return geo_orders(c).groupBy("r_name", "n_name", "o_orderstatus", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"))


# --------------------------------------------------------------------------- JSON jobs

def _half_even_mean_sql(total: str, n: str) -> str:
    """Exact mean rounded half-even to cents, in integer arithmetic (oracle side)."""
    c = f"CAST(({total}) * 100 AS HUGEINT)"
    q, r = f"({c} // ({n}))", f"({c} % ({n}))"
    return (f"CAST(CASE WHEN 2 * {r} > ({n}) THEN {q} + 1 WHEN 2 * {r} = ({n}) THEN {q} + ({q} % 2) ELSE {q} END "
            f"AS DOUBLE) / 100.0")


# points without a value: the rendered series have none for 2001
_REJECTED = "(SELECT COUNT(DISTINCT (n_name, o_orderstatus)) FROM geo WHERE yr = 2001) AS n_rejected"
_REJECTED_POP = ("(SELECT COUNT(DISTINCT (n_name, o_orderstatus)) + COUNT(DISTINCT (r_name, o_orderstatus)) FROM geo WHERE yr = 2001)")


def _population(spark, sf_dir):
    a = _nsy(cat(spark, sf_dir))
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == 2001, F.lit(None)).otherwise(_rev_str()).alias("Valor"),
                     F.lit("1 de julio de").alias("T3_Periodo"))
    sex, age = _m("Sexo", F.col("o_orderstatus")), _m("Edad", F.lit("Total"))
    prov = _json_files(a, ["r_name"], ["n_name", "o_orderstatus"], point,
                       F.array(_m("Provincias", F.col("n_name")), sex, age))
    reg = _json_files(a.groupBy("r_name", "o_orderstatus", "yr").agg(F.sum("rev").alias("rev")),
                      ["r_name"], ["o_orderstatus"], point,
                      F.array(_m("Comunidades y Ciudades Autónomas", F.col("r_name")), sex, age))
    return JB.job_population(prov.unionByName(reg))


@query("job_population_parts", covers=("JOB-01", "SRT-1", "SNK-1", "SNK-2", "SNK-6"), sql=f"""
{W},
p AS (SELECT 'province' AS level, n_name AS territory, yr AS year, o_orderstatus AS sex, {sql_money_sum('o_totalprice')} AS population
      FROM geo WHERE yr <> 2001 GROUP BY n_name, yr, o_orderstatus
      UNION ALL SELECT 'ccaa', r_name, yr, o_orderstatus, {sql_money_sum('o_totalprice')} FROM geo WHERE yr <> 2001 GROUP BY r_name, yr, o_orderstatus),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY level, territory, year, sex) - 1 AS nr, COUNT(*) OVER () // 3 AS size FROM p),
t AS (SELECT *, CASE WHEN size = 0 THEN 2 ELSE LEAST(nr // size, 2) END AS part FROM r)
SELECT CAST(part AS INTEGER) AS part, CAST(COUNT(*) AS BIGINT) AS n, arg_min(territory, nr) AS first_territory,
       arg_max(territory, nr) AS last_territory, SUM(CAST(population AS DECIMAL(18,2)))::DOUBLE AS population FROM t GROUP BY 1
""")
def job_population_parts(spark, sf_dir):
    """The three load files of the population job, each read back from its own folder."""
    out, _ = _population(spark, sf_dir)
    base = scratch_path(spark, "population-files")
    JB.write_population(out, base)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    back = R.union_all([append_parts(spark, [f"{base}/part={i}"], schema).withColumn("part", F.lit(i)) for i in range(3)])
    place = F.struct(*JB.POPULATION_ORDER[:4])
    return back.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min_by("territory", place).alias("first_territory"),
                                    F.max_by("territory", place).alias("last_territory"),
                                    F.sum(F.col("population").cast("decimal(18,2)")).cast("double").alias("population"))


@query("job_population", covers=("JOB-01", "SRC-3", "FLT-9", "FN-21"), sql=f"""
{W}
SELECT 'province' AS level, n_name AS territory, yr AS year, {sql_money_sum('o_totalprice')} AS population,
       o_orderstatus AS sex, 'Todas las edades' AS age_group, '1 de julio de' AS periodo, {_REJECTED_POP} AS skipped_points
FROM geo WHERE yr <> 2001 GROUP BY n_name, yr, o_orderstatus
UNION ALL
SELECT 'ccaa', r_name, yr, {sql_money_sum('o_totalprice')}, o_orderstatus, 'Todas las edades', '1 de julio de', {_REJECTED_POP}
FROM geo WHERE yr <> 2001 GROUP BY r_name, yr, o_orderstatus
""")
def job_population(spark, sf_dir):
    out, rejects = _population(spark, sf_dir)
    # the number of rejected points is part of the result (FLT-9)
    return out.select("level", "territory", "year", "population", "sex", "age_group", "periodo",
                      rejects.scalar().alias("skipped_points"))


@query("job_poverty", covers=("JOB-11", "SRC-4", "FN-17"), sql=f"""
{W}
SELECT 'ccaa' AS level, n_name AS territory, 'Todas las edades. Tasa ' || o_orderstatus || '. Base 2013.' AS indicator,
       yr AS year, {sql_money_sum('o_totalprice')} AS value, {_REJECTED}
FROM geo WHERE yr <> 2001 GROUP BY n_name, o_orderstatus, yr
""")
def job_poverty(spark, sf_dir):
    a = _nsy(cat(spark, sf_dir))
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == 2001, F.lit("..")).otherwise(_rev_str()).alias("Valor"))
    title = F.concat(F.col("n_name"), F.lit(". Todas las edades. Tasa "), F.col("o_orderstatus"), F.lit(". Base 2013."))
    files = _json_files(a, ["r_name"], ["n_name", "o_orderstatus"], point, F.array(), title=title)
    # the file-level layout {"Data": [...]} is accepted as well as a root list
    files = files.withColumn("content", F.concat(F.lit('{"Data": '), F.col("content"), F.lit("}")))
    out, rejects = JB.job_poverty_counted(files)
    return out.select("level", "territory", "indicator", "year", "value", rejects.scalar().alias("n_rejected"))


@query("job_migration", covers=("JOB-02", "SRC-1", "FN-5"), sql=f"""
{W}
SELECT r_name AS region, o_orderstatus AS indicator, 'Ambos sexos' AS sex, n_name AS nationality,
       yr AS year, {sql_money_sum('o_totalprice')} AS value, 'Euros' AS unit, {_REJECTED}
FROM geo WHERE yr <> 2001 GROUP BY r_name, o_orderstatus, n_name, yr
""")
def job_migration(spark, sf_dir):
    a = _nsy(cat(spark, sf_dir))
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == 2001, F.lit("n.d.")).otherwise(_rev_str()).alias("Valor"))
    meta = F.array(_m("Comunidades y Ciudades Autónomas", F.col("r_name")),
                   _m("Conceptos demógraficos", F.col("o_orderstatus")), _m("Sexo", F.lit("Ambos sexos")),
                   _m("Nacionalidad", F.lit("placeholder")), _m("Nacionalidad", F.col("n_name")))
    files = _json_files(a, ["r_name"], ["n_name", "o_orderstatus"], point, meta)
    out, rejects = JB.job_migration_counted(files)
    return out.select("region", "indicator", "sex", "nationality", "year", "value", "unit", rejects.scalar().alias("n_rejected"))


@query("job_earnings", covers=("JOB-03", "SRC-1", "FN-5", "FLT-9"), sql=f"""
{W}
SELECT o_orderstatus AS sex, n_name AS age_group, yr AS year, {sql_money_sum('o_totalprice')} AS value,
       (SELECT COUNT(DISTINCT (o_orderstatus, n_name)) FROM geo WHERE yr = 1995) AS discarded
FROM geo WHERE yr <> 1995 GROUP BY o_orderstatus, n_name, yr
""")
def job_earnings(spark, sf_dir):
    a = _nsy(cat(spark, sf_dir))
    point = F.struct(F.col("yr").cast("string").alias("NombrePeriodo"),
                     F.when(F.col("yr") == 1995, F.lit("x")).otherwise(_rev_str()).alias("Valor"))
    meta = F.array(_m("sexo", F.col("o_orderstatus")), _m("grupo de edad", F.col("n_name")))
    files = _json_files(a, ["r_name"], ["n_name", "o_orderstatus"], point, meta)
    out, discarded = JB.job_earnings(files)
    return out.select("sex", "age_group", "year", "value", discarded.scalar().alias("discarded"))


@query("job_employment", covers=("JOB-04", "SRC-2", "FN-19"), sql=f"""
{W}
SELECT 'Ocupados' AS relation_activity, 'Total Nacional' AS territory, o_orderstatus AS sex,
       o_orderpriority AS sector, n_name AS nationality, yr AS year,
       CASE WHEN yr = 2001 THEN NULL ELSE {sql_money_sum('o_totalprice')} END AS value
FROM geo GROUP BY o_orderstatus, o_orderpriority, n_name, yr
""")
def job_employment(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "n_name", "o_orderstatus", "o_orderpriority", "yr").agg(
        F.sum(N.money("o_totalprice")).alias("rev"))
    point = F.struct(F.col("yr").cast("string").alias("Anyo"),
                     F.when(F.col("yr") == 2001, F.lit(None)).otherwise(_rev_str()).alias("Valor"))
    # half of the series name the sector variable 'SECTORES ...', the others 'CNAE ...'
    sector_var = F.when(F.col("o_orderstatus") == "F", F.lit("SECTORES económicos")).otherwise(F.lit("CNAE 2009"))
    meta = F.array(_m("RELACIÓN CON LA ACTIVIDAD ECONÓMICA", F.lit("Ocupados")),
                   _m("Total Nacional", F.lit("Total Nacional")), _m("Sexo", F.col("o_orderstatus")),
                   F.struct(sector_var.alias("T3_Variable"), F.col("o_orderpriority").alias("Nombre")),
                   _m("Nacionalidad", F.col("n_name")))
    files = _json_files(a, ["r_name"], ["n_name", "o_orderstatus", "o_orderpriority"], point, meta)
    return JB.job_employment(files).select("relation_activity", "territory", "sex", "sector", "nationality",
                                           "year", "value")


# --------------------------------------------------------------------------- text jobs

def _wide_files(agg, file_key, dims, value, header_dims, title):
    """Titled wide CSV per ``file_key``: dims columns, then one quoted column for each year that the file has
    values for; every second file (by its key) lists its years in descending order."""
    years = agg.groupBy(file_key).agg(F.array_sort(F.collect_set("yr")).alias("ys"))          # a dimension's members
    years = years.withColumn("ys", F.when(F.crc32(F.col(file_key).cast("binary")) % 2 == 0, F.reverse("ys")).otherwise(F.col("ys")))
    by_row = agg.groupBy(file_key, *dims).agg(F.map_from_entries(F.collect_list(F.struct("yr", value))).alias("m"))
    rows = by_row.join(years, on=file_key)
    quoted = F.transform("ys", lambda y: F.concat(F.lit('"'), F.coalesce(F.element_at("m", y), F.lit("")), F.lit('"')))
    lines = rows.select(file_key, "ys", F.concat_ws(",", *[F.col(d) for d in dims], F.array_join(quoted, ",")).alias("line"), *dims)
    body = lines.groupBy(file_key, "ys").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct(*[F.col(d) for d in dims], F.col("line")))), lambda s: s["line"]), "\n").alias("body"))
    header = F.concat_ws(",", *[F.lit(h) for h in header_dims], F.array_join(F.transform("ys", lambda y: y.cast("string")), ","))
    return body.select(file_key, F.concat_ws("\n", F.concat(F.lit(title), F.col(file_key)), header, F.col("body")).alias("content"))


@query("job_activity_rates", covers=("JOB-05", "SRC-5", "PRJ-3", "RSH-1", "FN-4"), sql=f"""
{W}
SELECT o_orderstatus AS rate_type, r_name AS province, o_orderpriority AS nationality,
       'Annual average' AS quarter, yr AS year, {sql_money_sum('o_totalprice')} AS value
FROM geo GROUP BY o_orderstatus, r_name, o_orderpriority, yr
""")
def job_activity_rates(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "o_orderstatus", "o_orderpriority", "yr").agg(F.sum(N.money("o_totalprice")).alias("rev"))
    a = a.withColumn("v", F.translate(_rev_str(), ".", ",")).withColumn("q", F.lit("Annual average"))
    files = _wide_files(a.withColumn("prov", F.col("r_name")), "r_name", ["o_orderstatus", "prov", "o_orderpriority", "q"],
                        "v", ["Tipo", "Territorio", "Nacionalidad", "Periodo"], "Tasas por nacionalidad, ")
    return JB.job_activity_rates(files).select("rate_type", "province", "nationality", "quarter", "year", "value")


@query("job_population_nationality", covers=("JOB-06", "SRC-5", "DQ-1", "RSH-1", "PRJ-2"), sql=f"""
{W}
SELECT 'País Vasco' AS ccaa, r_name AS province, n_name AS nationality, o_orderstatus AS relation_with_activity,
       o_orderpriority AS sex, yr AS year, CAST(COUNT(*) AS DOUBLE) AS population
FROM geo GROUP BY r_name, n_name, o_orderstatus, o_orderpriority, yr
""")
def job_population_nationality(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    a = g.groupBy("r_name", "n_name", "o_orderstatus", "o_orderpriority", "yr").agg(
        F.count(F.lit(1)).cast("string").alias("v")).withColumn("prov", F.col("r_name"))
    files = _wide_files(a, "r_name", ["prov", "n_name", "o_orderstatus", "o_orderpriority"], "v",
                        JB.POP_NAT_IDS, "Population by nationality, ")
    return JB.job_population_nationality(files).select("ccaa", "province", "nationality", "relation_with_activity",
                                                       "sex", "year", "population")


@query("job_population_origin", covers=("JOB-07", "SRC-7", "FN-5", "PRJ-2"), sql="""
SELECT r.r_name AS province, n.n_name AS nationality, 2024 AS year, CAST(COUNT(*) AS BIGINT) AS population
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, n.n_name
""")
def job_population_origin(spark, sf_dir):
    c = cat(spark, sf_dir)
    cu = c["customer"].select(F.col("c_nationkey").alias("n_nationkey")).join(F.broadcast(nation_region(c)),
                                                                             on="n_nationkey")
    df = cu.groupBy(F.col("r_name").alias("provincia"), F.col("n_name").alias("nacionalidad")).agg(
        F.count(F.lit(1)).cast("string").alias("total"))
    return JB.job_population_origin(df).select("province", "nationality", "year", "population")


# Fixed values (analog only): regions standing in for the three register province codes.
_PADRON_ANALOG = {"AFRICA": "01 Araba/Álava", "AMERICA": "48 Bizkaia", "ASIA": "20 Gipuzkoa"}


@query("job_padron", covers=("JOB-12", "SRC-6", "FN-2", "FN-4"), sql=f"""
{W}
SELECT CASE r_name WHEN 'AFRICA' THEN 'Araba/Álava' WHEN 'AMERICA' THEN 'Bizkaia' ELSE 'Gipuzkoa' END AS province,
       CASE r_name WHEN 'AFRICA' THEN 'Araba' WHEN 'AMERICA' THEN 'Bizkaia' ELSE 'Gipuzkoa' END AS province_std,
       yr AS year, CAST(COUNT(*) AS BIGINT) * 1000 + 7 AS foreign_population
FROM geo WHERE o_orderstatus = 'F' AND r_name IN ('AFRICA', 'AMERICA', 'ASIA') GROUP BY r_name, yr
""")
def job_padron(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    code = F.coalesce(F.create_map(*[F.lit(x) for kv in _PADRON_ANALOG.items() for x in kv])[F.col("r_name")],
                      F.col("r_name"))
    a = g.groupBy("r_name", "o_orderstatus", "yr").agg(F.count(F.lit(1)).alias("n"))
    # Spanish thousands separator on a value that always needs one: n * 1000 + 7 -> "n.007"
    total = F.translate(F.format_number(F.col("n") * 1000 + 7, 0), ",", ".")
    nat = F.when(F.col("o_orderstatus") == "F", "TOTAL EXTRANJEROS").otherwise(F.col("o_orderstatus"))
    line = F.concat_ws(";", nat, code, F.lit("Ambos sexos"), F.col("yr").cast("string"), total)
    files = a.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    files = files.select(F.concat(F.lit("Nacionalidad;Provincias;Sexo;Periodo;Total\n"), F.col("body"),
                                  F.lit("\nlinea;corta")).alias("content"))
    return JB.job_padron(files)


@query("job_ecp", covers=("JOB-13", "FLT-7", "FN-7"), sql=f"""
{W}
SELECT r_name AS province_std, yr AS year, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS foreign_population,
       CAST(COUNT(*) AS BIGINT) AS total_population,
       {_half_even_mean_sql("100 * COUNT(*) FILTER (WHERE o_orderstatus = 'F')", "COUNT(*)")} AS foreign_population_pct
FROM geo WHERE yr <= 2000 GROUP BY r_name, yr
""")
def job_ecp(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    df = g.groupBy(F.col("r_name").alias("province_std"), F.col("yr").alias("year")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("foreign_population"),
        F.count(F.lit(1)).alias("total_population"))
    return JB.job_ecp(df, max_year=2000)


@query("job_ecp_pairing", covers=("JOB-16", "JN-11", "WIN-7", "FN-6"), sql=f"""
{W},
t AS (SELECT r_name, yr, mon, COUNT(*) AS n FROM geo GROUP BY 1, 2, 3),
f AS (SELECT r_name, yr, arg_max(n, mon) AS fn FROM
        (SELECT r_name, yr, mon, COUNT(*) AS n FROM geo WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT t.r_name AS province_std, t.yr AS year, CAST(f.fn AS BIGINT) AS foreign_population,
       CAST(t.n AS BIGINT) AS total_population
FROM t JOIN f ON t.r_name = f.r_name AND t.yr = f.yr
""")
def job_ecp_pairing(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    tot = g.groupBy(F.col("r_name").alias("province_std"), F.col("yr").alias("year"), F.col("mon").alias("obs_order")) \
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    fo = g.where(F.col("o_orderstatus") == "F").groupBy(F.col("r_name").alias("province_std"), F.col("yr").alias("year"),
                                                       F.col("mon").alias("obs_order")) \
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    return JB.job_ecp_pairing(tot, fo)


# --------------------------------------------------------------------------- PX jobs

def _px_files(dims_row, dims, counts, name):
    """Write PX cubes, a file for each label of the first dimension.

    ``dims_row`` is a one-row frame holding, per dimension ``d``, the label array ``d_lab`` (cube order) and a parallel array
    ``d_key`` of join keys (NULL for labels that match no cell, e.g. hierarchy headers).  ``counts`` has one column per
    dimension key (named like the dimension) and ``n``.  The grid comes from exploding those arrays; a line of the data vector
    holds the cells of the last dimension, and no row holds more."""
    grid = dims_row
    for d in dims:
        grid = grid.select("*", F.posexplode(F.arrays_zip(F.col(f"{d}_lab").alias("l"), F.col(f"{d}_key").alias("k")))
                           .alias(f"{d}_i", f"{d}_z"))
    grid = grid.select(*[F.col(f"{d}_i") for d in dims], *[F.col(f"{d}_z")["k"].alias(d) for d in dims])
    tok = (F.when(F.col("n").isNull(), F.lit('".."'))
            .when(F.col("n") >= 1000, F.concat(F.lit('"'), F.translate(F.format_number("n", 0), ",", "."), F.lit('"')))
            .otherwise(F.col("n").cast("string")))
    at = [F.col(f"{d}_i") for d in dims]
    body = grid.join(counts, on=list(dims), how="left").groupBy(*at[:-1]).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(at[-1].alias("p"), tok.alias("t")))), lambda x: x["t"]), " ").alias("line"))
    body = body.select(at[0].alias("cube"), F.array(F.lit(2), *at[1:-1]).alias("ord"), "line")

    def values(d, labels):
        quoted = F.transform(labels, lambda x: F.concat(F.lit('"'), x, F.lit('"')))
        return F.concat(F.lit(f'VALUES("{d}")='), F.array_join(quoted, ","), F.lit(";"))
    heads = dims_row.select("*", F.posexplode(f"{dims[0]}_lab").alias("cube", "own")).select(
        "cube", F.posexplode(F.array(F.lit('CHARSET="ANSI";'), values(dims[0], F.array("own")),
                                     *[values(d, F.col(f"{d}_lab")) for d in dims[1:]], F.lit("DATA="))).alias("i", "line"))
    heads = heads.select("cube", F.array(F.lit(1), "i").alias("ord"), "line")
    ends = heads.select("cube", F.array(F.lit(3)).alias("ord"), F.lit(";").alias("line")).distinct()
    return write_files(R.union_all([heads, body, ends]), "cube", ["ord"], name)


def _fixed_dim(name, values):
    lab = F.array(*[F.lit(str(v)) for v in values])
    return [lab.alias(f"{name}_lab"), lab.alias(f"{name}_key")]


def _nation_hierarchy(c):
    """One row: hierarchical nationality labels in document order ("k.- REGION" headers
    followed by "k.nn.- NATION" children) and their join keys (NULL for headers)."""
    r = c["region"].select(F.col("r_regionkey").alias("rk"), F.lit(-1).alias("nk"),
                           F.concat((F.col("r_regionkey") + 1).cast("string"), F.lit(".- "), F.col("r_name")).alias("l"),
                           F.lit(None).cast("string").alias("k"))
    n = c["nation"].select(F.col("n_regionkey").alias("rk"), F.col("n_nationkey").alias("nk"),
                           F.concat((F.col("n_regionkey") + 1).cast("string"), F.lit("."),
                                    F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(".- "),
                                    F.col("n_name")).alias("l"), F.col("n_name").alias("k"))
    # 30 rows at most (nation and region are fixed-size dimension tables)
    z = r.unionByName(n).agg(F.array_sort(F.collect_list(F.struct("rk", "nk", "l", "k"))).alias("z"))
    return z.select(F.transform("z", lambda x: x["l"]).alias("Nacionalidad_lab"),
                    F.transform("z", lambda x: x["k"]).alias("Nacionalidad_key"))


@query("job_detentions", covers=("JOB-08", "SRC-8", "WIN-4", "FN-14", "FN-4"), sql=f"""
{W}
SELECT o_orderpriority AS province, r_name AS region, n_name AS nationality, o_orderstatus AS sex, yr AS year,
       CAST(COUNT(*) AS BIGINT) AS value
FROM geo GROUP BY o_orderpriority, r_name, n_name, o_orderstatus, yr
""")
def job_detentions(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = geo_orders(c)
    counts = g.groupBy(F.col("o_orderpriority").alias("Provincias"), F.col("n_name").alias("Nacionalidad"),
                       F.col("o_orderstatus").alias("Sexo"), F.col("yr").cast("string").alias("periodo")) \
        .agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "detentions")
    provinces, sexes, years = labels_of(counts, "Provincias", "Sexo", "periodo")
    dims_row = _nation_hierarchy(c).select(*_fixed_dim("Provincias", provinces), "Nacionalidad_lab", "Nacionalidad_key",
                                           *_fixed_dim("Sexo", sexes), *_fixed_dim("periodo", years))
    # the written cubes stand for the fetched files: one a province, read in splits
    files = _px_files(dims_row, ["Provincias", "Nacionalidad", "Sexo", "periodo"], counts, "px_detentions")
    return JB.detentions(PX.read_px(spark, files, strict_numbers=False))


@query("job_detentions_total", covers=("JOB-09", "SRC-8", "FN-4"), sql=f"""
{W}
SELECT r_name AS territory, o_orderpriority AS crime_type, 'TOTAL edad' AS age_group, o_orderstatus AS sex,
       yr AS year, CAST(COUNT(*) AS BIGINT) AS value
FROM geo GROUP BY r_name, o_orderpriority, o_orderstatus, yr
""")
def job_detentions_total(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = geo_orders(c)
    counts = g.groupBy(F.col("r_name").alias("territory"), F.col("o_orderpriority").alias("crime_type"),
                       F.lit("TOTAL edad").alias("age_group"), F.col("o_orderstatus").alias("sex"),
                       F.col("yr").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "detentions_total")
    types, sexes, years = labels_of(counts, "crime_type", "sex", "year")
    regions = c["region"].agg(F.array_sort(F.collect_list("r_name")).alias("territory_lab")) \
        .withColumn("territory_key", F.col("territory_lab"))
    dims_row = regions.select("territory_lab", "territory_key", *_fixed_dim("crime_type", types),
                              *_fixed_dim("age_group", ["TOTAL edad"]), *_fixed_dim("sex", sexes),
                              *_fixed_dim("year", years))
    files = _px_files(dims_row, ["territory", "crime_type", "age_group", "sex", "year"], counts, "px_detentions_total")
    return JB.detentions_total(PX.read_px(spark, files, strict_numbers=False))


# --------------------------------------------------------------------------- HTML job

@query("job_elections", covers=("JOB-14", "SRC-9", "RSH-4", "FN-16"), sql=f"""
{W}
SELECT CAST(yr AS VARCHAR) AS year,
       list_extract(['enero','feb.','marzo','abril','mayo','junio','julio','agosto','sept.','oct.','nov.','dic.'], mon) AS month,
       o_orderpriority AS party_name, CAST(COUNT(*) AS BIGINT) AS seats
FROM geo GROUP BY r_name, yr, mon, o_orderpriority
""")
def job_elections(spark, sf_dir):
    """One page per region: an anchor paragraph, then a table whose header cells read
    '<month> <year>' and whose body rows are (party, seats per column).  The pages are
    written once (they stand for the fetched files) and the job reads them."""
    g = geo_orders(cat(spark, sf_dir))
    names = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    col = (F.col("yr") * 12 + F.col("mon")).cast("int")     # a month's place in time, whatever the first year
    counts = g.groupBy("r_name", "o_orderpriority", col.alias("col")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "election_counts")
    # header cells derive from the column number: year and month are recovered arithmetically
    yr = F.floor((F.col("col") - 1) / 12).cast("int")
    mon = ((F.col("col") - 1) % 12 + 1).cast("int")
    heads = counts.select("r_name", "col").distinct().select(
        "r_name", "col", F.concat(F.element_at(names, mon), F.lit(" "), yr.cast("string")).alias("h"))
    # every (region, party, column) cell, empty when there are no orders (grid from the region's own columns)
    parties = counts.select("r_name", "o_orderpriority").distinct()
    grid = heads.join(parties, on="r_name").join(counts, on=["r_name", "o_orderpriority", "col"], how="left")
    td = F.concat(F.lit("<td>"), F.coalesce(F.col("n").cast("string"), F.lit("")), F.lit("</td>"))
    rows = grid.groupBy("r_name", "o_orderpriority").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("col", td.alias("td")))), lambda x: x["td"]), "").alias("tds"))
    rows = rows.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list(F.concat(
        F.lit("<tr><td>"), F.col("o_orderpriority"), F.lit("</td>"), F.col("tds"), F.lit("</tr>")))), "").alias("body"))
    head = heads.groupBy("r_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "h"))),
                                                                lambda x: F.concat(F.lit("<th>"), x["h"], F.lit("</th>"))),
                                                    "").alias("ths"))
    pages = head.join(rows, on="r_name").select(
        F.col("r_name").alias("page_id"),
        F.concat(F.lit("<html><body><h1>Composición</h1><p>Grupos parlamentarios</p><table><tr><th>Partido</th>"),
                 F.col("ths"), F.lit("</tr>"), F.col("body"), F.lit("</table></body></html>")).alias("html"))
    return JB.job_elections(materialize(pages, "election_pages"), id_col="page_id")


# --------------------------------------------------------------------------- housing / origin table

_ROMAN = ["I", "II", "III", "IV"]


def _loc(x):
    """Spanish-locale text of an exact decimal: thousands '.', decimal ','."""
    return F.translate(F.format_number(x.cast("double"), 2), ",.", ".,")


@query("job_housing", covers=("JOB-10", "SRC-5", "WIN-3", "FLT-5", "RSH-5", "RSH-6", "FN-15", "FN-2", "AGG-2", "SET-2"),
       sql=f"""
{W},
q AS (SELECT yr, CAST(quarter(o_orderdate) AS INTEGER) AS qt, r_name, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s
      FROM geo GROUP BY 1, 2, 3),
e AS (SELECT yr AS year, CASE r_name WHEN 'AFRICA' THEN 'Álava' WHEN 'AMERICA' THEN 'Bizkaia' ELSE 'Gipuzkoa' END AS province,
             'Province' AS region_type,
             {_half_even_mean_sql('SUM(s)', 'COUNT(*)')} AS price_per_m2, 'Eustat' AS source
      FROM q WHERE r_name IN ('AFRICA', 'AMERICA', 'ASIA') GROUP BY 1, 2),
m AS (SELECT yr, n_name, CAST(quarter(o_orderdate) AS INTEGER) AS qt, COUNT(*) AS n FROM geo GROUP BY 1, 2, 3),
s AS (SELECT yr AS year, 'Nation_' || substr(n_name, 8) AS province, 'Province' AS region_type,
             {_half_even_mean_sql('SUM(n)', 'COUNT(*)')} AS price_per_m2, 'MIVAU' AS source
      FROM m GROUP BY 1, 2)
SELECT * FROM e UNION ALL SELECT * FROM s
""")
def job_housing(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir)).withColumn("qt", F.quarter("o_orderdate"))
    m = N.money("o_totalprice")

    def rsum(cond):
        return F.sum(F.when(cond, m))
    r = F.col("r_name")
    st = F.col("o_orderstatus")
    cols = [F.sum(m), rsum(st == "F"), rsum(st == "O")]
    for reg in ["AFRICA", "AMERICA", "ASIA"]:
        cols += [rsum(r == reg), rsum((r == reg) & (st == "F")), rsum((r == reg) & (st == "O"))]
    q = materialize(g.groupBy("yr", "qt").agg(*[c.alias(f"v{i}") for i, c in enumerate(cols)]), "housing_quarters")
    roman = F.element_at(F.array(*[F.lit(x) for x in _ROMAN]), F.col("qt"))
    qline = F.concat_ws(";", roman, *[F.coalesce(_loc(F.col(f"v{i}")), F.lit("")) for i in range(12)])
    lines = q.select("yr", F.col("qt").alias("k"), qline.alias("line")).unionByName(
        q.select("yr").distinct().select("yr", F.lit(0).alias("k"),
                                         F.concat(F.col("yr").cast("string"), F.lit(";" * 12)).alias("line")))
    # a file a year: 4 title lines, a year line and its quarter lines
    titles = q.select("yr").distinct().select("yr", F.posexplode(F.array(*[F.lit(x) for x in (
        "Precio vivienda", "Euskadi", "(euros/m2)", ";;;")])).alias("i", "line"))
    eustat = write_files(titles.select("yr", (F.col("i") - 9).alias("k"), "line").unionByName(lines), "yr", ["k"], "housing_files")
    # ministry workbook: one sheet per year, 13 title rows, header row 13, one row per nation
    cnt = materialize(g.groupBy("yr", "n_name", "qt").agg(F.count(F.lit(1)).cast("string").alias("value")),
                      "housing_counts")
    nk = F.regexp_extract("n_name", r"(\d+)$", 1).cast("int")
    sheet = F.concat(F.lit("Precios vivienda "), F.col("yr").cast("string"))
    body = cnt.select(sheet.alias("sheet"), (14 + nk).alias("row_idx"), (1 + F.col("qt")).alias("col_idx"), "value")
    labels = cnt.select("yr", "n_name").distinct().select(sheet.alias("sheet"), (14 + nk).alias("row_idx"),
                                                        F.lit(1).alias("col_idx"), F.col("n_name").alias("value"))
    years = cnt.select("yr").distinct()
    head = years.select(sheet.alias("sheet"), F.lit(13).alias("row_idx"), F.explode(F.array(
        *[F.struct(F.lit(i + 2).alias("c"), F.lit(f"{i + 1}º Trimestre").alias("v")) for i in range(4)])).alias("h")) \
        .select("sheet", "row_idx", F.col("h.c").alias("col_idx"), F.col("h.v").alias("value"))
    title = years.select(sheet.alias("sheet"), F.lit(0).alias("row_idx"), F.lit(0).alias("col_idx"),
                         F.lit("Valor tasado de vivienda libre").alias("value"))
    cells = body.unionByName(labels).unionByName(head).unionByName(title)
    # the written files and workbook stand for the fetched inputs
    return JB.job_housing(None, materialize(cells, "housing_cells"), JB.housing_files(spark, eustat)).select(
        "year", "province", "region_type", "price_per_m2", "source")


@query("job_origin_table", covers=("JOB-15", "RSH-8", "RSH-2", "RSH-3", "FN-4"), sql="""
SELECT r.r_name AS provincia, c.c_mktsegment AS nacionalidad, CAST(COUNT(*) AS DOUBLE) AS total,
       CAST(COUNT(*) FILTER (WHERE c.c_acctbal < 0) AS DOUBLE) AS hombres,
       CAST(COUNT(*) FILTER (WHERE c.c_acctbal >= 0) AS DOUBLE) AS mujeres
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2
""")
def job_origin_table(spark, sf_dir):
    """Two-level header tables, one a province: province over (Total, Hombres, Mujeres), one row per segment."""
    c = cat(spark, sf_dir)
    cu = c["customer"].select("c_mktsegment", "c_acctbal", F.col("c_nationkey").alias("n_nationkey")) \
        .join(nation_region(c).select("n_nationkey", F.col("r_name").alias("table")), on="n_nationkey")
    a = materialize(cu.groupBy("table", "c_mktsegment").agg(F.count(F.lit(1)).alias("t"),
                                                            F.count_if(F.col("c_acctbal") < 0).alias("h"),
                                                            F.count_if(F.col("c_acctbal") >= 0).alias("m")),
                    "origin_counts")
    # rows of a table are its own segments, a few
    row = F.row_number().over(Window.partitionBy("table").orderBy("c_mktsegment")) + 1
    fmt = lambda x: F.when(x >= 1000, F.translate(F.format_number(x, 0), ",", ".")).otherwise(x.cast("string"))  # noqa
    body = a.withColumn("row_idx", row).select("table", "row_idx", F.inline(F.array(
        F.struct(F.lit(0).alias("col_idx"), F.col("c_mktsegment").alias("text")),
        *[F.struct(F.lit(k).alias("col_idx"), fmt(F.col(v)).alias("text")) for k, v in enumerate(["t", "h", "m"], 1)])))
    heads = a.select("table").distinct().select("table", F.inline(F.array(*[F.struct(
        F.lit(r).alias("row_idx"), F.lit(k).alias("col_idx"), t.alias("text")) for r, texts in enumerate((
            [F.col("table"), F.lit(""), F.lit("")], [F.lit(x) for x in ("Total", "Hombres", "Mujeres")])) for k, t in enumerate(texts, 1)])))
    return JB.job_origin_table(body.unionByName(heads)).select("provincia", "nacionalidad", "total", "hombres", "mujeres")
