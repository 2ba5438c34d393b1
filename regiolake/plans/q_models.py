"""Analog marts (MDL-19..26) on the driver tables: same operator composition as the
reference views, with the role mapping of :mod:`regiolake.plans.common`."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import relational as R
from .common import GEO_SQL, cat, geo_orders
from .registry import query, sql_fixed, sql_pct, sql_ratio

# --------------------------------------------------------------------------- MDL-22 (slice 0)
# events = orders; "foreign" = customers of region EUROPE (expressed as NOT IN the
# other regions, like the nationality exclusion list); population = distinct
# active customers of the year.

_OTHER_REGIONS = ["AFRICA", "AMERICA", "ASIA", "MIDDLE EAST"]

MDL_CRIME_RATES_SQL = f"""
WITH {GEO_SQL.strip()},
t AS (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(COUNT(*) AS BIGINT) AS total_events,
           CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS events_f,
           CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS events_o
    FROM orders GROUP BY 1
),
f AS (
    SELECT yr AS year, CAST(COUNT(*) AS BIGINT) AS foreign_events
    FROM geo WHERE r_name NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'MIDDLE EAST')
    GROUP BY yr
),
p AS (
    SELECT yr AS year,
           CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS total_population,
           CAST(COUNT(DISTINCT CASE WHEN r_name = 'EUROPE' THEN o_custkey END) AS BIGINT) AS foreign_population
    FROM geo GROUP BY yr
)
SELECT t.year, p.total_population, p.foreign_population,
       p.total_population - p.foreign_population AS rest_population,
       t.total_events, t.events_f, t.events_o, f.foreign_events,
       t.total_events - f.foreign_events AS rest_events,
       {sql_pct('p.foreign_population', 'p.total_population')} AS foreign_population_pct,
       {sql_pct('f.foreign_events', 't.total_events')} AS foreign_event_pct,
       {sql_fixed(f"{sql_ratio('f.foreign_events', 't.total_events')} / NULLIF({sql_ratio('p.foreign_population', 'p.total_population')}, 0)")} AS over_representation_ratio,
       {sql_fixed(f"{sql_ratio('t.total_events', 'p.total_population')} * 100000.0")} AS total_event_rate_per_100k,
       {sql_fixed(f"{sql_ratio('f.foreign_events', 'p.foreign_population')} * 100000.0")} AS foreign_event_rate_per_100k,
       {sql_fixed(f"{sql_ratio('t.total_events - f.foreign_events', 'p.total_population - p.foreign_population')} * 100000.0")} AS rest_event_rate_per_100k
FROM t JOIN f ON t.year = f.year
LEFT JOIN p ON t.year = p.year
"""


def crime_rates(orders, geo, foreign_filter, foreign_flag):
    """MDL-22 composition: AGG-3 pivot of events, AGG-1 of foreign events, distinct
    population per year, JN-2 + JN-4, then FN-8..11.

    Two scans in total: ``orders`` once for the yearly event pivot (with the total
    count in the same aggregate), and the order star once, pre-aggregated per
    (year, customer) so that foreign events, population and foreign population all
    come from that one aggregate."""
    t = R.conditional_pivot(orders.withColumn("year", F.year("o_orderdate").cast("int")).withColumn("one", F.lit(1)),
                            ["year"], "o_orderstatus", "one", {"events_f": "F", "events_o": "O"},
                            agg="sum", else_value=0, extra=[F.count(F.lit(1)).alias("total_events")])
    # distinct active customers per year: de-duplicate (yr, custkey) first, then count
    per_cust = geo.groupBy("yr", "o_custkey").agg(F.max(foreign_flag.cast("int")).alias("is_foreign"),
                                                  F.count_if(foreign_filter).alias("fe"))
    pf = per_cust.groupBy(F.col("yr").alias("year")).agg(
        F.count(F.lit(1)).alias("total_population"),
        F.sum("is_foreign").cast("long").alias("foreign_population"),
        F.sum("fe").cast("long").alias("foreign_events"))
    # inner join with the foreign events (years with at least one), as the view's JOIN does
    j = t.join(pf.where(F.col("foreign_events") > 0), on="year", how="inner")
    return j.select(
        "year", "total_population", "foreign_population",
        N.complement("total_population", "foreign_population").alias("rest_population"),
        "total_events", F.col("events_f").cast("long").alias("events_f"),
        F.col("events_o").cast("long").alias("events_o"), "foreign_events",
        N.complement("total_events", "foreign_events").alias("rest_events"),
        N.pct("foreign_population", "total_population").alias("foreign_population_pct"),
        N.pct("foreign_events", "total_events").alias("foreign_event_pct"),
        N.over_representation("foreign_events", "total_events", "foreign_population", "total_population")
        .alias("over_representation_ratio"),
        N.rate_per("total_events", "total_population").alias("total_event_rate_per_100k"),
        N.rate_per("foreign_events", "foreign_population").alias("foreign_event_rate_per_100k"),
        N.rate_per(N.complement("total_events", "foreign_events"),
                   N.complement("total_population", "foreign_population")).alias("rest_event_rate_per_100k"),
    )


@query("mdl_crime_rates", covers=("MDL-22", "MDL-05", "MDL-19", "MDL-21", "AGG-3", "FLT-2", "JN-2", "JN-4",
                                  "FN-7", "FN-8", "FN-9", "FN-10", "FN-11"), sql=MDL_CRIME_RATES_SQL)
def mdl_crime_rates(spark, sf_dir):
    c = cat(spark, sf_dir)
    geo = geo_orders(c)
    return crime_rates(c["orders"], geo, ~F.col("r_name").isin(_OTHER_REGIONS), F.col("r_name") == "EUROPE")


# --------------------------------------------------------------------------- real models on derived base tables
# The reference models run unchanged (regiolake.plans.models) on base tables that Spark derives
# from the driver tables in the base-table schemas; label values are mapped onto the ones the
# models filter on.

from ..plans import models as M  # noqa: E402
from ..plans.schemas import SCHEMAS  # noqa: E402
from ..sources.sinks import conform  # noqa: E402

_PROV = {"AFRICA": "Araba/Álava", "AMERICA": "Bizkaia", "ASIA": "Gipuzkoa", "EUROPE": "Madrid",
         "MIDDLE EAST": "Bizkaia Norte"}
_PROV_SQL = ("CASE r_name WHEN 'AFRICA' THEN 'Araba/Álava' WHEN 'AMERICA' THEN 'Bizkaia' WHEN 'ASIA' THEN 'Gipuzkoa' "
             "WHEN 'EUROPE' THEN 'Madrid' ELSE 'Bizkaia Norte' END")


def _map(col, mapping, default=None):
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.try_element_at(m, F.col(col))
    return hit if default is None else F.coalesce(hit, default)


def _crime_base(c, n=None):
    """From a catalog, or from the orders star by its dimensions with ``n`` as the number of orders."""
    g, n = (geo_orders(c), F.count(F.lit(1))) if n is None else (c, n)
    nat = F.when(F.col("n_name") == "NATION_0", "España").when(F.col("n_name") == "NATION_5", "Sin determinar") \
        .when(F.col("n_name") == "NATION_10", F.lit(None)).otherwise(F.col("n_name"))
    sex = F.when(F.col("o_orderstatus") == "F", "Ambos sexos").when(F.col("o_orderstatus") == "O", "Hombres") \
        .otherwise("Mujeres")
    base = g.groupBy(_map("r_name", _PROV).alias("province"), F.col("r_name").alias("region"), nat.alias("nationality"),
                     sex.alias("sex"), F.col("yr").alias("year")).agg(n.alias("value"))
    return {"crime_detentions": conform(base, SCHEMAS["crime_detentions"])}


CRIME_BASE_SQL = f"""{GEO_SQL.strip()},
base AS (SELECT {_PROV_SQL} AS province, r_name AS region,
                CASE n_name WHEN 'NATION_0' THEN 'España' WHEN 'NATION_5' THEN 'Sin determinar' WHEN 'NATION_10' THEN NULL
                            ELSE n_name END AS nationality,
                CASE o_orderstatus WHEN 'F' THEN 'Ambos sexos' WHEN 'O' THEN 'Hombres' ELSE 'Mujeres' END AS sex,
                yr AS year, COUNT(*) AS value
         FROM geo GROUP BY 1, 2, 3, 4, 5),
clean AS (SELECT CASE WHEN lower(province) LIKE 'araba%' THEN 'Araba' WHEN lower(province) LIKE 'bizkaia%' THEN 'Bizkaia'
                      WHEN lower(province) LIKE 'gipuzkoa%' THEN 'Gipuzkoa' END AS province_std,
                 region, province AS province_original, year, nationality, CAST(SUM(value) AS BIGINT) AS total_detentions
          FROM base WHERE sex = 'Ambos sexos'
            AND (lower(province) LIKE 'araba%' OR lower(province) LIKE 'bizkaia%' OR lower(province) LIKE 'gipuzkoa%')
          GROUP BY 1, 2, 3, 4, 5)"""


@query("mdl_crime_clean", covers=("MDL-04", "FLT-1", "FLT-4", "FN-1", "AGG-1"),
       sql=f"WITH {CRIME_BASE_SQL}\nSELECT * FROM clean")
def mdl_crime_clean(spark, sf_dir):
    return M.stg_crime_by_province_nationality_clean(_crime_base(cat(spark, sf_dir)))


@query("mdl_foreign_detentions", covers=("MDL-19", "FLT-2", "AGG-1"), sql=f"""WITH {CRIME_BASE_SQL}
SELECT year, CAST(SUM(total_detentions) AS BIGINT) AS total_foreign_detentions FROM clean
WHERE nationality NOT IN ('España', 'Española', 'Total', 'Sin determinar') GROUP BY year
""")
def mdl_foreign_detentions(spark, sf_dir):
    return M.int_foreign_detentions_pv(_crime_base(cat(spark, sf_dir)))


_PROV_EUSTAT = {"AFRICA": "Araba/Alava", "AMERICA": "Bizkaia", "ASIA": "Gipuzkoa"}


@query("mdl_foreign_population_province", covers=("MDL-09", "AGG-6", "FN-1", "FN-6", "FN-19"), sql=f"""
WITH {GEO_SQL.strip()},
base AS (SELECT CASE r_name WHEN 'AFRICA' THEN 'Araba/Alava' WHEN 'AMERICA' THEN 'Bizkaia' WHEN 'ASIA' THEN 'Gipuzkoa'
                            ELSE r_name END AS province,
                CASE n_name WHEN 'NATION_0' THEN 'España' WHEN 'NATION_1' THEN 'Total' WHEN 'NATION_2' THEN NULL
                            ELSE n_name END AS nationality,
                CASE o_orderstatus WHEN 'F' THEN 'Total' WHEN 'O' THEN 'Employed population' ELSE 'Inactive population' END
                  AS relation_with_activity,
                CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Total' ELSE 'Hombres' END AS sex,
                yr AS year, CAST(COUNT(*) AS DOUBLE) AS population
         FROM geo GROUP BY 1, 2, 3, 4, 5)
SELECT province, CASE WHEN lower(province) LIKE 'araba%' THEN 'Araba' WHEN lower(province) LIKE 'bizkaia%' THEN 'Bizkaia'
                      WHEN lower(province) LIKE 'gipuzkoa%' THEN 'Gipuzkoa' END AS province_std, year,
       CAST(ROUND(CAST(COALESCE(SUM(CASE WHEN nationality NOT IN ('Total', 'España', 'Spanish nationality', 'Nacionalidad española')
                                         THEN population ELSE 0 END), 0) AS DECIMAL(38,10)), 0) AS BIGINT) AS foreign_population
FROM base WHERE relation_with_activity = 'Total' AND sex = 'Total' GROUP BY 1, 2, 3
""")
def mdl_foreign_population_province(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    nat = F.when(F.col("n_name") == "NATION_0", "España").when(F.col("n_name") == "NATION_1", "Total") \
        .when(F.col("n_name") == "NATION_2", F.lit(None)).otherwise(F.col("n_name"))
    rel = F.when(F.col("o_orderstatus") == "F", "Total").when(F.col("o_orderstatus") == "O", "Employed population") \
        .otherwise("Inactive population")
    sex = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Total").otherwise("Hombres")
    base = g.groupBy(F.lit("Euskadi").alias("ccaa"), _map("r_name", _PROV_EUSTAT, F.col("r_name")).alias("province"),
                     nat.alias("nationality"), rel.alias("relation_with_activity"), sex.alias("sex"),
                     F.col("yr").alias("year")).agg(F.count(F.lit(1)).cast("double").alias("population"))
    t = {"population_eustat_nationality": conform(base, SCHEMAS["population_eustat_nationality"])}
    return M.stg_eustat_foreign_population_province(t)


@query("mdl_migration", covers=("MDL-16", "AGG-4", "FLT-1", "FN-20"), sql=f"""
WITH {GEO_SQL.strip()},
base AS (SELECT CASE WHEN r_name = 'EUROPE' THEN 'País Vasco' ELSE r_name END AS region,
                CASE o_orderstatus WHEN 'F' THEN 'Ambas nacionalidades' WHEN 'O' THEN 'Española' ELSE 'Extranjera' END
                  AS nationality, yr AS year,
                CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) / 1000.0 AS value
         FROM geo GROUP BY 1, 2, 3)
SELECT CAST(year AS BIGINT) AS year,
       {sql_fixed("MAX(CASE WHEN nationality = 'Ambas nacionalidades' THEN value END)", 2)} AS in_migration_rate_total,
       {sql_fixed("MAX(CASE WHEN nationality = 'Española' THEN value END)", 2)} AS in_migration_rate_spanish,
       {sql_fixed("MAX(CASE WHEN nationality = 'Extranjera' THEN value END)", 2)} AS in_migration_rate_foreign
FROM base WHERE region = 'País Vasco' GROUP BY year
""")
def mdl_migration(spark, sf_dir):
    g = geo_orders(cat(spark, sf_dir))
    nat = F.when(F.col("o_orderstatus") == "F", "Ambas nacionalidades").when(F.col("o_orderstatus") == "O", "Española") \
        .otherwise("Extranjera")
    base = g.groupBy(F.when(F.col("r_name") == "EUROPE", "País Vasco").otherwise(F.col("r_name")).alias("region"),
                     nat.alias("nationality"), F.col("yr").alias("year")).agg(
        (N.exact_mean(F.sum(N.money("o_totalprice")), F.count(F.lit(1))) / 1000.0).alias("value"))
    base = base.select("*", F.lit(M.MIGRATION_INDICATOR).alias("indicator"), F.lit("Ambos sexos").alias("sex"),
                       F.lit("Total edades").alias("age_group"), F.lit("Anual").alias("periodicity"),
                       F.lit("Dato base").alias("data_type"), F.lit("tasa").alias("unit"))
    return M.stg_migration_basque_country({"migration_birth_country": conform(base, SCHEMAS["migration_birth_country"])})
