"""Domain models MDL-01..26: the staging, intermediate and mart views of the reference,
as functions of a dict ``table name -> DataFrame`` holding the 14 base tables
(:mod:`regiolake.plans.schemas`).

Each model is a plain DataFrame composition of the library operators; Catalyst
inlines the whole DAG (views are not materialised) and reuses the exchanges of
subplans that appear more than once, e.g. the population staging view used
four times by the foreign-share model.  ``build_all`` returns every model.

Label lists, category values and province names below are fixed values that
must equal the reference's for the models to give the same rows.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..operators import relational as R
from ..operators import series as S

Tables = Mapping[str, DataFrame]

# Province label ladders (prefix on the lower-cased label).
PROVINCE_PREFIX = [("prefix", "araba", "Araba"), ("prefix", "bizkaia", "Bizkaia"), ("prefix", "gipuzkoa", "Gipuzkoa")]
PROVINCE_PREFIX_PV = PROVINCE_PREFIX + [("contains", "euskadi", "País Vasco"), ("iregex", "pa[ií]s vasco", "País Vasco")]
PROVINCE_PREFIX_ALAVA = [("prefix", "araba", "Araba"), ("prefix", "álava", "Araba"), ("prefix", "alava", "Araba"),
                         ("prefix", "bizkaia", "Bizkaia"), ("prefix", "gipuzkoa", "Gipuzkoa")]
BASQUE = ["Araba", "Bizkaia", "Gipuzkoa"]
# Nationality labels that are not foreign.
NOT_FOREIGN_POP = ["Total", "España", "Spanish nationality", "Nacionalidad española"]
NOT_FOREIGN_CRIME = ["España", "Española", "Total", "Sin determinar"]
# Sector nationality buckets of the national employment table.
SPANISH_LEAVES = ["Española", "Doble nacionalidad"]
FOREIGN_LEAVES = ["Extranjera: Unión Europea", "Extranjera: América Latina", "Extranjera: Resto de Europa",
                  "Extranjera: Resto del mundo y apátrida"]
SECTORS = ["Agricultura", "Industria", "Construcción", "Servicios", "Total"]
# Headline slices.
EARNINGS_PER_WORKER = "Ganancia (bruta) por trabajador y año"
EARNINGS_PER_HOUR = "Ganancia (bruta) por hora y año"
POVERTY_INDICATOR = ("Todas las edades. Tasa de riesgo de pobreza (renta del año anterior a la entrevista). "
                     "Base 2013.")
MIGRATION_INDICATOR = "Tasa de Inmigración Interautonómica"


def _c(name):
    return F.col(name)


# --------------------------------------------------------------------------- staging

def stg_rate_annual(t: Tables, rate_type: str) -> DataFrame:
    """MDL-01..03: annual-average rate by province and nationality (one rate type)."""
    d = t["eustat_activity_nationality"].where((_c("quarter") == "Annual average") & (_c("rate_type") == rate_type))
    d = d.withColumn("province_std", L.standardise("province", PROVINCE_PREFIX_PV))
    nat = _c("nationality")
    return d.groupBy("year", "province_std").agg(
        N.fixed(F.avg(F.when(nat == "Spanish nationality", _c("value"))), 1).alias("spanish_nationality"),
        N.fixed(F.avg(F.when(nat == "Foreign nationality", _c("value"))), 1).alias("foreign_nationality"),
        N.fixed(F.avg(F.when(nat == "Total", _c("value"))), 1).alias("total"))


def stg_activity_rate_annual(t):
    return stg_rate_annual(t, "Activity rate")


def stg_employment_rate_annual(t):
    return stg_rate_annual(t, "Employment rate")


def stg_unemployment_rate_annual(t):
    return stg_rate_annual(t, "Unemployment rate")


def stg_crime_by_province_nationality_clean(t: Tables) -> DataFrame:
    """MDL-04."""
    d = t["crime_detentions"].where((_c("sex") == "Ambos sexos")
                                    & L.matches_any("province", [(k, p) for k, p, _ in PROVINCE_PREFIX]))
    d = d.withColumn("province_std", L.standardise("province", PROVINCE_PREFIX))
    return d.groupBy("province_std", "region", F.col("province").alias("province_original"), "year", "nationality") \
            .agg(F.sum("value").alias("total_detentions"))


def stg_crime_total_pais_vasco(t: Tables) -> DataFrame:
    """MDL-05: conditional sums by sex, 0 when a sex is missing (T14)."""
    d = t["crime_detentions_total"].where((_c("crime_type") == "TOTAL INFRACCIONES PENALES")
                                          & (_c("age_group") == "TOTAL edad") & (_c("territory") == "PAÍS VASCO"))
    p = R.conditional_pivot(d.withColumnRenamed("territory", "province"), ["province", "year"], "sex", "value",
                            {"ambos_sexos": "Ambos sexos", "hombres": "Masculino", "mujeres": "Femenino"},
                            agg="sum", else_value=0)
    return p


def stg_elections_results(t: Tables, default_month: int = 6) -> DataFrame:
    """MDL-06: keep, per year, the parties of the latest month only (AGG-7)."""
    d = t["elections_parlamento_vasco"].withColumn("month_num", L.month_number("month", default=default_month))
    snap = R.latest_snapshot(d, ["year"], "month_num")
    return snap.select("year", "party_name", F.col("seats").alias("total_seats"))


def stg_epa_earnings_national(t: Tables) -> DataFrame:
    """MDL-07: two indicators pivoted with MAX, NULL when absent (T14)."""
    d = t["epa_contract_stats"].where((_c("sex") == "Ambos sexos") & (_c("age_group") == "Total")
                                      & (_c("disability") == "Total"))
    p = R.conditional_pivot(d, ["year"], "indicator", "value",
                            {"gross_earnings_per_worker_eur": EARNINGS_PER_WORKER,
                             "gross_earnings_per_hour_eur": EARNINGS_PER_HOUR}, agg="max")
    return p.select(_c("year").cast("long").alias("year"),
                    *[N.fixed(c, 2).alias(c) for c in ["gross_earnings_per_worker_eur", "gross_earnings_per_hour_eur"]])


def stg_eustat_activity_by_nationality(t: Tables) -> DataFrame:
    """MDL-08."""
    d = t["population_eustat_nationality"].where(
        (_c("sex") == "Total") & _c("province").isin("Araba/Alava", "Bizkaia", "Gipuzkoa"))
    d = d.withColumn("province_std", L.standardise("province", PROVINCE_PREFIX))
    return R.conditional_pivot(d, ["ccaa", "province_std", "nationality", "year"], "relation_with_activity",
                               "population", {"employed_population": "Employed population",
                                              "unemployed_population": "Unemployed population",
                                              "inactive_population": "Inactive population",
                                              "total_population": "Total"}, agg="sum", else_value=0)


def stg_eustat_foreign_population_province(t: Tables) -> DataFrame:
    """MDL-09: NOT IN with a NULL nationality falls to ELSE 0 (T13)."""
    d = t["population_eustat_nationality"].where((_c("relation_with_activity") == "Total") & (_c("sex") == "Total"))
    d = d.withColumn("province_std", L.standardise("province", PROVINCE_PREFIX))
    foreign = F.when(~_c("nationality").isin(NOT_FOREIGN_POP), _c("population")).otherwise(F.lit(0))
    return d.groupBy("province", "province_std", "year").agg(
        N.round_to_long(F.coalesce(F.sum(foreign), F.lit(0))).alias("foreign_population"))


def stg_eustat_population_by_origin(t: Tables) -> DataFrame:
    """MDL-10."""
    d = t["population_eustat_total"]
    rules = PROVINCE_PREFIX + [("eq", "Total", "País Vasco")]
    return d.select(F.col("province").alias("province_raw"), L.standardise("province", rules).alias("province_std"),
                    F.col("nationality").alias("origin"),
                    L.bucket("nationality", [("España", ["España"]), ("Total", ["Total"])], "Foreign").alias("origin_bucket"),
                    _c("year").cast("long").alias("year"), N.round_to_long("population").alias("population"))


def stg_housing_prices_province(t: Tables) -> DataFrame:
    """MDL-11: grain is (province_raw, province_std, year) (N2 reproduced)."""
    d = t["housing_prices_annual"].where(L.matches_any("province", [(k, p) for k, p, _ in PROVINCE_PREFIX_ALAVA]))
    d = d.withColumn("province_std", L.standardise("province", PROVINCE_PREFIX_ALAVA))
    return d.groupBy(F.col("province").alias("province_raw"), "province_std", _c("year").cast("long").alias("year")) \
            .agg(N.fixed(F.avg("price_per_m2"), 2).alias("avg_price_per_m2"))


def stg_ine_ecp_foreign_province(t: Tables) -> DataFrame:
    """MDL-12."""
    return t["ine_ecp_foreign"].where(_c("province_std").isin(BASQUE)).select(
        "province_std", "year", "foreign_population", "total_population", "foreign_population_pct")


def stg_ine_employment_sector_national(t: Tables) -> DataFrame:
    """MDL-13: nationality buckets; 'Other' is the catch-all (N15); the aggregate
    'Extranjera: Total' row is excluded to avoid double counting."""
    d = t["ine_employment"].where((_c("relation_activity") == "Ocupados") & (_c("territory") == "Total Nacional")
                                  & (_c("sex") == "Ambos sexos") & _c("sector").isin(SECTORS)
                                  & (_c("nationality") != "Extranjera: Total"))
    b = L.bucket("nationality", [("Total", ["Total"]), ("Spanish", SPANISH_LEAVES), ("Foreign", FOREIGN_LEAVES)], "Other")
    return d.groupBy(_c("year").cast("long").alias("year"), "sector", b.alias("nationality_bucket")).agg(
        N.fixed(F.sum("value"), 1).alias("employed_thousands"))


def stg_ine_padron_foreign_province(t: Tables) -> DataFrame:
    """MDL-14."""
    return t["ine_padron_foreign"].where(_c("province_std").isin(BASQUE)).select(
        "province", "province_std", "year", "foreign_population")


def stg_ine_population_province(t: Tables) -> DataFrame:
    """MDL-15."""
    d = t["population_total"].where((_c("level") == "province")
                                    & _c("territory").isin("Araba/Álava", "Bizkaia", "Gipuzkoa")
                                    & (_c("sex") == "Ambos sexos") & (_c("age_group") == "Todas las edades")
                                    & (_c("periodo") == "1 de julio de"))
    return d.select(F.col("territory").alias("province"), L.standardise("territory", PROVINCE_PREFIX).alias("province_std"),
                    "year", N.round_to_long("population").alias("total_population"))


def stg_migration_basque_country(t: Tables) -> DataFrame:
    """MDL-16."""
    d = t["migration_birth_country"].where(
        (_c("region") == "País Vasco") & (_c("indicator") == MIGRATION_INDICATOR) & (_c("sex") == "Ambos sexos")
        & (_c("age_group") == "Total edades") & (_c("periodicity") == "Anual") & (_c("data_type") == "Dato base"))
    p = R.conditional_pivot(d, ["year"], "nationality", "value",
                            {"in_migration_rate_total": "Ambas nacionalidades", "in_migration_rate_spanish": "Española",
                             "in_migration_rate_foreign": "Extranjera"}, agg="max")
    return p.select(_c("year").cast("long").alias("year"),
                    *[N.fixed(c, 2).alias(c) for c in ["in_migration_rate_total", "in_migration_rate_spanish",
                                                       "in_migration_rate_foreign"]])


def _poverty(t, territory):
    d = t["ine_poverty_stats"].where((_c("level") == "ccaa") & (_c("territory") == territory)
                                     & (_c("indicator") == POVERTY_INDICATOR))
    return d.select("territory", "year", F.col("value").alias("poverty_rate"))


def stg_poverty_basque_country(t):
    """MDL-17."""
    return _poverty(t, "País Vasco")


def stg_poverty_national(t):
    """MDL-18."""
    return _poverty(t, "Total Nacional")


# --------------------------------------------------------------------------- intermediate

def int_foreign_detentions_pv(t: Tables) -> DataFrame:
    """MDL-19: WHERE NOT IN drops NULL nationalities (T13)."""
    d = stg_crime_by_province_nationality_clean(t).where(~_c("nationality").isin(NOT_FOREIGN_CRIME))
    return d.groupBy("year").agg(F.sum("total_detentions").alias("total_foreign_detentions"))


def int_foreign_population_pct(t: Tables) -> DataFrame:
    """MDL-20: EUSTAT > Padrón > ECP priority chain with chain-linked ECP (N4 kept:
    Padrón is hidden by any EUSTAT key, ECP only by EUSTAT keys that met a population)."""
    keys = ["province_std", "year"]
    eu = stg_eustat_foreign_population_province(t)
    pop = stg_ine_population_province(t).select(*keys, "total_population")
    pa = stg_ine_padron_foreign_province(t)
    ecp_raw = stg_ine_ecp_foreign_province(t).where(_c("province_std").isin(BASQUE))

    def shares(df):
        return df.select(*keys, "foreign_population", "total_population",
                         N.pct("foreign_population", "total_population").alias("foreign_population_pct"))
    eu_full = eu.select(*keys, "foreign_population").join(pop, on=keys)
    eustat = shares(eu_full)
    padron_raw = pa.select(*keys, "foreign_population").join(pop, on=keys)
    padron = shares(R.not_covered(padron_raw, eu, keys))
    ratio = S.chain_ratio(padron_raw, ecp_raw, keys, ["province_std"], "foreign_population", "foreign_population",
                          name="pop_ratio")
    e = R.left_default(ecp_raw.select(*keys, "foreign_population", "total_population"), ratio, ["province_std"],
                       "pop_ratio", 1.0)
    e = R.not_covered(R.not_covered(e, eu_full, keys), pa, keys)
    adj = _c("foreign_population") * _c("pop_ratio")
    ecp = e.select(*keys, N.round_to_long(adj).alias("foreign_population"), "total_population",
                   N.pct(adj, "total_population").alias("foreign_population_pct"))
    return R.union_all([eustat, padron, ecp])


def int_population_pais_vasco_year(t: Tables, fp: DataFrame | None = None) -> DataFrame:
    """MDL-21: ratio of sums over the three provinces."""
    fp = fp if fp is not None else int_foreign_population_pct(t)
    a = fp.where(_c("province_std").isin(BASQUE)).groupBy("year").agg(
        N.round_to_long(F.sum("total_population")).alias("total_population"),
        N.round_to_long(F.sum("foreign_population")).alias("foreign_population"))
    return a.withColumn("foreign_population_pct", N.pct("foreign_population", "total_population"))


# --------------------------------------------------------------------------- marts

def mart_immigration_crime_study_pv_rates(t: Tables) -> DataFrame:
    """MDL-22."""
    tt = stg_crime_total_pais_vasco(t)
    f = int_foreign_detentions_pv(t)
    p = int_population_pais_vasco_year(t)
    j = tt.join(f, on="year").join(p, on="year", how="left")
    return j.select(
        "year", "total_population", "foreign_population",
        N.complement("total_population", "foreign_population").alias("spanish_population"),
        F.col("ambos_sexos").alias("total_detention_events"),
        F.col("total_foreign_detentions").alias("foreign_detention_events"),
        N.complement("ambos_sexos", "total_foreign_detentions").alias("spanish_detention_events"),
        "foreign_population_pct",
        N.pct("total_foreign_detentions", "ambos_sexos").alias("foreign_detention_pct"),
        N.over_representation("total_foreign_detentions", "ambos_sexos", "foreign_population", "total_population")
        .alias("over_representation_ratio"),
        N.rate_per("ambos_sexos", "total_population").alias("total_event_rate_per_100k"),
        N.rate_per("total_foreign_detentions", "foreign_population").alias("foreign_event_rate_per_100k"),
        N.rate_per(N.complement("ambos_sexos", "total_foreign_detentions"),
                   N.complement("total_population", "foreign_population")).alias("spanish_event_rate_per_100k"))


def mart_labour_market_nationality_pv(t: Tables) -> DataFrame:
    """MDL-23: rates (three-way USING join), volumes with the Spanish residual (TS-4),
    national sector mix (AGG-9) and earnings, all left-joined on (year, nationality)."""
    keys = ["year", "province_std"]
    a, u, e = stg_activity_rate_annual(t), stg_unemployment_rate_annual(t), stg_employment_rate_annual(t)
    j = (a.select(*keys, F.col("spanish_nationality").alias("a_s"), F.col("foreign_nationality").alias("a_f"))
          .join(u.select(*keys, F.col("spanish_nationality").alias("u_s"), F.col("foreign_nationality").alias("u_f")), on=keys)
          .join(e.select(*keys, F.col("spanish_nationality").alias("e_s"), F.col("foreign_nationality").alias("e_f")), on=keys)
          .where(_c("province_std") == "País Vasco"))
    rates = R.union_all([
        j.select("year", F.lit("Spanish").alias("nationality"), F.col("a_s").alias("activity_rate"),
                 F.col("u_s").alias("unemployment_rate"), F.col("e_s").alias("employment_rate")),
        j.select("year", F.lit("Foreign").alias("nationality"), F.col("a_f").alias("activity_rate"),
                 F.col("u_f").alias("unemployment_rate"), F.col("e_f").alias("employment_rate"))])
    measures = ["employed_population", "unemployed_population", "inactive_population", "total_population"]
    v = stg_eustat_activity_by_nationality(t).where(_c("province_std").isin(BASQUE))
    v = v.withColumn("cat", F.when(_c("nationality") == "Total", "Total").otherwise("Foreign"))
    vraw = v.groupBy("year", "cat").agg(*[F.sum(m).alias(m) for m in measures])
    volumes = S.residual(vraw, ["year"], "cat", measures, "Total", ["Foreign"], "Foreign", "Spanish") \
        .withColumnRenamed("cat", "nationality")
    sec = stg_ine_employment_sector_national(t).where(_c("nationality_bucket").isin("Spanish", "Foreign"))
    mix = R.conditional_pivot(sec, ["year", "nationality_bucket"], "sector", "employed_thousands",
                              {s: s for s in SECTORS}, agg="max")
    mix = mix.select("year", F.col("nationality_bucket").alias("nationality"),
                     N.pct("Agricultura", "Total").alias("national_pct_agriculture"),
                     N.pct("Industria", "Total").alias("national_pct_industry"),
                     N.pct("Construcción", "Total").alias("national_pct_construction"),
                     N.pct("Servicios", "Total").alias("national_pct_services"))
    w = stg_epa_earnings_national(t).select(
        "year", F.col("gross_earnings_per_worker_eur").alias("national_gross_earnings_per_worker_eur"),
        F.col("gross_earnings_per_hour_eur").alias("national_gross_earnings_per_hour_eur"))
    out = R.left_enrich(rates, (volumes, ["year", "nationality"]), (mix, ["year", "nationality"]), (w, ["year"]))
    return out.select("year", "nationality", "activity_rate", "employment_rate", "unemployment_rate", *measures,
                      N.pct("inactive_population", "total_population").alias("inactive_share_pct"),
                      N.pct("unemployed_population", "total_population").alias("unemployed_share_pct"),
                      "national_pct_agriculture", "national_pct_industry", "national_pct_construction",
                      "national_pct_services", "national_gross_earnings_per_worker_eur",
                      "national_gross_earnings_per_hour_eur")


def mart_housing_foreign_share(t: Tables) -> DataFrame:
    """MDL-24: dominant foreign origin per (province, year) with an origin tie-break (N3)."""
    keys = ["province_std", "year"]
    o = stg_eustat_population_by_origin(t).where(_c("province_std").isin(BASQUE) & (_c("origin_bucket") == "Foreign"))
    o = R.group_total(o, keys, "population", "foreign_total_pop")
    top = R.top1_per_group(o, keys, "population", ["origin", "population", "foreign_total_pop"], tie_break=["origin"])
    top = top.select(*keys, F.col("origin").alias("top_foreign_origin"),
                     N.pct("population", "foreign_total_pop").alias("top_foreign_origin_pct"))
    h = stg_housing_prices_province(t).select("year", "province_std", "avg_price_per_m2")
    fp = int_foreign_population_pct(t)
    out = R.left_enrich(h, (fp, keys), (top, keys))
    return out.select("year", "province_std", "avg_price_per_m2", "foreign_population", "total_population",
                      "foreign_population_pct", "top_foreign_origin", "top_foreign_origin_pct")


def mart_immigration_poverty_pv(t: Tables) -> DataFrame:
    """MDL-25."""
    p = stg_poverty_basque_country(t).select("year", "poverty_rate")
    n = stg_poverty_national(t).select("year", F.col("poverty_rate").alias("national_poverty_rate"))
    out = R.left_enrich(p, (n, ["year"]), (int_population_pais_vasco_year(t), ["year"]))
    return out.select("year", "poverty_rate", "national_poverty_rate",
                      N.gap("national_poverty_rate", "poverty_rate", 1).alias("poverty_gap_pp"),
                      "total_population", "foreign_population", "foreign_population_pct")


def mart_elections_vs_demographics_pv(t: Tables) -> DataFrame:
    """MDL-26: party names normalised as an expression before grouping (T6), so typographic
    variants collapse; year text cast safely (rows with an unparsable year are dropped, N13)."""
    st = stg_elections_results(t)
    el = (st.withColumn("year", _c("year").try_cast("long")).where(_c("year").isNotNull())
            .groupBy("year", F.upper(F.trim("party_name")).alias("party_name"))
            .agg(F.sum("total_seats").alias("seats")))
    tot = el.groupBy("year").agg(F.sum("seats").alias("total_seats_year"))
    out = R.left_enrich(el.join(tot, on="year"), (int_population_pais_vasco_year(t), ["year"]),
                        (stg_migration_basque_country(t), ["year"]))
    return out.select("year", "party_name", "seats", "total_seats_year",
                      N.pct("seats", "total_seats_year").alias("seats_share_pct"), "total_population",
                      "foreign_population", "foreign_population_pct", "in_migration_rate_total",
                      "in_migration_rate_spanish", "in_migration_rate_foreign")


MODELS = {
    "stg_activity_rate_annual": stg_activity_rate_annual,
    "stg_employment_rate_annual": stg_employment_rate_annual,
    "stg_unemployment_rate_annual": stg_unemployment_rate_annual,
    "stg_crime_by_province_nationality_clean": stg_crime_by_province_nationality_clean,
    "stg_crime_total_pais_vasco": stg_crime_total_pais_vasco,
    "stg_elections_results": stg_elections_results,
    "stg_epa_earnings_national": stg_epa_earnings_national,
    "stg_eustat_activity_by_nationality": stg_eustat_activity_by_nationality,
    "stg_eustat_foreign_population_province": stg_eustat_foreign_population_province,
    "stg_eustat_population_by_origin": stg_eustat_population_by_origin,
    "stg_housing_prices_province": stg_housing_prices_province,
    "stg_ine_ecp_foreign_province": stg_ine_ecp_foreign_province,
    "stg_ine_employment_sector_national": stg_ine_employment_sector_national,
    "stg_ine_padron_foreign_province": stg_ine_padron_foreign_province,
    "stg_ine_population_province": stg_ine_population_province,
    "stg_migration_basque_country": stg_migration_basque_country,
    "stg_poverty_basque_country": stg_poverty_basque_country,
    "stg_poverty_national": stg_poverty_national,
    "int_foreign_detentions_pv": int_foreign_detentions_pv,
    "int_foreign_population_pct": int_foreign_population_pct,
    "int_population_pais_vasco_year": int_population_pais_vasco_year,
    "mart_immigration_crime_study_pv_rates": mart_immigration_crime_study_pv_rates,
    "mart_labour_market_nationality_pv": mart_labour_market_nationality_pv,
    "mart_housing_foreign_share": mart_housing_foreign_share,
    "mart_immigration_poverty_pv": mart_immigration_poverty_pv,
    "mart_elections_vs_demographics_pv": mart_elections_vs_demographics_pv,
}


def build_all(t: Tables) -> dict[str, DataFrame]:
    """Every model as a lazy DataFrame (nothing runs until an action)."""
    return {name: fn(t) for name, fn in MODELS.items()}
