"""The declared column tests, the pre-load and post-load contracts and the mart smoke test, over the 14 base tables and the
26 views that Spark derives from the driver tables.

The oracle SQL states the base tables over the orders again, one aggregate each, takes a view from the SQL of its own query
where that one starts from the same base table, and counts the failing rows check by check."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from . import models as M
from . import q_models_real as R
from .common import GEO_SQL
from .q_models import _PROV, _crime_base
from .q_quality import contract_sql, union_checks
from .q_relational import _MONTH_NAMES
from .registry import ORACLE, query
from .schemas import SCHEMAS, contracts, post_load_contracts, view_contracts


def base_tables(spark, sf_dir):
    """All 14 base tables, from one pass over the orders star."""
    g = R._mart_star(spark, sf_dir)
    return {**R._rates_base(g), **R._earnings_table(g), **R._sector_table(g), **_crime_base(g, R._n()), **R._crime_total_table(g),
            **R._poverty_base(g), **R._migration_table(g), **R._elections_table(g), **R._housing_table(g), **R._origin_table(g),
            **R._fp_tables(g)}


def _of(column, labels, other=None):
    """The label of a column's value in a mapping; of a value outside of it, the value itself or ``other``."""
    return R._case_sql(column, labels, column if other is None else other)


_MEAN = R._MEAN_SQL
_MONTH_SQL = "[" + ", ".join(f"'{m}'" for m in _MONTH_NAMES) + "][mon]"

BASE_SQL = {
    "eustat_activity_nationality": f"""
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Activity rate' WHEN '2-HIGH' THEN 'Activity rate'
                                    WHEN '3-MEDIUM' THEN 'Employment rate' ELSE 'Unemployment rate' END AS rate_type,
               {_of('r_name', R._RATE_PROV, 'NULL')} AS province, {_of('o_orderstatus', R._RATE_NAT, 'NULL')} AS nationality,
               IF(mon <= 6, 'Annual average', 'Q3') AS quarter, yr AS year, {_MEAN} / 1000.0 AS value FROM geo GROUP BY 1, 2, 3, 4, 5""",
    "epa_contract_stats": f"""
        SELECT IF(o_orderstatus = 'F', 'Ambos sexos', 'Hombres') AS sex, 'Total' AS age_group, {_of('o_orderpriority', R._EARN_IND)} AS indicator,
               'Total' AS disability, yr AS year, {_MEAN} AS value FROM geo GROUP BY 1, 3, 5""",
    "ine_employment": f"""
        SELECT 'Ocupados' AS relation_activity, 'Total Nacional' AS territory, 'Ambos sexos' AS sex,
               {_of('o_orderpriority', R._SECTOR, 'NULL')} AS sector, {_of('n_name', R._EMP_NAT)} AS nationality, yr AS year,
               COUNT(*) / 10.0 AS value FROM geo GROUP BY 4, 5, 6""",
    "crime_detentions": f"""
        SELECT {_of('r_name', _PROV, 'NULL')} AS province, r_name AS region,
               {_of('n_name', {'NATION_0': 'España', 'NATION_5': 'Sin determinar', 'NATION_10': None})} AS nationality,
               {_of('o_orderstatus', {'F': 'Ambos sexos', 'O': 'Hombres'}, "'Mujeres'")} AS sex, yr AS year, COUNT(*) AS value
        FROM geo GROUP BY 1, 2, 3, 4, 5""",
    "crime_detentions_total": f"""
        SELECT {_of('r_name', {'EUROPE': 'PAÍS VASCO'})} AS territory,
               {_of('o_orderpriority', {'1-URGENT': 'TOTAL INFRACCIONES PENALES'})} AS crime_type, 'TOTAL edad' AS age_group,
               {_of('o_orderstatus', R._SEX_TOTAL, 'NULL')} AS sex, yr AS year, COUNT(*) AS value FROM geo GROUP BY 1, 2, 4, 5""",
    "ine_poverty_stats": f"""
        SELECT 'ccaa' AS level, {_of('r_name', R._POV_TERR)} AS territory, '{M.POVERTY_INDICATOR}' AS indicator, yr AS year,
               AVG(IF(o_orderstatus = 'F', 100.0, 0.0)) AS value FROM geo GROUP BY 2, 4""",
    "migration_birth_country": f"""
        SELECT {_of('r_name', {'EUROPE': 'País Vasco'})} AS region, '{M.MIGRATION_INDICATOR}' AS indicator, 'Ambos sexos' AS sex,
               'Total edades' AS age_group, {_of('o_orderstatus', R._MIG_NAT, 'NULL')} AS nationality, yr AS year, {_MEAN} / 1000.0 AS value
        FROM geo GROUP BY 1, 5, 6""",
    "elections_parlamento_vasco": f"""
        SELECT CAST(yr AS VARCHAR) AS year, {_MONTH_SQL} AS month,
               IF(o_orderstatus = 'O', lower(o_orderpriority) || ' ', o_orderpriority) AS party_name, COUNT(*) AS seats FROM geo GROUP BY 1, 2, 3""",
    "housing_prices_annual": f"""
        SELECT yr AS year, {_of('r_name', R._HOUSE_PROV, 'NULL')} AS province, 'Province' AS region_type, {_MEAN} AS price_per_m2,
               o_orderstatus AS source FROM geo GROUP BY 1, 2, 5""",
    "population_eustat_total": f"""
        SELECT {_of('r_name', R._ORIG_PROV)} AS province, {_of('n_name', R._ORIG_NAT)} AS nationality, yr AS year, COUNT(*) AS population
        FROM geo GROUP BY 1, 2, 3""",
    "population_eustat_nationality": f"""
        SELECT 'Euskadi' AS ccaa, {_of('r_name', R._EU_PROV)} AS province, {_of('n_name', R._EU_NAT)} AS nationality,
               'Total' AS relation_with_activity, 'Total' AS sex, yr AS year, COUNT(*) AS population
        FROM geo WHERE o_orderstatus = 'F' AND yr IN ({', '.join(map(str, R._EU_YEARS))}) GROUP BY 2, 3, 6""",
    "population_total": f"""
        SELECT 'province' AS level, {_of('r_name', R._POPT_TERR)} AS territory, yr AS year, COUNT(*) / 2.0 AS population, 'Ambos sexos' AS sex,
               'Todas las edades' AS age_group, '1 de julio de' AS periodo FROM geo GROUP BY 2, 3""",
    "ine_padron_foreign": f"""
        SELECT r_name AS province, {_of('r_name', R._STD)} AS province_std, yr AS year, COUNT(*) AS foreign_population
        FROM geo WHERE o_orderstatus = 'O' AND yr <= 1999 GROUP BY 1, 2, 3""",
    "ine_ecp_foreign": f"""
        SELECT {_of('r_name', R._STD)} AS province_std, yr AS year, COUNT(*) FILTER (o_orderstatus = 'P') AS foreign_population,
               COUNT(*) AS total_population, 100.0 * COUNT(*) FILTER (o_orderstatus = 'P') / COUNT(*) AS foreign_population_pct
        FROM geo WHERE yr >= 1998 GROUP BY 1, 2""",
}

_THREE = "('Araba', 'Bizkaia', 'Gipuzkoa')"

# Views over a base table that no other query starts from; the rest are taken from their own query's SQL.
_OWN_VIEWS = {
    "stg_ine_population_province": f"""SELECT territory AS province, {R._LADDER.format(c='territory')} AS province_std, year,
        ROUND(population) AS total_population FROM population_total WHERE {R._LADDER.format(c='territory')} IS NOT NULL""",
    "stg_eustat_foreign_population_province": f"""SELECT province, {R._LADDER.format(c='province')} AS province_std, year,
        COALESCE(SUM(population) FILTER (nationality NOT IN ({', '.join(f"'{x}'" for x in M.NOT_FOREIGN_POP)})), 0) AS foreign_population
        FROM population_eustat_nationality GROUP BY 1, 2, 3""",
    "stg_eustat_activity_by_nationality": f"""SELECT ccaa, {R._LADDER.format(c='province')} AS province_std, nationality, year,
        SUM(population) AS total_population FROM population_eustat_nationality WHERE {R._LADDER.format(c='province')} IS NOT NULL GROUP BY ALL""",
    "stg_ine_padron_foreign_province": f"SELECT * FROM ine_padron_foreign WHERE province_std IN {_THREE}",
    "stg_ine_ecp_foreign_province": f"SELECT * FROM ine_ecp_foreign WHERE province_std IN {_THREE}",
}
_VIEW_QUERY = {
    "stg_eustat_population_by_origin": "mdl_population_origin", "stg_migration_basque_country": "mdl_migration",
    "stg_crime_total_pais_vasco": "mdl_crime_total", "stg_crime_by_province_nationality_clean": "mdl_crime_clean",
    "stg_activity_rate_annual": "mdl_activity_rate", "stg_unemployment_rate_annual": "mdl_unemployment_rate",
    "stg_employment_rate_annual": "mdl_employment_rate", "stg_ine_employment_sector_national": "mdl_sector_national",
    "stg_epa_earnings_national": "mdl_earnings", "stg_housing_prices_province": "mdl_housing_prices",
    "stg_poverty_basque_country": "mdl_poverty_regional", "stg_poverty_national": "mdl_poverty_national",
    "stg_elections_results": "mdl_elections_results", "int_foreign_population_pct": "mdl_foreign_pct_real",
    "int_foreign_detentions_pv": "mdl_foreign_detentions", "int_population_pais_vasco_year": "mdl_population_year_real",
    "mart_immigration_crime_study_pv_rates": "mdl_crime_study_real", "mart_labour_market_nationality_pv": "mdl_labour_mart_real",
    "mart_housing_foreign_share": "mdl_housing_mart_real", "mart_immigration_poverty_pv": "mdl_poverty_mart_real",
    "mart_elections_vs_demographics_pv": "mdl_elections_mart_real",
}
VIEW_SQL = {**_OWN_VIEWS, **{view: ORACLE[name] for view, name in _VIEW_QUERY.items()}}


def _named(tables: dict[str, str]) -> str:
    return ",\n".join(f"{name} AS MATERIALIZED ({sql.strip()})" for name, sql in tables.items())


_BASE_WITH = f"WITH {GEO_SQL.strip()},\n{_named(BASE_SQL)}"
_MARTS = [v for v in M.MODELS if v.startswith("mart_")]


def _contracts_sql(of) -> str:
    return union_checks([s for c in of for s in contract_sql(c, table=c.dataset, columns=SCHEMAS[c.dataset].names)])


_TESTS = ("not_null", "unique", "accepted_values")
_TESTED = "\n".join([_BASE_WITH + ",", _named(VIEW_SQL), union_checks(
    [s for c in view_contracts() for s in contract_sql(c, set(_TESTS), table=c.dataset, columns=["*"])])])


@query("dq_view_tests", covers=("DQ-8", "DQ-9", "DQ-10"), sql=_TESTED)
def dq_view_tests(spark, sf_dir):
    """The 104 declared column tests on the 26 views."""
    return Q.check_many(M.build_all(base_tables(spark, sf_dir)), view_contracts(), spark, _TESTS)


@query("dq_base_contracts", covers=("DQ-12",), sql=f"""{_BASE_WITH}
SELECT *, 'pre-load' AS phase FROM ({_contracts_sql(contracts())})
UNION ALL SELECT *, 'post-load' FROM ({_contracts_sql(post_load_contracts())})
""")
def dq_base_contracts(spark, sf_dir):
    """The 14 pre-load and the 14 post-load contracts on the 14 base tables."""
    t = base_tables(spark, sf_dir)
    return (Q.check_many(t, contracts(), spark).withColumn("phase", F.lit("pre-load"))
            .unionByName(Q.check_many(t, post_load_contracts(), spark).withColumn("phase", F.lit("post-load"))))


@query("dq_mart_smoke", covers=("DQ-11",), sql=f"WITH {_named({v: VIEW_SQL[v] for v in _MARTS})}\n" + "\nUNION ALL ".join(
    f"SELECT '{v}' AS dataset, EXISTS (SELECT 1 FROM {v}) AS has_rows" for v in _MARTS))
def dq_mart_smoke(spark, sf_dir):
    """Every mart can be read and has rows."""
    views = M.build_all(base_tables(spark, sf_dir))
    return Q.smoke({v: views[v] for v in _MARTS})
