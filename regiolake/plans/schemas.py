"""The 14 base tables: explicit schemas (warehouse types) and pre-load quality contracts.

Fixed values: table names, column names and types, logical keys and the
non-negative columns must equal the reference's so that clean files written
elsewhere bind to them (binding is positional, in the order given here).
"""
from __future__ import annotations

from pyspark.sql import types as T

from ..operators.quality import Contract

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _st(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "population_total": _st(("level", S), ("territory", S), ("year", I), ("population", D), ("sex", S),
                            ("age_group", S), ("nationality", S), ("concept", S), ("data_type", S), ("unit", S),
                            ("tipo_dato", S), ("periodo", S)),
    "population_eustat_total": _st(("province", S), ("nationality", S), ("year", I), ("population", L)),
    "population_eustat_nationality": _st(("ccaa", S), ("province", S), ("nationality", S),
                                         ("relation_with_activity", S), ("sex", S), ("year", I), ("population", D)),
    "epa_contract_stats": _st(("sex", S), ("age_group", S), ("indicator", S), ("disability", S), ("year", I),
                              ("value", D)),
    "migration_birth_country": _st(("region", S), ("indicator", S), ("sex", S), ("age_group", S),
                                   ("nationality", S), ("periodicity", S), ("data_type", S), ("year", I),
                                   ("value", D), ("unit", S)),
    "crime_detentions": _st(("province", S), ("region", S), ("nationality", S), ("sex", S), ("year", I), ("value", L)),
    "crime_detentions_total": _st(("territory", S), ("crime_type", S), ("age_group", S), ("sex", S), ("year", I),
                                  ("value", L)),
    "ine_employment": _st(("relation_activity", S), ("territory", S), ("sex", S), ("sector", S), ("nationality", S),
                          ("year", I), ("value", D)),
    "eustat_activity_nationality": _st(("rate_type", S), ("province", S), ("nationality", S), ("quarter", S),
                                       ("year", I), ("value", D)),
    "elections_parlamento_vasco": _st(("year", S), ("month", S), ("party_name", S), ("seats", L)),
    "housing_prices_annual": _st(("year", I), ("province", S), ("region_type", S), ("price_per_m2", D),
                                 ("source", S)),
    "ine_poverty_stats": _st(("level", S), ("territory", S), ("indicator", S), ("year", I), ("value", D)),
    "ine_padron_foreign": _st(("province", S), ("province_std", S), ("year", I), ("foreign_population", L)),
    "ine_ecp_foreign": _st(("province_std", S), ("year", I), ("foreign_population", L), ("total_population", L),
                           ("foreign_population_pct", D)),
}

# Pre-load contracts (DQ-12): dataset, required columns, logical key, non-negative columns, year check.
_CONTRACT_ROWS = [
    ("population_total", ["level", "territory", "year", "population", "sex", "age_group", "nationality", "periodo"],
     ["level", "territory", "year", "sex", "age_group", "periodo"], ["population"], False),
    ("migration_birth_country", ["region", "indicator", "sex", "age_group", "nationality", "year", "value"],
     ["region", "indicator", "sex", "age_group", "nationality", "year"], ["value"], True),
    ("population_eustat_total", ["province", "nationality", "year", "population"],
     ["province", "nationality", "year"], ["population"], True),
    ("population_eustat_nationality", ["ccaa", "province", "nationality", "relation_with_activity", "sex", "year",
                                       "population"],
     ["province", "nationality", "relation_with_activity", "sex", "year"], ["population"], True),
    ("epa_contract_stats", ["sex", "age_group", "indicator", "disability", "year", "value"],
     ["sex", "age_group", "indicator", "disability", "year"], [], True),
    ("ine_employment", ["relation_activity", "territory", "sex", "sector", "nationality", "year", "value"],
     ["relation_activity", "territory", "sex", "sector", "nationality", "year"], [], True),
    ("eustat_activity_nationality", ["rate_type", "province", "nationality", "quarter", "year", "value"],
     ["rate_type", "province", "nationality", "quarter", "year"], [], True),
    ("crime_detentions", ["province", "region", "nationality", "sex", "year", "value"],
     ["province", "region", "nationality", "sex", "year"], ["value"], True),
    ("crime_detentions_total", ["territory", "crime_type", "age_group", "sex", "year", "value"],
     ["territory", "crime_type", "age_group", "sex", "year"], ["value"], True),
    ("housing_prices_annual", ["year", "province", "region_type", "source", "price_per_m2"],
     ["year", "province", "source"], ["price_per_m2"], True),
    ("ine_poverty_stats", ["level", "territory", "year", "indicator", "value"],
     ["territory", "indicator", "year"], ["value"], True),
    ("ine_padron_foreign", ["province", "province_std", "year", "foreign_population"],
     ["province_std", "year"], ["foreign_population"], True),
    ("ine_ecp_foreign", ["province_std", "year", "foreign_population", "total_population", "foreign_population_pct"],
     ["province_std", "year"], ["foreign_population", "total_population"], True),
    ("elections_parlamento_vasco", ["party_name", "year", "month", "seats"],
     ["year", "month", "party_name"], ["seats"], False),
]


def contracts(reference_year: int | None = None, year_min: int = 1990) -> list[Contract]:
    """The 14 pre-load contracts; the year window is [year_min, reference_year + 1]."""
    return [Contract(name, required_columns=req, pk=pk, non_negative=nonneg, year_col="year",
                     check_year_range=yr, year_min=year_min, reference_year=reference_year)
            for name, req, pk, nonneg, yr in _CONTRACT_ROWS]


# Post-load contracts: logical key, non-negative columns, year column (fixed values; the keys differ from the
# pre-load ones where the loaded table keeps other columns).
_POST_LOAD_ROWS = [
    ("population_total", ["level", "territory", "year"], ["population"], "year"),
    ("population_eustat_total", ["province", "year", "nationality"], ["population"], "year"),
    ("population_eustat_nationality", ["province", "nationality", "relation_with_activity", "sex", "year"], ["population"], "year"),
    ("epa_contract_stats", ["sex", "age_group", "indicator", "disability", "year"], [], "year"),
    ("migration_birth_country", ["region", "indicator", "sex", "age_group", "nationality", "year"], ["value"], "year"),
    ("crime_detentions", ["province", "region", "nationality", "sex", "year"], ["value"], "year"),
    ("crime_detentions_total", ["territory", "crime_type", "age_group", "sex", "year"], ["value"], "year"),
    ("ine_employment", ["relation_activity", "territory", "sex", "sector", "nationality", "year"], [], "year"),
    ("eustat_activity_nationality", ["rate_type", "province", "nationality", "quarter", "year"], [], "year"),
    ("housing_prices_annual", ["year", "province", "source"], ["price_per_m2"], "year"),
    ("ine_poverty_stats", ["territory", "indicator", "year"], ["value"], "year"),
    ("elections_parlamento_vasco", ["year", "month", "party_name"], ["seats"], None),
    ("ine_padron_foreign", ["province_std", "year"], ["foreign_population"], "year"),
    ("ine_ecp_foreign", ["province_std", "year"], ["foreign_population", "total_population"], "year"),
]

# Declared column tests of the views (fixed values): columns that are never NULL, columns without repeats, and
# the accepted values of a column.
_THREE = ["Araba", "Bizkaia", "Gipuzkoa"]
_VIEW_TESTS = [
    ("stg_ine_population_province", ["province_std", "year", "total_population"], [], {"province_std": _THREE}),
    ("stg_eustat_foreign_population_province", ["province_std", "year", "foreign_population"], [], {"province_std": _THREE}),
    ("stg_eustat_population_by_origin", ["province_std", "origin", "year", "population"], [],
     {"origin_bucket": ["España", "Foreign", "Total"]}),
    ("stg_migration_basque_country", ["year"], ["year"], {}),
    ("stg_crime_total_pais_vasco", ["year", "ambos_sexos"], [], {}),
    ("stg_crime_by_province_nationality_clean", ["province_std", "year", "total_detentions"], [], {"province_std": _THREE}),
    ("stg_activity_rate_annual", ["year", "province_std"], [], {}),
    ("stg_unemployment_rate_annual", ["year", "province_std"], [], {}),
    ("stg_employment_rate_annual", ["year", "province_std"], [], {}),
    ("stg_eustat_activity_by_nationality", ["province_std", "year"], [], {"province_std": _THREE}),
    ("stg_ine_employment_sector_national", ["year", "sector", "nationality_bucket", "employed_thousands"], [],
     {"sector": ["Agricultura", "Industria", "Construcción", "Servicios", "Total"],
      "nationality_bucket": ["Spanish", "Foreign", "Total", "Other"]}),
    ("stg_epa_earnings_national", ["year"], ["year"], {}),
    ("stg_housing_prices_province", ["province_std", "year", "avg_price_per_m2"], [], {"province_std": _THREE}),
    ("stg_poverty_basque_country", ["year", "poverty_rate"], [], {}),
    ("stg_poverty_national", ["year", "poverty_rate"], [], {}),
    ("stg_ine_padron_foreign_province", ["province_std", "year", "foreign_population"], [], {"province_std": _THREE}),
    ("stg_ine_ecp_foreign_province", ["province_std", "year", "foreign_population", "total_population", "foreign_population_pct"],
     [], {"province_std": _THREE}),
    ("stg_elections_results", ["year", "party_name", "total_seats"], [], {}),
    ("int_foreign_population_pct", ["province_std", "year", "foreign_population", "total_population", "foreign_population_pct"],
     [], {"province_std": _THREE}),
    ("int_foreign_detentions_pv", ["year", "total_foreign_detentions"], [], {}),
    ("int_population_pais_vasco_year", ["year", "total_population", "foreign_population", "foreign_population_pct"], ["year"], {}),
    ("mart_immigration_crime_study_pv_rates", ["year", "total_population", "foreign_population", "total_detention_events",
                                               "foreign_detention_events", "foreign_population_pct", "foreign_detention_pct",
                                               "over_representation_ratio"], ["year"], {}),
    ("mart_labour_market_nationality_pv", ["year", "nationality"], [], {"nationality": ["Spanish", "Foreign"]}),
    ("mart_housing_foreign_share", ["year", "province_std", "avg_price_per_m2", "foreign_population", "total_population",
                                    "foreign_population_pct"], [], {"province_std": _THREE}),
    ("mart_immigration_poverty_pv", ["year", "poverty_rate", "national_poverty_rate", "poverty_gap_pp", "total_population",
                                     "foreign_population", "foreign_population_pct"], ["year"], {}),
    ("mart_elections_vs_demographics_pv", ["year", "party_name", "seats", "total_seats_year", "seats_share_pct"], [], {}),
]


def post_load_contracts(reference_year: int | None = None, year_min: int = 1990) -> list[Contract]:
    """The 14 contracts of the loaded tables."""
    return [Contract(name, pk=pk, non_negative=nonneg, year_col=y, check_year_range=y is not None, year_min=year_min,
                     reference_year=reference_year) for name, pk, nonneg, y in _POST_LOAD_ROWS]


def view_contracts() -> list[Contract]:
    """The 104 declared column tests of the 26 views, as contracts."""
    return [Contract(name, year_col=None, check_year_range=False, not_null=nn, unique=u, accepted_values=av)
            for name, nn, u, av in _VIEW_TESTS]
