"""Domain models (MDL-*) on invented base tables; expected values computed by hand."""
import pytest

from regiolake.plans import models as M

from base_fixtures import base_tables
from conftest import rows


@pytest.fixture(scope="module")
def t(spark):
    return base_tables(spark)


def test_rate_annual_labels_and_rounding(t):
    got = rows(M.stg_activity_rate_annual(t), "year", "province_std", "spanish_nationality", "foreign_nationality", "total")
    # 'PAÍS VASCO' matches the case-insensitive accented pattern (T7); 'Nowhere' gets a NULL label
    assert got == [(2020, "Araba", 55.0, None, None), (2020, "País Vasco", 56.5, 70.0, None), (2020, None, None, None, 10.0)]


def test_crime_models(t):
    assert rows(M.int_foreign_detentions_pv(t)) == [(2020, 40)]       # NULL nationality dropped by NOT IN (T13)
    assert rows(M.stg_crime_total_pais_vasco(t), "province", "year", "ambos_sexos", "hombres", "mujeres") == \
        [("PAÍS VASCO", 2020, 200, 150, 0)]                              # missing sex -> 0 (T14)
    m = M.mart_immigration_crime_study_pv_rates(t).collect()[0]
    assert (m.spanish_population, m.spanish_detention_events, m.foreign_detention_pct) == (311000, 160, 20.0)
    assert (m.over_representation_ratio, m.total_event_rate_per_100k, m.foreign_event_rate_per_100k,
            m.spanish_event_rate_per_100k) == (3.31, 60.42, 200.0, 51.45)


def test_elections_latest_month_and_party_collapse(t):
    stg = rows(M.stg_elections_results(t), "year", "party_name", "total_seats")
    assert stg == [("", "X", 3), ("1990", "EA", 9), ("1990", "PNV", 1), ("1990", "Pnv ", 22), ("1994", "PNV", 29)]
    mart = rows(M.mart_elections_vs_demographics_pv(t), "year", "party_name", "seats", "total_seats_year", "seats_share_pct")
    assert mart == [(1990, "EA", 9, 32, 28.13), (1990, "PNV", 23, 32, 71.88), (1994, "PNV", 29, 29, 100.0)]


def test_earnings_pivot_null_when_absent(t):
    assert rows(M.stg_epa_earnings_national(t)) == [(2020, 25000.46, None), (2021, None, 16.13)]


def test_foreign_population_province_not_in_else_zero(t):
    assert rows(M.stg_eustat_foreign_population_province(t), "province_std", "year", "foreign_population") == \
        [("Araba", 2020, 20000)]


def test_population_rounding_half_up(t):
    got = rows(M.stg_ine_population_province(t), "province_std", "year", "total_population")
    assert got == [("Araba", 2019, 330001), ("Araba", 2020, 331000), ("Araba", 2021, 333000), ("Bizkaia", 2019, 1150000)]


def test_foreign_population_pct_priority_chain(t):
    got = rows(M.int_foreign_population_pct(t))
    assert got == [
        ("Araba", 2019, 21000, 330001, 6.36),      # padron
        ("Araba", 2020, 20000, 331000, 6.04),      # eustat wins over padron
        ("Araba", 2021, 23000, 333000, 6.91),      # padron wins over ecp
        ("Araba", 2023, 24840, 335000, 7.41),      # ecp x chain ratio 23000/25000
        ("Bizkaia", 2019, 60000, 1150000, 5.22),
        ("Bizkaia", 2023, 70000, 1150000, 6.09),   # no overlap: ratio defaults to 1
    ]
    keys = [(r[0], r[1]) for r in got]
    assert len(keys) == len(set(keys))


def test_population_year_ratio_of_sums(t):
    assert rows(M.int_population_pais_vasco_year(t)) == [
        (2019, 1480001, 81000, 5.47), (2020, 331000, 20000, 6.04), (2021, 333000, 23000, 6.91),
        (2023, 1485000, 94840, 6.39)]


def test_housing_grain_and_top_origin_tie(t):
    h = rows(M.stg_housing_prices_province(t), "province_raw", "province_std", "year", "avg_price_per_m2")
    assert h == [("Araba/Álava", "Araba", 2020, 2100.0), ("Bizkaia", "Bizkaia", 2020, 3000.5),
                 ("Gipuzkoa", "Gipuzkoa", 2019, 3500.0), ("Álava", "Araba", 2020, 2000.0)]
    m = rows(M.mart_housing_foreign_share(t), "year", "province_std", "avg_price_per_m2", "foreign_population_pct",
             "top_foreign_origin", "top_foreign_origin_pct")
    assert m == [(2019, "Gipuzkoa", 3500.0, None, None, None),
                 (2020, "Araba", 2000.0, 6.04, "América del Sur", 45.0),
                 (2020, "Araba", 2100.0, 6.04, "América del Sur", 45.0),   # two Araba rows: N2 reproduced
                 (2020, "Bizkaia", 3000.5, None, None, None)]


def test_sector_buckets(t):
    got = rows(M.stg_ine_employment_sector_national(t), "year", "sector", "nationality_bucket", "employed_thousands")
    assert got == [(2020, "Construcción", "Foreign", 300.0), (2020, "Servicios", "Spanish", 12000.0),
                   (2020, "Total", "Foreign", 1000.0), (2020, "Total", "Other", 3.0),
                   (2020, "Total", "Spanish", 16500.0), (2020, "Total", "Total", 19000.0)]


def test_labour_mart(t):
    got = {r.nationality: r for r in M.mart_labour_market_nationality_pv(t).collect()}
    sp, fo = got["Spanish"], got["Foreign"]
    assert (sp.activity_rate, sp.unemployment_rate, sp.employment_rate) == (56.5, 8.0, 50.0)
    assert (fo.activity_rate, fo.unemployment_rate, fo.employment_rate) == (70.0, 20.0, 55.0)
    # Foreign = every non-'Total' nationality (NULL and España included, as in the view); Spanish = Total - Foreign
    assert (fo.employed_population, fo.inactive_population, fo.total_population) == (9000.0, 8000.0, 320007.0)
    assert (sp.employed_population, sp.unemployed_population, sp.total_population) == (141000.0, 15000.0, 9993.0)
    assert sp.national_pct_services == 72.73 and fo.national_pct_construction == 30.0
    assert sp.national_gross_earnings_per_worker_eur == 25000.46


def test_poverty_and_migration(t):
    assert rows(M.mart_immigration_poverty_pv(t), "year", "poverty_rate", "national_poverty_rate", "poverty_gap_pp",
                "foreign_population_pct") == [(2020, 10.0, 21.04, 11.0, 6.04), (2021, 11.0, None, None, 6.91)]
    assert rows(M.stg_migration_basque_country(t)) == [(2020, 5.56, 4.0, None)]


def test_build_all_models_analyse(t):
    built = M.build_all(t)
    assert len(built) == 26
    for name, df in built.items():
        assert df.columns, name


def test_declared_view_tests_find_planted_faults(spark, t):
    """A row without province, a repeated year and a value outside the list, each found by its declared test."""
    from pyspark.sql import functions as F

    from regiolake.operators import quality as Q
    from regiolake.plans.schemas import view_contracts
    views = M.build_all(t)
    names = ["mart_immigration_crime_study_pv_rates", "stg_ine_padron_foreign_province"]
    crime, padron = (views[n] for n in names)
    bad = {names[0]: crime.unionByName(crime), names[1]: padron.withColumn("province_std", F.lit("Elsewhere")).unionByName(
        padron.withColumn("province_std", F.lit(None).cast("string")))}
    found = {(r["dataset"], r["check_name"], r["column_name"]): r["n_failed"] for r in Q.check_many(
        bad, [c for c in view_contracts() if c.dataset in names], spark, ("not_null", "unique", "accepted_values")).collect()}
    n = padron.count()
    assert found[names[0], "unique", "year"] == crime.count()
    assert found[names[1], "not_null", "province_std"] == n and found[names[1], "accepted_values", "province_std"] == n


def test_contracts_cover_all_views_and_tables():
    from regiolake.plans import schemas as S
    v = S.view_contracts()
    assert (sum(len(c.not_null) for c in v), sum(len(c.unique) for c in v), sum(len(c.accepted_values) for c in v)) == (86, 5, 13)
    assert {c.dataset for c in v} == set(M.MODELS)
    assert {c.dataset for c in S.contracts()} == {c.dataset for c in S.post_load_contracts()} == set(S.SCHEMAS)
