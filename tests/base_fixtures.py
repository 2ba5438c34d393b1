"""Invented base-table rows (FIXTURES.md §4) covering the edge cases of each model."""
from regiolake.plans.schemas import SCHEMAS

PV = "Todas las edades. Tasa de riesgo de pobreza (renta del año anterior a la entrevista). Base 2013."

ROWS = {
    "eustat_activity_nationality": [
        ("Activity rate", "Araba/Álava", "Spanish nationality", "Annual average", 2020, 55.04),
        ("Activity rate", "Araba/Álava", "Spanish nationality", "Q1", 2020, 99.0),
        ("Activity rate", "Euskadi", "Spanish nationality", "Annual average", 2020, 56.0),
        ("Activity rate", "PAÍS VASCO", "Spanish nationality", "Annual average", 2020, 57.0),
        ("Activity rate", "Euskadi", "Foreign nationality", "Annual average", 2020, 70.0),
        ("Activity rate", "Nowhere", "Total", "Annual average", 2020, 10.0),
        ("Unemployment rate", "Euskadi", "Spanish nationality", "Annual average", 2020, 8.0),
        ("Unemployment rate", "Euskadi", "Foreign nationality", "Annual average", 2020, 20.0),
        ("Employment rate", "Euskadi", "Spanish nationality", "Annual average", 2020, 50.0),
        ("Employment rate", "Euskadi", "Foreign nationality", "Annual average", 2020, 55.0),
    ],
    "crime_detentions": [
        ("Araba/Álava", "Europa", "Francia", "Ambos sexos", 2020, 10),
        ("Bizkaia", "Europa", "España", "Ambos sexos", 2020, 100),
        ("Bizkaia", "África", "Marruecos", "Ambos sexos", 2020, 30),
        ("Gipuzkoa", "", "Sin determinar", "Ambos sexos", 2020, 5),
        ("Gipuzkoa", "", None, "Ambos sexos", 2020, 7),
        ("Madrid", "Europa", "Francia", "Ambos sexos", 2020, 999),
        ("Bizkaia", "África", "Marruecos", "Hombres", 2020, 20),
    ],
    "crime_detentions_total": [
        ("PAÍS VASCO", "TOTAL INFRACCIONES PENALES", "TOTAL edad", "Ambos sexos", 2020, 200),
        ("PAÍS VASCO", "TOTAL INFRACCIONES PENALES", "TOTAL edad", "Masculino", 2020, 150),
        ("PAÍS VASCO", "OTROS", "TOTAL edad", "Ambos sexos", 2020, 1),
    ],
    "elections_parlamento_vasco": [
        ("1990", "mayo", "Pnv ", 20), ("1990", "mayo", "EA", 10),
        ("1990", "dic.", "Pnv ", 22), ("1990", "dic.", "PNV", 1), ("1990", "dic.", "EA", 9),
        ("1994", "agosto", "PNV", 30), ("1994", "julio", "PNV", 29),
        ("", "mayo", "X", 3),
    ],
    "epa_contract_stats": [
        ("Ambos sexos", "Total", "Ganancia (bruta) por trabajador y año", "Total", 2020, 25000.456),
        ("Ambos sexos", "Total", "Ganancia (bruta) por hora y año", "Total", 2021, 16.125),
    ],
    "population_eustat_nationality": [
        ("Euskadi", "Araba/Alava", "Total", "Total", "Total", 2020, 330000.0),
        ("Euskadi", "Araba/Alava", "Africa", "Total", "Total", 2020, 20000.0),
        ("Euskadi", "Araba/Alava", None, "Total", "Total", 2020, 7.0),
        ("Euskadi", "Araba/Alava", "España", "Total", "Total", 2020, 300000.0),
        ("Euskadi", "Araba/Alava", "Africa", "Employed population", "Total", 2020, 9000.0),
        ("Euskadi", "Araba/Alava", "Total", "Employed population", "Total", 2020, 150000.0),
        ("Euskadi", "Araba/Alava", "Total", "Unemployed population", "Total", 2020, 15000.0),
        ("Euskadi", "Araba/Alava", "Africa", "Inactive population", "Total", 2020, 8000.0),
        ("Euskadi", "Araba/Alava", "Total", "Inactive population", "Total", 2020, 165000.0),
    ],
    "population_eustat_total": [
        ("Araba/Álava", "España", 2020, 300000), ("Araba/Álava", "Magreb", 2020, 9000),
        ("Araba/Álava", "América del Sur", 2020, 9000), ("Araba/Álava", "Europa del Este", 2020, 2000),
        ("Araba/Álava", "Total", 2020, 320000), ("Total", "Total", 2020, 2200000),
    ],
    "housing_prices_annual": [
        (2020, "Álava", "Province", 2000.0, "a"), (2020, "Araba/Álava", "Province", 2100.0, "a"),
        (2020, "Bizkaia", "Province", 3000.0, "a"), (2020, "Bizkaia", "Province", 3001.0, "b"),
        (2020, "Madrid", "Province", 4000.0, "a"), (2019, "Gipuzkoa", "Province", 3500.0, "a"),
    ],
    "ine_ecp_foreign": [
        ("Araba", 2021, 25000, 333000, 7.5), ("Araba", 2023, 27000, 335000, 8.06),
        ("Bizkaia", 2023, 70000, 1150000, 6.09), ("Madrid", 2023, 1, 2, 50.0),
    ],
    "ine_employment": [
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Total", 2020, 19000.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Española", 2020, 16000.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Doble nacionalidad", 2020, 500.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Servicios", "Española", 2020, 12000.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Extranjera: Unión Europea", 2020, 1000.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Extranjera: Total", 2020, 2500.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Construcción", "Extranjera: América Latina", 2020, 300.0),
        ("Ocupados", "Total Nacional", "Ambos sexos", "Total", "Apátrida rara", 2020, 3.0),
    ],
    "ine_padron_foreign": [
        ("01 Araba/Álava", "Araba", 2019, 21000), ("01 Araba/Álava", "Araba", 2020, 22000),
        ("01 Araba/Álava", "Araba", 2021, 23000), ("48 Bizkaia", "Bizkaia", 2019, 60000),
    ],
    "population_total": [
        ("province", "Araba/Álava", 2019, 330000.5, "Ambos sexos", "Todas las edades", None, "c", "d", "u", "t", "1 de julio de"),
        ("province", "Araba/Álava", 2020, 331000.0, "Ambos sexos", "Todas las edades", None, "c", "d", "u", "t", "1 de julio de"),
        ("province", "Araba/Álava", 2021, 333000.0, "Ambos sexos", "Todas las edades", None, "c", "d", "u", "t", "1 de julio de"),
        ("province", "Bizkaia", 2019, 1150000.0, "Ambos sexos", "Todas las edades", None, "c", "d", "u", "t", "1 de julio de"),
        ("province", "Araba/Álava", 2020, 1.0, "Hombres", "Todas las edades", None, "c", "d", "u", "t", "1 de julio de"),
    ],
    "migration_birth_country": [
        ("País Vasco", "Tasa de Inmigración Interautonómica", "Ambos sexos", "Total edades", "Ambas nacionalidades",
         "Anual", "Dato base", 2020, 5.555, "x"),
        ("País Vasco", "Tasa de Inmigración Interautonómica", "Ambos sexos", "Total edades", "Española",
         "Anual", "Dato base", 2020, 4.0, "x"),
    ],
    "ine_poverty_stats": [
        ("ccaa", "País Vasco", PV, 2020, 10.0), ("ccaa", "Total Nacional", PV, 2020, 21.04),
        ("ccaa", "País Vasco", PV, 2021, 11.0),
    ],
}


def base_tables(spark):
    return {name: spark.createDataFrame(ROWS.get(name, []), SCHEMAS[name]) for name in SCHEMAS}
