"""Clean-table jobs (JOB-*) on raw-shape fixtures (FIXTURES.md §2)."""
import json

import pytest

from regiolake.plans import jobs as J

from conftest import rows


def _raw(spark, *contents):
    return spark.createDataFrame([(c,) for c in contents], "content string")


def test_population_rules_defaults_and_rejects(spark):
    series = [
        {"Nombre": "a", "MetaData": [{"T3_Variable": "Provincias", "Nombre": "Bizkaia"},
                                     {"T3_Variable": "Sexo", "Nombre": "Ambos sexos"},
                                     {"T3_Variable": "Edad", "Nombre": "Total"},
                                     {"T3_Variable": "Edad", "Nombre": "De 20 a 24 años"},
                                     {"T3_Variable": "Edad", "Nombre": "TOTAL edades"}],
         "Data": [{"Anyo": 2020, "Valor": 100.5, "T3_TipoDato": "Definitivo", "T3_Periodo": "1 de julio de"},
                  {"Anyo": 2021, "Valor": None}, {"Anyo": "x", "Valor": 3}]},
        {"Nombre": "b", "MetaData": [{"T3_Variable": "Comunidades y Ciudades Autónomas", "Nombre": "País Vasco"},
                                     {"T3_Variable": "Sexo", "Nombre": "Hombres"}],
         "Data": [{"Anyo": 2020, "Valor": "7"}]},
        {"Nombre": "c", "Data": [{"Anyo": 2020, "Valor": 1}]},
    ]
    out, rej = J.job_population(_raw(spark, json.dumps(series)))
    got = rows(out, "level", "territory", "year", "population", "sex", "age_group", "concept", "periodo")
    assert got == [
        ("ccaa", "País Vasco", 2020, 7.0, "Hombres", "Todas las edades", "Población", ""),
        ("national", "España", 2020, 1.0, None, "Todas las edades", "Población", ""),
        ("province", "Bizkaia", 2020, 100.5, "Ambos sexos", "De 20 a 24 años", "Población", "1 de julio de"),
    ]
    assert rej.collect()[0]["skipped_points"] == 2


def test_poverty_title_split(spark):
    raw = {"Data": [{"Nombre": "País Vasco. Todas las edades. Tasa. Base 2013.", "Data": [{"Anyo": "2020", "Valor": "10.5"}]},
                    {"Nombre": "Sin punto", "Data": [{"Anyo": "2021", "Valor": "x"}, {"Anyo": "2022", "Valor": 3}]}]}
    got = rows(J.job_poverty(_raw(spark, json.dumps(raw))), "territory", "indicator", "year", "value")
    assert got == [("País Vasco", "Todas las edades. Tasa. Base 2013.", 2020, 10.5), ("Sin punto", None, 2022, 3.0)]


def test_employment_substring_meta_keeps_null_values(spark):
    series = [{"MetaData": [{"T3_Variable": "RELACIÓN CON LA ACTIVIDAD", "Nombre": "Ocupados"},
                            {"T3_Variable": "Total Nacional", "Nombre": "Total Nacional"},
                            {"T3_Variable": "Sexo", "Nombre": "Ambos sexos"},
                            {"T3_Variable": "CNAE 2009", "Nombre": "Industria"},
                            {"T3_Variable": "Nacionalidad", "Nombre": "Española"}],
               "Data": [{"Anyo": 2020, "Valor": 10.0}, {"Anyo": 2021, "Valor": None}]}]
    got = rows(J.job_employment(_raw(spark, json.dumps(series))), "sector", "nationality", "year", "value")
    assert got == [("Industria", "Española", 2020, 10.0), ("Industria", "Española", 2021, None)]


def test_activity_rates_titled_wide_csv(spark):
    text = ("Tasa de actividad (title)\n"
            "Tipo,Territorio,Nacionalidad,Periodo,2019,2020,nota\n"
            "Activity rate,Araba/Álava,Total,Annual average,\"55,5\",..,x\n"
            "Activity rate,Bizkaia,Total,Annual average,56,\"57,25\",y\n")
    got = rows(J.job_activity_rates(_raw(spark, text)), "province", "year", "value")
    assert got == [("Araba/Álava", 2019, 55.5), ("Bizkaia", 2019, 56.0), ("Bizkaia", 2020, 57.25)]


PX_CRIME = ('CHARSET="ANSI";\nVALUES("Provincias")="Araba","Bizkaia";\n'
            'VALUES("Nacionalidad")="1.01.- Huerfano","1.- Europa","1.01.- Francia","2.- Africa","2.01.- Marruecos","TOTAL";\n'
            'VALUES("Sexo")="Ambos sexos";\nVALUES("periodo")="2020","2021";\n'
            'DATA=\n1 2 3 4 5 6 7 8 ".." "1.234" 11 12\n13 14 15 16 17 18 19 20 "123.0" 22 23 24;\n')


def test_detentions_px_carry_down(spark):
    got = rows(J.job_detentions(_raw(spark, PX_CRIME)), "province", "region", "nationality", "year", "value")
    assert got == [
        ("Araba", "Africa", "Marruecos", 2021, 1234),          # '..' dropped; '1.234' -> 1234
        ("Araba", "Europa", "Francia", 2020, 5), ("Araba", "Europa", "Francia", 2021, 6),
        ("Araba", None, "Huerfano", 2020, 1), ("Araba", None, "Huerfano", 2021, 2),   # child before any header
        ("Bizkaia", "Africa", "Marruecos", 2020, 1230),        # '123.0' -> 1230 (loose parsing, N9)
        ("Bizkaia", "Africa", "Marruecos", 2021, 22),
        ("Bizkaia", "Europa", "Francia", 2020, 17), ("Bizkaia", "Europa", "Francia", 2021, 18),
        ("Bizkaia", None, "Huerfano", 2020, 13), ("Bizkaia", None, "Huerfano", 2021, 14),
    ]


def test_padron_filters_and_locale(spark):
    text = ("Nacionalidad;Provincias;Sexo;Periodo;Total\n"
            "TOTAL EXTRANJEROS;01 Araba/Álava;Ambos sexos;2020;12.345\n"
            "TOTAL EXTRANJEROS;48 Bizkaia ;Ambos sexos;2020;60.000\n"
            "TOTAL EXTRANJEROS;48 Bizkaia;Hombres;2020;1\n"
            "TOTAL EXTRANJEROS;20 Gipuzkoa;Ambos sexos;2020;..\n"
            "corta;linea;2020;1\n")
    got = rows(J.job_padron(_raw(spark, text)))
    assert got == [("Araba/Álava", "Araba", 2020, 12345), ("Bizkaia", "Bizkaia", 2020, 60000)]


def test_ecp_share_and_year_cap(spark):
    df = spark.createDataFrame([("Araba", 2024, 1, 3), ("Araba", 2026, 1, 2), ("Bizkaia", 2024, 5, 0)],
                               "province_std string, year int, foreign_population long, total_population long")
    assert rows(J.job_ecp(df)) == [("Araba", 2024, 1, 3, 33.33), ("Bizkaia", 2024, 5, 0, 0.0)]


def test_ecp_pairing_last_foreign_wins(spark):
    tot = spark.createDataFrame([("Araba", 2021, 0, 330000.4), ("Araba", 2021, 1, 331000.5), ("Araba", 2022, 2, 1.0)],
                                "province_std string, year int, obs_order int, value double")
    fo = spark.createDataFrame([("Araba", 2021, 0, 20000.0), ("Araba", 2021, 1, 21000.6)],
                               "province_std string, year int, obs_order int, value double")
    # halves go to the even neighbour: 331000.5 -> 331000
    assert rows(J.job_ecp_pairing(tot, fo)) == [("Araba", 2021, 21001, 330000), ("Araba", 2021, 21001, 331000)]


def test_files_with_other_year_columns_and_orders(spark):
    """Each file is read by its own header: a year that one file lacks, and columns in another order."""
    a = "t\nTipo,Territorio,Nac,Periodo,2019,2020\nA,Araba,Total,Annual average,\"1,5\",\"2,5\"\n"
    b = "t\nTipo,Territorio,Nac,Periodo,2021,2020\nA,Bizkaia,\"x, y\",Annual average,\"3,5\",\"4,5\"\n"
    raw = spark.createDataFrame([(a,), (b,)], "content string")
    got = rows(J.job_activity_rates(raw), "province", "nationality", "year", "value")
    assert got == [("Araba", "Total", 2019, 1.5), ("Araba", "Total", 2020, 2.5), ("Bizkaia", "x, y", 2020, 4.5),
                   ("Bizkaia", "x, y", 2021, 3.5)]


def test_file_without_a_required_column_is_an_error(spark):
    raw = spark.createDataFrame([("t\nprovince,sex,2020\nAraba,F,1\n",)], "content string")
    with pytest.raises(Exception, match="missing required column"):
        J.job_population_nationality(raw).collect()


def test_elections_html_table(spark):
    html = ("<html><body><h2>Composición</h2><p>Grupos parlamentarios</p><table>"
            "<tr><th>Partido</th><th>mayo 1990</th><th>dic. 1990</th><th>sin fecha</th></tr>"
            "<tr><td>PNV</td><td>22</td><td></td><td>1</td></tr>"
            "<tr><td></td><td>3</td><td>4</td><td>5</td></tr>"
            "<tr><td>EA</td><td>9</td><td>10</td><td></td></tr></table></body></html>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = rows(J.job_elections(pages), "year", "month", "party_name", "seats")
    assert got == [("", "", "PNV", 1), ("1990", "dic.", "EA", 10), ("1990", "mayo", "EA", 9), ("1990", "mayo", "PNV", 22)]


def test_housing_eustat_quarters(spark):
    pad = ";" * 12
    text = ("t1\nt2\nt3\nt4\n"
            f"2020{pad}\n"
            "I;1;1;1;1.000,5;0;0;2.000;0;0;3.000;0;0\n"
            "II;1;1;1;1.001,5;0;0;2.002;0;0;..;0;0\n"
            "demasiados;1;2;3;4;5;6;7;8;9;10;11;12;13\n"
            f"2021{pad}\n"
            "I;1;1;1;10;0;0;20;0;0;30;0;0\n")
    got = rows(J.housing_eustat(_raw(spark, text)), "year", "province", "price_per_m2", "source")
    assert got == [(2020, "Bizkaia", 2001.0, "Eustat"), (2020, "Gipuzkoa", 3000.0, "Eustat"),
                   (2020, "Álava", 1001.0, "Eustat"),                      # (1000.5 + 1001.5) / 2
                   (2021, "Bizkaia", 20.0, "Eustat"), (2021, "Gipuzkoa", 30.0, "Eustat"), (2021, "Álava", 10.0, "Eustat")]


def _sheet(name, rows_, header=("", "Provincia", "1º T", "2º T", "3º T")):
    cells = [(name, 0, 0, "titulo")]
    cells += [(name, 13, j, h) for j, h in enumerate(header)]
    for i, r in enumerate(rows_):
        cells += [(name, 14 + i, j, v) for j, v in enumerate(r) if v is not None]
    return cells


def test_housing_sheets_rules(spark):
    body = [(None, "araba/álava", "100", "200", "300"), (None, "CASTILLA Y LEÓN", "10", None, "20"),
            (None, "Vizcaya", "5", "5", "5"), (None, "x", None, None, None), (None, "y", "1", "1", "1"),
            (None, "z", "2", "2", "2")]
    cells = (_sheet("Precios 2019-2020", body) + _sheet("Sin año", body) +
             _sheet("Precios 2021", body[:3]))                           # fewer than 5 rows: skipped
    df = spark.createDataFrame(cells, "sheet string, row_idx int, col_idx int, value string")
    got = {(r.year, r.province): (r.region_type, r.price_per_m2) for r in J.housing_sheets(df).collect()}
    # 1st quarter -> 2019, 2nd and 3rd -> 2020 (last year repeats)
    assert got[(2019, "Araba/Álava")] == ("Province", 100.0)
    assert got[(2020, "Araba/Álava")] == ("Province", 250.0)             # title-cased, one rewrite only (N8)
    assert got[(2019, "Castilla Y León")] == ("CCAA", 10.0)              # case-folded CCAA lookup (N7)
    assert got[(2020, "Bizkaia")] == ("Province", 5.0)
    assert not [k for k in got if k[0] == 2021]


def test_origin_table_two_level_header(spark):
    cells = [("t", 0, 1, "Bizkaia"), ("t", 0, 2, ""), ("t", 0, 3, ""), ("t", 1, 1, "Total"), ("t", 1, 2, "Hombres"),
             ("t", 1, 3, "Mujeres"), ("t", 2, 0, "Magreb"), ("t", 2, 1, "1.234"), ("t", 2, 2, "600"), ("t", 2, 3, "634")]
    df = spark.createDataFrame(cells, "table string, row_idx int, col_idx int, text string")
    assert rows(J.job_origin_table(df).drop("table")) == [("Bizkaia", "Magreb", 1234.0, 600.0, 634.0)]
