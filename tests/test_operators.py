"""Unit fixtures for the column builders and operators (edge rows of FIXTURES.md / SURVEY §1.4)."""
import os

import pytest
from pyspark.sql import functions as F

from regiolake.functions import labels as L
from regiolake.functions import numbers as N
from regiolake.functions import text as X
from regiolake.operators import quality as Q
from regiolake.operators import relational as R
from regiolake.operators import reshape as RS
from regiolake.operators import series as S
from regiolake.sources import html as H
from regiolake.sources import text_tables as TT
from regiolake.sources.catalog import latest_file

from conftest import rows


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("y")).first()["y"]


def test_text_functions(spark):
    assert one(spark, X.strip_ws(F.col("x")), "  Araba ") == "Araba"          # T8
    assert one(spark, X.title_case(F.col("x")), "araba/álava") == "Araba/Álava"          # T9
    assert one(spark, X.title_case(F.col("x")), "CASTILLA Y LEÓN") == "Castilla Y León"
    assert one(spark, X.fold_accents(F.col("x")), "Nación Ñandú") == "nacion nandu"
    assert one(spark, X.norm_key(F.col("x")), " Tipo de Dato ") == "tipo_de_dato"
    assert one(spark, X.strip_numeric_prefix(F.col("x")), "1.01.- Francia") == "Francia"
    assert one(spark, X.upper_trim(F.col("x")), "  Pnv ") == "PNV"
    m, y = X.month_year_of_header(F.col("x"))
    assert one(spark, F.struct(m, y), "dic. 1990") == ("dic.", "1990")
    assert one(spark, F.struct(m, y), "sin fecha") == ("", "")                            # N13
    assert one(spark, X.years_in(F.col("x")), "Precios 2019-2020 (2021)") == [2019, 2020, 2021]
    a, b = X.split_last(F.col("x"), "_")
    assert one(spark, F.struct(a, b), "Bizkaia_Total_Hombres") == ("Bizkaia_Total", "Hombres")


def test_number_functions(spark):
    assert one(spark, N.locale_number(F.col("x")), "1.234,5") == 1234.5
    assert one(spark, N.locale_number(F.col("x")), "..") is None
    assert one(spark, N.locale_number(F.col("x")), "123.0") == 1230.0                    # N9 (loose)
    assert one(spark, N.locale_number(F.col("x"), strict=True), "123.0") == 123.0
    assert one(spark, N.safe_double(F.col("x")), "nan") is None                          # T10
    assert one(spark, N.safe_int(F.col("x")), "12.9") == 12
    assert one(spark, N.safe_ratio(F.col("x"), F.lit(0)), 5, "int") is None              # T2
    assert one(spark, N.fixed(F.col("x"), 2), 1.005, "double") == 1.01                    # T5
    assert one(spark, N.half_even(F.col("x"), 2), 0.125, "double") == 0.12
    assert one(spark, N.round_to_long(F.col("x")), 2.5, "double") == 3


def test_label_functions(spark):
    rules = [("prefix", "araba", "Araba"), ("iregex", "pa[ií]s vasco", "País Vasco")]
    assert one(spark, L.standardise(F.col("x"), rules), "PAÍS VASCO") == "País Vasco"    # T7
    assert one(spark, L.standardise(F.col("x"), rules), "Madrid") is None
    assert one(spark, L.month_number(F.col("x")), " Dic. ") == 12
    assert one(spark, L.month_number(F.col("x")), "agosto") == 6                          # N14
    # first matching rule only: no re-replacement (N8)
    rw = [("Álava", "Araba/Álava"), ("Araba", "Araba/Álava")]
    assert one(spark, L.first_match_rewrite(F.col("x"), rw), "Araba/Álava") == "Araba/Araba/Álava"
    assert one(spark, L.first_match_rewrite(F.col("x"), [("^Álava$", "Araba/Álava"), ("^Araba$", "Araba/Álava")]),
               "Araba") == "Araba/Álava"
    assert one(spark, L.bucket(F.col("x"), {"Spanish": ["España"]}, "Foreign"), None) == "Foreign"   # T13


def test_priority_merge_modes(spark):
    keys = ["k", "y"]
    eu = spark.createDataFrame([("A", 2020, 1.0)], "k string, y int, v double")
    eu_raw = spark.createDataFrame([("A", 2020), ("A", 2021)], "k string, y int")   # raw keys, one without output
    pa = spark.createDataFrame([("A", 2020, 2.0), ("A", 2021, 2.0), ("A", 2022, 2.0)], "k string, y int, v double")
    ec = spark.createDataFrame([("A", 2022, 3.0), ("A", 2023, 3.0)], "k string, y int, v double")
    complete = S.priority_merge([(eu, None), (pa, None), (ec, None)], keys, "src")
    assert rows(complete) == [("A", 2020, 1.0, 0), ("A", 2021, 2.0, 1), ("A", 2022, 2.0, 1), ("A", 2023, 3.0, 2)]
    raw = S.priority_merge([(eu, eu_raw), (pa, None), (ec, None)], keys, "src")       # N4 raw coverage
    assert rows(raw) == [("A", 2020, 1.0, 0), ("A", 2022, 2.0, 1), ("A", 2023, 3.0, 2)]


def test_chain_ratio_and_splice(spark):
    old = spark.createDataFrame([("A", 2019, 10.0), ("A", 2020, 12.0), ("B", 2020, 5.0)], "g string, y int, v double")
    new = spark.createDataFrame([("A", 2020, 24.0), ("A", 2021, 30.0), ("B", 2021, 7.0)], "g string, y int, v double")
    r = S.chain_ratio(old, new, ["g", "y"], ["g"], "v", "v")
    assert rows(r) == [("A", 0.5)]
    sp = S.splice(old, new, r, ["g", "y"], ["g"], "v")
    assert rows(sp.where(F.col("source") == "new")) == [("A", 2021, 15.0, "new"), ("B", 2021, 7.0, "new")]
    # spliced series equals the old series on old periods
    assert rows(sp.where(F.col("source") == "old")) == rows(old.withColumn("source", F.lit("old")))


def test_residual_part_plus_rest_is_total(spark):
    df = spark.createDataFrame([(2020, "Total", 100), (2020, "X", 30), (2020, "Y", 20), (2021, "X", 1)],
                               "y int, cat string, n long")
    got = rows(S.residual(df, ["y"], "cat", ["n"], "Total", ["X", "Y"], "Part", "Rest"))
    assert got == [(2020, "Part", 50), (2020, "Rest", 50), (2021, "Part", 1)]


def test_series_stats(spark):
    df = spark.createDataFrame([("a", y, float(y), 2.0 * y + 1) for y in range(2000, 2005)] +
                               [("b", 2000, 1.0, 1.0), ("b", 2001, 1.0, 2.0), ("b", 2002, 1.0, 3.0),
                                ("c", 2000, 1.0, 1.0)], "g string, y int, x double, z double")
    c = {r["g"]: r for r in S.corr_by_group(df, ["g"], "x", "z").collect()}
    assert round(c["a"]["r"], 9) == 1.0 and c["b"]["r"] is None and c["c"]["r"] is None   # T3
    assert S.mean_corr(S.corr_by_group(df, ["g"], "x", "z")).first()["mean_r"] == pytest.approx(1.0)
    fit = {r["g"]: r for r in S.fit_by_group(df, ["g"], "x", "z").select("g", "slope", "intercept").collect()}
    assert fit["a"]["slope"] == pytest.approx(2.0) and fit["a"]["intercept"] == pytest.approx(1.0)
    assert fit["b"]["slope"] is None                                                      # T4
    idx = S.index_pair(df, ["g"], "y", "x", "z").where(F.col("y") == 2000)
    assert {r["g"]: r["x_index"] for r in idx.collect()} == {"a": 100.0, "b": 100.0}     # index = 100 at base
    cut = S.break_cut(spark.createDataFrame([("a", 1, 10.0), ("a", 2, 11.0), ("a", 3, 20.0), ("a", 4, 21.0)],
                                            "g string, y int, v double"), ["g"], "y", "v")
    assert [r["y"] for r in cut.orderBy("y").collect()] == [1, 2]


def test_fallback(spark):
    a = spark.createDataFrame([(1,)], "v int")
    b = spark.createDataFrame([(2,)], "v int")
    assert rows(S.with_fallback(a, b)) == [(1,)]
    assert rows(S.with_fallback(a.where("v > 5"), b)) == [(2,)]


def test_forward_fill_blocked_equals_plain(spark):
    data = [(g, t, (t if t % 7 == 0 else None)) for g in ("a", "b") for t in range(1, 200)]
    data += [("c", t, None) for t in range(5)]
    df = spark.createDataFrame(data, "g string, t long, v long")
    plain = rows(R.forward_fill(df, ["g"], "t", ["v"]))
    blocked = rows(R.forward_fill(df, ["g"], "t", ["v"], block=16))
    assert plain == blocked
    assert dict(((g, t), v) for g, t, v in blocked)[("a", 20)] == 14


def test_split_even_last_part_takes_remainder(spark):
    df = spark.range(0, 11).withColumnRenamed("id", "k")
    got = rows(R.split_even(df, ["k"], 3, num_ranges=4).groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    assert got == [(0, 3), (1, 3), (2, 5)]
    tiny = rows(R.split_even(spark.range(0, 2).withColumnRenamed("id", "k"), ["k"], 3).select("part"))
    assert tiny == [(2,), (2,)]


def test_top1_tie_break_and_first_per_key(spark):
    df = spark.createDataFrame([("p", "Magreb", 9), ("p", "América", 9), ("p", "Este", 2), ("q", "x", None)],
                               "g string, o string, n int")
    assert rows(R.top1_per_group(df, ["g"], "n", ["o", "n"], tie_break=["o"])) == [("p", "América", 9), ("q", "x", None)]
    f = R.first_per_key(df, ["g"], [F.col("n"), F.col("o")])
    assert rows(f) == [("p", "Este", 2), ("q", "x", None)]


def test_quality_contract(spark):
    df = spark.createDataFrame([(None, 2020, 1.0), ("a", 2020, 1.0), ("a", 2020, 2.0), ("a", 2020, 3.0),
                                ("b", 1989, -1.0), ("c", 2999, 5.0)], "k string, year int, v double")
    c = Q.Contract("t", required_columns=["k", "year", "v", "missing_col"], pk=["k", "year"], non_negative=["v"],
                   reference_year=2025)
    got = {(r.check_name, r.column_name): (r.n_failed, r.severity) for r in Q.check(df, c).collect()}
    assert got[("required_columns", "missing_col")] == (1, "ERROR")
    assert got[("null_pk", "k")] == (1, "WARNING")
    assert got[("dup_rows", "k,year")] == (2, "WARNING")        # N10: surplus rows
    assert got[("dup_groups", "k,year")] == (1, "WARNING")      # N10: duplicated groups
    assert got[("negative", "v")] == (1, "WARNING")
    assert got[("year_range", "year")] == (2, "WARNING")
    empty = Q.check(df.limit(0), Q.Contract("e", pk=["k"]))
    assert {r.check_name: r.severity for r in empty.collect()}["empty"] == "ERROR"
    st = Q.status(Q.check_many({"t": df, "gone": None}, [c, Q.Contract("gone")], spark))
    assert rows(st, "dataset", "status") == [("gone", "ERROR"), ("t", "ERROR")]
    with pytest.raises(Q.QualityGateError):
        Q.gate(st)


def test_titled_csv_files_and_latest_file(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "v_2023.csv").write_bytes("Título\nprov;año;precio\nAraba;2023;1.234,5\nmal\n".encode("latin-1"))
    (d / "v_2024.csv").write_bytes("Título\nprov;año;precio\nBizkaia;2024;2.000\n".encode("latin-1"))
    t = TT.read_titled_csv(spark, str(d / "*.csv"), skip=1, sep=";", encoding="ISO-8859-1", min_fields=3)
    got = rows(t.select("prov", "año", N.locale_number("precio").alias("p")))
    assert got == [("Araba", "2023", 1234.5), ("Bizkaia", "2024", 2000.0)]
    last = latest_file(spark, str(d / "*.csv"))
    assert [os.path.basename(r["path"]) for r in last.select("path").collect()] == ["v_2024.csv"]


def test_nested_html_tables(spark):
    html = ("<table><tr><td>a</td><td><table><tr><td>in1</td></tr></table></td></tr>"
            "<tr><td>b &amp; c</td><td>2</td></tr></table>")
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = rows(H.nested_table_cells(df, "page_id"))
    assert (1, 0, 0, 0, "a") in got and (1, 1, 0, 0, "in1") in got and (1, 0, 1, 0, "b & c") in got


def test_reshape_roundtrip(spark):
    wide = spark.createDataFrame([("A", 1.0, None, "x")], "p string, `2019` double, `2020` double, note string")
    assert rows(RS.melt_years(wide, ["p"])) == [("A", 2019, "1.0"), ("A", 2020, None)]
    st = RS.stack_groups(spark.createDataFrame([(1, 10, 20, 30)], "id int, a1 int, a2 int, b1 int"), ["id"],
                         [("a", {"x": "a1", "y": "a2"}), ("b", {"x": "b1"})])
    assert rows(st) == [(1, "a", "10", "20"), (1, "b", "30", None)]
    ym = RS.melt_year_map(spark.createDataFrame([(1, 5, 6, 7)], "id int, q1 int, q2 int, q3 int"), ["id"],
                          ["q1", "q2", "q3"], F.array(F.lit(2019), F.lit(2020)))
    assert rows(ym) == [(1, 2019, 1, "5"), (1, 2020, 2, "6"), (1, 2020, 3, "7")]


def test_year_between_is_a_pushable_range(spark):
    df = spark.createDataFrame([("1999-12-31 23:59:59",), ("2000-01-01 00:00:00",), ("2001-01-01 00:00:00",)],
                               "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    got = [r.ts.year for r in df.where(N.year_between("ts", 2000, 2000)).collect()]
    assert got == [2000]
    assert len(df.where(N.year_between("ts", last=2000)).collect()) == 2


def test_catalog_views_and_counts(spark):
    from regiolake.sources.catalog import Catalog
    c = Catalog(spark, "/root/testdata/sf0.001")
    c.register_views(prefix="t_")
    assert spark.sql("SELECT COUNT(*) AS n FROM t_region").first()["n"] == 5
    counts = {r.table_name: r.row_count for r in c.row_counts().collect()}
    assert counts["nation"] == 25 and len(counts) == 14


def test_read_delimited_positional_and_short_lines(spark, tmp_path):
    p = tmp_path / "padron.csv"
    p.write_text("Nacionalidad;Provincias;Total\nTOTAL;01 Araba/Álava;12.345\ncorta;linea\nTOTAL;48 Bizkaia;..\n",
                 encoding="utf-8")
    df = TT.read_delimited(spark, str(p), "nat string, prov string, total string", sep=";", min_fields=3)
    got = rows(df.select("prov", N.locale_number("total").alias("t")))
    assert got == [("01 Araba/Álava", 12345.0), ("48 Bizkaia", None)]


def test_file_readers_px_and_json(spark, tmp_path):
    import json
    from regiolake.sources import json_series as J
    from regiolake.sources import px as PX
    d = tmp_path / "px"
    d.mkdir()
    (d / "a.px").write_bytes('VALUES("Sexo")="Hombres","Mujeres";\nVALUES("periodo")="2020";\nDATA=\n"1.234" 5;\n'
                             .encode("latin-1"))
    cells = PX.dims_to_columns(PX.read_px(spark, str(d / "*.px")), ["sexo", "periodo"])
    assert rows(cells.select("sexo", "periodo", "value")) == [("Hombres", "2020", 1234.0), ("Mujeres", "2020", 5.0)]
    j = tmp_path / "js"
    j.mkdir()
    (j / "list.json").write_text(json.dumps([{"Nombre": "a", "Data": [{"Anyo": 2020, "Valor": 1.5}]}]), encoding="utf-8")
    (j / "obj.json").write_text(json.dumps({"Data": [{"Nombre": "b", "Data": [{"Anyo": "2021", "Valor": "x"}]}]}),
                                encoding="utf-8")
    pts = J.points(J.read_series(spark, str(j / "*.json")), ["Nombre"])
    assert rows(pts.select("Nombre", "year", "value")) == [("a", 2020, 1.5), ("b", 2021, None)]


def test_px_files_in_splits_equal_whole_cubes(spark, tmp_path):
    from regiolake.sources import px as PX
    d = tmp_path / "px"
    d.mkdir()
    for f, n in (("a", 40), ("b", 7)):
        labels = ",\n".join(f'"{f}{i}"' for i in range(n))
        data = "\n".join(" ".join(str(i * 3 + j) if (i + j) % 5 else '".."' for j in range(3)) for i in range(n))
        (d / f"{f}.px").write_bytes(f'CHARSET="ANSI";\nVALUES("Año")={labels};\nVALUES("k")="x","y","z";\nDATA= \n{data};\nNOTE="1 2";\n'
                                    .encode("latin-1"))
    whole = spark.read.format("binaryFile").load(str(d)).select(F.col("path").alias("file"), F.decode("content", "ISO-8859-1").alias("content"))
    cols = ["dims", "labels", "cell_pos", "raw", "value"]
    want = rows(PX.parse_px(whole, keep=["file"]).select(*cols))
    conf = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = rows(PX.read_px(spark, str(d)).select(*cols))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want and len(want) == 47 * 3


def test_pivot_map_keeps_first_values_and_empty_rows(spark):
    df = spark.createDataFrame([("a", 2, "x", 5), ("a", 2, "w", 3), ("a", 1, None, 1), ("a", 3, "z", 1), ("b", 1, None, 1), ("c", None, "q", 1)],
                               "g string, y int, v string, o int")
    got = {r["g"]: dict(r["cells"] or {}) for r in RS.pivot_map(df, ["g"], "y", "v", F.col("o")).collect()}
    assert got == {"a": {2: "w", 3: "z"}, "b": {}, "c": {}}


def test_latest_file_scans_that_file_alone(spark, tmp_path):
    for d, f, text in (("x", "v_1.csv", "a"), ("x", "v_[9] b.csv", "last"), ("y", "v_2.csv", "c")):
        (tmp_path / d).mkdir(exist_ok=True)
        (tmp_path / d / f).write_text(f"h\n{text}\n")
    last = latest_file(spark, str(tmp_path / "*" / "*.csv"), fmt="csv", options={"header": "true"})
    assert rows(last) == [("last",)] and len(last.inputFiles()) == 1
    by_path = latest_file(spark, str(tmp_path / "*" / "*.csv"), fmt="csv", by="file_path", options={"header": "true"})
    assert rows(by_path) == [("c",)] and len(by_path.inputFiles()) == 1


def test_probe_tells_faults_apart(spark, tmp_path):
    df = spark.range(10).select("id", F.col("id").cast("string").alias("s"))
    df.repartition(3).write.parquet(str(tmp_path / "ok"))
    df.repartition(2).write.parquet(str(tmp_path / "cut"))
    part = next((tmp_path / "cut").glob("part-*.parquet"))
    part.write_bytes(part.read_bytes()[:-20])
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"PAR1 nothing")
    (tmp_path / "none").mkdir()
    df.write.parquet(str(tmp_path / "two" / "k=1"))
    df.select(F.array("id").alias("id")).write.parquet(str(tmp_path / "two" / "k=2"))
    got = Q.probe(spark, {n: str(tmp_path / n) for n in ("ok", "cut", "bad", "none", "gone", "two")}, {"ok": df.schema, "cut": df.schema})
    assert rows(got.select("dataset", "check_name", "n_failed", "severity")) == sorted([
        ("ok", "readable", 0, "OK"), ("cut", "unreadable", 1, "ERROR"), ("bad", "unreadable", 1, "ERROR"), ("none", "empty", 1, "ERROR"),
        ("gone", "missing", 1, "ERROR"), ("two", "schema", 1, "ERROR")])


def test_by_outcome_parses_once(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (3, None)], "k int, v string")
    good, bad = Q.by_outcome(df, F.col("v").try_cast("int") > 0, "outcome-test")
    assert rows(good) == [(1, "1")] and rows(bad.select("k")) == [(2,), (3,)]
    good, bad = Q.by_outcome(df.limit(0), F.col("v") == "1", "outcome-test")
    assert good.count() == bad.count() == 0 and good.columns == ["k", "v"]
