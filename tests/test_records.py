"""Delimited files: quoted cells over lines and splits, own headers, bad lines counted."""
import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from regiolake.sources import records as R
from regiolake.sources import text_tables as TT

from conftest import rows


def cut(spark, *lines, sep=","):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string")
    return [r["f"] for r in df.select("i", R.fields(F.col("x"), sep).alias("f")).orderBy("i").collect()]


def test_fields_agree_with_a_csv_reader(spark):
    rnd = random.Random(4)
    want = [[rnd.choice(["", "a", 'q"q', "x,y", '"', ",", '""', " b ", "l\nm", "é;"]) for _ in range(rnd.randrange(1, 9))]
            for _ in range(300)]
    out = io.StringIO()
    w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\x1e")
    w.writerows(want)
    assert cut(spark, *out.getvalue().split("\x1e")[:-1]) == want
    assert cut(spark, 'a,"b,c",d', "", 'x;"y"', sep=";") == [['a,b,c,d'], [""], ["x", "y"]]


def test_a_long_line_of_quoted_fields(spark, tmp_path):
    n = 20_000
    (tmp_path / "a.csv").write_text(",".join(f'"h{i}"' for i in range(n)) + "\n" + ",".join(f'"v,{i}"' for i in range(n)) + "\n")
    got = TT.read_lines(spark, str(tmp_path / "a.csv")).select("names", "vals", "reason").collect()
    assert len(got) == 1 and len(got[0]["names"]) == n and got[0]["vals"][-1] == f"v,{n - 1}" and got[0]["reason"] is None
    text = (tmp_path / "a.csv").read_text()
    by = TT.by_own_header(spark.createDataFrame([(text,)], "content string"), "content").collect()
    assert len(by) == 1 and by[0]["vals"][5] == "v,5"


def test_short_over_long_and_multi_line_records_are_told_apart(spark, tmp_path):
    text = '﻿Title, with a comma\r\nn,x,y\r\nA,"1\r\n1",2\r\nB,3,4,9\r\nC,5\r\n\r\n"D ""d""",6,"7,7"\r\n'
    (tmp_path / "a.csv").write_bytes(text.encode())
    lines = TT.read_lines(spark, str(tmp_path), skip=1)
    assert rows(TT.columns(lines).drop("file")) == sorted([("A", "1\n1", "2"), ("C", "5", None), ('D "d"', "6", "7,7")])
    assert [tuple(r)[1:] for r in TT.rejects(lines).collect()] == [("over-long", 1)]
    content = spark.createDataFrame([(text,)], "content string")
    got = TT.by_own_header(content, "content", skip=1).select("names", "vals").collect()
    assert [r["vals"] for r in got] == [["A", "1\n1", "2"], ["C", "5"], ['D "d"', "6", "7,7"]]
    assert TT.by_own_header(content, "content", skip=1, drop_bad=False).where("bad").count() == 1


def test_options_hold_without_names(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Título\nprov;año;precio\nAraba;2023;1\nmal\n".encode("latin-1"))
    t = TT.read_titled_csv(spark, str(tmp_path), skip=1, sep=";", encoding="ISO-8859-1", min_fields=3)
    assert t.columns == ["file", "prov", "año", "precio"] and rows(t.drop("file")) == [("Araba", "2023", "1")]


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n;y;v\np;2020;1,5\ny;n;v\n")          # a data line like a header of another file
    (tmp_path / "b.csv").write_text("y;n;w\n2021;q;7\n")
    t = TT.read_titled_csv(spark, str(tmp_path / "*.csv"), sep=";", infer=True)
    assert rows(t.select("n", "y", "v", "w")) == [("p", "2020", "1,5", None), ("q", "2021", None, 7), ("y", "n", "v", None)]
    assert dict(t.dtypes)["w"] == "bigint"
    two = TT.read_delimited(spark, str(tmp_path / "*.csv"), "a string, b string")
    assert rows(two) == [("2021", "q"), ("p", "2020"), ("y", "n")]


@pytest.mark.parametrize("block", [64, 1000])
def test_splits_give_the_same_records_as_whole_files(spark, tmp_path, block):
    rnd = random.Random(block)
    want = {}
    for f in ("a", "b", "plain"):
        cells = ["x", "1,2", "é"] if f == "plain" else ["x", "1,2", "l\nm\n\nn", 'q"', "", "é\n,"]
        want[f] = [[str(i), rnd.choice(cells), rnd.choice(cells)] for i in range(150)]
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as h:
            h.write("a title\n")
            csv.writer(h, lineterminator="\n").writerows([["k", "p", "q"], *want[f]])
    conf = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = TT.read_lines(spark, str(tmp_path / "*.csv"), skip=1)
        assert R.lines_of(spark, str(tmp_path / "a.csv")).select("block").distinct().count() > 3
        got = TT.columns(lines).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for f in want:
        mine = sorted((int(r["k"]), r["p"] or "", r["q"] or "") for r in got if r["file"].endswith(f"/{f}.csv"))
        assert mine == [(int(k), p, q) for k, p, q in want[f]]


def test_empty_files_and_folders_of_titles_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("only a title\n")
    (tmp_path / "c.csv").write_text("title\nn,v\n")
    lines = TT.read_lines(spark, str(tmp_path / "*.csv"), skip=1)
    assert lines.count() == 0 and TT.rejects(lines).count() == 0


def test_only_lines_of_longer_records_are_moved(spark, tmp_path):
    """Every line of a file with a quoted line break was sorted and shuffled, several times; and no split may lose the count."""
    want = [[str(i), f'a "{i}"\n\nb,' if i % 10 == 0 else f"plain {i}"] for i in range(3000)]
    for f in range(3):
        with open(tmp_path / f"f{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows([["key", "note"], *want])
    conf = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = R.lines_of(spark, str(tmp_path))
        recs = R.read_records(lines, R.split_facts(lines))
        assert "Window" not in recs._jdf.queryExecution().optimizedPlan().toString()
        no = [r["no"] for r in recs.where("file LIKE '%f1.csv'").orderBy("place").collect()]
        assert no == list(range(3001))
        got = TT.read_lines(spark, str(tmp_path)).where("file LIKE '%f2.csv'").orderBy("place").collect()
        assert [r["vals"] for r in got] == want and {r["reason"] for r in got} == {None}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_kinds_of_columns_are_those_of_the_casts(spark):
    odd = ["1", " 1\t", "+1", "-", "1.5", ".5", "1e3", "1d", "0x1p3", "NaN", "inf", " -Infinity ", "Inside", "", None, "١", "1 2", "\x7f1", "99999999999999999999"]
    for v in odd:
        df = spark.createDataFrame([("f", 0, ["a"], [v], None), ("f", 1, ["a"], ["7"], None), ("f", 2, ["a"], [None], None)],
                                   "file string, place long, names array<string>, vals array<string>, reason string")
        fits = spark.createDataFrame([(v,)], "a string").select(F.col("a").try_cast("bigint").isNotNull().alias("i"),
                                                                  F.col("a").try_cast("double").isNotNull().alias("d")).first()
        kind = "bigint" if not v else "string" if not fits["d"] else "bigint" if fits["i"] else "double"
        assert TT.columns(df, infer=True).dtypes[1][1] == kind, v
