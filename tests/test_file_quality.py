"""Contracts on CSV files: what can't be read, what isn't a number, and the checks of a table."""
import pytest

from regiolake.operators import file_quality as FQ
from regiolake.operators import quality as Q

from conftest import rows


@pytest.fixture
def contract():
    return Q.Contract("d", required_columns=["k", "v"], pk=["k"], non_negative=["v"], year_min=2000, reference_year=2020)


def told(df):
    return {(r["check_name"], r["column_name"]): (r["n_failed"], r["severity"]) for r in df.collect()}


def test_faults_of_a_file(spark, tmp_path, contract):
    (tmp_path / "a.csv").write_text('﻿k,v,year\n1,-2,1999\n1.0,x,2021\nNA,,2022\n2,"3",2005\n3,4,5,6\n\n')
    got = told(FQ.check_csv(spark, str(tmp_path), contract))
    assert got["over_long", None] == (1, "ERROR") and got["rows", None] == (4, "OK") and got["empty", None] == (0, "OK")
    assert got["not_numeric", "v"] == (1, "ERROR") and got["not_numeric", "year"] == (0, "OK")
    assert got["negative", "v"] == (1, "WARNING") and got["year_range", "year"] == (2, "WARNING")
    # keys of numbers only are compared as numbers
    assert got["null_pk", "k"] == (1, "WARNING") and got["dup_rows", "k"] == (1, "WARNING")
    assert got["required_columns", None] == (0, "OK")


def test_files_with_other_columns_and_quoted_records(spark, tmp_path, contract):
    (tmp_path / "a.csv").write_text('T\nk;v\na;1\n"b\nc";2\n')
    (tmp_path / "b.csv").write_text("T\nv;k\n7;a\n")
    got = told(FQ.check_csv(spark, str(tmp_path), contract, skip=1, sep=";"))
    assert got["rows", None] == (3, "OK") and got["dup_groups", "k"] == (1, "WARNING") and ("year_range", "year") not in got
    (tmp_path / "c.csv").write_text("T\nw\n7\n")
    got = FQ.check_csv(spark, str(tmp_path / "c.csv"), contract, skip=1, sep=";")
    assert [r["column_name"] for r in got.where("check_name = 'required_columns'").collect()] == ["k,v"]


def test_missing_empty_and_unreadable(spark, tmp_path, contract):
    (tmp_path / "head.csv").write_text("k,v,year\n")
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    names = ("head", "none", "blank", "gone")
    made = [Q.Contract(n, required_columns=["k"], pk=["k"], non_negative=["v"]) for n in (*names, "no path")]
    got = FQ.check_csv_files(spark, {n: str(tmp_path / f"{n}.csv") for n in names}, made)
    assert rows(Q.status(got), "dataset", "status") == [(n, "ERROR") for n in ("blank", "gone", "head", "no path", "none")]
    assert rows(got.where("severity = 'ERROR'"), "dataset", "check_name") == [
        ("blank", "unreadable"), ("gone", "missing"), ("head", "empty"), ("no path", "missing"), ("none", "unreadable")]
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.status(got))
    assert FQ.check_csv_files(spark, {}, []).count() == 0
