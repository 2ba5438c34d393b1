"""DQ-1..7, DQ-12 before a load: the contracts of :mod:`.quality` on CSV files instead of loaded tables.

The values of a file are text, so a contract on it says two more things than one on a table: whether the file can be read at all,
and whether its numbers are numbers.  Columns take the types that their values show (SRC-7), so keys are compared as numbers where all
of them are.  Check rows, beside those of :func:`.quality.check`:

* ``missing``: nothing lies at the path; ``unreadable``: no header (both end the dataset's checks);
* ``over_long``: records with more cells than their header, which are left out of all other checks;
* ``not_numeric``: values of a non-negative or year column that are no number; they count in no other check of that column.

A dataset's files are parsed once, into a written table; the types take one pass over it and the contract what it always takes.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import text_tables as TT
from . import quality as Q

# Cells that the usual CSV readers take for no value.
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
              "None", "n/a", "nan", "null")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _told(check: str, column: str | None, n: Column) -> Column:
    return F.struct(F.lit(check).alias("check_name"), F.lit(column).cast("string").alias("column_name"), n.cast("long").alias("n_failed"))


def check_csv(spark: SparkSession, path: str, contract: Q.Contract, skip: int = 0, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The checks of one contract on the CSV file or folder at ``path`` as check rows."""
    def fault(name):
        return spark.createDataFrame([(contract.dataset, name, None, 1, "ERROR")], Q.CHECK_SCHEMA)
    if not exists(spark, path):
        return fault("missing")
    lines = materialize(TT.read_lines(spark, path, skip, sep, encoding=encoding), f"checked_{contract.dataset}")
    # the headers alone tell the columns; a file with a header and no record has no line here and is told by the check "empty"
    names = TT.header_names(lines) or _header_of(spark, path, skip, sep, encoding)
    if not [n for n in names if n]:
        return fault("unreadable")
    table = TT.columns(lines, infer=True, nulls=NULL_TEXTS, headers=names).drop("file")
    year = [contract.year_col] if contract.check_year_range and contract.year_col else []
    numeric = [c for c in [*contract.non_negative, *year] if c in table.columns]
    texts = [c for c in numeric if table.schema[c].dataType.typeName() == "string"]
    long = lines.agg(F.count_if(F.col("reason") == "over-long").alias("n")).select(F.array(_told("over_long", None, F.col("n"))).alias("rows"))
    odd = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()) if c in texts else F.lit(0) for c in numeric]
    odd = table.agg(F.array(*[_told("not_numeric", c, n) for c, n in zip(numeric, odd)]).alias("rows")) if numeric else long.limit(0)
    own = long.unionByName(odd).select(F.inline("rows")).select(
        F.lit(contract.dataset).alias("dataset"), "check_name", "column_name", "n_failed",
        F.when(F.col("n_failed") > 0, "ERROR").otherwise("OK").alias("severity"))
    return own.unionByName(Q.check(table.withColumns({c: F.col(c).try_cast("double") for c in texts}), contract))


def _header_of(spark, path, skip, sep, encoding):
    """Names of the headers of files without any record."""
    # the header as the first record of a file read without one
    first = TT.read_lines(spark, path, skip, sep, header=False, encoding=encoding)
    place = first.groupBy("file").agg(F.min_by("vals", "place").alias("names"))
    return TT.header_names(place.select("file", F.transform("names", lambda x: F.trim(x)).alias("names")))


def check_csv_files(spark: SparkSession, paths: Mapping[str, str], contracts: Iterable[Q.Contract], **how) -> DataFrame:
    """The pre-load checks of many datasets; ``how`` as in :func:`check_csv`.  A dataset without a path is missing; roll up with
    :func:`.quality.status` and stop a load with :func:`.quality.gate`."""
    out = None
    for c in contracts:
        rows = Q.check_many({}, [c], spark) if c.dataset not in paths else check_csv(spark, paths[c.dataset], c, **how)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], Q.CHECK_SCHEMA) if out is None else out
