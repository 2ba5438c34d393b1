"""SRC-5 / SRC-6 / SRC-7: delimited text with title lines, headers, positional columns.

Statistical offices publish CSV files with title lines before the header, and files of one folder may have other columns or
another order.  Files are read in splits (:mod:`.records`); each file's own header names its records, joined by file from a table
of one row a file that is written first, so that the planner sees its size and broadcasts it or not.  The same rules work
on a string column that holds whole file contents (``parse_delimited``, ``by_own_header``).

Bad lines: records with more cells than the header (or than ``max_fields``) and with fewer than ``min_fields`` are dropped, and
``rejects`` counts them by file and reason; other short records have NULLs at the end.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import records as R

# what all texts look like that Spark casts to bigint and to double
_WHOLE, _REAL = r"^[\x00-\x20\x7F-\x9F]*[-+]?[0-9]+[\x00-\x20\x7F-\x9F]*$", r"^[\x00-\x20]*[-+]?[.0-9NnIi]"


def _cells(df: DataFrame, content_col: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(R.records_in(F.col(content_col))).alias("line_no", "__rec"))


def parse_delimited(df: DataFrame, content_col: str, names: Sequence[str], skip: int = 0, header: bool = True,
                    sep: str = ",", keep: Sequence[str] = (), min_fields: int | None = None,
                    max_fields: int | None = None, quote: str = '"') -> DataFrame:
    """Parse delimited text held in ``content_col`` into columns ``names`` (bound **by position**).

    * ``skip``: title lines before the header (SRC-5);
    * ``header``: the line after the title lines is a header and is dropped;
    * ``min_fields`` / ``max_fields``: drop records with fewer / more cells than expected (SRC-6);
    * blank lines are dropped.  All values stay strings, empty ones are NULL.
    """
    body = _cells(df, content_col, keep).where((F.col("line_no") >= skip + int(header)) & (F.trim("__rec") != ""))
    cut = body.select(*keep, "line_no", R.fields(F.col("__rec"), sep, quote).alias("__vals"))
    if min_fields is not None:
        cut = cut.where(F.size("__vals") >= min_fields)
    if max_fields is not None:
        cut = cut.where(F.size("__vals") <= max_fields)
    return cut.select(*keep, "line_no", *[_value(i).alias(n) for i, n in enumerate(names)])


def _value(i: int, vals: str = "__vals") -> Column:
    return F.nullif(F.get(vals, F.lit(i)), F.lit(""))


def by_own_header(df: DataFrame, content_col: str, skip: int = 0, sep: str = ",", keep: Sequence[str] = (),
                  drop_bad: bool = True) -> DataFrame:
    """Body records of every content with the names of its own header: rows (line_no, names, vals).  Records with more
    cells than names are dropped, or with ``drop_bad=False`` kept and told by ``bad``."""
    files = df.select(*keep, R.records_in(F.col(content_col)).alias("__l"))
    head = F.transform(R.fields(F.get("__l", F.lit(skip)), sep), lambda x: F.trim(x))
    lines = files.select(*keep, head.alias("names"), F.posexplode("__l").alias("line_no", "__line"))
    out = (lines.where((F.col("line_no") > skip) & (F.trim("__line") != ""))
           .select(*keep, "line_no", "names", R.fields(F.col("__line"), sep).alias("vals")))
    bad = F.size("vals") > F.size("names")
    return out.where(~bad) if drop_bad else out.withColumn("bad", bad)


def value_of(name: str) -> Column:
    """The value under a column name of the line's own header; a file without the column is an error."""
    at = F.array_position("names", name).cast("int")
    return F.when(at > 0, F.get("vals", at - 1)).otherwise(
        F.raise_error(F.concat(F.lit(f"missing required column: {name}; the header has "), F.array_join("names", ", "))).cast("string"))


def year_cells(df: DataFrame, ids: dict[str, Column], value_name: str = "value") -> DataFrame:
    """RSH-1 on lines with their own header: one row per digit-only column."""
    cells = F.filter(F.arrays_zip("names", "vals"), lambda z: F.rlike(z["names"], F.lit("^[0-9]+$")))
    rows = df.select(*[c.alias(n) for n, c in ids.items()], F.explode(cells).alias("__z"))
    return rows.select(*ids, F.col("__z.names").cast("int").alias("year"), F.col("__z.vals").alias(value_name))


def read_lines(spark: SparkSession, path, skip: int = 0, sep: str = ",", header: bool = True, encoding: str = "UTF-8",
               min_fields: int | None = None, max_fields: int | None = None, quote: str = '"') -> DataFrame:
    """All body records of the files: (file, place, names, vals, reason).  ``place`` orders the records of a file; ``reason`` is NULL, ``over-long`` (more cells than the
    header or ``max_fields``) or ``short`` (fewer than ``min_fields``); ``names`` is NULL without a header."""
    lines = R.lines_of(spark, path, encoding)
    recs = R.read_records(lines, R.split_facts(lines, quote), quote)
    recs = recs.where(F.col("no").isNull() | (F.col("no") >= skip))
    names = F.lit(None).cast("array<string>")
    if header:
        heads = recs.where(F.col("no") == skip).select("file", F.transform(R.fields(F.col("rec"), sep, quote), lambda x: F.trim(x)).alias("names"))
        heads = materialize(heads, "headers")          # a row a file; the planner knows its size
        recs = recs.where(F.col("no").isNull() | (F.col("no") > skip)).join(heads, "file")
        names = F.col("names")
    cut = recs.where(F.trim("rec") != "").select("file", "place", names.alias("names"), R.fields(F.col("rec"), sep, quote).alias("vals"))
    most = F.lit(max_fields) if max_fields is not None else F.size("names") if header else F.lit(None).cast("int")
    reason = F.when(F.size("vals") > most, "over-long")
    if min_fields is not None:
        reason = reason.when(F.size("vals") < min_fields, "short")
    return cut.withColumn("reason", reason)


def rejects(lines: DataFrame) -> DataFrame:
    """(file, reason, n_lines) of the dropped records."""
    return lines.where(F.col("reason").isNotNull()).groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n_lines"))


def header_names(lines: DataFrame) -> list[str]:
    """Names of all headers, the first file's first: a few for each distinct header, like a schema."""
    seen = lines.groupBy("names").agg(F.min("file").alias("file")).where(F.col("names").isNotNull()).orderBy("file")
    return list(dict.fromkeys(n for r in seen.collect() for n in r["names"]))


def columns(lines: DataFrame, names: Sequence[str] | None = None, infer: bool = False, nulls: Sequence[str] = ("",),
            headers: Sequence[str] | None = None) -> DataFrame:
    """Good records as columns, ``file`` first: by the names of their own header (NULL where a file lacks one), or with ``names``
    by position.  Cells among ``nulls`` are NULL.  ``infer``: whole columns of numbers get type bigint or double (SRC-7), which takes
    one pass over the values.  ``headers``: the names of all headers, where they are known already."""
    good = lines.where(F.col("reason").isNull())

    def value(i):
        return F.when(~F.get("vals", i).isin(*nulls), F.get("vals", i))
    if names:
        out = good.select("file", *[value(F.lit(i)).alias(n) for i, n in enumerate(names)])
    else:
        names = [n for n in dict.fromkeys(headers or header_names(lines)) if n and n != "file"]
        out = good.select("file", *[value(F.array_position("names", n).cast("int") - 1).alias(n) for n in names])
    if not infer or not names:
        return out
    q = [F.col(f"`{n}`") for n in names]
    # a text that can't be a number isn't tried: its cast to null is an exception, some microseconds for each value
    def no_number(c, shape, kind):
        return c.isNotNull() & F.when(F.rlike(c, F.lit(shape)), c.try_cast(kind).isNull()).otherwise(True)
    fits = out.agg(*[F.struct(F.count_if(no_number(c, _WHOLE, "bigint")).alias("i"), F.count_if(no_number(c, _REAL, "double")).alias("d"),
                              F.count(c).alias("n")).alias(f"c{k}") for k, c in enumerate(q)]).first()
    kind = ["string" if not f["n"] or f["d"] else "double" if f["i"] else "bigint" for f in fits]
    return out.select("file", *[c.try_cast(k).alias(n) for n, c, k in zip(names, q, kind)])


def read_titled_csv(spark: SparkSession, path, skip: int = 0, sep: str = ",", encoding: str = "UTF-8",
                    names: Sequence[str] | None = None, infer: bool = False, **kw) -> DataFrame:
    """SRC-5 / SRC-7: title-prefixed CSV files as columns, bound by each file's own header or with ``names`` by position.
    ``kw``: ``min_fields``, ``max_fields``, ``quote`` of :func:`read_lines`."""
    return columns(read_lines(spark, path, skip, sep, True, encoding, **kw), names, infer)


def read_delimited(spark: SparkSession, path, schema: str | Mapping[str, str], sep: str = ";", header: bool = True,
                   min_fields: int | None = None, encoding: str = "UTF-8", **kw) -> DataFrame:
    """SRC-6 / SRC-7: delimited files with a positional schema (``"a string, b int"``); each file's header line is
    dropped, and records with fewer than ``min_fields`` cells.  A value that doesn't fit its type is NULL."""
    pairs = list(schema.items()) if isinstance(schema, Mapping) else [tuple(p.strip().rsplit(" ", 1)) for p in schema.split(",")]
    lines = read_lines(spark, path, 0, sep, header, encoding, min_fields=min_fields, **{"max_fields": 1 << 30, **kw})
    out = columns(lines, [n for n, _ in pairs])
    return out.select(*[F.col(f"`{n}`").try_cast(t).alias(n) for n, t in pairs])
