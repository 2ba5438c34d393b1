"""Reshape operators (RSH-*): wide <-> long, header parsing, column -> year maps, stacking.

All of them are narrow transformations (``unpivot`` / ``stack`` / ``posexplode``
inside each row) except the pivots, which are one ``groupBy`` with a
declared value list (no extra job to discover the pivot values).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_year_of_header, split_last


def year_columns(df: DataFrame) -> list[str]:
    """Digit-only column names, in order."""
    return [c for c in df.columns if c.isdigit()]


def melt_years(df: DataFrame, ids: Sequence[str], value_name: str = "value", year_name: str = "year") -> DataFrame:
    """RSH-1: wide table with one column per year -> (ids, year int, value)."""
    ys = year_columns(df)
    if not ys:
        raise ValueError("no digit-only year columns")
    long = df.select(*ids, *[F.col(y).cast("string").alias(y) for y in ys]).unpivot(
        list(ids), ys, year_name, value_name)
    return long.withColumn(year_name, F.col(year_name).cast("int"))


def melt_split(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str], sep: str = "_",
               names: tuple[str, str] = ("group", "measure"), value_name: str = "value") -> DataFrame:
    """RSH-2: melt, then split each column name on its **last** ``sep`` into two dimensions."""
    long = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in value_cols]).unpivot(
        list(ids), list(value_cols), "__var", value_name)
    head, tail = split_last(F.col("__var"), sep)
    return long.select(*ids, head.alias(names[0]), tail.alias(names[1]), value_name)


def pivot_first(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence,
                order: Column | None = None) -> DataFrame:
    """RSH-3 / AGG-12: long -> wide; each cell holds the first non-NULL value (by ``order``
    when given, which makes "first" deterministic)."""
    if order is None:
        agg = F.first(value, ignorenulls=True)
    else:
        agg = F.min_by(value, F.when(F.col(value).isNotNull(), order))
    return df.groupBy(*index).pivot(column, list(values)).agg(agg)


def pivot_map(df: DataFrame, index: Sequence[str], column: str, value: str, order: Column, name: str = "cells") -> DataFrame:
    """RSH-3 / AGG-12 with open columns: long -> one row per ``index`` with a map label -> first non-NULL value by ``order``,
    labels ascending.  The labels needn't be known when the plan is made, and no pass looks for them; labels whose values are all
    NULL aren't in the map.  One shuffle by index and label, one by index; a map holds the labels of one row."""
    first = (df.where(F.col(value).isNotNull() & F.col(column).isNotNull()).groupBy(*index, column)
             .agg(F.min_by(value, order).alias("__v")))
    cells = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("__v").isNotNull(), F.struct(column, "__v")))))
    # index rows without any value keep an empty map
    every = df.select(*index, F.lit(None).cast(df.schema[column].dataType).alias(column),
                      F.lit(None).cast(df.schema[value].dataType).alias("__v")).distinct()
    return first.unionByName(every).groupBy(*index).agg(cells.alias(name))


def melt_with_header(cells: DataFrame, keys: Sequence[str], header_row: int = 0, label_col: int = 0,
                     label_name: str = "label") -> DataFrame:
    """RSH-4: a table as cells (keys, row_idx, col_idx, text) whose header cells read like
    ``'mayo 1990'`` -> long rows (keys, label, month, year, text) for every body cell right
    of the label column.  Header cells without a year give ``year = ''`` (N13)."""
    keys = list(keys)
    head = cells.where(F.col("row_idx") == header_row).select(*keys, "col_idx", F.col("text").alias("__h"))
    m, y = month_year_of_header(F.col("__h"))
    head = head.select(*keys, "col_idx", m.alias("month"), y.alias("year"))
    labels = cells.where((F.col("row_idx") > header_row) & (F.col("col_idx") == label_col)).select(
        *keys, "row_idx", F.col("text").alias(label_name))
    body = cells.where((F.col("row_idx") > header_row) & (F.col("col_idx") != label_col))
    return (body.join(labels, on=keys + ["row_idx"], how="inner").join(head, on=keys + ["col_idx"], how="inner")
                .select(*keys, "row_idx", label_name, "month", "year", "text"))


def melt_year_map(df: DataFrame, ids: Sequence[str], cols: Sequence[str], years: Column,
                  value_name: str = "value") -> DataFrame:
    """RSH-5: the i-th of ``cols`` takes the i-th year of ``years`` (an array column, e.g. the
    years found in a sheet name); when there are fewer years the last one repeats."""
    arr = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)])
    x = df.select(*ids, years.alias("__years"), F.inline(arr))
    y = F.when(F.size("__years") > 0,
               F.try_element_at(F.col("__years"), F.least(F.col("i"), F.size("__years")).cast("int")))
    return x.select(*ids, y.alias("year"), F.col("i").alias("col_pos"), F.col("v").alias(value_name))


def stack_groups(df: DataFrame, ids: Sequence[str], groups: Sequence[tuple[str, Mapping[str, str]]],
                 label_name: str = "label") -> DataFrame:
    """RSH-6: k column groups -> k rows per input row: each group gives a label and a
    mapping output column -> input column (missing input -> NULL)."""
    outs = list(dict.fromkeys(k for _, m in groups for k in m))
    structs = []
    for label, m in groups:
        structs.append(F.struct(F.lit(label).alias(label_name),
                                *[(F.col(m[o]) if o in m else F.lit(None)).cast("string").alias(o) for o in outs]))
    return df.select(*ids, F.inline(F.array(*structs)))


def row_records(df: DataFrame, cols: Sequence[str], label_name: str = "label", value_name: str = "value",
                missing=0, ids: Sequence[str] = ()) -> DataFrame:
    """RSH-7: each row -> (label, value) records, a missing value as ``missing``."""
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), label_name, value_name)
    return long.withColumn(value_name, F.coalesce(F.col(value_name), F.lit(float(missing))))


def flatten_header(cells: DataFrame, keys: Sequence[str], rows: tuple[int, int] = (0, 1), sep: str = "_",
                   name: str = "column_name") -> DataFrame:
    """RSH-8: two header rows -> one name per column, ``top + sep + bottom``; an empty top
    cell inherits the last non-empty top cell to its left (merged header cells)."""
    from pyspark.sql import Window
    keys = list(keys)
    top = cells.where(F.col("row_idx") == rows[0]).select(*keys, "col_idx", F.nullif(F.trim("text"), F.lit("")).alias("t"))
    w = Window.partitionBy(*keys).orderBy("col_idx").rowsBetween(Window.unboundedPreceding, 0)
    top = top.withColumn("t", F.last("t", ignorenulls=True).over(w))
    bot = cells.where(F.col("row_idx") == rows[1]).select(*keys, "col_idx", F.nullif(F.trim("text"), F.lit("")).alias("b"))
    j = top.join(bot, on=keys + ["col_idx"], how="full")
    return j.select(*keys, "col_idx", F.concat_ws(sep, "t", "b").alias(name))
