"""SRC-8: PC-Axis (PX) cubes -> one row per cell, as a Spark job.

A cube file lists its dimensions as ``VALUES("dim")="a","b",...;`` and its
cells as one flat ``DATA=v1 v2 ...;`` vector in row-major order (the last
dimension varies fastest).  The cell at flat position ``p`` has, for
dimension ``k`` with size ``n_k``, the label index
``(p div prod(n_{k+1..})) mod n_k``.  All of this is expressed with
``regexp_extract_all``, ``posexplode`` and integer arithmetic in the plan.
``read_px`` reads files in splits, cell by cell; ``parse_px`` takes cubes that
are held in a string column.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import locale_number
from ..session import materialize
from .records import lines_of


def parse_px(df: DataFrame, content_col: str = "content", keep: Sequence[str] = (),
             strict_numbers: bool = True) -> DataFrame:
    """Cells of every cube in ``content_col``.

    Output: ``keep + [dims (array<string>), labels (array<string>), cell_pos, raw, value]``
    where ``value`` is the locale-parsed number (``".."`` and other symbols -> NULL)."""
    c = F.col(content_col)
    dims, labels = _dimensions(c)
    cube = df.select(*keep, dims.alias("dims"), labels.alias("__labels"),
                     _tokens(F.regexp_extract(c, r"DATA\s*=\s*([^;]*);", 1)).alias("__tok"))
    cube = cube.withColumn("__sizes", F.transform("__labels", lambda a: F.size(a).cast("long")))
    cells = cube.select(*keep, "dims", "__labels", "__sizes", F.posexplode("__tok").alias("cell_pos", "raw"))
    return _cells(cells, keep, strict_numbers)


def _dimensions(text: Column) -> tuple[Column, Column]:
    """Names of the dimensions, and their labels."""
    lists = F.regexp_extract_all(text, F.lit(r'VALUES\("[^"]*"\)\s*=\s*([^;]*);'), 1)
    return (F.regexp_extract_all(text, F.lit(r'VALUES\("([^"]*)"\)\s*='), 1),
            F.transform(lists, lambda s: F.regexp_extract_all(s, F.lit(r'"([^"]*)"'), 1)))


def _tokens(data: Column) -> Column:
    return F.filter(F.split(F.trim(data), r"\s+"), lambda t: t != "")


def _cells(cells: DataFrame, keep: Sequence[str], strict_numbers: bool) -> DataFrame:
    """Labels and numbers of cells that know their place in the cube."""
    # a cell may be quoted ("..", "1.234"): the quotes are not part of the value
    cells = cells.withColumn("raw", F.regexp_replace("raw", r'^"|"$', ""))
    # label index of each dimension; a lambda over positions keeps this inside one expression
    lab = F.expr("""transform(__sizes, (n, k) ->
                      element_at(element_at(__labels, k + 1),
                        cast((cell_pos div aggregate(slice(__sizes, k + 2, greatest(size(__sizes) - k - 1, 0)),
                                                     1L, (acc, x) -> acc * x)) % n AS INT) + 1))""")
    return cells.select(*keep, "dims", lab.alias("labels"), "cell_pos", "raw",
                        locale_number("raw", strict=strict_numbers).alias("value"))


def read_px(spark: SparkSession, path, encoding: str = "ISO-8859-1", strict_numbers: bool = True) -> DataFrame:
    """Cells of PX files (decoded with their charset, latin-1 by default): ``file, dims, labels, cell_pos, raw, value``.

    A cube isn't held in one row.  Its file is read in splits; the lines of the data vector are counted in tokens, and prefix
    sums over the splits of a file and over the lines of a split give each token its place in the cube.  Only the
    dimension lists, the part above ``DATA``, are gathered by file."""
    lines = lines_of(spark, path, encoding)
    is_data = F.rlike(F.col("line"), F.lit(r"^\s*DATA\s*="))
    place = F.struct("block", "at")
    begins = materialize(lines.where(is_data).groupBy("file").agg(F.min(place).alias("begin")), "px_begin")
    told = lines.join(begins, "file").withColumn("t", F.when(place == F.col("begin"), F.regexp_replace(
        "line", r"^\s*DATA\s*=", "")).when(place > F.col("begin"), F.col("line")))
    # one more pass: the lines above DATA, and where the semicolon is that ends the vector (what comes after it is no data)
    head = told.groupBy("file").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("t").isNull(), F.struct("block", "at", "line")))),
                                 lambda x: x["line"]), "\n").alias("h"),
        F.first("begin").alias("begin"), F.min(F.when(F.contains("t", F.lit(";")), place)).alias("end"))
    cubes = head.select("file", "begin", "end", *[c.alias(n) for n, c in zip(("dims", "__labels"), _dimensions(F.col("h")))])
    cubes = materialize(cubes.withColumn("__sizes", F.transform("__labels", lambda a: F.size(a).cast("long"))), "px_dims")

    text = F.when(place == F.col("begin"), F.regexp_replace("line", r"^\s*DATA\s*=", "")).otherwise(F.col("line"))
    data = lines.join(cubes.select("file", "begin", "end"), "file").where((place >= F.col("begin")) & (
        F.col("end").isNull() | (place <= F.col("end")))).select("file", "block", "at", _tokens(F.substring_index(text, ";", 1)).alias("tok"))
    data = data.where(F.size("tok") > 0)
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    before = data.groupBy("file", "block").agg(F.sum(F.size("tok")).alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("__before"))
    placed = (data.withColumn("__line", F.coalesce(F.sum(F.size("tok")).over(here), F.lit(0)))
              .join(before, ["file", "block"]).join(cubes.drop("begin", "end"), "file"))
    cells = placed.select("file", "dims", "__labels", "__sizes", (F.col("__before") + F.col("__line")).alias("__from"),
                          F.posexplode("tok").alias("__i", "raw"))
    return _cells(cells.withColumn("cell_pos", F.col("__from") + F.col("__i")), ["file"], strict_numbers)


def dims_to_columns(cells: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project the label array to one column per dimension, in file order."""
    return cells.select(*keep, *[F.col("labels")[i].alias(n) for i, n in enumerate(names)], "raw", "value")
