"""SRC-1..4, FN-21: nested statistical series (JSON) -> tidy long rows.

A series is ``{Nombre, T3_Unidad, MetaData: [{T3_Variable, Nombre}],
Data: [{Anyo, Valor, NombrePeriodo, T3_TipoDato, T3_Periodo}]}``; a file is a
list of series or an object whose ``Data`` holds that list.

Everything is expressed with ``from_json`` + higher-order functions
(``filter``/``transform``/``element_at``) + ``inline``; the metadata of a
series is resolved inside its row, so there is no Python per row and no
shuffle.  Files are read with an explicit schema (no inference pass).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import safe_double
from ..functions.text import after_first, before_first, norm_key
from ..session import materialize

META = T.StructType([T.StructField("T3_Variable", T.StringType()), T.StructField("Nombre", T.StringType()),
                     T.StructField("Codigo", T.StringType())])
POINT = T.StructType([T.StructField("Anyo", T.StringType()), T.StructField("Valor", T.StringType()),
                      T.StructField("NombrePeriodo", T.StringType()), T.StructField("T3_TipoDato", T.StringType()),
                      T.StructField("T3_Periodo", T.StringType()), T.StructField("Fecha", T.StringType())])
SERIES = T.StructType([T.StructField("COD", T.StringType()), T.StructField("Nombre", T.StringType()),
                       T.StructField("T3_Unidad", T.StringType()), T.StructField("MetaData", T.ArrayType(META)),
                       T.StructField("Data", T.ArrayType(POINT))])
SERIES_LIST = T.ArrayType(SERIES)
WRAPPED = T.StructType([T.StructField("Data", SERIES_LIST)])


def parse_series(df: DataFrame, text_col: str = "content", keep: Sequence[str] = ()) -> DataFrame:
    """One row per series: ``keep + [series_idx, Nombre, T3_Unidad, MetaData, Data]``.

    Accepts a root list or an object with ``Data`` (the two layouts seen)."""
    t = F.col(text_col)
    as_list = F.from_json(t, SERIES_LIST, {"mode": "PERMISSIVE"})
    as_obj = F.from_json(t, WRAPPED, {"mode": "PERMISSIVE"}).getField("Data")
    arr = F.when(F.rlike(t, F.lit(r"^\s*\[")), as_list).otherwise(as_obj)
    s = df.select(*keep, F.posexplode_outer(arr).alias("series_idx", "s"))
    return s.where(F.col("s").isNotNull()).select(*keep, "series_idx", "s.Nombre", "s.T3_Unidad",
                                                  F.coalesce("s.MetaData", F.array().cast(T.ArrayType(META))).alias("MetaData"),
                                                  F.coalesce("s.Data", F.array().cast(T.ArrayType(POINT))).alias("Data"))


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1 file form: each JSON file is one row (``wholetext``), parsed with a fixed schema."""
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "content")
    return parse_series(raw.withColumn("file", F.col("_metadata.file_name")), "content", keep=["file"])


def read_series_splits(spark: SparkSession, path) -> DataFrame:
    """SRC-1 to SRC-4 for large files: ``file, series_at, Nombre, T3_Unidad, MetaData, Data``, a file read by several tasks.

    Files are cut after each closing brace, wherever lines end.  Prefix sums over the pieces of a split and over the splits of a
    file tell whether a piece begins inside a string, and how many braces and brackets are open there; a series is what
    lies between a brace that opens in a list of the file's top level and the brace that closes it.  Only a series is ever one value.
    ``series_at`` orders the series of a file.

    Series are the objects of the root list or, below a root object, of the lists in it; text after a file's last
    whole series is passed over."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", "^\ufeff", "").alias("v"))
    plain = F.regexp_replace("v", r"(?s)\\.", "xx")          # an escaped quote is no quote; lengths stay
    raw = raw.withColumn("quotes", F.length("v") - F.length(F.replace(plain, F.lit('"'), F.lit(""))))
    above = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("file", "block").orderBy("place")
    before, so_far = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, 0)

    def earlier(name: str):
        return F.coalesce(F.sum(name).over(above), F.lit(0)).alias(name)
    root = F.min(F.when(F.col("block") == 0, F.struct("at", F.rlike("v", F.lit(r"^\s*\{")).cast("int").alias("b"))))
    splits = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.sum("quotes").alias("quotes"), root["b"].alias("base"))
    splits = materialize(splits.select("file", "block", "first", earlier("quotes").alias("quotes_before"),
                                       F.max("base").over(Window.partitionBy("file")).alias("base")), "json_splits")

    p = raw.join(splits, ["file", "block"]).withColumn("place", F.col("block") + F.col("at") - F.col("first"))
    p = p.withColumn("inside", (F.col("quotes_before") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2)
    hidden = F.transform(F.split(plain, '"'), lambda x, i: F.when((i + F.col("inside")) % 2 == 1, F.repeat(F.lit("x"), F.length(x))).otherwise(x))
    p = p.withColumn("bare", F.array_join(hidden, '"'))        # strings blanked out, place by place

    def count(text, c):
        return F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    closes = ((F.col("inside") + F.col("quotes")) % 2 == 0).cast("int")
    p = p.select("file", "block", "place", "v", "bare", "base", closes.alias("closes"), count(F.col("bare"), "{").alias("opens"),
                 (count(F.col("bare"), "[") - count(F.col("bare"), "]")).alias("square"))
    p = materialize(p.withColumn("curly", F.col("opens") - F.col("closes")), "json_pieces")
    depths = p.groupBy("file", "block").agg(F.sum("curly").alias("curly"), F.sum("square").alias("square"))
    depths = materialize(depths.select("file", "block", earlier("curly").alias("c0"), earlier("square").alias("s0")), "json_depths")

    p = p.join(depths, ["file", "block"])
    p = p.withColumn("c", F.col("c0") + F.coalesce(F.sum("curly").over(before), F.lit(0))) \
         .withColumn("s", F.col("s0") + F.coalesce(F.sum("square").over(before), F.lit(0)))
    # the brace that opens a series is the one that goes one level below the top
    p = p.withColumn("head", F.when((F.col("c") <= F.col("base")) & (F.col("opens") > F.col("base") - F.col("c")),
                                    F.expr("substring_index(bare, '{', CAST(base - c + 1 AS INT))")))
    starts = F.col("head").isNotNull() & (F.col("s") + count(F.col("head"), "[") - count(F.col("head"), "]") == 1)
    mark = F.when(F.col("c") <= F.col("base"), F.when(starts, F.col("place")).otherwise(F.lit(-1).cast("long")))
    text = F.when(starts, F.substr("v", F.length("head") + 1)).otherwise(F.col("v"))
    p = p.select("file", "block", "place", text.alias("t"), mark.alias("mark"))
    marks = p.where(F.col("mark").isNotNull()).groupBy("file", "block").agg(F.max_by("mark", "place").alias("mark"))
    marks = splits.select("file", "block").join(marks, ["file", "block"], "left").select(
        "file", "block", F.last("mark", ignorenulls=True).over(above).alias("above"))
    owned = p.join(marks, ["file", "block"]).withColumn("series_at", F.coalesce(F.last("mark", ignorenulls=True).over(so_far), F.col("above")))
    whole = owned.where(F.col("series_at") >= 0).groupBy("file", "series_at").agg(F.array_sort(F.collect_list(F.struct("place", "t"))).alias("l"))
    one = F.from_json(F.concat(F.array_join(F.transform("l", lambda x: x["t"]), "}"), F.lit("}")), SERIES, {"mode": "PERMISSIVE"})
    return whole.select("file", "series_at", one.alias("s")).where(F.col("s").isNotNull()).select(
        "file", "series_at", "s.Nombre", "s.T3_Unidad", F.coalesce("s.MetaData", F.array().cast(T.ArrayType(META))).alias("MetaData"),
        F.coalesce("s.Data", F.array().cast(T.ArrayType(POINT))).alias("Data"))


def _var_is(v):
    return lambda m: m["T3_Variable"] == F.lit(v)


def _var_has(n):
    return lambda m: m["T3_Variable"].contains(n)


def _tag_is(t):
    return lambda e: e["t"] == F.lit(t)


def meta_exact(meta: Column, names: Mapping[str, str]) -> list[Column]:
    """SRC-1: metadata pivoted by **exact** variable name; duplicate names keep the last (T11)."""
    return [F.try_element_at(F.filter(meta, _var_is(var)), F.lit(-1))["Nombre"]
            .alias(out) for out, var in names.items()]


def meta_substring(meta: Column, needles: Sequence[str]) -> Column:
    """SRC-2: ``Nombre`` of the first metadata entry whose variable name contains any needle
    (tried in order: the first needle with a hit wins, e.g. ``SECTORES`` else ``CNAE``)."""
    cands = [F.try_element_at(F.filter(meta, _var_has(n)), F.lit(1))["Nombre"] for n in needles]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cands])


# Normalised-variable rules of the population transform, in order
# (target, substrings).  A variable is normalised by lower-casing, blanks to "_"
# and accent folding, so needles that contain a blank never match.
POPULATION_META_RULES = [
    ("sex", ["sexo"]),
    ("age_group", ["edad", "edades", "grupo_etario"]),
    ("nationality", ["nacionalidad"]),
    ("ccaa", ["comunidades", "ciudades autonomas"]),
    ("province", ["provincias"]),
    ("national", ["total nacional"]),
    ("concept", ["conceptos_demograficos"]),
    ("data_type", ["tipo_de_dato"]),
    ("unit", ["unidad"]),
]
# Defaults of the population transform.
POPULATION_DEFAULTS = {"age_group": "Todas las edades", "concept": "Población", "data_type": "Número",
                       "unit": "Personas"}


def meta_rules(meta: Column, rules: Sequence[tuple[str, Sequence[str]]], age_target: str | None = "age_group",
               age_total_label: str = "Todas las edades") -> dict[str, Column]:
    """SRC-3: classify each metadata entry by the first rule whose substring occurs in its
    normalised variable name; for every target the **last** classified entry wins.
    Entries with an empty variable or name are ignored.  For ``age_target`` a name
    containing "total" only fills the slot when no specific age is present."""
    def target_of(m):
        k = norm_key(m["T3_Variable"])
        expr = None
        for target, needles in rules:
            cond = None
            for n in needles:
                c = k.contains(n)
                cond = c if cond is None else (cond | c)
            expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
        return expr

    valid = F.filter(meta, lambda m: (F.coalesce(F.trim(m["T3_Variable"]), F.lit("")) != "")
                     & (F.coalesce(F.trim(m["Nombre"]), F.lit("")) != ""))
    tagged = F.transform(valid, lambda m: F.struct(target_of(m).alias("t"), F.trim(m["Nombre"]).alias("v")))
    out = {}
    for target, _ in rules:
        hits = F.filter(tagged, _tag_is(target))
        if target == age_target:
            specific = F.filter(hits, lambda e: ~F.lower(e["v"]).contains("total"))
            out[target] = F.coalesce(F.try_element_at(specific, F.lit(-1))["v"],
                                     F.when(F.size(hits) > 0, F.lit(age_total_label)))
        else:
            out[target] = F.try_element_at(hits, F.lit(-1))["v"]
    return out


def level_territory(m: Mapping[str, Column], national_label: str = "España") -> tuple[Column, Column]:
    """SRC-3: precedence province > ccaa > national (also the default)."""
    level = (F.when(m["province"].isNotNull(), F.lit("province"))
             .when(m["ccaa"].isNotNull(), F.lit("ccaa")).otherwise(F.lit("national")))
    terr = F.coalesce(m["province"], m["ccaa"], F.lit(national_label))
    return level, terr


def points(series: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Explode the data points of each series: ``keep + point fields + year/value``.

    ``year`` is NULL for a non-integral year, ``value`` NULL for a missing or
    unparsable value (FN-5)."""
    p = series.select(*keep, F.explode_outer("Data").alias("p")).where(F.col("p").isNotNull())
    return p.select(*keep, "p.*").withColumn("year", F.col("Anyo").try_cast("int")) \
            .withColumn("value", safe_double("Valor"))


def split_title(title: Column) -> tuple[Column, Column]:
    """SRC-4: ``"Territory. Indicator"`` -> (text before the first ``.``, text after the
    first ``". "`` or NULL)."""
    return before_first(title, "."), after_first(title, ". ")
