"""Clean-table jobs (JOB-*): raw shapes -> the tidy base tables of :mod:`regiolake.plans.schemas`.

Every job takes DataFrames that hold raw content (one row per file or page,
as produced by the readers in :mod:`regiolake.sources`) and returns a
DataFrame in the base-table schema.  Jobs are parallel across files; inside a
file the work is expressed with Spark expressions (no per-row Python).
Label lists and filters are fixed values of the reference transforms.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..functions import text as X
from ..operators import quality as Q
from ..operators import relational as R
from ..operators import reshape as RS
from ..sources import html as H
from ..sources import json_series as J
from ..sources import px as PX
from ..sources import text_tables as TT
from ..session import materialize
from ..sources.sinks import conform, write_csv
from .schemas import SCHEMAS

# Padrón province codes -> (province, province_std).
PADRON_PROVINCES = {"01 Araba/Álava": ("Araba/Álava", "Araba"), "48 Bizkaia": ("Bizkaia", "Bizkaia"),
                    "20 Gipuzkoa": ("Gipuzkoa", "Gipuzkoa")}


def job_population(raw: DataFrame, content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """JOB-01: population series (JSON) -> ``population_total`` rows, plus the number of
    rejected points (missing or unparsable year/value, FLT-9) as a one-row frame."""
    s = J.parse_series(raw, content_col)
    m = J.meta_rules(F.col("MetaData"), J.POPULATION_META_RULES)
    level, terr = J.level_territory(m)
    d = J.POPULATION_DEFAULTS
    s = s.select("Data", level.alias("level"), terr.alias("territory"), m["sex"].alias("sex"),
                 F.coalesce(m["age_group"], F.lit(d["age_group"])).alias("age_group"),
                 m["nationality"].alias("nationality"),
                 F.coalesce(m["concept"], F.lit(d["concept"])).alias("concept"),
                 F.coalesce(m["data_type"], F.lit(d["data_type"])).alias("data_type"),
                 F.coalesce(m["unit"], F.lit(d["unit"])).alias("unit"))
    p = J.points(s, ["level", "territory", "sex", "age_group", "nationality", "concept", "data_type", "unit"])
    good, bad = Q.by_outcome(p, F.col("year").isNotNull() & F.col("value").isNotNull(), "population_points")
    out = good.select(
        "level", "territory", "year", F.col("value").alias("population"), "sex", "age_group", "nationality", "concept",
        "data_type", "unit", F.coalesce("T3_TipoDato", F.lit("")).alias("tipo_dato"),
        F.coalesce("T3_Periodo", F.lit("")).alias("periodo"))
    return conform(out, SCHEMAS["population_total"]), bad.agg(F.count(F.lit(1)).alias("skipped_points"))


# The columns that the population file is sorted by.
POPULATION_ORDER = ["level", "territory", "year", "sex", "age_group", "nationality", "periodo"]


def write_population(rows: DataFrame, base: str, parts: int = 3) -> DataFrame:
    """JOB-01's files: the sorted rows in ``parts`` load files of equal length, the rest in the last (SRT-1, SNK-2), one folder
    each below ``base``; equal rows by the order go by their other columns.  Returns the rows with their part."""
    rest = [c for c in rows.columns if c not in POPULATION_ORDER]
    sorted_by = [F.col(c).asc_nulls_last() for c in [*POPULATION_ORDER, *rest]]
    told = R.split_even(rows, sorted_by, parts)
    # a part is written by several tasks; the names of their files go with the order
    told = materialize(told, "population_parts")
    write_csv(told.repartitionByRange(F.col("part"), *sorted_by).sortWithinPartitions("part", *sorted_by), base, partition_by=["part"])
    return told


def job_poverty(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """JOB-11: series titled ``"Territory. Indicator"`` -> ``ine_poverty_stats`` rows."""
    return job_poverty_counted(raw, content_col)[0]


def job_poverty_counted(raw: DataFrame, content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """JOB-11 with the number of rejected points (FLT-9)."""
    s = J.parse_series(raw, content_col)
    terr, ind = J.split_title(F.trim(F.col("Nombre")))
    p = J.points(s.select("Data", terr.alias("territory"), ind.alias("indicator")), ["territory", "indicator"])
    good, bad = Q.by_outcome(p, F.col("year").isNotNull() & F.col("value").isNotNull(), "poverty_points")
    out = good.select(F.lit("ccaa").alias("level"), "territory", "indicator", "year", "value")
    return conform(out, SCHEMAS["ine_poverty_stats"]), bad.agg(F.count(F.lit(1)).alias("n_rejected"))


def job_employment(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """JOB-04: employment series, metadata found by substring (sector: ``SECTORES`` else
    ``CNAE``).  NULL values are kept (N12): load-time enforcement decides."""
    s = J.parse_series(raw, content_col)
    meta = F.col("MetaData")
    s = s.select("Data", J.meta_substring(meta, ["RELACIÓN"]).alias("relation_activity"),
                 J.meta_substring(meta, ["Total Nacional"]).alias("territory"),
                 J.meta_substring(meta, ["Sexo"]).alias("sex"),
                 J.meta_substring(meta, ["SECTORES", "CNAE"]).alias("sector"),
                 J.meta_substring(meta, ["Nacionalidad"]).alias("nationality"))
    p = J.points(s, ["relation_activity", "territory", "sex", "sector", "nationality"])
    return conform(p.where(F.col("year").isNotNull()), SCHEMAS["ine_employment"])


def job_activity_rates(raw: DataFrame, content_col: str = "content", skip: int = 1, sep: str = ",") -> DataFrame:
    """JOB-05: titled wide CSV (title line, then header) -> ``eustat_activity_nationality``.

    The first four columns are renamed by position (PRJ-3); digit-only columns
    are years (RSH-1); values use a decimal comma (FN-4); empty values dropped."""
    ids = {n: F.get("vals", F.lit(i)) for i, n in enumerate(("rate_type", "province", "nationality", "quarter"))}
    long = TT.year_cells(TT.by_own_header(raw, content_col, skip, sep), ids)
    long = long.withColumn("value", N.safe_double(F.replace("value", F.lit(","), F.lit("."))))
    return conform(long.where(F.col("value").isNotNull()), SCHEMAS["eustat_activity_nationality"])


def job_detentions(cubes: DataFrame, content_col: str = "content", dims=("Provincias", "Nacionalidad", "Sexo", "periodo"),
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """JOB-08: PX cube -> ``crime_detentions``.

    The nationality labels form a hierarchy in cube order: ``1.- Europa`` is a
    region header, ``1.01.- Francia`` a country.  Headers set the region of the
    rows after them (WIN-4, partitioned by the file and the dimensions that
    vary slower than nationality, ordered by cell position); only country rows
    are kept; prefixes are stripped (FN-14); values parsed loosely (N9) and
    truncated to integers."""
    return detentions(PX.parse_px(cubes, content_col, keep=list(keep), strict_numbers=False), dims, keep)


def detentions(cells: DataFrame, dims=("Provincias", "Nacionalidad", "Sexo", "periodo"), keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """JOB-08 on the cells of cubes, as ``read_px`` gives them; ``keep`` names a cube."""
    names = {"Provincias": "province", "Nacionalidad": "raw_nat", "Sexo": "sex", "periodo": "year"}
    cols = [names.get(d, d) for d in dims]
    c = PX.dims_to_columns(cells.withColumn("__pos", F.col("cell_pos")), cols, keep=[*keep, "__pos"])
    nat_i = cols.index("raw_nat")
    part = [*keep, *cols[:nat_i]]
    raw = F.col("raw_nat")
    is_region = raw.rlike(r"^\d+\.-")
    is_country = raw.rlike(r"^\d+\.\d+\.-")
    c = c.withColumn("__part", F.concat_ws("|", *[F.col(p).cast("string") for p in part]) if part else F.lit(""))
    # blocked prefix scan: a large cube (one file, one province) is still filled in parallel
    c = R.carry_down(c, ["__part"], "__pos", is_region, X.strip_numeric_prefix(raw), name="region", drop_headers=True,
                     block=4096)
    out = c.where(is_country).select(
        "province", "region", X.strip_numeric_prefix(raw).alias("nationality"), "sex",
        F.col("year").try_cast("int").alias("year"), N.locale_number("raw").alias("vnum"))
    out = out.withColumn("value", F.col("vnum").cast("long")).where(F.col("vnum").isNotNull() & F.col("year").isNotNull())
    return conform(out, SCHEMAS["crime_detentions"])


def job_detentions_total(cubes: DataFrame, content_col: str = "content",
                         dims=("territory", "crime_type", "age_group", "sex", "year")) -> DataFrame:
    """JOB-09: PX cube -> ``crime_detentions_total`` (loose locale numbers, NULLs dropped)."""
    return detentions_total(PX.parse_px(cubes, content_col, strict_numbers=False), dims)


def detentions_total(cells: DataFrame, dims=("territory", "crime_type", "age_group", "sex", "year")) -> DataFrame:
    """JOB-09 on the cells of cubes."""
    c = PX.dims_to_columns(cells, list(dims))
    out = c.withColumn("year", F.col("year").try_cast("int")).withColumn("value", F.col("value").cast("long"))
    return conform(out.where(F.col("value").isNotNull() & F.col("year").isNotNull()), SCHEMAS["crime_detentions_total"])


def job_padron(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """JOB-12: ``;``-separated register file -> ``ine_padron_foreign`` (Basque provinces,
    both sexes, total foreigners; short lines skipped; ``int(float())`` of the locale value)."""
    t = TT.parse_delimited(raw, content_col, ["nationality", "province", "sex", "year", "total"], sep=";", min_fields=5)
    t = t.select(*[X.strip_ws(c).alias(c) for c in ["nationality", "province", "sex", "year", "total"]])
    t = t.where(F.col("province").isin(list(PADRON_PROVINCES)) & (F.col("sex") == "Ambos sexos")
                & (F.col("nationality") == "TOTAL EXTRANJEROS"))
    name = L.lookup("province", {k: v[0] for k, v in PADRON_PROVINCES.items()})
    std = L.lookup("province", {k: v[1] for k, v in PADRON_PROVINCES.items()})
    out = t.select(name.alias("province"), std.alias("province_std"), F.col("year").try_cast("int").alias("year"),
                   N.safe_int(F.replace(F.replace("total", F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
                   .alias("foreign_population"))
    return conform(out.where(F.col("foreign_population").isNotNull()), SCHEMAS["ine_padron_foreign"])


def job_ecp(df: DataFrame, max_year: int = 2025) -> DataFrame:
    """JOB-13: (province_std, year, foreign_population, total_population) -> add the share
    rounded to 2, half to even (0.0 when the total is not positive); years after ``max_year`` dropped."""
    d = df.select("province_std", F.col("year").cast("int").alias("year"),
                  F.col("foreign_population").cast("long").alias("foreign_population"),
                  F.col("total_population").cast("long").alias("total_population")).where(F.col("year") <= max_year)
    # the source rounds half to even; the ratio is an exact decimal, so ties are ties
    share = F.col("foreign_population").cast("decimal(20,0)") * 100 / F.col("total_population").cast("decimal(20,0)")
    pct = F.when(F.col("total_population") > 0, N.half_even(share, 2)).otherwise(F.lit(0.0))
    return conform(d.withColumn("foreign_population_pct", pct), SCHEMAS["ine_ecp_foreign"])


def job_ecp_pairing(total: DataFrame, foreign: DataFrame) -> DataFrame:
    """JOB-16: pair the total and the foreign yearly series of each province.

    Inputs: (province_std, year, obs_order, value) per observation.  For the
    foreign series the last observation of a year wins (a dict keyed by year);
    every total observation is kept, so one year can give several rows (N5).
    A year missing on the foreign side drops the row (inner lookup, JN-11).
    Values are rounded to integers, half to even."""
    last_foreign = R.top1_per_group(foreign, ["province_std", "year"], "obs_order", ["value"])
    j = total.join(last_foreign.withColumnRenamed("value", "foreign_value"), on=["province_std", "year"], how="inner")
    return j.select("province_std", F.col("year").cast("int").alias("year"),
                    N.half_even("foreign_value", 0).cast("long").alias("foreign_population"),
                    N.half_even("value", 0).cast("long").alias("total_population"))


def job_elections(pages: DataFrame, anchor: str = "Grupos parlamentarios", id_col: str = "page_id") -> DataFrame:
    """JOB-14: the table after the anchor text -> ``elections_parlamento_vasco``.

    Row 0 holds ``<month> <year>`` headers (no year -> empty strings, N13); the
    first column is the party; empty cells and rows without party are skipped."""
    cells = H.table_after_anchor(pages, anchor, keep=[id_col])
    long = RS.melt_with_header(cells, [id_col], label_name="party_name")
    seats = N.safe_double("text")
    out = long.where(F.col("party_name").isNotNull() & (F.col("party_name") != "") & seats.isNotNull()).select(
        "year", "month", "party_name", seats.cast("long").alias("seats"))
    return conform(out, SCHEMAS["elections_parlamento_vasco"])


# Exact metadata variable names of the migration series -> output column.
MIGRATION_META = {"region": "Comunidades y Ciudades Autónomas", "indicator": "Conceptos demógraficos",
                  "sex": "Sexo", "age_group": "Totales de edad", "nationality": "Nacionalidad",
                  "periodicity": "Periodicidad", "data_type": "Tipo de dato"}
# Exact metadata variable names of the earnings series -> output column.
EARNINGS_META = {"sex": "sexo", "age_group": "grupo de edad", "indicator": "tipo de indicador",
                 "disability": "personas sin y con discapacidad"}


def job_migration(raw: DataFrame, content_col: str = "content") -> DataFrame:
    """JOB-02: series with metadata pivoted by exact variable name (last duplicate wins, T11);
    points whose value is not a number are skipped; the unit comes from the series."""
    return job_migration_counted(raw, content_col)[0]


def job_migration_counted(raw: DataFrame, content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """JOB-02 with the number of skipped points (FLT-9)."""
    s = J.parse_series(raw, content_col)
    s = s.select("Data", "T3_Unidad", *J.meta_exact(F.col("MetaData"), MIGRATION_META))
    p = J.points(s, [*MIGRATION_META, "T3_Unidad"])
    good, bad = Q.by_outcome(p, F.col("value").isNotNull(), "migration_points")
    return (conform(good.withColumn("unit", F.col("T3_Unidad")), SCHEMAS["migration_birth_country"]),
            bad.agg(F.count(F.lit(1)).alias("n_rejected")))


def job_earnings(raw: DataFrame, content_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """JOB-03: earnings series; the year is the period name; invalid values are discarded
    and counted (FLT-9)."""
    s = J.parse_series(raw, content_col)
    s = s.select("Data", *J.meta_exact(F.col("MetaData"), EARNINGS_META))
    p = J.points(s, list(EARNINGS_META)).withColumn("year", N.safe_int("NombrePeriodo"))
    good, bad = Q.by_outcome(p, F.col("value").isNotNull(), "earnings_points")
    return conform(good, SCHEMAS["epa_contract_stats"]), bad.agg(F.count(F.lit(1)).alias("discarded"))


POP_NAT_IDS = ["province", "continent of nationality", "relation with the economic activity", "sex"]


def job_population_nationality(raw: DataFrame, content_col: str = "content", skip: int = 1, sep: str = ",",
                               ccaa: str = "País Vasco") -> DataFrame:
    """JOB-06: titled wide CSV -> ``population_eustat_nationality``.

    The dimension columns are required (DQ-1: a file without them is an error);
    digit-only columns are melted (RSH-1); non-numeric cells dropped; a constant
    ``ccaa`` column is added (PRJ-2)."""
    long = TT.year_cells(TT.by_own_header(raw, content_col, skip, sep), {n: TT.value_of(n) for n in POP_NAT_IDS}, "population")
    long = long.select(F.lit(ccaa).alias("ccaa"), "province",
                       F.col("continent of nationality").alias("nationality"),
                       F.col("relation with the economic activity").alias("relation_with_activity"), "sex", "year",
                       N.safe_double("population").alias("population"))
    return conform(long.where(F.col("population").isNotNull()), SCHEMAS["population_eustat_nationality"])


def job_population_origin(df: DataFrame, year: int = 2024) -> DataFrame:
    """JOB-07: (provincia, nacionalidad, total) -> ``population_eustat_total`` with a constant
    reference year; the total is coerced to a number (NULL when not numeric)."""
    missing = [c for c in ("provincia", "nacionalidad", "total") if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    out = df.select(F.col("provincia").alias("province"), F.col("nacionalidad").alias("nationality"),
                    F.lit(year).alias("year"), N.round_to_long(N.safe_double("total")).alias("population"))
    return conform(out, SCHEMAS["population_eustat_total"])


# EUSTAT quarterly housing file, 13 positional columns.
EUSTAT_HOUSING_COLS = ["trimestre", "euskadi_total", "euskadi_nueva", "euskadi_usada", "alava_total", "alava_nueva",
                       "alava_usada", "bizkaia_total", "bizkaia_nueva", "bizkaia_usada", "gipuzkoa_total",
                       "gipuzkoa_nueva", "gipuzkoa_usada"]
# Province label -> price column of the EUSTAT file.
EUSTAT_HOUSING_PROVINCES = [("Álava", "alava_total"), ("Bizkaia", "bizkaia_total"), ("Gipuzkoa", "gipuzkoa_total")]
# Province alias rewrites of the ministry sheets, in order.
MIVAU_ALIASES = [(r"Araba/.*", "Araba/Álava"), (r"Álava", "Araba/Álava"), (r"Vizcaya", "Bizkaia"),
                 (r"Guipúzcoa", "Gipuzkoa"), (r"Principado de Asturias", "Asturias"), (r"Islas Baleares", "Illes Balears"),
                 (r"Comunidad Foral de Navarra", "Navarra"), (r"Comunidad de Madrid", "Madrid"),
                 (r"Región de Murcia", "Murcia"), (r"La Rioja", "La Rioja")]
# Autonomous communities (region_type CCAA; everything else is a Province).
CCAA_NAMES = ["Andalucía", "Aragón", "Asturias", "Illes Balears", "Canarias", "Cantabria", "Castilla y León",
              "Castilla-La Mancha", "Cataluña", "Comunidad Valenciana", "Extremadura", "Galicia", "Madrid", "Murcia",
              "Navarra", "País Vasco", "La Rioja"]


def housing_eustat(raw: DataFrame, content_col: str = "content", skip: int = 4) -> DataFrame:
    """JOB-10, quarterly file: ``;``-separated, ``skip`` lines before the data, no header,
    13 positional columns (lines with another field count are skipped).  The year is the
    last numeric value of the first column above the row (WIN-3 forward fill in file
    order); only Roman-numeral quarter rows are kept (FLT-5); the three province price
    columns are stacked (RSH-6), parsed as locale numbers (FN-4) and averaged per year
    (AGG-2, rounded half-even as pandas does)."""
    # the file is named by its content: a row number would change when a part is computed again
    raw = raw.withColumn("__file", F.sha2(F.col(content_col), 256)) if "__file" not in raw.columns else raw
    return _housing(TT.parse_delimited(raw, content_col, EUSTAT_HOUSING_COLS, skip=skip, header=False, sep=";",
                                       keep=["__file"], min_fields=13, max_fields=13))


def housing_files(spark: SparkSession, path, skip: int = 4, encoding: str = "UTF-8") -> DataFrame:
    """JOB-10, quarterly files read in splits."""
    n = len(EUSTAT_HOUSING_COLS)
    lines = TT.read_lines(spark, path, skip, ";", header=False, encoding=encoding, min_fields=n, max_fields=n)
    return _housing(lines.where(F.col("reason").isNull()).select(
        F.col("file").alias("__file"), F.col("place").alias("line_no"),
        *[F.nullif(F.get("vals", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(EUSTAT_HOUSING_COLS)]))


def _housing(t: DataFrame) -> DataFrame:
    t = t.withColumn("year", F.col("trimestre").try_cast("int"))
    t = R.forward_fill(t, ["__file"], "line_no", ["year"], block=4096)
    t = t.where(F.col("trimestre").rlike(r"^[IVX]+$"))
    stacked = RS.stack_groups(t, ["year"], [(prov, {"price": col}) for prov, col in EUSTAT_HOUSING_PROVINCES],
                              label_name="province")
    stacked = stacked.withColumn("price_per_m2", N.locale_number("price"))
    # exact decimal mean, then half-even: no binary tie ambiguity in the rounding
    out = stacked.groupBy("year", "province").agg(
        N.half_even(F.avg(F.col("price_per_m2").cast("decimal(38,10)")), 2).alias("price_per_m2"))
    return out.select("year", "province", F.lit("Province").alias("region_type"), "price_per_m2",
                      F.lit("Eustat").alias("source"))


def housing_sheets(cells: DataFrame, skip_rows: int = 13, min_rows: int = 5) -> DataFrame:
    """JOB-10, ministry workbook delivered as cells ``(sheet, row_idx, col_idx, value)``.

    Row ``skip_rows`` is the header; all-empty rows are ignored; sheets with fewer
    than ``min_rows`` data rows or without a year in their name are skipped.  Quarter
    columns are header cells containing ``º`` (from the third column on) that hold
    at least one value; the i-th quarter column takes the i-th year of the sheet
    name, the last year repeating (RSH-5).  Province labels are title-cased (T9),
    rewritten by the first matching alias (FN-15, N8 fixed) and typed CCAA by a
    case-folded lookup (FN-2, N7 fixed)."""
    c = cells.withColumn("value", F.nullif(F.trim(F.col("value").cast("string")), F.lit("")))
    body = c.where(F.col("row_idx") > skip_rows)
    nonempty = body.groupBy("sheet", "row_idx").agg(F.count("value").alias("nv")).where(F.col("nv") > 0)
    body = body.join(nonempty.select("sheet", "row_idx"), on=["sheet", "row_idx"], how="left_semi")
    n_rows = nonempty.groupBy("sheet").agg(F.count(F.lit(1)).alias("n_rows"))
    head = c.where((F.col("row_idx") == skip_rows) & (F.col("col_idx") >= 2) & F.col("value").contains("º"))
    filled = body.where(F.col("value").isNotNull()).select("sheet", "col_idx").distinct()
    quarters = head.join(filled, on=["sheet", "col_idx"], how="left_semi")
    w_rank = F.dense_rank().over(Window.partitionBy("sheet").orderBy("col_idx"))
    quarters = quarters.select("sheet", "col_idx", w_rank.alias("q_pos"))
    years = X.years_in(F.col("sheet"))
    # a sheet name without a year gives no year (the sheet is skipped)
    quarters = quarters.withColumn("year", F.when(F.size(years) > 0, F.try_element_at(
        years, F.least(F.col("q_pos"), F.size(years)).cast("int"))))
    prov = body.where(F.col("col_idx") == 1).select("sheet", "row_idx", F.col("value").alias("prov"))
    vals = body.join(quarters, on=["sheet", "col_idx"], how="inner").join(prov, on=["sheet", "row_idx"], how="inner")
    vals = vals.join(n_rows.where(F.col("n_rows") >= min_rows), on="sheet", how="left_semi")
    label = L.first_match_rewrite(X.title_case(X.strip_ws(F.col("prov"))), MIVAU_ALIASES)
    ccaa = F.lower(label).isin([n.lower() for n in CCAA_NAMES])
    d = vals.select("year", label.alias("province"),
                    F.when(ccaa, F.lit("CCAA")).otherwise(F.lit("Province")).alias("region_type"),
                    N.safe_double("value").alias("price_per_m2")).dropna(subset=["year", "price_per_m2"])
    out = d.groupBy("year", "province", "region_type").agg(
        N.half_even(F.avg(F.col("price_per_m2").cast("decimal(38,10)")), 2).alias("price_per_m2"))
    return out.select("year", "province", "region_type", "price_per_m2", F.lit("MIVAU").alias("source"))


def job_housing(eustat_raw: DataFrame | None, sheet_cells: DataFrame | None, eustat: DataFrame | None = None) -> DataFrame:
    """JOB-10: both sources concatenated by name (SET-2); a missing source contributes nothing.  ``eustat``: rows of
    :func:`housing_files` in place of raw contents."""
    parts = [] if eustat is None else [eustat]
    if eustat_raw is not None:
        parts.append(housing_eustat(eustat_raw))
    if sheet_cells is not None:
        parts.append(housing_sheets(sheet_cells))
    if not parts:
        raise ValueError("no housing source")
    return conform(R.union_all(parts, allow_missing=True), SCHEMAS["housing_prices_annual"])


def job_origin_table(cells: DataFrame, keys: tuple[str, ...] = ("table",)) -> DataFrame:
    """JOB-15: a table with a two-level header (province / sex) -> (provincia, nacionalidad,
    total, hombres, mujeres).

    Cells ``(keys, row_idx, col_idx, text)``: rows 0 and 1 are the header levels,
    column 0 holds the nationality.  Headers are flattened to ``province_sex``
    (RSH-8), body cells melted and the name split on its last ``_`` (RSH-2), the
    sex values pivoted with "first" (RSH-3) and parsed as locale numbers (FN-4)."""
    keys = list(keys)
    names = RS.flatten_header(cells.where(F.col("col_idx") > 0), keys)
    nat = cells.where((F.col("row_idx") > 1) & (F.col("col_idx") == 0)).select(*keys, "row_idx",
                                                                              F.col("text").alias("nacionalidad"))
    body = cells.where((F.col("row_idx") > 1) & (F.col("col_idx") > 0))
    long = body.join(names, on=[*keys, "col_idx"]).join(nat, on=[*keys, "row_idx"])
    head, tail = X.split_last(F.col("column_name"), "_")
    long = long.select(*keys, "row_idx", head.alias("provincia"), "nacionalidad", tail.alias("sexo"), "text")
    wide = RS.pivot_first(long, [*keys, "provincia", "nacionalidad"], "sexo", "text", ["Total", "Hombres", "Mujeres"],
                          order=F.col("row_idx"))
    return wide.select(*keys, "provincia", "nacionalidad",
                       *[N.locale_number(F.col(s)).alias(s.lower()) for s in ["Total", "Hombres", "Mujeres"]])
