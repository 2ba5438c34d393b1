"""Analog marts MDL-20, MDL-23..26 on the driver tables.

Role mapping (besides :mod:`regiolake.plans.common`): the region label
standardised by an ordered prefix ladder plays ``province_std`` (MIDDLE EAST
matches no rule and gets NULL, like an unmatched province); distinct active
customers play population; F / O / P orders play the three foreign-population
sources (EUSTAT sparse years, Padrón to 1999, ECP from 1998).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..operators import relational as R
from ..operators import series as S
from ..session import materialize
from .common import GEO_SQL, cat, geo_orders
from .q_relational import _MONTH_NAMES
from .registry import query, sql_fixed, sql_pct, sql_ratio

PROVINCE_RULES = [("prefix", "eur", "Europa"), ("prefix", "asi", "Asia"), ("prefix", "afr", "Africa"),
                  ("prefix", "ame", "America")]
CORE = ["Europa", "Asia", "Africa"]
EUSTAT_YEARS = [1995, 1999, 2000, 2001]

G_SQL = f"""WITH {GEO_SQL.strip()},
g AS (SELECT *, CASE WHEN lower(r_name) LIKE 'eur%' THEN 'Europa' WHEN lower(r_name) LIKE 'asi%' THEN 'Asia'
                     WHEN lower(r_name) LIKE 'afr%' THEN 'Africa' WHEN lower(r_name) LIKE 'ame%' THEN 'America'
                END AS province_std FROM geo)"""

_SPARSE = ", ".join(map(str, EUSTAT_YEARS))
_IN_CORE = "province_std IN (" + ", ".join(f"'{p}'" for p in CORE) + ")"

# One row per (province, year) holds what each source says; a NULL is a source without the key.  The value is
# the first source that has one, the estimate scaled by the province's mean ratio over the shared years.
FOREIGN_PCT_CTES = f"""{G_SQL},
said AS (SELECT province_std, yr AS year, COUNT(DISTINCT o_custkey) AS everyone,
                COUNT(DISTINCT o_custkey) FILTER (o_orderstatus = 'P') AS estimated_everyone,
                NULLIF(COUNT(*) FILTER (o_orderstatus = 'F' AND yr IN ({_SPARSE})), 0) AS census,
                NULLIF(COUNT(*) FILTER (o_orderstatus = 'O' AND yr <= 1999 AND {_IN_CORE}), 0) AS register,
                NULLIF(COUNT(*) FILTER (o_orderstatus = 'P' AND yr >= 1998 AND {_IN_CORE}), 0) AS estimate
         FROM g WHERE province_std IS NOT NULL GROUP BY ALL),
chosen AS (SELECT province_std, year, census, register,
                  estimate * COALESCE(AVG({sql_ratio('register', 'estimate')}) OVER (PARTITION BY province_std), 1) AS scaled,
                  CASE WHEN census IS NULL AND register IS NULL THEN estimated_everyone ELSE everyone END AS of_all
           FROM said),
fpct AS (SELECT province_std, year,
                COALESCE(census, register, CAST(ROUND(CAST(scaled AS DECIMAL(38,10)), 0) AS BIGINT)) AS foreign_population,
                CAST(of_all AS BIGINT) AS total_population,
                {sql_pct('COALESCE(CAST(census AS DOUBLE), CAST(register AS DOUBLE), scaled)', 'of_all')} AS foreign_population_pct
         FROM chosen WHERE COALESCE(CAST(census AS DOUBLE), CAST(register AS DOUBLE), scaled) IS NOT NULL)"""


def _g(c):
    return geo_orders(c).withColumn("province_std", L.standardise("r_name", PROVINCE_RULES))


def geo_base(c):
    """One pass over the orders star, pre-aggregated to (province_std, r_name, n_name, year,
    status, customer): order count, exact revenue and priced-order count.

    Every source of the marts below is derived from this frame, so the plan scans
    and joins ``orders`` once and shuffles once on these keys; Spark reuses that
    exchange for every branch instead of re-running the star join per source.
    The customer key stays in the grain because populations are distinct
    customers; a customer holding a third of the orders still gives one
    partial row per map task (map-side combine)."""
    g = _g(c)
    agg = g.groupBy("province_std", "r_name", "n_name", F.col("yr").alias("year"), "o_orderstatus", "o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"),
        F.count("o_totalprice").alias("n_priced"))
    return materialize(agg, "geo_base")


def foreign_pct(c, base=None):
    """MDL-20 composition: TS-1 priority chain (anti-joins for the N4 coverage modes),
    TS-2 chain ratio, TS-3 splice with JN-5 default ratio, FN-7 shares."""
    b = base if base is not None else geo_base(c)
    keys = ["province_std", "year"]
    st = F.col("o_orderstatus")
    pop = b.select(*keys, "o_custkey").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("total_population"))
    eu = (b.where((st == "F") & F.col("year").isin(EUSTAT_YEARS))
           .groupBy(*keys).agg(F.sum("n").alias("foreign_population")))
    core = b.where(F.col("province_std").isin(CORE))
    pa = (core.where((st == "O") & (F.col("year") <= 1999))
              .groupBy(*keys).agg(F.sum("n").alias("foreign_population")))
    # one base row per (keys, customer) within a status: rows = distinct customers
    ec = (core.where((st == "P") & (F.col("year") >= 1998))
              .groupBy(*keys).agg(F.sum("n").alias("foreign_population"), F.count(F.lit(1)).alias("total_population")))

    def shares(df):
        return df.select(*keys, "foreign_population", "total_population",
                         N.pct("foreign_population", "total_population").alias("foreign_population_pct"))

    eustat = shares(eu.join(pop, on=keys))
    padron_raw = pa.join(pop, on=keys)
    padron = shares(R.not_covered(padron_raw, eu, keys))          # raw coverage of the higher source
    ratio = S.chain_ratio(padron_raw, ec, keys, ["province_std"], "foreign_population", "foreign_population",
                          name="pop_ratio")
    scaled = R.left_default(ec, ratio, ["province_std"], "pop_ratio", 1.0)
    scaled = R.not_covered(scaled, eu.join(pop, on=keys), keys)   # complete coverage (a join result, JN-7)
    scaled = R.not_covered(scaled, pa, keys)
    adj = F.col("foreign_population") * F.col("pop_ratio")
    ecp = scaled.select(*keys, N.round_to_long(adj).alias("foreign_population"), "total_population",
                        N.pct(adj, "total_population").alias("foreign_population_pct"))
    return R.union_all([eustat, padron, ecp]).select(
        *keys, F.col("foreign_population").cast("long").alias("foreign_population"), "total_population",
        "foreign_population_pct")


@query("mdl_foreign_pct", covers=("MDL-20", "MDL-12", "MDL-14", "MDL-15", "TS-1", "TS-2", "TS-3", "JN-5",
                                  "JN-6", "JN-7", "FN-1", "FN-6", "FN-7"),
       sql=f"{FOREIGN_PCT_CTES}\nSELECT * FROM fpct")
def mdl_foreign_pct(spark, sf_dir):
    return foreign_pct(cat(spark, sf_dir))


def population_year(fp):
    """MDL-21 (TS-13): ratio of sums over the core provinces per year."""
    a = fp.where(F.col("province_std").isin(CORE)).groupBy("year").agg(
        F.sum("total_population").cast("long").alias("total_population"),
        F.sum("foreign_population").cast("long").alias("foreign_population"))
    return a.withColumn("foreign_population_pct", N.pct("foreign_population", "total_population"))


POP_YEAR_SQL = f"""popy AS (SELECT year, CAST(SUM(total_population) AS BIGINT) AS total_population,
                 CAST(SUM(foreign_population) AS BIGINT) AS foreign_population,
                 {sql_pct('SUM(foreign_population)', 'SUM(total_population)')} AS foreign_population_pct
          FROM fpct WHERE province_std IN ('Europa', 'Asia', 'Africa') GROUP BY year)"""


@query("mdl_population_year", covers=("MDL-21", "TS-13"), sql=f"{FOREIGN_PCT_CTES},\n{POP_YEAR_SQL}\nSELECT * FROM popy")
def mdl_population_year(spark, sf_dir):
    return population_year(foreign_pct(cat(spark, sf_dir)))


# --------------------------------------------------------------------------- MDL-24 housing

@query("mdl_housing", covers=("MDL-24", "MDL-10", "MDL-11", "WIN-1", "WIN-2", "JN-4", "FLT-4", "FN-2"), sql=f"""
{FOREIGN_PCT_CTES},
housing AS (SELECT r_name AS province_raw, province_std, yr AS year,
                   {sql_fixed('SUM(CAST(o_totalprice AS DECIMAL(18,2))) / CAST(COUNT(o_totalprice) AS DOUBLE)', 2)} AS avg_price
            FROM g WHERE lower(r_name) LIKE 'eur%' OR lower(r_name) LIKE 'asi%' OR lower(r_name) LIKE 'afr%'
            GROUP BY 1, 2, 3),
origin AS (SELECT province_std, yr AS year, n_name, COUNT(*) AS k FROM g WHERE {_IN_CORE} AND n_name <> 'NATION_0' GROUP BY ALL),
top AS (SELECT province_std, year, arg_min(n_name, {{'a': -k, 'b': n_name}}) AS top_origin,
               {sql_pct('MAX(k)', 'SUM(k)')} AS top_origin_pct FROM origin GROUP BY ALL)
SELECT h.year, h.province_std, h.avg_price, f.foreign_population, f.total_population, f.foreign_population_pct,
       o.top_origin, o.top_origin_pct
FROM housing h LEFT JOIN fpct f ON f.year = h.year AND f.province_std = h.province_std
LEFT JOIN top o ON o.year = h.year AND o.province_std = h.province_std
""")
def mdl_housing(spark, sf_dir):
    c = cat(spark, sf_dir)
    base = geo_base(c)
    keys = ["province_std", "year"]
    h = (base.where(L.matches_any("r_name", [("prefix", "eur"), ("prefix", "asi"), ("prefix", "afr")]))
             .groupBy(F.col("r_name").alias("province_raw"), *keys)
             .agg(F.sum("rev").alias("s"), F.sum("n_priced").alias("k"))
             .select(*keys, N.fixed(N.exact_mean("s", "k"), 2).alias("avg_price")))
    origin = (base.where(F.col("province_std").isin(CORE)
                         & (L.bucket("n_name", {"Home": ["NATION_0"]}, "Foreign") == "Foreign"))
                  .groupBy(*keys, F.col("n_name").alias("origin")).agg(F.sum("n").alias("population")))
    with_tot = R.group_total(origin, keys, "population", "tot")
    top = R.top1_per_group(with_tot, keys, "population", ["origin", "population", "tot"], tie_break=["origin"])
    top = top.select(*keys, F.col("origin").alias("top_origin"), N.pct("population", "tot").alias("top_origin_pct"))
    fp = foreign_pct(c, base)
    out = R.left_enrich(h, (fp, keys), (top, keys))
    return out.select("year", "province_std", "avg_price", "foreign_population", "total_population",
                      "foreign_population_pct", "top_origin", "top_origin_pct")


# --------------------------------------------------------------------------- MDL-25 poverty

@query("mdl_poverty", covers=("MDL-25", "MDL-17", "MDL-18", "JN-4", "FN-11", "FLT-1"), sql=f"""
{FOREIGN_PCT_CTES},
{POP_YEAR_SQL},
p AS (SELECT yr AS year, {sql_pct("COUNT(*) FILTER (WHERE o_orderstatus = 'F')", 'COUNT(*)')} AS rate FROM g
      WHERE r_name = 'EUROPE' GROUP BY 1),
n AS (SELECT yr AS year, {sql_pct("COUNT(*) FILTER (WHERE o_orderstatus = 'F')", 'COUNT(*)')} AS rate FROM g
      GROUP BY 1)
SELECT p.year, p.rate AS regional_rate, n.rate AS national_rate, {sql_fixed('n.rate - p.rate', 1)} AS gap_pp,
       popy.total_population, popy.foreign_population, popy.foreign_population_pct
FROM p LEFT JOIN n ON p.year = n.year LEFT JOIN popy ON p.year = popy.year
""")
def mdl_poverty(spark, sf_dir):
    c = cat(spark, sf_dir)
    base = geo_base(c)

    def rate(df):
        return df.groupBy("year").agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("n"))).alias("f"),
                                      F.sum("n").alias("t")).select("year", N.pct("f", "t").alias("rate"))
    p = rate(base.where(F.col("r_name") == "EUROPE")).withColumnRenamed("rate", "regional_rate")
    n = rate(base).withColumnRenamed("rate", "national_rate")
    out = R.left_enrich(p, (n, ["year"]), (population_year(foreign_pct(c, base)), ["year"]))
    return out.select("year", "regional_rate", "national_rate",
                      N.gap("national_rate", "regional_rate", 1).alias("gap_pp"),
                      "total_population", "foreign_population", "foreign_population_pct")


# --------------------------------------------------------------------------- MDL-26 elections

def _month_base(g):
    """One pass over the orders star at (year, month, priority, status) grain."""
    return g.groupBy("yr", "mon", "o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"))


def _elections_base(mb):
    """Base table analog: (year string, month name, party_name with typographic variants, seats)."""
    names = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    party = F.when(F.col("o_orderstatus") == "O", F.concat(F.lower("o_orderpriority"), F.lit(" "))).otherwise(
        F.col("o_orderpriority"))
    return mb.groupBy(F.col("yr").cast("string").alias("year"), F.element_at(names, F.col("mon")).alias("month"),
                      party.alias("party_name")).agg(F.sum("n").alias("seats"))


# The month labels of the base table read back as their number, except August, which has no spelling in the label
# table and counts as 6; a year's result is its last month's.
ELECTIONS_SQL = f"""
stg AS (SELECT CAST(yr AS VARCHAR) AS year,
               CASE o_orderstatus WHEN 'O' THEN lower(o_orderpriority) || ' ' ELSE o_orderpriority END AS party_name,
               COUNT(*) AS total_seats
        FROM g GROUP BY yr, mon, 2
        QUALIFY IF(mon = 8, 6, mon) = MAX(IF(mon = 8, 6, mon)) OVER (PARTITION BY yr)),
el AS (SELECT CAST(year AS INTEGER) AS year, upper(trim(party_name)) AS party_name, SUM(total_seats) AS seats,
              SUM(SUM(total_seats)) OVER (PARTITION BY CAST(year AS INTEGER)) AS total_seats_year
       FROM stg GROUP BY 1, 2),
mig AS (SELECT yr AS year,
               {sql_fixed("SUM(CAST(o_totalprice AS DECIMAL(18,2))) / CAST(COUNT(*) AS DOUBLE) / 1000.0", 2)} AS rate_total,
               {sql_fixed("SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') / CAST(COUNT(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / 1000.0", 2)} AS rate_f
        FROM g GROUP BY 1)"""


@query("mdl_elections", covers=("MDL-26", "MDL-06", "AGG-1", "AGG-7", "JN-9", "FN-3", "FN-12", "FN-8", "JN-2", "JN-4"),
       sql=f"""{FOREIGN_PCT_CTES},
{POP_YEAR_SQL},{ELECTIONS_SQL}
SELECT year, party_name, CAST(seats AS BIGINT) AS seats, CAST(total_seats_year AS BIGINT) AS total_seats_year,
       {sql_pct('seats', 'total_seats_year')} AS seats_share_pct,
       total_population, foreign_population, foreign_population_pct, rate_total, rate_f
FROM el LEFT JOIN popy USING (year) LEFT JOIN mig USING (year)
""")
def mdl_elections(spark, sf_dir):
    c = cat(spark, sf_dir)
    mb = materialize(_month_base(_g(c)), "month_base")
    base = _elections_base(mb).withColumn("month_num", L.month_number("month"))
    stg = R.latest_snapshot(base, ["year"], "month_num").select("year", "party_name", F.col("seats").alias("total_seats"))
    # group by the normalised expression, not by an alias that shadows the input column (T6)
    el = stg.groupBy(F.col("year").cast("int").alias("year"), F.upper(F.trim("party_name")).alias("party_name")).agg(
        F.sum("total_seats").alias("seats"))
    tot = el.groupBy("year").agg(F.sum("seats").alias("total_seats_year"))
    isf = F.col("o_orderstatus") == "F"
    mig = (mb.groupBy(F.col("yr").alias("year"))
             .agg(F.sum("rev").alias("s"), F.sum("n").alias("n"),
                  F.sum(F.when(isf, F.col("rev"))).alias("sf"), F.sum(F.when(isf, F.col("n"))).alias("nf"))
            .select("year", N.fixed(N.exact_mean("s", "n") / 1000.0, 2).alias("rate_total"),
                    N.fixed(N.exact_mean("sf", "nf") / 1000.0, 2).alias("rate_f")))
    out = R.left_enrich(el.join(tot, on="year"), (population_year(foreign_pct(c)), ["year"]), (mig, ["year"]))
    return out.select("year", "party_name", F.col("seats").cast("long").alias("seats"),
                      F.col("total_seats_year").cast("long").alias("total_seats_year"),
                      N.pct("seats", "total_seats_year").alias("seats_share_pct"),
                      "total_population", "foreign_population", "foreign_population_pct", "rate_total", "rate_f")


@query("mdl_elections_stg", covers=("MDL-06", "AGG-7", "JN-9", "FN-3"), sql=f"""{G_SQL},{ELECTIONS_SQL}
SELECT year, party_name, CAST(total_seats AS BIGINT) AS total_seats FROM stg
""")
def mdl_elections_stg(spark, sf_dir):
    base = _elections_base(_month_base(_g(cat(spark, sf_dir)))).withColumn("month_num", L.month_number("month"))
    return R.latest_snapshot(base, ["year"], "month_num").select(
        "year", "party_name", F.col("seats").cast("long").alias("total_seats"))


# --------------------------------------------------------------------------- MDL-23 labour

_SPANISH_NATIONS = [f"NATION_{i}" for i in range(13)]
_HOME = "n_name IN (" + ", ".join(f"'{n}'" for n in _SPANISH_NATIONS) + ")"
_RATE = {"activity_rate": "o_orderpriority IN ('1-URGENT', '2-HIGH')", "employment_rate": "o_orderpriority = '3-MEDIUM'",
         "unemployment_rate": "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"}
_ABROAD = "r_name IN ('ASIA', 'AFRICA')"
_STATE = {"employed": "o_orderstatus = 'F'", "unemployed": "o_orderstatus = 'O'", "inactive": "o_orderstatus = 'P'", "total": "true"}


def _mean_of(cond):
    return sql_fixed(f"SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER ({cond}) "
                     f"/ CAST(NULLIF(COUNT(o_totalprice) FILTER ({cond}), 0) AS DOUBLE) / 1000.0", 1)


def _labour_sql():
    """Every measure is a conditional aggregate of one pass by year; the two groups are two sides of a row.
    Rates: Europa, first half-year, by priority and home nations.  Volumes: the home side is everybody less the
    Asian and African regions.  Sector mix: by region."""
    base = "province_std = 'Europa' AND mon <= 6"
    cols, sides = [], {"Spanish": [], "Foreign": []}
    for name, cond in _RATE.items():
        for side, who in (("Spanish", _HOME), ("Foreign", f"NOT {_HOME}")):
            cols.append(f"{_mean_of(f'{base} AND {cond} AND {who}')} AS {name}_{side}")
        cols.append(f"COUNT(*) FILTER ({base} AND {cond}) AS rows_{name}")
    for name, cond in _STATE.items():
        cols.append(f"CASE WHEN COUNT(*) FILTER ({_ABROAD}) > 0 THEN COUNT(*) FILTER ({cond}) - COUNT(*) FILTER ({cond} AND {_ABROAD}) END AS {name}_Spanish")
        cols.append(f"CASE WHEN COUNT(*) FILTER ({_ABROAD}) > 0 THEN COUNT(*) FILTER ({cond} AND {_ABROAD}) END AS {name}_Foreign")
    for name, sector in (("pct_urgent", "1-URGENT"), ("pct_low", "5-LOW")):
        for side, who in (("Spanish", "r_name = 'EUROPE'"), ("Foreign", _ABROAD)):
            part = sql_pct(f"NULLIF(COUNT(*) FILTER ({who} AND o_orderpriority = '{sector}'), 0)", f"COUNT(*) FILTER ({who})")
            cols.append(f"{part} AS {name}_{side}")
    cols.append(f"""{sql_fixed("MAX(o_totalprice) FILTER (o_orderstatus = 'F')", 2)} AS max_price_f""")
    for side in sides:
        sides[side] = ", ".join(f"{n}_{side} AS {n}" for n in (*_RATE, *_STATE, "pct_urgent", "pct_low"))
    seen = " AND ".join(f"rows_{n} > 0" for n in _RATE)
    both = " UNION ALL ".join(f"SELECT year, '{side}' AS nationality, {c}, max_price_f FROM y WHERE {seen}" for side, c in sides.items())
    out = ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in _STATE)
    return f"""{G_SQL}, y AS (SELECT yr AS year, {', '.join(cols)} FROM g GROUP BY yr)
SELECT year, nationality, activity_rate, employment_rate, unemployment_rate, {out},
       {sql_pct('inactive', 'total')} AS inactive_share_pct, {sql_pct('unemployed', 'total')} AS unemployed_share_pct,
       pct_urgent, pct_low, max_price_f FROM ({both})"""


LABOUR_SQL = _labour_sql()


@query("mdl_labour", covers=("MDL-23", "MDL-01", "MDL-02", "MDL-03", "MDL-08", "MDL-13", "MDL-07", "JN-3", "SET-1",
                             "TS-4", "AGG-5", "AGG-8", "AGG-9", "JN-4", "FN-13"), sql=LABOUR_SQL)
def mdl_labour(spark, sf_dir):
    c = cat(spark, sf_dir)
    g = _g(c)
    keys = ["year", "province_std"]
    # one pass over the orders star at the grain every branch needs, written once
    lb = materialize(g.groupBy(F.col("yr").alias("year"), (F.col("mon") <= 6).alias("h1"), "province_std", "r_name",
                               "n_name", "o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(N.money("o_totalprice")).alias("rev"),
        F.count("o_totalprice").alias("n_priced"), F.max("o_totalprice").alias("max_price")), "labour_base")
    # --- rates: conditional-avg pivot per rate type (replaces three views + three-way join)
    src = lb.where(F.col("h1")).select(   # quarter = 'Annual average'
        L.bucket("o_orderpriority", [("Activity rate", ["1-URGENT", "2-HIGH"]), ("Employment rate", ["3-MEDIUM"])],
                 "Unemployment rate").alias("rate_type"), "province_std", "year",
        F.when(F.col("n_name").isin(_SPANISH_NATIONS), "Spanish nationality").otherwise("Foreign nationality")
        .alias("nationality"), "rev", "n_priced")
    nat = F.col("nationality")
    stg = src.groupBy("rate_type", *keys).agg(
        F.sum(F.when(nat == "Spanish nationality", F.col("rev"))).alias("ss"),
        F.sum(F.when(nat == "Spanish nationality", F.col("n_priced"))).alias("sn"),
        F.sum(F.when(nat == "Foreign nationality", F.col("rev"))).alias("fs"),
        F.sum(F.when(nat == "Foreign nationality", F.col("n_priced"))).alias("fn"))
    stg = stg.select("rate_type", *keys,
                     N.fixed(N.exact_mean("ss", F.nullif("sn", F.lit(0))) / 1000.0, 1).alias("spanish_nationality"),
                     N.fixed(N.exact_mean("fs", F.nullif("fn", F.lit(0))) / 1000.0, 1).alias("foreign_nationality"))

    def rate(name, alias):
        return stg.where(F.col("rate_type") == name).select(
            *keys, F.col("spanish_nationality").alias(f"{alias}_s"), F.col("foreign_nationality").alias(f"{alias}_f"))
    j = rate("Activity rate", "a").join(rate("Unemployment rate", "u"), on=keys).join(
        rate("Employment rate", "e"), on=keys).where(F.col("province_std") == "Europa")
    rates = R.union_all([
        j.select("year", F.lit("Spanish").alias("nationality"), F.col("a_s").alias("activity_rate"),
                 F.col("u_s").alias("unemployment_rate"), F.col("e_s").alias("employment_rate")),
        j.select("year", F.lit("Foreign").alias("nationality"), F.col("a_f").alias("activity_rate"),
                 F.col("u_f").alias("unemployment_rate"), F.col("e_f").alias("employment_rate"))])
    # --- volumes: Foreign = sum of leaf nationalities, Spanish = Total - Foreign (TS-4 residual)
    st = F.col("o_orderstatus")
    leaf = lb.where(F.col("r_name").isin("ASIA", "AFRICA")).withColumn("cat", F.lit("Foreign"))
    tot = lb.withColumn("cat", F.lit("Total"))
    vsrc = R.union_all([leaf, tot]).select(
        "year", "cat", *[F.when(st == s_, F.col("n")).otherwise(F.lit(0)).cast("long").alias(m)
                         for s_, m in [("F", "employed"), ("O", "unemployed"), ("P", "inactive")]],
        F.col("n").cast("long").alias("total"))
    measures = ["employed", "unemployed", "inactive", "total"]
    volumes = S.residual(vsrc, ["year"], "cat", measures, "Total", ["Foreign"], "Foreign", "Spanish") \
        .withColumnRenamed("cat", "nationality")
    # --- sector mix: ratio of two conditional aggregates
    sec = R.union_all([lb.select("year", F.col("o_orderpriority").alias("sector"), "r_name", "n"),
                       lb.select("year", F.lit("Total").alias("sector"), "r_name", "n")])
    sec = sec.withColumn("nationality", L.bucket("r_name", [("Spanish", ["EUROPE"]), ("Foreign", ["ASIA", "AFRICA"])],
                                                  "Other"))
    sec = sec.groupBy("year", "sector", "nationality").agg(F.sum("n").alias("employed"))
    mix = R.conditional_pivot(sec.where(F.col("nationality").isin("Spanish", "Foreign")), ["year", "nationality"],
                              "sector", "employed", {"u": "1-URGENT", "l": "5-LOW", "t": "Total"}, agg="max")
    mix = mix.select("year", "nationality", N.pct("u", "t").alias("pct_urgent"), N.pct("l", "t").alias("pct_low"))
    earn = lb.groupBy("year").agg(N.fixed(F.max(F.when(st == "F", F.col("max_price"))), 2).alias("max_price_f"))
    out = R.left_enrich(rates, (volumes, ["year", "nationality"]), (mix, ["year", "nationality"]), (earn, ["year"]))
    return out.select("year", "nationality", "activity_rate", "employment_rate", "unemployment_rate",
                      *[F.col(m).cast("long").alias(m) for m in measures],
                      N.pct("inactive", "total").alias("inactive_share_pct"),
                      N.pct("unemployed", "total").alias("unemployed_share_pct"), "pct_urgent", "pct_low", "max_price_f")
