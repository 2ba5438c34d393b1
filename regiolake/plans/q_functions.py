"""Registered queries for the scalar functions (FN-*) on part, orders, events, documents.

Text functions run over whole documents (no prefixes); results are compared
through hashes of the full transformed text."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import numbers as N
from ..functions import text as X
from ..operators import relational as R
from .common import cat, nation_region
from .registry import query, sql_money_sum

# Part-type label ladder used by the query (prefix, contains, case-insensitive regex).
PART_RULES = [("prefix", "eco", "Economy"), ("iregex", "^sma", "Small"), ("contains", "arg", "Large"),
              ("in", ["STANDARD", "PROMO"], "Mainline")]


@query("fn_std_label", covers=("FN-1", "FN-13", "FN-2"), sql="""
SELECT CASE WHEN lower(p_type) LIKE 'eco%' THEN 'Economy'
            WHEN regexp_matches(p_type, '(?i)^sma') THEN 'Small'
            WHEN lower(p_type) LIKE '%arg%' THEN 'Large'
            WHEN p_type IN ('STANDARD', 'PROMO') THEN 'Mainline' END AS label,
       CASE WHEN p_size IN (1, 2, 3, 4, 5) THEN 'tiny' WHEN p_size IN (6, 7, 8, 9, 10) THEN 'small' ELSE 'other' END AS size_bucket,
       CAST(COUNT(*) AS BIGINT) AS n
FROM part GROUP BY 1, 2
""")
def fn_std_label(spark, sf_dir):
    p = cat(spark, sf_dir)["part"]
    return p.groupBy(L.standardise("p_type", PART_RULES).alias("label"),
                     L.bucket("p_size", [("tiny", range(1, 6)), ("small", range(6, 11))], "other").alias("size_bucket")
                     ).agg(F.count(F.lit(1)).alias("n"))


_LOOSE_SQL = "TRY_CAST(replace(replace(trim(s), '.', ''), ',', '.') AS DOUBLE)"


@query("fn_locale_number", covers=("FN-4", "FN-5"), sql=f"""
WITH t AS (SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS s FROM part)
SELECT p_partkey, {_LOOSE_SQL} AS loose,
       CASE WHEN regexp_matches(trim(s), '^[-+]?\\d{{1,3}}(\\.\\d{{3}})+(,\\d+)?$') OR contains(trim(s), ',')
            THEN {_LOOSE_SQL} ELSE TRY_CAST(trim(s) AS DOUBLE) END AS strict
FROM t
""")
def fn_locale_number(spark, sf_dir):
    p = cat(spark, sf_dir)["part"].select("p_partkey", F.col("p_retailprice").cast("string").alias("s"))
    # '900.1' read as Spanish locale: loose parsing strips the dot (N9), strict keeps it
    return p.select("p_partkey", N.locale_number("s").alias("loose"), N.locale_number("s", strict=True).alias("strict"))


@query("fn_locale_roundtrip", covers=("FN-4",), sql=f"""
SELECT o_orderpriority AS category, {sql_money_sum('o_totalprice')} AS total FROM orders GROUP BY 1
""")
def fn_locale_roundtrip(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    txt = F.translate(F.format_number("o_totalprice", 2), ",.", ".,")   # e.g. 1.234.567,89
    v = N.locale_number(txt, strict=True)
    return o.groupBy(F.col("o_orderpriority").alias("category")).agg(F.sum(N.money(v)).cast("double").alias("total"))


@query("fn_safe_cast", covers=("FN-5", "FN-6", "FN-21"), sql="""
SELECT event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       CAST(trunc(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS BIGINT) AS value_int,
       TRY_CAST(event_type AS DOUBLE) AS not_a_number,
       CAST(ROUND(CAST(value AS DECIMAL(38,10)), 0) AS BIGINT) AS value_round
FROM events
""")
def fn_safe_cast(spark, sf_dir):
    ev = cat(spark, sf_dir)["events"]
    return ev.select("event_id", N.safe_double(X.json_get("props", "$.k")).alias("k"),
                     N.safe_int(F.col("value").cast("string")).alias("value_int"),
                     N.safe_double("event_type").alias("not_a_number"),
                     N.round_to_long("value").alias("value_round"))


@query("fn_round_modes", covers=("FN-20",), sql="""
SELECT o_orderkey,
       CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) / 4, 1) AS DOUBLE) AS half_up,
       CAST(round_even(CAST(CAST(o_totalprice AS DECIMAL(18,2)) / 4 AS DECIMAL(38,10)), 1) AS DOUBLE) AS half_even
FROM orders
""")
def fn_round_modes(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    q = N.money("o_totalprice") / 4
    return o.select("o_orderkey", N.fixed(q, 1).alias("half_up"), N.half_even(q, 1).alias("half_even"))


# Java (?U)\s is Unicode White_Space; RE2 needs the same set spelled out
_WS_SQL = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("fn_text_norm", covers=("FN-12", "FN-18"), sql=f"""
SELECT doc_id,
       md5(translate(lower(text), '{X.ACCENTED}', '{X.UNACCENTED}')) AS folded_md5,
       CAST(length(regexp_replace(regexp_replace(text, '^{_WS_SQL}+', ''), '{_WS_SQL}+$', '')) AS BIGINT) AS stripped_len,
       md5(lower(trim(text, ' '))) AS lower_md5
FROM documents
""")
def fn_text_norm(spark, sf_dir):
    d = cat(spark, sf_dir)["documents"]
    return d.select("doc_id", F.md5(X.fold_accents("text")).alias("folded_md5"),
                    F.length(X.strip_ws("text")).cast("long").alias("stripped_len"),
                    F.md5(F.lower(F.trim("text"))).alias("lower_md5"))


@query("fn_regex_extract", covers=("FN-16",), sql="""
SELECT doc_id, regexp_extract(text, '(\\d{4})', 1) AS first_4digits,
       CAST(len(regexp_extract_all(text, '\\d+')) AS INTEGER) AS n_numbers,
       CAST(len(regexp_extract_all(text, '[A-Z][a-z]+')) AS INTEGER) AS n_capitalised
FROM documents
""")
def fn_regex_extract(spark, sf_dir):
    d = cat(spark, sf_dir)["documents"]
    return d.select("doc_id", F.regexp_extract("text", r"(\d{4})", 1).alias("first_4digits"),
                    F.size(F.regexp_extract_all("text", F.lit(r"\d+"), 0)).alias("n_numbers"),
                    F.size(F.regexp_extract_all("text", F.lit(r"[A-Z][a-z]+"), 0)).alias("n_capitalised"))


# Ordered alias rewrites; the first matching rule rewrites, the rest are skipped.
ALIAS_RULES = [(r"^red ", "crimson "), (r"widget", "gadget"), (r"ring$", "band")]


@query("fn_alias_rules", covers=("FN-15",), sql="""
SELECT CASE WHEN regexp_matches(p_name, '^red ') THEN regexp_replace(p_name, '^red ', 'crimson ', 'g')
            WHEN regexp_matches(p_name, 'widget') THEN regexp_replace(p_name, 'widget', 'gadget', 'g')
            WHEN regexp_matches(p_name, 'ring$') THEN regexp_replace(p_name, 'ring$', 'band', 'g')
            ELSE p_name END AS alias, CAST(COUNT(*) AS BIGINT) AS n
FROM part GROUP BY 1
""")
def fn_alias_rules(spark, sf_dir):
    p = cat(spark, sf_dir)["part"]
    return p.groupBy(L.first_match_rewrite("p_name", ALIAS_RULES).alias("alias")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_strip_prefix", covers=("FN-14", "WIN-4", "JOB-08"), sql="""
SELECT n.n_name AS label, r.r_name AS parent
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def fn_strip_prefix(spark, sf_dir):
    """Hierarchical label list (``2.- ASIA`` then ``2.08.- NATION_8`` ...) in document order:
    the numeric prefix is stripped, headers set the parent of the rows that follow."""
    c = cat(spark, sf_dir)
    reg = c["region"].select(F.col("r_regionkey").alias("k"), F.lit(-1).alias("sub"),
                             F.concat(F.col("r_regionkey").cast("string"), F.lit(".- "), F.col("r_name")).alias("raw"))
    nat = c["nation"].select(F.col("n_regionkey").alias("k"), F.col("n_nationkey").alias("sub"),
                             F.concat(F.col("n_regionkey").cast("string"), F.lit("."),
                                      F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(".- "),
                                      F.col("n_name")).alias("raw"))
    doc = R.union_all([reg, nat]).withColumn("doc", F.lit("labels")).withColumn(
        "line_no", (F.col("k") * 1000 + F.col("sub") + 1).cast("long"))
    out = R.carry_down(doc, ["doc"], "line_no", X.is_header_code("raw") & ~F.col("raw").rlike(r"^\d+\.\d+\.-"),
                       X.strip_numeric_prefix("raw"), name="parent", block=1000)
    return out.select(X.strip_numeric_prefix("raw").alias("label"), "parent")


@query("fn_ratio_share", covers=("FN-7", "FN-8", "FN-9", "FN-10", "FN-11", "FN-19"), sql="""
WITH a AS (SELECT c_mktsegment AS seg, COUNT(*) FILTER (WHERE c_acctbal < 0) AS neg, COUNT(*) AS tot,
                  COUNT(*) FILTER (WHERE c_nationkey < 5) AS part_tot,
                  COUNT(*) FILTER (WHERE c_nationkey < 5 AND c_acctbal < 0) AS part_neg
           FROM customer GROUP BY 1)
SELECT seg, CAST(neg AS BIGINT) AS neg, CAST(tot - neg AS BIGINT) AS non_neg,
       CAST(ROUND(CAST((CAST(neg AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0)) * 100.0 AS DECIMAL(38,10)), 2) AS DOUBLE) AS neg_pct,
       CAST(ROUND(CAST((CAST(neg AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0)) * 100000.0 AS DECIMAL(38,10)), 2) AS DOUBLE) AS neg_per_100k,
       CAST(ROUND(CAST((CAST(part_neg AS DOUBLE) / NULLIF(CAST(neg AS DOUBLE), 0)) / NULLIF(CAST(part_tot AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0), 0) AS DECIMAL(38,10)), 2) AS DOUBLE) AS over_rep,
       CAST(ROUND(CAST((CAST(part_neg AS DOUBLE) / NULLIF(CAST(part_tot AS DOUBLE), 0)) * 100.0 - (CAST(neg AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0)) * 100.0 AS DECIMAL(38,10)), 1) AS DOUBLE) AS gap_pp
FROM a
""")
def fn_ratio_share(spark, sf_dir):
    cu = cat(spark, sf_dir)["customer"]
    a = cu.groupBy(F.col("c_mktsegment").alias("seg")).agg(
        F.count_if(F.col("c_acctbal") < 0).alias("neg"), F.count(F.lit(1)).alias("tot"),
        F.count_if(F.col("c_nationkey") < 5).alias("part_tot"),
        F.count_if((F.col("c_nationkey") < 5) & (F.col("c_acctbal") < 0)).alias("part_neg"))
    return a.select("seg", "neg", N.complement("tot", "neg").alias("non_neg"),
                    N.pct("neg", "tot").alias("neg_pct"), N.rate_per("neg", "tot").alias("neg_per_100k"),
                    N.over_representation("part_neg", "neg", "part_tot", "tot").alias("over_rep"),
                    N.gap(N.pct("part_neg", "part_tot", None), N.pct("neg", "tot", None), 1).alias("gap_pp"))


@query("fn_month_number", covers=("FN-3", "FN-12"), sql="""
WITH m AS (SELECT o_orderkey, list_extract(['Enero ',' feb.','MARZO','abril','mayo','junio','julio','agosto','sept.','oct.','nov.','Dic.'],
                                           CAST(month(o_orderdate) AS INTEGER)) AS month FROM orders)
SELECT month, CASE lower(trim(month)) WHEN 'enero' THEN 1 WHEN 'ene.' THEN 1 WHEN 'feb.' THEN 2 WHEN 'febr.' THEN 2
              WHEN 'marzo' THEN 3 WHEN 'abril' THEN 4 WHEN 'mayo' THEN 5 WHEN 'junio' THEN 6 WHEN 'julio' THEN 7
              WHEN 'sept.' THEN 9 WHEN 'oct.' THEN 10 WHEN 'nov.' THEN 11 WHEN 'dic.' THEN 12 ELSE 6 END AS month_num,
       CAST(COUNT(*) AS BIGINT) AS n
FROM m GROUP BY 1, 2
""")
def fn_month_number(spark, sf_dir):
    o = cat(spark, sf_dir)["orders"]
    names = F.array(*[F.lit(m) for m in ['Enero ', ' feb.', 'MARZO', 'abril', 'mayo', 'junio', 'julio', 'agosto',
                                         'sept.', 'oct.', 'nov.', 'Dic.']])
    m = o.select(F.element_at(names, F.month("o_orderdate")).alias("month"))
    return m.groupBy("month", L.month_number("month").alias("month_num")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_split_title", covers=("FN-17", "FN-12"), sql="""
WITH t AS (SELECT n_nationkey, r_name || '. ' || n_name || '. Base 2013.' AS title
           FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT n_nationkey, split_part(title, '.', 1) AS territory, substr(title, strpos(title, '. ') + 2) AS indicator,
       upper(trim(lower(title))) AS normalised
FROM t
""")
def fn_split_title(spark, sf_dir):
    nr = nation_region(cat(spark, sf_dir))
    t = nr.select("n_nationkey", F.concat(F.col("r_name"), F.lit(". "), F.col("n_name"), F.lit(". Base 2013.")).alias("title"))
    return t.select("n_nationkey", X.before_first("title", ".").alias("territory"),
                    X.after_first("title", ". ").alias("indicator"), X.upper_trim(F.lower("title")).alias("normalised"))
