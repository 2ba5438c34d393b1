"""The registered queries of the training-data operators: one ``opN_<name>`` each, over whole tables.

A query calls its operator with production parameters and derives the digest columns from the
operator's own output.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ball_tree, bit_codes, chat_format, decontamination, exact_dedup, jaccard_join, kd_sharding, line_rules, line_runs, mixing, secret_scan,
               sentence_spans, toxicity)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

KD_DIMS = {"lang": "category", "source": "category", "n_chars": "magnitude", "doc_id": "magnitude"}
NUM_SHARDS = 24


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_kd_sharding")
def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = kd_sharding.shard_documents(docs, KD_DIMS, num_shards=NUM_SHARDS, carry=False)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return (toxicity.classify(docs.select("doc_id", "text"), labels, keep=["doc_id"])
            .select("doc_id", "held_out", "score", "predicted"))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"

OP4_SQL = f"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, {SPACED}) AS w FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
cells AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.r AS x, b.r AS y FROM cells a JOIN cells b ON a.g = b.g AND a.r <> b.r
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT r AS x, r AS y FROM sets UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, CAST(any_value(len(s.s)) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
FROM reach JOIN sets s ON reach.x = s.r JOIN sets t ON reach.y = t.r GROUP BY s.r, s.doc_id
"""


@query("op4_jaccard_join", OP4_SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents"), n=5, percent=80)


PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, {PLAIN}) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, {PLAIN}) AS w FROM benchmark),
b2 AS (SELECT item, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM b2)),
dw AS (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b2) WHERE len(w) >= k)),
hits AS (SELECT r, i, dw.k AS k, item FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op7_decontamination", OP7_SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = decontamination.find_matches(docs.select("doc_id", "text"), benchmark, width=13, carry=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        decontamination.contaminated(5).alias("contaminated"))


BLANK_RE = r"[\x20\x09-\x0D]+"
VISIBLE = f"length(regexp_replace({{}}, '{BLANK_RE}', '', 'g'))"
BAD_LINE = rf"""(NOT regexp_matches(l, '[.!?:;][\x22'')\]]*([\x20\x09-\x0D]|\z)')
  OR 100 * (length(l) - length(translate(l, '#*$%&|<>!', ''))) > 10 * length(l)
  OR (length(l) - length(translate(l, '|»›•·', '')) >= 2
      AND 100 * (length(l) - length(translate(l, '|»›•·', ''))) >= 4 * length(l))
  OR regexp_matches(l, '{line_rules.BOILERPLATE}'))"""

OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, {SPACED})),
by_line AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines,
                   sum(CASE WHEN {BAD_LINE} THEN {VISIBLE.format('l')} ELSE 0 END) AS lost FROM lines GROUP BY r),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, i FROM grams JOIN (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST({VISIBLE.format('t')} AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(lost, 0) AS lost
      FROM d LEFT JOIN by_line USING (r) LEFT JOIN again USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 40 * word_chars AS kept
FROM f
"""


@query("op6_line_rules", OP6_SQL)
def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_rules.clean(read(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


@query("op8_sentence_spans")
def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.dedup_spans(read(spark, sf_dir, "documents"), span=2, min_chars=40)


@query("op9_line_runs")
def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.dedup_lines(read(spark, sf_dir, "documents"), gram=3, window=3)


# the template's marks around a text, and the characters that escaping adds to it
_CONTROLS = chat_format.INSTRUCT.controls()
_ADDED = " + ".join(f"2 * ((length(t) - length(replace(t, '{c}', ''))) // {len(c)})" for c in _CONTROLS)
_MARKS = " ".join(f"WHEN role = '{k}' THEN {len(r.before) + len(r.after)}" for k, r in chat_format.INSTRUCT.roles.items())

OP10_SQL = f"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(t) + length(t) - length(replace(t, chr(92), '')) + {_ADDED} + CASE {_MARKS} END) AS BIGINT)
         AS formatted_chars
FROM c GROUP BY conv_id
"""


@query("op10_chat_format", OP10_SQL)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                      "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return (chat_format.read_back(chat_format.format_chat(turns))
            .select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"))


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"), carry=["doc_id"])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("found", lambda x: x["kind"] != "novel")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"))


# domains of the mixture: the languages of labelled texts of good quality, and texts of low quality
MIX_TARGETS = {"en": 0.57, "de": 0.14, "fr": 0.135, "es": 0.08, "low": 0.075}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled rows: their language, or 'low' where the quality label is 0."""
    return (docs.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id")
            .select("doc_id", F.when(F.col("quality") == 0, "low").otherwise(F.col("lang")).alias("domain")))


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, labelled_domains(docs, read(spark, sf_dir, "labels")), MIX_TARGETS, carry=["doc_id"])
    return mixed.select("doc_id", "n_tokens", "domain", "posterior", "rate")


OP13_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (same ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op13_exact_dedup", OP13_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


TERMS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP11_SQL = f"""
WITH d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n
           FROM (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents) WHERE len(w) > 0),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
b AS (SELECT i, item_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS i, item_id, {TERMS} AS w FROM benchmark)),
q AS (SELECT i, item_id, term, count(*) AS times FROM b GROUP BY ALL),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals),
hits AS (SELECT i, item_id, r, doc_id, sum(times * wt.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS score
         FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN d USING (r), totals GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM hits WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
"""


@query("op11_ball_tree_search", OP11_SQL)
def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op12_bit_code_negatives", OP12_SQL)
def op12_bit_code_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, ((F.col("label") + 1) % 10).cast("int")).otherwise(F.col("label"))
    return bit_codes.mine(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)
