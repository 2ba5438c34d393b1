"""Line-first quality rules [native].

Each line of a text is judged by itself and failing lines are removed; then a document that lost too much
of its text is rejected, beside the document's own base rules.

Line rules (blank lines are neither judged nor counted):
* punctuation: no sentence mark (. ! ? : ;) at the end of a word or of the line, or more than
  ``max_marks`` % of the line's characters are symbols or exclamation marks;
* navigation: two or more menu separators that make up at least ``nav_percent`` % of the characters;
* boilerplate: a licence, copyright, cookie or log-in phrase at the start of a word.

All measures are expressions over the text inside one row: no shuffle, no Python, and a document of any
length is judged whole.  Characters are code points; a document's lost share counts those outside white
space.

Defined results: a null text counts as empty; a text without words fails the base rule (too few words)
and has no lines to remove; repeated rows are judged alike; an empty table gives an empty result.  Input
columns named like an output column are replaced.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, others, text_or_empty

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = SYMBOLS + "!"
SEPARATORS = "|»›•·"
SENTENCE_MARK = r"[.!?:;][\x22')\]]*([\x20\x09-\x0D]|\z)"
WORD = r"[^\x20\x09-\x0D]"
BOILERPLATE = (r"(?i)(\A|[^a-z])(all rights reserved|copyright|licensed under|released under|is licensed under|terms of (use|service)"
               r"|privacy policy|cookie policy|accept cookies|sign in|log in|enable javascript)")
OUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bad_lines", "lost_chars",
       "clean_text", "base_failed", "kept")
_T = ("_q_text", "_q_words", "_q_lines", "_q_grams", "_q_bad", "_q_sorted", "_q_at")


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def _visible(c: Column) -> Column:
    return F.length(F.translate(c, BLANKS, ""))


def bad_line(line: Column, max_marks: int = 10, nav_percent: int = 4) -> Column:
    # a cheap search comes before each count, as most lines of prose have neither marks nor separators
    chars = F.length(line)
    marks = F.rlike(line, F.lit(f"[{MARKS}]")) & (F.lit(100) * _count(line, MARKS) > F.lit(max_marks) * chars)
    nav = (F.rlike(line, F.lit(f"[{SEPARATORS}].*[{SEPARATORS}]"))
           & (F.lit(100) * _count(line, SEPARATORS) >= F.lit(nav_percent) * chars))
    return ~F.rlike(line, F.lit(SENTENCE_MARK)) | marks | nav | F.rlike(line, F.lit(BOILERPLATE))


def measure(docs: DataFrame, max_marks: int = 10, nav_percent: int = 4) -> DataFrame:
    """``docs`` with the base measures and the outcome of the line rules."""
    df = docs.select(*[col(c) for c in others(docs, (*OUT, *_T))], text_or_empty(col("text")).alias("_q_text"))
    # each step is a projection of its own, as the next one looks its arrays up element by element
    df = df.select("*", F.array_remove(F.split("_q_text", r"[\x20\x09-\x0D]+"), "").alias("_q_words"),
                   F.filter(F.split("_q_text", "\n"), lambda x: F.rlike(x, F.lit(WORD))).alias("_q_lines"))
    words, n = F.col("_q_words"), F.size("_q_words")
    df = df.select(
        "*", n.cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.when(F.rlike("_q_text", F.lit(f"[{SYMBOLS}]")), _count(F.col("_q_text"), SYMBOLS)).otherwise(0)
        .cast("long").alias("n_symbols"), F.size("_q_lines").cast("long").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
            F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).alias("_q_grams"),
        F.filter("_q_lines", lambda x: bad_line(x, max_marks, nav_percent)).alias("_q_bad"))
    # 3-word windows found twice or more: equal neighbours after sorting; most texts have none
    g = F.col("_q_grams")
    df = df.withColumn("_q_sorted", F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(
        F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_q_sorted")
    twice = F.filter(
        F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k + 1)["h"]) | (x["h"] == F.get(s, k - 1)["h"])
                                           .eqNullSafe(True), x["i"])), lambda i: i.isNotNull())
    df = df.withColumn("_q_at", F.sort_array(twice))
    at = F.col("_q_at")
    covered = F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    lost = _visible(F.array_join("_q_bad", ""))
    return df.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                     F.size("_q_bad").cast("long").alias("n_bad_lines"), lost.cast("long").alias("lost_chars"))


def clean(docs: DataFrame, min_words: int = 50, max_repeat: int = 50, max_lost: int = 40,
          max_marks: int = 10, nav_percent: int = 4, with_text: bool = True) -> DataFrame:
    """All documents with their measures, ``base_failed``, ``kept`` (the base rules hold and at most
    ``max_lost`` % of the characters are lost) and, if asked for, ``clean_text`` (without the failing lines)."""
    df = measure(docs, max_marks, nav_percent)
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat) * F.col("n_words"))
    lines = F.filter(F.split("_q_text", "\n"), lambda x: ~F.rlike(x, F.lit(WORD)) | ~bad_line(x, max_marks, nav_percent))
    kept = ~failed & (F.lit(100) * F.col("lost_chars") <= F.lit(max_lost) * F.col("word_chars"))
    made = [*[F.col(c) for c in OUT if c not in ("clean_text", "base_failed", "kept")],
            failed.alias("base_failed"), kept.alias("kept")]
    if with_text:
        made.append(F.array_join(lines, "\n").alias("clean_text"))
    # a generator, so that a filter on the results isn't pushed below the steps above, where it would
    # evaluate whole arrays again for each of their elements
    return df.select(*[col(c) for c in others(docs, (*OUT, *_T))], F.inline(F.array(F.struct(*made))))
