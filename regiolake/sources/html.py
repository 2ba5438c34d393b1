"""SRC-9: records out of HTML held in a column (a page table), as a Spark job.

Flat structures (list items, links, the table that follows an anchor text) are cut out with ``regexp_extract_all`` +
``posexplode``.  Nested tables are read as tokens (tags and texts with their place in the page): the depth is a running sum over the
table tags, rows and cells are running counts inside their own table.  All of it is built-in expressions.
"""
from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _dictionary(pairs: dict[str, str]) -> Column:
    """A map from text to text that the optimizer makes once from one string, not an expression for each entry."""
    return F.str_to_map(F.lit("\x1d".join(f"{k}\x1e{v}" for k, v in pairs.items())), F.lit("\x1d"), F.lit("\x1e"))


# numeric references that HTML reads in another way: 0 and the bytes of windows-1252
_READ_AS = {0: "\ufffd", 13: "\r", **{b: bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)}}
# nearly all references of a page are these: a map is searched entry by entry, so they are looked up first
_USUAL = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "copy;", "middot;")
_SHORTEST, _LONGEST = (f(len(k) for k in html5 if not k.endswith(";")) for f in (min, max))


def unescape(x: Column) -> Column:
    """All character references decoded in one pass, as HTML reads them: names with and (the old ones) without a semicolon,
    the longest first; numbers of no character give U+FFFD, those of control characters nothing."""
    names, usual = _dictionary(html5), _dictionary({k: html5[k] for k in _USUAL})
    numbers = _dictionary({str(k): v for k, v in _READ_AS.items()})

    def named(z: Column) -> Column:
        part, name = z["part"], z["name"]

        def cut(n: Column) -> Column:
            return F.concat(F.try_element_at(names, F.substr(name, F.lit(1), n)), F.substr(part, n + 1))
        shorter = [F.when(F.length(name) > n, cut(F.lit(n))) for n in range(_LONGEST, _SHORTEST - 1, -1)]
        common = F.concat(F.try_element_at(usual, name), F.substr(part, F.length(name) + 1))
        return F.coalesce(common, cut(F.length(name)), *shorter, F.concat(F.lit("&"), part))

    def numbered(z: Column) -> Column:
        digits = F.ltrim(F.regexp_extract(z["number"], "^#[xX]?([0-9a-fA-F]+)", 1), F.lit("0"))
        hexadecimal = F.rlike(z["number"], F.lit("^#[xX]"))
        n = F.when(F.length(digits) > 7, F.lit(0x110000)).when(digits == "", F.lit(0)).when(
            hexadecimal, F.conv(digits, 16, 10).cast("int")).otherwise(digits.cast("int"))
        char = F.transform(F.array(n), lambda k: F.coalesce(
            F.try_element_at(numbers, k.cast("string")),
            F.when((k > 0x10FFFF) | k.between(0xD800, 0xDFFF), "\ufffd")
            .when(k.between(1, 8) | k.between(14, 31) | (k == 11) | (k == 127) | k.between(0xFDD0, 0xFDEF)
                  | (k.bitwiseAND(0xFFFE) == 0xFFFE), "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(k), 8, "0")), "UTF-32"))))[0]
        return F.concat(char, F.substr(z["part"], F.length(z["number"]) + 1))

    parts = F.split(x, "&")
    told = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(
        p.alias("part"), F.regexp_extract(p, "^#([0-9]+|[xX][0-9a-fA-F]+);?", 0).alias("number"),
        F.regexp_extract(p, "^[^\t\n\f <&#;]{1,32};?", 0).alias("name")))
    tail = F.transform(told, lambda z: F.when(z["number"] != "", numbered(z)).when(z["name"] != "", named(z))
                       .otherwise(F.concat(F.lit("&"), z["part"])))
    return F.when(F.contains(x, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))).otherwise(x)


def cell_text(x: Column) -> Column:
    """Tags removed, character references decoded, blanks collapsed and trimmed."""
    return _tidy(F.regexp_replace(x, r"(?s)<[^>]*>", " "))


def list_items(df: DataFrame, html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Every ``<li>`` with its position in the page, its text and its first link."""
    items = F.regexp_extract_all(F.col(html_col), F.lit(r"(?s)<li[^>]*>(.*?)</li>"), 1)
    x = df.select(*keep, F.posexplode(items).alias("pos", "item"))
    return x.select(*keep, "pos", cell_text(F.col("item")).alias("text"),
                    F.nullif(F.regexp_extract("item", r'href="([^"]*)"', 1), F.lit("")).alias("href"))


def table_after_anchor(df: DataFrame, anchor: str, html_col: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """Cells ``(row_idx, col_idx, text)`` of the first ``<table>`` after the first occurrence
    of ``anchor`` in the page text (flat tables)."""
    h = F.col(html_col)
    pos = F.instr(h, anchor)
    tail = F.when(pos > 0, F.substr(h, pos))
    table = F.regexp_extract(tail, r"(?is)<table[^>]*>(.*?)</table>", 1)
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(table, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1))
                     .alias("row_idx", "tr"))
    cells = rows.select(*keep, "row_idx",
                        F.posexplode(F.regexp_extract_all("tr", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1))
                        .alias("col_idx", "td"))
    return cells.select(*keep, "row_idx", "col_idx", cell_text(F.col("td")).alias("text"))


_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
_TAG = r"</?[A-Za-z!?][^>]*>"                          # a "<" before anything else is text
_TOKEN = rf"(?s){_TAG}|[^<]+|<"


def nested_table_cells(df: DataFrame, id_col: str, html_col: str = "html") -> DataFrame:
    """Cells ``(id, table_idx, row_idx, col_idx, text)`` of all tables, nested tables included.

    Tables are numbered in the order of their start tags, from 0 in each page, rows and cells from 0 in their table and row.  A
    cell's text is the text between its start tag and its end tag (or the next cell, row or table end), without that of tables inside
    it.  An end tag without a table is passed over; texts outside of cells, comments, scripts and styles are left out; a null page
    has no cells.  The work of a page is one group, as a page is one value."""
    pages = df.select(id_col, F.regexp_replace(html_col, _HIDDEN, "").alias("__h")).where(F.contains("__h", F.lit("<")))
    pages = pages.withColumn("__page", F.monotonically_increasing_id())
    t = pages.select(id_col, "__page", F.posexplode(F.regexp_extract_all("__h", F.lit(_TOKEN), 0)).alias("__at", "__tok"))
    tag = F.lower(F.regexp_extract("__tok", r"^<(/?[A-Za-z]+)(?=[\s/>])", 1))
    t = t.withColumn("__tag", F.when(F.rlike("__tok", F.lit(f"(?s)^{_TAG}$")), tag).otherwise(F.lit("text")))
    t = t.where(F.col("__tag").isin("table", "/table", "tr", "td", "th", "/td", "/th", "text"))
    page = Window.partitionBy("__page").orderBy("__at")
    to_here = page.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("__tag") == "table", 1).when(F.col("__tag") == "/table", -1).otherwise(0)
    t = t.withColumn("__sum", F.sum(step).over(to_here))
    # an end tag without a table would make the sum negative: what it lacks so far is added back
    t = t.withColumn("__depth", F.col("__sum") - F.least(F.lit(0), F.min("__sum").over(to_here)))
    t = t.withColumn("__seq", F.count_if(F.col("__tag") == "table").over(to_here) - 1).where(F.col("__depth") > 0)
    level = Window.partitionBy("__page", "__depth").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("table_idx", F.last(F.when(F.col("__tag") == "table", F.col("__seq")), ignorenulls=True).over(level))
    table = Window.partitionBy("__page", "table_idx").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("row_idx", F.count_if(F.col("__tag") == "tr").over(table) - 1)
    row = Window.partitionBy("__page", "table_idx", "row_idx").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    begins = F.col("__tag").isin("td", "th")
    t = t.withColumn("col_idx", F.count_if(begins).over(row) - 1)
    cell = Window.partitionBy("__page", "table_idx", "row_idx", "col_idx").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    t = t.where(F.col("col_idx") >= 0).withColumn("__closed", F.count_if(F.col("__tag").isin("/td", "/th")).over(cell) > 0)
    text = F.when((F.col("__tag") == "text") & ~F.col("__closed"), F.struct("__at", "__tok"))
    out = t.groupBy("__page", id_col, "table_idx", "row_idx", "col_idx").agg(F.array_sort(F.collect_list(text)).alias("__texts"))
    return out.select(id_col, *[F.col(c).cast("int").alias(c) for c in ("table_idx", "row_idx", "col_idx")],
                      _tidy(F.array_join(F.transform("__texts", lambda z: z["__tok"]), "")).alias("text"))


def _tidy(text: Column) -> Column:
    """Character references decoded, blanks collapsed and trimmed."""
    return F.trim(F.regexp_replace(unescape(text), r"(?U)\s+", " "))
