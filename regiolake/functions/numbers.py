"""Numeric Column builders: safe casts, locale numbers, ratios, shares, rates.

All builders return plain ``Column`` expressions (whole-stage codegen, no
Python).  ANSI mode is on in Spark 4, so every cast that may fail is a
``try_cast`` and every division is a ``try_divide``.

Rounding: ``fixed(x, s)`` rounds half away from zero on the decimal value of
``x`` and returns a double.  Going through ``decimal(38,10)`` first removes
last-bit differences of the double, so the same input gives the same output
on any engine that rounds half-up on decimals.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x: ColumnOrName) -> Column:
    """NaN (and +-inf) become NULL, as ``pd.to_numeric(...).dropna()`` would drop them."""
    c = _c(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(c)


def safe_double(x: ColumnOrName) -> Column:
    """FN-5: any value to double, NULL when unparsable, NaN or infinite."""
    c = _c(x)
    s = F.trim(c.cast("string"))
    return nan_to_null(s.try_cast("double"))


def safe_int(x: ColumnOrName) -> Column:
    """FN-6: ``int(float(x))``: go through double, truncate toward zero (T10)."""
    d = safe_double(x)
    return d.try_cast("long")


def round_to_long(x: ColumnOrName) -> Column:
    """FN-6: ``CAST(ROUND(x) AS INT64)`` with half away from zero."""
    return F.round(_c(x).cast("decimal(38,10)"), 0).cast("long")


def locale_number(x: ColumnOrName, strict: bool = False) -> Column:
    """FN-4: parse a Spanish-locale number such as ``1.234,5``.

    Thousands dots are removed, the decimal comma becomes a dot, then the
    text is cast safely; ``..``, blanks and text become NULL.  With
    ``strict=True`` dots are only treated as thousands separators when they
    group digits in threes (so ``123.0`` stays 123.0 instead of 1230, N9).
    """
    s = F.trim(_c(x).cast("string"))
    loose = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
    if not strict:
        return safe_double(loose)
    grouped = s.rlike(r"^[-+]?\d{1,3}(\.\d{3})+(,\d+)?$")
    has_comma = s.contains(",")
    parsed = F.when(grouped | has_comma, loose).otherwise(s)
    return safe_double(parsed)


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """FN-7: ``SAFE_DIVIDE`` / ``x / NULLIF(y, 0)`` as double; NULL on zero or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def fixed(x: ColumnOrName, scale: int = 2) -> Column:
    """FN-20: round half away from zero to ``scale`` digits, returned as double."""
    return F.round(_c(x).cast("decimal(38,10)"), scale).cast("double")


def half_even(x: ColumnOrName, scale: int = 2) -> Column:
    """FN-20: banker's rounding (pandas ``.round`` on exact decimals)."""
    return F.bround(_c(x).cast("decimal(38,10)"), scale).cast("double")


def pct(num: ColumnOrName, den: ColumnOrName, scale: int | None = 2) -> Column:
    """FN-8: percent share ``num / den * 100``, rounded; NULL when den is 0/NULL."""
    r = safe_ratio(num, den) * F.lit(100.0)
    return r if scale is None else fixed(r, scale)


def rate_per(num: ColumnOrName, den: ColumnOrName, per: float = 100000.0, scale: int | None = 2) -> Column:
    """FN-9: events per ``per`` inhabitants."""
    r = safe_ratio(num, den) * F.lit(float(per))
    return r if scale is None else fixed(r, scale)


def over_representation(part_events: ColumnOrName, total_events: ColumnOrName,
                        part_pop: ColumnOrName, total_pop: ColumnOrName,
                        scale: int | None = 2) -> Column:
    """FN-10: (share of events) / (share of population); NULL if any share is undefined or 0."""
    r = F.try_divide(safe_ratio(part_events, total_events), safe_ratio(part_pop, total_pop))
    return r if scale is None else fixed(r, scale)


def gap(a: ColumnOrName, b: ColumnOrName, scale: int | None = None) -> Column:
    """FN-11: difference in points (NULL propagates)."""
    r = _c(a) - _c(b)
    return r if scale is None else fixed(r, scale)


def complement(total: ColumnOrName, part: ColumnOrName) -> Column:
    """FN-11: rest = total - part."""
    return _c(total) - _c(part)


def money(x: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal for summing currency held as double."""
    return _c(x).cast(f"decimal({precision},{scale})")


def exact_mean(sum_col: ColumnOrName, count_col: ColumnOrName) -> Column:
    """Mean from an exact (decimal) sum and a count: one IEEE division, reproducible anywhere."""
    return F.try_divide(_c(sum_col).cast("double"), _c(count_col).cast("double"))


def first_truthy(*cols: ColumnOrName) -> Column:
    """FN-19: first of several values that is neither NULL nor empty text."""
    return F.coalesce(*[F.nullif(_c(c).cast("string"), F.lit("")) for c in cols])


def year_between(ts: ColumnOrName, first: int | None = None, last: int | None = None) -> Column:
    """``first <= year(ts) <= last`` written as a timestamp range, so Parquet can use it for
    row-group pruning (a predicate on ``year(ts)`` cannot be pushed to the scan)."""
    c = _c(ts)
    cond = F.lit(True)
    if first is not None:
        cond = cond & (c >= F.make_timestamp_ntz(F.lit(first), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    if last is not None:
        cond = cond & (c < F.make_timestamp_ntz(F.lit(last + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    return cond
