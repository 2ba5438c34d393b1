"""Label standardisation: ordered rule ladders, buckets, month names.

A rule list is turned into one ``CASE WHEN`` chain; the first matching rule
wins (this also fixes the re-replacement problem of dict-of-regex rewrites).
Case-insensitive regex matching uses ``(?iu)`` because Spark's ``(?i)`` alone
is ASCII-only.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c, ColumnOrName

# A rule is (kind, pattern, label).  kind in:
#   "eq"        value == pattern
#   "in"        value in pattern (a sequence)
#   "prefix"    lower(value) LIKE lower(pattern) || '%'
#   "contains"  lower(value) contains lower(pattern)
#   "regex"     value rlike pattern (pattern given as is)
#   "iregex"    value rlike '(?iu)' || pattern
Rule = tuple[str, object, str]


def _match(c: Column, kind: str, pattern) -> Column:
    if kind == "eq":
        return c == F.lit(pattern)
    if kind == "in":
        return c.isin(list(pattern))
    if kind == "prefix":
        return F.lower(c).startswith(str(pattern).lower())
    if kind == "contains":
        return F.lower(c).contains(str(pattern).lower())
    if kind == "regex":
        return c.rlike(str(pattern))
    if kind == "iregex":
        return c.rlike("(?iu)" + str(pattern))
    raise ValueError(f"unknown rule kind {kind!r}")


def standardise(x: ColumnOrName, rules: Sequence[Rule], default=None) -> Column:
    """FN-1 / FN-13: ordered rule ladder -> label; ``default`` (NULL) when nothing matches."""
    c = _c(x)
    out = None
    for kind, pattern, label in rules:
        cond = _match(c, kind, pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def matches_any(x: ColumnOrName, rules: Iterable[tuple[str, object]]) -> Column:
    """FLT-4: OR of several (kind, pattern) tests, e.g. a prefix ladder used as a row filter."""
    c = _c(x)
    cond = None
    for kind, pattern in rules:
        m = _match(c, kind, pattern)
        cond = m if cond is None else (cond | m)
    return cond if cond is not None else F.lit(False)


def bucket(x: ColumnOrName, groups: Mapping[str, Iterable] | Sequence[tuple[str, Iterable]],
           default=None) -> Column:
    """FN-2: value -> bucket by membership, first group wins, else ``default``.

    ``groups`` maps bucket label -> member values (checked in order).
    NULL input falls to ``default`` (three-valued logic of CASE, T13).
    """
    c = _c(x)
    items = list(groups.items()) if isinstance(groups, Mapping) else list(groups)
    out = None
    for label, members in items:
        cond = c.isin(list(members))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def lookup(x: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """JN-11 as an expression: small fixed dictionary via a literal map; missing -> default."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    hit = F.try_element_at(m, _c(x))
    return hit if default is None else F.coalesce(hit, F.lit(default))


# Spanish month spellings seen in parliament composition headers,
# mapped to month numbers; anything else gets the default (6).
MONTHS_ES = {
    "enero": 1, "ene.": 1,
    "feb.": 2, "febr.": 2,
    "marzo": 3,
    "abril": 4,
    "mayo": 5,
    "junio": 6,
    "julio": 7,
    "sept.": 9,
    "oct.": 10,
    "nov.": 11,
    "dic.": 12,
}


def month_number(x: ColumnOrName, mapping: Mapping[str, int] = MONTHS_ES, default: int = 6) -> Column:
    """FN-3: month name -> number on ``lower(trim(x))``, ``default`` when unknown (N14)."""
    key = F.lower(F.trim(_c(x)))
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(m, key), F.lit(default)).cast("int")


def first_match_rewrite(x: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """FN-15: ordered regex alias table; the first rule whose pattern matches rewrites, others are skipped (N8)."""
    c = _c(x)
    out = None
    for pattern, replacement in rules:
        cond = c.rlike(pattern)
        rep = F.regexp_replace(c, pattern, replacement)
        out = F.when(cond, rep) if out is None else out.when(cond, rep)
    return c if out is None else out.otherwise(c)
