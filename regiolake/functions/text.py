"""Text Column builders: whitespace, case, accents, prefixes, splits, JSON access."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import _c, ColumnOrName

# Accented letters and their unaccented forms used for key folding.
ACCENTED = "áéíóúàèìòùäëïöüâêîôûñç"
UNACCENTED = "aeiouaeiouaeiouaeiounc"


def strip_ws(x: ColumnOrName) -> Column:
    """FN-12 / T8: strip all Unicode whitespace at both ends (Python ``str.strip``)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def upper_trim(x: ColumnOrName) -> Column:
    """FN-12: ``UPPER(TRIM(x))``."""
    return F.upper(F.trim(_c(x)))


def title_case(x: ColumnOrName) -> Column:
    """FN-12 / T9: Python ``str.title()``: a letter is upper-cased when the previous
    character is not a letter, lower-cased otherwise (``araba/álava`` -> ``Araba/Álava``).

    Built from ``transform`` over the character array, so it stays JVM-side.
    """
    chars = F.split(_c(x), "")
    return F.array_join(
        F.transform(chars, lambda ch, i: F.when(
            (i == 0) | ~F.element_at(chars, i).rlike(r"^\p{L}$"), F.upper(ch)).otherwise(F.lower(ch))),
        "")


def fold_accents(x: ColumnOrName) -> Column:
    """FN-18: lower-case and remove the accents of Spanish letters."""
    return F.translate(F.lower(_c(x)), ACCENTED, UNACCENTED)


def norm_key(x: ColumnOrName) -> Column:
    """FN-18: metadata-variable key: lower, blanks to ``_``, accents folded."""
    return F.translate(F.regexp_replace(F.lower(F.trim(_c(x))), r"\s", "_"), ACCENTED, UNACCENTED)


def strip_numeric_prefix(x: ColumnOrName) -> Column:
    """FN-14: drop a hierarchical code prefix such as ``1.-`` or ``1.01.-`` and the blanks after it."""
    return F.trim(F.regexp_replace(_c(x), r"^\d+(\.\d+)?\.-\s*", ""))


def is_header_code(x: ColumnOrName) -> Column:
    """WIN-4 helper: a top-level hierarchical header (``1.- Europa``), not a child (``1.01.- Francia``)."""
    return _c(x).rlike(r"^\d+\.-")


def before_first(x: ColumnOrName, delim: str = ".") -> Column:
    """FN-17: text before the first delimiter (the whole text when absent)."""
    return F.trim(F.substring_index(_c(x), delim, 1))


def after_first(x: ColumnOrName, delim: str = ". ") -> Column:
    """FN-17: text after the first occurrence of ``delim``; NULL when absent."""
    c = _c(x)
    return F.when(F.instr(c, delim) > 0,
                  F.trim(F.regexp_extract(c, r"(?s)^.*?" + _re_escape(delim) + r"(.*)$", 1)))


def split_last(x: ColumnOrName, delim: str = "_") -> tuple[Column, Column]:
    """FN-17 / RSH-2: split on the last delimiter -> (head, tail); no delimiter -> (x, NULL)."""
    c = _c(x)
    has = F.instr(c, delim) > 0
    head = F.when(has, F.regexp_extract(c, r"^(.*)" + _re_escape(delim) + r"[^" + _re_escape(delim) + r"]*$", 1)).otherwise(c)
    tail = F.when(has, F.substring_index(c, delim, -1))
    return head, tail


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def month_year_of_header(x: ColumnOrName) -> tuple[Column, Column]:
    """FN-16 / RSH-4: ``'mayo 1990'`` -> (``'mayo'``, ``'1990'``); no 4-digit year -> ('', '') (N13)."""
    c = F.trim(_c(x))
    pat = r"(\D+)\s*(\d{4})"
    return F.trim(F.regexp_extract(c, pat, 1)), F.regexp_extract(c, pat, 2)


def years_in(x: ColumnOrName) -> Column:
    """FN-16: all 4-digit years in a text as an array of int (e.g. a sheet name)."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(r"(\d{4})"), 1), lambda s: s.cast("int"))


def json_get(x: ColumnOrName, path: str, default=None, cast: str | None = None) -> Column:
    """FN-21: ``d.get(k, default)`` on a JSON text column."""
    v = F.get_json_object(_c(x), path)
    if cast:
        v = v.try_cast(cast)
    return v if default is None else F.coalesce(v, F.lit(default))
