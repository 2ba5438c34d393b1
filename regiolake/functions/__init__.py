"""Column builders (FN-*): pure expressions over ``pyspark.sql.functions``."""
from .labels import (MONTHS_ES, bucket, first_match_rewrite, lookup, matches_any, month_number,  # noqa: F401
                     standardise)
from .numbers import (complement, exact_mean, first_truthy, fixed, gap, half_even, locale_number,  # noqa: F401
                      money, nan_to_null, over_representation, pct, rate_per, round_to_long, safe_double,
                      safe_int, safe_ratio)
from .text import (after_first, before_first, fold_accents, is_header_code, json_get, month_year_of_header,  # noqa: F401
                   norm_key, split_last, strip_numeric_prefix, strip_ws, title_case, upper_trim, years_in)
