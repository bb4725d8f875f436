"""Column expressions (JVM-side built-ins only, no Python UDFs)."""

from .bands import fixed_band, grade, ordinal, profile_from_zone, upper_inclusive_zone
from .casts import nan_to_null, safe_double, safe_int
from .lookup import label_or_default, map_literal, translate
from .text import contains_any, keywords_pattern, null_if_blank, py_strip, py_title

__all__ = [
    "fixed_band", "grade", "ordinal", "profile_from_zone", "upper_inclusive_zone",
    "nan_to_null", "safe_double", "safe_int",
    "label_or_default", "map_literal", "translate",
    "contains_any", "keywords_pattern", "null_if_blank", "py_strip", "py_title",
]
