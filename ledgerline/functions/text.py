"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters of Python's str.strip() /
# str.isspace(), as a Java regex character class.
PY_WHITESPACE = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace as Python's ``str.strip()`` does
    (Spark's ``trim`` removes spaces only)."""
    return F.regexp_replace(c, f"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$", "")
