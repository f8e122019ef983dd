"""Text cleaning expressions (all built-in, stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading or trailing runs of Unicode white space (the Java (?U) flag makes \s
# match no-break space, tabs, line breaks and the other White_Space characters);
# Spark's own trim() removes only the ASCII space.
_EDGE_WHITESPACE = r"(?U)^\s+|\s+$"


def strip_chars(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _EDGE_WHITESPACE, "")


def normalise_email(c: Column | str) -> Column:
    """Trimmed, lower-case e-mail address."""
    return F.lower(strip_chars(c))


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first || ' ' || last`` with SQL null propagation (not concat_ws)."""
    f = F.col(first) if isinstance(first, str) else first
    l = F.col(last) if isinstance(last, str) else last
    return F.concat(f, F.lit(" "), l)
