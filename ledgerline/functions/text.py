"""Text cleaning column functions for the people-file job (FN23-FN26)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def python_title(col) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of letters.

    ``initcap`` only restarts after blanks (``O'neil``); ``str.title`` restarts
    after any non-letter (``O'Neil``, ``Mc-Donald``, ``Abc1Def``).  The string is
    cut into alternating letter / non-letter runs, each run is capitalised
    and the runs are joined back.  ``\\p{L}`` keeps accented letters inside a run.
    """
    runs = F.regexp_extract_all(_c(col), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))),
        "",
    )


def dash_phone(col) -> Column:
    """``##########`` -> ``###-###-####`` when the value has exactly 10 characters (FN24)."""
    c = _c(col)
    return F.when(F.length(c) == 10,
                  F.regexp_replace(c, r"^(.{3})(.{3})(.{4})$", "$1-$2-$3")).otherwise(c)


def last_chars(col, n: int) -> Column:
    """Python ``s[-n:]`` (FN25): the whole string when shorter than ``n``."""
    return F.right(_c(col), F.lit(n))


def split_blanks(col) -> Column:
    """Python ``str.split()`` with no argument: split on runs of whitespace (FN26)."""
    return F.split(F.regexp_replace(_c(col), r"^\s+|\s+$", ""), r"\s+")
