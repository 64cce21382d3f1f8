"""Column functions that reproduce the reference dialects' semantics.

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
code generation; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal (the test tables store local timestamps)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.expr(f"TIMESTAMP_NTZ '{value}'")


def date_lit(value) -> Column:
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.expr(f"DATE '{value}'")


def in_year(col, year: int | str) -> Column:
    """``YEAR(col) = year`` written as a half-open range (FLT8).

    A range on the raw column is pushed into the Parquet scan as min/max
    row-group filters; ``year(col) = y`` is not.  A year given as text is
    compared as the whole number it holds (FLT7), so the range stays pushable;
    text that is none is an error, as in the dialect.
    """
    return in_years(col, year, year)


def in_years(col, first: int | str, last: int | str) -> Column:
    """``YEAR(col) BETWEEN first AND last`` as a pushable range (FLT3/FLT7/FLT8)."""
    c = _c(col)
    return (c >= ntz(f"{int(first):04d}-01-01 00:00:00")) & (c < ntz(f"{int(last) + 1:04d}-01-01 00:00:00"))


def datediff_days(start, end) -> Column:
    """T-SQL ``DATEDIFF(DAY, start, end)``: count of midnight boundaries (FN2)."""
    return F.datediff(_c(end).cast("date"), _c(start).cast("date"))


def datediff_months(start, end) -> Column:
    """T-SQL ``DATEDIFF(MONTH, start, end)``: month-boundary count (FN3).

    ``timestampdiff(MONTH, ..)`` counts completed months instead, which is
    a different number (31 Jan -> 1 Mar is 2 boundaries, 1 full month).
    """
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 (``DATEDIFF(SECOND, '1970-01-01', ts)``, FN4)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def datediff_seconds(start, end) -> Column:
    return epoch_seconds(end) - epoch_seconds(start)


def add_seconds_to_epoch(n) -> Column:
    """``DATEADD(SECOND, n, '1970-01-01')`` as a local timestamp (FN6)."""
    return F.timestamp_seconds(_c(n)).cast("timestamp_ntz")


def tsql_len(col) -> Column:
    """T-SQL ``LEN``: character count ignoring trailing blanks (FN10)."""
    return F.length(F.rtrim(_c(col)))


def int_avg(col) -> Column:
    """T-SQL ``AVG`` over an integer expression: integer, truncated toward 0 (AGG3).

    Empty groups (all NULL inputs) give NULL as ``AVG`` does.  Both partial
    aggregates (sum, count) combine map-side, so hot groups are cheap.
    """
    c = _c(col).cast("long")
    return div_trunc(F.sum(c), F.count(c))


def div_trunc(a: Column, b: Column) -> Column:
    """Exact integer division truncating toward zero; NULL when ``b`` is 0.

    ``a - a % b`` is an exact multiple of ``b`` (``%`` keeps the sign of the
    dividend), so the decimal quotient is an integer and the cast is exact.
    """
    return F.when(b != 0, ((a - a % b).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long"))


def mean_instant(ts) -> Column:
    """Mean event time with second precision (AGG19).

    ``DATEADD(SECOND, AVG(DATEDIFF(SECOND, epoch, ts)), epoch)`` where the
    integer AVG truncates toward zero.
    """
    secs = epoch_seconds(ts)
    n = F.count(secs)
    return F.when(n > 0, add_seconds_to_epoch(div_trunc(F.sum(secs), n)))


def plus_concat(*cols) -> Column:
    """T-SQL ``a + b + ...`` on strings: NULL if any operand is NULL (FN11)."""
    return F.concat(*[_c(c) for c in cols])


def pseudo_random_key(col, n: int, seed: int = 0) -> Column:
    """FN14 ``ABS(CHECKSUM(NEWID()) % n) + 1`` made repeatable: 1..n from an MD5 of the row's own key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(col).cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n + 1).cast("int")


def money(col) -> Column:
    """``MONEY`` is ``decimal(19,4)``; casting rounds half away from zero."""
    return _c(col).cast("decimal(19,4)")
