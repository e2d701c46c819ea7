"""Scalar column expressions, all built from JVM-side built-ins.

Nothing here is a Python UDF: each helper returns a ``Column`` that Catalyst
folds into whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes used to build the menu matching key.
# Leading/trailing whitespace = the Unicode White_Space property.
UNICODE_SPACE_CLASS = (
    r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
# Inner runs collapsed to one space = tab, newline, form feed, CR, space.
ASCII_SPACE_RUN = r"[\t\n\f\r ]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_labels(c: str | Column, mapping: Iterable[tuple[str, Iterable[str]]],
               default: str) -> Column:
    """First matching label set wins; unmatched and NULL give ``default``."""
    col = _c(c)
    out = None
    for target, labels in mapping:
        cond = col.isin(list(labels))
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def channel_group(c: str | Column, online: Iterable[str],
                  online_label: str = "ONLINE", offline_label: str = "OFFLINE") -> Column:
    return F.when(_c(c).isin(list(online)), F.lit(online_label)).otherwise(F.lit(offline_label))


def unicode_trim(c: str | Column) -> Column:
    """Strip every leading and trailing Unicode whitespace character."""
    return F.regexp_replace(_c(c), rf"^{UNICODE_SPACE_CLASS}+|{UNICODE_SPACE_CLASS}+$", "")


def product_key(c: str | Column) -> Column:
    """Menu matching key: trim, collapse inner whitespace runs, lower-case."""
    return F.lower(F.regexp_replace(unicode_trim(c), ASCII_SPACE_RUN, " "))


def month_of(c: str | Column) -> Column:
    """First day of the month, as a DATE (``trunc``; ``date_trunc`` gives a timestamp)."""
    return F.trunc(_c(c), "month")


def sunday_week(c: str | Column) -> Column:
    """Week of year, weeks start on Sunday, days before the first Sunday are week 0."""
    d = _c(c)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("int")


def null_greatest(*cols: Column) -> Column:
    """GREATEST that is NULL when any input is NULL."""
    any_null = None
    for c in cols:
        any_null = c.isNull() if any_null is None else (any_null | c.isNull())
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cols))


def year_bucket(open_date: str | Column, floor_year: int, when_null: int) -> Column:
    """coalesce(greatest(year(open), floor) with NULL propagation, when_null)."""
    y = F.year(_c(open_date))
    return F.coalesce(null_greatest(y, F.lit(floor_year)), F.lit(when_null)).cast("int")


def days_since(day: str | Column, start: str | Column) -> Column:
    """1-based day count: the start day itself is day 1."""
    return (F.datediff(_c(day), _c(start)) + F.lit(1)).cast("int")


def date_lit(d: _dt.date | str) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def as_of_date(as_of: _dt.date | None) -> Column:
    return F.current_date() if as_of is None else date_lit(as_of)


def gap_adjusted(code: Column, actual: Column, gap: Column, taf: Column,
                 override_code: str) -> Column:
    """Override store takes the adjustment value as-is (NULL included); other
    stores take actual x gap unless that product is NULL or zero."""
    prod = actual.cast("double") * gap.cast("double")
    return (F.when(code == F.lit(override_code), taf.cast("double"))
            .when(prod.isNull() | (prod == F.lit(0.0)), actual.cast("double"))
            .otherwise(prod))
