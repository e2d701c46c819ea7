"""Ingest casts from report strings to typed columns, as built-in expressions.

strict numeric  one bad value fails the batch (raise_error), empty stays NULL
lenient date    unparseable -> NULL, time part dropped
lenient time    exact H:m:s -> 'HH:mm:ss' text, else NULL
lenient stamp   unparseable -> NULL
duration        parsed, printed as the time-of-day tail of the duration:
                whole days vanish, negatives wrap and carry a '+'
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts after ISO (month-first for slashes).
DATE_FORMATS: tuple[str, ...] = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "d-MMM-yyyy",
    "yyyy/M/d",
)

# [sign][N day(s)[,]] [+]H:M:S[.fraction] -- days, time or both. With a day
# part the sign belongs to the days only ("-1 days 02:00:00" is -22 hours);
# without one it belongs to the time.
DURATION_RE = (r"^\s*([+-])?\s*(?:(\d+)\s*days?\s*,?\s*)?"
               r"(?:\+?(\d+):(\d+):(\d+)(?:\.(\d{1,9}))?)?\s*$")
BARE_INT_RE = r"^\s*([+-]?\d+)\s*$"
NUMBER_RE = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?(inf|infinity|nan)\s*$"
NS_PER_SEC = 1_000_000_000
NS_PER_DAY = 86_400 * NS_PER_SEC


def _c(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _bad(raw: Column, x: Column) -> Column:
    """Whether a cell, and what it parses to, is no number. The cast alone also
    takes type suffixes such as 1.5d or 2f, hexadecimal and control characters;
    what starts and ends as a plain number can only be hexadecimal of these."""
    plain = ((raw >= "+") & (raw < ":") & F.substring(raw, -1, 1).between(".", "9")
             & ~F.contains(raw, F.lit("x")) & ~F.contains(raw, F.lit("X")))
    return F.coalesce((raw != "") & (x.isNull() | (~plain & ~raw.rlike(NUMBER_RE))), F.lit(False))


def is_bad_number(c: str | Column) -> Column:
    """A non-empty cell that is not a number (never NULL)."""
    return _bad(_c(c), _c(c).try_cast("double"))


def lenient_double(c: str | Column, parsed: Column | None = None) -> Column:
    """Parse as double; a bad cell and NaN are NULL. ``parsed``: the cell's own
    try_cast, if a column holds it already."""
    x = _c(c).try_cast("double") if parsed is None else parsed
    return F.when((_c(c) != "") & ~_bad(_c(c), x) & ~F.isnan(x), x)


def strict_double(c: str | Column, name: str = "value", parsed: Column | None = None) -> Column:
    """Parse as double; a non-empty cell that does not parse fails the job.
    NaN is treated as missing. ``parsed`` as in ``lenient_double``."""
    raw = _c(c)
    x = raw.try_cast("double") if parsed is None else parsed
    return (F.when(_bad(raw, x), F.raise_error(F.concat(F.lit(f"column {name!r}: not a number: "), raw)).cast("double"))
            .when((raw != "") & ~F.isnan(x), x))


def lenient_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    s = F.trim(_c(c))
    parsed = [s.try_cast("timestamp_ntz")] + [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    return F.to_date(F.coalesce(*parsed))


# The layouts one of which a whole column follows, and the shape of
# a cell by which the first one is recognised. A first number above 12 cannot be
# a month, so it is the day.
_D, _T = r"\d{1,2}", r"\d{1,2}:\d{2}"
_DAY_FIRST = r"(?:1[3-9]|[23]\d)"
COLUMN_LAYOUTS: tuple[tuple[str, str], ...] = tuple(
    (f"^{date}{clock}$", f"{layout}{shown}")
    for date, layout in ((r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"), (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
                         (rf"{_DAY_FIRST}/{_D}/\d{{4}}", "d/M/yyyy"), (rf"{_D}/{_D}/\d{{4}}", "M/d/yyyy"),
                         (rf"{_DAY_FIRST}-{_D}-\d{{4}}", "d-M-yyyy"), (rf"{_D}-{_D}-\d{{4}}", "M-d-yyyy"),
                         (rf"{_D}-[A-Za-z]{{3}}-\d{{4}}", "d-MMM-yyyy"), (rf"{_D} [A-Za-z]{{3}} \d{{4}}", "d MMM yyyy"),
                         (r"\d{8}", "yyyyMMdd"))
    for clock, shown in (("", ""), (rf" {_T}:\d{{2}}", " H:mm:ss"), (rf" {_T}", " H:mm"),
                         (rf"T{_T}:\d{{2}}", "'T'H:mm:ss")))


def guessed_layout(c: str | Column) -> Column:
    """The layout that a cell shows, NULL when it is none of them."""
    s = _c(c)
    out = F.lit(None).cast("string")
    for shape, layout in reversed(COLUMN_LAYOUTS):
        out = F.when(s.rlike(shape) & F.try_to_timestamp(s, F.lit(layout)).isNotNull(), F.lit(layout)).otherwise(out)
    return out


def layout_date(c: str | Column, layout: str | Column) -> Column:
    """Date of a cell that follows ``layout``; any other cell is NULL. Without
    a layout each cell is parsed by itself."""
    s, fmt = _c(c), _c(layout)
    follows = F.coalesce(*[F.when(fmt == F.lit(y), s.rlike(shape.replace(_DAY_FIRST, _D)))
                           for shape, y in COLUMN_LAYOUTS])
    return F.when(fmt.isNull(), lenient_date(c)).otherwise(
        F.when(follows, F.to_date(F.try_to_timestamp(s, fmt))))


def lenient_time(c: str | Column) -> Column:
    return F.date_format(F.try_to_timestamp(F.trim(_c(c)), F.lit("H:m:s")), "HH:mm:ss")


def lenient_timestamp(c: str | Column) -> Column:
    return _c(c).try_cast("timestamp_ntz")


# Units of a duration and their nanoseconds. Case is folded, but a
# single M is a month, which has no fixed length.
UNITS: tuple[tuple[str, int], ...] = (
    ("nanoseconds|nanosecond|nanos|nano|ns|n", 1),
    ("microseconds|microsecond|micros|micro|us|\u00b5s|u", 1_000),
    ("milliseconds|millisecond|millis|milli|ms|l", 1_000_000),
    ("seconds|second|sec|s", NS_PER_SEC),
    ("minutes|minute|min|m|t", 60 * NS_PER_SEC),
    ("hours|hour|hr|h", 3600 * NS_PER_SEC),
    ("days|day|d", NS_PER_DAY),
    ("w", 7 * NS_PER_DAY),
)
_UNIT = "|".join(u for u, _ in UNITS)
UNIT_TOKEN = rf"([+-]?)\s*(\d+(?:\.\d*)?)\s*(?!M(?![A-Za-z]))((?i:{_UNIT}))(?![A-Za-z\u00b5])"
UNITS_RE = rf"^\s*(?:{UNIT_TOKEN}\s*)+$"
# P, days, T and parts of a day.
ISO_RE = r"^(-?)P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.(\d{1,9}))?S)?)?$"


def _times(number: Column, unit: int) -> Column:
    """A decimal text times nanoseconds, cut to whole ones; NULL out of range."""
    x = F.try_multiply(number.try_cast("decimal(28,9)"), F.lit(unit).cast("decimal(18,0)"))
    return F.when(F.abs(x) < F.lit(2 ** 63 - 1), x).try_cast("long")


def unit_nanos(s: Column) -> Column:
    """``5 min``, ``2h30m``, ``1.5 hours``: the sum of number-and-unit tokens. A
    minus sign holds for all that follows; commas count for nothing."""
    s = F.replace(s, F.lit(","), F.lit(""))
    signs, numbers, units = (F.regexp_extract_all(s, F.lit(UNIT_TOKEN), F.lit(i)) for i in (1, 2, 3))

    def one(i: Column) -> Column:
        n, u = F.get(numbers, i), F.lower(F.get(units, i))
        out = F.lit(None).cast("long")
        for names, ns in UNITS:
            out = F.when(u.isin(names.split("|")), _times(n, ns)).otherwise(out)
        return out

    tokens = F.transform(F.sequence(F.lit(0), F.size(units) - 1), one)
    total = F.aggregate(tokens, F.lit(0).cast("long"), F.try_add)
    # Only the first token may carry a sign.
    later = F.exists(F.slice(signs, 2, F.size(signs)), lambda x: x != F.lit(""))
    return F.when(s.rlike(UNITS_RE) & ~later, F.when(F.get(signs, F.lit(0)) == F.lit("-"), -total).otherwise(total))


def iso_nanos(s: Column) -> Column:
    """``P1DT2H``, ``PT5M``, ``PT1.5S``."""
    def g(i: int) -> Column:
        return F.nullif(F.regexp_extract(s, ISO_RE, i), F.lit(""))

    parts = [F.when(g(i).isNull(), F.lit(0).cast("long")).otherwise(
        F.try_multiply(g(i).try_cast("long"), F.lit(unit).cast("long")))
        for i, unit in ((2, 7 * NS_PER_DAY), (3, NS_PER_DAY), (4, 3600 * NS_PER_SEC), (5, 60 * NS_PER_SEC), (6, NS_PER_SEC))]
    total = F.coalesce(F.rpad(g(7), 9, "0").try_cast("long"), F.lit(0).cast("long"))
    for p in parts:
        total = F.try_add(total, p)
    given = F.coalesce(*[g(i) for i in range(2, 7)]).isNotNull()
    return F.when(s.rlike(ISO_RE) & given, F.when(F.regexp_extract(s, ISO_RE, 1) == F.lit("-"), -total).otherwise(total))


def duration_nanos(c: str | Column) -> Column:
    """Signed nanoseconds of a duration string, NULL when it does not parse.
    One regex pass rewrites a match into '|'-separated groups."""
    s = _c(c)
    parts = F.split(F.regexp_replace(s, DURATION_RE, "$1|$2|$3|$4|$5|$6"), r"\|")

    def g(i: int) -> Column:
        return F.get(parts, i - 1)

    has_days, has_time = g(2) != F.lit(""), g(3) != F.lit("")
    def part(i: int, unit: int) -> Column:          # NULL when out of range
        return F.try_multiply(g(i).try_cast("long"), F.lit(unit).cast("long"))

    days = F.when(has_days, part(2, NS_PER_DAY)).otherwise(F.lit(0).cast("long"))
    clock = F.when(has_time, F.try_add(F.try_add(F.try_add(
        part(3, 3600 * NS_PER_SEC), part(4, 60 * NS_PER_SEC)), part(5, NS_PER_SEC)),
        F.rpad(g(6), 9, "0").try_cast("long"))).otherwise(F.lit(0).cast("long"))
    neg = g(1) == F.lit("-")
    signed = (F.when(has_days, F.try_add(F.when(neg, -days).otherwise(days), clock))
              .otherwise(F.when(neg, -clock).otherwise(clock)))
    bare = F.regexp_extract(s, BARE_INT_RE, 1)
    return (F.when(s.rlike(DURATION_RE) & (has_days | has_time), signed)
            .when(bare != F.lit(""), bare.try_cast("long"))
            .otherwise(F.coalesce(iso_nanos(s), unit_nanos(s))))


def clock_text(nanos: Column) -> Column:
    """Time-of-day tail of a printed duration: the day part is dropped,
    a negative duration wraps into the day before and is prefixed '+'.
    ``nanos`` should be a column reference (see ingest.clean_durations):
    it is used several times below.
    Fractions print 6 digits, or 9 when there are nanoseconds."""
    tod = F.pmod(nanos, F.lit(NS_PER_DAY))
    secs = F.floor(tod / F.lit(NS_PER_SEC)).cast("long")
    sub = F.pmod(tod, F.lit(NS_PER_SEC))

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    hms = F.concat_ws(":", two(F.floor(secs / 3600)), two(F.floor(secs / 60) % 60), two(secs % 60))
    frac = (F.when(sub == 0, F.lit(""))
            .when(sub % 1000 == 0, F.concat(F.lit("."), F.lpad((sub / 1000).cast("long").cast("string"), 6, "0")))
            .otherwise(F.concat(F.lit("."), F.lpad(sub.cast("string"), 9, "0"))))
    text = F.concat(F.when(nanos < 0, F.lit("+")).otherwise(F.lit("")), hms, frac)
    return F.when(nanos.isNull(), F.lit(None).cast("string")).otherwise(text)


def not_blank(c: str | Column) -> Column:
    """Not NULL and not only whitespace."""
    from kasir.functions.expr import unicode_trim
    return _c(c).isNotNull() & (unicode_trim(_c(c)) != F.lit(""))
