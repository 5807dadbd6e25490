"""Timestamp parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference: the accepted timestamp text formats, in
# the order they are tried (Python strptime notation):
#   %Y-%m-%dT%H:%M:%S.%fZ   %Y-%m-%dT%H:%M:%SZ   %Y-%m-%d %H:%M:%S   %Y-%m-%d
# as Spark patterns (single letters accept one or two digits, like strptime):
TS_FORMATS = [
    "yyyy-M-d'T'H:m:s.SSSSSS'Z'",
    "yyyy-M-d'T'H:m:s'Z'",
    "yyyy-M-d H:m:s",
    "yyyy-M-d",
]
# Fixed value from the reference: the document store's stand-in for a missing timestamp.
DEFAULT_TS = "2024-01-01 00:00:00"
_EPOCH = "1970-01-01 00:00:00"


def _parse_wall_clock(c: Column, fmt: str) -> Column:
    """Text → timestamp_ntz without the session time zone.

    The text is parsed as a UTC instant (an explicit +0000 offset is
    appended), and the same wall-clock reading is rebuilt as
    ``epoch_ntz + micros``. A local time that does not exist in the
    session's zone (a DST gap) is therefore kept as written. Junk and
    impossible dates give NULL.
    """
    instant = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(fmt + " Z"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH).cast("timestamp_ntz"))


def _may_match(c: Column, fmt: str) -> Column:
    """A cheap necessary condition for ``fmt`` to parse ``c``: the pattern's
    literal characters must occur (case-insensitively, as the parser accepts
    them). A failed parse costs a caught exception, so formats that cannot
    match are not tried."""
    conds = []
    lits = {ch for part in fmt.split("'")[1::2] for ch in part} | {ch for ch in fmt.replace("'", "") if ch in "-: ."}
    if "Z" in lits:
        conds.append(c.endswith("Z") | c.endswith("z"))
    for ch in sorted(lits - {"Z"}):
        conds.append((c.contains(ch.upper()) | c.contains(ch.lower())) if ch.isalpha() else c.contains(ch))
    if ":" not in fmt:
        conds.append(~c.contains(":"))
    out = conds[0]
    for x in conds[1:]:
        out = out & x
    return out


def parse_mixed_timestamp(c: Column, formats=TS_FORMATS) -> Column:
    """First format that parses wins; junk, impossible dates and NULL give NULL."""
    return F.coalesce(*[F.when(_may_match(c, f), _parse_wall_clock(c, f)) for f in formats])


def parse_mixed_timestamp_unguarded(c: Column, formats=TS_FORMATS) -> Column:
    """Same result as :func:`parse_mixed_timestamp`, trying every format (reference for tests)."""
    return F.coalesce(*[_parse_wall_clock(c, f) for f in formats])


def parse_with_default(c: Column, default: str = DEFAULT_TS) -> Column:
    """Document-store rule: a *missing* timestamp becomes ``default``; text is parsed."""
    return F.when(c.isNull(), F.lit(default).cast("timestamp_ntz")).otherwise(parse_mixed_timestamp(c))


def month_key(c: Column) -> Column:
    """pandas ``to_period('M').astype(str)``: 'yyyy-MM'."""
    return F.date_format(c, "yyyy-MM")


def week_key(c: Column, iso_year: bool = True) -> Column:
    """'YYYY-Www' week key.

    ``iso_year=False`` reproduces ``%Y-W%V`` literally: calendar year with
    ISO week, so 2024-12-30 becomes '2024-W01'. The default uses the ISO
    week-based year ('2025-W01').
    """
    year = F.extract(F.lit("YEAROFWEEK"), c) if iso_year else F.year(c)
    return F.when(c.isNotNull(), F.format_string("%04d-W%02d", year, F.weekofyear(c)))


def hours_between(later: Column, earlier: Column) -> Column:
    """Fractional hours, like a millisecond difference ÷ 3,600,000."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(3.6e9)


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days, like a millisecond difference ÷ 86,400,000."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(8.64e10)
