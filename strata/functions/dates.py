"""Date parsing and formatting with ``try_*`` functions (invalid -> null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import text_value, ustrip

# Accepted input layouts, tried in this order after the two
# strict shapes (dd/MM/yyyy and yyyy-MM-dd) have been ruled out: month first, then day first.
FREE_LAYOUTS = ["MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "M/d/yyyy", "M-d-yyyy", "yyyy/M/d",
                "d MMM yyyy", "d MMMM yyyy", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy"]
OUTPUT_LAYOUT = "dd/MM/yyyy"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_long_date(x) -> Column:
    """``Month d, yyyy`` (full month name, case-insensitive) -> date; else null."""
    s = _c(x)
    return F.when(s.isNotNull() & (s != ""), F.try_to_date(ustrip(s), "MMMM d, yyyy"))


def iso_date(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def parse_multi_date(x) -> Column:
    """Multi-layout parse: strict dd/mm/yyyy, strict ISO date, then a fixed list.

    A value with a strict shape that does not parse (``30/02/2024``) is null;
    it is not retried with other layouts.
    """
    t = text_value(x)
    strict_dmy = t.rlike("^\\d{2}/\\d{2}/\\d{4}$")
    strict_iso = t.rlike("^\\d{4}-\\d{2}-\\d{2}$")
    free = F.coalesce(
        F.to_date(F.try_to_timestamp(t)),
        *[F.try_to_date(t, fmt) for fmt in FREE_LAYOUTS],
    )
    return (F.when(strict_dmy, F.try_to_date(t, "dd/MM/yyyy"))
             .when(strict_iso, F.try_to_date(t, "yyyy-MM-dd"))
             .otherwise(free))


def to_ddmmyyyy(x) -> Column:
    """Any accepted layout -> ``dd/MM/yyyy`` text; invalid -> null."""
    return F.date_format(parse_multi_date(x), OUTPUT_LAYOUT)


def parse_either_date(x) -> Column:
    """Scope predicate input: ``dd/MM/yyyy`` or ISO date text -> date."""
    s = _c(x)
    return F.coalesce(F.try_to_date(s, "dd/MM/yyyy"), F.try_to_date(s, "yyyy-MM-dd"))
