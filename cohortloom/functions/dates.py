"""Dates that people typed, as expressions inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: three-letter month names in calendar order
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _month(name: Column) -> Column:
    return F.lpad(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(name, 1, 3)).cast("string"), 2, "0")


def canonical_date(c: Column) -> Column:
    """``yyyy-MM-dd`` of a full date, ``yyyy-MM`` of a month, ``yyyy`` of a year, in whatever format it is written.

    Dates with slashes have the month or the year first; two-digit years are 20xx; a time of day is dropped. Null
    and blank give null. Text that is no date comes back in lower case with single spaces, so it still compares.
    """
    s = F.trim(F.regexp_replace(F.lower(c), r"[\s\u00a0]+", " "))
    s = F.regexp_replace(s, r"(\d)[t ]\d{1,2}:\d{2}.*$", "$1")

    def p(pattern: str, group: int) -> Column:
        return F.regexp_extract(s, pattern, group)

    def two(x: Column) -> Column:
        return F.lpad(x, 2, "0")

    ymd, compact, ym = r"^(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})$", r"^(\d{4})(\d{2})(\d{2})$", r"^(\d{4})[-/. ](\d{1,2})$"
    mdy, my, mdy2 = r"^(\d{1,2})[/](\d{1,2})[/](\d{4})$", r"^(\d{1,2})[-/. ](\d{4})$", r"^(\d{1,2})[/](\d{1,2})[/](\d{2})$"
    dmy = r"^(\d{1,2})[-. ](\d{1,2})[-. ](\d{4})$"
    name = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
    dmony, dmony2 = rf"^(\d{{1,2}})[-/. ]+{name}[-/., ]+(\d{{4}})$", rf"^(\d{{1,2}})[-/. ]+{name}[-/., ]+(\d{{2}})$"
    mondy, mony, ymon = rf"^{name}[-/. ]+(\d{{1,2}})(?:st|nd|rd|th)?[-/., ]+(\d{{4}})$", rf"^{name}[-/., ]+(\d{{4}})$", rf"^(\d{{4}})[-/., ]+{name}$"
    out = (
        F.when(s.rlike(ymd), F.concat_ws("-", p(ymd, 1), two(p(ymd, 2)), two(p(ymd, 3))))
        .when(s.rlike(compact), F.concat_ws("-", p(compact, 1), p(compact, 2), p(compact, 3)))
        .when(s.rlike(ym), F.concat_ws("-", p(ym, 1), two(p(ym, 2))))
        .when(s.rlike(mdy), F.concat_ws("-", p(mdy, 3), two(p(mdy, 1)), two(p(mdy, 2))))
        .when(s.rlike(mdy2), F.concat_ws("-", F.concat(F.lit("20"), p(mdy2, 3)), two(p(mdy2, 1)), two(p(mdy2, 2))))
        .when(s.rlike(my), F.concat_ws("-", p(my, 2), two(p(my, 1))))
        .when(s.rlike(dmy), F.concat_ws("-", p(dmy, 3), two(p(dmy, 2)), two(p(dmy, 1))))
        .when(s.rlike(dmony), F.concat_ws("-", p(dmony, 3), _month(p(dmony, 2)), two(p(dmony, 1))))
        .when(s.rlike(dmony2), F.concat_ws("-", F.concat(F.lit("20"), p(dmony2, 3)), _month(p(dmony2, 2)), two(p(dmony2, 1))))
        .when(s.rlike(mondy), F.concat_ws("-", p(mondy, 3), _month(p(mondy, 1)), two(p(mondy, 2))))
        .when(s.rlike(mony), F.concat_ws("-", p(mony, 2), _month(p(mony, 1))))
        .when(s.rlike(ymon), F.concat_ws("-", p(ymon, 1), _month(p(ymon, 2))))
        .otherwise(s)
    )
    return F.nullif(out, F.lit(""))
