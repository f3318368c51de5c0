"""Calendar keys of the variability mart.

* ``iso_week_key``: ISO year followed by the ISO week number, the week *not*
  zero-padded (2021-01-01 -> ``202053``, 2021-01-04 -> ``20211``). Unique per
  ISO week but does not sort as text.
* ``synthetic_week``: the last 28 days of a month are cut into four
  seven-day weeks numbered 1..4; the 0-3 leading days form week 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def iso_week_key(d) -> Column:
    d = as_col(d).cast("date")
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
        F.weekofyear(d).cast("string"),
    )


def calendar_year(d) -> Column:
    return F.year(as_col(d).cast("date"))


def calendar_month(d) -> Column:
    return F.month(as_col(d).cast("date"))


def calendar_day(d) -> Column:
    return F.dayofmonth(as_col(d).cast("date"))


def synthetic_week(d) -> Column:
    """Week 1..4 of the month's last 28 days, 0 for the days before them.

    Closed form of the month-length/leap-year case table: with ``L`` the
    length of the month, day ``x`` falls in week ``(x - (L - 28) + 6) div 7``.
    The operand is never negative, so integer division is a floor.
    NULL dates give NULL.
    """
    d = as_col(d).cast("date")
    shifted = F.dayofmonth(d) - F.dayofmonth(F.last_day(d)) + F.lit(34)
    return F.floor(shifted / F.lit(7)).cast("int")
