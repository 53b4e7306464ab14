"""Report dates and ``YYYY-MM`` months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.config import check_month

_REPORT_DATE = "^(1[0-2]|0?[1-9])/(3[01]|[12][0-9]|0?[1-9])/[0-9]{2}$"


def parse_report_date(text: Column) -> Column:
    """Date written ``mm/dd/yy``; years 69 to 99 belong to the 1900s.

    The parts are put in the order of an ISO date and cast: a report has a date per line, and
    a parser with a pattern takes several times as long. A day that its month lacks is null.
    """
    month = F.substring_index(text, "/", 1)
    day = F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    year = F.substring_index(text, "/", -1)
    century = F.when(year >= "69", "19").otherwise("20")
    iso = F.concat(century, year, F.lit("-"), month, F.lit("-"), day)
    return F.when(text.rlike(_REPORT_DATE), iso.try_cast("date"))


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def months_back(last: str, count: int) -> list[str]:
    """The ``count`` calendar months that end with ``last``, oldest first."""
    year, month = map(int, check_month(last).split("-"))
    newest = 12 * year + month - 1
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in range(newest - count + 1, newest + 1)]


def trailing_months(last: Column, count: int) -> Column:
    """Array of the ``count`` calendar months that end with month ``last``."""
    end = F.to_date(F.concat(last, F.lit("-01")))
    months = F.sequence(F.add_months(end, 1 - count), end, F.expr("interval 1 month"))
    return F.transform(months, month_key)
