"""Number coercion, rounding and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.config import AMOUNT, AMOUNT_LIMIT


def to_amount(value: Column) -> Column:
    """Exact amount; text that is no number, null, NaN and infinity count as 0.

    Casting text straight to a decimal also rejects what a double would accept
    in Java but is no number in a report, such as ``1D``. A number too large for
    the decimal is an error: it must not count as 0.
    """
    exact, size = value.try_cast(AMOUNT), F.abs(value.try_cast("double"))
    too_large = exact.isNull() & (size >= AMOUNT_LIMIT) & (size < float("inf"))
    failed = F.raise_error(F.concat(F.lit("amount too large: "), value.cast("string")))
    return F.when(too_large, failed.cast(AMOUNT)).otherwise(
        F.coalesce(exact, F.lit(0).cast(AMOUNT))
    )


def to_number(value: Column) -> Column:
    """Numeric value of a code, null for anything else."""
    return value.try_cast("decimal(38,18)")


def round_half_even(value: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def fmt_money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value.cast("double"), 2))


def fmt_qty(value: Column) -> Column:
    whole = F.rint(value.cast("double")).cast("bigint").cast("string")
    return F.coalesce(whole, F.lit(""))
