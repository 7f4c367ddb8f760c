"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

UNKNOWN = "unknown"


def is_blank(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.isNull() | (c == "")


def or_unknown(column: str | Column) -> Column:
    """Blank and NULL text become the label 'unknown'."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(is_blank(c), F.lit(UNKNOWN)).otherwise(c)


# Amounts are summed as decimals. A sum of doubles depends on the order in which partitions
# arrive, so a retried task could change the last digits of a report. Ten digits after the
# point are kept of every row, more than money or usage prices have; an amount of 10**18 or
# more, or a total of 10**28, fails the job (ANSI overflow), it never turns into NULL.
AMOUNT = "decimal(28,10)"


def units(column: str | Column) -> Column:
    """An amount as an exact number, ready to be summed."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast(AMOUNT)


def units_where(condition: Column, column: str | Column = "price") -> Column:
    """The exact amounts of qualifying rows and 0 for the others, ready to be summed."""
    return F.when(condition, units(column)).otherwise(F.lit(0).cast(AMOUNT))


def from_units(total: Column) -> Column:
    """The amount as double."""
    return total.cast("double")


def is_event(event_type: str) -> Column:
    return F.col("event_type") == event_type


def times(event_type: str) -> Column:
    """Rows of the group with this event type."""
    return F.count_if(is_event(event_type))


def revenue() -> Column:
    """Exact purchase value of the group, in units."""
    return F.sum(units_where(is_event("purchase")))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL for an empty denominator."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL for an empty denominator."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def mean_of_units(total: Column, rows: Column, digits: int = 2) -> Column:
    return F.round(ratio(from_units(total), rows), digits)


def below(value: Column, steps: Iterable[tuple[float, object]], otherwise: object) -> Column:
    """Label of the first step whose upper bound exceeds the value.

    NULL, like anything beyond the last bound, gets the ``otherwise`` label.
    """
    label = F.lit(otherwise)
    for bound, name in sorted(steps, key=lambda step: step[0], reverse=True):
        label = F.when(value < F.lit(bound), F.lit(name)).otherwise(label)
    return label


def period_start(day: str | Column, period: str = "month") -> Column:
    """First day of the reporting period a date falls in: month, half_month or week."""
    d = F.col(day) if isinstance(day, str) else day
    month = F.trunc(d, "month")
    if period == "month":
        return month
    if period == "half_month":
        return F.when(F.dayofmonth(d) <= 15, month).otherwise(F.date_add(month, 15))
    if period == "week":
        return F.trunc(d, "week")
    raise ValueError(f"unknown period: {period}")


def period_number(start: str, period: str = "month") -> Column:
    """Consecutive numbers for the first days of consecutive periods."""
    d = F.col(start)
    months = F.year(d) * 12 + F.month(d)
    if period == "month":
        return months
    if period == "half_month":
        return months * 2 + F.when(F.dayofmonth(d) > 15, 1).otherwise(0)
    if period == "week":
        return F.floor((F.unix_date(d) + 3) / 7).cast("int")
    raise ValueError(f"unknown period: {period}")


def mask_user_id(user_id: str | Column, privileged: bool = False) -> Column:
    """Unchanged for privileged readers, otherwise a deterministic 64-bit hash.

    NULL stays NULL, so masked ids group and count exactly as the originals do.
    """
    c = F.col(user_id) if isinstance(user_id, str) else user_id
    if privileged:
        return c
    return F.when(c.isNotNull(), F.xxhash64(c.cast("string")))
