"""Column expressions shared by the query plans.

Money is kept to the cent and summed as whole cents: a sum of doubles depends on
how rows are partitioned, and decimals cost several times as much per row. A sum
holds up to 9.2e16 units of money and fails loudly beyond. Ratios are taken in
double and rounded once, ties away from zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(column: str | Column) -> Column:
    """An amount as whole cents."""
    return F.rint(_col(column) * 100).cast("bigint")


def scaled(units: str | Column, places: int = 2) -> Column:
    """Whole hundredths (or smaller parts) as a decimal with that many places."""
    step = f"decimal({places},{places})"
    return _col(units).cast("decimal(20,0)") * F.lit("0." + "0" * (places - 1) + "1").cast(step)


def cents_total(column: str | Column) -> Column:
    """Sum of an amount in whole cents, whatever the order in which rows are added."""
    return F.sum(cents(column))


def money_total(column: str | Column) -> Column:
    return scaled(cents_total(column))


def money_mean(column: str | Column) -> Column:
    return mean_of(money_total(column), F.count(_col(column)))


def number(column: str | Column) -> Column:
    return _col(column).cast("double")


def rounded(column: str | Column, places: int = 2) -> Column:
    """Round a double to some places by its decimal text, half away from zero: 0.285 gives 0.29, though
    the number stored for it lies below. No size overflows."""
    return F.round(number(column), places)


def rounded_even(column: str | Column, places: int) -> Column:
    """Round a double, ties to the even neighbour."""
    step = 10**places
    return F.rint(_col(column) * step) / step


def mean_of(total: str | Column, count: str | Column) -> Column:
    """total / count as double, NULL for a zero count."""
    return F.try_divide(number(total), number(count))


def mean(column: str | Column) -> Column:
    """Average of a measure, to six places: beyond those it varies with the order of rows.

    An average that its type cannot hold is NULL.
    """
    return rounded(F.try_avg(_col(column)), 6)


def percent_change(current: str | Column, previous: str | Column) -> Column:
    current, previous = number(current), number(previous)
    return F.try_divide(current - previous, previous) * 100


def month_label(column: str | Column) -> Column:
    return F.date_format(_col(column), "yyyy-MM")


def date_key(column: str | Column) -> Column:
    """Date as the integer YYYYMMDD."""
    column = _col(column)
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def full_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    return F.concat(_col(first), F.lit(" "), _col(last))


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return number(F.datediff(_col(later), _col(earlier)))


def per_unit(amount: str | Column, units: str | Column) -> Column:
    """amount / units, where zero units count as one."""
    units = number(units)
    return number(amount) / F.when(units == 0, F.lit(1.0)).otherwise(units)


def banded(value: str | Column, bands: list[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound lies above ``value``; ``top`` beyond the last."""
    value = _col(value)
    (bound, label), *rest = bands
    first = F.when(value < bound, F.lit(label))
    return reduce(lambda acc, b: acc.when(value < b[0], F.lit(b[1])), rest, first).otherwise(F.lit(top))


def at_least(value: str | Column, steps: list[tuple[float, str]], floor: str, strict: bool = False) -> Column:
    """Label of the first step that ``value`` reaches (or passes, if ``strict``)."""
    value = _col(value)

    def reached(bound):
        return value > bound if strict else value >= bound

    (bound, label), *rest = steps
    first = F.when(reached(bound), F.lit(label))
    return reduce(lambda acc, s: acc.when(reached(s[0]), F.lit(s[1])), rest, first).otherwise(F.lit(floor))


def relabel(column: str | Column, labels: dict) -> Column:
    """Map fixed values to fixed labels; anything else becomes NULL."""
    column = _col(column)
    (value, label), *rest = labels.items()
    first = F.when(column == value, F.lit(label))
    return reduce(lambda acc, kv: acc.when(column == kv[0], F.lit(kv[1])), rest, first)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
