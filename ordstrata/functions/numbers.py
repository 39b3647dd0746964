"""Casts, rounding and bucketing. Money is decimal, so sums do not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,9)"


def whole(text: Column) -> Column:
    """Strict whole number: other text fails the job (ANSI mode)."""
    return text.cast("bigint")


def try_whole(text: Column) -> Column:
    """Whole number, or NULL for other text."""
    return text.try_cast("bigint")


def _digits(text: Column, cast: Callable[[Column, str], Column]) -> tuple[Column, Column, Column]:
    """Whether the text is short, its value if so, and else whether digits of it would be lost.

    A text of at most ten characters without an exponent holds at most nine decimals."""
    with_exponent = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))
    short = (F.length(text) <= 10) & ~with_exponent
    wide = cast(text, "decimal(38,18)")
    decimals = F.length(F.regexp_extract(text, r"\.([0-9]*[1-9])", 1))
    exponent = F.regexp_extract(text, r"[eE]([+-]?[0-9]{1,6})", 1)
    shifted = F.when(exponent != "", decimals - exponent.try_cast("int")).otherwise(decimals)
    return short, wide, (shifted > 9) | (wide != cast(wide, MONEY))


def money(text: Column) -> Column:
    """Strict decimal number with every digit given: other text fails the job (ANSI mode), and so
    does a number with more than nine decimals, written out or by its exponent, which would lose
    some."""
    short, wide, lost = _digits(text, Column.cast)
    failed = F.raise_error(F.concat(F.lit("more than nine decimals: "), text))
    return F.when(short, text.cast(MONEY)).otherwise(
        F.when(lost, failed).otherwise(wide.cast(MONEY))
    )


def try_money(text: Column) -> Column:
    """The value of :func:`money`, or NULL where that fails."""
    short, wide, lost = _digits(text, Column.try_cast)
    return F.when(short, text.try_cast(MONEY)).otherwise(F.when(~lost, wide.try_cast(MONEY)))


def rounded(value: Column, places: int) -> Column:
    """Round halves away from zero, on the decimal value where there is one; double out."""
    return F.round(value, places).cast("double")


def _exact(value: Column) -> Column:
    return value.cast("decimal(33,9)")


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient of two sums or counts, divided and rounded in decimal. Zero divisor fails."""
    return rounded(_exact(numerator) / denominator.cast("decimal(20,0)"), places)


def percent(part: Column, total: Column, places: int) -> Column:
    return ratio(F.lit(100) * part, total, places)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, or NULL where the divisor is zero."""
    return F.try_divide(numerator, denominator)


def percent_change(before: Column, after: Column, places: int) -> Column:
    """Change in per cent of two sums with two decimals; NULL where it starts from zero.

    The operands are cut to 24 digits, which leaves the quotient 14 decimals: wider ones leave 6,
    too few to round from.
    """
    change = (F.lit(100) * (after - before)).cast("decimal(24,2)")
    return rounded(safe_divide(change, before.cast("decimal(24,2)")), places)


def range_bucket(value: Column, boundaries: Sequence[int]) -> Column:
    """How many of the ascending boundaries are at or below the value; NULL for NULL."""
    passed = [F.when(value >= F.lit(b), 1).otherwise(0) for b in boundaries]
    return F.when(value.isNotNull(), sum(passed[1:], passed[0]))


def generate_array(start: int, stop: int, step: int = 1) -> Column:
    """Array of whole numbers, both ends included."""
    return F.sequence(*[F.lit(n).cast("bigint") for n in (start, stop, step)])
