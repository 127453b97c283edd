"""Row rules as data: each takes the load's "now" and gives a boolean column, and names what breaks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from siltstone.functions.dates import AsOf


@dataclass(frozen=True)
class Rule:
    """``broken`` says what is wrong with a row on which the test is false or NULL."""

    broken: str
    test: Callable[[AsOf], Column]

    def __call__(self, as_of: AsOf) -> Column:
        return self.test(as_of)


def present(column: str) -> Rule:
    return Rule(f"{column} missing", lambda as_of: F.col(column).isNotNull())


def _or_null(column: str, test: Column) -> Column:
    return F.col(column).isNull() | test


def moment_passed(column: str) -> Rule:
    """NULL, or a timestamp that is not in the future."""
    return Rule(f"{column} in the future", lambda as_of: _or_null(column, F.col(column) <= as_of.timestamp))


def day_passed(column: str) -> Rule:
    """NULL, or a date that is not in the future."""
    return Rule(f"{column} in the future", lambda as_of: _or_null(column, F.col(column) <= as_of.date))


def in_order(earlier: str, later: str) -> Rule:
    """``later >= earlier`` unless one of them is NULL."""
    return Rule(
        f"{later} before {earlier}",
        lambda as_of: F.coalesce(F.col(later) >= F.col(earlier), F.lit(True)),
    )


def not_negative(column: str) -> Rule:
    return Rule(f"{column} negative", lambda as_of: _or_null(column, F.col(column) >= 0))


def within(column: str, low: int, high: int) -> Rule:
    return Rule(f"{column} not in {low}..{high}", lambda as_of: _or_null(column, F.col(column).between(low, high)))


def code_of_length(column: str, length: int) -> Rule:
    return Rule(f"{column} not of length {length}", lambda as_of: _or_null(column, F.length(column) == length))


def sane_change_times() -> tuple[Rule, ...]:
    return (
        moment_passed("created_at"),
        moment_passed("updated_at"),
        in_order("created_at", "updated_at"),
    )
