"""What a table must hold to replace its old version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ExpectationsFailed(ValueError):
    """The rows of a new version break rules; the message names them with their counts."""


@dataclass(frozen=True)
class Gate:
    """Rules that rows must keep before a table shows them.

    ``rules`` are conditions of bad rows; NULL is not bad. ``allowed`` gives by rule the share of
    rows that may be bad, else none may. There must be ``least_rows`` rows, and no key ``unique``
    may occur twice (NULL keys included).
    """

    rules: Mapping[str, Column] = field(default_factory=dict)
    allowed: Mapping[str, float] = field(default_factory=dict)
    least_rows: int = 0
    unique: Sequence[str] = ()

    def measures(self, among: Column | None = None) -> list[Column]:
        """Aggregates for an observation of the rows, or of those ``among`` them."""
        return [
            F.count_if(bad if among is None else bad & among).alias(f"bad_{name}")
            for name, bad in self.rules.items()
        ]

    def check(self, table: str, counts: Mapping[str, int], written: DataFrame) -> None:
        """Raise :class:`ExpectationsFailed` where ``counts``, the observed ``rows`` and measures,
        or the keys of the ``written`` rows break a rule. Keys are counted by a grouped count that
        reads their columns only."""
        n = counts["rows"]
        broken = []
        if n < self.least_rows:
            broken.append(f"rows {n} < {self.least_rows}")
        for name in self.rules:
            bad = counts[f"bad_{name}"]
            if bad > self.allowed.get(name, 0.0) * n:
                broken.append(f"{name} {bad} of {n}")
        if self.unique:
            held = written.groupBy(*self.unique).count().filter("count > 1")
            repeated = held.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
            if more := repeated.first()["n"]:
                broken.append(f"unique {', '.join(self.unique)} {more} of {n}")
        if broken:
            raise ExpectationsFailed(f"{table}: {'; '.join(broken)}")
