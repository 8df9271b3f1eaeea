"""Cleaning declared by column.

A table's cleaning is a list of rules, one for each output column: where it comes
from, how it is cleaned, and so what counts as unreadable. The same rules give the
projection (``project``) and the expectations on the rows before it
(``readable``), so what cleaning turns into null is what the expectation counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.quality import Expectation


@dataclass(frozen=True)
class Rule:
    """``how``: keep, upper, timestamp or date (texts in ``pattern``; others become null, so that no row stops a stream)."""
    column: str
    how: str = "keep"
    pattern: str | None = None
    source: str | None = None          # the input column, where it has another name
    optional: bool = False             # left out if the input doesn't have it

    def _sql(self) -> str:
        name = f"`{self.source or self.column}`"
        return {"keep": name, "upper": f"upper({name})", "timestamp": f"try_to_timestamp({name}, '{self.pattern}')",
                "date": f"try_to_date({name}, '{self.pattern}')"}[self.how]

    def value(self) -> Column:
        return F.expr(self._sql()).alias(self.column)

    def expectation(self) -> Expectation | None:
        """That a value which was given can be read; None for rules that read anything."""
        if self.pattern is None:
            return None
        return Expectation(f"readable_{self.column}", f"`{self.source or self.column}` IS NULL OR {self._sql()} IS NOT NULL", "warn")


def project(df: DataFrame, rules: Sequence[Rule], *more: Column) -> DataFrame:
    return df.select(*[r.value() for r in rules if not r.optional or (r.source or r.column) in df.columns], *more)


def readable(rules: Sequence[Rule]) -> tuple[Expectation, ...]:
    return tuple(e for r in rules if (e := r.expectation()))
