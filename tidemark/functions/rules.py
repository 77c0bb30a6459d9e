"""Rules as data: a named boolean predicate per rule.

One pass over the input yields kept rows and rejected rows with the names of the
rules they broke, from the same list of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`predicate` is true for a row that passes. A null predicate counts as a failure."""

    name: str
    predicate: Column

    def passed(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


def all_pass(rules: Sequence[Rule]) -> Column:
    """Conjunction of the rules; null-safe (a null counts as failed)."""
    expr = F.lit(True)
    for rule in rules:
        expr = expr & rule.passed()
    return expr


def broken_rules_text(rules: Sequence[Rule], sep: str = ";") -> Column:
    """Names of the rules the row breaks, in rule order, joined ('' when none)."""
    return F.concat_ws(sep, *[F.when(~r.passed(), F.lit(r.name)) for r in rules])
