"""First-match rule tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


# Kinds that ignore case. They look at the upper-cased value, so their words are given in upper case.
FOLDED = ("starts", "contains", "regex")


@dataclass(frozen=True)
class Rule:
    """``label`` applies where the value passes the test named by ``kind``.

    ``in``: equals one of ``args``; ``between``: from ``args[0]`` to ``args[1]``, both included;
    ``starts``, ``contains``, ``regex``: starts with, contains or matches one of ``args`` in any case.
    """

    label: str
    kind: str
    args: tuple

    def test(self, value: Column, folded: Column) -> Column:
        if self.kind == "in":
            return value.isin(*self.args)
        if self.kind == "between":
            return value.between(*self.args)
        if self.kind == "starts":
            return reduce(or_, [folded.startswith(word) for word in self.args])
        if self.kind == "contains":
            return reduce(or_, [folded.contains(word) for word in self.args])
        if self.kind == "regex":
            return reduce(or_, [folded.rlike(pattern) for pattern in self.args])
        raise ValueError(f"unknown rule kind {self.kind!r}")


def ignores_case(rules: Sequence[Rule]) -> bool:
    return any(rule.kind in FOLDED for rule in rules)


def categorize(
    value: Column, rules: Sequence[Rule], default: str | None, folded: Column | None = None
) -> Column:
    """Label of the first rule that holds; ``default`` if none does or the value is NULL.

    ``folded`` is the upper-cased value where the caller has it as a column already.
    """
    if folded is None:
        folded = F.upper(value)
    labels = [F.when(rule.test(value, folded), F.lit(rule.label)) for rule in rules]
    return F.coalesce(*labels, F.lit(default).cast("string"))


def indicator(value: Column, *accepted: str) -> Column:
    """1 where the value is accepted, else 0 (NULL included)."""
    return F.coalesce(value.isin(*accepted), F.lit(False)).cast("int")
