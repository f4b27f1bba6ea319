"""Labels from ordered pattern rules: the first rule that matches decides."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacanta.fixed_values import (
    MID_LEVEL,
    OTHER_ROLE,
    ROLE_PATTERNS,
    SENIORITY_PATTERNS,
    UNSPECIFIED_LEVEL,
)
from vacanta.functions.text import bind, is_blank

Rules = Sequence[tuple[str, Sequence[str]]]

# Case-insensitive, Unicode word boundaries, and only \n ends a line.
_FLAGS = "(?iUd)"


def label_by_rules(c: Column, rules: Rules, default: str, blank: str | None = None) -> Column:
    """One CASE WHEN over ``rules``; ``blank`` (if other than ``default``) for no text."""
    used = [(label, "|".join(patterns)) for label, patterns in rules if patterns]
    empty = F.lit(default if blank is None else blank)

    def cases(text: Column) -> Column:
        return reduce(
            lambda case, rule: case.when(text.rlike(_FLAGS + rule[1]), F.lit(rule[0])),
            used,
            F.when(is_blank(text), empty),
        ).otherwise(F.lit(default))

    return bind(c, cases)


def role_category(title: Column) -> Column:
    return label_by_rules(title, ROLE_PATTERNS, OTHER_ROLE)


def seniority(title: Column) -> Column:
    return label_by_rules(title, SENIORITY_PATTERNS, MID_LEVEL, UNSPECIFIED_LEVEL)
