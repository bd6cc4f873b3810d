"""Arrays of explanation texts built from (condition, text) rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def notes(rules: Sequence[tuple[Column, str]]) -> Column:
    """Texts whose condition holds, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(cond, F.lit(note)) for cond, note in rules]))


def notes_or(rules: Sequence[tuple[Column, str]], default: str) -> Column:
    found = notes(rules)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))


def merged(lists: Sequence[Column], cap: int) -> Column:
    """Ordered distinct union of text lists, the first ``cap`` kept."""
    flat = F.flatten(F.array(*lists))
    clean = F.filter(F.transform(flat, lambda x: F.btrim(x)), lambda x: x != "")
    return F.slice(F.array_distinct(clean), 1, cap)
