"""Ordered rule tables compiled to one column: the first rule that matches decides, so Spark short-circuits it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, str]


def cascade(c: Column, rules: Sequence[Rule], default: str | None = None, *, ignore_case: bool = True, anchor: str = "search") -> Column:
    """Label of the first rule whose pattern matches; null input gives null.

    ``anchor``: "search" anywhere, "start" at the beginning, "full" the whole text. Case is ignored for all of Unicode.
    """
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for pattern, label in rules:
        shaped = {"search": pattern, "start": f"^(?:{pattern})", "full": f"^(?:{pattern})$"}[anchor]
        out = out.when(c.rlike(("(?iu)" if ignore_case else "") + shaped), F.lit(label))
    return out.otherwise(F.lit(default))


def lookup(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """Value of a small literal map, else ``default`` (null if not given)."""
    if not table:
        return default if default is not None else F.lit(None).cast("string")
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return F.when(c.isNull(), default if default is not None else F.lit(None).cast("string")).otherwise(F.coalesce(found, default) if default is not None else found)


def flag(c: Column, pattern: str, *, ignore_case: bool = True) -> Column:
    """1 if the pattern occurs, else 0 (also for null)."""
    return F.coalesce(c.rlike(("(?iu)" if ignore_case else "") + pattern).cast("int"), F.lit(0))
