"""Canonical stage names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clausewise import rules


def canonical_stage(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """Exact alias, else the first alias inside the name, else the name itself.

    Of a column of filled text; null is ''.
    """
    aliases = rules.STAGE_ALIASES if aliases is None else aliases
    text = F.coalesce(c, F.lit(""))
    inside = text
    for alias, stage in reversed(aliases.items()):
        inside = F.when(text.contains(alias), stage).otherwise(inside)
    pairs = [F.lit(part) for pair in aliases.items() for part in pair]
    exact = F.element_at(F.create_map(*pairs), text) if pairs else F.lit(None).cast("string")
    return F.coalesce(exact, inside)
