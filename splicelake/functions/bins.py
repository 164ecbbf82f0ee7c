"""Nested bins of coordinates: a span has one home, whatever its length, and meets what overlaps it level by level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Width of the narrowest bins. Each level is eight times as wide; the last holds every position.
WIDTH, LEVELS = 1 << 14, 7


def _places(at: Column, width: int) -> list[Column]:
    return [F.floor(at / F.lit(width << (3 * k))) for k in range(LEVELS)] + [F.lit(0).cast("long")]


def home(s: Column, e: Column, width: int = WIDTH) -> Column:
    """The narrowest bin that holds a whole span, as ``level, bin``: one row a span, however long."""
    both = enumerate(zip(_places(s, width), _places(e, width), strict=True))
    return F.coalesce(*[F.when(a == b, F.struct(F.lit(k).alias("level"), a.alias("bin"))) for k, (a, b) in both])


def met(s: Column, e: Column, width: int = WIDTH) -> Column:
    """An array of all bins, as ``level, bin``, that a span reaches into: what overlaps it has its home in one of them, and no other."""
    both = enumerate(zip(_places(s, width), _places(e, width), strict=True))

    def at_level(k: int, a: Column, b: Column) -> Column:
        return F.transform(F.sequence(a, b), lambda x: F.struct(F.lit(k).alias("level"), x.alias("bin")))

    return F.flatten(F.array(*[at_level(k, a, b) for k, (a, b) in both]))
