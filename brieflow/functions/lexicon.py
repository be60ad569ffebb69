"""Multi-pattern substring matching as one JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lexicon_hits(text: Column, patterns: list[str]) -> Column:
    """array<int>: ids (positions in ``patterns``) of the patterns contained in ``text``, ascending.

    The patterns are one literal array that is filtered by ``contains``, instead of a generated term per pattern.
    ``text`` becomes a variable of its own, so that whatever it is made of is evaluated once per row.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(patterns)])
    hits = F.transform(F.array(F.coalesce(text, F.lit(""))), lambda t: F.transform(F.filter(entries, lambda e: F.contains(t, e["p"])), lambda e: e["i"]))
    return F.get(hits, F.lit(0))
