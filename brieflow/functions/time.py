"""Lenient publication-time parsing with a closed format list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in order after the weekday prefix ("Mon, ") is removed.
# Zone-less forms are read in the session time zone, which must be UTC.
DEFAULT_FORMATS: tuple[str, ...] = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy HH:mm Z",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
)


def _parse_one(raw: Column, formats) -> Column:
    s = F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def parse_published(published_struct=None, published=None, updated=None, run_ts=None,
                    formats=DEFAULT_FORMATS) -> Column:
    """Structured time, else first non-empty of published/updated parsed, else ``run_ts``.

    A structured time is taken as UTC (the intended meaning). Unparsable
    strings fall through to ``run_ts``; count them with ``published_parsed_ok``.
    """
    parts = []
    if published_struct is not None:
        parts.append(F.col(published_struct) if isinstance(published_struct, str) else published_struct)
    raw = None
    if published is not None or updated is not None:
        cols = [F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (published, updated) if c is not None]
        raw = F.coalesce(*cols)
        parts.append(_parse_one(raw, formats))
    if run_ts is not None:
        parts.append(run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp"))
    return F.coalesce(*parts)
