"""String / numeric column helpers used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(col) -> Column:
    """Strip leading/trailing Unicode white space (``trim`` only strips U+0020)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def canonical_url(col) -> Column:
    """Strip + lower-case; query string, fragment and trailing slash kept."""
    return F.lower(py_strip(F.coalesce(_c(col), F.lit(""))))


def article_id(col) -> Column:
    """SHA-256 hex of the canonical URL (same formula as the URL hash)."""
    return F.sha2(canonical_url(col), 256)


def entry_url(link, links) -> Column:
    """A10: ``link``, else ``links[0].href``; stripped. Empty means no URL."""
    first_href = F.try_element_at(_c(links), F.lit(1)).getField("href")
    return py_strip(F.coalesce(F.nullif(_c(link), F.lit("")), first_href, F.lit("")))


def effective_body(body="body", summary="summary") -> Column:
    """``body or summary``: NULL and '' are treated alike."""
    return F.coalesce(F.nullif(_c(body), F.lit("")), _c(summary), F.lit(""))


def article_text(title="title", body="body", summary="summary", body_chars: int | None = None,
                 sep: str = " ") -> Column:
    """``title + sep + (body or summary)``, body optionally cut to ``body_chars``."""
    b = effective_body(body, summary)
    if body_chars is not None:
        b = F.substring(b, 1, body_chars)
    return F.concat(F.coalesce(_c(title), F.lit("")), F.lit(sep), b)


def clamp01(col, low: float = 0.0, high: float = 1.0) -> Column:
    """max(low, min(high, v)). Coalesce to a default *before* calling:
    ``least``/``greatest`` skip NULLs."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), _c(col).cast("double")))


def hamming(a, b) -> Column:
    """Number of differing bits of two 64-bit fingerprints."""
    return F.bit_count(_c(a).bitwiseXOR(_c(b))).cast("int")


def title_case(col) -> Column:
    """``str.title()``: upper-case the first letter of every letter run, lower the rest.

    ``initcap`` only restarts after spaces (``x-y`` -> ``X-y``); this restarts
    after any non-letter (``x-y`` -> ``X-Y``).
    """
    runs = F.regexp_extract_all(_c(col), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))),
        "",
    )
