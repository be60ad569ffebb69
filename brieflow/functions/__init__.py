"""Column-level functions (JVM built-ins only, no Python UDFs but the SimHash helper)."""

from brieflow.functions.text import (  # noqa: F401
    article_id,
    article_text,
    canonical_url,
    clamp01,
    effective_body,
    entry_url,
    hamming,
    py_strip,
    title_case,
)
from brieflow.functions.time import parse_published  # noqa: F401
