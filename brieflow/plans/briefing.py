"""Articles -> dedup -> enrich -> score -> select.

Articles come from any table of their columns, or from stored feeds and pages through
``brieflow.sources.feeds.collect``. The dedup stages checkpoint narrow key tables as they are built; the scored
candidates are materialised once without their texts. Nothing is cached on executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import declared, dedup, enrich, ingest, score, select


def briefing(articles: DataFrame, vectors: DataFrame | None = None, rules: P.Rules = P.DEFAULT_RULES,
             run_ts=None, gazetteer=(), countries=P.COUNTRY_KEYWORDS, embedder=None, tagger=None, texts: bool = False,
             history: DataFrame | None = None) -> DataFrame:
    """The selected articles in order (``BRIEFING_COLUMNS`` and the article's other narrow columns).

    Without ``run_ts`` ages count from the newest article; its time is looked up once (one row).
    ``history`` (arr, embedding) of earlier briefings gives survivors with a vector their novelty (B07), which
    counts into the importance score; without it every article has the default novelty. ``texts`` joins title, body and summary to the selected rows.
    """
    if run_ts is None:
        run_ts = articles.agg(F.max("published_at")).first()[0]
    fresh = ingest.min_length_filter(ingest.freshness_filter(articles, run_ts, rules.max_age_hours),
                                     rules.min_article_chars)
    survivors = dedup.dedup_cascade(fresh, vectors, rules, embedder=embedder)
    if history is not None and vectors is not None:
        own = vectors.select("arr", "embedding").join(survivors.select("arr"), "arr", "left_semi")
        survivors = survivors.join(declared.novelty(own, history).select("arr", "novelty"), "arr", "left")
    enriched = enrich.enrich(survivors, gazetteer=gazetteer, countries=countries, tagger=tagger)
    chosen = select.select(score.score(enriched, rules), rules)
    return select.with_texts(chosen, articles) if texts else chosen


BRIEFING_COLUMNS = ["rank", "arr", "id", "primary_domain", "primary_country", "corroboration_count",
                    "importance_score", "risk_score", "bias_adjusted_score", "is_fringe"]
