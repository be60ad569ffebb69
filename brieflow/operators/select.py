"""Selection (A45–A50): threshold, top-N per domain, country cap, fringe, order.

Plan shape at scale: the per-domain top-N is a ``row_number <= n`` filter,
which Catalyst turns into a *partial* ``WindowGroupLimit`` before the
shuffle, so a domain holding a third of all rows still ships only ``n`` rows
per input partition. The domain's first-seen arrival is a partial/final hash
aggregate (one row per domain). Everything after that works on at most
``n × domains`` rows; the fringe pick is a distributed top-1
(``TakeOrderedAndProject``) over an anti join with that small set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.session import ensure_checkpoint_dir

SCORE = "bias_adjusted_score"


def _score():
    return F.coalesce(F.col(SCORE), F.lit(0.0))


def min_score_filter(df: DataFrame, min_score: float = P.MIN_SCORE) -> DataFrame:
    """Keep ``bias_adjusted_score >= min_score`` (missing -> 0)."""
    return df.filter(_score() >= F.lit(float(min_score)))


def _domain(df: DataFrame):
    return F.coalesce(F.col("primary_domain"), F.lit(P.DEFAULT_DOMAIN))


def top_n_per_domain(df: DataFrame, n: int = P.TOP_N_PER_DOMAIN) -> DataFrame:
    """Top ``n`` per primary domain by score desc, ties by arrival (``arr``).

    Adds ``domain_first_arr`` (first arrival of the domain among the input),
    which fixes the list order the later stable sorts depend on.
    """
    df = df.withColumn("_dom", _domain(df))
    w = Window.partitionBy("_dom").orderBy(_score().desc(), F.col("arr").asc())
    top = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    first = df.groupBy("_dom").agg(F.min("arr").alias("domain_first_arr"))
    return top.join(first, "_dom").drop("_dom")


def country_cap(df: DataFrame, max_country: int = P.MAX_PER_COUNTRY, other: str = P.OTHER_COUNTRY) -> DataFrame:
    """Greedy in list order (score desc, domain first arrival, arrival): keep a row if its
    country is ``Other`` or fewer than ``max_country`` were kept. Equals rank ≤ max within country."""
    cty = F.coalesce(F.col("primary_country"), F.lit(other))
    w = Window.partitionBy(cty).orderBy(_score().desc(), F.col("domain_first_arr").asc(), F.col("arr").asc())
    return (df.withColumn("_crn", F.row_number().over(w))
              .filter((cty == other) | (F.col("_crn") <= max_country)).drop("_crn"))


def best_fringe(candidates: DataFrame, selected: DataFrame) -> DataFrame:
    """Best-scoring candidate with corroboration 1 not yet selected; ties -> first arrival.
    Returns at most one row."""
    corr = (F.coalesce(F.col("corroboration_count"), F.lit(1))
            if "corroboration_count" in candidates.columns else F.lit(1))
    pool = candidates.filter(corr == 1).join(selected.select("id").distinct(), "id", "left_anti")
    return pool.orderBy(_score().desc(), F.col("arr").asc()).limit(1)


def final_order(selected: DataFrame, fringe: DataFrame | None) -> DataFrame:
    """Selected ∪ fringe, score desc; ties keep list order, the fringe row last.
    Adds ``rank`` (1-based)."""
    sel = selected.withColumn("is_fringe", F.lit(False))
    if fringe is not None:
        fr = fringe.withColumn("is_fringe", F.lit(True))
        if "domain_first_arr" not in fr.columns:
            fr = fr.withColumn("domain_first_arr", F.lit(None).cast("bigint"))
        sel = sel.unionByName(fr.select(*sel.columns))
    # The union has at most n × domains + 1 rows: a global window is cheap here.
    w = Window.orderBy(_score().desc(), F.col("is_fringe").asc(), F.col("domain_first_arr").asc_nulls_last(),
                       F.col("arr").asc())
    return sel.withColumn("rank", F.row_number().over(w))


#: what selection never looks at: dropped before the candidates are materialised
WIDE_COLUMNS = ["title", "body", "summary", "content", "embedding", "ner_entities", "domain_scores", "gdelt_themes", "pmesii_tags"]


def candidates(df: DataFrame, min_score: float = P.MIN_SCORE) -> DataFrame:
    """A45 as the input of the later steps: narrow columns only, checkpointed once (shared folder), as several
    steps read them. The score is filtered on the stored rows: a filter on top of the scoring would be pushed
    below it, with a copy of the lexicon match for every score that it is made of."""
    ensure_checkpoint_dir(df.sparkSession)
    return min_score_filter(df.drop(*WIDE_COLUMNS).checkpoint(eager=True), min_score)


def select(df: DataFrame, rules: P.Rules = P.DEFAULT_RULES) -> DataFrame:
    """A45 -> A46 -> A47 -> A48 -> A49. Texts are joined to the few selected rows afterwards
    (:func:`with_texts`)."""
    cands = candidates(df, rules.min_score)
    top = top_n_per_domain(cands, rules.top_n_per_domain)
    capped = country_cap(top, rules.max_per_country)
    fringe = best_fringe(cands, capped) if rules.include_fringe else None
    return final_order(capped, fringe)


def with_texts(selected: DataFrame, articles: DataFrame, columns=("title", "body", "summary")) -> DataFrame:
    """The selected rows (at most n × domains + 1, so they are broadcast) with columns of their articles."""
    return articles.select("arr", *columns).join(F.broadcast(selected), "arr")


__all__ = ["min_score_filter", "top_n_per_domain", "country_cap", "best_fringe", "final_order", "candidates", "select", "with_texts"]
