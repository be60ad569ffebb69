"""Scoring (A39–A43): importance, risk and single-source-adjusted scores.

Pure column arithmetic; evaluation order matches the studied formulas so
the doubles are bit-identical before rounding. ``round`` is HALF_UP on the
decimal value (agrees with the SQL oracle; may differ by 1e-4 from a binary
round on exact ties).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import clamp01


def _col_or(df: DataFrame, name: str, default) -> Column:
    if name in df.columns:
        return F.coalesce(F.col(name).cast("double"), F.lit(float(default)))
    return F.lit(float(default))


def importance_raw(df: DataFrame, weights=None) -> Column:
    """A40 before clamping/rounding."""
    w = dict(P.IMPORTANCE_WEIGHTS, **(weights or {}))
    cred = clamp01(_col_or(df, "credibility_score", P.DEFAULT_CREDIBILITY))
    corr = clamp01(F.least(_col_or(df, "corroboration_count", P.DEFAULT_CORROBORATION) / F.lit(5.0), F.lit(1.0)))
    actor = clamp01(_col_or(df, "actor_significance", P.DEFAULT_ACTOR))
    nov = clamp01(_col_or(df, "novelty", P.DEFAULT_NOVELTY))
    return (F.lit(w["credibility"]) * cred + F.lit(w["corroboration"]) * corr
            + F.lit(w["actor_significance"]) * actor + F.lit(w["novelty"]) * nov)


def importance_score(df: DataFrame, weights=None) -> DataFrame:
    """Stored clamped and rounded to 4 decimals."""
    return df.withColumn("importance_score", F.round(clamp01(importance_raw(df, weights)), 4))


def risk_raw(df: DataFrame, risk_weights=None) -> Column:
    """Sum of weights of the article's known tags / sum of all weights;
    no tags or none known -> 0.3."""
    w = dict(P.RISK_WEIGHTS, **(risk_weights or {}))
    all_sum = 0.0
    for v in w.values():
        all_sum += v
    all_sum = all_sum or 1.0
    tag_w = F.create_map(*[x for tag, key in P.TAG_TO_RISK_KEY.items() if key in w
                           for x in (F.lit(tag), F.lit(float(w[key])))])
    tags = F.coalesce(F.col("pmesii_tags"), F.array().cast("array<string>")) \
        if "pmesii_tags" in df.columns else F.array().cast("array<string>")
    total = F.aggregate(tags, F.lit(0.0),
                        lambda acc, t: acc + F.coalesce(F.try_element_at(tag_w, t), F.lit(0.0)))
    return F.when(total == 0.0, F.lit(P.DEFAULT_RISK)).otherwise(clamp01(total / F.lit(all_sum)))


def risk_score(df: DataFrame, risk_weights=None) -> DataFrame:
    return df.withColumn("risk_score", F.round(clamp01(risk_raw(df, risk_weights)), 4))


def bias_adjusted_score(df: DataFrame, penalty: float = P.SINGLE_SOURCE_PENALTY, weights=None) -> DataFrame:
    """Importance × (1 − penalty) iff corroboration = 1, from the unrounded importance."""
    imp = importance_raw(df, weights)
    corr = _col_or(df, "corroboration_count", P.DEFAULT_CORROBORATION)
    adj = F.when(corr == 1.0, imp * F.lit(1 - penalty)).otherwise(imp)
    return df.withColumn("bias_adjusted_score", F.round(clamp01(adj), 4))


def score(df: DataFrame, rules: P.Rules = P.DEFAULT_RULES) -> DataFrame:
    """A40–A42 in one projection."""
    imp = importance_raw(df, rules.importance_weights)
    corr = _col_or(df, "corroboration_count", P.DEFAULT_CORROBORATION)
    adj = F.when(corr == 1.0, imp * F.lit(1 - rules.single_source_penalty)).otherwise(imp)
    return df.select("*",
                     F.round(clamp01(imp), 4).alias("importance_score"),
                     F.round(clamp01(risk_raw(df, rules.risk_weights)), 4).alias("risk_score"),
                     F.round(clamp01(adj), 4).alias("bias_adjusted_score"))


__all__ = ["importance_score", "risk_score", "bias_adjusted_score", "score", "importance_raw", "risk_raw"]
