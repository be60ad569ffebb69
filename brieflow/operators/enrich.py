"""Enrichment (A31–A38): domain scores, routing, themes, tags, actors,
entities and primary country.

Lexicons are config-size Python lists folded into the plan as literals, so
each operator is a narrow projection: no join, no shuffle, whole-stage
codegen. The lower-cased text is computed once as ``_text_lower``; Catalyst
keeps it as one projection because ``lower`` is not a cheap expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.lexicon import lexicon_hits
from brieflow.functions.text import article_text, effective_body, title_case
from brieflow.operators.text_join import as_often, few_patterns, pattern_rows, substring_join
from brieflow.session import broadcast_if_small

TEXT_LOWER = "_text_lower"

ENTITY_TYPE = "array<struct<text:string,label:string>>"


def with_text_lower(df: DataFrame) -> DataFrame:
    """Add ``_text_lower`` = lower(title + ' ' + (body or summary)) once."""
    if TEXT_LOWER in df.columns:
        return df
    return df.withColumn(TEXT_LOWER, F.lower(article_text()))


def sql_lit(value: str) -> str:
    """A SQL string literal (backslash and quote escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def jvm_cond(w: str) -> str:
    """``w`` occurs in the lower-cased text (one JVM scan per pattern)."""
    return f"contains({TEXT_LOWER}, {sql_lit(w)})"


def _count_sql(cond, words: list[str]) -> str:
    if not words:
        return "0"
    return "(" + " + ".join(f"CASE WHEN {cond(w.lower())} THEN 1 ELSE 0 END" for w in words) + ")"


def _any_sql(cond, words: list[str]) -> str:
    if not words:
        return "false"
    return "(" + " OR ".join(cond(w) for w in words) + ")"


def _full_text_patterns(topics, major, regional) -> list[str]:
    """Every pattern tested against the whole lower-cased text, deduplicated, in first-seen order."""
    seen: dict[str, None] = {}
    for _, kws, themes in topics:
        for k in kws:
            seen.setdefault(k.lower(), None)
        for th in themes:
            seen.setdefault(th.lower().replace("_", " "), None)
    for a in list(major) + list(regional):
        seen.setdefault(a, None)
    return list(seen)


def _counts_cols(topics, cond=jvm_cond) -> list[Column]:
    return [F.expr(_count_sql(cond, kws)).alias(f"_ds_{i}") for i, (_, kws, _) in enumerate(topics)]


def _scores_map_col(topics) -> Column:
    m = F.map_from_arrays(F.array(*[F.lit(d) for d, _, _ in topics]),
                          F.array(*[F.col(f"_ds_{i}") for i in range(len(topics))]))
    return F.map_filter(m, lambda k, v: v > 0)


def _route_col(has_domain: bool, topics, default=P.DEFAULT_DOMAIN) -> Column:
    best = F.greatest(*[F.struct(F.col(f"_ds_{i}").alias("s"), F.lit(-i).alias("o"), F.lit(d).alias("d"))
                        for i, (d, _, _) in enumerate(topics)])
    src = F.coalesce(F.col("domain"), F.lit("all")) if has_domain else F.lit("all")
    return (F.when((src != "") & (src != "all"), src)
            .when(best["s"] > 0, best["d"])
            .otherwise(F.lit(default)))


def _themes_col(topics, cond=jvm_cond) -> Column:
    branches = []
    for d, _, themes in topics:
        if not themes:
            continue
        items = ", ".join(f"CASE WHEN {cond(th.lower().replace('_', ' '))} THEN {sql_lit(th)} END" for th in themes)
        branches.append(f"WHEN primary_domain = {sql_lit(d)} THEN array_compact(array({items}))")
    if not branches:
        return F.array().cast("array<string>")
    return F.expr("CASE " + " ".join(branches) + " ELSE CAST(array() AS ARRAY<STRING>) END")


def _tags_col(mapping) -> Column:
    branches = " ".join(f"WHEN primary_domain = {sql_lit(d)} THEN array({', '.join(sql_lit(x) for x in tags)})"
                        for d, tags in mapping.items())
    return F.expr(f"CASE {branches} ELSE CAST(array() AS ARRAY<STRING>) END")


def _actor_col(major, regional, cond=jvm_cond) -> Column:
    return F.expr(f"CASE WHEN {_any_sql(cond, major)} THEN 0.9D "
                  f"WHEN {_any_sql(cond, regional)} THEN 0.7D ELSE 0.5D END")


def _entities_col(gazetteer, max_chars, labels, tagger) -> Column:
    head = F.substring(article_text(), 1, max_chars)
    if tagger is not None:
        return tagger(head)
    entries = [(s_, lab) for s_, lab in gazetteer if lab in set(labels)]
    if not entries:
        return F.array().cast(ENTITY_TYPE)
    head_lower = F.lower(head)

    def mentions(surface: str, label: str) -> Column:
        """Every mention: the pieces between the mentions give their places."""
        size = len(surface)
        gaps = F.transform(F.split(head_lower, "\\Q" + surface.lower() + "\\E", -1), lambda g: F.length(g))
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
        places = F.aggregate(gaps, start, lambda p, g: F.struct((p["at"] + g + size).alias("at"),
                                                                F.concat(p["found"], F.array(p["at"] + g)).alias("found")),
                             lambda p: F.slice(p["found"], F.lit(1), F.size(p["found"]) - 1))
        return F.transform(places, lambda p: F.struct(p.alias("pos"), F.substring(head, p, F.lit(size)).alias("text"),
                                                      F.lit(label).alias("label")))

    found = [mentions(s_, lab) for s_, lab in entries]
    return F.transform(F.array_sort(F.concat(*found)),
                       lambda e: F.struct(e["text"].alias("text"), e["label"].alias("label")))


def _country_col(has_entities: bool, countries, other=P.OTHER_COUNTRY) -> Column:
    if has_entities:
        gpe = F.try_element_at(F.filter(F.col("ner_entities"), lambda e: e["label"] == "GPE"), F.lit(1))
        first_gpe = title_case(gpe["text"])
    else:
        first_gpe = F.lit(None).cast("string")
    # Repeated sub-expression: whole-stage codegen evaluates it once per row.
    head = "lower(concat(coalesce(title, ''), ' ', substring(coalesce(body, ''), 1, 200)))"
    branches = " ".join(f"WHEN contains({head}, {sql_lit(k)}) THEN {sql_lit(lab)}" for k, lab in countries)
    return F.coalesce(first_gpe, F.expr(f"CASE {branches} ELSE {sql_lit(other)} END"))


def _hidden(topics):
    return [f"_ds_{i}" for i in range(len(topics))] + [TEXT_LOWER]


def domain_scores(df: DataFrame, topics=P.TOPICS) -> DataFrame:
    """``domain_scores`` MAP<STRING,INT> of domains with ≥ 1 keyword present
    (substring match), in lexicon order."""
    out = with_text_lower(df).select("*", *_counts_cols(topics))
    return out.select(*df.columns, _scores_map_col(topics).alias("domain_scores"))


def domain_scores_text(col="domain_scores") -> Column:
    """Stable text form ``domain:count,...`` (lexicon order) for comparisons."""
    return F.array_join(F.transform(F.map_entries(F.col(col)),
                                    lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), ",")


def route_domain(df: DataFrame, topics=P.TOPICS, default=P.DEFAULT_DOMAIN) -> DataFrame:
    """Source domain unless empty/``all``; else the top-scoring domain with ties
    going to the first in lexicon order; else ``politics``."""
    out = with_text_lower(df).select("*", *_counts_cols(topics))
    return out.select(*df.columns, _route_col("domain" in df.columns, topics, default).alias("primary_domain"))


def theme_match(df: DataFrame, topics=P.TOPICS) -> DataFrame:
    """Themes of the primary domain whose ``lower().replace('_',' ')`` occurs
    in the text, in list order; unknown domain -> []."""
    return with_text_lower(df).select(*df.columns, _themes_col(topics).alias("gdelt_themes"))


def pmesii_tags(df: DataFrame, mapping=P.DOMAIN_TAGS) -> DataFrame:
    """Domain -> category tags; unknown -> []."""
    return df.withColumn("pmesii_tags", _tags_col(mapping))


def actor_significance(df: DataFrame, major=P.MAJOR_ACTORS, regional=P.REGIONAL_ACTORS) -> DataFrame:
    """0.9 if any major actor is a substring, else 0.7 for a regional one, else 0.5."""
    return with_text_lower(df).select(*df.columns, _actor_col(major, regional).alias("actor_significance"))


def extract_entities(df: DataFrame, gazetteer=(), max_chars: int = 1000,
                     labels=P.ENTITY_LABELS, tagger=None) -> DataFrame:
    """A36 (re-aimed): entities ``{text,label}`` from the first ``max_chars`` characters
    of ``title + ' ' + (body or summary)``.

    ``gazetteer`` is a config-size list of ``(surface, label)``; a surface
    matches case-insensitively as a substring (every mention), entity text
    keeps the original casing, order is document position. ``tagger`` may be
    a pandas_udf returning the same array type (pluggable model).
    """
    return df.withColumn("ner_entities", _entities_col(gazetteer, max_chars, labels, tagger))


def extract_entities_table(df: DataFrame, gazetteer: DataFrame, max_chars: int = 1000, labels=P.ENTITY_LABELS,
                           longest_only: bool = False, key: str = "arr") -> DataFrame:
    """A36 with a table of surfaces (surface, label) of any size: (key, ner_entities) for every row of ``df``; ``key`` is unique.

    The same mentions in the same order as :func:`extract_entities` gives for a list. Texts' heads meet surfaces by rare trigrams
    (:func:`brieflow.operators.text_join.substring_join`), so no surface is part of the plan. With ``longest_only`` a mention inside a longer one is left out.
    """
    head = F.substring(article_text(), 1, max_chars)
    heads = df.select(F.col(key).alias("k"), head.alias("head")).withColumn("t", F.lower("head"))
    known = (gazetteer.select("surface", "label").filter(F.col("label").isin(list(labels)) & (F.col("surface") != "")).distinct()
             .withColumn("pattern", F.lower("surface")))
    labelled = known.select("pattern", "label").distinct()
    size = F.length("pattern")
    few = few_patterns(known)
    if few is not None:
        one = as_often(pattern_rows(heads, few, "head"), heads, 2).join(F.broadcast(labelled), "pattern").select("k", F.struct("pos", "text", "label").alias("e"))
    else:
        met = substring_join(heads, known, most=0).join(labelled, "pattern").join(heads, "k")
        # the pieces between the mentions give their places
        gaps = F.transform(F.split("t", F.concat(F.lit("\\Q"), F.replace("pattern", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")), -1), lambda g: F.length(g))
        start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("found"))
        places = F.aggregate(gaps, start, lambda a, g: F.struct((a["at"] + g + size).alias("at"), F.concat(a["found"], F.array(a["at"] + g)).alias("found")),
                             lambda a: F.slice(a["found"], F.lit(1), F.size(a["found"]) - 1))
        one = (met.select("k", "head", "label", size.alias("size"), F.explode(places).alias("pos"))
               .select("k", F.struct("pos", F.expr("substring(head, pos, size)").alias("text"), "label").alias("e")))
    # at most a head's mentions are gathered
    per = one.groupBy("k").agg(F.array_sort(F.collect_list("e")).alias("es"))
    if longest_only:
        def inside(e: Column) -> Column:
            end = e["pos"] + F.length(e["text"])
            return F.exists("es", lambda x: (F.length(x["text"]) > F.length(e["text"])) & (x["pos"] <= e["pos"]) & (x["pos"] + F.length(x["text"]) >= end))
        per = per.withColumn("es", F.filter("es", lambda e: ~inside(e)))
    entities = F.transform("es", lambda e: F.struct(e["text"].alias("text"), e["label"].alias("label")))
    out = df.select(F.col(key).alias("k")).join(per.select("k", entities.alias("ner_entities")), "k", "left")
    return out.select(F.col("k").alias(key), F.coalesce("ner_entities", F.array().cast(ENTITY_TYPE)).alias("ner_entities"))


def primary_country(df: DataFrame, countries=P.COUNTRY_KEYWORDS, other=P.OTHER_COUNTRY) -> DataFrame:
    """First GPE entity, title-cased; else the first *lexicon-order* key found in
    lower(title + ' ' + body[:200]) (summary not used); else ``Other``."""
    return df.withColumn("primary_country", _country_col("ner_entities" in df.columns, countries, other))


def keyword_match(df: DataFrame, topics=P.TOPICS) -> DataFrame:
    """One row (…, domain, keyword) per lexicon keyword contained in the text.

    The lexicon is config-size, so the theta join stays within a row: the literal array is filtered by
    ``contains`` and only the hits are exploded — no join, no shuffle, no copy of a text per keyword.
    """
    entries = ", ".join(f"named_struct('domain', {sql_lit(d)}, 'keyword', {sql_lit(k)}, 'low', {sql_lit(k.lower())})"
                        for d, kws, _ in topics for k in kws)
    table = F.expr(f"array({entries})")
    hits = F.get(F.transform(F.array(F.col(TEXT_LOWER)), lambda t: F.filter(table, lambda e: F.contains(t, e["low"]))), F.lit(0))
    # the hits are kept as a column of their own, so the text does not pass the explode
    out = with_text_lower(df).select(*df.columns, hits.alias("_hits")).select(*df.columns, F.explode("_hits").alias("_lex"))
    return out.select(*df.columns, F.col("_lex.domain").alias("domain_hit"), F.col("_lex.keyword").alias("keyword")) \
        .withColumnRenamed("domain_hit", "domain" if "domain" not in df.columns else "keyword_domain")


def keyword_match_table(df: DataFrame, lexicon: DataFrame, key: str = "arr") -> DataFrame:
    """A16 with a lexicon table (domain, keyword) of any size: (key, domain, keyword) for each of its rows whose keyword
    the lower-cased text contains; ``key`` is unique. Texts and keywords meet by trigrams, see
    :func:`brieflow.operators.text_join.substring_join`; null and empty keywords match nothing."""
    texts = df.select(F.col(key).alias("k"), F.lower(article_text()).alias("t"))
    known = lexicon.select("domain", "keyword", F.lower("keyword").alias("pattern"))
    return substring_join(texts, known).join(broadcast_if_small(known), "pattern").select(F.col("k").alias(key), "domain", "keyword")


def enrich(df: DataFrame, topics=P.TOPICS, gazetteer=(), tagger=None,
           countries=P.COUNTRY_KEYWORDS, keep_text_lower: bool = False) -> DataFrame:
    """A31–A37 as three projections, no shuffle, all in the JVM.

    Stage 1 tests every full-text pattern (keywords, theme phrases, actors) against the lower-case text,
    which is computed once, and keeps the numbers of those that occur. Stage 2: map, routing, actor,
    entities. Stage 3: themes, tags, country. Built with ``select`` so the analyzer sees each large
    expression once.
    """
    enriched = ["domain_scores", "primary_domain", "gdelt_themes", "pmesii_tags",
                "actor_significance", "ner_entities", "primary_country"]
    base_cols = [c for c in df.columns if c not in enriched and c != TEXT_LOWER]
    pats = _full_text_patterns(topics, P.MAJOR_ACTORS, P.REGIONAL_ACTORS)
    ids = {p: i for i, p in enumerate(pats)}

    def cond(w: str) -> str:
        return f"array_contains(_hits, {ids[w]})"

    low = df.select(*base_cols, F.lower(article_text()).alias(TEXT_LOWER))
    s1 = low.select(*base_cols, lexicon_hits(F.col(TEXT_LOWER), pats).alias("_hits"))
    carry = ["_hits"]
    s1 = s1.select("*", *_counts_cols(topics, cond))
    s2 = s1.select(*base_cols, *carry,
                   _scores_map_col(topics).alias("domain_scores"),
                   _route_col("domain" in base_cols, topics).alias("primary_domain"),
                   _actor_col(P.MAJOR_ACTORS, P.REGIONAL_ACTORS, cond).alias("actor_significance"),
                   _entities_col(gazetteer, 1000, P.ENTITY_LABELS, tagger).alias("ner_entities"))
    keep = [F.lower(article_text()).alias(TEXT_LOWER)] if keep_text_lower else []
    return s2.select(*base_cols, *keep, "domain_scores", "primary_domain",
                     _themes_col(topics, cond).alias("gdelt_themes"),
                     _tags_col(P.DOMAIN_TAGS).alias("pmesii_tags"),
                     "actor_significance", "ner_entities",
                     _country_col(True, countries).alias("primary_country"))


__all__ = [
    "with_text_lower", "domain_scores", "domain_scores_text", "route_domain", "theme_match",
    "pmesii_tags", "actor_significance", "extract_entities", "primary_country", "enrich",
    "effective_body",
]
