"""Registered queries: ``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.

Names start with the operator id of the inventory. Every query reads the
driver tables (whole tables, whole texts) or data Spark derives from them.
Computed columns carry the same alias on both sides; arrays and maps are
rendered as ordered strings so value hashes are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import article_id, article_text, canonical_url, effective_body, entry_url
from brieflow.functions.time import parse_published
from brieflow.operators import dedup, enrich, ingest, score, select
from brieflow.operators.election import leader_election
from brieflow.operators.similarity import cosine_pairs, hamming_pairs, simhash64
from brieflow.plans import fixtures as FX
from brieflow.plans import oracle as O
from brieflow.plans.briefing import briefing
from brieflow.sources.testbed import articles, embeddings_for, source_registry, table

L3_TEST_THRESHOLD = 0.40  # 0.85 finds no pair in the driver vectors (max cosine ~0.5-0.6)

QUERIES: dict[str, tuple] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def _fresh(spark, sf_dir) -> DataFrame:
    return ingest.min_length_filter(ingest.freshness_filter(articles(spark, sf_dir)))


def _arr_list(df: DataFrame) -> DataFrame:
    return df.select("arr")


BASE = O.articles_cte()
FRESH = O.fresh_cte()


# ---------------------------------------------------------------------------
# A51 flagship and dedup
# ---------------------------------------------------------------------------

BRIEF_COLS = ["rank", "arr", "id", "primary_domain", "primary_country", "corroboration_count",
              "importance_score", "risk_score", "bias_adjusted_score", "is_fringe"]


def _brief_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("rank").cast("bigint").alias("rank"), *BRIEF_COLS[1:])


@register("a51_briefing", O.with_(BASE, FRESH, O.cascade_ctes("fresh"), O.enrich_ctes("surv"),
                                  O.score_ctes("enr"), O.select_ctes("sc"))
          + f"SELECT {', '.join(BRIEF_COLS)} FROM ranked")
def q_briefing(spark, sf_dir):
    return _brief_out(briefing(articles(spark, sf_dir), embeddings_for(spark, sf_dir)))


def _cascade(spark, sf_dir, threshold=L3_TEST_THRESHOLD, transitive=False):
    rules = P.Rules(cosine_threshold=threshold, transitive_counts=transitive)
    return dedup.dedup_cascade(_fresh(spark, sf_dir), embeddings_for(spark, sf_dir), rules, return_tables=True)


@register("a29_dedup_cascade", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + "SELECT arr, story_id, corroboration_count FROM surv")
def q_cascade(spark, sf_dir):
    out, _ = _cascade(spark, sf_dir)
    return out.select("arr", "story_id", "corroboration_count")


@register("a29_dedup_cascade_transitive",
          O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD, transitive=True))
          + "SELECT arr, story_id, corroboration_count FROM surv")
def q_cascade_t(spark, sf_dir):
    out, _ = _cascade(spark, sf_dir, transitive=True)
    return out.select("arr", "story_id", "corroboration_count")


@register("a27_story_map", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + "SELECT id, story_id FROM smap")
def q_story_map(spark, sf_dir):
    _, t = _cascade(spark, sf_dir)
    return t["story_map"].select("id", "story_id")


@register("a28_corroboration_count", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + "SELECT story_id, corroboration_count FROM counts")
def q_counts(spark, sf_dir):
    _, t = _cascade(spark, sf_dir)
    return t["counts"].select("story_id", F.col("corroboration_count").cast("bigint"))


@register("a19_attach_story", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + "SELECT f.arr, coalesce(m.story_id, f.id) AS story_id FROM fresh f LEFT JOIN smap m ON m.id = f.id")
def q_attach(spark, sf_dir):
    fresh = _fresh(spark, sf_dir)
    _, t = dedup.dedup_cascade(fresh, embeddings_for(spark, sf_dir), P.Rules(cosine_threshold=L3_TEST_THRESHOLD),
                               return_tables=True)
    return dedup.attach_story(fresh.select("arr", "id"), t["story_map"]).select("arr", "story_id")


PAGES_COPIES = """pg AS (
  SELECT page_id AS arr, url FROM pages
  UNION ALL SELECT page_id + 1000000000 AS arr, upper(url) AS url FROM pages
  UNION ALL SELECT page_id + 2000000000 AS arr, '  ' || url || ' ' AS url FROM pages)"""


def _pages_with_copies(spark, sf_dir):
    pg = table(spark, sf_dir, "pages")
    return (pg.select(F.col("page_id").alias("arr"), "url")
            .unionByName(pg.select((F.col("page_id") + 1_000_000_000).alias("arr"), F.upper("url").alias("url")))
            .unionByName(pg.select((F.col("page_id") + 2_000_000_000).alias("arr"),
                                   F.concat(F.lit("  "), F.col("url"), F.lit(" ")).alias("url"))))


@register("a21_l1_url_dedup", O.with_(PAGES_COPIES, O.l1_cte("(SELECT arr, NULL AS id, url FROM pg)"))
          + "SELECT arr, url_hash, l1_keep FROM l1")
def q_l1(spark, sf_dir):
    return dedup.l1_url_dedup(_pages_with_copies(spark, sf_dir)).select("arr", "url_hash", "l1_keep")


@register("a22_simhash", O.with_(BASE, O.simhash_ctes("articles")) + "SELECT arr, simhash FROM fp")
def q_simhash(spark, sf_dir):
    return simhash64(articles(spark, sf_dir))


@register("a17_hamming_pairs", O.with_(BASE, O.simhash_ctes("articles"))
          + f"""SELECT a.simhash AS fp_a, b.simhash AS fp_b, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS dist
FROM (SELECT DISTINCT simhash FROM fp) a JOIN (SELECT DISTINCT simhash FROM fp) b
  ON a.simhash < b.simhash AND bit_count(xor(a.simhash, b.simhash)) <= {P.SIMHASH_MAX_DISTANCE}""")
def q_hamming(spark, sf_dir):
    return hamming_pairs(simhash64(articles(spark, sf_dir)), P.SIMHASH_MAX_DISTANCE)


@register("a17_hamming_pairs_wide_blocks", QUERIES["a17_hamming_pairs"][1])
def q_hamming_wide(spark, sf_dir):
    # same pairs with 8 blocks (70 four-block keys): the large-scale layout
    return hamming_pairs(simhash64(articles(spark, sf_dir)), P.SIMHASH_MAX_DISTANCE, blocks=8)


@register("a24_l2_near_dup", O.with_(BASE, O.simhash_ctes("articles"), "fpn AS (SELECT arr, simhash AS k FROM fp)",
                                     O.first_fit_ctes("ff2", "fpn", "BIGINT", O.HAMMING_NEAR))
          + "SELECT arr, leader AS l2_leader_arr FROM ff2")
def q_l2(spark, sf_dir):
    return dedup.l2_near_dup(articles(spark, sf_dir)).select("arr", "l2_leader_arr")


DOCS_AS_ARTICLES = """docart AS (SELECT doc_id AS arr, '' AS title, coalesce(text, '') AS body, '' AS summary
  FROM documents)"""


@register("a26_leader_election", O.with_(DOCS_AS_ARTICLES, O.simhash_ctes("docart"),
                                         "fpn AS (SELECT arr, simhash AS k FROM fp)",
                                         O.first_fit_ctes("ff", "fpn", "BIGINT", O.HAMMING_NEAR))
          + "SELECT arr AS node, leader FROM ff")
def q_election(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("arr"), F.lit("").alias("title"), F.coalesce("text", F.lit("")).alias("body"),
        F.lit("").alias("summary"))
    res = dedup.l2_near_dup(docs)
    return res.select(F.col("arr").alias("node"), F.col("l2_leader_arr").alias("leader"))


@register("a18_cosine_pairs", f"""SELECT a.vec_id AS a, b.vec_id AS b,
  round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cos
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= {O.dbl(L3_TEST_THRESHOLD)}""")
def q_cosine(spark, sf_dir):
    v = embeddings_for(spark, sf_dir)
    return cosine_pairs(v, L3_TEST_THRESHOLD).select("a", "b", F.round("cos", 6).alias("cos"))


@register("a25_l3_semantic_dup", O.with_("vec AS (SELECT vec_id AS arr, embedding AS k FROM embeddings)",
                                         O.first_fit_ctes("ff3", "vec", "FLOAT[]", O.cosine_near(L3_TEST_THRESHOLD)))
          + "SELECT arr, leader AS l3_leader_arr FROM ff3")
def q_l3(spark, sf_dir):
    v = embeddings_for(spark, sf_dir)
    return dedup.l3_semantic_dup(v.select("arr"), v, L3_TEST_THRESHOLD).select("arr", "l3_leader_arr")


# ---------------------------------------------------------------------------
# Ingest
# ---------------------------------------------------------------------------

@register("a12_freshness_filter", O.with_(BASE) + f"""SELECT arr FROM articles
WHERE published_at >= (SELECT max(published_at) FROM articles) - INTERVAL {P.MAX_AGE_HOURS} HOUR""")
def q_fresh(spark, sf_dir):
    return _arr_list(ingest.freshness_filter(articles(spark, sf_dir)))


@register("a13_min_length_filter", O.with_(BASE) + f"""SELECT arr FROM articles
WHERE length(coalesce(nullif(body, ''), summary, '')) >= {P.MIN_ARTICLE_CHARS}""")
def q_minlen(spark, sf_dir):
    return _arr_list(ingest.min_length_filter(articles(spark, sf_dir)))


@register("a14_project_articles", O.with_(BASE) + """SELECT arr, id, url, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS title,
  source_id, source_name, domain, bias_rating, factual_rating, credibility_score, 'en' AS language, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published
FROM articles""")
def q_project(spark, sf_dir):
    a = ingest.project_articles(articles(spark, sf_dir), source_registry(table(spark, sf_dir, "documents")).drop("feed_url", "active")
                                .withColumn("language", F.lit(None).cast("string")))
    return a.select("arr", "id", "url", "title", "source_id", "source_name", "domain", "bias_rating",
                    "factual_rating", "credibility_score", "language",
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"))


@register("a15_article_text", O.with_(BASE) + """SELECT arr,
  md5(coalesce(title, '') || ' ' || coalesce(nullif(body, ''), summary, '')) AS text_md5,
  CAST(length(coalesce(title, '') || ' ' || coalesce(nullif(body, ''), summary, '')) AS INTEGER) AS text_len
FROM articles""")
def q_text(spark, sf_dir):
    t = article_text()
    return articles(spark, sf_dir).select("arr", F.md5(t).alias("text_md5"), F.length(t).alias("text_len"))


@register("a08_canonical_url", """SELECT page_id,
  lower(regexp_replace(coalesce(url, ''), '^\\s+|\\s+$', '', 'g')) AS canonical_url,
  sha256(lower(regexp_replace(coalesce(url, ''), '^\\s+|\\s+$', '', 'g'))) AS article_id FROM pages""")
def q_canon(spark, sf_dir):
    pg = table(spark, sf_dir, "pages")
    return pg.select("page_id", canonical_url("url").alias("canonical_url"), article_id("url").alias("article_id"))


@register("a10_entry_url", """SELECT page_id,
  regexp_replace(coalesce(nullif(CASE WHEN contains(url, '?') THEN '' ELSE url END, ''), ' ' || url || ' ', ''),
                 '^\\s+|\\s+$', '', 'g') AS url
FROM pages""")
def q_entry_url(spark, sf_dir):
    pg = table(spark, sf_dir, "pages")
    entries = pg.select("page_id",
                        F.when(F.contains("url", F.lit("?")), F.lit("")).otherwise(F.col("url")).alias("link"),
                        F.array(F.struct(F.concat(F.lit(" "), F.col("url"), F.lit(" ")).alias("href"))).alias("links"))
    out = entries.select("page_id", entry_url("link", "links").alias("url"))
    return ingest.drop_missing_url(out)


@register("a11_parse_published", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS published
FROM events""")
def q_parse(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    raw = (F.when(F.col("event_type") == "click",
                  F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000")))
           .when(F.col("event_type") == "view", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
           .when(F.col("event_type") == "error", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
           .otherwise(F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" GMT"))))
    parsed = parse_published(published=raw, updated=F.lit(None).cast("string"))
    return ev.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("published"))


@register("a44_feed_cap", f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
FROM documents) WHERE rn <= {P.MAX_ARTICLES_PER_FEED}""")
def q_feed_cap(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"),
                                                 F.col("doc_id").alias("pos"))
    return ingest.feed_cap(d).select("doc_id")


@register("a44_feed_cap_10", """SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
FROM documents) WHERE rn <= 10""")
def q_feed_cap10(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_id"),
                                                 F.col("doc_id").alias("pos"))
    return ingest.feed_cap(d, 10).select("doc_id")


@register("a07_run_stats", O.with_(BASE, FRESH) + f"""SELECT 'articles' AS stage, count(*) AS rows FROM articles
UNION ALL SELECT 'fresh', count(*) FROM articles
  WHERE published_at >= (SELECT max(published_at) FROM articles) - INTERVAL {P.MAX_AGE_HOURS} HOUR
UNION ALL SELECT 'long_enough', count(*) FROM fresh""")
def q_stats(spark, sf_dir):
    a = articles(spark, sf_dir)
    newest = ingest.run_ts_of(a)
    fresh = F.col("published_at") >= newest - F.make_interval(hours=F.lit(P.MAX_AGE_HOURS))
    long_enough = F.length(effective_body()) >= P.MIN_ARTICLE_CHARS
    return ingest.run_stats(a, articles=F.lit(True), fresh=fresh, long_enough=fresh & long_enough)


@register("a07_run_stats_observed", QUERIES["a07_run_stats"][1])
def q_stats_observed(spark, sf_dir):
    """The counts of the stages themselves, taken while they run into a table."""
    from brieflow.session import scratch_path
    stats = ingest.RunStats()
    a = stats.watch("articles", articles(spark, sf_dir).select("arr", "published_at", "body", "summary"))
    newest = articles(spark, sf_dir).agg(F.max("published_at")).first()[0]
    fresh = stats.watch("fresh", ingest.freshness_filter(a, newest))
    done = stats.watch("long_enough", ingest.min_length_filter(fresh))
    done.write.parquet(scratch_path(spark, "observed"))
    return stats.table(spark).select("stage", "rows")


# ---------------------------------------------------------------------------
# Enrichment and scoring (all articles, corroboration 1)
# ---------------------------------------------------------------------------

CORPUS_TOPICS = FX.topics_with_corpus_themes(P.TOPICS)


def _enriched(spark, sf_dir, **kw):
    return enrich.enrich(articles(spark, sf_dir), **kw)


def _str_cols():
    return dict(
        domain_scores_s=enrich.domain_scores_text("domain_scores"),
        gdelt_themes=F.array_join("gdelt_themes", ","),
        pmesii_tags=F.array_join("pmesii_tags", ","),
        entities_s=F.array_join(F.transform("ner_entities", lambda e: F.concat(e["text"], F.lit(":"), e["label"])), "|"),
    )


ENR_SQL = O.with_(BASE, O.enrich_ctes("articles"))
ENR_CORPUS_SQL = O.with_(BASE, O.enrich_ctes("articles", topics=CORPUS_TOPICS, gazetteer=FX.CORPUS_GAZETTEER,
                                             countries=FX.CORPUS_COUNTRIES))


@register("a31_domain_scores", ENR_SQL + "SELECT arr, domain_scores_s FROM enr")
def q_ds(spark, sf_dir):
    d = enrich.domain_scores(articles(spark, sf_dir))
    return d.select("arr", enrich.domain_scores_text().alias("domain_scores_s"))


@register("a32_route_domain", ENR_SQL + "SELECT arr, primary_domain FROM enr")
def q_route(spark, sf_dir):
    return enrich.route_domain(articles(spark, sf_dir)).select("arr", "primary_domain")


@register("a33_theme_match", ENR_CORPUS_SQL
          + "SELECT arr, primary_domain, array_to_string(gdelt_themes, ',') AS gdelt_themes FROM enr")
def q_themes(spark, sf_dir):
    d = enrich.route_domain(articles(spark, sf_dir), CORPUS_TOPICS)
    d = enrich.theme_match(d, CORPUS_TOPICS)
    return d.select("arr", "primary_domain", _str_cols()["gdelt_themes"].alias("gdelt_themes"))


@register("a34_pmesii_tags", ENR_SQL + "SELECT arr, array_to_string(pmesii_tags, ',') AS pmesii_tags FROM enr")
def q_tags(spark, sf_dir):
    d = enrich.pmesii_tags(enrich.route_domain(articles(spark, sf_dir)))
    return d.select("arr", _str_cols()["pmesii_tags"].alias("pmesii_tags"))


@register("a35_actor_significance", ENR_SQL + "SELECT arr, actor_significance FROM enr")
def q_actor(spark, sf_dir):
    return enrich.actor_significance(articles(spark, sf_dir)).select("arr", "actor_significance")


@register("a36_extract_entities", ENR_CORPUS_SQL + "SELECT arr, entities_s FROM enr")
def q_ents(spark, sf_dir):
    d = enrich.extract_entities(articles(spark, sf_dir), FX.CORPUS_GAZETTEER)
    return d.select("arr", _str_cols()["entities_s"].alias("entities_s"))


@register("a37_primary_country", ENR_CORPUS_SQL + "SELECT arr, primary_country FROM enr")
def q_country(spark, sf_dir):
    d = enrich.extract_entities(articles(spark, sf_dir), FX.CORPUS_GAZETTEER)
    return enrich.primary_country(d, FX.CORPUS_COUNTRIES).select("arr", "primary_country")


@register("a37_primary_country_shipped", ENR_SQL + "SELECT arr, primary_country FROM enr")
def q_country_shipped(spark, sf_dir):
    return enrich.primary_country(articles(spark, sf_dir)).select("arr", "primary_country")


ENRICH_COLS_SQL = """SELECT arr, domain_scores_s, primary_domain, array_to_string(gdelt_themes, ',') AS gdelt_themes,
  array_to_string(pmesii_tags, ',') AS pmesii_tags, actor_significance, entities_s, primary_country FROM enr"""


@register("a38_enrich", ENR_CORPUS_SQL + ENRICH_COLS_SQL)
def q_enrich(spark, sf_dir):
    d = _enriched(spark, sf_dir, topics=CORPUS_TOPICS, gazetteer=FX.CORPUS_GAZETTEER, countries=FX.CORPUS_COUNTRIES)
    s = _str_cols()
    return d.select("arr", s["domain_scores_s"].alias("domain_scores_s"), "primary_domain",
                    s["gdelt_themes"].alias("gdelt_themes"), s["pmesii_tags"].alias("pmesii_tags"),
                    "actor_significance", s["entities_s"].alias("entities_s"), "primary_country")


SCORE_SQL = O.with_(BASE, O.enrich_ctes("articles"), O.score_ctes("enr", with_corr=False))


@register("a43_score", SCORE_SQL + "SELECT arr, importance_score, risk_score, bias_adjusted_score FROM sc")
def q_score(spark, sf_dir):
    return score.score(_enriched(spark, sf_dir)).select("arr", "importance_score", "risk_score",
                                                        "bias_adjusted_score")


@register("a40_importance_score", SCORE_SQL + "SELECT arr, importance_score FROM sc")
def q_imp(spark, sf_dir):
    return score.importance_score(_enriched(spark, sf_dir)).select("arr", "importance_score")


@register("a41_risk_score", SCORE_SQL + "SELECT arr, risk_score FROM sc")
def q_risk(spark, sf_dir):
    return score.risk_score(_enriched(spark, sf_dir)).select("arr", "risk_score")


@register("a42_bias_adjusted_score", SCORE_SQL + "SELECT arr, bias_adjusted_score FROM sc")
def q_adj(spark, sf_dir):
    return score.bias_adjusted_score(_enriched(spark, sf_dir)).select("arr", "bias_adjusted_score")


# ---------------------------------------------------------------------------
# Selection (all articles, corpus countries so the cap bites)
# ---------------------------------------------------------------------------

SEL_BASE = O.with_(BASE, O.enrich_ctes("articles", countries=FX.CORPUS_COUNTRIES),
                   O.score_ctes("enr", with_corr=False), O.select_ctes("sc", with_corr=False))


def _scored_all(spark, sf_dir):
    return score.score(_enriched(spark, sf_dir, countries=FX.CORPUS_COUNTRIES))


@register("a45_min_score_filter", SEL_BASE + "SELECT arr FROM cands")
def q_minscore(spark, sf_dir):
    return select.min_score_filter(_scored_all(spark, sf_dir)).select("arr")


@register("a46_top_n_per_domain", SEL_BASE + """SELECT t.arr, t.primary_domain, d.domain_first_arr
FROM top_n t JOIN dom_first d ON d.pdom = coalesce(t.primary_domain, 'politics')""")
def q_topn(spark, sf_dir):
    c = select.candidates(_scored_all(spark, sf_dir))
    return select.top_n_per_domain(c).select("arr", "primary_domain", "domain_first_arr")


@register("a47_country_cap", SEL_BASE + "SELECT arr, primary_country FROM capped")
def q_cap(spark, sf_dir):
    c = select.candidates(_scored_all(spark, sf_dir))
    return select.country_cap(select.top_n_per_domain(c)).select("arr", "primary_country")


@register("a48_best_fringe", SEL_BASE + "SELECT arr FROM fringe")
def q_fringe(spark, sf_dir):
    c = select.candidates(_scored_all(spark, sf_dir))
    capped = select.country_cap(select.top_n_per_domain(c))
    return select.best_fringe(c, capped).select("arr")


@register("a50_select", SEL_BASE + """SELECT rank, arr, primary_domain, primary_country, bias_adjusted_score, is_fringe
FROM ranked""")
def q_select(spark, sf_dir):
    r = select.select(_scored_all(spark, sf_dir))
    return r.select(F.col("rank").cast("bigint").alias("rank"), "arr", "primary_domain", "primary_country",
                    "bias_adjusted_score", "is_fringe")


@register("a16_keyword_match", O.with_(BASE, "lex AS (SELECT * FROM (VALUES " + ", ".join(
    f"({O.sql_lit(d)}, {O.sql_lit(k)})" for d, kws, _ in P.TOPICS for k in kws) + ") t(domain, keyword))")
    + """SELECT a.arr, l.domain, l.keyword FROM articles a JOIN lex l
ON contains(lower(coalesce(a.title, '') || ' ' || coalesce(nullif(a.body, ''), a.summary, '')), lower(l.keyword))""")
def q_kw(spark, sf_dir):
    a = articles(spark, sf_dir).select("arr", "title", "body", "summary")
    return enrich.keyword_match(a).select("arr", "domain", "keyword")


# A16 and A36 with tables: every word of the benchmark items is a keyword and, from four letters on, a surface.

WORDS_SQL = """words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\\p{L}]+')) AS w FROM benchmark)"""


def _benchmark_words(spark, sf_dir) -> DataFrame:
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}]+"), F.lit(0))
    return table(spark, sf_dir, "benchmark").select(F.explode(words).alias("w")).distinct()


@register("a16_keyword_match_table", O.with_(BASE, WORDS_SQL) + """SELECT a.arr, 'd' || (length(w) % 3) AS domain, w AS keyword
FROM articles a JOIN words ON contains(lower(coalesce(a.title, '') || ' ' || coalesce(nullif(a.body, ''), a.summary, '')), lower(w))""")
def q_kw_table(spark, sf_dir):
    lexicon = _benchmark_words(spark, sf_dir).select(F.concat(F.lit("d"), F.length("w") % 3).alias("domain"), F.col("w").alias("keyword"))
    return enrich.keyword_match_table(articles(spark, sf_dir), lexicon)


ENTITY_TABLE_SQL = O.with_(BASE, WORDS_SQL, """h AS (SELECT arr, substring(coalesce(title, '') || ' ' || coalesce(nullif(body, ''), summary, ''), 1, 1000) AS head FROM articles)""",
    """s AS (SELECT DISTINCT lower(w) AS w, CASE WHEN length(w) % 2 = 0 THEN 'GPE' ELSE 'ORG' END AS label FROM words WHERE length(w) >= 4)""",
    """m AS (SELECT arr, head, label, length(w) AS size, string_split(lower(head), w) AS p FROM h JOIN s ON contains(lower(head), w))""",
    """e AS (SELECT arr, label, size, head, 1 + list_sum(list_transform(p[1:i], lambda x: length(x))) + (i - 1) * size AS pos
  FROM (SELECT *, unnest(range(1, len(p))) AS i FROM m))""",
    """l AS (SELECT arr, list_sort(list({'pos': CAST(pos AS BIGINT), 'text': substring(head, CAST(pos AS BIGINT), size), 'label': label})) AS es FROM e GROUP BY arr)""")


@register("a36_extract_entities_table", ENTITY_TABLE_SQL + """SELECT arr,
  coalesce(array_to_string(list_transform(es, lambda x: x.text || ':' || x.label), '|'), '') AS entities_s FROM articles LEFT JOIN l USING (arr)""")
def q_ents_table(spark, sf_dir):
    gazetteer = (_benchmark_words(spark, sf_dir).filter(F.length("w") >= 4)
                 .select(F.col("w").alias("surface"), F.when(F.length("w") % 2 == 0, "GPE").otherwise("ORG").alias("label")))
    d = enrich.extract_entities_table(articles(spark, sf_dir), gazetteer)
    return d.select("arr", _str_cols()["entities_s"].alias("entities_s"))


# ---------------------------------------------------------------------------
# Sources and declared operators
# ---------------------------------------------------------------------------

from brieflow.operators import declared as D  # noqa: E402
from brieflow.sources.testbed import source_registry  # noqa: E402


@register("a01_source_registry", O.with_(O.reg_cte()) + """SELECT source_id, source_name, domain, bias_rating,
  factual_rating, credibility_score FROM reg""")
def q_registry(spark, sf_dir):
    reg = source_registry(table(spark, sf_dir, "documents"))
    return reg.filter(F.coalesce("active", F.lit(True))).select(
        "source_id", "source_name", "domain", "bias_rating", "factual_rating", "credibility_score")


@register("b03_rating_to_credibility", O.with_(O.reg_cte()) + f"""SELECT source_id,
  coalesce(CASE lower(factual_rating) {' '.join(f"WHEN {O.sql_lit(k)} THEN {O.dbl(v)}" for k, v in P.RATING_SCORES.items())}
           END, {O.dbl(P.DEFAULT_CREDIBILITY)}) AS credibility_from_rating,
  coalesce(CASE WHEN bias_rating = 'left' THEN NULL ELSE credibility_score END,
           CASE lower(factual_rating) {' '.join(f"WHEN {O.sql_lit(k)} THEN {O.dbl(v)}" for k, v in P.RATING_SCORES.items())}
           END, {O.dbl(P.DEFAULT_CREDIBILITY)}) AS credibility_resolved
FROM reg""")
def q_b03(spark, sf_dir):
    reg = source_registry(table(spark, sf_dir, "documents"))
    reg = reg.withColumn("credibility_score", F.when(F.col("bias_rating") == "left", F.lit(None))
                         .otherwise(F.col("credibility_score")))
    return D.rating_to_credibility(reg).select("source_id", "credibility_from_rating", "credibility_resolved")


@register("b04_credibility_gate", O.with_(BASE, FRESH)
          + f"SELECT arr FROM fresh WHERE coalesce(credibility_score, 0.5) >= {O.dbl(P.MIN_FACTUAL_SCORE)}")
def q_b04(spark, sf_dir):
    return D.credibility_gate(_fresh(spark, sf_dir)).select("arr")


@register("b04_story_sources", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + f"""SELECT coalesce(m.story_id, f.id) AS story_id, count(*) AS n_articles,
  count(DISTINCT f.source_id) AS n_sources, count(DISTINCT f.source_id) >= {P.CORROBORATION_MIN_SOURCES} AS corroborated
FROM fresh f LEFT JOIN smap m ON m.id = f.id GROUP BY 1""")
def q_b04s(spark, sf_dir):
    fresh = _fresh(spark, sf_dir)
    _, t = dedup.dedup_cascade(fresh, embeddings_for(spark, sf_dir), P.Rules(cosine_threshold=L3_TEST_THRESHOLD),
                               return_tables=True)
    return D.story_sources(dedup.attach_story(fresh.select("arr", "id", "source_id"), t["story_map"]))


@register("b05_story_window", O.with_(BASE, O.simhash_ctes("articles"))
          + f"""SELECT e.u, e.v FROM (
  SELECT DISTINCT least(ra.rep, rb.rep) AS u, greatest(ra.rep, rb.rep) AS v
  FROM (SELECT simhash, min(arr) AS rep FROM fp GROUP BY simhash) ra
  JOIN (SELECT simhash, min(arr) AS rep FROM fp GROUP BY simhash) rb
    ON ra.simhash < rb.simhash AND bit_count(xor(ra.simhash, rb.simhash)) <= {P.SIMHASH_MAX_DISTANCE}) e
JOIN articles a ON a.arr = e.u JOIN articles b ON b.arr = e.v
WHERE abs(epoch_us(a.published_at) - epoch_us(b.published_at)) <= {P.STORY_WINDOW_HOURS * 3600 * 1_000_000}""")
def q_b05(spark, sf_dir):
    a = articles(spark, sf_dir)
    fps = simhash64(a)
    reps = fps.groupBy("simhash").agg(F.min("arr").alias("rep"))
    pairs = hamming_pairs(fps)
    ra = reps.select(F.col("simhash").alias("fp_a"), F.col("rep").alias("ra"))
    rb = reps.select(F.col("simhash").alias("fp_b"), F.col("rep").alias("rb"))
    edges = pairs.join(ra, "fp_a").join(rb, "fp_b").select(F.least("ra", "rb").alias("u"),
                                                            F.greatest("ra", "rb").alias("v")).distinct()
    return D.story_window(edges, a)


# The window held against every member before leaders are elected (first-fit over articles, not over fingerprints), on all
# articles: copies and near copies days apart are stories of their own.

@register("b05_story_leaders", O.with_(
    BASE, O.simhash_ctes("articles"), "fpn AS (SELECT arr, {'x': simhash, 't': epoch_us(published_at)} AS k FROM fp JOIN articles USING (arr))",
    O.first_fit_ctes("ff2", "fpn", "STRUCT(x BIGINT, t BIGINT)", O.within(O.HAMMING_NEAR, P.STORY_WINDOW_HOURS))) + "SELECT arr, leader AS l2_leader_arr FROM ff2")
def q_b05_leaders(spark, sf_dir):
    return dedup.l2_near_dup(articles(spark, sf_dir), window_hours=P.STORY_WINDOW_HOURS).select("arr", "l2_leader_arr")


@register("a29_dedup_cascade_windowed", O.with_(BASE, O.cascade_ctes("articles", L3_TEST_THRESHOLD, window_hours=P.STORY_WINDOW_HOURS))
          + "SELECT arr, story_id, corroboration_count FROM surv")
def q_cascade_windowed(spark, sf_dir):
    rules = P.Rules(cosine_threshold=L3_TEST_THRESHOLD, window_stories=True)
    out = dedup.dedup_cascade(articles(spark, sf_dir), embeddings_for(spark, sf_dir), rules)
    return out.select("arr", "story_id", "corroboration_count")


@register("b06_domain_age_gate", O.with_(BASE) + f"""SELECT a.arr, lower(split_part(split_part(a.url, '://', 2), '/', 1)) AS host,
  CAST(datediff('day', h.first_seen, (SELECT max(published_at) FROM articles)) AS INTEGER) AS host_age_days,
  coalesce(datediff('day', h.first_seen, (SELECT max(published_at) FROM articles)) >= {P.DOMAIN_AGE_MIN_DAYS}, false)
    AS domain_age_ok
FROM articles a LEFT JOIN (SELECT lower(split_part(split_part(url, '://', 2), '/', 1)) AS host,
  min(published_at) AS first_seen FROM articles GROUP BY 1) h
  ON h.host = lower(split_part(split_part(a.url, '://', 2), '/', 1))""")
def q_b06(spark, sf_dir):
    a = articles(spark, sf_dir)
    out = D.domain_age_gate(a, a, ingest.run_ts_of(a))
    return out.select("arr", "host", "host_age_days", "domain_age_ok")


@register("b07_novelty", f"""SELECT a.vec_id AS arr,
  round(CASE WHEN max(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) IS NULL
             THEN {O.dbl(P.DEFAULT_NOVELTY)}
             ELSE greatest(0.0, least(1.0, 1 - max(list_dot_product(CAST(a.embedding AS DOUBLE[]),
                                                                   CAST(b.embedding AS DOUBLE[]))))) END, 6) AS novelty
FROM embeddings a LEFT JOIN embeddings b ON b.label = a.label AND b.vec_id < a.vec_id
GROUP BY a.vec_id""")
def q_b07(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("arr"), "embedding", "label")
    out = D.novelty(e, e, part_col="label", earlier_only=True)
    return out.select("arr", F.round("novelty", 6).alias("novelty"))


@register("b08_chunk_text", f"""SELECT doc_id, CAST(i AS INTEGER) AS chunk_no,
  CAST(i * {P.CHUNK_SIZE_CHARS - P.CHUNK_OVERLAP_CHARS} + 1 AS INTEGER) AS chunk_start,
  md5(substring(coalesce(text, ''), CAST(i * {P.CHUNK_SIZE_CHARS - P.CHUNK_OVERLAP_CHARS} + 1 AS BIGINT),
                {P.CHUNK_SIZE_CHARS})) AS chunk_md5
FROM (SELECT doc_id, text, unnest(range(0, CAST(greatest(0, ceil((length(coalesce(text, '')) - {P.CHUNK_SIZE_CHARS})
      / {O.dbl(P.CHUNK_SIZE_CHARS - P.CHUNK_OVERLAP_CHARS)})) AS BIGINT) + 1)) AS i FROM documents)""")
def q_b08(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return D.chunk_text(d).select("doc_id", "chunk_no", "chunk_start", F.md5("chunk").alias("chunk_md5"))


@register("b09_layer_tier", O.with_(BASE) + f"""SELECT arr,
  CAST(datediff('day', published_at, (SELECT max(published_at) FROM articles)) AS INTEGER) AS age_days,
  CASE WHEN datediff('day', published_at, (SELECT max(published_at) FROM articles)) <= {P.HOT_LAYER_DAYS} THEN 'hot'
       WHEN datediff('day', published_at, (SELECT max(published_at) FROM articles)) <= {P.COLD_LAYER_DAYS} THEN 'cold'
       ELSE 'expired' END AS tier
FROM articles""")
def q_b09(spark, sf_dir):
    a = articles(spark, sf_dir)
    return D.layer_tier(a, ingest.run_ts_of(a)).select("arr", "age_days", "tier")


@register("b10_domain_topk_search", f"""SELECT query, rank, match, round(cos, 6) AS cos FROM (
  SELECT a.vec_id AS query, b.vec_id AS match,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS cos,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY
           list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id)
WHERE rank <= {P.CROSS_DOMAIN_TOP_K}""")
def q_b10(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("arr"), "embedding",
                                                  F.col("label").alias("domain"))
    out = D.domain_topk_search(e, e)
    return out.select("query", F.col("rank").cast("bigint").alias("rank"), "match", F.round("cos", 6).alias("cos"))


@register("b10_cross_domain_search", f"""SELECT query, domain, rank, match, round(cos, 6) AS cos FROM (
  SELECT a.vec_id AS query, CAST(b.label AS VARCHAR) AS domain, b.vec_id AS match,
         list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS cos,
         row_number() OVER (PARTITION BY a.vec_id, b.label ORDER BY
           list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
WHERE rank <= {P.CROSS_DOMAIN_TOP_K}""")
def q_b10_cross(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("arr"), "embedding", F.col("label").alias("domain"))
    out = D.cross_domain_search(e, e)
    return out.select("query", "domain", F.col("rank").cast("bigint").alias("rank"), "match", F.round("cos", 6).alias("cos"))


LIVE_CHAINS = [c for c in FX.CORPUS_CHAINS if c["confidence"] >= P.CHAIN_MIN_CONFIDENCE]
CHAIN_TRIG_SQL = "(VALUES " + ", ".join(
    f"({O.sql_lit(c['id'])}, {O.sql_lit(c['trigger']['domain'])}, {O.sql_lit(c['trigger']['theme'])})"
    for c in LIVE_CHAINS) + ") t(chain_id, tdom, theme)"
CHAIN_EDGE_SQL = "(VALUES " + ", ".join(
    f"({O.sql_lit(c['id'])}, {i}, {O.sql_lit(d['domain'])}, {O.sql_lit(d['query'])}, {O.dbl(c['confidence'])})"
    for c in LIVE_CHAINS for i, d in enumerate(c["downstream"])) + ") t(chain_id, pos, domain, query, confidence)"
FIRED_SQL = f"""fired AS (SELECT e.arr, t.chain_id FROM enr e JOIN {CHAIN_TRIG_SQL} ON e.primary_domain = t.tdom
  WHERE len(list_filter(string_split(lower(t.theme), '_'), lambda w: NOT contains(e.tl, w))) = 0)"""


def _chain_inputs(spark, sf_dir):
    a = enrich.route_domain(articles(spark, sf_dir))
    edges = D.chain_edges(D.chains_frame(spark, FX.CORPUS_CHAINS))
    return a, edges


@register("b12_chain_trigger", O.with_(BASE, O.enrich_ctes("articles"), FIRED_SQL) + "SELECT arr, chain_id FROM fired")
def q_b12(spark, sf_dir):
    a, edges = _chain_inputs(spark, sf_dir)
    return D.chain_trigger(a, edges)


@register("b13_chain_expand", O.with_(BASE, O.enrich_ctes("articles"), FIRED_SQL) + f"""SELECT chain_id, pos, domain,
  rank, arr, matches, score FROM (
  SELECT l.chain_id, CAST(l.pos AS INTEGER) AS pos, l.domain, e.arr, m.matches,
         round(m.matches * l.confidence, 6) AS score,
         row_number() OVER (PARTITION BY l.chain_id, l.pos ORDER BY m.matches DESC, e.arr) AS rank
  FROM {CHAIN_EDGE_SQL.replace(' t(', ' l(')} JOIN enr e ON e.primary_domain = l.domain,
  LATERAL (SELECT CAST(len(list_filter(string_split(lower(l.query), ' '), lambda w: contains(e.tl, w))) AS INTEGER)
           AS matches) m
  WHERE l.chain_id IN (SELECT chain_id FROM fired) AND m.matches > 0)
WHERE rank <= {P.CROSS_DOMAIN_TOP_K}""")
def q_b13(spark, sf_dir):
    a, edges = _chain_inputs(spark, sf_dir)
    fired = D.chain_trigger(a, edges)
    out = D.chain_expand(fired, edges, a)
    return out.select("chain_id", "pos", "domain", F.col("rank").cast("bigint").alias("rank"), "arr", "matches",
                      "score")


@register("b14_story_bias_mix", O.with_(BASE, FRESH, O.cascade_ctes("fresh", L3_TEST_THRESHOLD))
          + """SELECT story_id, string_agg(bias || ':' || CAST(n AS VARCHAR), ',' ORDER BY bias || ':' || CAST(n AS VARCHAR))
  AS bias_mix FROM (SELECT coalesce(m.story_id, f.id) AS story_id, coalesce(f.bias_rating, 'unknown') AS bias,
  count(*) AS n FROM fresh f LEFT JOIN smap m ON m.id = f.id GROUP BY 1, 2) GROUP BY story_id""")
def q_b14(spark, sf_dir):
    fresh = _fresh(spark, sf_dir)
    _, t = dedup.dedup_cascade(fresh, embeddings_for(spark, sf_dir), P.Rules(cosine_threshold=L3_TEST_THRESHOLD),
                               return_tables=True)
    return D.story_bias_mix(dedup.attach_story(fresh.select("arr", "id", "bias_rating"), t["story_map"]))


# ---------------------------------------------------------------------------
# A30 incremental dedup, A04 feeds, A06 page text, A05 safe map, B02 MinHash
# ---------------------------------------------------------------------------

from brieflow.sources import feeds as FD  # noqa: E402

SPLIT_HOURS = 24


@register("a30_incremental_dedup", O.with_(
    BASE, f"""art2 AS (SELECT * FROM articles WHERE length(coalesce(nullif(body, ''), summary, '')) >= {P.MIN_ARTICLE_CHARS})""",
    f"""cut AS (SELECT max(published_at) - INTERVAL {SPLIT_HOURS} HOUR AS t FROM art2)""",
    O.cascade_ctes("art2", L3_TEST_THRESHOLD, scope="arr IN (SELECT arr FROM art2 WHERE published_at >= (SELECT t FROM cut))"))
    + "SELECT arr, story_id, corroboration_count FROM surv")
def q_incremental(spark, sf_dir):
    a = ingest.min_length_filter(articles(spark, sf_dir))
    cut = a.agg(F.max("published_at")).scalar() - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                                                 F.lit(SPLIT_HOURS))
    b1, b2 = a.filter(F.col("published_at") < cut), a.filter(F.col("published_at") >= cut)
    rules = P.Rules(cosine_threshold=L3_TEST_THRESHOLD)
    vec = embeddings_for(spark, sf_dir)
    _, store = dedup.incremental_dedup(b1, None, vec, rules)
    out, _ = dedup.incremental_dedup(b2, store, vec, rules)
    return out.select("arr", "story_id", "corroboration_count")


# The same two batches with keys that fall while time rises: stored leaders have larger keys than the batch.
KEY_TOP, BATCH_STEP = 1_000_000_000, 1_000_000_000_000
BACKWARD = O.with_(
    BASE, f"""art1 AS (SELECT * FROM articles WHERE length(coalesce(nullif(body, ''), summary, '')) >= {P.MIN_ARTICLE_CHARS})""",
    f"""cut AS (SELECT max(published_at) - INTERVAL {SPLIT_HOURS} HOUR AS t FROM art1)""",
    f"""art2 AS (SELECT * REPLACE ({KEY_TOP} - arr + CASE WHEN published_at >= (SELECT t FROM cut) THEN {BATCH_STEP} ELSE 0 END AS arr)
  FROM art1)""")
BACKWARD_VECTORS = f"e.vec_id = {KEY_TOP} - (l.arr % {BATCH_STEP})"


def _second_batch(spark, sf_dir, rules):
    a = ingest.min_length_filter(articles(spark, sf_dir))
    cut = a.agg(F.max("published_at")).scalar() - F.make_interval(hours=F.lit(SPLIT_HOURS))
    b1, b2 = (a.filter(c).withColumn("arr", KEY_TOP - F.col("arr")) for c in (F.col("published_at") < cut, F.col("published_at") >= cut))
    vec = embeddings_for(spark, sf_dir).withColumn("arr", KEY_TOP - F.col("arr"))
    _, store = dedup.incremental_dedup(b1, None, vec, rules)
    return dedup.incremental_dedup(b2, store, vec, rules, return_tables=True)


def _backward_sql(select: str, **kw) -> str:
    return O.with_(BACKWARD.removeprefix("WITH RECURSIVE ").removeprefix("WITH ").rstrip(), O.cascade_ctes(
        "art2", L3_TEST_THRESHOLD, scope=f"arr >= {BATCH_STEP}", vec_on=BACKWARD_VECTORS, **kw)) + select


@register("a30_incremental_backward", _backward_sql(f"SELECT arr % {BATCH_STEP} AS arr, story_id, corroboration_count FROM surv"))
def q_incremental_backward(spark, sf_dir):
    out, _ = _second_batch(spark, sf_dir, P.Rules(cosine_threshold=L3_TEST_THRESHOLD))
    return out.select("arr", "story_id", "corroboration_count")


@register("a30_incremental_story_map", _backward_sql("SELECT id, story_id FROM smap"))
def q_incremental_map(spark, sf_dir):
    _, t = _second_batch(spark, sf_dir, P.Rules(cosine_threshold=L3_TEST_THRESHOLD))
    return t["story_map"].select("id", "story_id")


@register("a30_incremental_without_l2", _backward_sql(f"SELECT arr % {BATCH_STEP} AS arr, story_id, corroboration_count FROM surv", use_l2=False))
def q_incremental_no_l2(spark, sf_dir):
    out, _ = _second_batch(spark, sf_dir, P.Rules(cosine_threshold=L3_TEST_THRESHOLD, use_l2=False))
    return out.select("arr", "story_id", "corroboration_count")


@register("a30_leader_store", QUERIES["a30_incremental_dedup"][1])
def q_leader_store(spark, sf_dir):
    """The second batch of a30_incremental_dedup against a store on files; the first comes in two batches."""
    from brieflow.operators.leader_store import LeaderStore
    a = ingest.min_length_filter(articles(spark, sf_dir))
    ends = a.agg(F.max("published_at").alias("t")).select("t", (F.col("t") - F.make_interval(hours=F.lit(SPLIT_HOURS))).alias("cut"),
                                                         (F.col("t") - F.make_interval(hours=F.lit(3 * SPLIT_HOURS))).alias("first")).first()
    at, vec = F.col("published_at"), embeddings_for(spark, sf_dir)
    store = LeaderStore(spark, scratch_path(spark, "leader-store"), buckets=16, compact_every=1, rules=P.Rules(cosine_threshold=L3_TEST_THRESHOLD))
    for n, part in enumerate((a.filter(at < ends["first"]), a.filter((at >= ends["first"]) & (at < ends["cut"])))):
        store.run(n, part, vec)
    out, _ = store.run(2, a.filter(at >= ends["cut"]), vec)
    return out.select("arr", "story_id", "corroboration_count")


def _page_feeds(spark, sf_dir):
    """One stored feed document per page: RSS when the URL has no query string, else Atom."""
    pg = table(spark, sf_dir, "pages")
    rss = F.concat(F.lit("<rss version=\"2.0\"><channel><title>f</title><item><title>p"), F.col("page_id").cast("string"),
                   F.lit("</title><link>"), F.regexp_replace("url", "&", "&amp;"),
                   F.lit("</link><pubDate>Mon, 01 Jan 2024 00:00:00 +0000</pubDate></item></channel></rss>"))
    atom = F.concat(F.lit("<feed xmlns=\"http://www.w3.org/2005/Atom\"><entry><title>p"),
                    F.col("page_id").cast("string"), F.lit("</title><link href=\""),
                    F.regexp_replace("url", "&", "&amp;"),
                    F.lit("\"/><updated>2024-01-01T00:00:00Z</updated></entry></feed>"))
    # every fifth feed has a bare "&" in its link, every seventh is never closed
    xml = F.when(F.contains("url", F.lit("?")), atom).otherwise(rss)
    xml = F.when(F.col("page_id") % 5 == 0, F.replace(xml, F.lit("&amp;"), F.lit("&"))).otherwise(xml)
    xml = F.when(F.col("page_id") % 7 == 0, F.regexp_replace(xml, "</(item|entry)>.*$", "")).otherwise(xml)
    return pg.select(F.col("page_id").alias("source_id"), xml.alias("xml"))


@register("a04_feed_entries", """SELECT page_id AS feed, 0 AS pos, 'p' || CAST(page_id AS VARCHAR) AS title, url
FROM pages""")
def q_feeds(spark, sf_dir):
    e = FD.feed_entries(_page_feeds(spark, sf_dir))
    return e.select(F.col("feed").cast("bigint").alias("feed"), "pos", "title",
                    entry_url("link", "links").alias("url"))


def _page_text_sql() -> str:
    h = "coalesce(html, '')"
    h = f"regexp_replace({h}, '[\x01\x02]', '', 'g')"
    h = f"regexp_replace({h}, '(?s)<!--.*?-->', '', 'g')"
    for t in FD.DROP_BLOCKS:
        h = f"regexp_replace({h}, '(?is)<{t}\\b[^>]*>.*?</{t}\\s*>', ' ', 'g')"
    h = f"regexp_replace({h}, '(?i)<a\\b[^>]*>', '\x01', 'g')"
    h = f"regexp_replace({h}, '(?i)</a\\s*>', '\x02', 'g')"
    tags = "|".join(FD.BREAK_TAGS)
    h = f"regexp_replace({h}, '(?i)<({tags})\\b[^>]*>', chr(10), 'g')"
    h = f"regexp_replace({h}, '(?i)</({tags})\\s*>', chr(10), 'g')"
    h = f"regexp_replace({h}, '<[^>]*>', '', 'g')"
    for ent, ch in FD.ENTITIES:
        h = f"replace({h}, {O.dlit(ent)}, {O.dlit(ch)})"
    h = f"regexp_replace({h}, '[ \\t\\r\\f]+', ' ', 'g')"
    plain, own = "regexp_replace(l, '[\x01\x02]', '', 'g')", "regexp_replace(regexp_replace(l, '\x01[^\x02]*\x02', '', 'g'), '[\x01\x02]', '', 'g')"
    kept = (f"list_filter(list_transform(string_split({h}, chr(10)), lambda l: {{'t': trim({plain}, ' '), 'own': length(trim({own}, ' '))}}), "
            f"lambda x: x.t <> '' AND x.own > {O.dbl(1 - FD.LINK_SHARE)} * length(x.t))")
    return f"array_to_string(list_transform({kept}, lambda x: x.t), chr(10))"


@register("a06_extract_page_text", f"""SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS text_len
FROM (SELECT page_id, {_page_text_sql()} AS t FROM pages)""")
def q_page_text(spark, sf_dir):
    pg = FD.extract_page_text(table(spark, sf_dir, "pages"))
    return pg.select("page_id", F.md5("page_text").alias("text_md5"), F.length("page_text").alias("text_len"))


def _host_or_fail(rec):
    """Example per-item function: host of the page URL; pages with a query string fail."""
    url = rec["url"] or ""
    if "?" in url:
        return None
    host = url.split("://", 1)[-1].split("/", 1)[0]
    return [{"page_id": rec["page_id"], "host": host}]


@register("a05_flat_map_safe", """SELECT CASE WHEN ok THEN page_id END AS page_id,
  CASE WHEN ok THEN split_part(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE url END, '/', 1) END AS host,
  ok, CASE WHEN NOT ok THEN 'none' END AS error
FROM (SELECT page_id, coalesce(url, '') AS url, NOT contains(coalesce(url, ''), '?') AS ok FROM pages)""")
def q_flat_map(spark, sf_dir):
    pg = table(spark, sf_dir, "pages").select("page_id", "url")
    return ingest.flat_map_safe(pg, _host_or_fail, "page_id long, host string")


@register("a05_flat_map_udtf", QUERIES["a05_flat_map_safe"][1])
def q_flat_map_udtf(spark, sf_dir):
    ingest.register_flat_map(spark, "page_hosts", _host_or_fail, "page_id long, host string", ["page_id", "url"])
    return spark.sql("SELECT t.* FROM {pages} p, LATERAL page_hosts(p.page_id, p.url) t", pages=table(spark, sf_dir, "pages"))


B02_SQL = f"""WITH w AS (SELECT doc_id AS k, list_filter(regexp_split_to_array(lower(' ' || coalesce(text, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (SELECT k, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' ')))) AS s
  FROM w WHERE len(w) > 0),
c AS MATERIALIZED (SELECT min(k) AS name, s, len(s) AS n, list(k) AS ks FROM s GROUP BY s),
g AS MATERIALIZED (SELECT name, n, unnest(s) AS g FROM c),
p AS (SELECT x.name AS a, y.name AS b, x.n AS na, y.n AS nb, count(*) AS hit FROM g x JOIN g y ON x.g = y.g AND x.name < y.name GROUP BY 1, 2, 3, 4)
SELECT a, b, round(hit / CAST(na + nb - hit AS DOUBLE), 6) AS jaccard FROM p WHERE hit >= {O.dbl(0.8)} * (na + nb - hit) - 1e-9
UNION ALL SELECT name, k, 1.0 FROM (SELECT name, unnest(ks) AS k FROM c) WHERE k <> name"""


@register("b02_minhash_near_dup", B02_SQL)
def q_minhash(spark, sf_dir):
    from brieflow.operators.similarity import minhash_near_dup
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("arr"), F.lit("").alias("title"),
                                                 F.col("text").alias("body"), F.lit("").alias("summary"))
    return minhash_near_dup(d, threshold=0.8).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


# A01/A02/B11 read files that the query writes from the given tables; B01 is written and read back.

@register("a01_scan_sources", O.with_(O.reg_cte()) + "SELECT source_id, source_name, domain, credibility_score FROM reg WHERE source_id NOT LIKE '%3'")
def q_scan_sources(spark, sf_dir):
    reg = source_registry(table(spark, sf_dir, "documents")).withColumn("active", F.when(F.col("source_id").endswith("3"), False))
    path = scratch_path(spark, "sources")
    # a registry file holds a list of sources; here each part of the folder is a file with an object per source
    reg.select(F.array(F.struct(*reg.columns)).alias("sources")).write.json(path)
    return FD.scan_sources(spark, path).select("source_id", "source_name", "domain", "credibility_score")


@register("a02_scan_lexicon", """SELECT lang AS domain, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS domain_ord,
  kind, CAST(item_ord AS INTEGER) AS item_ord, item
FROM (SELECT lang, list_sort(list(DISTINCT source)) AS s FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY lang),
LATERAL (SELECT 'keywords' AS kind, i - 1 AS item_ord, s[i] AS item FROM range(1, len(s) + 1) t(i)
         UNION ALL SELECT 'gdelt_themes', 0, upper(lang)) l
QUALIFY true""".replace("CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER)", "CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER)"))
def q_scan_lexicon(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("lang is not null and source is not null")
    one = d.groupBy("lang").agg(F.array_sort(F.collect_set("source")).alias("keywords")).select(
        "lang", F.struct("keywords", F.array(F.upper("lang")).alias("gdelt_themes")).alias("v"))
    text = one.groupBy().agg(F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "v")))).alias("domains"))).alias("value"))
    path = scratch_path(spark, "lexicon")
    text.select(F.concat(F.lit("// domains by language\n"), "value").alias("value")).coalesce(1).write.text(path)
    return FD.scan_lexicon(spark, path)


@register("b11_scan_chains", """SELECT 'c_' || source AS chain_id, lang AS trigger_domain, 'THEME' AS theme, CAST(0 AS INTEGER) AS pos,
  source AS domain, 'q ' || lang AS query, CAST(count(*) % 10 / 10.0 AS DOUBLE) AS confidence
FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY source, lang HAVING count(*) % 10 / 10.0 >= """ + f"{P.CHAIN_MIN_CONFIDENCE}")
def q_scan_chains(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("lang is not null and source is not null")
    chains = d.groupBy("source", "lang").agg((F.count("*") % 10 / 10.0).alias("confidence")).select(
        F.concat(F.lit("c_"), "source").alias("id"), F.struct(F.col("lang").alias("domain"), F.lit("THEME").alias("theme")).alias("trigger"),
        F.array(F.struct(F.col("source").alias("domain"), F.concat(F.lit("q "), "lang").alias("query"))).alias("downstream"), "confidence")
    path = scratch_path(spark, "chains")
    chains.select(F.array(F.struct(*chains.columns)).alias("chains")).write.json(path)  # an object per chain, in many files
    return D.chain_edges(D.scan_chains(spark, path)).select("chain_id", "trigger_domain", "theme", "pos", "domain", "query", "confidence")


@register("b01_run_outputs", """SELECT lang, CAST(count(*) AS VARCHAR) AS n, '2026-03' AS ym FROM documents GROUP BY lang
UNION ALL SELECT 'scored:' || source, CAST(count(*) AS VARCHAR), '2026-03' FROM documents GROUP BY source""")
def q_run_outputs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    base = scratch_path(spark, "run-outputs")
    frames = {"raw": d.groupBy("lang").agg(F.count("*").alias("n")), "scored": d.groupBy("source").agg(F.count("*").alias("n"))}
    for _ in range(2):  # writing a month again replaces it
        paths = FD.write_run_outputs(frames, base, "2026-03")
    raw = spark.read.option("inferSchema", False).json(paths["raw"])
    scored = spark.read.option("header", True).csv(paths["scored"])
    return raw.select("lang", F.col("n").cast("string").alias("n"), F.col("ym").cast("string").alias("ym")).unionByName(
        scored.select(F.concat(F.lit("scored:"), "source").alias("lang"), "n", F.col("ym").cast("string").alias("ym")))


COLLECT_SQL = O.with_(O.reg_cte(), f"""feed AS (SELECT page_id, 'src' || CAST(page_id % 20 AS VARCHAR) AS source_id,
  'p' || CAST(page_id AS VARCHAR) AS title, trim(url) AS url, date_trunc('second', ts) AS published_at,
  row_number() OVER (PARTITION BY page_id % 20 ORDER BY page_id) AS rn
  FROM pages JOIN events ON event_id = page_id)""",
    f"""txt AS (SELECT trim(url) AS url, arg_min(html, page_id) AS html FROM pages GROUP BY 1)""",
    f"""body AS (SELECT f.*, ({_page_text_sql()}) AS body FROM feed f LEFT JOIN txt USING (url)
  WHERE rn <= {P.MAX_ARTICLES_PER_FEED} AND url <> '')""",
    f"""late AS (SELECT max(published_at) - INTERVAL {P.MAX_AGE_HOURS} HOUR AS t FROM body)""") + f"""
SELECT sha256(lower(url)) AS id, url, source_id, title, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published, md5(body) AS body_md5, domain,
  credibility_score, 'en' AS language
FROM body JOIN reg USING (source_id) WHERE published_at >= (SELECT t FROM late) AND length(body) >= {P.MIN_ARTICLE_CHARS}"""


@register("a51_collect", COLLECT_SQL)
def q_collect(spark, sf_dir):
    pg, ev = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    items = pg.join(ev, F.col("event_id") == F.col("page_id")).select(
        "page_id", F.concat(F.lit("src"), (F.col("page_id") % 20).cast("string")).alias("source_id"),
        F.concat(F.lit("<item><title> p"), F.col("page_id").cast("string"), F.lit(" </title><link>"), "url", F.lit("</link><dc:date>"),
                 F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z</dc:date></item>")).alias("item"))
    # a feed is a document, so it is gathered whole; links hold bare "&" and the feeds are never closed
    feeds = items.groupBy("source_id").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("page_id", "item"))), lambda i: i["item"]), "")).alias("xml"))
    registry = source_registry(table(spark, sf_dir, "documents")).withColumn("language", F.lit("en"))
    out = FD.collect(feeds, pg, registry)
    return out.select("id", "url", "source_id", "title", F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published"),
                      F.md5("body").alias("body_md5"), "domain", "credibility_score", "language")


# ---------------------------------------------------------------------------
# Streaming S1–S3 (replayed from staged article files, availableNow)
# ---------------------------------------------------------------------------

from brieflow.session import scratch_path  # noqa: E402
from brieflow.streaming import streams as ST  # noqa: E402


STREAM_COLS = ["arr", "id", "url", "title", "body", "summary", "published_at", "source_id", "domain", "credibility_score"]


def _staged(spark, sf_dir, with_copies: bool = False):
    a = articles(spark, sf_dir).select(*STREAM_COLS)
    if with_copies:
        a = a.unionByName(a.withColumn("arr", F.col("arr") + 1_000_000_000).withColumn("url", F.upper("url")))
    folder = ST.stage_article_files(a, scratch_path(spark, "staged-articles"))
    return ST.replay(spark, folder, a.schema)


@register("s1_stream_url_dedup", O.with_(BASE) + "SELECT min(arr) AS arr, sha256(lower(url)) AS url_hash FROM articles GROUP BY 2")
def q_s1(spark, sf_dir):
    out = ST.run_to_table(ST.stream_url_dedup(_staged(spark, sf_dir, with_copies=True)), "s1")
    return out.select("arr", "url_hash")


@register("s3_stream_story_counts", O.with_(BASE, O.cascade_ctes("articles", L3_TEST_THRESHOLD))
          + f"""SELECT strftime(day, '%Y-%m-%d %H:%M:%S') AS window_start, story_id, articles
FROM (SELECT date_trunc('day', a.published_at) AS day, coalesce(m.story_id, a.id) AS story_id, count(*) AS articles
      FROM articles a LEFT JOIN smap m ON m.id = a.id GROUP BY 1, 2)
WHERE day + INTERVAL {P.STORY_WINDOW_HOURS} HOUR <= (SELECT max(published_at) FROM articles) - INTERVAL {P.MAX_AGE_HOURS} HOUR""")
def q_s3(spark, sf_dir):
    _, t = dedup.dedup_cascade(articles(spark, sf_dir), embeddings_for(spark, sf_dir), P.Rules(cosine_threshold=L3_TEST_THRESHOLD),
                               return_tables=True)
    s = dedup.attach_story(_staged(spark, sf_dir), ST.moved_stories(t["story_map"]))
    out = ST.run_to_table(ST.stream_story_counts(s), "s3")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "story_id",
                      "articles")


@register("s2_stream_leader_dedup", O.with_(BASE, O.cascade_ctes("articles", L3_TEST_THRESHOLD)) + """SELECT s.arr, s.story_id,
  1 + (SELECT count(*) FROM articles b JOIN smap m ON m.id = b.id WHERE m.story_id = s.id AND b.id <> s.id
       AND date_trunc('day', b.published_at) = date_trunc('day', s.published_at)) AS corroboration_count
FROM surv s""")
def q_s2(spark, sf_dir):
    s = _staged(spark, sf_dir)
    sink = scratch_path(spark, "s2-sink")
    q = ST.stream_leader_dedup(s, sink, sink + "-ckpt", embeddings_for(spark, sf_dir),
                               P.Rules(cosine_threshold=L3_TEST_THRESHOLD))
    q.awaitTermination()
    return spark.read.parquet(sink).select("arr", "story_id", "corroboration_count")
