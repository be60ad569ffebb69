"""Operators declared by the studied configuration but without code there.

Definitions marked *ours* in the survey are implemented as documented in
each docstring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators.nearest import nearest_join
from brieflow.session import broadcast_if_small


def _ts(run_ts) -> Column:
    if run_ts is None:
        raise ValueError("run_ts required")
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")


# B03 -----------------------------------------------------------------------
def rating_to_credibility(df: DataFrame, mapping=P.RATING_SCORES, rating_col: str = "factual_rating",
                          score_col: str = "credibility_score") -> DataFrame:
    """``credibility_from_rating`` = map[rating] (unknown -> 0.5) and
    ``credibility_resolved`` = explicit score, else the mapped value."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(float(v)))])
    mapped = F.coalesce(F.try_element_at(m, F.lower(F.col(rating_col))), F.lit(P.DEFAULT_CREDIBILITY))
    explicit = F.col(score_col).cast("double") if score_col in df.columns else F.lit(None).cast("double")
    return df.select("*", mapped.alias("credibility_from_rating"),
                     F.coalesce(explicit, mapped).alias("credibility_resolved"))


# B04 -----------------------------------------------------------------------
def credibility_gate(df: DataFrame, min_score: float = P.MIN_FACTUAL_SCORE,
                     col: str = "credibility_score") -> DataFrame:
    """B04 (row part): keep credibility ≥ ``min_score`` (missing -> 0.5)."""
    return df.filter(F.coalesce(F.col(col).cast("double"), F.lit(P.DEFAULT_CREDIBILITY)) >= min_score)


def story_sources(df: DataFrame, min_sources: int = P.CORROBORATION_MIN_SOURCES) -> DataFrame:
    """B04 (story part): (story_id, n_articles, n_sources, corroborated) — distinct sources per story."""
    return (df.groupBy("story_id")
              .agg(F.count(F.lit(1)).alias("n_articles"), F.count_distinct("source_id").alias("n_sources"))
              .withColumn("corroborated", F.col("n_sources") >= min_sources))


# B05 -----------------------------------------------------------------------
def story_window(edges: DataFrame, nodes: DataFrame, hours: int = P.STORY_WINDOW_HOURS,
                 key: str = "arr", ts_col: str = "published_at") -> DataFrame:
    """B05 (ours), for given pairs: keep edges (u, v) whose articles were published within ``hours``. Where leaders are to be
    elected, every member counts, copies included: see ``window_hours`` of :func:`brieflow.operators.dedup.l2_near_dup`."""
    t = nodes.select(F.col(key), F.col(ts_col))
    tu = t.select(F.col(key).alias("u"), F.col(ts_col).alias("_tu"))
    tv = t.select(F.col(key).alias("v"), F.col(ts_col).alias("_tv"))
    gap = F.abs(F.unix_micros(F.col("_tu")) - F.unix_micros(F.col("_tv")))
    return (edges.join(tu, "u").join(tv, "v")
                 .filter(gap <= F.lit(int(hours) * 3600 * 1_000_000)).select("u", "v"))


# B06 -----------------------------------------------------------------------
def domain_age_gate(df: DataFrame, history: DataFrame, run_ts, min_days: int = P.DOMAIN_AGE_MIN_DAYS,
                    url_col: str = "url") -> DataFrame:
    """B06 (ours): host first seen in ``history`` at least ``min_days`` before ``run_ts``.
    Adds host, first_seen, host_age_days, domain_age_ok."""
    host = F.lower(F.parse_url(F.col(url_col), F.lit("HOST")))
    first = (history.select(host.alias("host"), F.col("published_at"))
                    .groupBy("host").agg(F.min("published_at").alias("first_seen")))
    # one row per host: broadcast where the hosts are few, so that a hot host's rows stay where they are
    out = df.withColumn("host", host).join(broadcast_if_small(first), "host", "left")
    age = F.datediff(_ts(run_ts), F.col("first_seen"))
    return out.withColumn("host_age_days", age).withColumn("domain_age_ok", F.coalesce(age >= min_days, F.lit(False)))


# B07 / B10 -----------------------------------------------------------------
def novelty(new: DataFrame, history: DataFrame, key: str = "arr", vec_col: str = "embedding",
            part_col: str | None = None, earlier_only: bool = False, block_rows: int = 1 << 15,
            default: float = P.DEFAULT_NOVELTY) -> DataFrame:
    """B07 (ours): novelty = clamp(1 − max cosine to history), no history -> 0.7.

    The greatest cosine is that of the nearest row (:func:`brieflow.operators.nearest.nearest_join`, k = 1), which looks only into cells of
    the history that may hold it. ``part_col`` restricts history to the same partition (e.g. the
    domain); ``earlier_only`` compares with history rows of smaller key only.
    """
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")) if part_col else F.lit("")
    nq = new.select(F.col(key).alias("qk"), F.col(vec_col).alias("qv"), part.alias("p")).filter(F.col("qv").isNotNull())
    hc = history.select(F.col(key).alias("ck"), F.col(vec_col).alias("cv"), part.alias("p"))
    met = nearest_join(nq, hc, 1, own_part=True, earlier_only=earlier_only, block_rows=block_rows)
    mx = met.select(F.col("qk").alias(key), F.col("cos").alias("max_cos"))
    nov = F.when(F.col("max_cos").isNull(), F.lit(float(default))) \
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("max_cos"))))
    return nq.select(F.col("qk").alias(key)).join(mx, key, "left").select(key, "max_cos", nov.alias("novelty"))


def domain_topk_search(queries: DataFrame, corpus: DataFrame, k: int = P.CROSS_DOMAIN_TOP_K, key: str = "arr",
                       vec_col: str = "embedding", part_col: str = "domain", exclude_self: bool = True,
                       block_rows: int = 1 << 15) -> DataFrame:
    """B10 within the query's own domain: the ``k`` nearest corpus rows of its domain by cosine (ties by key)."""
    q = queries.select(F.col(key).alias("qk"), F.col(vec_col).alias("qv"), F.col(part_col).alias("p"))
    c = corpus.select(F.col(key).alias("ck"), F.col(vec_col).alias("cv"), F.col(part_col).alias("p"))
    out = nearest_join(q, c, int(k), own_part=True, exclude_self=exclude_self, block_rows=block_rows)
    return out.select(F.col("qk").alias("query"), "rank", F.col("ck").alias("match"), "cos")


def cross_domain_search(queries: DataFrame, corpus: DataFrame, k: int = P.CROSS_DOMAIN_TOP_K, key: str = "arr",
                        vec_col: str = "embedding", part_col: str = "domain", exclude_self: bool = True, block_rows: int = 1 << 15,
                        probes: dict | None = None) -> DataFrame:
    """For each query and each domain of ``corpus`` the ``k`` nearest rows by cosine (ties by key): (query, domain, rank, match,
    cos), the domain as text. Exact; see :func:`brieflow.operators.nearest.nearest_join`."""
    q = queries.select(F.col(key).alias("qk"), F.col(vec_col).alias("qv"))
    c = corpus.select(F.col(key).alias("ck"), F.col(vec_col).alias("cv"), F.col(part_col).alias("p"))
    out = nearest_join(q, c, int(k), exclude_self=exclude_self, block_rows=block_rows, probes=probes)
    return out.select(F.col("qk").alias("query"), F.col("p").alias("domain"), "rank", F.col("ck").alias("match"), "cos")


# B08 -----------------------------------------------------------------------
def chunk_text(df: DataFrame, text_col: str = "text", size: int = P.CHUNK_SIZE_CHARS,
               overlap: int = P.CHUNK_OVERLAP_CHARS) -> DataFrame:
    """B08 (ours): ``size``-char chunks with ``overlap``; step = size − overlap; stops at the
    first chunk that reaches the end. Adds chunk_no, chunk_start (1-based), chunk."""
    step = size - overlap
    n = F.length(F.coalesce(F.col(text_col), F.lit("")))
    last = F.greatest(F.lit(0), F.ceil((n - size) / F.lit(float(step)))).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: i * step + 1)
    out = df.select("*", F.posexplode(starts).alias("chunk_no", "chunk_start"))
    return out.withColumn("chunk", F.expr(f"substring(coalesce({text_col}, ''), chunk_start, {int(size)})"))


# B09 -----------------------------------------------------------------------
def layer_tier(df: DataFrame, run_ts, hot_days: int = P.HOT_LAYER_DAYS, cold_days: int = P.COLD_LAYER_DAYS,
               ts_col: str = "published_at") -> DataFrame:
    """B09 (ours, inclusive): age ≤ hot -> hot, ≤ cold -> cold, else expired."""
    age = F.datediff(_ts(run_ts), F.col(ts_col))
    return df.withColumn("age_days", age).withColumn(
        "tier", F.when(age <= hot_days, "hot").when(age <= cold_days, "cold").otherwise("expired"))


# B11–B13 -------------------------------------------------------------------
CHAIN_SCHEMA = ("id string, description string, trigger struct<domain:string,theme:string,theme_type:string>, "
                "downstream array<struct<domain:string,query:string>>, confidence double, source string, "
                "last_reviewed string")


def chains_frame(spark, chains: list[dict]) -> DataFrame:
    """Config-size chain list as a DataFrame."""
    return spark.createDataFrame(chains, schema=CHAIN_SCHEMA)


def scan_chains(spark, path: str) -> DataFrame:
    """Read a chain file ``{"chains": [...]}``, or a folder of files with an object ``{"chains": [...]}`` on each line."""
    raw = spark.read.option("multiLine", path.endswith(".json")).json(path)
    return raw.select(F.explode("chains").alias("c")).select("c.*")


def chain_edges(chains: DataFrame, min_conf: float = P.CHAIN_MIN_CONFIDENCE) -> DataFrame:
    """Chains with confidence ≥ ``min_conf`` exploded to edges
    (chain_id, trigger_domain, theme, pos, domain, query, confidence)."""
    kept = chains.filter(F.col("confidence") >= min_conf)
    return kept.select(F.col("id").alias("chain_id"), F.col("trigger.domain").alias("trigger_domain"),
                       F.col("trigger.theme").alias("theme"), "confidence",
                       F.posexplode("downstream").alias("pos", "d")) \
        .select("chain_id", "trigger_domain", "theme", "pos", F.col("d.domain").alias("domain"),
                F.col("d.query").alias("query"), "confidence")


def chain_trigger(articles: DataFrame, edges: DataFrame) -> DataFrame:
    """B12 (ours): (arr, chain_id) where primary_domain = trigger domain and every
    ``_``-separated word of the theme occurs in the lower-cased text.
    The chain table is broadcast if a check finds it small."""
    from brieflow.operators.enrich import TEXT_LOWER, with_text_lower

    trig = edges.select("chain_id", "trigger_domain", "theme").distinct() \
        .withColumn("words", F.split(F.lower("theme"), "_"))
    a = with_text_lower(articles.select("arr", "primary_domain", "title", "body", "summary"))
    j = a.join(broadcast_if_small(trig), a["primary_domain"] == trig["trigger_domain"])
    return j.filter(F.forall("words", lambda w: F.contains(F.col(TEXT_LOWER), w))).select("arr", "chain_id")


def chain_expand(fired: DataFrame, edges: DataFrame, articles: DataFrame, k: int = P.CROSS_DOMAIN_TOP_K) -> DataFrame:
    """B13 (ours): for every fired chain's downstream (domain, query), the best ``k``
    articles of that domain by number of query words present (ties by arr);
    score = matches × confidence. Articles with no query word are not returned."""
    from brieflow.operators.enrich import TEXT_LOWER, with_text_lower

    live = edges.join(fired.select("chain_id").distinct(), "chain_id", "left_semi") \
        .withColumn("qwords", F.split(F.lower("query"), " "))
    a = with_text_lower(articles.select("arr", "primary_domain", "title", "body", "summary"))
    j = a.join(broadcast_if_small(live), a["primary_domain"] == live["domain"])
    j = j.withColumn("matches", F.size(F.filter("qwords", lambda w: F.contains(F.col(TEXT_LOWER), w))))
    j = j.filter(F.col("matches") > 0)
    w = Window.partitionBy("chain_id", "pos").orderBy(F.col("matches").desc(), F.col("arr").asc())
    return (j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
             .select("chain_id", "pos", "domain", "rank", "arr", "matches",
                     F.round(F.col("matches") * F.col("confidence"), 6).alias("score")))


# B14 -----------------------------------------------------------------------
def story_bias_mix(df: DataFrame) -> DataFrame:
    """Per story, article counts per bias rating as ``rating:count`` sorted by rating.
    At most one entry per distinct rating (a handful), so the list is bounded."""
    per = df.groupBy("story_id", F.coalesce(F.col("bias_rating"), F.lit("unknown")).alias("bias")).count()
    return per.groupBy("story_id").agg(
        F.array_join(F.array_sort(F.collect_list(F.concat(F.col("bias"), F.lit(":"), F.col("count").cast("string")))),
                     ",").alias("bias_mix"))
