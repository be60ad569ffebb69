"""Adapter from the driver tables to articles.

``documents`` ⋈ ``events`` (event_id = doc_id) gives ``published_at``; the
20-source registry is *derived by Spark* from the distinct ``source`` values
with a fixed rule (credibility 0.05 × (n + 1), every fourth source a wire
service ``all``, the rest spread over the 13 domains). ``arr = doc_id`` is
the total arrival order (a natural unique key, never a generated id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import article_id
from brieflow.session import broadcast_if_small

BIAS_CYCLE = ["center", "center-left", "center-right", "left", "right"]
FACTUAL_CYCLE = ["high", "mixed", "low"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_registry(documents: DataFrame) -> DataFrame:
    """Registry rows (id, url, name, domain, ratings, credibility, language, active)
    for the distinct sources of ``documents``."""
    n = F.col("_n")
    reg = documents.select("source").distinct().filter(F.col("source").isNotNull())
    reg = reg.withColumn("_n", F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0)))
    domains = F.array(*[F.lit(d) for d in P.DOMAINS])
    return reg.select(
        F.col("source").alias("source_id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/feed")).alias("feed_url"),
        F.concat(F.lit("Source "), n.cast("string")).alias("source_name"),
        F.when(n % 4 == 0, F.lit("all")).otherwise(F.element_at(domains, (n % 13) + 1)).alias("domain"),
        F.element_at(F.array(*[F.lit(b) for b in BIAS_CYCLE]), (n % 5) + 1).alias("bias_rating"),
        F.element_at(F.array(*[F.lit(b) for b in FACTUAL_CYCLE]), (n % 3) + 1).alias("factual_rating"),
        F.round((n + 1) * F.lit(0.05), 2).alias("credibility_score"),
        F.lit("en").alias("source_language"),
        F.lit(True).alias("active"),
    )


def articles(spark: SparkSession, sf_dir: str, with_embedding: bool = False) -> DataFrame:
    """Articles of SURVEY §5 / FIXTURES §2 built from the driver tables."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"),
                                                 F.col("ts").cast("timestamp").alias("published_at"))
    reg = source_registry(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string"))
    # The registry has one row per feed; where that is a checked small number it is broadcast, so the
    # text is never dealt by source. Only the doc_id join shuffles it.
    art = (docs.join(broadcast_if_small(reg), docs["source"] == reg["source_id"])
               .join(ev, "doc_id")
               .select(F.col("doc_id").alias("arr"),
                       article_id(url).alias("id"),
                       url.alias("url"),
                       F.substring(F.substring_index(text, "\n", 1), 1, 80).alias("title"),
                       text.alias("body"),
                       F.lit("").alias("summary"),
                       "published_at", "source_id", "source_name", "domain", "bias_rating",
                       "factual_rating", "credibility_score",
                       F.coalesce(F.col("lang"), F.lit("en")).alias("language")))
    if with_embedding:
        emb = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("arr"), "embedding")
        art = art.join(emb, "arr", "left")
    return art


def embeddings_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(arr, embedding) keyed like articles."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("arr"), "embedding")
