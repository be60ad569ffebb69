"""Structured Streaming operators.

S1 ``stream_url_dedup``: keyed state per URL hash that emits the first article (least ``arr`` of the
micro-batch in which the URL first appears) and expires by the 48-hour watermark, so state is bounded by the
watermark, not by history.
S2 ``stream_leader_dedup``: ``foreachBatch`` running the batch cascade against the leaders of earlier
micro-batches (A30). The leaders are kept by a ``LeaderStore`` in shared storage; batch ``n`` reads what the batches below ``n``
left and overwrites its own generation, so a restart goes on where it was and a replayed batch gives the same rows again.
S3 ``stream_story_counts``: tumbling 24-hour event-time windows per story, in append mode: a window is
emitted once, when the watermark has passed its end, and its state is dropped.
"""

from __future__ import annotations

import math
import os
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from brieflow import params as P
from brieflow.operators import dedup
from brieflow.operators.leader_store import LeaderStore
from brieflow.session import ensure_checkpoint_dir, scratch_path


def stream_url_dedup(stream: DataFrame, watermark_hours: int = P.MAX_AGE_HOURS) -> DataFrame:
    """Exact-URL dedup over an article stream, the first article of each URL kept; rows later than the
    watermark are dropped. Returns (arr, url_hash, published_at)."""
    keep_ms = int(watermark_hours) * 3_600_000

    def first(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for pdf in frames:  # one Arrow batch at a time: a hot URL is never held whole
            row = pdf.loc[[pdf["arr"].idxmin()]]
            if best is None or row["arr"].iloc[0] < best["arr"].iloc[0]:
                best = row
        if best is not None and not state.exists:
            seen = int(best["published_at"].iloc[0].timestamp() * 1000)
            state.update((seen,))
            state.setTimeoutTimestamp(max(seen + keep_ms, state.getCurrentWatermarkMs() + 1))
            yield best[["arr", "url_hash", "published_at"]]

    keyed = (stream.select("arr", dedup.url_hash("url").alias("url_hash"), "published_at")
                   .withWatermark("published_at", f"{int(watermark_hours)} hours"))
    return keyed.groupBy("url_hash").applyInPandasWithState(
        first, "arr long, url_hash string, published_at timestamp", "seen long", "append", GroupStateTimeout.EventTimeTimeout)


def stream_story_counts(stream: DataFrame, story_col: str = "story_id", window_hours: int = P.STORY_WINDOW_HOURS,
                        watermark_hours: int = P.MAX_AGE_HOURS) -> DataFrame:
    """S3: article count per (24-hour event-time window, story)."""
    return (stream.withWatermark("published_at", f"{int(watermark_hours)} hours")
                  .groupBy(F.window("published_at", f"{int(window_hours)} hours").alias("w"), story_col)
                  .agg(F.count(F.lit(1)).alias("articles"))
                  .select(F.col("w.start").alias("window_start"), story_col, "articles"))


def moved_stories(smap: DataFrame) -> DataFrame:
    """The rows of a story map (one for each id) that name another story, stored once: every micro-batch joins them, not the plan that the map
    came from. An article without a row is its own story (:func:`brieflow.operators.dedup.attach_story`)."""
    ensure_checkpoint_dir(smap.sparkSession)
    return smap.filter("story_id <> id").checkpoint(eager=True)


def stream_leader_dedup(stream: DataFrame, sink: str, checkpoint: str, vectors: DataFrame | None = None,
                        rules: P.Rules = P.DEFAULT_RULES, trigger: dict | None = None, state: str | None = None,
                        keep_hours: int | None = None, store_options: dict | None = None):
    """Per micro-batch, dedup against the leaders of all earlier batches, which a
    :class:`brieflow.operators.leader_store.LeaderStore` keeps: a batch reads the buckets that its keys fall into.

    Returns the started query; survivors land in ``sink`` by batch id, the store in ``state`` (by default beside the
    checkpoint). ``keep_hours`` forgets leaders that much older than a batch's newest article. A replayed batch gives the same rows again.
    """
    folder = state or checkpoint.rstrip("/") + "-state"

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        store = LeaderStore(batch.sparkSession, folder, rules=rules, keep_hours=keep_hours, **(store_options or {}))
        out, _ = store.run(batch_id, batch, vectors)
        out.select("arr", "id", "story_id", "corroboration_count").write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# ---------------------------------------------------------------------------
# helpers for running a stream over stored articles (tests and registered queries)
# ---------------------------------------------------------------------------

#: rows of a staged file at most, about
FILE_ROWS = 20_000


def stage_article_files(articles: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> str:
    """Write articles by publication day, day after day, to replay as a stream (files are replayed by modification time). Every day has
    the same number of files, so that the largest day's hold ``file_rows`` each; :func:`replay` takes a day's files as one micro-batch.
    A helper for tests and registered queries over short periods."""
    spark, dealt = articles.sparkSession, folder.rstrip("/") + "-dealt"
    articles.withColumn("_day", F.date_format("published_at", "yyyy-MM-dd")).filter("_day is not null").write.mode("overwrite").partitionBy("_day").parquet(dealt)
    by_day = spark.read.schema(f"{_ddl(articles)}, _day string").parquet(dealt)
    days = by_day.groupBy("_day").count().orderBy("_day").collect()  # a row per day
    files = max([1, *(math.ceil(r["count"] / file_rows) for r in days)])
    for day, _ in days:
        path = os.path.join(folder, f"day={day}")
        one = by_day.filter(F.col("_day") == day).drop("_day")  # reads this day's folder only
        one.repartition(files).write.mode("overwrite").parquet(path)
        for _ in range(files - len(spark.read.schema(articles.schema).parquet(path).inputFiles())):  # partitions without rows leave no file
            one.limit(0).coalesce(1).write.mode("append").parquet(path)
    return folder


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def replay(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    """The staged files as a stream; ``max_files`` a micro-batch, by default those of a day."""
    if max_files is None:
        staged = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder).inputFiles()
        max_files = max([1, *Counter(os.path.dirname(f) for f in staged).values()])
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
                 .option("recursiveFileLookup", True).parquet(folder))


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a streaming frame to completion (availableNow, append) into Parquet; return the result as a table."""
    spark = df.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    q = (df.writeStream.format("parquet").option("path", out)
           .option("checkpointLocation", out + "-ckpt").outputMode("append")
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)
