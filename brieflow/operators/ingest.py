"""Ingest operators.

All are narrow projections or filters except ``feed_cap`` (a ranked window
that Catalyst turns into a partial ``WindowGroupLimit``, so a feed holding a
third of all entries ships only ``n`` rows per partition) and the registry
join (one row per feed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import effective_body


def run_ts_of(df: DataFrame, col: str = "published_at") -> Column:
    """``max(published_at)`` as a scalar subquery (no cross join, no driver round trip)."""
    return df.agg(F.max(col)).scalar()


def freshness_filter(df: DataFrame, run_ts=None, max_age_hours: int = P.MAX_AGE_HOURS,
                     col: str = "published_at") -> DataFrame:
    """Drop rows older than ``run_ts - max_age_hours``; the boundary is kept.

    ``run_ts`` may be a literal timestamp, a Column or None (the newest
    ``published_at`` of ``df``). A literal bound is pushed into the Parquet scan.
    """
    if run_ts is None:
        run_ts = run_ts_of(df, col)
    elif not isinstance(run_ts, Column):
        run_ts = F.lit(run_ts).cast("timestamp")
    cutoff = run_ts - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(int(max_age_hours)))
    return df.filter(F.col(col) >= cutoff)


def min_length_filter(df: DataFrame, min_chars: int = P.MIN_ARTICLE_CHARS) -> DataFrame:
    """Effective text = body, else summary; drop if shorter than ``min_chars``."""
    return df.filter(F.length(effective_body()) >= F.lit(int(min_chars)))


def feed_cap(entries: DataFrame, n: int = P.MAX_ARTICLES_PER_FEED, feed_col: str = "source_id",
             pos_col: str = "pos") -> DataFrame:
    """First ``n`` entries of each feed in feed order. Must stay below the
    URL/age/length filters in the plan (a filter on other columns is not pushed
    below a window, which is what keeps the semantics)."""
    w = Window.partitionBy(feed_col).orderBy(F.col(pos_col).asc())
    return entries.withColumn("_feed_rn", F.row_number().over(w)).filter(F.col("_feed_rn") <= n).drop("_feed_rn")


def drop_missing_url(entries: DataFrame, url_col: str = "url") -> DataFrame:
    """A10 (row part): entries without a URL are dropped."""
    return entries.filter(F.coalesce(F.col(url_col), F.lit("")) != "")


def project_articles(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """Entry (title stripped) + source attributes with defaults (unknown, unknown, 0.5, en).

    ``sources`` is a registry (one row per feed); AQE turns the join into a
    broadcast from runtime size statistics, otherwise it stays a shuffle join.
    """
    src = sources.select(
        F.col("source_id"),
        F.col("source_name"),
        F.coalesce(F.col("domain"), F.lit("all")).alias("domain"),
        F.coalesce(F.col("bias_rating"), F.lit("unknown")).alias("bias_rating"),
        F.coalesce(F.col("factual_rating"), F.lit("unknown")).alias("factual_rating"),
        F.coalesce(F.col("credibility_score").cast("double"), F.lit(P.DEFAULT_CREDIBILITY)).alias("credibility_score"),
        F.coalesce(F.col("language"), F.lit("en")).alias("language"),
    )
    drop = [c for c in src.columns if c != "source_id" and c in entries.columns]
    entries = entries.drop(*drop)
    if "title" in entries.columns:
        entries = entries.withColumn("title", F.regexp_replace(F.coalesce("title", F.lit("")), r"^\s+|\s+$", ""))
    return entries.join(src, "source_id")


def run_stats(df: DataFrame, **stages: Column) -> DataFrame:
    """One row per stage with its row count, in one pass over ``df``.

    Each stage is a condition on the rows of ``df`` (a stage counts the rows on which it holds).
    """
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in stages.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("stage"), F.col(name).alias("rows")) for name in stages])
    return counts.select(F.inline(pairs))


class RunStats:
    """A07 while the stages run: each watched frame counts its own rows, and those that failed, as they pass (``DataFrame.observe``), so
    the counts cost no scan of their own.

    ``watch`` returns the frame to go on with. After an action that ran all watched frames, ``table`` has a row (stage, rows, failed) for each, in the
    order of watching. A frame that several actions run keeps the counts of the first one.
    """

    def __init__(self):
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, stage: str, df: DataFrame, failed: Column | None = None) -> DataFrame:
        seen = Observation(f"{stage}-{len(self._seen)}")
        self._seen.append((stage, seen))
        bad = F.lit(0).cast("long") if failed is None else F.count_if(F.coalesce(failed, F.lit(False)))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), (F.max(bad) if failed is None else bad).alias("failed"))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(stage, seen.get["rows"], seen.get["failed"] or 0) for stage, seen in self._seen]  # a row per stage
        return spark.createDataFrame(rows, "stage string, rows long, failed long")


def register_flat_map(spark: SparkSession, name: str, fn, schema: str, columns: list[str]) -> None:
    """A05 as a table function for SQL: ``SELECT t.* FROM items i, LATERAL name(i.a, i.b) t`` gives the rows of
    ``flat_map_safe(items, fn, schema, ["a", "b"])``, with ``ok`` and ``error``. ``columns`` name the arguments for ``fn``; values arrive in Arrow batches.
    """
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()

    class FlatMap:
        def eval(self, *values):
            try:
                res = fn(dict(zip(columns, values)))
            except Exception as exc:  # noqa: BLE001 - failures are data here
                yield (*[None] * len(names), False, repr(exc))
                return
            if res is None:
                yield (*[None] * len(names), False, "none")
                return
            for r in res if isinstance(res, list) else [res]:
                yield (*[r.get(k) for k in names], True, None)

    spark.udtf.register(name, F.udtf(FlatMap, returnType=f"{schema}, ok boolean, error string", useArrow=True))


def flat_map_safe(df: DataFrame, fn, schema: str, payload_cols: list[str] | None = None) -> DataFrame:
    """Map each row through ``fn(row_dict) -> None | dict | list[dict]`` in Arrow batches.

    ``None`` or an exception counts as a failure and yields one row with
    ``ok = false`` and the error text; a list is flattened; a dict is one row.
    Values arrive as plain Python values (an integer stays exact beside nulls).
    Output schema = ``schema`` + ``ok boolean, error string``. Totals come from
    ``flat_map_totals``. This is the user-function surface (per-row Python).
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, StringType, StructField, StructType

    given = StructType.fromDDL(schema)
    names = given.fieldNames()
    out_schema = StructType([*given.fields, StructField("ok", BooleanType()), StructField("error", StringType())])
    arrow_schema = to_arrow_schema(out_schema)
    cols = payload_cols or df.columns

    def run(batches):
        for b in batches:
            rows = []
            for rec in b.to_pylist():
                try:
                    res = fn(rec)
                except Exception as exc:  # noqa: BLE001 - failures are data here
                    rows.append({"ok": False, "error": repr(exc)})
                    continue
                if res is None:
                    rows.append({"ok": False, "error": "none"})
                else:
                    rows.extend({**{k: r.get(k) for k in names}, "ok": True} for r in (res if isinstance(res, list) else [res]))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    return df.select(*cols).mapInArrow(run, schema=out_schema)


def flat_map_totals(mapped: DataFrame, items: DataFrame) -> DataFrame:
    """Totals of A05: items, results, failed."""
    res = mapped.agg(F.count_if(F.col("ok")).alias("results"), F.count_if(~F.col("ok")).alias("failed"))
    return res.withColumn("items", items.agg(F.count(F.lit(1))).scalar())


__all__ = ["run_ts_of", "freshness_filter", "min_length_filter", "feed_cap", "drop_missing_url",
           "project_articles", "run_stats", "RunStats", "register_flat_map", "flat_map_safe", "flat_map_totals"]
