"""Staged days: several files each, the same number, one micro-batch a day."""

from pyspark.sql import functions as F

from brieflow.session import scratch_path
from brieflow.streaming.streams import replay, run_to_table, stage_article_files


def test_a_day_is_several_files_and_one_batch(spark):
    a = spark.range(203).select(F.col("id").alias("arr"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.when(F.col("id") < 200, F.col("id") % 2)
                                                                                                                   .otherwise(2).cast("int"))).alias("published_at"))
    folder = stage_article_files(a, scratch_path(spark, "staging-test"), file_rows=20)
    per_file = spark.read.option("recursiveFileLookup", True).parquet(folder).groupBy(F.input_file_name().alias("f")).count().collect()
    assert max(r["count"] for r in per_file) <= 40 and len(per_file) >= 6
    out = run_to_table(replay(spark, folder, a.schema).select("arr", F.to_date("published_at").alias("d")), "staging")
    assert sorted(r["arr"] for r in out.collect()) == list(range(203))
    days_of_a_file = out.groupBy(F.input_file_name()).agg(F.count_distinct("d").alias("n")).agg(F.max("n")).first()[0]
    assert days_of_a_file == 1
