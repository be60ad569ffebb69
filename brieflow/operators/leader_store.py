"""A leader store on shared storage for incremental dedup (A30, S2): a batch reads what its keys can meet.

Three tables of Parquet files below one folder, each in *generations* (one a batch) and hash buckets:

* ``urls``: URL hashes, by a bucket of the hash;
* ``prints``: SimHash leaders, a row for each of their band keys, by a bucket of the key, so leaders within the
  Hamming distance of a fingerprint stand in the buckets of its own keys;
* ``vectors``: vector leaders by the cell of their nearest pivot (pivots are taken from the first batch that has vectors and never change), with the
  cells' radii in ``cells``. A vector can only be near leaders of cells whose pivot is at most the radius plus the threshold angle away.

A batch looks up which buckets its keys fall into (a number per bucket, bounded by ``buckets``) and reads these with a partition filter. After
``compact_every`` generations all live ones are merged into one. Rows older than ``keep_hours`` before the batch's newest article are expired: they are not
read any more, and the next compaction leaves them out. So a batch's cost follows its own size and the articles of ``keep_hours``, not the store's age.

``manifest/batch=n`` names the generations that are live after batch n. Batch n reads the manifest of the last batch before it and writes its own
generation and manifest anew, so a replayed batch, or one that was cut off, gives the same rows again. Old generations stay until :meth:`vacuum`.
"""

from __future__ import annotations

import math
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import dedup
from brieflow.operators.similarity import band_keys

SLACK = 1e-6


class LeaderStore:
    """``blocks`` (of :func:`brieflow.operators.similarity.band_keys`) fixes the keys of all generations; more blocks make longer keys
    for larger stores."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64, blocks: int = 6, keep_hours: int | None = None,
                 compact_every: int = 8, pivots: int = 64, rules: P.Rules = P.DEFAULT_RULES):
        self.spark, self.folder, self.buckets, self.blocks = spark, folder.rstrip("/"), buckets, blocks
        self.keep_hours, self.compact_every, self.pivots, self.rules = keep_hours, compact_every, pivots, rules

    # -- files ----------------------------------------------------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return os.path.join(self.folder, *parts)

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def live(self, before: int) -> list[tuple[str, str]]:
        """(table, generation) of what is live for batch ``before``."""
        m = self._read(self._path("manifest"))
        if m is None:
            return []
        rows = m.filter(F.col("batch") < before).select("batch", "part", "gen").collect()  # at most four a generation
        last = max((r["batch"] for r in rows), default=None)
        return sorted((r["part"], r["gen"]) for r in rows if r["batch"] == last and r["part"])

    def _part(self, name: str, live: list[tuple[str, str]], newest: int | None) -> DataFrame | None:
        """All live and unexpired rows of a table; None if there is none yet."""
        paths = [self._path(name, f"gen={g}") for part, g in live if part == name]
        if not paths:
            return None
        whole = self.spark.read.option("basePath", self._path(name)).parquet(*paths).drop("gen")
        if newest is not None and self.keep_hours is not None and "t" in whole.columns:
            whole = whole.filter((F.col("t") >= newest - self.keep_hours * 3_600_000_000) | F.col("t").isNull())
        return whole

    # -- reading --------------------------------------------------------------------------------------------------

    def _bucket(self, *cols: str):
        return F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")

    def _keyed(self, prints: DataFrame) -> DataFrame:
        keys = F.explode(band_keys("simhash", self.blocks, self.rules.simhash_max_distance))
        return prints.withColumn("_key", keys).select(*prints.columns, F.col("_key.c").alias("c"), F.col("_key.v").alias("v")).withColumn("bucket", self._bucket("c", "v"))

    def _in_buckets(self, table: DataFrame, keys: DataFrame) -> DataFrame:
        asked = [r["bucket"] for r in keys.select("bucket").distinct().collect()]
        return table.filter(F.col("bucket").isin(asked))

    def before(self, batch: int, newest: int | None = None) -> dict:
        """The ``store`` argument of :func:`brieflow.operators.dedup.incremental_dedup` for batch ``batch``: each part is a function that is told
        the batch's keys and gives the stored rows that these can meet. ``newest``: time of the batch's newest article (microseconds)."""
        live = self.live(batch)
        store: dict = {"batch": batch - 1, "url_hashes": None, "l2_leaders": None, "l3_leaders": None}
        urls, prints, vectors = (self._part(n, live, newest) for n in ("urls", "prints", "vectors"))
        if urls is not None:
            store["url_hashes"] = lambda l1: self._in_buckets(urls, l1.select(self._bucket("url_hash").alias("bucket"))).select("url_hash")
        if prints is not None:
            def near_prints(fps: DataFrame) -> DataFrame:
                keys = self._keyed(fps.select("simhash").distinct())
                met = self._in_buckets(prints, keys).join(keys.select("c", "v", "bucket").distinct(), ["bucket", "c", "v"], "left_semi")
                return met.select("batch", "arr", "id", "simhash", "t").distinct()
            store["l2_leaders"] = near_prints
        if vectors is not None:
            store["l3_leaders"] = lambda v: self._near_cells(v, vectors, live)
        return store

    # -- vectors --------------------------------------------------------------------------------------------------

    def _angles(self):
        import numpy as np

        rows = self.spark.read.parquet(self._path("pivots")).orderBy("n").collect()  # ``pivots`` vectors
        unit = np.array([r["v"] for r in rows], np.float64)
        norms = np.linalg.norm(unit, axis=1, keepdims=True)
        unit = unit / np.where(norms > 0, norms, 1.0)

        def angles(vectors) -> np.ndarray:
            m = np.stack(vectors.to_numpy()).astype(np.float64)
            length = np.linalg.norm(m, axis=1, keepdims=True)
            return np.arccos(np.clip((m / np.where(length > 0, length, 1.0)) @ unit.T, -1.0, 1.0))

        return angles, len(unit)

    def _near_cells(self, v: DataFrame, stored: DataFrame, live: list[tuple[str, str]]) -> DataFrame:
        import numpy as np
        import pandas as pd

        angles, n = self._angles()
        radius = np.full(n, -np.inf)
        for r in self._part("cells", live, None).groupBy("cell").agg(F.max("radius").alias("radius")).collect():
            radius[r["cell"]] = r["radius"]
        reach = math.acos(max(-1.0, min(1.0, float(self.rules.cosine_threshold))))

        def cells(batches):
            for pdf in batches:
                if len(pdf):
                    may = (angles(pdf["embedding"]) <= radius[None, :] + reach + SLACK).any(axis=0)
                    yield pd.DataFrame({"bucket": np.flatnonzero(may).astype(np.int32)})

        met = self._in_buckets(stored, v.select("embedding").mapInPandas(cells, "bucket int"))
        return met.select("batch", "arr", "id", "embedding", "t")

    def _in_cells(self, leaders: DataFrame) -> DataFrame:
        """Leaders with their cell (``bucket``) and angle to its pivot (``far``)."""
        import numpy as np
        from pyspark.sql import types as T

        if self._read(self._path("pivots")) is None:
            chosen = leaders.select("embedding").orderBy(F.xxhash64("arr", F.lit(3)), "arr").limit(self.pivots).collect()
            rows = [(k, [float(x) for x in r["embedding"]]) for k, r in enumerate(chosen)]
            self.spark.createDataFrame(rows, "n int, v array<float>").write.mode("overwrite").parquet(self._path("pivots"))
        angles, _ = self._angles()

        def deal(batches):
            for pdf in batches:
                if len(pdf):
                    far = angles(pdf["embedding"])
                    cell = far.argmin(axis=1)
                    yield pdf.assign(bucket=cell.astype(np.int32), far=far[np.arange(len(pdf)), cell])

        return leaders.mapInPandas(deal, T.StructType([*leaders.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("far", T.DoubleType())]))

    # -- writing --------------------------------------------------------------------------------------------------

    def _put(self, name: str, gen: str, df: DataFrame) -> list[tuple[str, str]]:
        """Writes a generation of a table; one without rows leaves no file and is not live."""
        path = self._path(name, f"gen={gen}")
        df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return [(name, gen)] if self._read(path) is not None else []

    def _put_cells(self, gen: str, cells: DataFrame) -> list[tuple[str, str]]:
        """The greatest angle of each cell: a row per pivot at most."""
        cells.groupBy("cell").agg(F.max("radius").alias("radius")).coalesce(1).write.mode("overwrite").parquet(self._path("cells", f"gen={gen}"))
        return [("cells", gen)]

    def add(self, batch: int, articles: DataFrame, tables: dict, vectors: DataFrame | None = None, newest: int | None = None) -> None:
        """Stores what a batch leaves: ``tables`` of ``dedup_cascade(..., return_tables=True)`` over ``articles``."""
        live, gen = self.live(batch), f"b{batch}"
        times = articles.select("arr", F.unix_micros("published_at").alias("t"))
        number, ids = F.lit(batch).cast("long").alias("batch"), tables["l1"].select("arr", "id")
        new = self._put("urls", gen, tables["l1"].filter("l1_keep").join(times, "arr").select("url_hash", "t", self._bucket("url_hash").alias("bucket")))
        if self.rules.use_l2:
            leaders = tables["l2"].filter("keep").select("arr", "simhash").join(ids, "arr").join(times, "arr").select(number, "arr", "id", "simhash", "t")
            new += self._put("prints", gen, self._keyed(leaders))
        if self.rules.use_l3 and vectors is not None:
            of = tables["l3"].filter("keep").select("arr").join(vectors.select("arr", "embedding"), "arr").join(ids, "arr").join(times, "arr")
            leaders = of.select(number, "arr", "id", "embedding", "t").checkpoint(eager=True)
            if not leaders.isEmpty():
                dealt = self._in_cells(leaders).checkpoint(eager=True)
                new += self._put("vectors", gen, dealt.drop("far"))
                new += self._put_cells(gen, dealt.select(F.col("bucket").alias("cell"), F.col("far").alias("radius")))
        live = live + new
        if len({g for _, g in live}) > self.compact_every:
            merged, names = f"c{batch}", {n for n, _ in live}
            whole = {n: self._part(n, live, newest) for n in names}
            live = [x for n, d in whole.items() for x in (self._put(n, merged, d) if n != "cells" else self._put_cells(merged, d))]
        live = live or [("", "")]  # an empty store has a manifest as well
        self.spark.createDataFrame(live, "part string, gen string").coalesce(1).write.mode("overwrite").parquet(self._path("manifest", f"batch={batch}"))

    def run(self, batch: int, articles: DataFrame, vectors: DataFrame | None = None):
        """Dedup one batch against the store and add it: (survivors, tables)."""
        newest = articles.agg(F.max(F.unix_micros("published_at"))).first()[0]
        out, tables = dedup.incremental_dedup(articles, self.before(batch, newest), vectors, self.rules, return_tables=True)
        self.add(batch, articles, tables, vectors, newest)
        return out, tables

    def vacuum(self, keep_batches: int = 2) -> list[str]:
        """Deletes generations that none of the last ``keep_batches`` manifests name; returns their paths."""
        m = self._read(self._path("manifest"))
        if m is None:
            return []
        rows = m.select("batch", "gen").distinct().collect()
        last = sorted({r["batch"] for r in rows})[-keep_batches:]
        live = {r["gen"] for r in rows if r["batch"] in last}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        gone = []
        for name in ("urls", "prints", "vectors", "cells"):
            top = jvm.org.apache.hadoop.fs.Path(self._path(name))
            fs = top.getFileSystem(conf)
            for s in fs.listStatus(top) if fs.exists(top) else []:
                if s.getPath().getName().removeprefix("gen=") not in live:
                    fs.delete(s.getPath(), True)
                    gone.append(str(s.getPath()))
        return gone


__all__ = ["LeaderStore"]
