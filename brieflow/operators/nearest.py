"""Exact k-nearest join of vectors by cosine, within parts (domains) of a corpus.

For every query and every part it asks for, the ``k`` corpus rows of greatest dot product. Vectors are unit-norm, so the angle
obeys the triangle inequality, which rules cells out:

* corpus vectors are dealt to the cells of their nearest pivots; of each (part, cell) the number of rows and the greatest
  angle to the pivot are known to every task (a table of at most ``MAX_STATS`` entries: the more parts, the fewer pivots);
* pass 1 looks only into the cells nearest to the query that hold ``k`` rows of the part together. The k-th best value found
  there bounds the true one from below;
* pass 2 looks into all cells whose angle to the query, less their radius, does not exceed the angle of that bound.

The number of pivots grows with the root of the corpus. For pass 2 the corpus lies in blocks of whole cells, ordered by part and cell, and queries
in portions, both bounded; a query is sent once to each block that holds a cell of its, and which cells of the block it needs is found there. So where
bounds rule little out (vectors without clusters) what is shuffled is a row for each query and block, not for each query and cell. Within a block a few
queries at a time meet the rows of one part; products are screened in single precision, and the exact ones of what is left are compared.
Nothing leaves a block but each query's best rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brieflow.session import broadcast_if_small, ensure_checkpoint_dir

#: (part, cell) statistics that every task holds
MAX_STATS = 1 << 22
#: angles are compared with this much room for rounding
SLACK = 1e-6
#: queries and corpus rows of which a task holds all products at a time
TILE_QUERIES, TILE_ROWS = 512, 4096
#: corpus rows of a block for each query of a portion
ROWS_A_QUERY = 4


def nearest_join(queries: DataFrame, corpus: DataFrame, k: int, own_part: bool = False, earlier_only: bool = False,
                 exclude_self: bool = True, block_rows: int = 1 << 15, probes: dict | None = None) -> DataFrame:
    """(qk, p, ck, cos, rank): the ``k`` nearest rows of ``corpus`` (ck, cv, p) to each of ``queries`` (qk, qv, p), ties by ck.

    A query asks for all parts, or with ``own_part`` for its own one (its ``p``) only. ``earlier_only``: corpus rows of smaller key only;
    ``exclude_self``: not the row of its own key. ``block_rows``: queries that meet a block at a time. ``probes``, if given, is told the numbers of
    cells: (query, part, cell) of pass 1 (``first``), of pass 2 (``second``), and without bounds (``all``), and of
    (query, block) rows of pass 2 (``sent``). Null vectors are left out; keys are unique on each side.
    """
    import numpy as np
    import pandas as pd

    spark = queries.sparkSession
    ensure_checkpoint_dir(spark)
    result = "qk long, p string, ck long, cos double"
    q = queries.select("qk", "qv", F.col("p").cast("string").alias("p")).filter("qv is not null") if own_part else queries.select("qk", "qv").filter("qv is not null")
    c = corpus.select("ck", "cv", F.col("p").cast("string").alias("p")).filter("cv is not null and p is not null")
    sizes = c.groupBy("p").agg(F.count("*").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("parts")).first()
    if not total["n"]:
        return spark.createDataFrame([], result + ", rank int")
    pivots_n = max(1, min(math.ceil(math.sqrt(total["n"])), MAX_STATS // total["parts"]))
    chosen = c.select("ck", "cv").orderBy(F.xxhash64("ck", F.lit(3)), "ck").limit(pivots_n).collect()
    pivots = np.array([r["cv"] for r in chosen], np.float64)
    norms = np.linalg.norm(pivots, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(pivots / np.where(norms > 0, norms, 1.0))

    def matrix(vectors) -> np.ndarray:
        return np.stack(vectors.to_numpy()).astype(np.float64)

    def angles(m: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(m, axis=1, keepdims=True)
        return np.arccos(np.clip((m / np.where(length > 0, length, 1.0)) @ shared.value.T, -1.0, 1.0))

    def slices(batches):
        """So few rows that their angles to all pivots are at most four million."""
        rows = max(1, min(block_rows, (1 << 22) // pivots_n))
        for pdf in batches:
            for at in range(0, len(pdf), rows):
                yield pdf.iloc[at:at + rows]

    def deal(batches):
        for pdf in slices(batches):
            far = angles(matrix(pdf["cv"]))
            cell = far.argmin(axis=1)
            yield pdf.assign(cell=cell.astype(np.int32), far=far[np.arange(len(pdf)), cell])

    home = c.mapInPandas(deal, "ck long, cv array<float>, p string, cell int, far double").checkpoint(eager=True)
    # a row for each part and cell of it, at most MAX_STATS (or a row per part); blocks of whole cells, of a cell larger than a block several
    most, filled, last = ROWS_A_QUERY * block_rows, 0, 0
    of_part: dict = {}
    for r in sorted(home.groupBy("p", "cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect(), key=lambda r: (r["p"], r["cell"])):
        if filled and filled + r["n"] > most:
            last, filled = last + 1, 0
        cuts = math.ceil(r["n"] / most)
        of_part.setdefault(r["p"], []).append((r["cell"], r["radius"], r["n"], last, cuts))
        last, filled = last + cuts - 1, filled + r["n"] if cuts == 1 else most
    blocks = last + 1
    told = spark.sparkContext.broadcast({p: tuple(np.array(x) for x in zip(*v)) for p, v in of_part.items()})
    enough = k + (1 if exclude_self else 0)

    def nearest_cells(far: np.ndarray, part: str) -> np.ndarray:
        """For one part: (query, cell of the part) to look into first."""
        cells, n = told.value[part][0], told.value[part][2]
        order = np.argsort(far[:, cells], axis=1, kind="stable")
        held = np.cumsum(n[order], axis=1)
        take = np.zeros(order.shape, bool)
        np.put_along_axis(take, order, (held - n[order]) < enough, axis=1)
        return take

    def may_hold(far: np.ndarray, bound: np.ndarray, part: str) -> np.ndarray:
        """For one part: (query, cell of the part) that may hold a row of at least ``bound``."""
        cells, radius = told.value[part][:2]
        may = far[:, cells] - radius <= np.arccos(np.clip(bound, -1.0, 1.0))[:, None] + SLACK
        may[bound <= -1.0] = True
        return may

    def asking(pdf: pd.DataFrame, part: str) -> np.ndarray:
        return np.flatnonzero(pdf["p"].to_numpy() == part) if own_part else np.arange(len(pdf))

    def parts_of(pdf: pd.DataFrame):
        return [p for p in pdf["p"].dropna().unique() if p in told.value] if own_part else list(told.value)

    def first(batches):
        """Rows with the cells to look into first, of whichever part."""
        for pdf in slices(batches):
            far, take = angles(matrix(pdf["qv"])), np.zeros((len(pdf), pivots_n), bool)
            asked = np.zeros(len(pdf), np.int64)
            for part in parts_of(pdf):
                rows = asking(pdf, part)
                mine = nearest_cells(far[rows], part)
                asked[rows] += mine.sum(axis=1)
                take[np.ix_(rows, told.value[part][0])] |= mine
            yield pdf.assign(ats=[np.flatnonzero(t).astype(np.int32) for t in take], asked=asked)

    def second(batches):
        """Rows with the blocks to look into."""
        for pdf in slices(batches):
            far, take = angles(matrix(pdf["qv"])), np.zeros((len(pdf), blocks), bool)
            asked = np.zeros(len(pdf), np.int64)
            known = [dict(zip(p, b)) for p, b in zip(pdf["ps"], pdf["bounds"])]
            for part in parts_of(pdf):
                rows = asking(pdf, part)
                may = may_hold(far[rows], np.array([known[i].get(part, -2.0) for i in rows]), part)
                asked[rows] += may.sum(axis=1)
                base, cuts = told.value[part][3:]
                for at in np.unique(base):
                    take[rows, at] |= may[:, base == at].any(axis=1)
                for j in np.flatnonzero(cuts > 1):
                    take[rows, base[j]:base[j] + cuts[j]] |= may[:, [j]]
            yield pdf.assign(ats=[np.flatnonzero(t).astype(np.int32) for t in take], asked=asked)

    def block(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qk": pd.Series([], dtype="int64"), "p": pd.Series([], dtype=str), "ck": pd.Series([], dtype="int64"), "cos": pd.Series([], dtype="float64")})
        if lp.empty or rp.empty:
            return empty
        bounded = "bounds" in lp.columns
        rp = rp.sort_values(["p", "cell", "ck"])
        ck, parts, cell, vectors = rp["ck"].to_numpy(dtype=np.int64), rp["p"].to_numpy(), rp["cell"].to_numpy(), matrix(rp["cv"])
        wide = matrix(lp["qv"])
        if bounded:  # queries of near cells together: they need the same cells
            near = np.concatenate([angles(wide[at:at + TILE_QUERIES]).argmin(axis=1) for at in range(0, len(wide), TILE_QUERIES)])
            order = np.argsort(near, kind="stable")
            lp, wide = lp.iloc[order], wide[order]
        keys = lp["qk"].to_numpy(dtype=np.int64)
        rough, length = vectors.astype(np.float32), float(np.sqrt((vectors ** 2).sum(axis=1).max()))
        sections = {p: np.flatnonzero(parts == p) for p in dict.fromkeys(parts)}
        out = []
        for at in range(0, len(lp), TILE_QUERIES):
            pdf, m = lp.iloc[at:at + TILE_QUERIES], wide[at:at + TILE_QUERIES]
            far = angles(m) if bounded else None
            room = 1e-5 * length * np.linalg.norm(m, axis=1) + 1e-12
            known = [dict(zip(p, b)) for p, b in zip(pdf["ps"], pdf["bounds"])] if bounded else None
            for part, of in sections.items():
                rows = asking(pdf, part)
                if not len(rows):
                    continue
                least = np.full(len(rows), -2.0)
                if bounded:
                    least = np.array([known[i].get(part, -2.0) for i in rows])
                    needed = np.zeros(pivots_n, bool)
                    needed[told.value[part][0][may_hold(far[rows], least, part).any(axis=0)]] = True
                    of = of[needed[cell[of]]]
                least = np.where(least <= -1.0, -np.inf, least)
                qk, small = keys[at:at + TILE_QUERIES][rows], m[rows].astype(np.float32)
                floor = (least - room[rows]).astype(np.float32)
                hits_i, hits_j = [], []
                for start in range(0, len(of), TILE_ROWS):
                    cols = of[start:start + TILE_ROWS]
                    dots = small @ rough[cols].T
                    if earlier_only:
                        dots[ck[cols][None, :] >= qk[:, None]] = -np.inf
                    elif exclude_self:
                        dots[ck[cols][None, :] == qk[:, None]] = -np.inf
                    if start == 0 and len(cols) > k:  # the k-th best of these is a bound as well
                        floor = np.maximum(floor, np.partition(dots, len(cols) - k, axis=1)[:, len(cols) - k] - 2 * room[rows].astype(np.float32))
                    i, j = np.nonzero((dots >= floor[:, None]) & np.isfinite(dots))
                    hits_i.append(i)
                    hits_j.append(cols[j])
                if not hits_i:
                    continue
                i, j = np.concatenate(hits_i), np.concatenate(hits_j)
                values = np.concatenate([np.einsum("ij,ij->i", m[rows[i[x:x + 65536]]], vectors[j[x:x + 65536]]) for x in range(0, len(i), 65536)] or [np.zeros(0)])
                good = values >= least[i]  # an equal value still counts: ties go by key
                i, j, values = i[good], j[good], values[good]
                order = np.lexsort((ck[j], -values, i))
                i, j, values = i[order], j[order], values[order]
                starts = np.searchsorted(i, np.arange(len(rows)))
                best = np.arange(len(i)) - starts[i] < k
                i, j, values = i[best], j[best], values[best]
                out.append(pd.DataFrame({"qk": qk[i], "p": part, "ck": ck[j], "cos": values}))
        return pd.concat(out) if out else empty

    def search(requests: DataFrame, stored: DataFrame, most: int) -> DataFrame:
        """Best rows by block: ``requests`` with the numbers ``ats`` of blocks, ``stored`` rows with the number ``at`` of theirs."""
        requests = requests.drop("asked").withColumn("at", F.explode("ats")).drop("ats")
        met = requests.groupBy("at").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("sides"))
        cuts = stored.groupBy("at").agg(F.ceil(F.count("*") / most).cast("int").alias("chunks")).join(met, "at").checkpoint(eager=True)
        cuts = broadcast_if_small(cuts)
        left = (requests.join(cuts, "at").withColumn("side", F.pmod(F.xxhash64("qk", F.lit(2)), F.col("sides")).cast("int"))
                .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("sides", "chunks"))
        right = (stored.join(cuts, "at").withColumn("chunk", F.pmod(F.xxhash64("ck", F.lit(1)), F.col("chunks")).cast("int"))
                 .withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).drop("sides", "chunks", "far"))
        key = ["at", "chunk", "side"]
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(block, result)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("qk", "p").orderBy(F.col("cos").desc(), F.col("ck").asc())
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def blocked(batches):
        for pdf in batches:
            at = np.zeros(len(pdf), np.int32)
            spread = pdf["spread"].to_numpy()
            cells, parts = pdf["cell"].to_numpy(), pdf["p"].to_numpy()
            for part in pdf["p"].unique():
                rows = np.flatnonzero(parts == part)
                own, base, cuts = told.value[part][0], told.value[part][3], told.value[part][4]
                where = np.searchsorted(own, cells[rows])
                at[rows] = base[where] + spread[rows] % cuts[where]
            yield pdf.drop(columns="spread").assign(at=at)

    extra = "qk long, qv array<float>" + (", p string" if own_part else "")
    requests = q.mapInPandas(first, extra + ", ats array<int>, asked long").checkpoint(eager=True)
    near = best(search(requests, home.withColumnRenamed("cell", "at").withColumn("cell", F.col("at")), block_rows))
    bound = near.groupBy("qk", "p").agg(F.when(F.count("*") >= k, F.min("cos")).otherwise(F.lit(-2.0)).alias("bound"))
    bounds = bound.groupBy("qk").agg(F.collect_list(F.struct("p", "bound")).alias("_b"))  # an entry per part
    known = q.join(bounds, "qk", "left").select(*q.columns, F.coalesce(F.col("_b.p"), F.array().cast("array<string>")).alias("ps"),
                                                F.coalesce(F.col("_b.bound"), F.array().cast("array<double>")).alias("bounds"))
    more = known.mapInPandas(second, extra + ", ps array<string>, bounds array<double>, ats array<int>, asked long").checkpoint(eager=True)
    if probes is not None:
        asked_for = [x.select(F.coalesce(F.sum("asked"), F.lit(0))).first()[0] for x in (requests, more)]
        targets = q.groupBy("p").count().collect() if own_part else [(p, q.count()) for p in of_part]
        sent = more.select(F.coalesce(F.sum(F.size("ats")), F.lit(0))).first()[0]
        probes.update(first=asked_for[0], second=asked_for[1], sent=sent, all=sum(n * len(of_part.get(p, ())) for p, n in targets))
    dealt = home.withColumn("spread", F.pmod(F.xxhash64("ck", F.lit(5)), F.lit(1 << 30)).cast("int")).mapInPandas(
        blocked, "ck long, cv array<float>, p string, cell int, far double, at int")
    # a cut cell's rows are spread by hash, so its blocks may pass ``most`` by a little
    return best(search(more, dealt.checkpoint(eager=True), 2 * most))


__all__ = ["nearest_join"]
