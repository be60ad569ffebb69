"""Fingerprints and similarity self-joins.

Design for scale:

* SimHash (A22) is map-only: one Arrow-batched helper per article text
  (``method='native'`` is the same value from exploded shingles and JVM sums).
* Hamming pairs (A17) never compare all pairs. A 64-bit fingerprint is cut
  into ``m`` blocks; two fingerprints within distance ``k`` agree on at least
  ``m - k`` blocks (pigeonhole), so an equi-join on every combination of
  ``m - k`` blocks finds every pair exactly. ``m`` is chosen from the number
  of distinct fingerprints (:func:`choose_blocks`), so buckets stay small at any
  scale; the pairs are the same for every ``m``. A pair is emitted only under
  the first key it matches, so no ``distinct`` shuffle is needed. Exact copies
  are one fingerprint before the join, so a fingerprint held by a third of all
  rows costs one row.
* Cosine pairs (A18) are exact at every size. Vectors are dealt to the cells of
  their nearest pivots; by the triangle inequality of angles a vector can only
  match a cell whose pivot is at most the cell's radius plus the threshold
  angle away. Cells and the vectors that probe them are cut into blocks of
  bounded size on both sides. ``mode='lsh'`` (approximate, recall below 1) runs
  on explicit request only.
* Jaccard pairs (B02) are exact: equal shingle sets are one class, and a prefix
  filter over rare-first shingles finds every pair at or above the threshold.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import article_text
from brieflow.session import broadcast_if_small, ensure_checkpoint_dir, scratch_path


# ---------------------------------------------------------------------------
# A22 / A23 SimHash
# ---------------------------------------------------------------------------

def simhash_text(body_chars: int = 500) -> Column:
    """``title + ' ' + (body or summary)[:500]``."""
    return article_text(body_chars=body_chars)


def simhash64(df: DataFrame, key: str = "arr", text: Column | None = None,
              out: str = "simhash", method: str = "arrow", carry: tuple[Column, ...] = ()) -> DataFrame:
    """64-bit SimHash per row of ``df`` -> (key, simhash BIGINT), with the columns ``carry`` (arrow only).

    Lower-case, keep runs of word characters/CJK, concatenate, slide 4-char
    shingles (at least one), weight by occurrence, hash = low 64 bits of MD5,
    bit i set iff more than half of the shingle weight has bit i set.

    ``method='arrow'`` (default): vectorised per-batch helper, map-only.
    ``method='native'``: shingles exploded and reduced with 64 JVM sums
    (partial aggregation per article before one shuffle); same result.
    """
    text = simhash_text() if text is None else text
    if method == "arrow":
        from brieflow.functions.fingerprint import simhash_col
        return df.select(F.col(key), *carry, simhash_col(text).alias(out))
    s = F.array_join(F.regexp_extract_all(F.lower(text), F.lit(P.SIMHASH_TOKEN_PATTERN), 0), "")
    w = P.SIMHASH_SHINGLE
    base = df.select(F.col(key).alias("_k"), s.alias("_s"))
    sh = base.select("_k", F.explode(F.expr(
        f"transform(sequence(1, greatest(length(_s) - {w - 1}, 1)), i -> substring(_s, i, {w}))")).alias("_g"))
    sh = sh.select("_k", F.expr("CAST(conv(substring(md5(_g), 17, 16), 16, -10) AS BIGINT)").alias("_h"))
    sums = [F.expr(f"sum(shiftrightunsigned(_h, {j}) & 1)").alias(f"_p{j}") for j in range(64)]
    agg = sh.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), *sums)
    bits = " | ".join(f"CASE WHEN 2 * _p{j} > _n THEN shiftleft(1L, {j}) ELSE 0L END" for j in range(64))
    return agg.select(F.col("_k").alias(key), F.expr(bits).alias(out))


def hamming_distance(a, b) -> Column:
    """A23."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


# ---------------------------------------------------------------------------
# A17 Hamming pairs
# ---------------------------------------------------------------------------

def _block_layout(m: int, bits: int = 64) -> list[tuple[int, int]]:
    """(offset, width) of m near-equal blocks covering ``bits`` bits, widest first."""
    base, extra = divmod(bits, m)
    widths = [base + 1] * extra + [base] * (m - extra)
    out, off = [], 0
    for wdt in widths:
        out.append((off, wdt))
        off += wdt
    return out


def choose_blocks(n_distinct: int, max_distance: int = P.SIMHASH_MAX_DISTANCE,
                  target_bucket: float = 4.0) -> int:
    """Smallest block count ``m`` in [k+1, 2k+2] whose keys give expected bucket
    sizes ≤ ``target_bucket`` for ``n_distinct`` random fingerprints."""
    k = max_distance
    for m in range(k + 1, 2 * k + 3):
        key_bits = min(64, round(64 * (m - k) / m))
        if n_distinct / (2.0 ** key_bits) <= target_bucket:
            return m
    return 2 * k + 2


def _combinations(m: int, k: int) -> list[tuple[int, ...]]:
    return list(combinations(range(m), m - k))


def _block_value(col: str, offset: int, width: int) -> str:
    return f"(shiftrightunsigned({col}, {offset}) & {(1 << width) - 1}L)"


def band_keys(col: str, blocks: int, max_distance: int) -> Column:
    """array<struct<c,v>>: for every combination of ``blocks - max_distance`` blocks of a fingerprint, its number and the
    packed bits of its blocks. Fingerprints within ``max_distance`` bits share at least one."""
    layout = _block_layout(blocks)
    keys = []
    for ci, c in enumerate(_combinations(blocks, max_distance)):
        parts, shift = [], 0
        for b in c:
            parts.append(f"shiftleft({_block_value(col, *layout[b])}, {shift})")
            shift += layout[b][1]
        keys.append(f"named_struct('c', {ci}, 'v', {' | '.join(parts)})")
    return F.expr(f"array({', '.join(keys)})")


def hamming_pairs(fps: DataFrame, max_distance: int = P.SIMHASH_MAX_DISTANCE, fp_col: str = "simhash",
                  blocks: int | None = None, other: DataFrame | None = None) -> DataFrame:
    """All pairs of *distinct* fingerprints within ``max_distance`` bits.

    Returns (fp_a, fp_b, dist) with fp_a < fp_b; with ``other`` all pairs of a value of ``fps`` and one of ``other``, equal ones
    included, and none within a table. Exact (no false negatives,
    no false positives) for any number of ``blocks``; None chooses it from the
    number of distinct fingerprints. These are materialised once. The keys meet by a sort-merge join: Spark would judge their
    size by the fingerprints before the explode, and broadcast a table of up to 70 times that size.
    """
    k = int(max_distance)
    ensure_checkpoint_dir(fps.sparkSession)
    d, e = (x if x is None else x.select(F.col(fp_col).alias("fp")).filter(F.col("fp").isNotNull()).distinct().checkpoint(eager=True) for x in (fps, other))
    if blocks is None:
        blocks = choose_blocks(d.count() if e is None else max(d.count(), e.count()), k)
    m = blocks
    if m < k + 1:
        raise ValueError("blocks must be at least max_distance + 1")
    layout, combos = _block_layout(m), _combinations(m, k)
    masks = [sum(1 << b for b in c) for c in combos]

    def block_val(col: str, b: int) -> str:
        return _block_value(col, *layout[b])

    # one row per (fingerprint, combination)
    def keyed(values: DataFrame, name: str) -> DataFrame:
        return values.select(F.col("fp").alias(name), F.explode(band_keys("fp", m, k)).alias("key")).select(name, F.col("key.c").alias("c"), F.col("key.v").alias("v"))

    cand = keyed(d, "fp_a").join(keyed(d if e is None else e, "fp_b").hint("merge"), ["c", "v"])
    if e is None:
        cand = cand.filter(F.col("fp_a") < F.col("fp_b"))
    dist = hamming_distance("fp_a", "fp_b")
    # bitmask of equal blocks; emit only under the first combination fully contained in it
    eq = " | ".join(f"CASE WHEN {block_val('_x', b)} = 0 THEN {1 << b} ELSE 0 END" for b in range(m))
    first = "CASE " + " ".join(f"WHEN (_eq & {mk}) = {mk} THEN {ci}" for ci, mk in enumerate(masks)) + " END"
    out = (cand.withColumn("dist", dist).filter(F.col("dist") <= k)
               .withColumn("_x", F.col("fp_a").bitwiseXOR(F.col("fp_b")))
               .withColumn("_eq", F.expr(eq))
               .filter(F.expr(first) == F.col("c")))
    return out.select("fp_a", "fp_b", "dist")


# ---------------------------------------------------------------------------
# A18 cosine pairs
# ---------------------------------------------------------------------------

def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(F.col(a), F.col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, v: s + v)


def cosine_pairs(vecs: DataFrame, threshold: float = P.SEMANTIC_COSINE_THRESHOLD, key: str = "arr",
                 vec_col: str = "embedding", mode: str = "exact", block_rows: int = 2048,
                 lsh_tables: int = 8, lsh_bucket_length: float | None = None, seed: int = 7, within: int | None = None) -> DataFrame:
    """Pairs (a, b, cos) with a < b (by ``key``) and dot product ≥ ``threshold``; with ``within`` (exact only) their ``t`` differ by
    so much at most, which is looked at where they meet (a null ``t`` is near nothing).

    Vectors are unit-norm (the dot product is the cosine); ``key`` is unique. ``exact``
    (the default at every size) finds all pairs; ``lsh`` is approximate and must be asked for.
    """
    v = _vectors(vecs, key, vec_col, within)
    if mode == "exact":
        pairs = _cosine_join(v, None, threshold, block_rows, within)
        return pairs.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"), "cos")
    if mode == "lsh":
        return _cosine_lsh(v.select("k", "v"), threshold, lsh_tables, lsh_bucket_length, seed)
    raise ValueError(mode)


def _vectors(vecs: DataFrame, key: str, vec_col: str, within: int | None) -> DataFrame:
    """(k, v, t) of what can meet; without ``within`` all times are the same."""
    t = F.lit(0).cast("long") if within is None else F.col("t").cast("long")
    return vecs.select(F.col(key).alias("k"), F.col(vec_col).alias("v"), t.alias("t")).filter("v is not null and t is not null")


def cosine_cross_pairs(left: DataFrame, right: DataFrame, threshold: float = P.SEMANTIC_COSINE_THRESHOLD,
                       key: str = "arr", vec_col: str = "embedding", block_rows: int = 2048, within: int | None = None) -> DataFrame:
    """All (l, r, cos) between two tables of vectors with dot product ≥ ``threshold`` (exact), ``within`` as in :func:`cosine_pairs`."""
    lv, rv = (_vectors(d, key, vec_col, within) for d in (left, right))
    return _cosine_join(lv, rv, threshold, block_rows, within)


#: bytes of the pivots' vectors, of which every task holds a copy (with the statistics of their cells, all that the driver sees)
PIVOT_BYTES = 1 << 28


def _cosine_join(left: DataFrame, right: DataFrame | None, threshold: float, block_rows: int, within: int | None = None) -> DataFrame:
    """Exact join on the dot product; ``right`` None joins ``left`` with itself, each pair once."""
    import numpy as np
    import pandas as pd

    spark, itself = left.sparkSession, right is None
    ensure_checkpoint_dir(spark)
    base = left if itself else right
    n = base.count()
    empty = "l long, r long, cos double"
    if n == 0:
        return spark.createDataFrame([], empty)
    # cells of half a block, until there are so many that meeting the pivots would cost more than meeting a cell
    width = len(base.select("v").first()["v"])
    size = max(1, min(2 * math.ceil(n / block_rows), 4 * math.ceil(math.sqrt(n)), PIVOT_BYTES // (8 * max(width, 1))))
    chosen = base.orderBy(F.xxhash64("k", F.lit(3)), "k").limit(size).collect()
    pivots = np.array([r["v"] for r in chosen], np.float64)
    norms = np.linalg.norm(pivots, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(pivots / np.where(norms > 0, norms, 1.0))
    # a vector's angle to each pivot; rounding is covered by SLACK
    slack, reach = 1e-6, math.acos(max(-1.0, min(1.0, float(threshold))))

    def angles(vectors) -> np.ndarray:
        m = np.stack(vectors.to_numpy()).astype(np.float64)
        length = np.linalg.norm(m, axis=1, keepdims=True)
        return np.arccos(np.clip((m / np.where(length > 0, length, 1.0)) @ shared.value.T, -1.0, 1.0))

    def portions(batches):
        """So few rows that their angles to all pivots are at most four million."""
        rows = max(1, (1 << 22) // size)
        for pdf in batches:
            for at in range(0, len(pdf), rows):
                yield pdf.iloc[at:at + rows]

    def deal(batches):
        for pdf in portions(batches):
            far = angles(pdf["v"])
            cell = far.argmin(axis=1)
            yield pdf.assign(cell=cell.astype(np.int32), far=far[np.arange(len(pdf)), cell])

    home = base.mapInPandas(deal, "k long, v array<float>, t long, cell int, far double").checkpoint(eager=True)
    stats = {r["cell"]: r for r in home.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect()}
    radius = np.full(size, -np.inf)
    for c, r in stats.items():
        radius[c] = r["radius"]

    def probe(batches):
        for pdf in portions(batches):
            far = angles(pdf["v"])
            may = far <= radius[None, :] + reach + slack
            if itself:  # a cell is probed from the cells of lower number and by itself
                own = pdf["cell"].to_numpy()
                may &= np.arange(size)[None, :] >= own[:, None]
                may[np.arange(len(pdf)), own] = True
            yield pdf[["k", "v", "t"]].assign(cells=[np.flatnonzero(m).astype(np.int32) for m in may],
                                         own=pdf["cell"].astype(np.int32) if itself else np.int32(-1))

    probes = (home if itself else left).mapInPandas(probe, "k long, v array<float>, t long, cells array<int>, own int")
    probes = probes.checkpoint(eager=True)
    met = probes.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    cuts = home.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("chunks")).join(met, "cell").checkpoint(eager=True)
    cuts = broadcast_if_small(cuts)  # a row for each cell
    h = (home.join(cuts, "cell").withColumn("chunk", F.pmod(F.xxhash64("k", F.lit(1)), F.col("chunks")).cast("int"))
         .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
         .select(F.col("k").alias("rk"), F.col("v").alias("rv"), F.col("t").alias("rt"), "cell", "chunk", "part"))
    q = (probes.select("k", "v", "t", "own", F.explode("cells").alias("cell")).join(cuts, "cell")
         .withColumn("part", F.pmod(F.xxhash64("k", F.lit(2)), F.col("parts")).cast("int"))
         .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
         .select(F.col("k").alias("lk"), F.col("v").alias("lv"), F.col("t").alias("lt"), "own", "cell", "chunk", "part"))
    t = float(threshold)

    def block(lp: pd.DataFrame, rp: pd.DataFrame) -> pd.DataFrame:
        if lp.empty or rp.empty:
            return pd.DataFrame({"l": pd.Series([], dtype="int64"), "r": pd.Series([], dtype="int64"), "cos": pd.Series([], dtype="float64")})
        lk, rk = lp["lk"].to_numpy(dtype=np.int64), rp["rk"].to_numpy(dtype=np.int64)
        dots = np.stack(lp["lv"].to_numpy()).astype(np.float64) @ np.stack(rp["rv"].to_numpy()).astype(np.float64).T
        good = dots >= t
        if within is not None:
            good &= np.abs(lp["lt"].to_numpy(dtype=np.int64)[:, None] - rp["rt"].to_numpy(dtype=np.int64)[None, :]) <= within
        if itself:  # within its own cell a vector meets the larger keys only
            inside = lp["own"].to_numpy() == lp["cell"].to_numpy()
            good &= ~inside[:, None] | (lk[:, None] < rk[None, :])
        i, j = np.nonzero(good)
        return pd.DataFrame({"l": lk[i], "r": rk[j], "cos": dots[i, j]})

    return q.groupBy("cell", "chunk", "part").cogroup(h.groupBy("cell", "chunk", "part")).applyInPandas(block, schema=empty)


def _cosine_lsh(v: DataFrame, threshold: float, tables: int, bucket_length, seed: int) -> DataFrame:
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    # on unit vectors: cos >= t  <=>  euclidean distance <= sqrt(2 - 2t)
    radius = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    vv = v.withColumn("u", array_to_vector(F.transform(F.col("v"), lambda x: x.cast("double") / norm)))
    lsh = BucketedRandomProjectionLSH(inputCol="u", outputCol="h", numHashTables=tables,
                                      bucketLength=bucket_length or max(radius, 1e-3) * 2, seed=seed)
    model = lsh.fit(vv)
    joined = model.approxSimilarityJoin(vv, vv, radius * 1.0000001, distCol="d")
    pairs = joined.select(F.col("datasetA.k").alias("a"), F.col("datasetB.k").alias("b"),
                          F.col("datasetA.v").alias("va"), F.col("datasetB.v").alias("vb")).filter("a < b")
    return pairs.withColumn("cos", _dot("va", "vb")).filter(F.col("cos") >= threshold).select("a", "b", "cos")


# ---------------------------------------------------------------------------
# B02 MinHash near-duplicates
# ---------------------------------------------------------------------------

def words_of(text: Column) -> Column:
    """Word tokens of lower-cased text (array<string>)."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def shingle_set(words: Column, width: int = 4) -> Column:
    """Distinct word ``width``-grams of a *materialised* word-array column.

    Pass a column reference, not an expression: a lambda re-evaluates captured
    expressions for every element. Fewer words than ``width`` are one gram; no words, none.
    """
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1))),
                        lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) > 0, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


#: shingles a hash bucket in which they are counted for their order, and buckets at most; their counts (4 bytes each) are all that the driver sees
BUCKET_SHINGLES, MOST_BUCKETS, BUCKET_PARTS = 64, 1 << 24, 256
#: so many shingles of a set give one more that must be met among the first ones
MORE_SHARED = 20
#: words or shingles that a task works on at once, a whole text at least
AT_ONCE = 1 << 20


def _shingling():
    """(lists, hashes): what the tasks below call, as closures, since a task need not find this module."""
    import numpy as np

    def lists(batches, column: str):
        """Of Arrow batches, in portions of about ``AT_ONCE`` values: the portion, the values of its list column as uint64 and the rows' n + 1 offsets."""
        for b in batches:
            ends = b.column(column).offsets.to_numpy()
            at = 0
            while at < b.num_rows:
                upto = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE, "right")) - 1)
                lists = b.column(column).slice(at, upto - at)
                yield b.slice(at, upto - at), lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), ends[at:upto + 1] - ends[at]
                at = upto

    def hashes(words, offsets, width: int):
        """(row, hash) of all runs of ``width`` consecutive word hashes within a row; a row of fewer words, but not none, is one run."""
        n = np.diff(offsets)
        runs = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
        row = np.repeat(np.arange(len(n)), runs)
        start = offsets[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
        h = np.full(len(row), 0x9E3779B97F4A7C15, np.uint64)
        for i in range(width):
            inside = start + i < offsets[1:][row]
            x = (h ^ words[np.where(inside, start + i, 0)]) * np.uint64(0xFF51AFD7ED558CCD) if len(words) else h
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            h = np.where(inside, x ^ (x >> np.uint64(29)), h)
        return row, h

    return lists, hashes


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder, of which later steps read the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shingle_sets(words: DataFrame, width: int) -> DataFrame:
    """Of (k, w), w the hashes of a text's words: (k, c, n, s), s the sorted distinct hashes of its shingles, n their number and c a digest of s."""
    lists, hashes = _shingling()

    def sets(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for b, values, offsets in lists(batches, "w"):
            row, h = hashes(values, offsets, width)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
            row, h = row[fresh], h[fresh].view(np.int64)
            n = np.bincount(row, minlength=b.num_rows)
            at = np.concatenate([[0], np.cumsum(n)])
            digest = [hashlib.sha256(h[i:j].tobytes()).digest() for i, j in zip(at[:-1], at[1:])]
            whole = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(digest, pa.binary()), pa.array(n, pa.int32()), whole], ["k", "c", "n", "s"])

    return words.mapInArrow(sets, f"k {words.schema['k'].dataType.simpleString()}, c binary, n int, s array<bigint>")


def _bucket_counts(sets: DataFrame):
    """Number of shingles (each once a text, 2^31 - 1 at most) in each hash bucket, summed by parts of the buckets."""
    import numpy as np
    import pandas as pd

    lists, _ = _shingling()
    total = sets.agg(F.sum("n")).first()[0] or 0
    size = min(MOST_BUCKETS, max(1 << 16, 1 << math.ceil(math.log2(total / BUCKET_SHINGLES + 1))))
    parts_of, most = BUCKET_PARTS, np.iinfo(np.int32).max

    def count(batches):
        import pyarrow as pa

        held = np.zeros(size, np.int32)
        for _, values, _ in lists(batches, "s"):
            buckets, n = np.unique(values % np.uint64(size), return_counts=True)
            held[buckets.view(np.int64)] += n.astype(np.int32)
        parts = [p.tobytes() for p in np.split(held, parts_of)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts_of), pa.int32()), pa.array(parts, pa.binary())], ["part", "held"])

    def add(key, pdf: pd.DataFrame) -> pd.DataFrame:
        whole = np.zeros(size // parts_of, np.int64)
        for p in pdf["held"]:
            whole += np.frombuffer(p, np.int32)
        return pd.DataFrame({"part": [key[0]], "held": [np.minimum(whole, most).astype(np.int32).tobytes()]})

    sums = sets.select("s").mapInArrow(count, "part int, held binary").groupBy("part").applyInPandas(add, "part int, held binary").collect()
    whole = np.zeros((parts_of, size // parts_of), np.int32)
    for r in sums:
        whole[r["part"]] = np.frombuffer(r["held"], np.int32)
    return whole.ravel()


def _shingle_prefixes(sets: DataFrame, threshold: float) -> DataFrame:
    """(k, c, n, p): the ``n - ceil(t n) + m`` first shingles of each set, in the order of their buckets' counts, then of their hashes, and ``m``
    as in :func:`_must_share`."""
    shared = sets.sparkSession.sparkContext.broadcast(_bucket_counts(sets))
    (lists, _), more = _shingling(), MORE_SHARED

    def first(batches):
        import numpy as np
        import pyarrow as pa

        for b, values, offsets in lists(batches, "s"):
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            held = shared.value[(values % np.uint64(len(shared.value))).view(np.int64)]
            values = values[np.lexsort((values, held, row))]
            need = np.ceil(threshold * n - 1e-9).astype(np.int64)
            keep = np.minimum(n - need + np.minimum(1 + n // more, np.maximum(need, 1)), n)
            inside = np.arange(len(row)) - offsets[:-1][row] < keep[row]
            at = np.concatenate([[0], np.cumsum(keep)])
            head = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values[inside].view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("c"), b.column("n"), head], ["k", "c", "n", "p"])

    return sets.mapInArrow(first, f"k {sets.schema['k'].dataType.simpleString()}, c binary, n int, p array<bigint>")


def _must_share(n: Column, threshold: float) -> Column:
    """How many of the first shingles two sets must share if the smaller one has ``n``."""
    return F.least(F.lit(1) + F.floor(n / MORE_SHARED), F.greatest(F.ceil(F.lit(threshold) * n - F.lit(1e-9)), F.lit(1)))


def minhash_near_dup(df: DataFrame, key: str = "arr", text: Column | None = None, shingle: int = 4,
                     threshold: float = 0.8) -> DataFrame:
    """Pairs (a, b, jaccard) of word-``shingle`` sets with Jaccard ≥ ``threshold``, exact.

    Shingles are kept as 64-bit hashes. Documents with equal sets are one class, named by its least
    key: a class member is paired with that name only (jaccard 1), and other pairs are between names, so
    copies never multiply into all their pairs and no link is lost. Texts without words are left out.

    Two sets with Jaccard ≥ t share ``ceil(t |s|)`` shingles for either s, so if m of these are short of it in what follows the ``|s| - ceil(t |s|) + m``
    first shingles of each, in any common order, the first ones share m. For m a twentieth of the set is taken, so sets that share a few
    frequent shingles by chance are no candidates. In rare-first order a shingle that many documents hold is hardly ever among the first. For the
    order shingles are counted by hash buckets, over all texts: only the first shingles of each set ever shuffle by shingle.
    The first shingle that two sets share also bounds how many they can share, by how many follow it in each.
    The sets themselves are fetched for the candidates that are left.
    """
    ensure_checkpoint_dir(df.sparkSession)
    text = article_text() if text is None else text
    words = df.select(F.col(key).alias("k"), F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("w"))
    # filtered afterwards: a filter of the words would be computed from the text once more
    sets = _stored(_shingle_sets(words, shingle).filter("n > 0"), "shingle-sets")
    names = sets.groupBy("c").agg(F.min("k").alias("name"))
    named = sets.select("k", "c").join(names, "c")
    member = named.filter("k != name").select(F.col("name").alias("a"), F.col("k").alias("b"), F.lit(1.0).alias("jaccard"))
    own = named.filter("k = name").select("k", "c")
    t = float(threshold)
    heads = _stored(_shingle_prefixes(sets, t).join(own, ["k", "c"], "left_semi"), "shingle-prefixes")
    left, right = (heads.select("k", "n", F.posexplode("p").alias("at", "g")).toDF(x, f"n{x}", f"at{x}", "g") for x in "ab")
    fits = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(t) * F.greatest("na", "nb") - F.lit(1e-9))
    met = left.join(right.hint("merge"), "g").filter(fits).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met"), F.min("ata").alias("ata"), F.min("atb").alias("atb"))
    reach = F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb")) >= F.lit(t / (1 + t)) * (F.col("na") + F.col("nb")) - F.lit(1e-6)
    cand = met.filter((F.col("met") >= _must_share(F.least("na", "nb"), t)) & reach).select("a", "b").distinct()
    classes = sets.select("k", "c", "s").join(own, ["k", "c"], "left_semi")
    sa, sb = classes.select(F.col("k").alias("a"), F.col("s").alias("sa")), classes.select(F.col("k").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    jaccard = both / (F.size("sa") + F.size("sb") - both)
    pairs = cand.join(sa, "a").join(sb, "b").withColumn("jaccard", jaccard).filter(F.col("jaccard") >= t - 1e-12)
    return pairs.select("a", "b", "jaccard").unionByName(member)


__all__ = ["simhash64", "hamming_distance", "hamming_pairs", "choose_blocks", "cosine_pairs", "cosine_cross_pairs",
           "minhash_near_dup", "shingle_set"]
