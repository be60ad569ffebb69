"""Deduplication cascade.

Article rows carry ``arr`` (BIGINT, total arrival order) and ``id``.

* L1 (A21) keeps the first article per URL hash: a hash aggregate
  ``min(arr)`` per hash (partial aggregation absorbs a hot URL), joined back
  on the unique ``arr``.
* L2 (A24) runs SimHash on L1 survivors, collapses equal fingerprints to
  their earliest holder (copies share a neighbourhood, so the earliest copy
  decides for all of them) and elects leaders among them by their bands, without a list of pairs.
* L3 (A25) does the same on L2 leaders with vectors, using cosine pairs.
* With a story window (B05) only articles published within the window of each other are near, in both stages; copies then
  collapse by fingerprint and time, and bands are cut into overlapping time buckets of two windows.
* The story map (A27) has one row per distinct ``id``; a later stage wins.
  Corroboration (A28) counts map rows per story id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import canonical_url
from brieflow.operators.election import first_fit, leader_election
from brieflow.operators.similarity import (_dot, band_keys, choose_blocks, cosine_cross_pairs, cosine_pairs, hamming_distance, hamming_pairs,
                                           simhash64)
from brieflow.session import ensure_checkpoint_dir


def url_hash(col="url"):
    return F.sha2(canonical_url(col), 256)


def l1_url_dedup(df: DataFrame) -> DataFrame:
    """Adds ``url_hash`` and ``l1_keep`` (first article per URL hash by ``arr``, which is unique).

    A missing URL hashes like '' (all URL-less articles collapse into one). The kept rows are marked by a
    join on ``arr``, so a URL that very many rows share is only ever a key of the pre-aggregated minimum.
    """
    h = df.withColumn("url_hash", url_hash("url"))
    first = h.groupBy("url_hash").agg(F.min("arr").alias("arr")).select("arr", F.lit(True).alias("_first"))
    return h.join(first, "arr", "left").withColumn("l1_keep", F.coalesce("_first", F.lit(False))).drop("_first")


def _cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a narrow key table (shared checkpoint folder)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _stored_leader(near: DataFrame) -> DataFrame:
    """(arr, stored_id): of each row of (arr, batch, l_arr, l_id) the earliest stored leader."""
    first = F.min(F.struct("batch", "l_arr", "l_id"))
    return near.groupBy("arr").agg(first.alias("f")).select("arr", F.col("f.l_id").alias("stored_id"))


def _with_stored(own: DataFrame, elected: DataFrame, stored: DataFrame | None, leader: str) -> DataFrame:
    """All rows of ``own`` (arr, ...) with their leader: (``leader``, ``leader``_id of a stored one, keep)."""
    out = own.join(elected.withColumnRenamed("leader_arr", leader), "arr", "left")
    out = out.join(stored, "arr", "left") if stored is not None else out.withColumn("stored_id", F.lit(None).cast("string"))
    return out.withColumn("keep", F.coalesce(F.col(leader) == F.col("arr"), F.lit(False)))


def _stored_for(keys: DataFrame, part) -> DataFrame:
    """A part of the store: a table, or a function that gives the stored rows that ``keys`` can meet."""
    return part(keys) if callable(part) else part


def _micros(hours: int | None) -> int | None:
    return None if hours is None else int(hours) * 3600 * 1_000_000


def _within(a: str, b: str, window: int) -> Column:
    """Two times (microseconds) at most ``window`` apart."""
    return F.coalesce(F.abs(F.col(a) - F.col(b)) <= window, F.lit(False))


def first_fit_prints(fps: DataFrame, max_distance: int = P.SIMHASH_MAX_DISTANCE, blocks: int | None = None,
                     window_hours: int | None = None) -> DataFrame:
    """(arr, leader_arr) of rows (arr, simhash, t): first-fit by fingerprints within ``max_distance`` bits and, with a
    window, times ``t`` (microseconds; null is near nothing) within it."""
    window = _micros(window_hours)
    keys = ["simhash"] if window is None else ["simhash", "t"]
    timed = fps if window is None else fps.filter("t is not null")
    reps = _cut(timed.groupBy(*keys).agg(F.min("arr").alias("node")))
    m = blocks or choose_blocks(reps.select("simhash").distinct().count(), max_distance)
    gs = band_keys("simhash", m, max_distance)
    if window is not None:
        # times within a window of each other share a bucket or lie in following ones
        at = F.floor(F.col("t") / F.lit(window))
        gs = F.flatten(F.transform(gs, lambda x: F.array(*[F.struct(x["c"].alias("c"), x["v"].alias("v"), (at + i).alias("w")) for i in (0, 1)])))

    def near(a: str, b: str) -> Column:
        close = hamming_distance(f"{a}_simhash", f"{b}_simhash") <= max_distance
        return close if window is None else close & _within(f"{a}_t", f"{b}_t", window)

    elected = first_fit(reps.select("node", *keys), near, gs=gs)
    # a copy of a leader is a duplicate of that leader; a copy of a duplicate follows it
    led = timed.select("arr", *keys).join(reps.join(elected, "node").select(*keys, "leader"), keys).select("arr", F.col("leader").alias("leader_arr"))
    return led if window is None else led.unionByName(fps.filter("t is null").select("arr", F.col("arr").alias("leader_arr")))


def l2_near_dup(df: DataFrame, max_distance: int = P.SIMHASH_MAX_DISTANCE, blocks: int | None = None,
                leaders_store=None, window_hours: int | None = None, ts_col: str = "published_at") -> DataFrame:
    """(arr, simhash, l2_leader_arr, stored_id, keep) for the rows of ``df`` (L1 survivors), with
    ``window_hours`` also their time ``t``.

    ``leaders_store`` (batch, arr, id, simhash, and t with a window) holds leaders of earlier batches (A30). They come before every
    row of ``df`` whatever its ``arr``: a row near one of them is its duplicate (``stored_id`` is that leader's
    id, ``l2_leader_arr`` NULL), and the others elect among themselves.
    """
    window = _micros(window_hours)
    if window is None:
        fps = simhash64(df.select("arr", "title", "body", "summary"))
    else:
        fps = simhash64(df.select("arr", "title", "body", "summary", ts_col), carry=(F.unix_micros(F.col(ts_col)).alias("t"),))
    fps = _cut(fps)
    keys = ["simhash"] if window is None else ["simhash", "t"]
    stored, nodes = None, fps
    if leaders_store is not None:
        old = _stored_for(fps, leaders_store).select("batch", F.col("arr").alias("l_arr"), F.col("id").alias("l_id"), F.col("simhash").alias("l_fp"),
                                   *([] if window is None else [F.col("t").alias("l_t")]))
        # stored leaders meet the batch's fingerprints only, not each other
        near = hamming_pairs(fps, max_distance, "simhash", blocks, other=old.select(F.col("l_fp").alias("simhash"))).select("fp_a", "fp_b").toDF("simhash", "l_fp")
        # of each stored fingerprint (and time) its earliest leader, then of each of ours the earliest near one
        first = old.groupBy(*["l_fp", "l_t"][:len(keys)]).agg(F.min(F.struct("batch", "l_arr", "l_id")).alias("f"))
        mine = fps.select(*keys).distinct()
        met = near.join(first, "l_fp").join(mine, "simhash").drop("l_fp")
        if window is not None:
            met = met.filter(_within("t", "l_t", window))
        of_print = met.groupBy(*keys).agg(F.min("f").alias("f")).select(*keys, F.col("f.l_id").alias("stored_id"))
        stored = _cut(fps.join(of_print, keys).select("arr", "stored_id"))
        nodes = fps.join(stored, "arr", "left_anti")
    res = first_fit_prints(nodes, max_distance, blocks, window_hours)
    return _with_stored(fps, res, stored, "l2_leader_arr")


#: vectors among which leaders are elected first, and how many times as many follow in the next portion
PORTION, PORTION_GROWTH = 1 << 14, 8


def _leaders_by_portion(nodes: DataFrame, threshold: float, mode: str, window: int | None) -> DataFrame:
    """(vk, leader_arr): first-fit leaders among vectors (arr, embedding, and t with a window).

    Pairs grow with the square of the vectors, leaders do not. So the vectors come in portions by ``arr``: a portion first meets the leaders of those before
    it, which are before all of its vectors, and only what is near none of these is paired and elected by itself. An approximate join is not cut.
    """
    timed = [] if window is None else ["t"]
    n = nodes.count()
    share, cuts = PORTION, []
    while mode == "exact" and share < n:
        cuts.append(share / n)
        share *= PORTION_GROWTH
    ends = nodes.agg(F.percentile_approx("arr", F.array(*map(F.lit, cuts)), 10_000).alias("e")).first()["e"] if cuts else []
    ends = [e for e in sorted(set(ends or [])) if e is not None]
    leaders, found = None, []
    for after, upto in zip([None, *ends], [*ends, None]):
        portion = nodes
        if after is not None:
            portion = portion.filter(F.col("arr") > after)
        if upto is not None:
            portion = portion.filter(F.col("arr") <= upto)
        if leaders is not None:
            met = cosine_cross_pairs(portion, leaders, threshold, within=window)
            taken = _cut(met.groupBy("l").agg(F.min("r").alias("leader_arr")).withColumnRenamed("l", "vk"))
            found.append(taken)
            portion = _cut(portion.join(taken.select(F.col("vk").alias("arr")), "arr", "left_anti"))
        exact = mode == "exact"
        pairs = cosine_pairs(portion, threshold, key="arr", mode=mode, **({"within": window} if exact and window is not None else {}))
        if window is not None and not exact:
            a, b = (portion.select(F.col("arr").alias(c), F.col("t").alias(f"t_{c}")) for c in "ab")
            pairs = pairs.join(a, "a").join(b, "b").filter(_within("t_a", "t_b", window)).select("a", "b", "cos")
        elected = leader_election(portion.select("arr"), pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u < v").distinct(), "arr")
        elected = elected.select(F.col("arr").alias("vk"), F.col("leader").alias("leader_arr"))
        if upto is not None:
            elected = _cut(elected)
            new = portion.join(elected.filter("vk = leader_arr").select(F.col("vk").alias("arr")), "arr", "left_semi").select("arr", "embedding", *timed)
            leaders = _cut(new if leaders is None else leaders.unionByName(new))
        found.append(elected)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def l3_semantic_dup(df: DataFrame, vectors: DataFrame, threshold: float = P.SEMANTIC_COSINE_THRESHOLD,
                    mode: str = "exact", leaders_store: DataFrame | None = None,
                    embedder=None, window_hours: int | None = None) -> DataFrame:
    """(arr, l3_leader_arr, stored_id, keep) for rows of ``df`` (L2 leaders) that have a vector. With ``window_hours``
    ``df`` has their times ``t`` (microseconds), which the result keeps, and only articles within the window are near.

    ``vectors``: (arr, embedding) unit-norm. ``embedder``: optional pandas_udf
    mapping ``title + '. ' + (body or summary)[:300]`` to a vector (used when
    ``vectors`` is None). ``leaders_store``: (batch, arr, id, embedding), as in :func:`l2_near_dup`.
    """
    if vectors is None:
        if embedder is None:
            return _with_stored(df.select("arr"), df.select("arr", F.col("arr").alias("leader_arr")), None, "l3_leader_arr")
        from brieflow.functions.text import article_text
        vectors = df.select("arr", embedder(article_text(body_chars=300, sep=". ")).alias("embedding"))
    window = _micros(window_hours)
    timed = [] if window is None else ["t"]
    v = df.select("arr", *timed).join(vectors.select("arr", "embedding"), "arr").filter(F.col("embedding").isNotNull())
    stored, nodes = None, v
    if leaders_store is not None:
        # stored keys may equal ours, so stored leaders are joined by a key of their own
        old = _cut(_stored_for(v, leaders_store).withColumn("s", F.xxhash64("batch", "arr", "id")))
        met = cosine_cross_pairs(v, old.select(F.col("s").alias("arr"), "embedding"), threshold)
        near = met.select(F.col("l").alias("arr"), F.col("r").alias("s")).join(
            old.select("s", "batch", F.col("arr").alias("l_arr"), F.col("id").alias("l_id"), *(F.col(c).alias("l_t") for c in timed)), "s")
        if window is not None:
            near = near.join(v.select("arr", "t"), "arr").filter(_within("t", "l_t", window))
        stored = _cut(_stored_leader(near))
        nodes = v.join(stored, "arr", "left_anti")
    # equal vectors (and, with a window, times) are one class under their earliest holder, if they are near each other at all
    nodes = nodes.withColumn("_near", F.coalesce(_dot("embedding", "embedding") >= threshold, F.lit(False)))
    if window is not None:
        nodes = nodes.withColumn("_near", F.col("_near") & F.col("t").isNotNull())
    named = nodes.filter("_near").groupBy("embedding", *timed).agg(F.min("arr").alias("vk"))
    classes = nodes.filter("_near").join(named, ["embedding", *timed]).select("arr", "vk", "embedding", *timed)
    classes = _cut(classes.unionByName(nodes.filter("not _near").select("arr", F.col("arr").alias("vk"), "embedding", *timed)))
    nodes = classes.filter("arr = vk").drop("vk")
    led = _leaders_by_portion(nodes, threshold, mode, window)
    res = classes.select("arr", "vk").join(led, "vk").select("arr", "leader_arr")
    return _with_stored(v.select("arr", *timed), res, stored, "l3_leader_arr")


def dedup_cascade(df: DataFrame, vectors: DataFrame | None = None, rules: P.Rules = P.DEFAULT_RULES,
                  cosine_mode: str = "exact", transitive: bool | None = None, return_tables: bool = False,
                  store: dict | None = None, embedder=None):
    """L1 -> L2 -> L3 -> counts. Returns the surviving rows of ``df`` with
    ``story_id`` and ``corroboration_count``.

    Only narrow key tables (arr, id, hashes, leaders) are materialised between
    stages; article text is read again by a semi join on ``arr`` where a stage
    needs it, so nothing wide is written and plans stay short. ``store`` holds what
    earlier batches left (see :func:`incremental_dedup`); each part of it counts by itself.
    With ``rules.window_stories`` near articles are one story only if they were published within ``rules.story_window_hours``.
    """
    transitive = rules.transitive_counts if transitive is None else transitive
    store = store or {}
    l1 = l1_url_dedup(_cut(df.select("arr", "id", "url")))  # both sides of its join read it, and ``df`` may come from whole texts
    if store.get("url_hashes") is not None:
        # URLs seen in earlier batches are L1 duplicates (their story id is the URL hash)
        seen = _stored_for(l1, store["url_hashes"]).select("url_hash").distinct().withColumn("_seen", F.lit(True))
        l1 = (l1.join(seen, "url_hash", "left")
                .withColumn("l1_keep", F.col("l1_keep") & F.col("_seen").isNull()).drop("_seen"))
    l1 = _cut(l1)
    s1 = df.join(l1.filter("l1_keep").select("arr"), "arr", "left_semi")
    alone = F.lit(None).cast("string").alias("stored_id"), F.lit(True).alias("keep")
    window = rules.story_window_hours if rules.window_stories else None
    timed = [] if window is None else ["t"]
    if rules.use_l2:
        l2 = _cut(l2_near_dup(s1, rules.simhash_max_distance, leaders_store=store.get("l2_leaders"), window_hours=window))
    else:
        l2 = s1.select("arr", F.col("arr").alias("l2_leader_arr"), *alone, *(F.unix_micros("published_at").alias(c) for c in timed))
    l2_leaders = l2.filter("keep").select("arr", *timed)
    semantic = rules.use_l3 and (vectors is not None or embedder is not None)
    if semantic:
        texts = l2_leaders if vectors is not None else df.join(l2_leaders, "arr")
        l3 = _cut(l3_semantic_dup(texts, vectors, rules.cosine_threshold, cosine_mode,
                                  leaders_store=store.get("l3_leaders"), embedder=embedder, window_hours=window))
    else:
        l3 = l2_leaders.select("arr", F.col("arr").alias("l3_leader_arr"), *alone)
    smap = story_map(l1, l2, l3, transitive)
    counts = smap.groupBy("story_id").agg(F.count(F.lit(1)).alias("corroboration_count"))
    l3_leaders = l3.filter("keep").select("arr", *(c for c in timed if c in l3.columns))
    # L2 leaders without a vector never enter L3 and stay leaders
    no_vec = l2_leaders.select("arr").join(l3.select("arr"), "arr", "left_anti")
    surv_keys = (l1.join(l3_leaders.select("arr").union(no_vec), "arr", "left_semi").select("arr", "id")
                   .join(smap, "id", "left")
                   .withColumn("story_id", F.coalesce("story_id", "id"))
                   .join(counts, "story_id", "left")
                   .select("arr", "story_id",
                           F.coalesce(F.col("corroboration_count"), F.lit(1)).cast("bigint")
                           .alias("corroboration_count")))
    surv_keys = _cut(surv_keys)
    out = df.join(surv_keys, "arr")
    if return_tables:
        tables = {"l1": l1, "l2": l2, "l3": l3, "story_map": smap, "counts": counts, "survivor_keys": surv_keys}
        by_function = any(callable(p) for p in store.values())
        tables["store"] = None if by_function else _next_store(store, l1, l2 if rules.use_l2 else None,
                                      l3_leaders if semantic and vectors is not None else None, vectors)
        return out, tables
    return out


def batch_state(batch: int, l1: DataFrame, l2: DataFrame | None, l3_leaders: DataFrame | None,
                vectors: DataFrame | None) -> dict:
    """What one batch adds to the store: its URL hashes, SimHash leaders and vector leaders."""
    number, ids = F.lit(batch).cast("long").alias("batch"), l1.select("arr", "id")
    state = {"url_hashes": l1.select("url_hash").distinct(), "l2_leaders": None, "l3_leaders": None}
    if l2 is not None:
        state["l2_leaders"] = l2.filter("keep").join(ids, "arr").select(number, "arr", "id", "simhash", *(c for c in ("t",) if c in l2.columns))
    if l3_leaders is not None:
        of = l3_leaders.join(vectors.select("arr", "embedding"), "arr").join(ids, "arr")
        state["l3_leaders"] = of.select(number, "arr", "id", "embedding", *(c for c in ("t",) if c in l3_leaders.columns))
    return state


def _next_store(store: dict, l1, l2, l3_leaders, vectors) -> dict:
    """The store after a batch; a part that the batch did not touch stays as it was."""
    number = store.get("batch", -1) + 1
    out = {"batch": number}
    for part, new in batch_state(number, l1, l2, l3_leaders, vectors).items():
        old = store.get(part)
        both = new if old is None else old if new is None else new.unionByName(old)
        out[part] = None if both is None else _cut(both.distinct() if part == "url_hashes" else both)
    return out


def incremental_dedup(batch: DataFrame, store: dict | None, vectors: DataFrame | None = None,
                      rules: P.Rules = P.DEFAULT_RULES, cosine_mode: str = "exact", return_tables: bool = False):
    """Dedup ``batch`` against the leaders of earlier batches.

    ``store`` (None for the first batch) holds ``batch`` (the last batch's number), ``url_hashes``,
    ``l2_leaders`` (batch, arr, id, simhash) and ``l3_leaders`` (batch, arr, id, embedding); a part is None
    while no batch has run its stage. Stored leaders come before every row of the batch, whatever their
    ``arr``. A part may also be a function from the batch's keys to the stored rows that these can meet; such a store
    (:class:`brieflow.operators.leader_store.LeaderStore`) writes its next state itself. The story map is per batch: a late duplicate of a stored leader is dropped and has that leader's id
    as its story. Returns (survivors, new_store) or, with ``return_tables``, (survivors, tables).
    """
    out, t = dedup_cascade(batch, vectors, rules, cosine_mode, return_tables=True, store=store)
    return (out, t) if return_tables else (out, t["store"])


def story_map(l1: DataFrame, l2: DataFrame, l3: DataFrame, transitive: bool = False) -> DataFrame:
    """One row per distinct ``id`` -> ``story_id`` (later stage wins).

    L1: survivor -> own id, duplicate -> URL hash (the last write per id wins);
    L2/L3 duplicate -> leader's id, also of a leader stored by an earlier batch. ``transitive`` also moves L2
    members of an article absorbed at L3 to the L3 leader.
    """
    ids = l1.select("arr", "id")
    l1v = (l1.select("id", "arr", F.when(F.col("l1_keep"), F.col("id")).otherwise(F.col("url_hash")).alias("s1"))
             .groupBy("id").agg(F.max_by("s1", "arr").alias("s1")))

    def led(level: DataFrame, leader: str, name: str) -> DataFrame:
        own = ids.select(F.col("arr").alias(leader), F.col("id").alias("_own"))
        return (level.filter("not keep").join(own, leader, "left")
                .select("arr", leader, F.coalesce("stored_id", "_own").alias(name)))

    l2d, l3d = led(l2, "l2_leader_arr", "l2_leader_id"), led(l3, "l3_leader_arr", "l3_leader_id").select("arr", "l3_leader_id")
    per_article = ids.join(l2d, "arr", "left").join(l3d, "arr", "left")
    if transitive:
        moved = l3d.select(F.col("arr").alias("l2_leader_arr"), F.col("l3_leader_id").alias("l3_of_leader"))
        per_article = per_article.join(moved, "l2_leader_arr", "left")
        later = F.coalesce("l3_leader_id", "l3_of_leader", "l2_leader_id")
    else:
        later = F.coalesce("l3_leader_id", "l2_leader_id")
    # several rows may share an id (L1 copies): the survivor's later-stage write wins
    per_id = per_article.groupBy("id").agg(F.max(later).alias("later"))
    return l1v.join(per_id, "id", "left").select("id", F.coalesce("later", "s1").alias("story_id"))


def attach_story(df: DataFrame, smap: DataFrame) -> DataFrame:
    """Left join id -> story_id, missing -> own id."""
    return df.join(smap, "id", "left").withColumn("story_id", F.coalesce("story_id", "id"))


def corroboration_count(smap: DataFrame) -> DataFrame:
    """(story_id, corroboration_count)."""
    return smap.groupBy("story_id").agg(F.count(F.lit(1)).alias("corroboration_count"))


__all__ = ["url_hash", "l1_url_dedup", "l2_near_dup", "l3_semantic_dup", "dedup_cascade", "story_map",
           "attach_story", "corroboration_count"]
