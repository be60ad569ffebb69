"""What stored leaders and the rounds of an election move: only what their result needs."""
import random

from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import dedup, election
from brieflow.operators.similarity import cosine_cross_pairs, cosine_pairs, hamming_distance, hamming_pairs, simhash64
from brieflow.streaming.streams import moved_stories


def test_stored_prints_do_not_meet_each_other(spark):
    rng = random.Random(7)
    old = [rng.getrandbits(62) for _ in range(60)]
    old += [x ^ 1 for x in old[:30]]  # near each other
    new = [old[0], old[5] ^ 6, rng.getrandbits(62)]
    a, b = (spark.createDataFrame([(x,) for x in v + v[:1]], "simhash long") for v in (new, old))
    got = sorted(tuple(r) for r in hamming_pairs(a, 3, other=b).collect())
    assert got == sorted((x, y, bin(x ^ y).count("1")) for x in new for y in old if bin(x ^ y).count("1") <= 3)


def test_rounds_keep_edges_only(spark):
    # a path is decided in one round for every two nodes
    nodes = spark.range(12).select(F.col("id").alias("n"))
    edges = spark.range(11).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    cuts = []
    leaders, duplicates = election._rounds(nodes, edges, lambda d: (cuts.append(d), d.checkpoint(eager=True))[1])
    assert sorted(r.n for d in leaders for r in d.collect()) == [0, 2, 4, 6, 8, 10]
    assert sorted(r.n for d in duplicates for r in d.collect()) == [1, 3, 5, 7, 9, 11]
    assert len(cuts) <= 2 * 6 + 2
    # the first node waits for one outside, so what follows it waits as well, unless a leader takes it
    waits = spark.createDataFrame([(100, 0), (0, 1), (2, 3), (3, 4)], "u long, v long")
    leaders, duplicates = election._rounds(spark.range(5).select(F.col("id").alias("n")), waits, lambda d: d.checkpoint(eager=True))
    assert sorted(r.n for d in leaders for r in d.collect()) == [2, 4] and sorted(r.n for d in duplicates for r in d.collect()) == [3]


def test_members_that_meet_nobody_are_not_stored(spark, monkeypatch):
    nodes = spark.range(300).select(F.col("id").alias("node"), (F.col("id") * 2 + 1).alias("x"))
    stored, frame = [], type(nodes)
    real = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda d, *a, **kw: (stored.append(d.count() if "g" in d.columns else 0), real(d, *a, **kw))[1])
    near = lambda a, b: hamming_distance(f"{a}_x", f"{b}_x") == 0
    got = election.first_fit(nodes.withColumn("gs", F.array("x", F.col("x") + 1_000_000)), near)
    assert got.filter("node = leader").count() == 300 and sum(stored) == 0


def test_the_cascade_reads_urls_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(k):
        seen.add(1)
        return f"http://x/{k % 40}"

    a = spark.range(50).select(F.col("id").alias("arr"), F.col("id").cast("string").alias("id"), F.udf(counted)("id").alias("url"))
    dedup.dedup_cascade(a, rules=P.Rules(use_l2=False, use_l3=False))
    assert seen.value == 50


def test_batch_hashes_equal_the_native_ones(spark):
    texts = [None, "", "a", "abc", "abcd", "no", "\u4e2d\u6587\u5b57 a", "\U00020000 x", "A b C !!", "\u00c9 \u00df \ufb00", "ab" * 40_000,
             "".join(chr(c) for c in range(0x4e00, 0x9000))] + [f"text {k} of a batch" for k in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "arr long, t string")
    a, b = ({r["arr"]: r["simhash"] for r in simhash64(df, text=F.coalesce("t", F.lit("")), method=m).collect()} for m in ("arrow", "native"))
    assert a == b and len(a) == len(texts)


def test_a_stream_joins_moved_stories_only(spark):
    smap = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", None), ("d", "x")], "id string, story_id string")
    kept = moved_stories(smap)
    assert sorted(map(tuple, kept.collect())) == [("b", "a"), ("d", "x")]
    assert "Scan ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()
    ids = spark.createDataFrame([(x,) for x in "abcde"], "id string")
    assert sorted(map(tuple, dedup.attach_story(ids, kept).collect())) == sorted(map(tuple, dedup.attach_story(ids, smap).collect()))


def test_cosine_pairs_within_a_time_leave_their_block_only_then(spark):
    times = [0, 5, 11, None, 10]
    v = spark.createDataFrame([(k, [1.0, 0.0], t) for k, t in enumerate(times)], "arr long, embedding array<float>, t long")
    want = {(a, b) for a in range(5) for b in range(5) if None not in (times[a], times[b]) and abs(times[a] - times[b]) <= 6}
    assert {(r.a, r.b) for r in cosine_pairs(v, 0.5, within=6).collect()} == {(a, b) for a, b in want if a < b}
    assert {(r.l, r.r) for r in cosine_cross_pairs(v, v, 0.5, within=6).collect()} == want
    assert cosine_pairs(v, 0.5).count() == 10
