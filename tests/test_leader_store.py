"""The leader store on files: the same as one pass, replay, expiry, compaction, pruned reads."""

import random

from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators.dedup import dedup_cascade
from brieflow.operators.leader_store import LeaderStore
from brieflow.session import scratch_path

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def articles(spark, rows):
    return spark.createDataFrame([(a, f"id{a}", url, "", text, "", h * 3600) for a, url, text, h in rows],
                                 "arr long, id string, url string, title string, body string, summary string, s long").withColumn("published_at", F.timestamp_seconds("s"))


def batches(rng, n, size, apart):
    """Texts of which some come again in later batches, with a changed word or as they were; URLs repeat as well."""
    known, out = [], []
    for b in range(n):
        rows = []
        for i in range(size):
            text = " ".join(rng.choices(WORDS, k=90))
            if known and rng.random() < 0.5:
                text = rng.choice(known)
                if rng.random() < 0.5:
                    w = text.split()
                    w[rng.randrange(90)] = rng.choice(WORDS)
                    text = " ".join(w)
            known.append(text)
            k = b * 1000 + i
            rows.append((k, f"http://x/{rng.randrange(k // 3 + 5)}", text, b * apart))
        out.append(rows)
    return out


def vectors(spark, rng, all_rows):
    rows = []
    for a, _, _, _ in all_rows:
        v = [rng.gauss(0, 1) for _ in range(4)]
        n = sum(x * x for x in v) ** 0.5
        rows.append((a, [x / n for x in v]))
    return spark.createDataFrame(rows, "arr long, embedding array<float>")


def test_batches_equal_one_pass_and_replay_gives_the_same(spark):
    rng = random.Random(1)
    parts = batches(rng, 2, 40, 10)
    rows = [r for p in parts for r in p]
    vec, rules = vectors(spark, rng, rows), P.Rules(cosine_threshold=0.95)
    whole = {r["arr"] for r in dedup_cascade(articles(spark, rows), vec, rules).collect()}
    store = LeaderStore(spark, scratch_path(spark, "store"), buckets=4, compact_every=1, pivots=4, rules=rules)
    kept = [{(r["arr"], r["story_id"]) for r in store.run(n, articles(spark, p), vec)[0].collect()} for n, p in enumerate(parts)]
    assert {a for part in kept for a, _ in part} == whole and len(whole) < len(rows)
    again = {(r["arr"], r["story_id"]) for r in store.run(1, articles(spark, parts[1]), vec)[0].collect()}
    assert again == kept[1]


def test_cost_stays_flat_with_expiry_and_compaction(spark):
    rng = random.Random(2)
    rules = P.Rules(use_l3=False)
    store = LeaderStore(spark, scratch_path(spark, "store"), buckets=2, compact_every=2, keep_hours=24, rules=rules)
    held = []
    for n, p in enumerate(batches(rng, 6, 12, 24)):
        store.run(n, articles(spark, p))
        live = store.live(n + 1)
        assert len({g for _, g in live}) <= 2
        held.append(store._part("urls", live, None).count())  # rows on file, the expired ones that no compaction has met yet included
    assert max(held[2:]) <= 3 * 12  # three days of twelve articles at most
    assert len(store.vacuum(1)) > 0
    late = articles(spark, [(99_000, "http://x/late", "x " * 80, 6 * 24)])
    assert store.run(6, late)[0].count() == 1


def test_an_expired_leader_no_longer_counts(spark):
    text = " ".join(random.Random(3).choices(WORDS, k=90))
    for hours, kept in ((40, 0), (60, 1)):
        store = LeaderStore(spark, scratch_path(spark, "store"), buckets=4, keep_hours=48, rules=P.Rules(use_l3=False))
        store.run(0, articles(spark, [(1, "http://x/1", text, 0)]))
        assert store.run(1, articles(spark, [(2, "http://x/2", text, hours)]))[0].count() == kept


def test_a_batch_reads_only_its_buckets(spark):
    rng = random.Random(4)
    store = LeaderStore(spark, scratch_path(spark, "store"), buckets=32, rules=P.Rules(use_l3=False))
    store.run(0, articles(spark, batches(rng, 1, 40, 0)[0]))
    keys = {"l2_leaders": spark.createDataFrame([(5,)], "simhash long"), "url_hashes": spark.createDataFrame([("x",)], "url_hash string")}
    for part, rows in keys.items():
        plan = store.before(1)[part](rows)._jdf.queryExecution().executedPlan().toString()
        assert "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
