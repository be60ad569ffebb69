"""The election without an edge list equals sequential first-fit, with and without a story window."""

import random

import pytest
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import election
from brieflow.operators.dedup import first_fit_prints, incremental_dedup, l2_near_dup
from first_fit import first_fit_reference

HOUR = 3_600_000_000


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clusters(rng, n):
    """Fingerprints in overlapping clusters with copies, times over several days, some missing."""
    centres = [rng.getrandbits(64) for _ in range(max(n // 25, 2))]
    rows = []
    for k in range(n):
        fp = rng.choice(centres)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
            fp ^= 1 << rng.randrange(64)
        rows.append((k * 7 % 1009 + 1009 * (k // 1009), signed(fp), None if rng.random() < 0.03 else rng.randrange(0, 96) * HOUR))
    return rows


def near_prints(rows, window=None):
    of = {a: (fp, t) for a, fp, t in rows}

    def near(a, b):
        (x, s), (y, t) = of[a], of[b]
        return bin((x ^ y) & (2**64 - 1)).count("1") <= 4 and (window is None or (s is not None and t is not None and abs(s - t) <= window))

    return near


@pytest.mark.parametrize("head", [2, election.HEAD])
@pytest.mark.parametrize("window", [None, 24])
def test_equals_sequential_rule(spark, monkeypatch, head, window):
    monkeypatch.setattr(election.first_fit, "__defaults__", (head,))
    rows = clusters(random.Random(head), 200)
    got = {r["arr"]: r["leader_arr"] for r in first_fit_prints(spark.createDataFrame(rows, "arr long, simhash long, t long"), window_hours=window).collect()}
    assert got == first_fit_reference([a for a, _, _ in rows], near_prints(rows, None if window is None else window * HOUR))


def test_copies_spread_over_days_follow_the_first_leader_in_the_window(spark):
    """Copies at hours 20, 30 and 40: the third is not near the first, and the second, which leads nobody, does not take it."""
    rows = [(0, 5, 20 * HOUR), (1, 5, 30 * HOUR), (2, 5, 45 * HOUR)]
    got = {r["arr"]: r["leader_arr"] for r in first_fit_prints(spark.createDataFrame(rows, "arr long, simhash long, t long"), window_hours=24).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_dense_cluster_makes_linear_rows(spark, monkeypatch):
    """Fingerprints around one: edges between the first of each group only, and a row for each node that a leader takes."""
    rng = random.Random(9)
    prints = {0}
    while len(prints) < 20_000:
        prints.add(sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    rows = [(k, signed(fp), None) for k, fp in enumerate(sorted(prints, key=lambda x: (bin(x).count("1"), x)))]
    compared = []
    rounds = election._rounds
    monkeypatch.setattr(election, "_rounds", lambda u, e, cut: (compared.append(e.count()), rounds(u, e, cut))[1])
    got = first_fit_prints(spark.createDataFrame(rows, "arr long, simhash long, t long"))
    assert got.count() == 20_000 and got.filter("leader_arr <> 0").count() == 0
    assert sum(compared) < 20_000  # all pairs within four bits would be many millions


def articles(spark, rows):
    return spark.createDataFrame([(a, f"id{a}", f"http://x/{a}", "t", text, "", h * 3600) for a, text, h in rows],
                                 "arr long, id string, url string, title string, body string, summary string, s long").withColumn("published_at", F.timestamp_seconds("s"))


def test_window_holds_between_batches(spark):
    """A copy of a stored leader is its duplicate only within the window."""
    long = "a text about a thing that happened " * 4
    rules = P.Rules(window_stories=True, use_l3=False)
    _, store = incremental_dedup(articles(spark, [(1, long, 0), (2, "quite another text " * 9, 0)]), None, None, rules)
    out, _ = incremental_dedup(articles(spark, [(3, long, 20), (4, long, 40), (5, long, 50)]), store, None, rules, return_tables=True)
    assert {r["arr"]: r["story_id"] for r in out.collect()} == {4: "id4"}
    _, store = incremental_dedup(articles(spark, [(1, long, 0)]), None, None, P.Rules(use_l3=False))
    out, _ = incremental_dedup(articles(spark, [(4, long, 40)]), store, None, P.Rules(use_l3=False))
    assert out.count() == 0


def test_articles_without_a_time_lead_themselves(spark):
    a = articles(spark, [(1, "one text " * 9, 0), (2, "one text " * 9, 1)]).withColumn("published_at", F.when(F.col("arr") == 1, F.col("published_at")))
    assert {r["arr"]: r["l2_leader_arr"] for r in l2_near_dup(a, window_hours=24).collect()} == {1: 1, 2: 2}
