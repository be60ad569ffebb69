"""Equal vectors are one class (A25), the cosine join (A18) finds every pair with any number of cells, and selection
scores a text's lexicon once (A46)."""

import random

import numpy as np

from brieflow.operators import enrich, score, select, similarity
from brieflow.operators.dedup import l3_semantic_dup
from brieflow.operators.similarity import cosine_pairs
from brieflow.sources.testbed import articles
from first_fit import first_fit_reference

SF_SMALL = "/root/testdata/sf0.001"
HOUR = 3_600_000_000


def unit(rng, n, dim=8):
    v = np.array([[rng.gauss(0, 1) for _ in range(dim)] for _ in range(n)])
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def test_equal_vectors_make_linear_links(spark, monkeypatch):
    rng = random.Random(1)
    v = unit(rng, 3)
    rows = [(k, [float(x) for x in v[0 if k % 50 else rng.randrange(3)]]) for k in range(20_000)]
    met = []
    real = similarity.cosine_pairs
    monkeypatch.setattr("brieflow.operators.dedup.cosine_pairs", lambda d, *a, **kw: (met.append(d.count()), real(d, *a, **kw))[1])
    t = spark.createDataFrame(rows, "arr long, embedding array<float>")
    got = l3_semantic_dup(t.select("arr"), t, 0.999)
    assert met == [3] and got.count() == 20_000 and got.filter("keep").count() == 3


def test_leaders_with_copies_times_and_vectors_that_are_not_near_themselves(spark):
    rng = random.Random(2)
    v = unit(rng, 12, 3)
    v[3] *= 0.1  # shorter than a unit: not near itself
    rows = [(k, [float(x) for x in v[rng.randrange(12)]], None if k % 19 == 0 else rng.randrange(72) * HOUR) for k in range(150)]
    t = spark.createDataFrame(rows, "arr long, embedding array<float>, t long")
    of = {a: (np.array(e, np.float64), s) for a, e, s in rows}
    for window in (None, 24):
        def near(a, b):
            (x, s), (y, u) = of[a], of[b]
            return x @ y >= 0.8 and (window is None or (s is not None and u is not None and abs(s - u) <= window * HOUR))

        got = {r["arr"]: r["l3_leader_arr"] for r in l3_semantic_dup(t.select("arr", "t"), t, 0.8, window_hours=window).collect()}
        assert got == first_fit_reference(list(of), near)


def test_portions_elect_the_same_leaders_and_pair_less(spark, monkeypatch):
    rng = random.Random(5)
    v = unit(rng, 240, 3)
    rows = [(k, [float(x) for x in e], None if k % 19 == 0 else rng.randrange(72) * HOUR) for k, e in enumerate(v)]
    t = spark.createDataFrame(rows, "arr long, embedding array<float>, t long")
    of = {a: (np.array(e, np.float64), s) for a, e, s in rows}
    met, real = [], similarity.cosine_pairs
    monkeypatch.setattr("brieflow.operators.dedup.cosine_pairs", lambda d, *a, **kw: (met.append(d.count()), real(d, *a, **kw))[1])
    monkeypatch.setattr("brieflow.operators.dedup.PORTION", 60, raising=False)
    monkeypatch.setattr("brieflow.operators.dedup.PORTION_GROWTH", 3, raising=False)
    for window in (None, 24):
        def near(a, b):
            (x, s), (y, u) = of[a], of[b]
            return x @ y >= 0.8 and (window is None or (s is not None and u is not None and abs(s - u) <= window * HOUR))

        met.clear()
        got = {r["arr"]: r["l3_leader_arr"] for r in l3_semantic_dup(t.select("arr", "t"), t, 0.8, window_hours=window).collect()}
        assert got == first_fit_reference(list(of), near)
        if window is None:
            assert sum(n * n for n in met) < 240 * 240 / 2


def test_pairs_are_the_same_for_any_number_of_pivots(spark, monkeypatch):
    rng = random.Random(3)
    v = unit(rng, 300, 4)
    t = spark.createDataFrame([(k, [float(x) for x in e]) for k, e in enumerate(v)], "arr long, embedding array<float>")
    dots = v.astype(np.float64) @ v.astype(np.float64).T
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if dots[i, j] >= 0.9}
    for size, block in ((1 << 28, 2048), (1 << 28, 8), (64, 8)):  # the last has two pivots
        monkeypatch.setattr(similarity, "PIVOT_BYTES", size)
        got = cosine_pairs(t, 0.9, block_rows=block)
        assert {(r["a"], r["b"]) for r in got.collect()} == want


def test_the_lexicon_is_matched_once(spark):
    """A score filter must not bring further copies of the lexicon match into the plan."""
    scored = score.score(enrich.enrich(articles(spark, SF_SMALL)))
    plan = select.candidates(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert "contains" not in plan.lower()  # scores are read as stored
    whole = scored.drop(*select.WIDE_COLUMNS)._jdf.queryExecution().optimizedPlan().toString()
    assert whole.lower().count("contains(lambda") <= 2
