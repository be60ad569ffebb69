"""Jaccard pairs by the first shingles of each set."""
import random

import pytest
from pyspark.sql import functions as F

from brieflow.operators import similarity as S
from brieflow.operators.similarity import minhash_near_dup


def _texts(rng):
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 3, 4, 9, 60, 200]))] for _ in range(40)]
    line = [rng.choice(words) for _ in range(12)]  # in half of the texts
    texts = []
    for i, t in enumerate(base):
        t = t + line if i % 2 and len(t) > 20 else t
        texts.append(t)
        for _ in range(3):
            near = list(t)
            for _ in range(rng.randrange(0, 1 + len(t) // 25)):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(near)
    return [" ".join(t) for t in texts] + ["", None, " - "]


def _grams(t):
    w = (t or "").replace("-", " ").split()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))) if w else frozenset()


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_jaccard_pairs_by_first_shingles(spark, threshold):
    rows = list(enumerate(_texts(random.Random(5))))
    sets = {k: _grams(t) for k, t in rows}
    names = {}
    for k, s in sets.items():
        if s:
            names.setdefault(s, k)
    want = {(names[s], k): 1.0 for k, s in sets.items() if s and names[s] != k}
    of = sorted((k, s) for s, k in names.items())
    for i, (a, sa) in enumerate(of):
        for b, sb in of[i + 1:]:
            j = len(sa & sb) / len(sa | sb)
            if j >= threshold - 1e-12:
                want[a, b] = j
    df = spark.createDataFrame(rows, "arr long, body string")
    got = [(r.a, r.b, round(r.jaccard, 9)) for r in minhash_near_dup(df, text=F.col("body"), threshold=threshold).collect()]
    assert sorted(got) == sorted((a, b, round(j, 9)) for (a, b), j in want.items())


def test_only_first_shingles_travel(spark):
    rng = random.Random(6)
    rows = [(i, [rng.getrandbits(63) for _ in range(200)]) for i in range(50)] + [(50, [])]
    words = spark.createDataFrame(rows, "k long, w array<bigint>")
    sets = S._shingle_sets(words, 4).checkpoint(eager=True)
    assert [r.n for r in sets.orderBy("k").collect()] == [197] * 50 + [0]
    heads = S._shingle_prefixes(sets, 0.8).collect()
    assert all(len(r.p) <= 0.26 * r.n for r in heads) and {len(set(r.p)) for r in heads} == {0, 49}
