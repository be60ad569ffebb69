"""The pruned nearest join equals brute force."""

import numpy as np
import pytest

from brieflow.operators.declared import cross_domain_search, domain_topk_search, novelty
from brieflow.operators.nearest import nearest_join


def vectors(rng, n, centres, spread, dim=16):
    base = rng.normal(size=(centres, dim))
    v = base[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, dim))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    v[1::17] = v[0]  # equal vectors: ties go by key
    return v


def table(spark, v, part, start=0):
    rows = [(start + i, None if i % 97 == 5 else [float(x) for x in v[i]], part(i)) for i in range(len(v))]
    return spark.createDataFrame(rows, "arr long, embedding array<float>, domain string")


def brute(queries, corpus, k, allowed):
    out = set()
    for q in queries:
        if q["embedding"] is None:
            continue
        near = {}
        for c in corpus:
            if c["embedding"] is not None and c["domain"] is not None and allowed(q, c):
                dot = float(np.dot(np.array(q["embedding"], np.float64), np.array(c["embedding"], np.float64)))
                near.setdefault(c["domain"], []).append((-dot, c["arr"]))
        out |= {(q["arr"], p, r + 1, a) for p, v in near.items() for r, (_, a) in enumerate(sorted(v)[:k])}
    return out


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_every_domain_gives_its_nearest(spark, block_rows):
    rng = np.random.default_rng(1)
    t = table(spark, vectors(rng, 240, 9, 0.2), lambda i: None if i % 31 == 0 else f"d{i % 3 if i % 40 else 9}")  # d9 has few rows
    got = {(r["query"], r["domain"], r["rank"], r["match"]) for r in cross_domain_search(t, t, 3, block_rows=block_rows).collect()}
    rows = t.collect()
    assert got == brute(rows, rows, 3, lambda q, c: q["arr"] != c["arr"])


def test_own_domain_and_earlier_rows(spark):
    rng = np.random.default_rng(2)
    t = table(spark, vectors(rng, 150, 5, 0.3), lambda i: f"d{i % 4}")
    rows = t.collect()
    got = {(r["query"], r["rank"], r["match"]) for r in domain_topk_search(t, t, 4, block_rows=16).collect()}
    assert got == {(q, r, m) for q, _, r, m in brute(rows, rows, 4, lambda q, c: q["domain"] == c["domain"] and q["arr"] != c["arr"])}
    best = {r["arr"]: r["max_cos"] for r in novelty(t, t, part_col="domain", earlier_only=True).collect()}
    of = {r["arr"]: np.array(r["embedding"], np.float64) for r in rows if r["embedding"] is not None}
    want = {q: m for q, _, _, m in brute(rows, rows, 1, lambda q, c: q["domain"] == c["domain"] and c["arr"] < q["arr"])}
    assert set(best) == set(of) and all((best[a] is None) == (a not in want) for a in of)
    assert all(abs(best[a] - of[a] @ of[m]) < 1e-9 for a, m in want.items())


def test_bounds_rule_cells_out(spark):
    rng = np.random.default_rng(3)
    t = table(spark, vectors(rng, 2000, 40, 0.05), lambda i: f"d{i % 2}")
    probes = {}
    out = cross_domain_search(t.filter("arr < 200"), t, 5, probes=probes)
    assert out.count() == 2 * 5 * t.filter("arr < 200 and embedding is not null").count()
    assert probes["first"] + probes["second"] < 0.25 * probes["all"]


def test_a_query_is_sent_once_to_a_block(spark):
    """Vectors without clusters: bounds rule out hardly any cell, and yet a query does not travel to each cell."""
    rng = np.random.default_rng(6)
    v = rng.normal(size=(400, 24))
    t = table(spark, (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32), lambda i: f"d{i % 3}")
    probes = {}
    got = {(r["query"], r["domain"], r["rank"], r["match"]) for r in cross_domain_search(t, t, 2, probes=probes).collect()}
    rows = t.collect()
    assert got == brute(rows, rows, 2, lambda q, c: q["arr"] != c["arr"])
    queries = sum(r["embedding"] is not None for r in rows)
    assert probes["second"] > 20 * queries and probes["sent"] == queries


def test_empty_sides(spark):
    t = table(spark, vectors(np.random.default_rng(4), 10, 2, 0.1), lambda i: "d")
    q, c = t.selectExpr("arr qk", "embedding qv", "domain p"), t.selectExpr("arr ck", "embedding cv", "domain p")
    assert nearest_join(q, c.limit(0), 3).count() == 0 and nearest_join(q.limit(0), c, 3).count() == 0
    assert {r["novelty"] for r in novelty(t, t.limit(0)).collect()} == {0.7}
