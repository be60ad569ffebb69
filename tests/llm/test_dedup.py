"""Exact and near-duplicate groups against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from brieflow.llm import exact_dedup, simhash_bk
from brieflow.llm.exact_dedup import drop_exact_copies, exact_groups
from brieflow.llm.simhash_bk import BKTree, components, drop_near_copies, near_groups, simhash

from llm_helpers import words_of


def exact_by_hand(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i, k))
    out = []
    for text, members in groups.items():
        best = min((m[:2] + ((m[2],) if m[2] is not None else (0,)) + (m[3],)) for m in members)
        for _, _, i, k in members:
            out.append((i, None if best[1] else best[2], len(members), k == best[3], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups_match_brute_force(spark, odd_docs):
    rng = random.Random(1)
    texts = [words_of(rng, rng.randrange(1, 9), 30) for _ in range(200)]
    rows = [(i, rng.choice(texts).replace(" ", rng.choice([" ", "  ", "\n"]))) for i in range(1500)] + [(9000 + i, "hot text") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, exact_groups(df).collect()), key=str)
    # which of equal rows stays is open only where id, length and text are equal
    assert got == exact_by_hand(rows)
    got = sorted((tuple(r) for r in exact_groups(odd_docs).collect()), key=str)
    assert got == exact_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_bloom_flags_every_repeat(spark):
    rows = [(i, f"text {i % 700}") for i in range(1000)]
    hashed = exact_dedup.hash_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    table = exact_dedup.seen_again(hashed, 1 << 16)
    flagged = {r.doc_id for r in exact_dedup.flag_repeats(hashed, table).filter("_again").collect()}
    assert {i for i in range(1000) if i < 300 or i >= 700} <= flagged and len(flagged) < 640


def test_shards_have_tables_of_their_own(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 1 << 15)
    rows = [(i, f"a text of its own, number {i}") for i in range(6000)] + [(10_000 + i, f"copied text {i % 900}") for i in range(1800)] + [(20_000 + i, "hot") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert exact_dedup._shards(len(rows)) == 5
    assert sorted(map(tuple, exact_groups(df).collect()), key=str) == exact_by_hand(rows)
    kept = {r[0] for r in exact_by_hand(rows) if r[3]}
    got = drop_exact_copies(df.withColumn("_row", F.lit(1)).withColumn("_shard", F.lit(2)))
    assert got.columns == ["doc_id", "text", "_row", "_shard"] and sorted(r.doc_id for r in got.collect()) == sorted(kept)

    flagged = []
    flag = exact_dedup.flag_repeats
    monkeypatch.setattr(exact_dedup, "flag_repeats", lambda *a: flagged.append(flag(*a)) or flagged[-1])
    exact_groups(df)
    alone = sum(f.filter("_again and _id < 6000").count() for f in flagged)
    assert len(flagged) == 5 and alone < 0.02 * 6000  # rows without a copy that would shuffle

    monkeypatch.setattr(exact_dedup, "_shards", lambda total: 3)
    want = exact_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert sorted((tuple(r) for r in exact_groups(odd_docs).collect()), key=str) == want
    assert sorted(r["_row"] for r in drop_exact_copies(odd_docs).collect() if r.doc_id != 4) == [2, 5, 7, 8, 9, 10]


def test_drop_exact_copies_keeps_columns_and_one_row_each(spark, odd_docs, no_docs):
    kept = drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["_row"] for r in kept.collect() if r.doc_id != 4) == [2, 5, 7, 8, 9, 10] and kept.filter("doc_id = 4").count() == 1
    assert drop_exact_copies(no_docs).columns == no_docs.columns and drop_exact_copies(no_docs).count() == 0
    assert exact_groups(no_docs).count() == 0


def test_simhash_by_definition():
    rng = random.Random(2)
    for n in (0, 1, 3, 4, 5, 60):
        text = "  ".join(rng.choice(["Añ", "BC", "d", "e f"]) for _ in range(n))
        words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c < "\x80" else c for c in text))
        grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        assert simhash(text, 4) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_bk_tree_finds_all_within_radius():
    rng = random.Random(3)
    words = [rng.getrandbits(64) & 0xFFFF0F0F for _ in range(600)]
    tree = BKTree()
    for w in words:
        tree.add(w)
    for q in words[:80]:
        assert sorted(tree.words[i] for i in tree.within(q, 4)) == sorted(w for w in words if (w ^ q).bit_count() <= 4)


def by_hand(prints, radius):
    ids = sorted(prints)
    least = {i: i for i in ids}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                ra, rb = root(a), root(b)
                least[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("shard", [4096, 20])
def test_near_groups_match_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash_bk, "SHARD_MAX", shard)  # 20: large shards are cut into several trees
    rng = random.Random(4)
    base = [words_of(rng, 120) for _ in range(25)]
    rows = []
    for i in range(350):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \t")]
    got = {r.doc_id: r.component_id for r in near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = by_hand({i: simhash(t, 4) for i, t in rows}, 4)
    assert got == want and len(set(want.values())) < 300


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 900), (700, 900)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 700: 500, 900: 500}


def test_drop_near_copies(spark, odd_docs, no_docs):
    kept = drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    prints = {int(r.fingerprint, 16) for r in near_groups(odd_docs).collect()}
    groups = by_hand({p: p for p in prints}, 4)
    assert kept.count() == len(set(groups.values())) < len(odd_docs.collect())
    assert drop_near_copies(no_docs).count() == 0 and near_groups(no_docs).count() == 0
