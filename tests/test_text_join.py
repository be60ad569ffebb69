"""Table forms of keyword match (A16) and entities (A36) equal the literal forms and brute force."""

import random

from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import enrich
from brieflow.operators.text_join import pattern_rows, substring_join
from brieflow.plans import fixtures as FX
from brieflow.sources.testbed import articles


SF_SMALL = "/root/testdata/sf0.001"
ARTICLE = "arr long, title string, body string, summary string"


def test_equals_brute_force_with_short_and_odd_patterns(spark):
    rng = random.Random(1)
    letters = "abcdé中😀 .%\\"
    texts = [(k, None if k == 3 else "".join(rng.choices(letters, k=rng.randrange(60)))) for k in range(120)] + [(500, "")]
    patterns = {"".join(rng.choices(letters, k=n)) for n in (1, 1, 2, 2, 3, 3, 4, 5) for _ in range(12)} | {"zzz", "abz"}
    rows = [(p,) for p in patterns] * 2 + [(None,), ("",)]
    got = substring_join(spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame(rows, "pattern string"))
    assert sorted((r["k"], r["pattern"]) for r in got.collect()) == sorted((k, p) for k, t in texts if t for p in patterns if p in t)


def test_patterns_beyond_the_broadcast_and_places(spark):
    rng = random.Random(2)
    texts = [(k, "".join(rng.choices("abé😀 ", k=rng.randrange(40)))) for k in range(60)]
    patterns = ["a", "ab", "aa", "é😀", "bab", " a b", "zz"]
    t, p = spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame([(x,) for x in patterns], "pattern string")
    want = sorted((k, x) for k, s in texts for x in patterns if x in s)
    for most in (0, 100):
        assert sorted((r["k"], r["pattern"]) for r in substring_join(t, p, most).collect()) == want
    of = dict(texts)
    got = {}
    for r in pattern_rows(t, patterns, "t").collect():
        assert r["text"] == r["pattern"] and of[r["k"]][r["pos"] - 1:].startswith(r["text"])
        got.setdefault((r["k"], r["pattern"]), []).append(r["pos"])
    assert sorted(got) == want and all(len(at) == of[k].count(x) for (k, x), at in got.items())


def test_repeated_keys_count_as_in_the_join(spark):
    t = spark.createDataFrame([(1, "ab"), (1, "ab"), (2, "ab"), (None, "ab")], "k long, t string")
    p = spark.createDataFrame([("ab",)], "pattern string")
    few, many = (sorted(r["k"] for r in substring_join(t, p, most).collect()) for most in (10, 0))
    assert few == many == [1, 1, 1, 1, 2]


def test_few_patterns_shuffle_no_text(spark):
    texts = spark.range(50).select(F.col("id").alias("k"), F.concat(F.lit("text w"), F.col("id").cast("string")).alias("t"))
    patterns = spark.createDataFrame([(f"w{i}",) for i in range(50)], "pattern string")
    plan = substring_join(texts, patterns)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_no_nested_loop_and_no_pattern_in_the_plan(spark):
    texts = spark.createDataFrame([(k, f"some text number {k} about w{k * 7}") for k in range(200)], "k long, t string")
    patterns = spark.range(100_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("pattern"))
    out = substring_join(texts, patterns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and len(plan) < 20_000
    want = sum(len({f"w{k * 7}"[:n] for n in range(2, 7) if f"w{k * 7}"[:n] == "w0" or f"w{k * 7}"[1:2] != "0"} - {"w"}) for k in range(200))
    assert out.count() == want


def test_keyword_table_equals_literal_lexicon(spark):
    a = articles(spark, SF_SMALL).select("arr", "title", "body", "summary")
    rows = [(d, k) for d, kws, _ in FX.topics_with_corpus_themes(P.TOPICS) for k in kws] + [("x", "Th"), ("y", "e"), ("z", "the ")]
    literal = enrich.keyword_match(a, [("x", ["Th"], []), ("y", ["e"], []), ("z", ["the "], []), *P.TOPICS]).select("arr", "domain", "keyword")
    table = enrich.keyword_match_table(a, spark.createDataFrame(rows, "domain string, keyword string")).select("arr", "domain", "keyword")
    assert sorted(map(tuple, literal.collect())) == sorted(map(tuple, table.collect())) and literal.count() > 0


def test_entity_table_equals_literal_gazetteer(spark):
    a = articles(spark, SF_SMALL).select("arr", "title", "body", "summary")
    odd = spark.createDataFrame([(-1, "Ab.c ab\\Ec", "AB.C ab.c", ""), (-2, None, None, None), (-3, "", "aaaa", "")], ARTICLE)
    given = [*FX.CORPUS_GAZETTEER, ("ab.c", "ORG"), ("aa", "PERSON"), ("ab", "GPE"), ("skip", "NOLABEL")]
    literal = enrich.extract_entities(a.unionByName(odd), given).select("arr", "ner_entities")
    got = enrich.extract_entities_table(a.unionByName(odd), spark.createDataFrame(given, "surface string, label string"))
    assert {r[0]: r[1] for r in literal.collect()} == {r[0]: r[1] for r in got.collect()}


def test_longest_surface_only(spark):
    a = spark.createDataFrame([(1, "New York Times in York", "", "")], ARTICLE)
    g = spark.createDataFrame([("york", "GPE"), ("new york", "GPE"), ("new york times", "ORG"), ("b\\Ec", "ORG")], "surface string, label string")
    got = enrich.extract_entities_table(a, g, longest_only=True).first()["ner_entities"]
    assert [(e["text"], e["label"]) for e in got] == [("New York Times", "ORG"), ("York", "GPE")]
