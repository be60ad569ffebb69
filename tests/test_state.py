"""State between batches, exact cosine pairs, feeds, safe map, mentions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import dedup, enrich, ingest
from brieflow.operators.similarity import cosine_cross_pairs, cosine_pairs, minhash_near_dup
from brieflow.sources import feeds

ART = "arr long, id string, url string, title string, body string, summary string"


def article(arr, url, body):
    return (arr, f"id{arr}-{url}", url, "", body, "")


def test_stored_leaders_come_first_whatever_their_key(spark):
    text = "a text about the weather in the north and the harvest in the south of the land"
    one = spark.createDataFrame([article(900, "u1", text)], ART)
    two = spark.createDataFrame([article(5, "u2", text), article(6, "u3", "something else entirely, of other things")], ART)
    _, store = dedup.incremental_dedup(one, None)
    out, t = dedup.incremental_dedup(two, store, return_tables=True)
    assert [r.arr for r in out.collect()] == [6]
    assert {r.id: r.story_id for r in t["story_map"].collect()}["id5-u2"] == "id900-u1"


def test_store_parts_count_by_themselves(spark):
    rules = P.Rules(use_l2=False, use_l3=False)
    one = spark.createDataFrame([article(1, "u1", "first words")], ART)
    two = spark.createDataFrame([article(2, "U1 ", "other words")], ART)
    _, store = dedup.incremental_dedup(one, None, rules=rules)
    out, _ = dedup.incremental_dedup(two, store, rules=rules)
    assert store["l2_leaders"] is None and out.count() == 0


@pytest.mark.parametrize("block_rows", [7, 64, 4096])
def test_cosine_pairs_do_not_depend_on_the_layout(spark, block_rows):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    vectors = centres[rng.integers(0, 6, 150)] + 0.4 * rng.normal(size=(150, 16))
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "arr long, embedding array<float>")
    dots = vectors.astype(np.float64) @ vectors.astype(np.float64).T
    for t in (0.4, 0.85):
        want = {(i, j) for i in range(150) for j in range(i + 1, 150) if dots[i, j] >= t}
        got = [(r.a, r.b) for r in cosine_pairs(df, t, block_rows=block_rows).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    left, right = df.filter("arr < 60"), df.filter("arr >= 50")
    got = {(r.l, r.r) for r in cosine_cross_pairs(left, right, 0.85, block_rows=block_rows).collect()}
    assert got == {(i, j) for i in range(60) for j in range(50, 150) if dots[i, j] >= 0.85}


def test_no_vectors(spark):
    assert cosine_pairs(spark.createDataFrame([], "arr long, embedding array<float>")).count() == 0


def test_jaccard_pairs_of_copies_and_empty_texts(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "same few words here") for i in range(1, 6)] + [(10, ""), (11, None), (12, " . "), (20, long), (21, long + " one"), (22, long[: len(long) // 2])]
    df = spark.createDataFrame(rows, "arr long, body string").withColumn("title", F.lit("")).withColumn("summary", F.lit(""))
    got = {(r.a, r.b): round(r.jaccard, 4) for r in minhash_near_dup(df).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 1.0, (1, 4): 1.0, (1, 5): 1.0, (20, 21): round(57 / 58, 4)}


def test_malformed_feeds_keep_their_entries(spark):
    rows = [
        (1, "<rss><channel><item><title>A</title><link>http://a/1</link></item><item><title>B</title><link>http://a/2</link></item>"),
        (2, "<rss><channel><item><title>A & B</title><link>http://a/?x=1&y=2</link></item></channel></rss>"),
        (3, '<rdf:RDF xmlns:rdf="r" xmlns:dc="d"><item rdf:about="x"><title>C</title><link>http://c</link><dc:date>2024-01-01T00:00:00Z</dc:date></item></rdf:RDF>'),
        (4, '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>D</title><link rel="self" href="http://s"/><link rel="alternate" href="http://d"/><updated>2024-01-02T00:00:00Z</updated><content>text</content></entry></feed>'),
        (5, "<rss><channel><item><title>E</title><link>http://e</link><content:encoded>whole</content:encoded><description>short</description></item></channel></rss>"),
        (6, "<rss><channel><item><title>F<b></title><link>http://f</link></item><item><title>G</title><link>http://g</link></item></channel></rss>"),
        (7, "not xml at all"), (8, None), (9, ""),
    ]
    got = {}
    for r in feeds.feed_entries(spark.createDataFrame(rows, "source_id long, xml string")).collect():
        got.setdefault(r.feed, {})[r.pos] = r
    assert {f: len(e) for f, e in got.items()} == {1: 2, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2}
    assert got[2][0].title == "A & B" and got[2][0].link == "http://a/?x=1&y=2"
    assert got[3][0].published.startswith("2024-01-01") and got[4][0].links[0].href == "http://d" and got[4][0].content == "text"
    assert got[5][0].content == "whole" and got[5][0].summary == "short"
    assert got[6][0].link == "http://f" and got[6][1].title == "G"


def test_safe_map_keeps_integers_beside_nulls(spark):
    df = spark.createDataFrame([(1, 9007199254740993), (2, None)], "k long, v long")

    def fn(rec):
        if rec["v"] is None:
            raise ValueError("none given")
        return [{"k": rec["k"], "v": rec["v"]}, {"k": rec["k"], "v": rec["v"] + 1}]

    mapped = ingest.flat_map_safe(df, fn, "k long, v long").cache()
    assert sorted(r.v for r in mapped.filter("ok").collect()) == [9007199254740993, 9007199254740994]
    assert "none given" in mapped.filter("not ok").first().error
    (t,) = ingest.flat_map_totals(mapped, df).collect()
    assert (t["items"], t.results, t.failed) == (2, 2, 1)


def test_every_mention_of_an_entity(spark):
    df = spark.createDataFrame([("Orre met Eriner then Orre",)], "body string").withColumn("title", F.lit("")).withColumn("summary", F.lit(""))
    (r,) = enrich.extract_entities(df, [("Orre", "GPE"), ("Eriner", "GPE")]).collect()
    assert [e.text for e in r.ner_entities] == ["Orre", "Eriner", "Orre"]


def test_novelty_counts_in_the_briefing(spark):
    from brieflow.plans.briefing import briefing
    from brieflow.sources.testbed import articles, embeddings_for
    sf = "/root/testdata/sf0.001"
    a, v = articles(spark, sf), embeddings_for(spark, sf)
    plain = {r.arr: r.importance_score for r in briefing(a, v).collect()}
    known = {r.arr: r.importance_score for r in briefing(a, v, history=v.withColumn("arr", F.col("arr") + 10**6)).collect()}
    both = plain.keys() & known.keys()
    assert both and all(known[k] < plain[k] for k in both)  # everything has been seen: novelty 0 instead of 0.7


def test_embedder_and_tagger_are_used(spark):
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<float>")
    def embed(s):
        return s.map(lambda t: [1.0, 0.0] if "rain" in t else [0.0, 1.0])

    @pandas_udf("array<struct<text:string,label:string>>")
    def tag(s):
        return s.map(lambda t: [{"text": t[:3], "label": "ORG"}])

    rows = [article(1, "u1", "rain falls in the north of the country this week"), article(2, "u2", "heavy rain was seen by everyone who was outside"), article(3, "u3", "quite different things are told in this one here")]
    df = spark.createDataFrame(rows, ART)
    assert sorted(r.arr for r in dedup.dedup_cascade(df, None, embedder=embed).collect()) == [1, 3]
    assert enrich.extract_entities(df, tagger=tag).filter("arr = 1").first().ner_entities[0].label == "ORG"


def test_short_paragraphs_stay_and_menus_go(spark):
    html = "<nav>x</nav><div><a href='a'>Home</a> <a href='b'>News</a></div><p>Short one.</p><p>See <a href='c'>this</a> for more about it.</p>"
    (r,) = feeds.extract_page_text(spark.createDataFrame([(html,)], "html string")).collect()
    assert r.page_text == "Short one.\nSee this for more about it."


def test_hot_url_is_never_a_join_key(spark):
    df = spark.createDataFrame([(i, f"id{i}", "same" if i % 3 == 0 else f"u{i}") for i in range(90)], "arr long, id string, url string")
    out = dedup.l1_url_dedup(df)
    assert sorted(r.arr for r in out.filter("l1_keep").collect()) == [0, *(i for i in range(90) if i % 3)]
    assert "url_hash#" not in "".join(x for x in out._jdf.queryExecution().toString().split("\n") if "Join" in x and "LeftOuter" in x)
