"""Hand-made golden cases (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.operators import dedup, enrich, score, select
from brieflow.operators.election import leader_election
from first_fit import first_fit_reference


def test_scores_golden(spark):
    rows = [("F1", 0.91, 1, 0.9, 0.6985, 0.5937), ("F2", 0.68, 2, 0.7, 0.6180, 0.6180),
            ("F3", 0.10, 1, 0.5, 0.3150, 0.2678), ("F4", 0.95, 7, 0.9, 0.9125, 0.9125),
            ("F5", None, None, None, 0.4550, 0.3868)]
    df = spark.createDataFrame(rows, "case string, credibility_score double, corroboration_count long, "
                                     "actor_significance double, imp double, adj double")
    got = score.score(df.withColumn("pmesii_tags", F.array().cast("array<string>"))).collect()
    for r in got:
        assert abs(r["importance_score"] - r["imp"]) < 1e-9, r
        assert abs(r["bias_adjusted_score"] - r["adj"]) < 1e-9, r
        assert r["risk_score"] == 0.3


def test_f6_novelty_and_clamp(spark):
    df = spark.createDataFrame([(1.70, 5, 0.7, 0.0)], "credibility_score double, corroboration_count long, "
                                                       "actor_significance double, novelty double")
    r = score.score(df).collect()[0]
    assert r["importance_score"] == 0.775 and r["bias_adjusted_score"] == 0.775


def test_risk_by_domain(spark):
    expect = {"politics": 0.2, "trade_sanctions": 0.4, "energy_resources": 0.35, "information_ops": 0.1,
              "health_pandemic": 0.3, "nowhere": 0.3}
    df = spark.createDataFrame([(d,) for d in expect], "primary_domain string")
    got = {r["primary_domain"]: r["risk_score"] for r in score.risk_score(enrich.pmesii_tags(df)).collect()}
    assert got == expect


def test_selection_golden(spark):
    rows = [("a1", 1, "politics", "US", 0.70, 2), ("a2", 2, "politics", "US", 0.65, 2),
            ("a3", 3, "politics", "China", 0.65, 1), ("a4", 4, "politics", "Other", 0.60, 1),
            ("a5", 5, "military", "US", 0.65, 2), ("a6", 6, "military", "Iran", 0.55, 1),
            ("a7", 7, "economics", "Other", 0.50, 3), ("a8", 8, "economics", "Other", 0.50, 1),
            ("a9", 9, "economics", "Other", 0.50, 1), ("a10", 10, "economics", "Other", 0.50, 1),
            ("a11", 11, "lawfare", "China", 0.29, 1), ("a12", 12, "lawfare", "China", 0.30, 2)]
    df = spark.createDataFrame(rows, "id string, arr long, primary_domain string, primary_country string, "
                                     "bias_adjusted_score double, corroboration_count long")
    out = [r["id"] for r in select.select(df).orderBy("rank").collect()]
    assert out == ["a1", "a2", "a3", "a4", "a6", "a7", "a8", "a9", "a12"]


def _arts(spark, rows):
    return spark.createDataFrame(rows, "arr long, id string, url string, title string, body string, summary string")


def test_l1_url_variants(spark):
    df = _arts(spark, [(1, "x", "http://X/a", "", "", ""), (2, "y", " HTTP://x/A ", "", "", ""),
                       (3, "z", "http://x/a?b", "", "", ""), (4, "n1", None, "", "", ""),
                       (5, "n2", "", "", "", "")])
    keep = {r["arr"] for r in dedup.l1_url_dedup(df).filter("l1_keep").collect()}
    assert keep == {1, 3, 4}


def test_first_fit_not_components(spark):
    # A~B, B~C, A!~C -> leaders A and C, B -> A
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "node long")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")
    got = {r["node"]: r["leader"] for r in leader_election(nodes, edges).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_first_leader_wins(spark):
    # leaders A(1), C(3); D(4) adjacent to both -> A
    nodes = spark.createDataFrame([(1,), (3,), (4,)], "node long")
    edges = spark.createDataFrame([(1, 4), (3, 4)], "u long, v long")
    got = {r["node"]: r["leader"] for r in leader_election(nodes, edges).collect()}
    assert got == {1: 1, 3: 3, 4: 1}


def test_enrichment_cases(spark):
    rows = [(1, "", "refund", "all"), (2, "", "summit and drone", "all"), (3, "", "GDP grows", "military"),
            (4, "", "nothing here", "all"), (5, "", "NATO meets", "all"), (6, "", "virus in brazil", "all")]
    df = spark.createDataFrame(rows, "arr long, title string, body string, domain string") \
        .withColumn("summary", F.lit(""))
    got = {r["arr"]: r for r in enrich.enrich(df).collect()}
    assert got[1]["domain_scores"] == {"politics": 1} and got[1]["primary_domain"] == "politics"
    assert got[2]["primary_domain"] == "politics"
    assert got[3]["primary_domain"] == "military"
    assert got[4]["domain_scores"] == {} and got[4]["primary_domain"] == "politics"
    assert got[5]["domain_scores"] == {"politics": 1, "military": 1} and got[5]["actor_significance"] == 0.9
    assert got[6]["actor_significance"] == 0.9


def test_country_order_and_title_case(spark):
    df = spark.createDataFrame([(1, "china and the us say", "x"), (2, "t", "y")], "arr long, title string, body string")
    df = df.withColumn("ner_entities", F.when(F.col("arr") == 2, F.array(F.struct(
        F.lit("guinea-bissau").alias("text"), F.lit("GPE").alias("label")))).otherwise(
        F.array().cast(enrich.ENTITY_TYPE)))
    got = {r["arr"]: r["primary_country"] for r in enrich.primary_country(df).collect()}
    assert got == {1: "US", 2: "Guinea-Bissau"}


def test_matchers_agree(spark):
    """One pass over all patterns gives what the single operators give."""
    from brieflow.sources.testbed import articles
    a = articles(spark, "/root/testdata/sf0.001")
    cols = ["arr", "primary_domain", "actor_significance", "gdelt_themes"]
    x = enrich.enrich(a).select(*cols)
    y = enrich.theme_match(enrich.actor_significance(enrich.route_domain(a))).select(*cols)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_first_fit_reference_rule():
    got = first_fit_reference([1, 2, 3], lambda a, b: abs(a - b) == 1)
    assert got == {1: 1, 2: 1, 3: 3}
