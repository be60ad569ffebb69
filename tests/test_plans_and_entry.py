"""Plan-shape checks and the driver contract."""

import importlib.util
import os

from brieflow.operators import select
from brieflow.operators.similarity import hamming_pairs, simhash64
from brieflow.sources.testbed import articles

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_uses_window_group_limit(spark):
    from brieflow.operators import enrich, score
    s = score.score(enrich.enrich(articles(spark, SF)))
    df = select.top_n_per_domain(s)
    df.collect()
    assert "WindowGroupLimit" in _plan(df) or "WindowGroupLimit" in df._jdf.queryExecution().toString()


def test_hamming_pairs_is_equi_join(spark):
    df = hamming_pairs(simhash64(articles(spark, SF)))
    text = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_simhash_methods_agree(spark):
    a = articles(spark, SF)
    x = simhash64(a, method="arrow")
    y = simhash64(a, method="native")
    assert x.exceptAll(y).count() == 0


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    rows = df.collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(rows) > 10
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_lexicon_is_matched_once_for_selection(spark):
    """Selection reads one checkpoint of the candidates, so the full-text patterns are tested in one stage."""
    from brieflow.operators import enrich, score
    chosen = select.select(score.score(enrich.enrich(articles(spark, SF))))
    assert "contains" not in chosen._jdf.queryExecution().analyzed().toString().lower()


def test_no_article_text_is_shuffled_by_source(spark):
    plan = articles(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # the small registry is broadcast (only its own distinct sources are dealt out), the text has one exchange, by doc_id
    assert "REPARTITION" not in plan and "BroadcastHashJoin [source" in plan and plan.count("hashpartitioning(source") == 1


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    import pytest

    from brieflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
