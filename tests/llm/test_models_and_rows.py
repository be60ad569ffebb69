"""Toxicity, chat windows, url filter and the pipeline."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brieflow.llm import catalog, chat_windows as cw, toxicity as tx, url_filter
from brieflow.llm.url_filter import Rule, judge_urls

from llm_helpers import words_of

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- toxicity ----------------------------------------------------------------------------------------------------

def test_subwords_by_definition():
    points = tx.letters(" Ab  cdé ab ")
    assert "".join(map(chr, points)) == " ab cdé "
    text = "".join(map(chr, points))
    for n, (starts, _) in zip(tx.SIZES, tx.subwords(points)):
        want = [i for i in range(len(text) - n + 1) if " " not in text[i + 1:i + n - 1]]
        assert starts.tolist() == want


def test_scores_of_portions_equal_scores_of_texts(monkeypatch):
    rng = random.Random(1)
    texts = [words_of(rng, rng.randrange(40)) for _ in range(60)] + [None, ""]
    weights = np.random.default_rng(2).normal(size=tx.BUCKETS + 1).astype(np.float32)
    whole = tx.logits(texts, weights)
    monkeypatch.setattr(tx, "PORTION", 1)
    assert np.allclose(whole, tx.logits(texts, weights))
    by_bags = [weights[-1] + (weights[tx.bag(t)[0]] * tx.bag(t)[1]).sum() for t in texts]
    assert np.allclose(whole, by_bags, atol=1e-4)


def test_learns_words_and_unseen_misspellings(spark):
    rng = random.Random(3)
    bad = ["grumblefop", "snarkwit", "blatherskite"]
    rows, labels = [], []
    for i in range(500):
        text, toxic = words_of(rng, 60).split(), i % 5 == 0
        if toxic:
            text[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(9000 + k, words_of(rng, 30) + " " + w) for k, w in enumerate(["grumblefopp", "snarkwitt", "blathersskite", "plain"])]
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in tx.toxicity(docs, known).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} >= set(held)
    right = sum(got[i].predicted == labels[i][1] for i in held) / len(held)
    assert right >= 0.95
    assert [got[9000 + k].predicted for k in range(4)] == [1, 1, 1, 0]


def test_held_out_labels_are_not_learned(spark):
    docs = spark.createDataFrame([(i, words_of(random.Random(i), 20)) for i in range(60)], "doc_id long, text string")
    label = lambda turned: spark.createDataFrame([(i, (i % 2) ^ (turned and zlib.crc32(str(i).encode()) % 5 == 0)) for i in range(60)], "doc_id long, toxic int")
    assert [np.array_equal(tx.fit_model(docs, label(False)), tx.fit_model(docs, label(t))) for t in (False, True)] == [True, True]


def test_toxicity_without_labels_and_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = tx.toxicity(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and all(abs(r.score - 0.25) < 1e-6 and r.predicted == 0 for r in got)
    assert tx.drop_toxic(odd_docs, none).columns == odd_docs.columns
    assert tx.toxicity(no_docs, none).count() == 0


def test_held_out_accuracy_on_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    judged = tx.toxicity(docs, labels).filter("held_out").join(labels, "doc_id")
    n, wrong, toxic, found = judged.agg(F.count("*"), F.sum((1 - F.col("toxic")) * F.col("predicted")), F.sum("toxic"), F.sum(F.col("toxic") * F.col("predicted"))).first()
    # about 350 toxic texts in four languages to learn from
    assert wrong / (n - toxic) < 0.03 and found / toxic > 0.75


# --- chats -------------------------------------------------------------------------------------------------------

def chat_rows():
    rng = random.Random(4)
    bits = ["<|im_end|>", "<|im_start|>", "<\\|", "<|", "<\\\\|im_end|>", "\n", "%0A", "ok", "é", "😀", " ", "word", "assistant"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a\nb", "%25", "<|x", "", None]), None if rng.random() < 0.1 else "".join(rng.choices(bits, k=rng.randrange(60))))
            for c in range(30) for t in range(rng.randrange(1, 12))]
    rows += [(100, t, ["system", "user", "assistant"][min(t, 2 - t % 2)], words_of(rng, 90)) for t in range(40)]
    rows += [(101, t, ["user", "assistant"][t % 2], words_of(rng, 40)) for t in range(1500)]  # one long conversation
    rows += [(102, 0, "user", "same"), (102, 0, "user", "same"), (102, None, "system", "no number"), (None, 1, "assistant", "no id"), (103, 0, "assistant", words_of(rng, 5000))]
    return rows


def test_chats_read_back_whole(spark):
    rows = chat_rows()
    windows = cw.chat_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    got = {r.conv_id: r for r in cw.chat_digest(windows).collect()}
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t is not None, t or 0, r or "", x or ""))
    formatted = {r.conv_id: r.n for r in windows.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect()}
    for c, own in turns.items():
        own.sort()
        shown = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        learned = "".join(x for _, _, r, x in own if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), hashlib.sha256(shown.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert got[c].formatted_chars == formatted[c]


def test_windows_keep_to_the_budget(spark):
    rows = [r for r in chat_rows() if r[0] in (100, 101)]
    windows = cw.chat_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=400, history=120)
    counted = windows.withColumn("turns", cw.read_turns(F.col("formatted"))).withColumn(
        "tokens", F.aggregate(F.transform("turns", lambda t: cw.token_count(t["text"]) + cw.MARKS), F.lit(0).cast("long"), lambda s, n: s + n)).collect()
    assert all(r.tokens <= 400 for r in counted)
    many = [r for r in counted if r.conv_id == 100]
    assert len(many) > 5 and all(r.turns[0].role == "system" for r in many)
    later = [r for r in counted if r.conv_id == 101 and r.n_repeated]
    assert later and all(sum(len(t.text.split()) for t in r.turns[:r.n_repeated]) <= 120 for r in later)


def windows_by_hand(turns, budget, history):
    """``[(own, repeated)]`` turn numbers of each window of one conversation, whose turns are ``(role, tokens)``; -1 is the repeated system turn."""
    sums = list(itertools.accumulate((n for _, n in turns), initial=0))
    system = turns[0][1] if turns[0][0] == "system" and turns[0][1] <= budget - budget // 4 else 0
    most = min(history, budget - budget // 4 - system)
    room = budget - system - most
    inside, over = defaultdict(list), []
    for i, (_, n) in enumerate(turns):
        a, b = sums[i] // room, (sums[i] + n - 1) // room
        if a == b:
            inside[a].append(i)
        else:
            over.append((i, a, b))
    used = {a: sum(turns[i][1] for i in own) for a, own in inside.items()}
    windows, left = {2 * a + 1: list(own) for a, own in inside.items()}, []
    for i, a, b in over:
        if a in used and used[a] + turns[i][1] <= room:
            windows[2 * a + 1].append(i)
            used[a] += turns[i][1]
        else:
            left.append((i, a, b))
    for i, a, b in left:
        windows.setdefault(2 * b + 1 if b in used and used[b] + turns[i][1] <= room else 2 * a + 2, []).insert(0, i)
    out = []
    for _, own in sorted(windows.items()):
        total = sum(turns[i][1] for i in own)
        again = own[0] > 0 and system > 0 and total + system <= budget
        fits = max(min(most, budget - total - again * system), 0)
        out.append((own, [-1] * again + [i for i in range(again, own[0]) if sums[i] >= sums[own[0]] - fits]))
    return out


@pytest.mark.parametrize("budget,history", [(120, 30), (400, 120), (400, 0), (64, 60)])
def test_windows_match_brute_force(spark, budget, history):
    rng = random.Random(budget)
    chats = {c: [(rng.choice(["user", "assistant"]), rng.choice([1, 3, 8, 20, 60, 150])) for _ in range(rng.choice([1, 5, 40, 300]))] for c in range(12)}
    for c in range(0, 12, 2):  # system turns from short to longer than the budget
        chats[c][0] = ("system", [2, 15, 40, 90, 310, 500][c // 2])
    chats[20] = [("user", 1)] * 700  # many short turns in a window
    rows = [(c, t, r, f"{t} " + "w " * (n - 1)) for c, own in chats.items() for t, (r, n) in enumerate(own)]
    got = cw.chat_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5), budget=budget, history=history)
    got = got.select("conv_id", "window", "n_repeated", cw.read_turns(F.col("formatted")).alias("turns")).orderBy("conv_id", "window").collect()
    by_chat = defaultdict(list)
    for r in got:
        of = [int(t.text.split()[0]) for t in r.turns]
        by_chat[r.conv_id].append((of[r.n_repeated:], of[:r.n_repeated]))
        size = [len(t.text.split()) + cw.MARKS for t in r.turns]
        assert sum(size) <= budget or len(size) == 1
    for c, own in chats.items():
        want = windows_by_hand([(r, n + cw.MARKS) for r, n in own], budget, history)
        assert by_chat[c] == [(o, [max(i, 0) for i in again]) for o, again in want]
    assert budget < 400 or max(len(o) for o, _ in by_chat[20]) > 48


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cw.chat_digest(cw.chat_windows(none)).count() == 0


def test_escaping_is_reversible(spark):
    rng = random.Random(5)
    texts = [("".join(rng.choices("<|\\%0A25\nx", k=rng.randrange(14))),) for _ in range(3000)]
    df = spark.createDataFrame(texts, "t string")
    bad = df.filter((cw.unescape(cw.escape(F.col("t"))) != F.col("t")) | cw.escape(F.col("t")).contains("<|")
                    | (cw.unescape_role(cw.escape_role(F.col("t"))) != F.col("t")) | cw.escape_role(F.col("t")).contains("\n"))
    assert bad.count() == 0


# --- urls --------------------------------------------------------------------------------------------------------

def url_by_hand(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, path = "".join(c.lower() if c < "\x80" else c for c in rest[:cut]), rest[cut:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.host + r.path), default=None)


def test_urls_match_brute_force(spark):
    urls = [r.url for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme", "http://", "http://A.Org?x=/y", "HTTP://EXAMPLE.ORG/es/1#/x", "a://b://c.org/d", "x://org/", "http://É.com/fr/", "http://h.com/\n/a", "http://xorg/", "http://org#/"]
    rules = catalog.URL_RULES
    rows = [(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[4])]
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    assert len(got) == len(rows)
    want = {i: url_by_hand(u, rules) for i, u in enumerate(urls)}
    for r in got:
        if r.page_id is not None:
            host, path, rule = want[r.page_id]
            assert (r.host, r.path, r.rule) == (host, path, rule and rule.host + rule.path)
            assert r.verdict in ("allow", "block") and (rule is None or r.verdict == ("allow" if rule.allow else "block"))


def test_templates_and_purity(spark):
    rules = [Rule("shop.com", "/offer/a", False), Rule("shop.com", "/news/", True)]
    rows = [f"http://shop.com/offer/a{i}name" for i in range(40)] + [f"http://shop.com/offer/zz{'abcdefghijklmnopqrstuvwxyz'[i]}" for i in range(26)]
    rows += [f"http://shop.com/news/{i}/page" for i in range(40)] + ["http://shop.com/other", "http://else.net/offer/b"]
    got = {r.url: r for r in judge_urls(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules).join(
        spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), "page_id").collect()}
    assert got["http://shop.com/news/7/page"].template == "/news/*/page"
    # the names under /offer/ vary, so they share a branch, which blocked urls dominate
    assert got["http://shop.com/offer/zzq"].template == "/offer/*" and got["http://shop.com/offer/zzq"].rule is None
    assert got["http://shop.com/offer/zzq"].verdict == "block" and got["http://else.net/offer/b"].verdict == "allow"


def purity_by_hand(forms):
    """``{(host, raw): (template, purity)}`` of ``forms``: ``{(host, raw): (segments, n, known, bad)}``, one branch after the other."""
    now = {k: list(s) for k, (s, *_) in forms.items()}
    for d in range(url_filter.LEVELS):
        branches = defaultdict(Counter)
        for k, s in now.items():
            if len(s) > d and "*" not in s[d]:
                branches[k[0], tuple(s[:d])][s[d]] += forms[k][1]
        variable = {b for b, c in branches.items() if len(c) >= url_filter.MANY_CHILDREN and sum(c.values()) <= url_filter.RARE_CHILD * len(c)}
        for k, s in now.items():
            if len(s) > d and "*" not in s[d] and (k[0], tuple(s[:d])) in variable:
                s[d] = "*"
    known, bad = Counter(), Counter()
    for k, s in now.items():
        for d in range(len(s) + 1):
            known[k[0], tuple(s[:d])] += forms[k][2]
            bad[k[0], tuple(s[:d])] += forms[k][3]

    def own(node):
        host, s = node
        if not s:
            return True
        n, rate = known[node], bad[host, s[:-1]] / known[host, s[:-1]] if known[host, s[:-1]] else None
        return n > 0 and rate is not None and abs(bad[node] - n * rate) > url_filter.DIFFERS * math.sqrt(n * rate * (1 - rate))

    pooled = defaultdict(lambda: [0, 0])
    for node in known:
        if not own(node):
            pooled[node[0], node[1][:-1]][0] += known[node]
            pooled[node[0], node[1][:-1]][1] += bad[node]
    prior = (sum(f[3] for f in forms.values()) + 0.5) / (sum(f[2] for f in forms.values()) + 2.0)
    found = {}
    for k, s in now.items():
        p = prior
        for d in range(len(s) + 1):
            node = k[0], tuple(s[:d])
            n, b = (known[node], bad[node]) if own(node) else pooled[node[0], node[1][:-1]]
            p = (b + url_filter.WEIGHT * p) / (n + url_filter.WEIGHT)
        found[k] = "/" + "/".join(s), p
    return found


def test_purity_matches_brute_force(spark):
    rng = random.Random(12)
    forms = {}
    for host in ("a.org", "b.org", "c.net"):
        for _ in range(250):
            s = [rng.choice(["x", "y", "z*"]), rng.choice(["k", "".join(rng.choices("abcdefgh", k=5))]), *rng.choices(["p", "q", "*"], k=rng.randrange(4))]
            s = s[:rng.randrange(1, 6)]
            known = rng.randrange(4)
            forms[host, "/".join(s)] = s, known + rng.randrange(1, 3), known, rng.randrange(known + 1) if s[0] == "x" else 0
    df = spark.createDataFrame([(h, raw, s, n, k, b) for (h, raw), (s, n, k, b) in forms.items()], "host string, raw string, segments array<string>, n long, known long, bad long")
    got = {(r.host, r.raw): (r.template, r.purity) for r in url_filter.template_purity(url_filter._wildcards(df)).collect()}
    want = purity_by_hand(forms)
    assert got.keys() == want.keys() and any("/*" in t for t, _ in want.values())
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_deep_paths_have_a_tail(spark):
    deep = "http://d.org/" + "s/" * 2000
    rows = [deep + "end", deep + "end", deep, "http://d.org/a/b/c/d/e/f/g", "http://d.org/a/b/c/d/e/f/g/h", "http://d.org/a/b/c/d/e/f/g/h/i"]
    rows += [f"http://d.org/a/b/c/d/e/f/g/{''.join(c)}/i" for c in itertools.product("klmn", "opqrs")]
    urls = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r for r in judge_urls(urls, catalog.URL_RULES).collect()}
    assert len(got) == len(rows) and got[0].template == got[1].template == "/" + "s/" * 2000 + "end"
    assert got[0].path == rows[0][len("http://d.org"):] and got[3].template == "/a/b/c/d/e/f/g"
    assert {got[i].template for i in range(6, len(rows))} == {"/a/b/c/d/e/f/g/*"}  # tails vary, so they are one branch


def test_no_urls_and_no_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(none, catalog.URL_RULES).count() == 0
    odd = spark.createDataFrame([(1, "http://a.net/b", "h", "v"), (1, None, None, None)], "page_id long, url string, host string, verdict string")
    assert {r.verdict for r in judge_urls(odd, catalog.URL_RULES).collect()} == {"allow"}


# --- the pipeline ------------------------------------------------------------------------------------------------

def test_pipeline_runs_every_stage_in_order(spark):
    from brieflow.llm.bpe_lexicon import load_bpe
    from brieflow.llm.simhash_bk import simhash
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in tx.toxicity(docs.select("doc_id", "text"), spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    kept = {i: t for i, t in kept.items() if not scores[i]}
    groups = defaultdict(list)
    for i, t in kept.items():
        groups["".join((t or "").translate({c: None for c in (32, 9, 10, 11, 12, 13)}))].append((-len(t or ""), i))
    kept = {min(g)[1]: kept[min(g)[1]] for g in groups.values()}
    prints = {i: simhash(t, 4) for i, t in kept.items()}
    least = {i: i for i in kept}
    while True:
        new = {i: min(least[j] for j in kept if (prints[i] ^ prints[j]).bit_count() <= 4) for i in kept}
        if new == least:
            break
        least = new
    kept = {i: t for i, t in kept.items() if least[i] == i}
    from test_texts import contaminated_by_hand
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {w[0] for w in contaminated_by_hand(kept.items(), items) if not w[-1]}
    bpe = load_bpe(catalog.vocabulary("word_bpe_49k.json"))
    want = {i: sum(len(bpe.encode_word(w)) for w in bpe.pre_tokens(t or "")) for i, t in kept.items() if i in clean}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SMALL).collect()} == want


def test_stages_return_the_columns_of_documents(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
