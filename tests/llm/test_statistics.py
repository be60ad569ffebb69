"""op11 to op13 against plain recounts."""

import collections
import random
import re

import pytest

from brieflow.llm import collocations as co
from brieflow.llm import divergence as dv
from brieflow.llm import quality_rules as qr

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank string, n long, part string, a int"


def corpus(spark, rng, rows=240, vocabulary=30):
    """Small vocabularies, so that phrases repeat; odd separators, nulls and columns with clashing names."""
    ends = [" ", "  ", "\t", ", ", ".\n", " ", "; ", "\x01 ", " "]
    out = []
    for k in range(rows):
        words = (f"{rng.choice(['W', 'w', 'ß', 'é', '中'])}{chr(97 + rng.randrange(vocabulary) % 26)}{rng.choice(ends)}" for _ in range(rng.randrange(0, 60)))
        text = None if k % 41 == 0 else "".join(words)
        out.append((k % 200, text, rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s1", "s2", "s3", None]), 0, "x", 1, "y", 2))
    return spark.createDataFrame(out, SCHEMA).repartition(5)


def expected_collocations(rows, least, top):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i:i + n])) for n in range(1, 6) for i in range(len(w) - n + 1))
    cand = {k: v for k, v in counts.items() if v >= least and len(k[1]) > 1}
    inside = {(lang, p[i:j]) for (lang, p), f in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
              if j - i < len(p) and 100 * f >= 100 * counts[lang, p[i:j]]}
    found = collections.defaultdict(list)
    for (lang, p), a in cand.items():
        if (lang, p) not in inside:
            score, k = min((1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
            found[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, le, r, total[lang], -s) for lang, v in found.items() for i, (s, a, p, le, r) in enumerate(sorted(v)[:top])}


@pytest.mark.parametrize("most_bits", [co.MOST_BITS, 1 << 11])  # the second makes several shards
def test_collocations_equal_recount(spark, most_bits):
    docs = corpus(spark, random.Random(3), vocabulary=2)
    got = [tuple(r) for r in co.collocations(docs, least=12, top=40, most_bits=most_bits).collect()]
    assert len(got) == len(set(got)) and len(got) > 20
    assert set(got) == expected_collocations([(r["lang"], r["text"]) for r in docs.collect()], 12, 40)


def test_colliding_fingerprints_are_told_apart_by_text():
    words = [b"aa", b"bb", b"aa", b"bbb", b"bb", b"aa"]
    p = co.Portion([b" ".join(words)], [1])
    at = p.grams(1)
    found = {words[first]: n for first, n in p.phrases(at, 1, at.astype("uint64") * 0)}  # all fingerprints alike
    assert found == {b"aa": 3, b"bb": 2, b"bbb": 1}


def test_portions_cut_long_texts_where_a_piece_ends(monkeypatch):
    monkeypatch.setattr(co, "PORTION", 64)
    text = b"one two three. " * 30 + b"x" * 200 + b" y z, " + b"a b c"
    assert b"".join(co._cut(text)) == text and len(list(co._cut(text))) > 5
    assert all(part == list(co._cut(text))[-1] or co.KIND[part[-1]] == 2 for part in co._cut(text))


def expected_divergence(rows, least_docs=10, top=10):
    held, own = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        c = collections.Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)))
        held[lang or ""].update(c.keys())
        own[lang or "", source or ""].update(c)
    out = set()
    for lang, in_docs in held.items():
        kept = [t for t, n in in_docs.items() if n >= least_docs]
        groups = {s: c for (x, s), c in own.items() if x == lang}

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), collections.Counter()))
        for s in groups:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            terms = sorted((-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            for part, ranked in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("block", [dv.BLOCK_SOURCES, 2])  # the second cuts sources and terms into several cells
def test_divergence_equals_recount(spark, monkeypatch, block):
    monkeypatch.setattr(dv, "BLOCK_SOURCES", block)
    monkeypatch.setattr(dv, "BUCKET_TERMS", 7 if block == 2 else dv.BUCKET_TERMS)
    docs = corpus(spark, random.Random(4))
    extra = spark.createDataFrame([(1, "1 2 3", "xx", "s1", 0, "x", 1, "y", 2), (2, None, "xx", "s9", 0, "x", 1, "y", 2)], SCHEMA)  # no terms
    docs = docs.unionByName(extra)
    got = [tuple(r) for r in dv.divergence(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == expected_divergence([(r["lang"], r["source"], r["text"]) for r in docs.collect()])


def test_long_texts_are_counted_in_portions(monkeypatch):
    monkeypatch.setattr(dv, "PORTION", 10)
    assert dv.count_terms("Ab ab, é2é abc".encode() * 9) == collections.Counter({b"ab": 10, "é".encode(): 18, b"abc": 1, b"abcab": 8})


def measured(text):
    w, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    hit = {q for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for q in range(k, k + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_measures_equal_recount(spark, odd_docs):
    rng = random.Random(5)
    texts = ["a b c d e " * 7, "x", "a b c d e f a b c d e", "a\x1cb\x85c\xa0d e a", "l\nl\n \nl\r\n", "# $ <|> é\n" * 4] + [
        " ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(60)]
    docs = odd_docs.unionByName(spark.createDataFrame([(100 + k, t, None, "s", 0, "k", 0.0, 1) for k, t in enumerate(texts)], odd_docs.schema))
    got = sorted(map(str, ((r["_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in qr.measures(docs).collect())))
    assert got == sorted(map(str, ((r["doc_id"], *measured(r["text"] or "")) for r in docs.collect())))


def labelled(spark, rng, n=1500):
    """Good texts without symbols; bad ones full of them; in stratum ``b`` a third of the good ones as well."""
    docs, labels = [], []
    for k in range(n):
        good, stratum = rng.random() < 0.7, rng.choice(["a", "b", None])
        symbols = not good or (stratum == "b" and rng.random() < 0.33)
        docs.append((k, " ".join(f"w{rng.randrange(10**6)}{'#$%' if symbols else ''}" for _ in range(20)), stratum))
        labels.append((k, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_hold_the_risk_in_every_stratum(spark):
    docs, labels = labelled(spark, random.Random(6))
    out = qr.quality(docs, labels, rules=[qr.RULES[0]]).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for stratum, used in (("a", True), ("b", False), (None, True)):  # in b every cutoff would lose a third of the good ones
        of = [r for r in out if r["lang"] == stratum]
        assert all(r["kept"] for r in of if r["quality"] == 1)
        assert all(r["kept"] != used for r in of if r["quality"] == 0)


def test_tail_is_exact_binomial(spark):
    from math import comb

    from pyspark.sql import functions as F
    rows = [(k, m) for m in (0, 1, 7, 200) for k in (0, 1, 3, 7, 200) if k <= m]
    for r in spark.createDataFrame(rows, "k long, m long").select("k", "m", qr.binomial_tail(F.col("k"), F.col("m"), 0.03).alias("p")).collect():
        exact = sum(comb(r["m"], i) * 0.03**i * 0.97 ** (r["m"] - i) for i in range(r["k"] + 1))
        assert abs(r["p"] - exact) < 1e-9


def test_few_labels_and_copies_reject_nothing(spark):
    docs, labels = labelled(spark, random.Random(7), n=60)
    one = docs.filter("doc_id = 0").select("text", "lang")
    copies = spark.range(1000, 3000).withColumnRenamed("id", "doc_id").crossJoin(one).select(*docs.columns)  # one text, many rows
    more = copies.selectExpr("doc_id", "1 quality")
    out = qr.quality(docs.unionByName(copies), labels.unionByName(more), rules=[qr.RULES[0]])
    assert out.filter("not kept").count() == 0 and out.count() == 2060


def test_empty_and_odd_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert co.collocations(no_docs).count() == 0 and dv.divergence(no_docs).count() == 0 and qr.quality(no_docs, none).count() == 0
    odd_labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    assert qr.quality(odd_docs, odd_labels).count() == odd_docs.count()
    found = {r["phrase"]: r["a"] for r in co.collocations(odd_docs).collect()}
    assert found["word word"] == 39_999 and dv.divergence(odd_docs, least_docs=1).filter("part = 'pair'").count() == 6
