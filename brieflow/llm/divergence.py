"""Source divergence audit: how far the sources of a language differ in the words that they use.

Terms are read by a translate table: ``bytes.translate`` lowers the letters A-Z and blanks everything that is neither a
letter nor a byte above ASCII in one pass, ``bytes.split`` cuts the terms and a ``Counter`` for each document gives
their frequencies. A task adds the documents' counters up by (lang, source) and sends sums (lang, source, term) only, so a source
that holds a third of all rows costs a row per term and task. One shuffle by (lang, term) settles which terms a language
keeps, namely those in ``least_docs`` of its documents, and their counts.

A kept term's share in a group (lang, source), or in the whole language, is smoothed and scaled to a whole number
``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, N being the group's occurrences of kept terms and V their number. Two
shares differ by ``f = floor((p - q)^2 / (p + q))``. Part ``pair`` sums f over all kept terms for every two sources of a
language; part ``term`` ranks the terms that a group uses more than its language does. Pairs are summed in cells of (lang, bucket of
terms, two blocks of sources), of which a task holds one; terms that neither of two sources has add the same f each, so they are counted only.

Arithmetic is exact: counts are scaled as decimals, the rest fits 64 bits (a share is at most 10^9 + 1).

Defined cases: null text, lang and source count as ''; a group without terms has the shares of count 0; a language
without kept terms gives value 0 for its pairs and no terms; ties rank by item in UTF-8 order; repeated rows (and null or
equal ids, which are not read) count as often as they occur; very long texts are split in portions, which are counted together; an empty table
gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow.llm.common import slices, stored, texts_utf8

#: letters in lower case, bytes above ASCII as they are, everything else a blank
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
SCALE = 1_000_000_000
#: bytes of a text that are split at once
PORTION = 1 << 20
#: terms that a task holds before it sends their sums
HELD = 300_000
#: kept terms, and sources, of which a task holds the shares at once (about)
BUCKET_TERMS, BLOCK_SOURCES = 2048, 64


def count_terms(body: bytes) -> Counter:
    """Occurrences of each term of a text."""
    body = body.translate(TABLE)
    if len(body) <= PORTION:
        return Counter(body.split())
    found, at = Counter(), 0
    while at < len(body):
        end = body.find(b" ", at + PORTION)
        end = len(body) if end < 0 else end
        found.update(body[at:end].split())
        at = end
    return found


def term_sums(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Partial sums (lang, source, term, n, docs) of all texts: several rows for a term, from several tasks."""

    def send(groups: dict) -> pa.RecordBatch:
        rows = [(*key, t, n, in_docs[t]) for key, (total, in_docs) in groups.items() for t, n in total.items()]
        lang, source, term, n, in_docs = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
                                           pa.array(n, pa.int64()), pa.array(in_docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        held = 0
        for b in slices(batches):
            data, at = texts_utf8(b.column(2))
            for k, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                own = count_terms(data[at[k]:at[k + 1]].tobytes())
                if not own:
                    continue
                total, in_docs = groups.setdefault(key, (Counter(), Counter()))
                held -= len(total)
                total.update(own)
                in_docs.update(own.keys())
                held += len(total)
                if held >= HELD:
                    yield send(groups)
                    groups, held = {}, 0
        if held:
            yield send(groups)

    given = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col)), F.col(text_col).alias("_text"))
    return given.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _share(count: Column, total: Column, kept: Column) -> Column:
    """Smoothed share of a term, scaled to a whole number."""
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", scaled, (total + 2 * kept).cast("decimal(20,0)"))


def _differ(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(t: pa.Table) -> pa.Table:
    """Sums of f for the pairs of sources of one cell, and the number of terms in it."""
    lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
    names, block, term, p = t["source"].to_pylist(), t["block"].to_numpy(), t["term"].to_pylist(), t["p"].to_numpy()
    place = {n: i for i, n in enumerate(sorted(set(names)))}
    column: dict = {}
    row = np.array([place[n] for n in names])
    at = np.array([-1 if x is None else column.setdefault(x, len(column)) for x in term])
    shares, of_block = np.zeros((len(place), len(column)), np.int64), np.zeros(len(place), np.int64)
    none = at < 0  # one such row for each source: its share at count 0
    shares[row[none]] = p[none][:, None]
    of_block[row[none]] = block[none]
    shares[row[~none], at[~none]] = p[~none]
    left, right = np.flatnonzero(of_block == lo), np.flatnonzero(of_block == hi)
    order, a, b, f = sorted(place), [], [], []
    for i in left:
        met = right[right > i] if lo == hi else right
        gap, both = shares[met] - shares[i], shares[met] + shares[i]
        f.extend((gap * gap // both).sum(axis=1).tolist())
        a.extend([order[i]] * len(met))
        b.extend(order[j] for j in met)
    return pa.table({"lang": pa.array([t["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()),
                     "f": pa.array(f, pa.int64()), "terms": pa.array([len(column)] * len(a), pa.int64())})


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
               least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term`` for each group (see above)."""
    sums = term_sums(docs, lang_col, source_col, text_col).repartition("lang", "term")
    counts = sums.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    kept = (counts.withColumn("in_docs", F.sum("docs").over(of_term)).withColumn("in_lang", F.sum("n").over(of_term))
            .filter(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "in_lang"))
    kept = stored(kept, "kept-terms")
    terms = kept.select("lang", "term", "in_lang").distinct()
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("lang_n"))
    own_n = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    sources = named.groupBy("lang").agg(F.count("*").alias("sources"))
    zero = F.lit(0).cast("long")
    groups = (named.join(sources, "lang").join(langs, "lang", "left").join(own_n, ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("v", zero).alias("v"), F.coalesce("lang_n", zero).alias("lang_n"),
                      F.coalesce("group_n", zero).alias("group_n"), F.ceil(F.col("sources") / BLOCK_SOURCES).cast("int").alias("blocks"))
              .withColumn("buckets", F.ceil(F.col("v") / BUCKET_TERMS).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
              .withColumn("p0", F.when(F.col("v") > 0, _share(zero, F.col("group_n"), F.col("v")))))
    groups = stored(groups, "groups")
    shares = stored(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "block", "blocks", "buckets", _share(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_n"), F.col("v")).alias("q")), "shares")

    more = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _differ(F.col("p"), F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    best = more.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    own = shares.select("lang", "source", "term", "p", "block", "blocks", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"))
    heads = groups.filter("v > 0").select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "block", "blocks",
                                          F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"))
    cells = (own.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lang", "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "source", "block", "term", "p"))
    summed = (cells.groupBy("lang", "bucket", "lo", "hi").applyInArrow(_pair_sums, "lang string, a string, b string, f long, terms long")
              .groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("f").alias("f"), F.sum("terms").alias("terms")))
    one = groups.select("lang", "source", "v", "p0")
    both = one.join(one.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0")), "lang").filter("source <> item")
    both = both.withColumns({"a": F.least("source", "item"), "b": F.greatest("source", "item")}).join(summed, ["lang", "a", "b"], "left")
    rest = (F.col("v") - F.coalesce("terms", zero)) * _differ(F.col("p0"), F.col("q0"))  # terms that neither source has
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("f", zero) + F.coalesce(rest, zero)).alias("value"))
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(best).select("lang", "source", "part", "item", "value", "rank")
