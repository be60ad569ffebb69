"""Quality rules with risk-controlled thresholds, with DataFrame functions only.

Each rule is a measure of a text and a sequence of cutoffs, from the one that rejects least to the one that rejects
most. Cutoffs are not set by hand: on the labelled holdout of a stratum, a rule's cutoff is *safe* if the hypothesis that it
rejects more than a share ``risk`` of the good texts can be refused, by the exact binomial tail ``P(Bin(m, risk) <= k)`` for k rejected of m
good texts. Cutoffs are tested in their fixed order until one fails, which needs no correction; over strata and rules the error ``error`` is divided
equally (Bonferroni), and ``risk`` over the rules of a stratum. So with probability ``1 - error`` no
stratum loses more than ``risk`` of its good texts to all its rules together. Of the safe cutoffs the one that rejects the greatest surplus of bad
texts' share over good texts' share is taken, the most lenient of equals; a rule without such a cutoff, or a stratum with
too few labels for any bound, rejects nothing.

Copies prove nothing, so each distinct text of a stratum counts once in the holdout (as bad if any of its labels is).
Texts that the base rules reject are out of the holdout, as the learned rules never see them.

The measures are taken in one pass, without a shuffle of texts. Repeated 5-word windows are found in a text by sorting 64-bit numbers that
hold a hash's bits above the window's place; windows that share these bits are then compared by their words.

Defined cases: null text has no words, and its base rule rejects it; an empty or very long text is measured whole; repeated
rows each get a row; a null id has no label; several labels of an id make it bad if one of them is 0, null labels are none; a null stratum is a
stratum of its own; ties between cutoffs go to the more lenient; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow.llm.common import attach_groups, stored

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
RISK, ERROR = 0.05, 0.05


class QualityRule(NamedTuple):
    """A text is rejected if the column ``measure`` is above the cutoff."""

    measure: str
    cutoffs: tuple[float, ...]


RULES = [
    QualityRule("symbols_per_word", (2.0, 1.0, 0.5, 0.2, 0.1, 0.05)),
    QualityRule("upper_share", (0.9, 0.7, 0.5, 0.3, 0.2)),
    QualityRule("dup_line_share", (0.9, 0.7, 0.5, 0.4, 0.3)),
    QualityRule("mark_share", (2.0, 1.0, 0.5, 0.3, 0.2)),
]


def _bound(value: Column, use) -> Column:
    """``use`` of ``value``, which is evaluated once (a lambda would evaluate it for every element)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _window_keys(words: Column, bits: Column) -> Column:
    """For each window of a text the hash of its words above the ``bits`` that hold its place, ascending."""
    def key(i: Column) -> Column:
        return F.call_function("shiftleft", F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]), bits).bitwiseOR(i.cast("long"))

    return F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW, F.lit(0))), key))


def _repeated_words(words: Column, keys: Column, bits: Column) -> Column:
    """Words in windows that occur twice or more in the text."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def hash_of(j: Column) -> Column:
        return F.call_function("shiftright", F.get(keys, j), bits)

    def really(found: Column) -> Column:
        same = F.filter(found, lambda x, j: F.coalesce(x["w"] == F.get(found, j - 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(found, j + 1)["w"], F.lit(False)))
        return _bound(F.sort_array(F.transform(same, lambda x: x["at"])), covered)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda a, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - a, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    # windows whose neighbour shares the hash's bits are compared by their words
    met = F.filter(keys, lambda k, j: F.coalesce(hash_of(j) == hash_of(j - 1), F.lit(False)) | F.coalesce(hash_of(j) == hash_of(j + 1), F.lit(False)))
    places = F.transform(met, lambda k: k.bitwiseAND(mask).cast("int"))
    texts = F.transform(places, lambda i: F.struct(F.slice(words, i + 1, WINDOW).alias("w"), i.alias("at")))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(_bound(F.sort_array(texts), really))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_stratum``, a hash of the text, and its counts. Written once: a filter on a count
    would otherwise be pushed below the columns that it is made of, which lambdas would then make anew for every element."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    given = docs.select(F.col(id_col).alias("_id"), F.col(stratum_col).cast("string").alias("_stratum"), text.alias("_text"))
    split = F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def kept_of(pattern: str) -> Column:
        return F.length(F.regexp_replace("_text", pattern, "")).cast("long")

    # a column each, as later steps look at its elements many times; its bits hold every place of a window
    first = given.select("_id", "_stratum", "_text", split.alias("_words"), lines.alias("_lines"))
    first = first.withColumn("_bits", F.coalesce(F.ceil(F.log2(F.size("_words") + 1)), F.lit(0)).cast("int"))
    first = first.withColumn("_keys", _window_keys(F.col("_words"), F.col("_bits")))
    counts = first.select(
        "_id", "_stratum", F.sha2("_text", 256).alias("_sha"), F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), kept_of(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("_words"), F.col("_keys"), F.col("_bits")).alias("n_repeat_words"), F.size("_lines").cast("long").alias("n_lines"),
        kept_of(r"\P{Lu}+").alias("n_upper"), kept_of(r"[^!?]+").alias("n_marks"))
    return stored(counts, "measures")


def with_rules(measured: DataFrame) -> DataFrame:
    """The counts with ``base_failed`` and the measures of the rules."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return measured.withColumns({
        "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        "symbols_per_word": F.col("n_symbols") / words, "upper_share": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / lines, "mark_share": F.col("n_marks") / words})


def binomial_tail(k: Column, m: Column, risk: float) -> Column:
    """``P(Bin(m, risk) <= k)``: the terms are summed up from their logarithms, each made from the one before it."""
    odds = math.log(risk) - math.log1p(-risk)
    first = F.struct((m * math.log1p(-risk)).alias("log"), F.exp(m * math.log1p(-risk)).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        log = s["log"] + F.log(m - i + 1) - F.log(i) + F.lit(odds)
        return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))

    return F.when(k >= m, F.lit(1.0)).when(k <= 0, F.exp(m * math.log1p(-risk))).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))), first, step, lambda s: s["sum"]))


def safe_cutoffs(rated: DataFrame, labels: DataFrame, rules: list[QualityRule] | None = None, id_col: str = "doc_id", label_col: str = "quality",
                 risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(``_stratum``, ``measure``, ``cutoff``, ``good``, ``good_lost``, ``bad``, ``bad_lost``, ``tail``): the cutoff of each rule that has one.

    ``rated``: rows of :func:`with_rules`; ``labels``: (id, label), 1 for good."""
    rules = RULES if rules is None else rules
    label = F.col(label_col).cast("int")
    known = labels.select(F.col(id_col).alias("_id"), label.alias("_good")).filter("_id is not null and _good is not null").groupBy("_id").agg((F.min("_good") > 0).alias("_good"))
    held = (rated.filter("not base_failed and _id is not null").join(known, "_id")
            .groupBy("_stratum", "_sha").agg(F.min("_good").alias("_good"), *[F.first(r.measure).alias(r.measure) for r in rules]))
    lost = [(r, i, c) for r in rules for i, c in enumerate(r.cutoffs)]
    sums = held.groupBy("_stratum").agg(
        F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad"),
        *[F.count_if(F.col("_good") & (F.col(r.measure) > c)).alias(f"_g{j}") for j, (r, _, c) in enumerate(lost)],
        *[F.count_if(~F.col("_good") & (F.col(r.measure) > c)).alias(f"_b{j}") for j, (r, _, c) in enumerate(lost)])
    sums = stored(sums, "holdout")  # a row per stratum
    strata = max(sums.count(), 1)
    tests = F.inline(F.array(*[F.struct(F.lit(r.measure).alias("measure"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"),
                                        F.col(f"_g{j}").alias("good_lost"), F.col(f"_b{j}").alias("bad_lost")) for j, (r, i, c) in enumerate(lost)]))
    tested = sums.select("_stratum", "good", "bad", tests).withColumn("tail", binomial_tail(F.col("good_lost"), F.col("good"), risk / len(rules)))
    failed = (F.col("tail") > error / (strata * len(rules))).cast("int")
    so_far = Window.partitionBy("_stratum", "measure").orderBy("step")
    safe = tested.withColumn("_failed", F.max(failed).over(so_far)).filter("_failed = 0")
    surplus = F.col("bad_lost") / F.greatest("bad", F.lit(1)) - F.col("good_lost") / F.greatest("good", F.lit(1))
    best = Window.partitionBy("_stratum", "measure").orderBy(F.col("_surplus").desc(), "step")
    return (safe.withColumn("_surplus", surplus).filter("_surplus > 0").withColumn("_n", F.row_number().over(best)).filter("_n = 1")
            .select("_stratum", "measure", "cutoff", "good", "good_lost", "bad", "bad_lost", "tail"))


def quality(docs: DataFrame, labels: DataFrame, rules: list[QualityRule] | None = None, id_col: str = "doc_id", text_col: str = "text",
            stratum_col: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """One row per row of ``docs``: the id, its counts, ``base_failed``, ``kept`` and ``failed_rules`` (measures above their cutoff)."""
    rules = RULES if rules is None else rules
    rated = with_rules(measures(docs, id_col, text_col, stratum_col))
    cutoffs = stored(safe_cutoffs(rated, labels, rules, id_col, risk=risk, error=error), "cutoffs")
    # one row per stratum, with a null cutoff for rules that have none; a null stratum joins by the flag beside its name
    key = {"_s": F.coalesce("_stratum", F.lit("")), "_none": F.col("_stratum").isNull()}
    rated = rated.withColumns(key)
    strata = rated.groupBy("_s", "_none").agg(F.count("*").alias("_rows"))
    wide = cutoffs.withColumns(key).groupBy("_s", "_none").agg(*[F.max(F.when(F.col("measure") == r.measure, F.col("cutoff"))).alias(f"_c_{r.measure}") for r in rules])
    groups = stored(strata.join(wide, ["_s", "_none"], "left"), "strata")
    total = groups.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    joined = attach_groups(rated, groups, ["_s", "_none"], "_rows", total)
    failed = F.array_compact(F.array(*[F.when(F.col(r.measure) > F.col(f"_c_{r.measure}"), F.lit(r.measure)) for r in rules]))
    return joined.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), F.array_join(failed, ",").alias("failed_rules"))
