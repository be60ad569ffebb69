"""Secret scan by a trigram inverted index, with DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived: for every alternative the trigrams
of the literal text that each of its matches must hold. The index has a posting (trigram, document) for each
trigram that some rule asks for. A document is a candidate of a rule if its postings hold all trigrams of one
alternative; candidates are verified with the rule's expression. A rule with an alternative that has no such
trigram cannot be narrowed down and scans every text. The index ignores case, so it never loses a match.

Matches are leftmost and do not overlap within a rule; those that fail the rule's length are dropped, without a
retry. Start and end count code points, the end is exclusive.

Defined cases: null text is empty, without matches; repeated rows each get a row; a null id is scanned by every
rule (a posting cannot name it); very long texts are read whole; an empty table gives no rows; further columns, whatever
their names, are not read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow.llm.common import stored


class Rule(NamedTuple):
    """``pattern`` is written so that Python and Java read it alike. A match counts if group ``group`` has at
    least ``least`` characters; ``guard``, if given, is a cheap expression that texts with a match fulfil."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    guard: str | None = None


#: The formats of the base kinds. A run of under 32 digits never counts, so the shortest hex match is 32.
BASE_RULES = [
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
]
#: Further kinds, whose formats their issuers publish.
MORE_RULES = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE_RULES + MORE_RULES


#: alternatives that an expression may unfold to before it counts as one without literal text
MOST_ALTERNATIVES = 256
#: members of a character class that become alternatives
MOST_MEMBERS = 8


def _literals(tree) -> list[list[str]]:
    """Alternatives of a parsed expression, each as the pieces of literal text that follow one another; a piece
    ends where something else can stand between."""
    out: list[list[str]] = [[""]]
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            more = [[chr(value).lower()]]
        elif name == "IN" and len(value) <= MOST_MEMBERS and all(str(o) == "LITERAL" for o, _ in value):
            more = [[chr(c).lower()] for _, c in value]
        elif name == "SUBPATTERN":
            more = _literals(value[-1])
        elif name == "BRANCH":
            more = [a for branch in value[1] for a in _literals(branch)]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] == 0 and value[1] == 1:
            more = [[""], *_literals(value[2])]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            more = [[*a, ""] for a in _literals(value[2])]
        elif name == "AT":
            continue
        else:
            more = [["", ""]]
        # the last piece so far and the first new one adjoin
        out = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for b in more]
        if len(out) > MOST_ALTERNATIVES:
            return [["", ""]]
    return out


def trigram_query(pattern: str) -> list[set[str]] | None:
    """For each alternative the trigrams that its matches hold; None if one of them has none."""
    alternatives = {frozenset(p[i:i + 3] for p in a for i in range(len(p) - 2)) for a in _literals(re._parser.parse(pattern))}
    return None if any(not a for a in alternatives) else sorted(map(set, alternatives), key=sorted)


def build_index(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """Postings (``trigram``, ``_id``) of the given trigrams in all texts, without regard to case."""
    low = F.lower(F.coalesce(text_col, F.lit("")))
    texts = docs.filter(F.col(id_col).isNotNull())
    # a variable of its own, so that the lower-case text is made once and not for every trigram
    held = F.get(F.transform(F.array(low), lambda x: F.array_compact(F.array(*[F.when(F.contains(x, F.lit(t)), F.lit(t)) for t in trigrams]))), F.lit(0))
    return texts.select(F.col(id_col).alias("_id"), held.alias("_held")).filter(F.size("_held") > 0).select("_id", F.explode("_held").alias("trigram")).distinct()


def candidates(index: DataFrame, queries: dict[str, list[set[str]]]) -> DataFrame:
    """``_id`` and the kinds (``_kinds``) of which one alternative's postings intersect in it."""
    terms = [(kind, i, t, len(a)) for kind, alternatives in queries.items() for i, a in enumerate(alternatives) for t in sorted(a)]
    asked = index.sparkSession.createDataFrame(terms, "kind string, alternative int, trigram string, terms int")
    met = index.join(F.broadcast(asked), "trigram")  # a row for each trigram of the rules
    return (met.groupBy("_id", "kind", "alternative").agg((F.count("*") == F.first("terms")).alias("all")).filter("all")
            .groupBy("_id").agg(F.collect_set("kind").alias("_kinds")))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans (``start``, ``kind``, ``end``) of a rule in a text that may hold a match: what lies between the
    matches and the matches themselves, summed up in turn."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    pieces = F.transform(whole, lambda m, i: F.struct(F.length(F.get(between, i)).alias("gap"), F.length(m).alias("size"),
                                                      (F.length(F.get(counted, i)) >= rule.least).alias("good")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>").alias("found"))
    rank = [r.kind for r in RULES].index(rule.kind) if rule in RULES else len(RULES)

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + p["gap"]
        end = start + p["size"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(p["good"], F.concat(s["found"], F.array(span))).otherwise(s["found"]).alias("found"))

    return F.aggregate(pieces, none, step, lambda s: s["found"])


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``spans`` (``start``, ``rank``, ``kind``, ``end``), ordered by
    start, then in the order of the rules."""
    rules = RULES if rules is None else rules
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    queries = {k: q for k, q in asked.items() if q is not None}
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    if queries:
        index = build_index(texts, sorted({t for q in queries.values() for a in q for t in a}), "_id", "_text")
        texts = texts.join(stored(candidates(index, queries), "candidates"), "_id", "left")
    else:
        texts = texts.withColumn("_kinds", F.array().cast("array<string>"))
    found = []
    for r in rules:
        spans = rule_spans(F.col("_text"), r)
        may = F.col("_text").rlike(r.guard or r.pattern)
        if r.kind in queries:
            may = (F.coalesce(F.array_contains("_kinds", r.kind), F.lit(False)) | F.col("_id").isNull()) & may
        found.append(F.when(may, spans).otherwise(F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")))
    return texts.select(F.col("_id").alias(id_col), F.array_sort(F.concat(*found)).alias("spans"))


def secrets_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``find_secrets`` with the number of base spans by kind, their hash, and all spans as text."""
    base = [r.kind for r in BASE_RULES]
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    numbers = [number(k) for k in base]
    return found.select(id_col, *numbers, F.sha2(shown(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
