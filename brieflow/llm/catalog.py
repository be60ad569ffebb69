"""Queries of the corpus operators and their DuckDB SQL (None where SQL cannot express the operator)."""

from __future__ import annotations

from brieflow.llm.bpe_lexicon import round_trip
from brieflow.llm.chat_windows import chat_digest, chat_windows
from brieflow.llm.collocations import collocations
from brieflow.llm.common import table
from brieflow.llm.decontaminate import contamination, contamination_digest
from brieflow.llm.divergence import divergence
from brieflow.llm.exact_dedup import exact_groups
from brieflow.llm.pii import personal_data, personal_data_digest
from brieflow.llm.quality_rules import ERROR, RISK, quality
from brieflow.llm.quality_rules import RULES as QUALITY_RULES
from brieflow.llm.secret_scan import BASE_RULES, find_secrets, secrets_digest
from brieflow.llm.secret_scan import RULES as SECRET_RULES
from brieflow.llm.secret_scan import Rule as SecretRule
from brieflow.llm.simhash_bk import near_groups
from brieflow.llm.token_counts import Pieces, token_counts
from brieflow.llm.toxicity import toxicity
from brieflow.llm.url_filter import Rule, judge_urls


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; only the driver reads it."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_pii(spark, sf_dir):
    return personal_data_digest(personal_data(_documents(spark, sf_dir)))


def op2_decontaminate(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return contamination_digest(contamination(_documents(spark, sf_dir), items))


def op3_secrets(spark, sf_dir):
    return secrets_digest(find_secrets(_documents(spark, sf_dir)))


def op4_toxicity(spark, sf_dir):
    return toxicity(_documents(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id", "toxic"))


#: a turn that holds the template's own control strings, and its answer
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op5_chat(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return chat_digest(chat_windows(given.unionByName(extra)))


def op6_simhash(spark, sf_dir):
    return near_groups(_documents(spark, sf_dir))


def op7_token_counts(spark, sf_dir):
    return token_counts(_documents(spark, sf_dir), Pieces.from_file(vocabulary("piece_bpe_32k.model")))


def op8_exact_dedup(spark, sf_dir):
    return exact_groups(_documents(spark, sf_dir))


def op9_bpe(spark, sf_dir):
    return round_trip(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


URL_RULES = [Rule("org", "/", True), Rule("example.org", "/es/", False), Rule("example.org", "/en/1", False), Rule("com", "/fr/", True), Rule("com", "/de/", False)]


def op10_urls(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_divergence(spark, sf_dir):
    return divergence(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{ASCII}', '{ASCII.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP2_SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
i AS (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark),
t AS MATERIALIZED (
  SELECT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM i WHERE len(w) > 0)),
o AS (
  SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM t) WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT r, o.n, k, item_id FROM o JOIN t ON o.n = t.n AND o.win = t.win),
c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS q FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""


def _spans_sql(rule: SecretRule, rank: int) -> str:
    """List of a rule's spans: the text between the matches and the matches summed up in turn."""
    re = "'" + rule.pattern.replace("'", "''") + "'"
    m, g, p = f"regexp_extract_all(t, {re})", f"regexp_extract_all(t, {re}, {rule.group})", f"string_split_regex(t, {re})"
    before = "coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    return f"""(SELECT list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'start': CAST({before} AS BIGINT), 'rank': {rank},
      'kind': '{rule.kind}', 'size': length(m[i]), 'own': length(g[i])}}), lambda s: s.own >= {rule.least})
    FROM (SELECT {m} AS m, {g} AS g, {p} AS p))"""


OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS MATERIALIZED (SELECT doc_id, list_sort(flatten([{", ".join(_spans_sql(r, k) for k, r in enumerate(SECRET_RULES))}])) AS f FROM d),
b AS (SELECT doc_id, f, list_filter(f, lambda s: s.rank < {len(BASE_RULES)}) AS b FROM f)
SELECT doc_id, {", ".join(f"CAST(len(list_filter(b, lambda s: s.rank = {k})) AS BIGINT) AS n_{r.kind}" for k, r in enumerate(BASE_RULES))},
  sha256(array_to_string(list_transform(b, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size)), ',')) AS base_sha256,
  array_to_string(list_transform(f, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size)), ',') AS spans
FROM b
"""

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, row_number() OVER w AS rn, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
"""

OP11_SQL = rf"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{ASCII}', '{ASCII.lower()}'), '[.,;:!?\x0A-\x0D]')) AS s
  FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM s),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, size, array_to_string(w[k:k + size - 1], ' ') AS phrase
      FROM (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS k FROM w, range(1, 6) t(size) WHERE len(w) >= size)),
f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
i AS (SELECT lang, size, f, string_split(phrase, ' ') AS p FROM f WHERE size > 2),
x AS (SELECT lang, array_to_string(p[b:e], ' ') AS phrase, max(f) AS most
      FROM (SELECT lang, size, f, p, b, unnest(range(b + 1, size + 1)) AS e FROM (SELECT *, unnest(range(1, size)) AS b FROM i)) WHERE e - b + 1 < size GROUP BY ALL),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS p FROM f LEFT JOIN x USING (lang, phrase) WHERE size > 1 AND (most IS NULL OR 100 * most < 100 * f)),
k AS (SELECT lang, phrase, a, k, array_to_string(p[1:k], ' ') AS lp, array_to_string(p[k + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
z AS (SELECT k.lang, k.phrase, a, l.f AS l, r.f AS r, n, 1000 * CAST(a AS HUGEINT) * n // (CAST(l.f AS HUGEINT) * r.f) AS score, k
      FROM k JOIN f l ON l.lang = k.lang AND l.phrase = lp JOIN f r ON r.lang = k.lang AND r.phrase = rp JOIN n ON n.lang = k.lang),
b AS (SELECT * FROM z QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM b QUALIFY rank <= 2000
"""

OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{ASCII}', '{ASCII.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term FROM (SELECT lang, term, count(DISTINCT r) AS held FROM o GROUP BY ALL) WHERE held >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
p AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + (1000000000 * (CAST(n AS HUGEINT) + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term)
  JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000 * (CAST(n AS HUGEINT) + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY ALL) JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM f QUALIFY part = 'pair' OR rank <= 10
"""

_MEASURES = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)", "upper_share": "n_upper / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)", "mark_share": "n_marks / greatest(n_words, 1)"}
_TAIL = (f"list_sum(list_transform(range(0, good_lost + 1), lambda i: exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) "
         f"+ i * ln({RISK / len(QUALITY_RULES)!r}) + (good - i) * ln(1 - {RISK / len(QUALITY_RULES)!r}))))")
OP13_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
d AS MATERIALIZED (
  SELECT r, doc_id, lang, sha256(t) AS sha, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, t FROM t),
o AS (SELECT r, k, array_to_string(w[k:k + 4], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)),
h AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, win) AS n FROM o) WHERE n > 1),
c AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(k, k + 5)) AS q FROM h) GROUP BY r),
m AS (SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper,
        length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_marks FROM d LEFT JOIN c USING (r)),
b AS MATERIALIZED (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
x AS MATERIALIZED (SELECT r, doc_id, lang, sha, base_failed, unnest([{", ".join(f"{{'measure': '{k}', 'value': CAST({e} AS DOUBLE)}}" for k, e in _MEASURES.items())}], recursive := true) FROM b),
y AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
z AS (SELECT lang, sha, measure, min(good) AS good, min(value) AS value FROM x JOIN y USING (doc_id) WHERE NOT base_failed GROUP BY lang, sha, measure),
u AS (SELECT * FROM (VALUES {", ".join(f"('{q.measure}', {i}, {float(c)!r})" for q in QUALITY_RULES for i, c in enumerate(q.cutoffs))}) u(measure, step, cutoff)),
n AS (SELECT lang, measure, step, cutoff, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad,
        count(*) FILTER (good AND value > cutoff) AS good_lost, count(*) FILTER (NOT good AND value > cutoff) AS bad_lost
      FROM z JOIN u USING (measure) GROUP BY ALL),
e AS (SELECT *, {_TAIL} > {ERROR!r} / ((SELECT greatest(count(DISTINCT coalesce('_' || lang, '')), 1) FROM n) * {len(QUALITY_RULES)}) AS failed FROM n),
s AS (SELECT *, bad_lost / greatest(bad, 1) - good_lost / greatest(good, 1) AS surplus
      FROM (SELECT *, bool_or(failed) OVER (PARTITION BY lang, measure ORDER BY step) AS out FROM e) WHERE NOT out),
a AS (SELECT lang, measure, cutoff FROM s WHERE surplus > 0 QUALIFY row_number() OVER (PARTITION BY lang, measure ORDER BY surplus DESC, step) = 1),
j AS (SELECT r, string_agg(x.measure, ',' ORDER BY list_position([{", ".join(f"'{q.measure}'" for q in QUALITY_RULES)}], x.measure)) AS failed_rules
      FROM x JOIN a ON a.lang IS NOT DISTINCT FROM x.lang AND a.measure = x.measure AND x.value > a.cutoff GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND j.r IS NULL AS kept,
       coalesce(failed_rules, '') AS failed_rules
FROM b LEFT JOIN j USING (r)
"""

QUERIES = {
    "op1_pii": (op1_pii, None),
    "op2_decontaminate": (op2_decontaminate, OP2_SQL),
    "op3_secrets": (op3_secrets, OP3_SQL),
    "op4_toxicity": (op4_toxicity, None),
    "op5_chat": (op5_chat, None),
    "op6_simhash": (op6_simhash, None),
    "op7_token_counts": (op7_token_counts, None),
    "op8_exact_dedup": (op8_exact_dedup, OP8_SQL),
    "op9_bpe": (op9_bpe, None),
    "op10_urls": (op10_urls, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_divergence": (op12_divergence, OP12_SQL),
    "op13_quality": (op13_quality, OP13_SQL),
}
