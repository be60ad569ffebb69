"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently in SQL over the driver's views and
re-derives the same articles adapter. Sequential first-fit dedup is a
recursive CTE (arrival order, leader list carried along) — the brute-force
reference for the round-based Spark election. Lexicons are generated from the
same parameter lists the library uses.
"""

from __future__ import annotations

from brieflow import params as P
from brieflow.operators.enrich import sql_lit

DOMAINS_SQL = "[" + ", ".join(sql_lit(d) for d in P.DOMAINS) + "]"
TOKEN_RE = P.SIMHASH_TOKEN_PATTERN


def dlit(value: str) -> str:
    """DuckDB string literal (quotes doubled, backslashes literal)."""
    return "'" + value.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def reg_cte() -> str:
    return f"""reg AS (
  SELECT source AS source_id, 'Source ' || CAST(n AS VARCHAR) AS source_name,
         CASE WHEN n % 4 = 0 THEN 'all' ELSE {DOMAINS_SQL}[n % 13 + 1] END AS domain,
         ['center', 'center-left', 'center-right', 'left', 'right'][n % 5 + 1] AS bias_rating,
         ['high', 'mixed', 'low'][n % 3 + 1] AS factual_rating,
         round((n + 1) * {dbl(0.05)}, 2) AS credibility_score
  FROM (SELECT DISTINCT source, coalesce(try_cast(regexp_extract(source, '(\\d+)$', 1) AS INTEGER), 0) AS n
        FROM documents WHERE source IS NOT NULL))"""


def articles_cte() -> str:
    url = "'https://' || d.source || '.example.com/' || CAST(d.doc_id AS VARCHAR)"
    return f"""{reg_cte()},
articles AS (
  SELECT d.doc_id AS arr, sha256(lower({url})) AS id, {url} AS url,
         substring(split_part(coalesce(d.text, ''), chr(10), 1), 1, 80) AS title,
         coalesce(d.text, '') AS body, '' AS summary, CAST(e.ts AS TIMESTAMP) AS published_at,
         r.source_id, r.source_name, r.domain, r.bias_rating, r.factual_rating, r.credibility_score,
         coalesce(d.lang, 'en') AS language
  FROM documents d JOIN events e ON e.event_id = d.doc_id JOIN reg r ON r.source_id = d.source)"""


def fresh_cte(src: str = "articles", name: str = "fresh", hours: int = P.MAX_AGE_HOURS,
              min_chars: int = P.MIN_ARTICLE_CHARS) -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  WHERE published_at >= (SELECT max(published_at) FROM {src}) - INTERVAL {int(hours)} HOUR
    AND length(coalesce(nullif(body, ''), summary, '')) >= {int(min_chars)})"""


def l1_cte(src: str, name: str = "l1") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT arr, id, url_hash, arr = min(arr) OVER (PARTITION BY url_hash) AS l1_keep
  FROM (SELECT arr, id, sha256(lower(regexp_replace(coalesce(url, ''), '^\\s+|\\s+$', '', 'g'))) AS url_hash
        FROM {src}))"""


def simhash_ctes(src: str, name: str = "fp") -> str:
    """(arr, simhash) of title + ' ' + (body or summary)[:500]."""
    sums = ", ".join(f"sum((h >> {j}) & 1) AS p{j}" for j in range(64))
    bits = " | ".join(f"CASE WHEN 2 * p{j} > n THEN (CAST(1 AS UBIGINT) << {j}) ELSE CAST(0 AS UBIGINT) END"
                      for j in range(64))
    return f"""{name}_s AS (
  SELECT arr, array_to_string(regexp_extract_all(lower(coalesce(title, '') || ' ' ||
         substring(coalesce(nullif(body, ''), summary, ''), 1, 500)), '{TOKEN_RE}'), '') AS s
  FROM {src}),
{name}_g AS (SELECT arr, substring(s, i, 4) AS g
  FROM (SELECT arr, s, unnest(range(1, greatest(length(s) - 3, 1) + 1)) AS i FROM {name}_s)),
{name}_h AS (SELECT arr, CAST('0x' || substring(md5(g), 17, 16) AS UBIGINT) AS h FROM {name}_g),
{name}_p AS (SELECT arr, count(*) AS n, {sums} FROM {name}_h GROUP BY arr),
{name}_u AS (SELECT arr, ({bits}) AS u FROM {name}_p),
{name} AS MATERIALIZED (SELECT arr, CAST(CASE WHEN u >= (CAST(1 AS UBIGINT) << 63)
                                THEN CAST(u AS HUGEINT) - CAST(18446744073709551616 AS HUGEINT)
                                ELSE CAST(u AS HUGEINT) END AS BIGINT) AS simhash FROM {name}_u)"""


def first_fit_ctes(name: str, nodes: str, key_type: str, near: str) -> str:
    """Sequential first-fit over ``nodes`` (arr, k): (arr, leader). ``near`` uses ``l.k`` and ``n.k``."""
    return f"""{name}_n AS (SELECT row_number() OVER (ORDER BY arr) AS rn, arr, k FROM {nodes}),
{name}_r AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(arr BIGINT, k {key_type})[]) AS leaders,
         CAST(NULL AS BIGINT) AS arr, CAST(NULL AS BIGINT) AS leader
  UNION ALL
  SELECT n.rn,
         CASE WHEN len(list_filter(f.leaders, lambda l: {near})) = 0
              THEN list_append(f.leaders, {{'arr': n.arr, 'k': n.k}}) ELSE f.leaders END,
         n.arr,
         coalesce(list_filter(f.leaders, lambda l: {near})[1].arr, n.arr)
  FROM {name}_r f JOIN {name}_n n ON n.rn = f.rn + 1),
{name} AS MATERIALIZED (SELECT arr, leader FROM {name}_r WHERE rn > 0)"""


HAMMING_NEAR = f"bit_count(xor(l.k, n.k)) <= {P.SIMHASH_MAX_DISTANCE}"


def cosine_near(threshold: float) -> str:
    return f"list_dot_product(CAST(l.k AS DOUBLE[]), CAST(n.k AS DOUBLE[])) >= {dbl(threshold)}"


def within(near: str, hours: int) -> str:
    """``near`` on the part ``x`` of the keys, and their times ``t`` (microseconds) within ``hours``."""
    near = near.replace("l.k", "l.k.x").replace("n.k", "n.k.x")
    return f"{near} AND abs(l.k.t - n.k.t) <= {int(hours) * 3600 * 1_000_000}"


def cascade_ctes(src: str, threshold: float = P.SEMANTIC_COSINE_THRESHOLD, transitive: bool = False,
                 scope: str = "true", vec_on: str = "e.vec_id = l.arr", use_l2: bool = True,
                 window_hours: int | None = None) -> str:
    """L1 -> L2 -> L3 -> story map -> counts over ``src`` (articles).

    ``scope``: predicate on ``arr`` selecting the batch whose story map, counts and
    survivors are reported (sequential first-fit still runs over all of ``src``). ``vec_on``
    joins embeddings ``e`` to articles ``l``. ``window_hours``: near articles must be published within it."""
    ff2 = (first_fit_ctes("ff2", "fpn", "BIGINT", HAMMING_NEAR) if use_l2
           else "ff2 AS (SELECT arr, arr AS leader FROM s1)")
    ff3 = first_fit_ctes("ff3", "vec", "FLOAT[]", cosine_near(threshold))
    fpn, vec_k, times = "fpn AS (SELECT arr, simhash AS k FROM fp)", "e.embedding", ""
    if window_hours is not None:
        fpn = f"fpn AS (SELECT arr, {{'x': simhash, 't': epoch_us(published_at)}} AS k FROM fp JOIN s1 USING (arr))"
        vec_k, times = "{'x': e.embedding, 't': epoch_us(a.published_at)}", f"JOIN {src} a ON a.arr = l.arr"
        ff2 = first_fit_ctes("ff2", "fpn", "STRUCT(x BIGINT, t BIGINT)", within(HAMMING_NEAR, window_hours))
        ff3 = first_fit_ctes("ff3", "vec", "STRUCT(x FLOAT[], t BIGINT)", within(cosine_near(threshold), window_hours))
    later = "coalesce(i3.id, i3b.id, i2.id)" if transitive else "coalesce(i3.id, i2.id)"
    tjoin = ("LEFT JOIN ff3 m3b ON m3b.arr = m2.leader AND m3b.leader <> m3b.arr "
             "LEFT JOIN ids i3b ON i3b.arr = m3b.leader") if transitive else ""
    return f"""{l1_cte(src)},
ids AS (SELECT arr, id FROM l1),
s1 AS (SELECT s.* FROM {src} s JOIN l1 USING (arr) WHERE l1.l1_keep),
{simhash_ctes("s1", "fp")},
{fpn},
{ff2},
l2lead AS (SELECT arr FROM ff2 WHERE leader = arr),
vec AS (SELECT l.arr, {vec_k} AS k FROM l2lead l JOIN embeddings e ON {vec_on} {times}
        WHERE e.embedding IS NOT NULL),
{ff3},
l1v AS (SELECT id, max_by(CASE WHEN l1_keep THEN id ELSE url_hash END, arr) AS s1v FROM l1
        WHERE {scope} GROUP BY id),
per_art AS (
  SELECT a.id, {later} AS later
  FROM (SELECT * FROM ids WHERE {scope}) a
  LEFT JOIN ff2 m2 ON m2.arr = a.arr AND m2.leader <> m2.arr
  LEFT JOIN ids i2 ON i2.arr = m2.leader
  LEFT JOIN ff3 m3 ON m3.arr = a.arr AND m3.leader <> m3.arr
  LEFT JOIN ids i3 ON i3.arr = m3.leader
  {tjoin}),
smap AS MATERIALIZED (SELECT v.id, coalesce(p.later, v.s1v) AS story_id
         FROM l1v v LEFT JOIN (SELECT id, max(later) AS later FROM per_art GROUP BY id) p USING (id)),
counts AS (SELECT story_id, count(*) AS corroboration_count FROM smap GROUP BY story_id),
surv_arr AS (SELECT arr FROM (SELECT arr FROM ff3 WHERE leader = arr
             UNION SELECT arr FROM l2lead WHERE arr NOT IN (SELECT arr FROM vec)) WHERE {scope}),
surv AS (
  SELECT s.*, coalesce(m.story_id, s.id) AS story_id,
         CAST(coalesce(c.corroboration_count, 1) AS BIGINT) AS corroboration_count
  FROM {src} s JOIN surv_arr USING (arr)
  LEFT JOIN smap m ON m.id = s.id
  LEFT JOIN counts c ON c.story_id = coalesce(m.story_id, s.id))"""


def _contains_sum(words) -> str:
    return "(" + " + ".join(f"CASE WHEN contains(tl, {sql_lit(w.lower())}) THEN 1 ELSE 0 END" for w in words) + ")"


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(tl, {sql_lit(w)})" for w in words) + ")"


def title_case_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')")


def entities_list_sql(gazetteer, max_chars: int = 1000) -> str:
    """list of struct(pos, text, label) sorted by position."""
    if not gazetteer:
        return "CAST([] AS STRUCT(pos BIGINT, text VARCHAR, label VARCHAR)[])"
    head = f"substring(coalesce(title, '') || ' ' || coalesce(nullif(body, ''), summary, ''), 1, {max_chars})"
    items = []
    for s_, lab in gazetteer:
        if lab not in P.ENTITY_LABELS:
            continue
        # a surface never overlaps itself here, so every place where it stands is a mention
        at = f"list_filter(range(1, length({head}) + 1), lambda i: substring(lower({head}), i, {len(s_)}) = {sql_lit(s_.lower())})"
        items.append(f"list_transform({at}, lambda i: {{'pos': CAST(i AS BIGINT), 'text': substring({head}, i, {len(s_)}), "
                     f"'label': {sql_lit(lab)}}})")
    return f"list_sort(flatten([{', '.join(items)}]))"


def enrich_ctes(src: str, name: str = "enr", topics=P.TOPICS, gazetteer=(), countries=P.COUNTRY_KEYWORDS) -> str:
    counts = ", ".join(f"{_contains_sum(kws)} AS ds_{i}" for i, (_, kws, _) in enumerate(topics))
    n = len(topics)
    mx = "greatest(" + ", ".join(f"ds_{i}" for i in range(n)) + ")"
    argmax = "CASE " + " ".join(f"WHEN ds_{i} = mx THEN {sql_lit(d)}" for i, (d, _, _) in enumerate(topics)) + " END"
    scores_s = "concat_ws(',', " + ", ".join(
        f"CASE WHEN ds_{i} > 0 THEN {sql_lit(d + ':')} || CAST(ds_{i} AS VARCHAR) END"
        for i, (d, _, _) in enumerate(topics)) + ")"
    themes = "CASE " + " ".join(
        f"WHEN primary_domain = {sql_lit(d)} THEN list_filter([{', '.join(sql_lit(t) for t in th)}], "
        f"lambda t: contains(tl, replace(lower(t), '_', ' ')))"
        for d, _, th in topics if th) + " ELSE CAST([] AS VARCHAR[]) END"
    tags = "CASE " + " ".join(
        f"WHEN primary_domain = {sql_lit(d)} THEN [{', '.join(sql_lit(t) for t in tg)}]"
        for d, tg in P.DOMAIN_TAGS.items()) + " ELSE CAST([] AS VARCHAR[]) END"
    actor = (f"CASE WHEN {_any(P.MAJOR_ACTORS)} THEN {dbl(0.9)} WHEN {_any(P.REGIONAL_ACTORS)} THEN {dbl(0.7)} "
             f"ELSE {dbl(0.5)} END")
    head = "lower(coalesce(title, '') || ' ' || substring(coalesce(body, ''), 1, 200))"
    fallback = "CASE " + " ".join(f"WHEN contains({head}, {sql_lit(k)}) THEN {sql_lit(c)}" for k, c in countries) \
        + f" ELSE {sql_lit(P.OTHER_COUNTRY)} END"
    ents = entities_list_sql(gazetteer)
    gpe = "list_filter(ents, lambda e: e.label = 'GPE')[1].text"
    return f"""{name}_t AS (SELECT *, lower(coalesce(title, '') || ' ' || coalesce(nullif(body, ''), summary, '')) AS tl
  FROM {src}),
{name}_c AS (SELECT *, {counts} FROM {name}_t),
{name}_m AS (SELECT *, {mx} AS mx, {ents} AS ents FROM {name}_c),
{name}_d AS (SELECT *,
  CASE WHEN coalesce(domain, 'all') <> '' AND coalesce(domain, 'all') <> 'all' THEN domain
       WHEN mx > 0 THEN {argmax} ELSE {sql_lit(P.DEFAULT_DOMAIN)} END AS primary_domain,
  {scores_s} AS domain_scores_s, {actor} AS actor_significance FROM {name}_m),
{name} AS (SELECT *, {themes} AS gdelt_themes, {tags} AS pmesii_tags,
  coalesce({title_case_sql(gpe)}, {fallback}) AS primary_country,
  array_to_string(list_transform(ents, lambda e: e.text || ':' || e.label), '|') AS entities_s
  FROM {name}_d)"""


def score_ctes(src: str, name: str = "sc", rules: P.Rules = P.DEFAULT_RULES, with_corr: bool = True) -> str:
    w = rules.importance_weights
    clamp = lambda x: f"greatest({dbl(0)}, least({dbl(1)}, {x}))"
    corr = "CAST(coalesce(corroboration_count, 1) AS DOUBLE)" if with_corr else dbl(1)
    cred = f"coalesce(CAST(credibility_score AS DOUBLE), {dbl(P.DEFAULT_CREDIBILITY)})"
    actor = f"coalesce(CAST(actor_significance AS DOUBLE), {dbl(P.DEFAULT_ACTOR)})"
    imp = (f"{dbl(w['credibility'])} * {clamp(cred)} + {dbl(w['corroboration'])} * "
           f"{clamp(f'least({corr} / {dbl(5.0)}, {dbl(1.0)})')} + {dbl(w['actor_significance'])} * {clamp(actor)}"
           f" + {dbl(w['novelty'])} * {clamp(dbl(P.DEFAULT_NOVELTY))}")
    all_sum = 0.0
    for v in rules.risk_weights.values():
        all_sum += v
    tagw = "CASE t " + " ".join(f"WHEN {sql_lit(tag)} THEN {dbl(rules.risk_weights[key])}"
                                for tag, key in P.TAG_TO_RISK_KEY.items() if key in rules.risk_weights) \
        + f" ELSE {dbl(0)} END"
    total = f"list_reduce(list_prepend({dbl(0)}, list_transform(pmesii_tags, lambda t: {tagw})), lambda a, b: a + b)"
    pen = 1 - rules.single_source_penalty
    return f"""{name}_i AS (SELECT *, {imp} AS imp_raw, {total} AS risk_total, {corr} AS corr_d FROM {src}),
{name} AS (SELECT *, round({clamp('imp_raw')}, 4) AS importance_score,
  round({clamp(f"CASE WHEN risk_total = 0 THEN {dbl(P.DEFAULT_RISK)} ELSE {clamp(f'risk_total / {dbl(all_sum)}')} END")}, 4)
    AS risk_score,
  round({clamp(f"CASE WHEN corr_d = {dbl(1)} THEN imp_raw * {dbl(pen)} ELSE imp_raw END")}, 4) AS bias_adjusted_score
  FROM {name}_i)"""


def select_ctes(src: str, rules: P.Rules = P.DEFAULT_RULES, with_corr: bool = True) -> str:
    corr = "coalesce(corroboration_count, 1)" if with_corr else "1"
    fringe = (f""",
fringe AS (SELECT * FROM cands WHERE {corr} = 1 AND id NOT IN (SELECT id FROM capped)
           ORDER BY coalesce(bias_adjusted_score, 0) DESC, arr LIMIT 1)""" if rules.include_fringe else "")
    fringe_union = ("UNION ALL SELECT *, true AS is_fringe, CAST(NULL AS BIGINT) AS dfa FROM fringe"
                    if rules.include_fringe else "")
    return f"""cands AS (SELECT * FROM {src} WHERE coalesce(bias_adjusted_score, 0) >= {dbl(rules.min_score)}),
dom_first AS (SELECT coalesce(primary_domain, 'politics') AS pdom, min(arr) AS domain_first_arr FROM cands GROUP BY 1),
top_n AS (SELECT * EXCLUDE (rn) FROM (SELECT c.*, row_number() OVER (PARTITION BY coalesce(primary_domain, 'politics')
            ORDER BY coalesce(bias_adjusted_score, 0) DESC, arr) AS rn FROM cands c) WHERE rn <= {rules.top_n_per_domain}),
capped AS (SELECT * EXCLUDE (crn, pdom) FROM (
  SELECT t.*, d.pdom, d.domain_first_arr, row_number() OVER (PARTITION BY coalesce(primary_country, 'Other')
    ORDER BY coalesce(bias_adjusted_score, 0) DESC, d.domain_first_arr, arr) AS crn
  FROM top_n t JOIN dom_first d ON d.pdom = coalesce(t.primary_domain, 'politics'))
  WHERE coalesce(primary_country, 'Other') = 'Other' OR crn <= {rules.max_per_country}){fringe},
final_u AS (SELECT * EXCLUDE (domain_first_arr), false AS is_fringe, domain_first_arr AS dfa FROM capped
            {fringe_union}),
ranked AS (SELECT *, row_number() OVER (ORDER BY coalesce(bias_adjusted_score, 0) DESC, is_fringe,
             dfa NULLS LAST, arr) AS rank FROM final_u)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
