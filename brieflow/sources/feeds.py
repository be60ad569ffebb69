"""Scans and sinks: registry and lexicon files, stored feeds, page text, run outputs.

A01, A02, A04, A06, B01.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brieflow import params as P
from brieflow.functions.text import article_id, entry_url, py_strip
from brieflow.functions.time import parse_published
from brieflow.operators import ingest

# ---------------------------------------------------------------------------
# Configuration files
# ---------------------------------------------------------------------------


def scan_sources(spark: SparkSession, path: str) -> DataFrame:
    """``{"sources": [...]}`` -> one row per source with ``active`` true or missing. A path that ends in ``.json`` is a file of
    one object; any other is a folder of files with such an object on each line, which are read in parallel."""
    raw = spark.read.option("multiLine", path.endswith(".json")).json(path)
    src = raw.select(F.explode("sources").alias("s")).select("s.*")
    if "active" in src.columns:
        src = src.filter(F.coalesce(F.col("active"), F.lit(True)))
    return src


#: a lexicon file is parsed on the driver; a larger one is refused
MAX_LEXICON_BYTES = 16 << 20


def scan_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``{"domains": {name: {"keywords": [...], "gdelt_themes": [...]}}}`` ->
    (domain, domain_ord, kind, item_ord, item), file order kept (it breaks ties)."""
    import json

    # a config file of a few KB: read as one text value, parse with the JSON reader on the driver
    texts = spark.read.text(path, wholetext=True)
    size = texts.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    if size > MAX_LEXICON_BYTES:
        raise ValueError(f"{path} holds {size} bytes; a lexicon file has at most {MAX_LEXICON_BYTES}")
    text = "\n".join(r.value for r in texts.collect())
    lines = [ln for ln in text.splitlines() if not ln.lstrip().startswith("//")]
    doms = json.loads("\n".join(lines)).get("domains", {})
    rows = []
    for di, (d, cfg) in enumerate(doms.items()):
        for kind in ("keywords", "gdelt_themes"):
            for ii, it in enumerate(cfg.get(kind, [])):
                rows.append((d, di, kind, ii, it))
    return spark.createDataFrame(rows, "domain string, domain_ord int, kind string, item_ord int, item string")


# ---------------------------------------------------------------------------
# Stored feed documents -> entries
# ---------------------------------------------------------------------------

ENTRY_SCHEMA = ("title string, link array<struct<_VALUE: string, _href: string, _rel: string>>, guid string, id string, "
                "pubDate string, published string, updated string, date string, description string, summary string, "
                "encoded string, content string")


def feed_entries(feeds: DataFrame, xml_col: str = "xml", feed_col: str = "source_id") -> DataFrame:
    """Feed documents (one XML document per row) -> entry rows in document order, in one pass.

    RSS 0.9x/1.0/2.0 ``item`` and Atom ``entry`` blocks are cut out by position and each is parsed on its own
    (name-space prefixes ignored: ``dc:date``, ``content:encoded``), after stray ``&`` are repaired. A feed that
    is not well-formed, or is never closed, so keeps its entries; a block that cannot be parsed still gives
    its title and link where these can be found.
    Output: feed, pos (0-based), title, link, links (array<struct<href>>), published, updated, summary, content.
    """
    xml = F.regexp_replace(F.coalesce(F.col(xml_col), F.lit("")), r"&(?!#[0-9]+;|#x[0-9a-fA-F]+;|amp;|lt;|gt;|quot;|apos;)", "&amp;")
    starts = F.split(xml, r"<(?:[A-Za-z0-9]+:)?(?:item|entry)(?:\s[^>]*)?>", -1)
    blocks = F.transform(F.filter(starts, lambda b, i: i > 0),
                         lambda b: F.regexp_replace(b, r"(?s)</(?:[A-Za-z0-9]+:)?(?:item|entry|channel|rss|feed|RDF)\s*>.*", ""))
    cut = feeds.select(F.col(feed_col).alias("feed"), F.posexplode(blocks).alias("pos", "b"))
    opts = {"mode": "PERMISSIVE", "ignoreNamespace": "true"}
    e = cut.select("feed", "pos", "b", F.from_xml(F.concat(F.lit("<e>"), F.col("b"), F.lit("</e>")), ENTRY_SCHEMA, opts).alias("e"))
    found = lambda tag: F.nullif(F.regexp_extract("b", rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", 1), F.lit(""))
    links = F.filter(F.coalesce("e.link", F.array()), lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate")
    hrefs = F.filter(F.transform(links, lambda k: F.struct(k["_href"].alias("href"))), lambda k: k["href"].isNotNull())
    texts = F.filter(F.transform(links, lambda k: k["_VALUE"]), lambda v: F.trim(F.coalesce(v, F.lit(""))) != "")
    return e.select("feed", "pos", F.coalesce("e.title", found("title")).alias("title"),
                    F.coalesce(F.try_element_at(texts, F.lit(1)), found("link"), F.lit("")).alias("link"), hrefs.alias("links"),
                    F.coalesce("e.pubDate", "e.published", "e.date").alias("published"), F.col("e.updated").alias("updated"),
                    F.coalesce("e.summary", "e.description").alias("summary"), F.coalesce("e.encoded", "e.content").alias("content"))


# ---------------------------------------------------------------------------
# Page HTML -> main text
# ---------------------------------------------------------------------------

DROP_BLOCKS = ["script", "style", "nav", "header", "footer", "aside", "table", "noscript", "head", "form"]
BREAK_TAGS = ["br", "p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "article", "section"]
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
#: a line of which this share of the characters is link text is a menu
LINK_SHARE = 0.8


def extract_page_text(pages: DataFrame, html_col: str = "html", out: str = "page_text", link_share: float = LINK_SHARE) -> DataFrame:
    """A06 (re-aimed): main text of stored HTML with built-in regex functions.

    Comments and non-content blocks (script, style, nav, header, footer,
    aside, tables, forms) are removed, block tags become line breaks, other
    tags are dropped, common entities decoded, blanks collapsed. A line is dropped if it is empty or
    at least ``link_share`` of it is link text (menus); length plays no part, so short paragraphs stay.
    Failure-free: NULL html gives ''.
    """
    h = F.coalesce(F.col(html_col), F.lit(""))
    h = F.regexp_replace(h, "[\x01\x02]", "")
    h = F.regexp_replace(h, r"(?s)<!--.*?-->", "")
    for t in DROP_BLOCKS:
        h = F.regexp_replace(h, rf"(?is)<{t}\b[^>]*>.*?</{t}\s*>", " ")
    # the marks \x01 and \x02 enclose link text until the lines are judged
    h = F.regexp_replace(h, r"(?i)<a\b[^>]*>", "\x01")
    h = F.regexp_replace(h, r"(?i)</a\s*>", "\x02")
    h = F.regexp_replace(h, r"(?i)<(" + "|".join(BREAK_TAGS) + r")\b[^>]*>", "\n")
    h = F.regexp_replace(h, r"(?i)</(" + "|".join(BREAK_TAGS) + r")\s*>", "\n")
    h = F.regexp_replace(h, r"<[^>]*>", "")
    for ent, ch in ENTITIES:
        h = F.replace(h, F.lit(ent), F.lit(ch))
    h = F.regexp_replace(h, r"[ \t\r\f]+", " ")
    plain = lambda ln: F.regexp_replace(ln, "[\x01\x02]", "")
    own = lambda ln: F.regexp_replace(F.regexp_replace(ln, "\x01[^\x02]*\x02", ""), "[\x01\x02]", "")
    judged = F.transform(F.split(h, "\n"), lambda ln: F.struct(F.trim(plain(ln)).alias("t"), F.length(F.trim(own(ln))).alias("own")))
    kept = F.filter(judged, lambda ln: (ln["t"] != "") & (ln["own"] > (1 - link_share) * F.length(ln["t"])))
    return pages.withColumn(out, F.array_join(F.transform(kept, lambda ln: ln["t"]), "\n"))


def collect(feeds: DataFrame, pages: DataFrame, sources: DataFrame, run_ts=None, rules: P.Rules = P.DEFAULT_RULES) -> DataFrame:
    """The collect stage: stored feeds and pages -> articles.

    Entries -> per-feed cap -> URL -> time -> age -> page text (of the page with the entry's URL; the first by
    ``page_id`` where several have it) -> length -> source attributes. ``feeds``: (source_id, xml);
    ``pages``: (page_id, url, html); ``sources``: the registry. Without ``run_ts`` ages count from the newest entry.
    """
    entries = ingest.feed_cap(feed_entries(feeds).withColumnRenamed("feed", "source_id"), rules.max_articles_per_feed)
    entries = ingest.drop_missing_url(entries.withColumn("url", entry_url("link", "links")))
    timed = entries.withColumn("published_at", parse_published(published=F.col("published"), updated=F.col("updated")))
    if run_ts is None:
        run_ts = ingest.run_ts_of(timed)
    elif not isinstance(run_ts, Column):
        run_ts = F.lit(run_ts).cast("timestamp")
    # an entry without a readable time counts as new
    entries = timed.withColumn("published_at", F.coalesce("published_at", run_ts))
    fresh = ingest.freshness_filter(entries, run_ts, rules.max_age_hours)
    first = pages.groupBy(py_strip("url").alias("url")).agg(F.min_by("html", "page_id").alias("html"))
    texts = extract_page_text(fresh.join(first, "url", "left"), out="page_text")
    body = texts.withColumn("body", F.coalesce(F.nullif("page_text", F.lit("")), F.col("content"), F.lit("")))
    kept = ingest.min_length_filter(body.withColumn("summary", F.coalesce("summary", F.lit(""))), rules.min_article_chars)
    articles = ingest.project_articles(kept.withColumn("id", article_id("url")), sources)
    return articles.select("id", "url", "source_id", "pos", "title", "body", "summary", "published_at", "source_name", "domain",
                           "bias_rating", "factual_rating", "credibility_score", "language")


# ---------------------------------------------------------------------------
# Run outputs
# ---------------------------------------------------------------------------


def write_run_outputs(frames: dict[str, DataFrame], base: str, ym: str, mode: str = "overwrite") -> dict[str, str]:
    """Write a run's tables under ``base/<name>/ym=<YYYY-MM>/``.

    ``raw``/``clusters``/``top`` as JSON, ``scored`` as CSV (map/array columns
    rendered with ``to_json``), ``meta`` as JSON. Partition overwrite is
    dynamic, so re-running a month replaces only that month (idempotent).
    """
    paths = {}
    for name, df in frames.items():
        out = df.withColumn("ym", F.lit(ym))
        path = f"{base}/{name}"
        if name == "scored":
            cols = [F.to_json(F.col(f.name)).alias(f.name)
                    if f.dataType.typeName() in ("map", "array", "struct") else F.col(f.name)
                    for f in out.schema.fields]
            out.select(*cols).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("ym").option("header", True).csv(path)
        else:
            out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("ym").json(path)
        paths[name] = path
    return paths
