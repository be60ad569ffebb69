"""URL filter: host rules first, then a path-template tree per host.

A rule names a host and the start of a path, and holds for the host and all its subdomains; of the rules that
fit a url the longest decides. Other urls are judged by their path's template. Segments become templates in two
steps: digits and hexadecimal ids are generalised by their form, and where a branch has many rare children
these are variable and become a wildcard. The urls that a rule decides are the labels. Among the children of a
branch, those whose share of blocked urls does not differ significantly from the branch's are merged to one
statistical branch; the others keep their own counts. A template's purity is the blocked share, smoothed towards
the purity of its parent, from the host's root (smoothed towards the share of all labels) down to the leaf;
templates of at least ``REJECT`` are blocked.

The tree has ``LEVELS`` levels. What a longer path holds from the last level on is one segment, its tail, which is
compared whole and becomes a wildcard like any other segment; so the number of steps does not follow the deepest url.

Pages meet only the templates; the tree is built on the distinct templates with their counts, summed before
they shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path and no rule; repeated rows each get a
row; without labels nothing is blocked by the tree; very long urls are read whole (a deep path's tail is one segment of the last level);
an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brieflow.llm.common import attach_groups, stored

#: levels of the tree; the last one holds the whole tail of a deeper path
LEVELS = 8
#: children from which a branch's segments can be variable, and how often a child then occurs at most on average
MANY_CHILDREN = 16
RARE_CHILD = 4.0
#: normal deviate beyond which a child differs from its branch
DIFFERS = 1.96
#: labelled urls that the parent's purity counts for
WEIGHT = 5.0
REJECT = 0.7


class Rule(NamedTuple):
    host: str
    path: str
    allow: bool


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), ascii_uppercase, ascii_lowercase), F.regexp_extract(url, pattern, 2)


def deciding_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Number of the longest rule that fits; null if none does."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].host + rules[i].path), i))
    fits = [F.when(((host == rules[i].host) | host.endswith("." + rules[i].host)) & path.startswith(rules[i].path), i) for i in order]
    return F.coalesce(*fits, F.lit(None).cast("int"))


def path_form(path: Column) -> Column:
    """The path's segments without a slash at the end, digits and hexadecimal ids generalised."""
    form = lambda s: F.when(s.rlike("^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "*").otherwise(F.regexp_replace(s, "[0-9]+", "*"))
    return F.transform(F.split(F.regexp_replace(path, "^/|/$", ""), "/"), form)


def fold_tail(segments: Column) -> Column:
    """At most ``LEVELS`` segments: those from the last level on are joined to one."""
    tail = F.array_join(F.slice(segments, LEVELS, F.greatest(F.size(segments) - (LEVELS - 1), F.lit(0))), "/")
    return F.when(F.size(segments) > LEVELS, F.concat(F.slice(segments, 1, LEVELS - 1), F.array(tail))).otherwise(segments)


def _wildcards(forms: DataFrame) -> DataFrame:
    """``forms`` with the variable segments of ``segments`` made wildcards, level by level from the root."""
    depth = forms.agg(F.max(F.size("segments"))).first()[0] or 0  # at most LEVELS
    for d in range(depth):
        head = F.slice("segments", 1, d)
        children = forms.filter(F.size("segments") > d).groupBy("host", head.alias("head"), F.get("segments", F.lit(d)).alias("child")).agg(F.sum("n").alias("n"))
        variable = (children.filter(~F.col("child").contains("*")).groupBy("host", "head").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"))
                    .filter((F.col("kinds") >= MANY_CHILDREN) & (F.col("n") <= RARE_CHILD * F.col("kinds"))).select("host", "head", F.lit(True).alias("variable")))
        variable = stored(variable, "variable")
        if variable.isEmpty():
            continue
        replaced = F.transform("segments", lambda s, i: F.when((i == d) & F.col("variable") & ~s.contains("*"), "*").otherwise(s))
        forms = stored(forms.withColumn("head", head).join(variable, ["host", "head"], "left").withColumn("segments", replaced).drop("head", "variable"), "templates")
    return forms


def template_purity(forms: DataFrame) -> DataFrame:
    """``host``, ``raw``, ``n``, ``template`` and ``purity`` of each path form (``segments``, and the numbers of
    its urls ``n``, labelled urls ``known`` and blocked ones ``bad``)."""
    path = F.array_join("segments", "/")
    leaves = forms.select("host", "raw", "n", "known", "bad", "segments")
    steps = leaves.select("host", "raw", "known", "bad", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("segments")), lambda d: F.struct(d.alias("depth"), F.slice("segments", 1, d).alias("node"),
                                                                     F.slice("segments", 1, F.greatest(d - 1, F.lit(0))).alias("parent")))).alias("s")).select("*", "s.*").drop("s")
    nodes = steps.groupBy("host", "depth", "node", "parent").agg(F.sum("known").alias("known"), F.sum("bad").alias("bad"))
    nodes = stored(nodes, "nodes")
    above = nodes.select("host", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("known").alias("p_known"), F.col("bad").alias("p_bad"))
    judged = nodes.join(above, ["host", "depth", "parent"], "left")
    rate = F.try_divide("p_bad", "p_known")
    off = F.abs(F.col("bad") - F.col("known") * rate) > DIFFERS * F.sqrt(F.col("known") * rate * (1 - rate))
    judged = judged.withColumn("own", F.coalesce((F.col("depth") == 0) | (F.col("known") > 0) & (F.col("p_known") > 0) & off, F.lit(False)))
    pooled = judged.filter("not own").groupBy("host", "depth", "parent").agg(F.sum("known").alias("m_known"), F.sum("bad").alias("m_bad"))
    counts = stored(judged.join(pooled, ["host", "depth", "parent"], "left")
                    .select("host", "depth", "node", F.when(F.col("own"), F.col("known")).otherwise(F.col("m_known")).alias("known"),
                            F.when(F.col("own"), F.col("bad")).otherwise(F.col("m_bad")).alias("bad")), "branches")
    total = nodes.filter("depth = 0").agg(F.coalesce(F.sum("known"), F.lit(0)).alias("k"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b")).first()
    prior = (total["b"] + 0.5) / (total["k"] + 2.0)
    chain = (steps.select("host", "raw", "depth", "node").join(counts, ["host", "depth", "node"])
             .groupBy("host", "raw").agg(F.array_sort(F.collect_list(F.struct("depth", "known", "bad"))).alias("chain")))
    purity = F.aggregate("chain", F.lit(prior), lambda p, x: (x["bad"] + WEIGHT * p) / (x["known"] + WEIGHT))
    return chain.select("host", "raw", purity.alias("purity")).join(leaves.select("host", "raw", "n", F.concat(F.lit("/"), path).alias("template")), ["host", "raw"])


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity``."""
    host, path = url_parts(F.col("_url"))
    parts = (pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select("_id", host.alias("host"), path.alias("path"))
             .withColumn("_rule", deciding_rule(F.col("host"), F.col("path"), rules)).withColumn("segments", path_form(F.col("path")))
             .withColumn("raw", F.array_join("segments", "/")).withColumn("segments", fold_tail(F.col("segments"))))
    parts = stored(parts, "urls")
    blocked = F.col("_rule").isin([i for i, r in enumerate(rules) if not r.allow])
    forms = stored(parts.groupBy("host", "raw", "segments").agg(
        F.count("*").alias("n"), F.count("_rule").alias("known"), F.count_if(F.coalesce(blocked, F.lit(False))).alias("bad")), "forms")
    templates = stored(template_purity(_wildcards(forms)), "purities")
    names = F.array(*[F.lit(r.host + r.path) for r in rules])
    by_tree = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    verdict = F.when(F.col("_rule").isNull(), by_tree).when(blocked, "block").otherwise("allow")
    judged = attach_groups(parts.drop("segments"), templates, ["host", "raw"], "n", parts.count())
    return judged.select(F.col("_id").alias(id_col), "host", "path", F.when(F.col("_rule").isNotNull(), F.get(names, F.col("_rule"))).alias("rule"),
                         verdict.alias("verdict"), "template", "purity")
