"""First-fit leader election over a pair list, as rounds of DataFrame joins.

Semantics (sequential rule): visit nodes in ascending order; a node is a
*duplicate* of the first (lowest-order) earlier *leader* adjacent to it, and
becomes a leader itself when no earlier leader is adjacent. This is the
lexicographically first maximal independent set; it is **not** connected
components (A~B, B~C, A≁C gives leaders A and C, B -> A).

Round r works on the undecided nodes ``U`` and the edges among them ``E``
(edges oriented earlier -> later):

1. new leaders  ``N`` = nodes of ``U`` with no incoming edge in ``E`` — every
   earlier neighbour is decided, and none of them is a leader (each leader's
   later neighbours were turned into duplicates in the round it was elected);
2. new duplicates ``D`` = heads of edges leaving ``N``;
3. ``U -= N ∪ D``, ``E`` keeps edges with neither end in ``D``.

Only ``E`` is kept between rounds: ``N`` are its sources that are no heads, and at the end the leaders are all nodes but the
duplicates. The lowest undecided node is always elected, so the loop ends; the number of
rounds is the longest arrival-ordered chain of near-duplicates, not n. Each
round is a few shuffle joins over the shrinking residual graph, and the
residual is checkpointed to the shared checkpoint folder each round so
lineage stays short and a lost executor only replays one round. Finally each
duplicate maps to its lowest adjacent leader via one aggregate over the
original edges (``min`` over leader neighbours).

:func:`first_fit` elects without an edge list. Nodes carry *groups*, such that any two adjacent nodes share one (the bands
of a fingerprint). In each pass only the first ``head`` undecided nodes of every group are compared with each other, so a
cluster of m nodes in which all are adjacent costs rows for its first nodes, not m squared: whoever of them leads then meets
the rest of its groups, one row for each node that it takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow.session import broadcast_if_small, ensure_checkpoint_dir


def _rounds(U: DataFrame, E: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> tuple[list[DataFrame], list[DataFrame]]:
    """(leaders, duplicates), in parts, of the undecided nodes ``U`` (n) over the edges ``E`` (u, v).

    An edge may come from a node outside ``U``, which stays undecided: its heads then stay undecided as well,
    unless a leader takes them."""
    duplicates: list[DataFrame] = []
    # whether an edge comes from an undecided node; those of ``U`` without edges need no rounds
    E = cut(E.join(U.select(F.col("n").alias("u"), F.lit(True).alias("own")), "u", "left"))
    while True:
        heads = E.select(F.col("v").alias("u")).distinct()
        D = cut(E.filter("own").join(heads, "u", "left_anti").select("v").distinct())
        if D.isEmpty():  # no edges left, or all that are wait for a node outside
            U = U.join(heads.withColumnRenamed("u", "n"), "n", "left_anti")
            return [U if not duplicates else U.join(_union(duplicates), "n", "left_anti")], duplicates
        duplicates.append(D.withColumnRenamed("v", "n"))
        # edges out of new leaders lead to new duplicates, so these joins drop them as well
        E = cut(E.join(D, "v", "left_anti").join(D.withColumnRenamed("v", "u"), "u", "left_anti"))


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def leader_election(nodes: DataFrame, edges: DataFrame, node: str = "node", checkpoint: bool = True) -> DataFrame:
    """Return (node, leader, is_leader) for every node of ``nodes``.

    ``nodes``: one column ``node`` (BIGINT order key, unique). ``edges``: (u, v)
    with u < v. The edges are materialised once; they feed every round and the final map.
    """
    spark = nodes.sparkSession
    if checkpoint:
        ensure_checkpoint_dir(spark)
    nd = nodes.select(F.col(node).alias("n")).distinct()

    def cut(df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True) if checkpoint else df

    e0 = cut(edges.select("u", "v"))
    # only nodes with an edge are undecided; all others lead themselves
    U = cut(e0.select(F.col("u").alias("n")).union(e0.select(F.col("v").alias("n"))).distinct())
    all_leaders = cut(_union(_rounds(U, e0, cut)[0]))
    # duplicate -> lowest adjacent leader (over the original edges)
    dup_map = (e0.join(all_leaders.withColumnRenamed("n", "u"), "u", "left_semi")
                 .join(all_leaders.withColumnRenamed("n", "v"), "v", "left_anti")
                 .groupBy("v").agg(F.min("u").alias("leader"))
                 .withColumnRenamed("v", "n"))
    out = (nd.join(dup_map, "n", "left")
             .select(F.col("n").alias(node), F.coalesce(F.col("leader"), F.col("n")).alias("leader"),
                     F.col("leader").isNull().alias("is_leader")))
    return out


#: undecided nodes of a group that are compared with each other in a pass
HEAD = 64


def first_fit(nodes: DataFrame, near: Callable[[str, str], Column], head: int = HEAD, *, gs: Column | None = None) -> DataFrame:
    """(node, leader) for every row of ``nodes``: ``node`` (BIGINT order key, unique), ``gs`` (array of its groups) and what
    ``near`` looks at. ``near(a, b)`` says whether two nodes, their columns prefixed ``a_`` and ``b_``, are adjacent; adjacent
    nodes must share a group (a node without groups leads itself). Groups that are given as an expression ``gs`` over the other columns are not stored.

    A pass takes the nodes that are among the first ``head`` undecided ones of *all* their groups: all their earlier undecided
    neighbours are among the first of a shared group, so the edges between the groups' first nodes are all that can decide them.
    The rounds above decide them, except those that wait for a node which is not taken. New leaders then take whoever is near them in their groups.
    The lowest undecided node is always decided. Each pass doubles ``head``, as leaders have thinned the groups out. At the end a duplicate's leader is
    the lowest one among its edges, or, where a leader took it, among all leaders in its groups.

    Members shuffle once in a pass, under a hash of their group (one that two groups share only lets more nodes meet). Of a group only its edges are kept
    and, if it holds more than ``head`` nodes, the first one beyond.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    own = [c for c in nodes.columns if c not in ("node", "gs")]
    groups = F.array_distinct(F.transform(F.col("gs") if gs is None else gs, lambda g: F.xxhash64(g)))

    def cut(df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True)

    def members(df: DataFrame) -> DataFrame:
        return df.select("node", *own, F.explode("gs" if gs is None else groups).alias("g"))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("g", *[F.col(c).alias(f"{name}_{c}") for c in ("node", *own)])

    def meetings(leaders: DataFrame, others: DataFrame) -> DataFrame:
        """(u, v): nodes of ``others`` near a leader before them."""
        few = broadcast_if_small(members(others).select("g").distinct())  # where it is small, no other group of the leaders shuffles
        met = side(members(nodes.join(leaders, "node", "left_semi")).join(few, "g", "left_semi"), "a").join(side(members(others), "b"), "g")
        return met.filter((F.col("a_node") < F.col("b_node")) & near("a", "b")).select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))

    nodes = cut(nodes.withColumn("gs", groups) if gs is None else nodes)
    size = F.size("gs" if gs is None else gs)
    leaders = [nodes.filter(size == 0).select("node")]
    edges: list[DataFrame] = []
    taken: list[DataFrame] = []
    left = nodes.filter(size > 0)
    while not left.isEmpty():
        first, rank = Window.partitionBy("g").orderBy("node"), F.col("rank")
        ranked = members(left).withColumn("rank", F.row_number().over(first)).filter(rank <= head + 1)
        earlier = F.collect_list(F.struct("node", *own)).over(first.rowsBetween(-head, -1))
        met = ranked.withColumn("earlier", F.when(rank <= head, earlier)).withColumn("a", F.explode_outer("earlier"))
        met = met.select("g", "rank", *[F.col(c).alias(f"b_{c}") for c in ("node", *own)], *[F.col(f"a.{c}").alias(f"a_{c}") for c in ("node", *own)])
        met = cut(met.filter((rank > head) | near("a", "b")).select(F.col("a_node").alias("u"), F.col("b_node").alias("v"), F.when(rank > head, F.col("g")).alias("g")))
        over = met.filter("g is not null").select("g", F.col("v").alias("bound"))
        whole = over.isEmpty()
        met = met.filter("g is null").select("u", "v").distinct()
        if not whole:
            beyond = cut(members(left).join(broadcast_if_small(over), "g").filter(F.col("node") >= F.col("bound")).select("node").distinct())
            met = met.join(beyond.withColumnRenamed("node", "v"), "v", "left_anti").select("u", "v")
        met = cut(met)
        edges.append(met)
        bound = met.select(F.col("u").alias("n")).union(met.select(F.col("v").alias("n"))).distinct()
        alone = left.select(F.col("node").alias("n")).join(bound, "n", "left_anti")
        if not whole:
            alone, bound = (d.join(beyond.withColumnRenamed("node", "n"), "n", "left_anti") for d in (alone, bound))
        new, duplicates = _rounds(cut(bound), met, cut)
        new = cut(_union([alone, *new]).withColumnRenamed("n", "node"))
        leaders.append(new)
        if whole:  # all were taken, so none waits
            break
        gone = _union([new, *(d.withColumnRenamed("n", "node") for d in duplicates)])
        left = cut(left.join(gone, "node", "left_anti"))
        reached = cut(meetings(new, left).select(F.col("v").alias("node")).distinct())
        taken.append(reached)
        left = cut(left.join(reached, "node", "left_anti"))
        head *= 2
    all_leaders = cut(_union(leaders))
    found = [e.join(all_leaders.withColumnRenamed("node", "u"), "u", "left_semi").select("u", "v") for e in edges]
    if taken:
        found.append(meetings(all_leaders, nodes.join(_union(taken), "node", "left_semi")))
    if not found:
        return all_leaders.withColumn("leader", F.col("node"))
    of = _union(found).groupBy("v").agg(F.min("u").alias("leader")).withColumnRenamed("v", "node")
    of = of.join(all_leaders, "node", "left_anti")
    return all_leaders.withColumn("leader", F.col("node")).unionByName(of)


__all__ = ["leader_election", "first_fit"]
