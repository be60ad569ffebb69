"""SimHash near-duplicate groups by BK-trees.

A text's fingerprint is the SimHash of its word shingles. Equal fingerprints are one class; only classes are
compared. Two fingerprints within ``radius`` bits agree on at least ``m - radius`` of ``m`` bit blocks, so all
classes that agree on such a set of blocks form a shard, and every pair within the radius meets in some shard.
Each shard has a BK-tree: a node's children are keyed by their Hamming distance to it, and a search for ``q``
at distance ``d`` from a node follows only the edges from ``d - radius`` to ``d + radius`` (the triangle
inequality rules out the others). ``m`` grows with the number of classes so that shards stay small; the result
is the same for every ``m``.

A shard of more than ``SHARD_MAX`` classes is cut into trees of about that size; each such tree is sent to the
tasks that hold its queries, so a tree that is copied to other tasks never exceeds that bound by more than
chance. Only the links of a spanning forest leave a shard: they connect what all links connect, without a row
for every pair. Components of the links are found by alternating star contraction on checkpointed tables.

Defined cases: null and blank texts have fingerprint zero and link like any other; repeated rows share a class;
null ids never name a component unless all its ids are null (then the component id is null);
very long texts are read whole; an empty table gives no rows; further columns, whatever their names, are not read (``drop_near_copies`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import attach_groups, slices, stored

SEED = 42
SHARD_MEAN = 64
SHARD_MAX = 4096
#: shingles whose bits are counted at once
BIT_BATCH = 1 << 15


def simhash(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the text's word shingles (ASCII lower case and white space); zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b - 1], SEED) for a, b in zip(ends, ends[k:])], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BIT_BATCH):
        part = hashes[at:at + BIT_BATCH].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_texts(docs: DataFrame, text_col: str = "text", shingle: int = 4, name: str = "_fp") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of ``text_col``."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([simhash(t, shingle) for t in b.column(at).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


class BKTree:
    """Fingerprints in a tree whose edges carry the Hamming distance between child and parent."""

    def __init__(self) -> None:
        self.words: list[int] = []
        self.kids: list[dict[int, int]] = []

    def add(self, word: int) -> int:
        at, new = 0, len(self.words)
        self.words.append(word)
        self.kids.append({})
        if new:
            while (child := self.kids[at].get(d := (word ^ self.words[at]).bit_count())) is not None:
                at = child
            self.kids[at][d] = new
        return new

    def within(self, word: int, radius: int) -> list[int]:
        found, todo = [], [0] if self.words else []
        while todo:
            at = todo.pop()
            d = (word ^ self.words[at]).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.kids[at].items():
                if -radius <= edge - d <= radius:
                    todo.append(child)
        return found


def block_masks(m: int) -> list[int]:
    """Masks of ``m`` blocks that together hold the 64 bits."""
    cuts = [64 * i // m for i in range(m + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


def shard_masks(classes: int, radius: int) -> list[int]:
    """One mask for each way in which two fingerprints within the radius can agree; as few blocks as keep the
    mean shard at ``SHARD_MEAN`` classes."""
    m = radius + 1
    while m < 2 * radius + 4 and classes > SHARD_MEAN << (64 * (m - radius) // m):
        m += 1
    return [sum(c) for c in combinations(block_masks(m), m - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def forest(tree_words: list[int], queries: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest: within ``tree_words`` (no ``queries``), or between them and the queries."""
    tree, parent, links = BKTree(), {}, []

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = up = parent.get(up, up)
            x = up
        return x

    def join(a: int, b: int) -> None:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            links.append((a, b))

    for word in tree_words:
        if queries is None:
            for at in tree.within(word, radius):
                join(word, tree.words[at])
        tree.add(word)
    for word in queries or ():
        for at in tree.within(word, radius):
            join(word, tree.words[at])
    return links


def near_links(classes: DataFrame, radius: int, total: int) -> DataFrame:
    """Links (``a``, ``b``) that connect all fingerprints ``_fp`` of ``classes`` within the radius."""
    masks = shard_masks(total, radius)
    keyed = classes.select("_fp", F.posexplode(F.array(*[F.col("_fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("_t", "_k"))
    large = keyed.groupBy("_t", "_k").count().filter(F.col("count") > SHARD_MAX).select("_t", "_k", F.ceil(F.col("count") / SHARD_MAX).alias("_cuts"))
    large = stored(large, "large-shards")
    cut = F.pmod(F.xxhash64("_fp", F.lit(7)), F.col("_cuts"))
    small_ones = keyed.join(large, ["_t", "_k"], "left_anti").select("_fp", "_t", "_k", F.lit(0).cast("long").alias("_i"), F.lit(0).cast("long").alias("_j"), F.lit(False).alias("_query"))
    if large.isEmpty():
        dealt = keyed.select(*small_ones.columns[:3], F.lit(0).cast("long").alias("_i"), F.lit(0).cast("long").alias("_j"), F.lit(False).alias("_query"))
    else:
        # every cut meets itself and every other cut once: the lower number is the tree, the higher one queries
        pairs = (keyed.join(large, ["_t", "_k"]).withColumn("_s", cut)
                 .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cuts") - 1)))
                 .select("_fp", "_t", "_k", F.least("_s", "_o").alias("_i"), F.greatest("_s", "_o").alias("_j"), (F.col("_s") > F.col("_o")).alias("_query")))
        dealt = small_ones.unionByName(pairs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = ([], []), None
        out: list[tuple[int, int]] = []

        def close() -> None:
            same_cut = now is None or now[2] == now[3]
            if len(held[0]) + len(held[1]) > 1:
                out.extend(forest(held[0], None if same_cut else held[1], radius))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"a": pa.array([_signed(a) for a, _ in out], pa.int64()), "b": pa.array([_signed(b) for _, b in out], pa.int64())})

        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64).tolist()
            for fp, *key, query in zip(fps, *(b.column(c).to_pylist() for c in range(1, 5)), b.column(5).to_pylist()):
                if key != now:
                    close()
                    held, now = ([], []), key
                held[query].append(fp)
            if out:
                yield batch()
                out.clear()
        close()
        if out:
            yield batch()

    return (dealt.repartition("_t", "_k", "_i", "_j").sortWithinPartitions("_t", "_k", "_i", "_j")
            .mapInArrow(search, "a long, b long").distinct())


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node connected with it (``root``), of all nodes in ``links`` (``a``, ``b``).

    Alternating large and small stars: each round ties every node to the smallest in its neighbourhood, and
    the tables of a round are checkpointed. Hot nodes are summed before they shuffle; their rows only take
    part in joins, which Spark can split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct().checkpoint()
    mark = None
    while True:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(low, "u").select("u", "v", "m")
        small = tied.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        edges = small.filter("u != v").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        mark = now


def label_classes(fps: DataFrame, radius: int, total: int) -> DataFrame:
    """Of each fingerprint: its number of rows ``_n``, the component's least id ``_component`` and, of the
    component's rows with that id, the least fingerprint ``_keep_fp``. ``fps`` has ``_id`` and ``_fp``."""
    first = F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_fp").alias("f")))
    classes = stored(fps.groupBy("_fp").agg(first.alias("_first"), F.count("*").alias("_n")), "classes")
    nodes = stored(components(near_links(classes.select("_fp"), radius, total)), "components")
    linked = classes.join(nodes.select(F.col("node").alias("_fp"), "root"), "_fp")
    best = linked.groupBy("root").agg(F.min("_first").alias("_best"))
    of_linked = linked.join(best, "root").select("_fp", "_n", "_best")
    of_others = classes.join(nodes.select(F.col("node").alias("_fp")), "_fp", "left_anti").select("_fp", "_n", F.col("_first").alias("_best"))
    return stored(of_linked.unionByName(of_others).select("_fp", "_n", F.col("_best.i").alias("_component"), F.col("_best.f").alias("_keep_fp")), "labels")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    fps = stored(fingerprint_texts(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", shingle).drop("_text"), "fingerprints")
    total = fps.count()
    labels = label_classes(fps, radius, total)
    return attach_groups(fps, labels, "_fp", "_n", total).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row with the least id."""
    own = docs.columns
    full = fingerprint_texts(docs.select(F.struct(*own).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", shingle)
    keyed = stored(full.drop("_text"), "fingerprinted")
    total = keyed.count()
    labels = label_classes(keyed.select("_id", "_fp"), radius, total)
    marked = attach_groups(keyed.select("_id", "_fp"), labels, "_fp", "_n", total)
    stays = F.col("_id").eqNullSafe(F.col("_component")) & (F.col("_fp") == F.col("_keep_fp"))
    members = marked.groupBy("_id", "_fp").agg(F.first(stays).alias("_stays"), F.count("*").alias("_rows"))
    gone = stored(members.filter("not _stays").select("_id", "_fp"), "near-copies")
    twice = stored(members.filter("_stays and _rows > 1").select("_id", "_fp"), "repeated")

    def is_in(other: DataFrame):
        return keyed["_id"].eqNullSafe(other["_id"]) & (keyed["_fp"] == other["_fp"])

    rest = keyed.join(gone, is_in(gone), "left_anti")
    if twice.isEmpty():
        return rest.select("_row.*")
    rest = keyed.join(gone, is_in(gone), "left_anti").join(twice, is_in(twice), "left_anti")
    single = keyed.join(twice, is_in(twice), "left_semi").dropDuplicates(["_id", "_fp"])
    return rest.unionByName(single).select("_row.*")
