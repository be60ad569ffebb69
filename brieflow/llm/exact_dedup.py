"""Exact deduplication by two-pass Bloom filtering.

Texts are equal when they are identical after every ASCII white-space character is deleted. The first pass
hashes each text and sets the hash's bits in two tables: *seen* and *seen again*. A row is possibly repeated
if all its bits are set in the second table. Only those rows shuffle; all others pass straight through.
False positives cost a shuffled row, never a wrong answer.

The bit tables are never dense per task: a task sends the positions it set, by block of 32,768 bits, and a
block is merged where its positions meet. A table has ``BITS_PER_ROW`` bits a row and at most ``MAX_BITS`` (16 MiB), so
it can be broadcast. More rows than one table serves (about 8 million) are dealt to shards by their hash, so that copies meet
in one shard; the rows are then written once, by shard and without a shuffle, and each shard has both passes with its own table.
So the share of rows that shuffle without need, about 1.4 %, does not grow with the input.

Defined cases: null text counts as empty; rows with the same id and the same text are one document seen
several times, of which one row stays; a null id sorts after all others; very long texts are
hashed whole; an empty table gives no rows; further columns, whatever their names, are not read (``drop_exact_copies`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import attach_groups, slices, stored
from brieflow.session import scratch_path

WHITE_SPACE = b" \t\n\v\f\r"
MAX_BITS = 1 << 27
MIN_BITS = 1 << 16
BITS_PER_ROW = 16
BLOCK_BITS = 1 << 15
#: rows whose positions a task gathers before it sends them
FLUSH_ROWS = 1 << 20


def hash_texts(docs: DataFrame, text_col: str = "text", table: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``_sha`` (SHA-256 of the normalised text) and ``_chars`` (code points of the original); with
    the ``table`` of the first pass also ``_again`` (see ``flag_repeats``), and without the text itself."""
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if table is None or i != at]
    shared = None if table is None else docs.sparkSession.sparkContext.broadcast(table)
    fields = [*(docs.schema.fields[i] for i in kept), T.StructField("_sha", T.BinaryType()), T.StructField("_chars", T.LongType())]
    if table is not None:
        fields.append(T.StructField("_again", T.BooleanType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            sha = pa.array([hashlib.sha256(t.encode().translate(None, WHITE_SPACE)).digest() for t in texts], pa.binary())
            own = [sha, pa.array([len(t) for t in texts], pa.int64())]
            if shared is not None:
                own.append(pa.array(_is_again(sha, shared.value)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *own], names=[f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def _is_again(sha: pa.Array, table: np.ndarray) -> np.ndarray:
    """Whether all bits of each hash are set."""
    p = bit_positions(sha, len(table) * 8)
    return np.all((table[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1, axis=0).astype(bool)


def bit_positions(sha: pa.Array, bits: int) -> np.ndarray:
    """Two bit positions (a row of the result each) for every hash."""
    words = np.frombuffer(b"".join(sha.to_pylist()), np.uint64).reshape(-1, 4)
    return (words[:, :2] & np.uint64(bits - 1)).astype(np.int64).T


def seen_again(hashed: DataFrame, bits: int) -> np.ndarray:
    """First pass: the table of the bits that at least two rows set, as packed bytes."""

    def send(pairs: list[np.ndarray]) -> pa.RecordBatch:
        own = np.concatenate([*(p[0] for p in pairs), *(p[1][p[0] != p[1]] for p in pairs)])  # a row sets a bit once
        at, n = np.unique(own, return_counts=True)
        block = at // BLOCK_BITS
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        ends = np.append(cuts[1:], len(at))
        low, again = (at % BLOCK_BITS).astype(np.uint16), n > 1
        return pa.RecordBatch.from_pydict({
            "block": pa.array(block[cuts], pa.int64()),
            "once": pa.array([low[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "again": pa.array([low[a:b][again[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary())})

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(bit_positions(b.column(0), bits))
            rows += b.num_rows
            if rows >= FLUSH_ROWS:
                yield send(held)
                held, rows = [], 0
        if rows:
            yield send(held)

    def merge(t: pa.Table) -> pa.Table:
        once = np.frombuffer(b"".join(t["once"].to_pylist()), np.uint16)
        twice = np.bincount(once, minlength=BLOCK_BITS) > 1
        twice[np.frombuffer(b"".join(t["again"].to_pylist()), np.uint16)] = True
        return pa.table({"block": t["block"][:1], "bits": pa.array([np.packbits(twice).tobytes()], pa.binary())})

    parts = (hashed.select("_sha").mapInArrow(mark, "block long, once binary, again binary")
             .groupBy("block").applyInArrow(merge, "block long, bits binary"))
    table = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():  # at most bits / 8 bytes in all
        at = r["block"] * (BLOCK_BITS // 8)
        table[at:at + BLOCK_BITS // 8] = np.frombuffer(r["bits"], np.uint8)
    return table


def flag_repeats(hashed: DataFrame, table: np.ndarray) -> DataFrame:
    """Second pass: adds ``_again``, true where the row's hash may occur in another row."""
    shared, at = hashed.sparkSession.sparkContext.broadcast(table), hashed.columns.index("_sha")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_is_again(b.column(at), shared.value))], names=[*b.schema.names, "_again"])

    return hashed.mapInArrow(run, T.StructType([*hashed.schema.fields, T.StructField("_again", T.BooleanType())]))


def _table_bits(rows: int) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << (rows * BITS_PER_ROW).bit_length()))


def _shards(total: int) -> int:
    """Number of shards for ``total`` rows."""
    return max(1, -(-total * BITS_PER_ROW // MAX_BITS))


def _by_shard(hashed: DataFrame, total: int, run: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """The rows of ``run`` over each shard of ``hashed`` (with ``_sha``), written shard by shard."""
    spark, shards = hashed.sparkSession, _shards(total)
    dealt = hashed.withColumn("_shard", F.pmod(F.xxhash64("_sha"), F.lit(shards)).cast("int"))
    source, result = scratch_path(spark, f"{name}-shards"), scratch_path(spark, name)
    dealt.write.partitionBy("_shard").parquet(source)
    parts = spark.read.schema(dealt.schema).parquet(source)
    for k in range(shards):
        own = run(parts.filter(F.col("_shard") == k).drop("_shard"))
        own.write.mode("append").parquet(result)
    return spark.read.schema(own.schema).parquet(result)


def _groups(members: DataFrame) -> DataFrame:
    """Of each hash: the row that stays (most code points, then smallest id) and the number of rows."""
    best = F.min(F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i")))
    return (members.groupBy("_sha").agg(best.alias("_best"), F.sum("_n").alias("_size"))
            .select("_sha", "_size", F.col("_best.i").alias("_keep"), (-F.col("_best.c")).alias("_keep_chars")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    hashed = stored(hash_texts(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")), "text").drop("text"), "exact")
    total = hashed.count()
    bits, sha = _table_bits(total), F.lower(F.hex("_sha"))

    def judged(rows: DataFrame) -> DataFrame:
        flagged = flag_repeats(rows, seen_again(rows, bits))
        alone = flagged.filter("not _again").select(
            F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), sha.alias("text_sha256"))
        members = flagged.filter("_again").groupBy("_sha", "_id", "_chars").agg(F.count("*").alias("_n"))
        joined = attach_groups(members, _groups(members), "_sha", "_size", total)
        stays = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_chars") == F.col("_keep_chars"))
        rest = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(
            F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
            (stays & (F.col("_copy") == 1)).alias("kept"), sha.alias("text_sha256"))
        return alone.unionByName(rest)

    return judged(hashed) if _shards(total) == 1 else _by_shard(hashed, total, judged, "exact-groups")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    keys = stored(hash_texts(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text").drop("_text"), "exact")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    total = keys.count()
    bits = _table_bits(total)

    def kept(keys: DataFrame, flag: Callable[[np.ndarray], DataFrame]) -> DataFrame:
        table = seen_again(keys, bits)
        members = flag_repeats(keys, table).filter("_again").groupBy("_sha", "_id", "_chars").agg(F.count("*").alias("_n"))
        winners = stored(_groups(members).select(F.col("_sha").alias("_g"), "_keep", "_keep_chars"), "winners")
        flagged = flag(table)
        chosen = (flagged.filter("_again")
                  .join(winners, (F.col("_sha") == F.col("_g")) & F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_chars") == F.col("_keep_chars")))
                  .dropDuplicates(["_sha"]))
        return flagged.filter("not _again").select("_row").unionByName(chosen.select("_row"))

    if _shards(total) == 1:  # the texts are hashed again rather than written
        return kept(keys, lambda table: hash_texts(rows, "_text", table)).select("_row.*")
    hashed = hash_texts(rows, "_text").drop("_text")
    return _by_shard(hashed, total, lambda part: kept(part.select("_id", "_sha", "_chars"), lambda table: flag_repeats(part, table)), "exact-rows").select("_row.*")
