"""Benchmark decontamination by winnowing.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after ASCII lower-casing. A window is ``window``
consecutive words of a test item; an item with fewer words is one window. Of every ``window`` words the
fingerprint is the smallest hash of their ``kgram``-word grams (the rightmost of equals), so two texts that
share ``window`` words in a row always share a fingerprint inside them. Training and test fingerprints are
joined, and each hit is extended to both sides word by word; where the common run reaches the needed length,
its words are hit. Hashes only propose: words are compared before anything counts.

Training fingerprints that no test item has are sorted out before the join by a bit table of the test
fingerprints (at most ``MAX_BITS`` bits, so it is broadcast at any size; a denser table only lets more rows
through to the join). Items shorter than a window are looked up by the hash of all their words.

Defined cases: null text has no words; repeated rows each get a row; an item with a null id contaminates but
is not counted among the items; a repeated item id counts once; no items: nothing is hit;
very long texts are read whole; an empty table of documents gives no rows; further columns, whatever their names, are not read
(``drop_contaminated`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import slices, stored, texts_utf8

WINDOW = 10
KGRAM = 5
MAX_BITS = 1 << 27
MIN_BITS = 1 << 16
BITS_PER_PRINT = 64
#: bytes of text that are hashed at once (a longer text is a portion of its own)
PORTION = 1 << 19

_LOWER = np.zeros(256, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)

#: an odd multiplier has an inverse modulo 2 ** 64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


class Hasher:
    """Words and gram hashes of a portion of texts; keeps the powers it has computed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, PORTION + 1)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64))]) for b in (_BASE, _BACK))

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, starts, ends and hashes of the words, and the first word of each text (n + 1)."""
        low = _LOWER[data]
        of_word = low != 0
        first, last = of_word.copy(), of_word.copy()
        first[1:] &= ~of_word[:-1]
        last[:-1] &= ~of_word[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads], last[tails] = of_word[heads], of_word[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self._powers(len(low) + 1)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(low * self.up[:len(low)], out=total[1:])
        hashes = _mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))
        return low, starts, ends, hashes, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on (one less for each word that is missing at the end)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        h = _mix(h * _U(_BASE) + words[j:len(words) - n + 1 + j])
    return h


def winnow(words: np.ndarray, text_of: np.ndarray, window: int, kgram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of texts with the given word hashes."""
    grams = gram_hashes(words, kgram)
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, at = grams[window - kgram:window - kgram + n].copy(), np.full(n, window - kgram)
    for j in range(window - kgram - 1, -1, -1):
        less = grams[j:j + n] < low
        low[less], at[less] = grams[j:j + n][less], j
    whole = np.flatnonzero(text_of[:n] == text_of[window - 1:])
    places = np.unique(whole + at[whole])
    return places, grams[places]


_PRINT = T.StructType([T.StructField("print", T.LongType()), T.StructField("before", T.ArrayType(T.StringType())),
                       T.StructField("words", T.ArrayType(T.StringType())), T.StructField("places", T.ArrayType(T.IntegerType()))])


def scan(df: DataFrame, text_col: str, window: int, kgram: int, short: list[int] | None, table: np.ndarray | None) -> DataFrame:
    """``df`` with ``_words`` (their number) and ``_prints``: each fingerprint with the words around it.

    ``short`` None: ``df`` holds items; each shorter than a window gets one print of all its words. Otherwise
    ``short`` lists the lengths of such items, which are looked for at every place, and only prints whose bit
    is set in ``table`` are given.
    """
    at, reach = df.columns.index(text_col), window - kgram
    shared = None if table is None else df.sparkSession.sparkContext.broadcast(table)

    def passes(prints: np.ndarray) -> np.ndarray:
        if shared is None:
            return np.ones(len(prints), bool)
        own = shared.value
        bit = prints & _U(len(own) * 64 - 1)
        return (own[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1

    def portion(hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> tuple[list[int], list[list[dict]]]:
        low, starts, ends, words, head = hasher.words(data, offsets)
        counts = np.diff(head)
        text_of = np.repeat(np.arange(len(counts)), counts)
        found: list[list[dict]] = [[] for _ in counts]

        def said(a: int, b: int) -> list[str]:
            return [low[starts[i]:ends[i]].tobytes().decode() for i in range(a, b)]

        places, prints = winnow(words, text_of, window, kgram)
        hit = passes(prints)
        for p, h in zip(places[hit].tolist(), prints[hit].view(np.int64).tolist()):
            k = text_of[p]
            a, b = head[k], head[k + 1]
            found[k].append({"print": h, "before": said(max(a, p - reach), p)[::-1], "words": said(p, min(b, p + window)), "places": [p - int(a)]})
        for n in range(1, window) if short is None else short:
            if short is None:
                texts = np.flatnonzero(counts == n)
                at_all = head[:-1][texts]
            else:
                at_all = np.flatnonzero(text_of[:len(words) - n + 1] == text_of[n - 1:]) if len(words) >= n else np.zeros(0, np.int64)
            if not len(at_all):
                continue
            h = gram_hashes(words, n)[at_all]
            hit = passes(h)
            held: dict[tuple[int, int], dict] = {}
            for p, h in zip(at_all[hit].tolist(), h[hit].view(np.int64).tolist()):
                k = int(text_of[p])
                said_here = said(p, p + n)
                one = held.setdefault((k, h, *said_here), {"print": h, "before": [], "words": said_here, "places": []})
                one["places"].append(p - int(head[k]))
            for (k, *_), one in held.items():
                found[k].append(one)
        return counts.tolist(), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        kind = pa.list_(pa.struct([("print", pa.int64()), ("before", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("places", pa.list_(pa.int32()))]))
        for b in slices(batches):
            data, offsets = texts_utf8(b.column(at))
            counts, found, a = [], [], 0
            while a < b.num_rows:
                z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PORTION, "right")) - 1)
                n, f = portion(hasher, data[offsets[a]:offsets[z]], offsets[a:z + 1] - offsets[a])
                counts += n
                found += f
                a = z
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(counts, pa.int64()), pa.array(found, kind)], names=[*b.schema.names, "_words", "_prints"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_words", T.LongType()), T.StructField("_prints", T.ArrayType(_PRINT))]))


def _common(a: Column, b: Column) -> Column:
    """Number of equal elements at the start of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def _covered(spans: Column) -> Column:
    """Number of places covered by the spans of a sorted array."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, lambda s, x: F.struct(
        F.greatest(s["end"], x["end"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).alias("n")), lambda s: s["n"])


def _bit_table(prints: DataFrame, count: int) -> np.ndarray:
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (count * BITS_PER_PRINT).bit_length()))
    bit = F.col("print").bitwiseAND(F.lit(bits - 1))
    rows = prints.select(F.shiftright(bit, 6).alias("slot"), F.expr(f"shiftleft(1L, cast(print & 63 as int))").alias("m")).groupBy("slot").agg(F.bit_or("m").alias("m")).toArrow()
    table = np.zeros(bits // 64, np.uint64)  # the query gave at most a row for each of its entries
    table[rows["slot"].to_numpy()] = rows["m"].to_numpy().view(np.uint64)
    return table


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, kgram: int = KGRAM) -> DataFrame:
    """One row per row of ``docs``: the id, ``text_key`` (a hash of the text), ``n_words``, ``spans`` (hit runs
    of words, ordered, ends exclusive) and ``items`` (the ids of the items that occur)."""
    tests = scan(items.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_text")), "_text", window, kgram, None, None)
    index = stored(tests.select("_item", F.least("_words", F.lit(window)).alias("_need"), F.explode("_prints").alias("p"))
                   .groupBy("p.print", F.col("p.before").alias("t_before"), F.col("p.words").alias("t_words"), "_need")
                   .agg(F.collect_set("_item").alias("_items")), "test-prints")
    short = [r[0] for r in index.filter(F.col("_need") < window).select("_need").distinct().collect()]  # under `window` numbers
    table = _bit_table(index.select("print").distinct(), index.count())
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("text_key"))
    rows = stored(scan(texts, "_text", window, kgram, short, table).drop("_text").withColumn("_row", F.monotonically_increasing_id()), "train-prints")
    none = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    item_type = index.schema["_items"].dataType
    clean = rows.filter(F.size("_prints") == 0).select("_id", "text_key", "_words", F.array().cast(none).alias("spans"), F.array().cast(item_type).alias("items"))
    met = (rows.filter(F.size("_prints") > 0).select("_row", "_id", "text_key", "_words", F.explode("_prints").alias("p"))
           .select("_row", "_id", "text_key", "_words", "p.*").join(index, "print", "left"))
    left, right = _common(F.col("before"), F.col("t_before")), _common(F.col("words"), F.col("t_words"))
    hit = met.withColumn("_l", left).withColumn("_r", right).withColumn("_hit", F.coalesce(F.col("_l") + F.col("_r") >= F.col("_need"), F.lit(False)))
    spans = F.when(F.col("_hit"), F.transform("places", lambda p: F.struct((p - F.col("_l")).alias("start"), (p + F.col("_r")).alias("end"))))
    hits = (hit.groupBy("_row", "_id", "text_key", "_words")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(spans)))).alias("spans"),
                 F.array_distinct(F.flatten(F.collect_set(F.when(F.col("_hit"), F.col("_items"))))).alias("items")))
    return clean.unionByName(hits.select(*clean.columns)).select(F.col("_id").alias(id_col), "text_key", F.col("_words").alias("n_words"), "spans", "items")


def contamination_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``contamination`` with spans and items as numbers and a hash."""
    n_hit = _covered(F.col("spans"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    found = contamination(docs, items, id_col, text_col, **options).filter(F.size("spans") > 0)
    gone = stored(found.select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_own"), F.xxhash64(text_col).alias("_own_key"))
    return rows.join(gone, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left_anti").select("_row.*")
