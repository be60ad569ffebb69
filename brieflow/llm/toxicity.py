"""Toxicity scores from averaged subword-bag embeddings and a linear softmax, trained jointly in numpy.

A text is the bag of the character n-grams (3 to 6) of its distinct lower-case words, a blank at each end of a
word counted as a character. Every n-gram is hashed to a row of the embedding table; a text's vector is the sum of its rows over
the root of their number (and of ``CALM`` more, so a few words do not speak louder than many): a mean that is damped for long texts, in which few
words decide. A linear softmax of that vector gives the classes. Misspelt words share most n-grams with their models, so they lie near them
without having been seen.

Table and softmax are trained jointly, text by text (AdaGrad). After each step a row is shrunk towards zero by ``SHRINK`` times its
own step (the proximal form of a penalty on the rows' lengths), so an n-gram speaks only if texts ask for it again and again: what stands in few
texts, or in both classes, falls to zero by evidence and not by a count. Classes weigh the same in total, so a missed toxic text costs
as much as many clean ones where toxic texts are rare.

The model is fitted in one task on a bounded sample of labelled rows, ``2 * PER_CLASS`` at most: the ``PER_CLASS`` toxic training ids of
least hash, and clean ones up to that number. Whole texts are turned into bags where they are; a bag has at most ``BUCKETS`` n-grams, however
long its text. Every document is then scored on its whole text: as the softmax is linear, a text's score needs only one number for
each n-gram, so a score is one pass over the text.

Defined cases: null counts as empty; an empty text scores the prior; several labels of an id count as toxic if
one is; null labels are no labels; without labels of both classes every text scores the smoothed prior (0.25
with no label at all), so nothing is rejected for lack of evidence; repeated rows and copies each get their score, and of rows with one labelled id
one is learned from; very long texts are scored whole; an empty table gives no rows; further columns, whatever their names, pass by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import slices

PER_CLASS = 1500
SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 18
#: n-grams of no meaning that count into every text's number
CALM = 50
#: scale of a text's vector, so that its rows learn at the pace of the softmax
SCALE = 20.0
WIDTH = 4
EPOCHS = 8
#: steps of the rows and of the softmax, and how much of a step a row is shrunk
STEP, HEAD_STEP, SHRINK = 0.1, 0.05, 0.01
#: characters of text that are scored at once (a longer text is a portion of its own)
PORTION = 1 << 18

_U = np.uint64


def pull(n):
    """Weight of one n-gram among ``n``."""
    return SCALE / np.sqrt(n + CALM)


def letters(text: str | None) -> np.ndarray:
    """Code points of the distinct lower-case words, one blank before, between and after them."""
    words = dict.fromkeys((text or "").lower().split())
    return np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), np.uint32) if words else np.zeros(0, np.uint32)


def subwords(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: where an n-gram starts and its bucket, at every place where no inner character is a blank."""
    wide = points.astype(np.uint64)
    blanks = np.concatenate([[0], np.cumsum(points == 32)])
    h = wide
    for n in range(2, max(SIZES) + 1):
        if len(wide) < n:
            return
        h = h[:len(wide) - n + 1] * _U(0x100000001B3) + wide[n - 1:]
        if n in SIZES:
            start = np.flatnonzero(blanks[n - 1:len(wide)] == blanks[1:len(wide) - n + 2])
            x = h[start]
            x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
            yield start, ((x >> _U(40)) & _U(BUCKETS - 1)).astype(np.int64)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the weight of each in its vector."""
    found = [b for _, b in subwords(letters(text))]
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at, n = np.unique(np.concatenate(found), return_counts=True)
    return at.astype(np.int32), (n * pull(n.sum())).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: list[int], seed: int = 7) -> np.ndarray:
    """One number for each bucket and, last, the constant: the logit of toxic is the constant plus the weighted sum
    over the n-grams. ``bags``: buckets and weights of each text."""
    y = np.array(toxic, np.int64)
    of_class = np.array([y.sum() / max((1 - y).sum(), 1), 1.0], np.float32)
    rng = np.random.default_rng(seed)
    # rows start at zero, so an n-gram that was never learned from says nothing
    table, seen = np.zeros((BUCKETS, WIDTH), np.float32), np.full(BUCKETS, 1e-6, np.float32)
    head, bias = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen_head, seen_bias = np.full_like(head, 1e-3), np.full_like(bias, 1e-3)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            at, weight = bags[i]
            rows = table[at]
            vector = weight @ rows
            z = vector @ head + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= of_class[y[i]]
            of_vector = head @ p
            seen[at] += weight * weight * (of_vector @ of_vector / WIDTH)
            step = STEP / np.sqrt(seen[at])
            rows -= (step * weight)[:, None] * of_vector
            length = np.sqrt((rows * rows).sum(axis=1)) + 1e-12
            table[at] = rows * np.maximum(0, 1 - step * SHRINK / length)[:, None]
            of_head = np.outer(vector, p)
            seen_head += of_head * of_head
            head -= HEAD_STEP * of_head / np.sqrt(seen_head)
            seen_bias += p * p
            bias -= HEAD_STEP * p / np.sqrt(seen_bias)
    return np.append(table @ (head[:, 1] - head[:, 0]), bias[1] - bias[0]).astype(np.float32)


def logits(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Logit of toxic for each text, each on its whole length."""
    out, held, size = np.full(len(texts), weights[-1], np.float64), [], 0

    def close() -> None:
        ends = np.cumsum([len(p) for _, p in held])
        points = np.concatenate([p for _, p in held])
        total, count = np.zeros(len(held)), np.zeros(len(held))
        for start, bucket in subwords(points):
            cuts = np.searchsorted(start, ends)
            sums = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])[cuts]
            total += np.diff(sums, prepend=0.0)
            count += np.diff(cuts, prepend=0)
        for (k, _), t, n in zip(held, total, count):
            out[k] += t * pull(n)

    for k, text in enumerate(texts):
        points = letters(text)
        if len(points):
            held.append((k, points))
            size += len(points)
        if size >= PORTION:
            close()
            held, size = [], 0
    if held:
        close()
    return out


def held_out(id_col: Column) -> Column:
    """True for the fifth of the ids whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _fit_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int) -> DataFrame:
    """Bags and labels to fit on, with the numbers of labelled training rows."""
    known = (labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic")).filter("_toxic is not null and _id is not null")
             .filter(~held_out(F.col("_id"))).groupBy("_id").agg((F.max("_toxic") > 0).cast("int").alias("_toxic")))
    known = known.withColumn("_order", F.xxhash64("_id", F.lit(11)))
    counts = known.agg(F.coalesce(F.sum("_toxic"), F.lit(0)).alias("ones"), F.count("*").alias("rows")).first()
    ones = min(counts["ones"], per_class)
    chosen = [known.filter(F.col("_toxic") == c).orderBy("_order", "_id").limit(n) for c, n in ((0, 2 * per_class - ones), (1, ones))]
    chosen = chosen[0].unionByName(chosen[1])  # at most 2 * per_class rows
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = texts.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]).select("_order", "_id", "_toxic", "_text")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            own = [bag(t) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array([x[k].tobytes() for x in own], pa.binary()) for k in (0, 1))],
                                             names=["_order", "_id", "_toxic", "_at", "_weight"])

    schema = T.StructType([*found.schema.fields[:3], T.StructField("_at", T.BinaryType()), T.StructField("_weight", T.BinaryType())])
    return found.mapInArrow(bags, schema).withColumns({"_task": F.lit(0), "_ones": F.lit(counts["ones"]), "_all": F.lit(counts["rows"])})


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> np.ndarray:
    """Weights of the model (see ``fit``), learned in one task from the bounded sample."""

    def learn(t: pa.Table) -> pa.Table:
        t = t.sort_by([("_order", "ascending"), ("_id", "ascending")])
        toxic = t["_toxic"].to_pylist()
        ones, rows = t["_ones"][0].as_py(), t["_all"][0].as_py()
        bags = [(np.frombuffer(a, np.int32), np.frombuffer(w, np.float32)) for a, w in zip(t["_at"].to_pylist(), t["_weight"].to_pylist())]
        weights = fit(bags, toxic) if len(set(toxic)) == 2 else _prior_only((ones + 0.5) / (rows + 2))
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary())})

    rows = _fit_sample(docs, labels, id_col, text_col, per_class).groupBy("_task").applyInArrow(learn, "weights binary").collect()
    return np.frombuffer(rows[0]["weights"], np.float32) if rows else _prior_only(0.25)


def _prior_only(share: float) -> np.ndarray:
    return np.append(np.zeros(BUCKETS), np.log(share / (1 - share))).astype(np.float32)


def score_texts(docs: DataFrame, weights: np.ndarray, text_col: str = "text", name: str = "_score") -> DataFrame:
    """``docs`` with the probability of toxic."""
    shared, at = docs.sparkSession.sparkContext.broadcast(weights), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            z = logits(b.column(at).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=[*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score`` and ``predicted``."""
    weights = fit_model(docs, labels, id_col, text_col, per_class)
    scored = score_texts(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), weights, "_text").drop("_text")
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that score under 0.5, with all their columns."""
    weights = fit_model(docs, labels, id_col, text_col, per_class)
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"))
    return score_texts(packed, weights, "_text").filter("_score < 0.5").select("_row.*")
