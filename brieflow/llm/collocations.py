"""Phrase collocation mining by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line breaks, and pieces into words at blanks and tabs. A portion of
texts is one byte array: prefix polynomials over its bytes give every word's hash as a difference of two sums, prefix polynomials
over the words' hashes give every n-gram's fingerprint (with its length and language in it) alike, all in numpy.

Counting goes by length. A task sorts its fingerprints and sends each once with its count, as packed blocks by range of fingerprints; the
shuffle adds the ranges up and keeps what may be frequent. An n-gram is only sent if both of its (n-1)-grams may be frequent, which a
bit table of the shorter length tells (a false yes costs a sent fingerprint). Tables are sized by what they hold; above ``MOST_BITS`` bits the
fingerprints are cut into shards by range, each with its own table and its own pass over the texts, so no table grows with the corpus.

The last pass materialises frequent phrases only: in each portion every fingerprint that may be frequent points to its first occurrence, all its
other occurrences are compared with that one byte by byte (those that differ, a collision, point to a first one of their own), and the phrase's text is
taken from the pointer once. Texts and exact counts travel as blocks again and are summed by (lang, phrase), so fingerprints decide what is looked at and never what is counted.

Scores: each candidate of n >= 2 words is cut after each of its first n-1 words; l and r are the counts of the parts, which are frequent
as they occur wherever the candidate does. Arithmetic is in decimals of 38 digits: a, l, r below 10^15 and n below 10^16 are exact.
A candidate inside a longer one that holds (nearly) all of its occurrences is dropped; comparing with phrases of one word more
is enough, as a phrase between the two is at least as frequent as the longer one.

Defined cases: null text is empty, a null language counts as ``und``; repeated rows (and null or equal ids, which are not read) count as often as they
occur; very long texts are read in portions that end where a piece ends; ties rank by count, then by phrase in UTF-8 order; an empty table gives no
rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brieflow.llm.common import slices, stored, texts_utf8

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: kinds of bytes: 0 part of a word, 1 blank, 2 end of a piece
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\v\f\r")] = 2
#: bytes of text that are hashed at once (a longer piece is a portion of its own)
PORTION = 1 << 19
#: fingerprints that a task gathers before it sends them
HELD = 1 << 20
#: phrases that a task gathers before it sends them
HELD_PHRASES = 1 << 18
#: fingerprints (about) that a task adds up at once
PART_SIZE = 1 << 22
#: bits of a table for each fingerprint in it, and the most that a table has (32 MiB, broadcast)
BITS_PER_KEY = 32
MOST_BITS = 1 << 28
#: a fingerprint's places in a table are the upper bits of its products with these (a false yes: one in 5,000 at most)
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

_U = np.uint64
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_STEP, _STEP_INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


class BitTable(NamedTuple):
    """Which fingerprints of ``words`` words may be frequent, for those in shard ``shard`` of ``shards`` (by range)."""

    words: int
    shard: int
    shards: int
    bits: np.ndarray

    def inside(self, keys: np.ndarray) -> np.ndarray:
        return _range_of(keys, self.shards) == self.shard

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each fingerprint (of this shard) may be frequent."""
        held = np.ones(len(keys), bool)
        for p in _places(keys, len(self.bits) * 8):
            held &= ((self.bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).astype(bool)
        return held


def _places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for factor in PLACES:
        yield _range_of(keys * _U(factor), bits)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Which of ``ranges`` (a power of two) equal ranges each fingerprint lies in."""
    bits = ranges.bit_length() - 1
    return (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Portion:
    """Words of some texts and the fingerprints of their n-grams."""

    def __init__(self, texts: list[bytes], langs: list[int]):
        """``langs``: a number for each text's language, the same in every task."""
        raw = np.frombuffer((b"\n".join(texts) + b"\n").translate(LOWER), np.uint8)
        kind = KIND[raw]
        word = kind == 0
        after = np.zeros(len(raw), bool)
        after[1:] = word[:-1] & ~word[1:]
        start, end = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]])), np.flatnonzero(after)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.size = end - start
        # the words once more with one blank after each, so that a phrase is a run of bytes
        self.text = np.where(after, np.uint8(32), raw)[word | after]
        self.at = np.cumsum(self.size + 1) - self.size - 1
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, start, "right")
        self.lang = np.array(langs, np.uint64)[self.doc] if len(start) else np.zeros(0, np.uint64)
        terms = _powers(_BASE, len(self.text))
        terms *= self.text.astype(np.uint64) + _U(1)
        sums = np.zeros(len(self.text) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        own = _mix((sums[self.at + self.size] - sums[self.at]) * _powers(_BASE_INVERSE, len(self.text) + 1)[self.at] + self.size.astype(np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * _powers(_STEP, len(own)), dtype=np.uint64)])
        self.back = _powers(_STEP_INVERSE, len(own) + 1)

    def grams(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie within a piece."""
        last = len(self.size) - n
        if last < 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[n - 1:] == self.piece[:last + 1])

    def keys(self, at: np.ndarray, n: int) -> np.ndarray:
        return _mix((self.sums[at + n] - self.sums[at]) * self.back[at] + self.lang[at] * _U(2 * n + 1))

    def span(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the bytes of n-grams begin, and how many they are."""
        begin = self.at[at]
        return begin, self.at[at + n - 1] + self.size[at + n - 1] - begin

    def phrases(self, at: np.ndarray, n: int, keys: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word of the first occurrence, occurrences) of each distinct phrase among the n-grams at ``at``."""
        while len(at):
            _, first, own, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            same = _equal_bytes(self.text, *self.span(at, n), *(x[own] for x in self.span(at[first], n))) & (self.lang[at] == self.lang[at[first]][own])
            count = count - np.bincount(own[~same], minlength=len(first))
            yield from zip(at[first].tolist(), count.tolist())
            at, keys = at[~same], keys[~same]


def _equal_bytes(text: np.ndarray, a: np.ndarray, size: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the runs of bytes at ``a`` and at ``b`` are equal."""
    same = size == size_b
    long = np.where(same, size, 0)
    where = np.arange(int(long.sum())) - np.repeat(np.cumsum(long) - long, long)
    differ = text[np.repeat(a, long) + where] != text[np.repeat(b, long) + where]
    same[np.repeat(np.arange(len(a)), long)[differ]] = False
    return same


def _lang_number(lang: str) -> int:
    import hashlib
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _cut(body: bytes) -> Iterator[bytes]:
    """A text in portions that end where a piece ends."""
    at = 0
    while len(body) - at > PORTION:
        kinds = np.flatnonzero(KIND[np.frombuffer(body, np.uint8, PORTION, at)] == 2)
        if len(kinds):
            end = at + int(kinds[-1]) + 1
        else:  # a piece longer than a portion
            kinds = np.flatnonzero(KIND[np.frombuffer(body, np.uint8, -1, at)] == 2)
            end = at + int(kinds[0]) + 1 if len(kinds) else len(body)
        yield body[at:end]
        at = end
    if at < len(body):
        yield body[at:]


def portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Portion, list[str]]]:
    """Portions of the rows (lang, text), with the language of each text in it."""
    texts: list[bytes] = []
    langs: list[str] = []
    numbers: dict[str, int] = {}
    held = 0
    for b in slices(batches):
        data, at = texts_utf8(b.column(1))
        for k, lang in enumerate(b.column(0).to_pylist()):
            for body in _cut(data[at[k]:at[k + 1]].tobytes()):
                if held + len(body) > PORTION and held:
                    yield Portion(texts, [numbers[x] for x in langs]), langs
                    texts, langs, held = [], [], 0
                if lang not in numbers:
                    numbers[lang] = _lang_number(lang)
                texts.append(body)
                langs.append(lang)
                held += len(body) + 1
    if held:
        yield Portion(texts, [numbers[x] for x in langs]), langs


def _sum_keys(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[cuts], np.add.reduceat(counts, cuts) if len(cuts) else counts


def frequent_keys(texts: DataFrame, n: int, table: BitTable | None, parts: int, least: int) -> DataFrame:
    """Blocks (``part``, ``keys``) of the fingerprints of ``n`` words that occur ``least`` times, ascending.

    ``table`` tells the frequent fingerprints of a word less; only n-grams whose first words lie in its shard are counted."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def send(held: list) -> pa.RecordBatch:
        keys, counts = _sum_keys(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        part = _range_of(keys, parts)
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = np.append(cuts[1:], len(keys))
        once = counts == 1
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part[cuts], pa.int64()),
            "once": pa.array([keys[a:b][once[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "more": pa.array([keys[a:b][~once[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            "counts": pa.array([counts[a:b][~once[a:b]].tobytes() for a, b in zip(cuts, ends)], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, shared.value
        for p, _ in portions(batches):
            at = p.grams(n)
            if known is not None:
                first, last = p.keys(at, n - 1), p.keys(at + 1, n - 1)
                keep = known.inside(first)
                keep[keep] = known.holds(first[keep])
                check = keep & known.inside(last)
                keep[check] = known.holds(last[check])
                at = at[keep]
            if not len(at):
                continue
            keys, counts = np.unique(p.keys(at, n), return_counts=True)
            held.append((keys, counts.astype(np.int64)))
            size += len(keys)
            if size >= HELD:
                held = [_sum_keys(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
                size = len(held[0][0])
                if size >= HELD // 2:
                    yield send(held)
                    held, size = [], 0
        if size:
            yield send(held)

    def add(t: pa.Table) -> pa.Table:
        once, more, counts = (np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in (("once", np.uint64), ("more", np.uint64), ("counts", np.int64)))
        keys, sums = _sum_keys(np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), counts]))
        keys = keys[sums >= least]
        rows = [keys.tobytes()] if len(keys) else []
        return pa.table({"part": t["part"][:len(rows)], "keys": pa.array(rows, pa.binary())})

    blocks = texts.mapInArrow(count, "part long, once binary, more binary, counts binary").groupBy("part").applyInArrow(add, "part long, keys binary")
    return stored(blocks, f"frequent-{n}")


def bit_tables(blocks: DataFrame, n: int, most_bits: int) -> Iterator[BitTable]:
    """The tables of the fingerprints in ``blocks``, one after another. Bits are set where the blocks are: a task sends the places
    (4 bytes each) of one shard, so the driver only ever holds one table of at most ``most_bits`` bits."""
    held = blocks.agg(F.coalesce(F.sum(F.length("keys")), F.lit(0))).first()[0] // 8
    if not held:
        return
    bits = 1 << (held * BITS_PER_KEY - 1).bit_length()
    shards = max(1, bits // most_bits)
    bits = min(bits, most_bits)
    for shard in range(shards):
        def places(batches: Iterator[pa.RecordBatch], shard: int = shard) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for body in b.column(0).to_pylist():
                    keys = np.frombuffer(body, np.uint64)
                    keys = keys[_range_of(keys, shards) == shard]
                    at = np.unique(np.concatenate(list(_places(keys, bits)))).astype(np.uint32)
                    if len(at):
                        yield pa.RecordBatch.from_pydict({"at": pa.array([at.tobytes()], pa.binary())})

        table = np.zeros(bits // 8, np.uint8)
        for row in blocks.select("keys").mapInArrow(places, "at binary").toLocalIterator():
            at = np.frombuffer(row["at"], np.uint32).astype(np.int64)
            np.bitwise_or.at(table, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        yield BitTable(n, shard, shards, table)


def phrase_counts(texts: DataFrame, tables: list[BitTable], parts: int, with_total: bool) -> DataFrame:
    """Blocks (``part``, ``lang``, ``words``, ``phrase``, ``f``) of partial counts of the phrases that ``tables`` hold, by a range of
    the phrases' checksums; ``words`` 0 counts all word occurrences of a language."""
    shared = texts.sparkSession.sparkContext.broadcast(tables)

    def send(held: dict) -> pa.RecordBatch:
        part = np.array([crc32(phrase) & (parts - 1) for _, _, phrase in held])
        order = np.argsort(part, kind="stable")
        part = part[order]
        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = pa.array(np.append(cuts, len(part)), pa.int32())
        lang, words, phrase = zip(*held)
        columns = [pa.array(lang, pa.string()), pa.array(words, pa.int32()), pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())]
        lists = [pa.ListArray.from_arrays(ends, c.take(pa.array(order))) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(part[cuts], pa.int64()), *lists], names=["part", "lang", "words", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for p, langs in portions(batches):
            if with_total:
                for k, n in zip(*(x.tolist() for x in np.unique(p.doc, return_counts=True))):
                    held[langs[k], 0, b""] = held.get((langs[k], 0, b""), 0) + n
            body = p.text.tobytes()
            for t in shared.value:
                at = p.grams(t.words)
                keys = p.keys(at, t.words)
                keep = t.inside(keys)
                keep[keep] = t.holds(keys[keep])
                for first, n in p.phrases(at[keep], t.words, keys[keep]):
                    last = first + t.words - 1
                    key = langs[p.doc[first]], t.words, body[p.at[first]:p.at[last] + p.size[last]]
                    held[key] = held.get(key, 0) + n
                if len(held) >= HELD_PHRASES:
                    yield send(held)
                    held = {}
        if held:
            yield send(held)

    return texts.mapInArrow(run, "part long, lang array<string>, words array<int>, phrase array<string>, f array<long>")


def _sum_phrases(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, words, phrase, f): the blocks' counts added up, of phrases that occur ``least`` times."""

    def add(t: pa.Table) -> pa.Table:
        names = ["lang", "words", "phrase", "f"]
        whole = pa.table([pa.chunked_array([c.flatten() for c in t[n].chunks]) for n in names], names=names)
        whole = whole.group_by(names[:3]).aggregate([("f", "sum")]).select(["lang", "words", "phrase", "f_sum"]).rename_columns(names)
        return whole.filter((pc.field("f") >= least) | (pc.field("words") == 0))

    return blocks.groupBy("part").applyInArrow(add, "lang string, words int, phrase string, f long")


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = 5, least: int = 100,
                     most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, words, phrase, f): every phrase of up to ``most_words`` words that occurs at least ``least`` times in its language,
    with its exact count; ``words`` 0 holds the number of all word occurrences of a language."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 << max(6, (size // (6 * PART_SIZE)).bit_length())  # about six bytes a word
    tables: list[BitTable] = []
    counted = []
    room = most_bits

    def gather(t: BitTable) -> None:
        """Tables share the last passes as far as they fit into ``most_bits`` together."""
        nonlocal room, tables
        if tables and len(t.bits) * 8 > room:
            counted.append(phrase_counts(texts, tables, parts, not counted))
            tables, room = [], most_bits
        tables.append(t)
        room -= len(t.bits) * 8

    blocks = frequent_keys(texts, 1, None, parts, least)
    for n in range(1, most_words + 1):
        longer = None
        for t in bit_tables(blocks, n, most_bits):
            gather(t)
            if n < most_words:
                found = frequent_keys(texts, n + 1, t, parts, least)
                longer = found if longer is None else longer.unionByName(found)
        if longer is None:
            break
        blocks = longer
    counted.append(phrase_counts(texts, tables, parts, not counted))
    whole = counted[0]
    for c in counted[1:]:
        whole = whole.unionByName(c)
    return stored(_sum_phrases(whole, least), "phrases")


def _words(phrase: str, n: Column) -> Column:
    """The first ``n`` words of a phrase, or the last ones if ``n`` is negative."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), n)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most_words: int = 5, least: int = 100, top: int = 2000,
                 swallowed: int = 100, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language (see above). A phrase inside a longer
    candidate with at least ``swallowed`` percent of its occurrences is dropped."""
    found = frequent_phrases(docs, lang_col, text_col, most_words, least, most_bits)
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    known = found.filter("words > 0").select("lang", "phrase", "f")
    longer = found.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    # a phrase of one word more holds this one at its beginning or at its end
    inner = longer.filter("words > 2").select("lang", "a", F.explode(F.array(
        _words("phrase", F.col("words") - 1), _words("phrase", 1 - F.col("words")))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    candidates = longer.join(inner, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("most") < swallowed * F.col("a"), F.lit(True)))
    cuts = candidates.select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": _words("phrase", F.col("k")), "right": _words("phrase", F.col("k") - F.col("words"))})
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang"))
    a, left, right, n = (F.col(c).cast(f"decimal({d},0)") for c, d in (("a", 15), ("l", 15), ("r", 15), ("n", 16)))
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (a * n), left * right)
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
