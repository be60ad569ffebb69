"""Information-theoretic sanitisation of personal data.

Personal data of fixed form (mail and IP addresses, card and phone numbers) are found by their patterns; these
are the protected entities. A term discloses an entity if the corpus shows them together: with probabilities as
shares of distinct texts, the pointwise mutual information ``log p(entity, term) / (p(entity) p(term))`` is
what reading the term tells of the entity, and the entity's own information ``-log p(entity)`` is all there is to
tell. A term is sensitive if for some entity the part told reaches ``DISCLOSED``. How often the entity stands
where the term does is an estimate from few texts, so its lower confidence bound (Wilson's, ``SURE`` standard
errors) is used: a pair seen once or twice is judged like any other, and tells less than one seen often. Sensitive
terms get a span of kind ``term`` wherever they stand, also in texts without the entity. Sanitising a text replaces
base spans by their kind (generalisation) and removes the sensitive terms, which have no general form.

An entity and a term are together where one text holds both, at any distance. Entities that stand in the same texts
tell the same, so pairs are made for each such class. As the bound is at most one, only terms of at most
``places ** (1 - DISCLOSED) * texts of the class ** DISCLOSED`` texts can reach it; others need no pair. A bit table
picks out the asked terms while the texts are read, and a join settles which of them are meant.

Defined cases: null text is empty, without spans; repeated rows each get a row; spans count code points, ends are
exclusive; equal starts are ordered email, ip, card, phone, term; a word that touches a base span is no term;
very long texts are read whole; a null id gives its row all the same; an empty table gives no rows; further columns, whatever their names, are not read
(``sanitise`` keeps them).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import attach_groups, slices, stored

KINDS = ["email", "ip", "card", "phone"]
DISCLOSED = 0.8
#: one-sided confidence of 95 %
SURE = 1.645
#: bits of a table: at least so many, and ``BITS_EACH`` times the terms up to the largest
TABLE_BITS = 1 << 24
BITS_EACH = 64
MOST_BITS = 1 << 28
BITS_OF_TERM = 4
#: distinct terms that a task counts before it sends them on
HELD_TERMS = 1 << 18

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match of these starts at the head of a run of digits, as the one before took its last run whole
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    """Check sum of a card number: every second digit from the right is doubled, digits of results added."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all personal data of fixed form, in order."""
    found = []
    taken = 0
    mark = text.find("@")
    while mark >= 0:
        start = mark
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, mark + 1) if start < mark else None
        if domain:
            taken = domain.end()
            found.append((start, 0, taken))
        mark = text.find("@", max(mark + 1, taken))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def _free(text: str, spans: list[tuple[int, int, int]]) -> Iterator[re.Match]:
    """Words of ``text`` that touch no span, in order."""
    reached, at = list(accumulate((z for _, _, z in spans), max)), 0
    for m in _WORD.finditer(text):
        while at < len(spans) and reached[at] <= m.start():
            at += 1
        # the spans from ``at`` on that start before the word ends; ``reached`` may stem from an earlier one
        if not any(s < m.end() and m.start() < z for s, _, z in spans[at:bisect_left(spans, (m.end(),))]):
            yield m


def _places_of(term: str, bits: int) -> list[int]:
    """The ``BITS_OF_TERM`` bits of a term. With one bit each, the terms let through by mistake would grow with the
    number of asked terms times the number of words read."""
    h = xxhash.xxh128_intdigest(term, 5)
    return [h >> 32 * k & (bits - 1) for k in range(BITS_OF_TERM)]


def _all_set(table: np.ndarray, bits: int, term: str) -> bool:
    return all(table[p >> 3] >> (p & 7) & 1 for p in _places_of(term, bits))


_FOUND = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_PLACES = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _entity(text: str, span: tuple[int, int, int]) -> str:
    said = text[span[0]:span[2]]
    return f"{KINDS[span[1]]}:{said.lower() if span[1] < 2 else ''.join(_DIGIT.findall(said))}"


def find_entities(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` without the text but with its distinct entities (``_entities``) and, where there are any, its
    distinct terms (``_words``)."""
    at, kept = docs.columns.index(text_col), [c for c in docs.columns if c != text_col]
    strings = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            entities, words = [], []
            for text in b.column(at).to_pylist():
                spans = base_spans(text or "")
                entities.append(sorted({_entity(text, s) for s in spans}))
                words.append(sorted({m.group().lower() for m in _free(text, spans)}) if spans else [])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(entities, strings), pa.array(words, strings)], names=[*kept, "_entities", "_words"])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("_entities", T.ArrayType(T.StringType())), T.StructField("_words", T.ArrayType(T.StringType()))]))


def find_places(docs: DataFrame, text_col: str, table: np.ndarray) -> DataFrame:
    """``docs`` without the text but with its base spans (``_spans``) and all places of terms whose bits are set in
    the table (``_places``)."""
    at, kept = docs.columns.index(text_col), [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(table)
    spans_of = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    places_of = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _Asked(shared.value)
        for b in slices(batches):
            all_spans, all_places = [], []
            for text in b.column(at).to_pylist():
                text = text or ""
                spans, places = base_spans(text), []
                if not asked.words(text).isdisjoint(asked.hits):
                    for m in _free(text, spans):
                        term = m.group().lower()
                        if asked(term):
                            places.append({"term": term, "start": m.start(), "end": m.end()})
                all_spans.append([{"start": a, "kind": k, "end": z} for a, k, z in spans])
                all_places.append(places)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(all_spans, spans_of), pa.array(all_places, places_of)], names=[*kept, "_spans", "_places"])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("_spans", _FOUND), T.StructField("_places", _PLACES)]))


class _Asked:
    """Whether the bits of terms are set, with the answers for some terms at hand."""

    def __init__(self, table: np.ndarray):
        self.table, self.bits = table, len(table) * 8
        self.hits: set[str] = set()
        self.others: set[str] = set()

    def __call__(self, term: str) -> bool:
        if term in self.others:
            return False
        if term in self.hits:
            return True
        hit = _all_set(self.table, self.bits, term)
        (self.hits if hit else self.others).add(term)
        return hit

    def words(self, text: str) -> set[str]:
        """The distinct terms of a text, all of them asked."""
        if len(self.hits) + len(self.others) > HELD_TERMS:
            self.hits.clear()
            self.others.clear()
        found = {w.lower() for w in set(_WORD.findall(text))}
        for w in found - self.others:
            self(w)
        return found


def _term_counts(texts: DataFrame, text_col: str, table: np.ndarray) -> DataFrame:
    """Number of rows with each term whose bits are set in the table (``term``, ``in_docs``)."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, held = _Asked(shared.value), Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"term": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for b in slices(batches):
            for text in b.column(0).to_pylist():
                held.update(asked.words(text or "") & asked.hits)
                if len(held) > HELD_TERMS:
                    yield batch()
                    held.clear()
        yield batch()

    return texts.select(text_col).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("in_docs"))


def _once(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Each distinct text of ``texts`` (with ``_key``) once. Only texts whose key has copies are shuffled, and the few
    whose key has its bits set by others. ``keys``: ``_key`` with its number of rows, ``n``."""
    copied = keys.filter("n > 1").select("_key")
    shared, at = texts.sparkSession.sparkContext.broadcast(_table(copied.select(F.col("_key").cast("string")))), texts.columns.index("_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bits = shared.value, len(shared.value) * 8
        for b in batches:
            marks = [_all_set(own, bits, str(k)) for k in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(marks, pa.bool_())], names=[*b.schema.names, "_copied"])

    marked = texts.mapInArrow(run, T.StructType([*texts.schema.fields, T.StructField("_copied", T.BooleanType())]))
    return marked.filter("not _copied").unionByName(marked.filter("_copied").dropDuplicates(["_key"])).drop("_copied")


def _table(terms: DataFrame) -> np.ndarray:
    """Bits of distinct terms. Positions that are set are gathered on the executors; at most one for each 64 bits arrives."""
    bits = max(TABLE_BITS, min(MOST_BITS, 1 << (BITS_EACH * terms.count()).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"at": pa.array([p for t in b.column(0).to_pylist() for p in _places_of(t, bits)], pa.int64())})

    slots = (terms.mapInArrow(place, "at long").groupBy(F.shiftright("at", 6).alias("slot"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("m")).toArrow())
    table = np.zeros(bits // 64, np.int64)
    table[slots["slot"].to_numpy()] = slots["m"].to_numpy()
    return table.view(np.uint8)


def _at_least(hits: Column, n: Column, sure: float) -> Column:
    """Wilson's lower confidence bound of a share of which ``hits`` of ``n`` are seen."""
    p, z2 = hits / n, sure * sure
    return (p + z2 / (2 * n) - sure * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _classes(entities: DataFrame) -> DataFrame:
    """``_key`` and the classes of its entities: ``class``, with ``n_entity``, the number of its texts. Entities are of
    one class if they stand in the same texts."""
    sizes = entities.groupBy("entity").agg(F.count("*").alias("n_entity"), F.bit_xor(F.xxhash64("_key", F.lit(1))).alias("x"), F.bit_xor(F.xxhash64("_key", F.lit(2))).alias("y"))
    sizes = stored(sizes.select("entity", "n_entity", F.struct("n_entity", "x", "y").alias("class")), "entities")
    return attach_groups(entities, sizes, "entity", "n_entity", entities.count()).select("_key", "class", "n_entity").distinct()


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str, disclosed: float = DISCLOSED, sure: float = SURE) -> DataFrame:
    """The sensitive terms (``term``) with ``told``, the largest share of an entity's information that one tells.
    Every number is one of distinct texts, so copies and the layout of the table change nothing."""
    held = stored(found.filter(F.size("_entities") > 0).select("_key", "_entities", "_words").dropDuplicates(["_key"]), "with-entities")
    if held.isEmpty():  # nothing to count over the corpus
        return held.select(F.lit("").alias("term"), F.lit(0.0).alias("told"))
    keys = stored(found.groupBy("_key").agg(F.count("*").alias("n")), "keys")
    classes = stored(_classes(stored(held.select("_key", F.explode("_entities").alias("entity")), "entity-texts")), "classes")
    words = held.select("_key", F.explode("_words").alias("term"))
    counts = stored(_term_counts(_once(docs.select(text_col, "_key"), keys), text_col, _table(stored(words.select("term").distinct(), "asked-terms"))), "term-counts")
    places = float(keys.count())
    # a common term's rows are not dealt to one task
    rare = attach_groups(words, counts, "term", "in_docs", counts.agg(F.coalesce(F.sum("in_docs"), F.lit(0))).first()[0])
    limits = classes.withColumn("_most", F.pow(F.lit(places), F.lit(1 - disclosed)) * F.pow(F.col("n_entity"), F.lit(disclosed)) * 1.000001)
    rare, limits = rare.alias("w"), limits.alias("c")
    pairs = (rare.join(limits, (F.col("w._key") == F.col("c._key")) & (F.col("w.in_docs") <= F.col("c._most")))
             .groupBy("c.class", "w.term").agg(F.count("*").alias("n_both"), F.first("c.n_entity").alias("n_entity"), F.first("w.in_docs").alias("in_docs")))
    # a term stands in at least as many texts as it was seen with the entity
    own = F.greatest("in_docs", "n_both").cast("double")
    pmi = F.log(_at_least(F.col("n_both").cast("double"), own, sure) * F.lit(places) / F.col("n_entity"))
    all_of_it = F.log(F.lit(places) / F.col("n_entity"))
    told = F.when(all_of_it > 0, pmi / all_of_it).otherwise(F.lit(0.0))
    return pairs.withColumn("told", told).filter(F.col("told") >= disclosed).groupBy("term").agg(F.max("told").alias("told"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosed: float = DISCLOSED, sure: float = SURE) -> DataFrame:
    """One row per row of ``docs``: the id, ``text_key`` (a hash of the text), and the ordered ``spans`` (``start``,
    ``rank``, ``kind``, ``end``)."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_key"))
    found = stored(find_entities(texts.select("_text", "_key"), "_text"), "entities-of-texts")
    sensitive = stored(disclosing_terms(found, texts, "_text", disclosed, sure).select("term"), "sensitive")
    placed = stored(find_places(texts, "_text", _table(sensitive)).withColumn("_row", F.monotonically_increasing_id()), "personal-data")
    asked = placed.select("_row", F.explode("_places").alias("p")).select("_row", "p.*")
    # every term that the table let through, with its number of places and whether it is meant
    meant = stored(asked.groupBy("term").agg(F.count("*").alias("n")).join(sensitive.withColumn("_meant", F.lit(True)), "term", "left"), "asked")
    total = meant.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    terms = (attach_groups(asked, meant, "term", "n", total).filter("_meant").groupBy("_row")
             .agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), "end")).alias("_terms")))
    kinds = F.array(*map(F.lit, KINDS))
    base = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("rank"), F.get(kinds, s["kind"]).alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    plain = placed.filter(F.size("_places") == 0).select("_id", "_key", base.alias("spans"))
    rest = (placed.filter(F.size("_places") > 0).join(terms, "_row", "left")
            .select("_id", "_key", F.array_sort(F.concat(base, F.coalesce("_terms", none))).alias("spans")))
    return plain.unionByName(rest).select(F.col("_id").alias(id_col), F.col("_key").alias("text_key"), "spans")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "sanitised", **options) -> DataFrame:
    """``docs`` with the text in which base spans are generalised to ``<kind>`` and sensitive terms are removed."""
    found = personal_data(docs, id_col, text_col, **options).filter(F.size("spans") > 0)
    hits = stored(found.select(F.col(id_col).alias("_id"), F.col("text_key").alias("_key"), "spans").dropDuplicates(["_id", "_key"]), "to-sanitise")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_own"), F.xxhash64(text_col).alias("_own_key"), F.col(text_col).alias("_text"))
    joined = rows.join(hits, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left")

    @F.pandas_udf("string")
    def rewrite(text, spans):
        out = []
        for t, found_here in zip(text, spans):
            if t is None or found_here is None:
                out.append(t)
                continue
            parts, at = [], 0
            for s in found_here:
                if s["start"] >= at:
                    parts += [t[at:s["start"]], "" if s["kind"] == "term" else f"<{s['kind']}>"]
                at = max(at, s["end"])
            out.append("".join([*parts, t[at:]]))
        return text.__class__(out, index=text.index, dtype=object)

    return joined.select("_row.*", rewrite("_text", "spans").alias(name))


def personal_data_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``personal_data`` with the number of base spans by kind, their hash, and all spans as text."""

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["rank"] < len(KINDS))
    return found.select(id_col, *map(number, KINDS), F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
