"""BPE encoding and decoding with a minimal acyclic transducer for frequent words.

The corpus's most frequent pre-tokens are compiled into a minimal acyclic automaton: states with equal futures
are one state, so words share suffixes as well as prefixes. Every edge carries the number of words that sort
before it among those that leave its state; the sum along a word's path is the word's number, and a table gives
the ids of each number. The compiled lexicon is one file, shipped once to each executor and memory-mapped by
its workers. Words that it lacks are merged exactly: again and again the pair of lowest rank, leftmost first.
What the lexicon holds changes the speed only, never an id.

The vocabulary is a parameter: a BPE file of the tokenizers library with word ends, whose normaliser is NFC and
lower case, and whose special strings are found in the raw text.

Defined cases: null text is empty, with no tokens and an empty decoded text; repeated rows, and rows with a
null id, each get a row; very long texts are encoded whole; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import sys
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from brieflow.llm.common import slices

#: words in the lexicon, and how often a task must have met a word to name it for the lexicon
LEXICON_WORDS = 1 << 15
LEAST_IN_TASK = 8
#: distinct words that a task counts, and keeps the ids of, before it starts anew
COUNTED_WORDS = 1 << 17
HELD_WORDS = 1 << 19
#: words of more bytes are merged by a heap
LONG_WORD = 48

#: The pre-token pattern of the vocabulary's file.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_BEYOND = re.compile("[^\x00-\u0377]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_NO_MERGE = 1 << 60


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + i) for i, b in enumerate(hidden)})
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=4)
def _library_rules(spec: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(spec)


class WordBPE:
    """Merges, pre-tokens and token strings of one vocabulary file."""

    def __init__(self, spec: dict) -> None:
        vocab = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        letters = byte_letters()
        self.plain = [vocab[c] for c in letters]
        self.final = [vocab[c + end] for c in letters]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        # of each pair, one number that sorts by rank and ends with the new id
        self.merges = {(vocab[a], vocab[b]): rank << 24 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.pattern = regex.compile(PRE_TOKEN)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.marks = {s[:2] for s in self.special}
        self.normal_form = json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []})

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens in order, special strings among them as they are."""
        if self.specials is None or not any(m in text for m in self.marks):
            return self._plain_pre_tokens(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += self._plain_pre_tokens(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._plain_pre_tokens(text[at:])

    def normal(self, text: str) -> str | None:
        """NFC and lower case; None if the text has characters that Python's Unicode tables lack."""
        if not text.isascii():
            # these tables know every character up to there
            if _BEYOND.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
                return None
            # each character is lowered by itself, so a sigma at a word's end stays an ordinary one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _plain_pre_tokens(self, text: str) -> list[str]:
        normal = self.normal(text)
        return self._newer_pre_tokens(text) if normal is None else self.pattern.findall(normal)

    def pieces(self, text: str) -> list[str] | None:
        """The normal text between white space, which no pre-token crosses; None for the rare text that has to be
        split as a whole (special strings, newer characters, separators that only Python takes for white space)."""
        if self.specials is not None and any(m in text for m in self.marks) or _SEPARATORS.search(text):
            return None
        normal = self.normal(text)
        return None if normal is None else normal.split()

    def _newer_pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of the rare text whose characters are newer than Python's tables, by the library's own tables."""
        rules = _library_rules(self.normal_form)
        data = {c: b for b, c in enumerate(byte_letters())}
        found = rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(text))
        return [bytes(data[c] for c in w).decode() for w, _ in found]

    def encode_word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        ids = [self.plain[b] for b in data[:-1]]
        ids.append(self.final[data[-1]])
        return self._merge_long(ids) if len(ids) > LONG_WORD else self._merge(ids)

    def _merge(self, ids: list[int]) -> list[int]:
        look = self.merges.get
        found = [look(p, _NO_MERGE) for p in zip(ids, ids[1:])]
        while found and (best := min(found)) != _NO_MERGE:
            at = found.index(best)
            ids[at] = best & 0xFFFFFF
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = look((ids[at - 1], ids[at]), _NO_MERGE)
            if at < len(found):
                found[at] = look((ids[at], ids[at + 1]), _NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        look, n = self.merges.get, len(ids)
        after, before = [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(f, i) for i, p in enumerate(zip(ids, ids[1:])) if (f := look(p)) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (f := look((ids[i], ids[after[i]]))) is not None:
                heapq.heappush(heap, (f, i))

        while heap:
            best, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or look((ids[i], ids[j])) != best:
                continue
            ids[i], ids[j] = best & 0xFFFFFF, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [t for t in ids if t >= 0]


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """The minimal automaton of the words (built in sorted order) and the ids of each, as one block of bytes."""
    keys = sorted(w.encode() for w in words)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, list[tuple[int, int]]]] = []

    def freeze(node: list) -> int:
        """Number of the state with this node's future."""
        key = (node[0], tuple(node[1]))
        if (at := register.get(key)) is None:
            at = register[key] = len(states)
            states.append((node[0], list(node[1])))
        return at

    path: list[list] = [[False, []]]  # nodes of the last word, each with its finished edges
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(node)))

    for key in keys:
        shared = len(os.path.commonprefix([last, key]))
        close(shared)
        path.extend([False, []] for _ in key[shared:])
        path[-1][0] = True
        last = key
    close(0)
    start = freeze(path[0])

    reach = [0] * len(states)  # words that each state leads to; children are frozen before their parents
    firsts, labels, targets, skips = [0], bytearray(), [], []
    for i, (final, edges) in enumerate(states):
        n = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            skips.append(n)
            n += reach[target]
        reach[i] = n
        firsts.append(len(targets))
    ids = [words[k.decode()] for k in keys]
    parts = [np.array(x, np.int32).tobytes() for x in (firsts, [s[0] for s in states], targets, skips, np.cumsum([0, *map(len, ids)]), [t for x in ids for t in x])]
    parts.append(bytes(labels))
    head = np.array([start, *np.cumsum([4 * 8, *map(len, parts)])[:-1]], np.int32)
    return head.tobytes() + b"".join(parts)


class Lexicon:
    """A compiled lexicon over a memory-mapped file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.data)
        self.start, *at = view[:32].cast("i")
        self.firsts, self.finals, self.targets, self.skips, self.cuts, self.ids = (view[a:b].cast("i") for a, b in zip(at, at[1:]))
        self.labels = at[6]

    def get(self, word: bytes) -> list[int] | None:
        state, number, find, labels = self.start, 0, self.data.find, self.labels
        for k in range(len(word)):
            edge = find(word[k:k + 1], labels + self.firsts[state], labels + self.firsts[state + 1]) - labels
            if edge < 0:
                return None
            number += self.skips[edge]
            state = self.targets[edge]
        return self.ids[self.cuts[number]:self.cuts[number + 1]].tolist() if self.finals[state] else None


def frequent_words(docs: DataFrame, text_col: str, bpe: WordBPE, limit: int = LEXICON_WORDS) -> list[str]:
    """The ``limit`` most frequent pre-tokens of all documents (as far as tasks meet them ``LEAST_IN_TASK`` times)."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = shared.value, Counter()

        def batch() -> pa.RecordBatch:
            kept: Counter = Counter()
            for piece, n in held.items():
                if n >= LEAST_IN_TASK:
                    for w in own.pattern.findall(piece):
                        kept[w] += n
            return pa.RecordBatch.from_pydict({"w": pa.array(list(kept), pa.string()), "n": pa.array(list(kept.values()), pa.int64())})

        for b in slices(batches):
            for t in b.column(0).to_pylist():
                held.update(own.pieces(t or "") or ())
                if len(held) > COUNTED_WORDS:
                    yield batch()
                    held.clear()
        yield batch()

    rows = (docs.select(text_col).mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "w").limit(limit))
    return [r["w"] for r in rows.collect()]  # at most `limit` words


def ship_lexicon(spark, words: Iterable[str], bpe: WordBPE) -> str:
    """Compiles the words and hands the file to every executor; the name by which they find it."""
    data = compile_lexicon({w: bpe.encode_word(w) for w in words if w not in bpe.special})
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:20]}.bin"
    folder = os.path.join(SparkFiles.getRootDirectory(), "to-ship")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    if not os.path.exists(path):
        with open(path, "wb") as f:
            f.write(data)
        spark.sparkContext.addFile(path)
    return name


class _Ids(dict):
    """Ids of words as bytes, little-endian; fills itself from the lexicon or by merging."""

    def __init__(self, bpe: WordBPE, lexicon: Lexicon) -> None:
        self.bpe, self.lexicon = bpe, lexicon

    def __missing__(self, word: str) -> bytes:
        if len(self) >= HELD_WORDS:
            self.clear()
        ids = (None if word in self.bpe.special else self.lexicon.get(word.encode())) or self.bpe.encode_word(word)
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        self[word] = data = packed.tobytes()
        return data


class _PieceIds(dict):
    """Ids of what stands between white space, from those of its words."""

    def __init__(self, words: _Ids) -> None:
        self.words, self.split = words, words.bpe.pattern.findall

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= HELD_WORDS:
            self.clear()
        self[piece] = data = b"".join(map(self.words.__getitem__, self.split(piece)))
        return data

    def of_text(self, text: str) -> bytes:
        pieces = self.words.bpe.pieces(text)
        if pieces is None:
            return b"".join(map(self.words.__getitem__, self.words.bpe.pre_tokens(text)))
        return b"".join(map(self.__getitem__, pieces))


def load_bpe(path: str) -> WordBPE:
    with open(path, encoding="utf-8") as f:
        return WordBPE(json.load(f))


def _encoder(docs: DataFrame, vocabulary: str, text_col: str, limit: int):
    """What a task calls to get its own function from a text to its ids as bytes."""
    spark, bpe = docs.sparkSession, load_bpe(vocabulary)
    name = ship_lexicon(spark, frequent_words(docs, text_col, bpe, limit), bpe)
    shared = spark.sparkContext.broadcast(bpe)
    return lambda: _PieceIds(_Ids(shared.value, Lexicon(SparkFiles.get(name)))).of_text


def _decoder(spark, vocabulary: str):
    """What a task calls to get its own function from ids as bytes to their text."""
    bpe = load_bpe(vocabulary)
    shared = spark.sparkContext.broadcast([bpe.tokens.get(i, "") for i in range(max(bpe.tokens) + 1)])

    def make():
        tokens = shared.value
        return lambda data: " ".join([tokens[i] for i in np.frombuffer(data, "<u4").tolist()])

    return make


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", limit: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with ``_ids``: the token ids of each text, as little-endian unsigned 32-bit integers."""
    make, at = _encoder(docs, vocabulary, text_col, limit), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = make()
        for b in slices(batches):
            out = [ids_of(t or "") for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "_ids"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_ids", T.BinaryType())]))


def decode(encoded: DataFrame, vocabulary: str, ids_col: str = "_ids", name: str = "_decoded") -> DataFrame:
    """``encoded`` with the text of its ids, special tokens included (token strings joined by a blank, as the
    file names no decoder)."""
    make, at = _decoder(encoded.sparkSession, vocabulary), encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = make()
        for b in slices(batches):
            out = [text_of(x or b"") for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, name])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())]))


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LEXICON_WORDS) -> DataFrame:
    """Per row of ``docs``: the id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``. Texts are encoded and decoded
    in the same task, so neither ids nor decoded texts leave it."""
    texts = docs.select(F.col(id_col), F.col(text_col))
    encoder, decoder = _encoder(texts, vocabulary, text_col, limit), _decoder(docs.sparkSession, vocabulary)
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, text_of = encoder(), decoder()
        for b in slices(batches):
            n, ids_sha, text_sha = [], [], []
            for text in b.column(1).to_pylist():
                data = ids_of(text or "")
                n.append(len(data) // 4)
                ids_sha.append(hashlib.sha256(data).hexdigest())
                text_sha.append(hashlib.sha256(text_of(data).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=names)

    return texts.mapInArrow(run, T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                                               T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
