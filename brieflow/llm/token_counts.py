"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

Pre-tokens are the white-space separated words of a text, each with the vocabulary's word mark before it. A
pre-token's count is the number of tokens in its best segmentation: the one of highest total score, and of equals
the one with the fewest tokens. The forward score of a prefix does not depend on what follows it, so the distinct
pre-tokens are put into a trie and the score of each shared prefix is computed once, at its node. The node at
which a pre-token ends holds its count; texts then only sum up counts.

The vocabulary is a parameter: the pieces of a sentencepiece file in their order. The file's scores are ranks,
so a piece's probability is taken by Zipf's law from its place in the file. Scores are whole numbers of
millionths, so sums do not depend on their order. A character that no piece holds costs one token for each of its
UTF-8 bytes.

A task settles its trie when ``TRIE_WORDS`` words are in it, keeps the counts of about ``HELD_WORDS`` words and
then starts anew; that bounds its memory and changes no count. Words of over ``LONG_WORD`` characters are scored by themselves.

Defined cases: null and empty texts have no words and no tokens; repeated rows, and rows
with a null id, each get a row; very long texts are read whole; an empty table gives no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brieflow.llm.common import slices

WORD_MARK = "▁"
TRIE_WORDS = 1 << 15
HELD_WORDS = 1 << 18
LONG_WORD = 200
#: score of a byte token, in nats below the rarest piece
BYTE_BELOW = 10.0


class Pieces:
    """Scores of the pieces of a vocabulary, in millionths of a nat."""

    def __init__(self, pieces: list[str]) -> None:
        norm = math.log(sum(1 / (r + 2) for r in range(len(pieces))))
        self.scores = {p: round(-1e6 * (math.log(r + 2) + norm)) for r, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.trie: dict = {}
        for p, score in self.scores.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[END] = score
        self.byte = min(self.scores.values(), default=0) - round(1e6 * BYTE_BELOW)

    @classmethod
    def from_file(cls, path: str) -> Pieces:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        return cls([sp.id_to_piece(i) for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))])

    def extend(self, word: str, end: int, scores: list[int], counts: list[int]) -> tuple[int, int]:
        """Best score and count of ``word[:end]``, from those of all shorter prefixes."""
        best, fewest, known = None, 0, self.scores
        for start in range(max(0, end - self.longest), end):
            s = known.get(word[start:end])
            if s is not None:
                s += scores[start]
                if best is None or s > best or (s == best and counts[start] + 1 < fewest):
                    best, fewest = s, counts[start] + 1
        if word[end - 1] not in known:
            size = len(word[end - 1].encode())
            s = scores[end - 1] + size * self.byte
            if best is None or s > best or (s == best and counts[end - 1] + size < fewest):
                best, fewest = s, counts[end - 1] + size
        return best, fewest

    def count(self, word: str) -> int:
        """Count of one pre-token by itself."""
        scores, counts = [0], [0]
        for end in range(1, len(word) + 1):
            s, n = self.extend(word, end, scores, counts)
            scores.append(s)
            counts.append(n)
        return counts[-1]


END = ""  # the key of what a trie's node holds itself


class PreTokenTrie:
    """A trie of words; ``counts`` gives the count of each word in it."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces, self.root, self.size = pieces, {}, 0

    def insert(self, word: str) -> None:
        node = self.root
        for c in WORD_MARK + word:
            node = node.setdefault(c, {})
        node[END] = word
        self.size += 1

    def counts(self) -> dict[str, int]:
        """Walks the trie; a node's score is found once, from the pieces that can end there."""
        found, first, byte = {}, self.pieces.trie, self.pieces.byte
        todo = [(self.root, 0, 0, [])]  # node, its score and count, and the pieces begun before it
        while todo:
            node, score, count, begun = todo.pop()
            begun = [*begun, (first, score, count)]
            for c, child in node.items():
                if c == END:
                    found[child] = count
                    continue
                best, fewest, still = None, 0, []
                for piece, s, n in begun:
                    piece = piece.get(c)
                    if piece is not None:
                        still.append((piece, s, n))
                        own = piece.get(END)
                        if own is not None:
                            s += own
                            if best is None or s > best or (s == best and n + 1 < fewest):
                                best, fewest = s, n + 1
                if END not in first.get(c, ()):
                    size = len(c.encode())
                    s = score + size * byte
                    if best is None or s > best or (s == best and count + size < fewest):
                        best, fewest = s, count + size
                todo.append((child, best, fewest, still))
        return found


def token_counts(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words`` and ``n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for b in slices(batches):
            words, tokens, waiting = [], [], []
            trie = PreTokenTrie(own)

            def settle() -> None:
                known.update(trie.counts())
                tokens.extend(sum(map(known.__getitem__, w)) for w in waiting)
                waiting.clear()
                if len(known) > HELD_WORDS:
                    known.clear()

            for text in b.column(1).to_pylist():
                split = (text or "").split()
                words.append(len(split))
                waiting.append(split)
                for w in set(split).difference(known):
                    if len(w) > LONG_WORD:
                        known[w] = own.count(WORD_MARK + w)
                    else:
                        trie.insert(w)
                if trie.size >= TRIE_WORDS:
                    settle()
                    trie = PreTokenTrie(own)
            settle()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_words", "n_tokens"])

    id_field = docs.schema[id_col]
    schema = T.StructType([id_field, T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
