"""SimHash of whole feature texts in Arrow batches (map-only, no shuffle).

Same definition as the native-Spark form in ``operators.similarity``: lower
case, keep runs of ``[\\p{L}\\p{N}_\\x{4e00}-\\x{9fcc}]``, concatenate, slide
4-character shingles (at least one), hash each with MD5 and keep the low 8
bytes big-endian, set bit i iff more than half of the shingles have it set.

Texts share most of their shingles, so a batch hashes each of its shingles once, and a task keeps the hashes of those it has met (``KEPT`` at
most; the others are hashed again). Characters are numbered as they are met, so that a shingle is one 64-bit number while there are
few enough of them. Bits are counted for a whole batch at once, four to a 64-bit word.
"""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from brieflow import params as P


#: hashes of shingles that a task keeps, and texts whose bits it counts at once
KEPT, ROWS = 1 << 18, 256


def simhash_col(text: Column) -> Column:
    # Java/RE2 write code points as \x{hhhh}; Python's regex module wants \uhhhh
    pattern = re.sub(r"\\x\{([0-9a-fA-F]{4})\}", r"\\u\1", P.SIMHASH_TOKEN_PATTERN)
    width = P.SIMHASH_SHINGLE

    @F.pandas_udf("long")
    def _simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import hashlib

        import numpy as np
        import regex

        tok = regex.compile(pattern)
        bits = 64 // width
        seen: dict = {}
        number = np.zeros(0x110000, np.uint64)  # of each character met, from 1; 0 fills up short texts
        kept = np.full(0x110000, -1, np.int8)  # whether the pattern, runs of a class of characters, takes one; -1 until it is met

        def digest(key, text):
            h = seen.get(key)
            if h is None:
                h = int.from_bytes(hashlib.md5(text().encode("utf-8")).digest()[8:], "big")
                if len(seen) < KEPT:
                    seen[key] = h
            return h

        met = 0

        def keys(codes, start):
            """A number for each shingle from ``start``; None where characters are too many for that."""
            nonlocal met
            new = np.unique(codes[(number[codes] == 0) & (codes > 0)])
            if met + len(new) >= 1 << bits:
                return None
            number[new] = np.arange(met + 1, met + 1 + len(new), dtype=np.uint64)
            met += len(new)
            own = number[codes]
            key = np.zeros(len(start), np.uint64)
            for i in range(width):
                key = (key << np.uint64(bits)) | own[start + i]
            return key

        def signs(texts):
            cs = [(t or "").lower() for t in texts]
            codes = np.frombuffer("".join(cs).encode("utf-32-le"), np.uint32)
            for c in np.unique(codes[kept[codes] < 0]).tolist():
                kept[c] = tok.fullmatch(chr(c)) is not None
            keep = kept[codes] > 0
            size = np.bincount(np.repeat(np.arange(len(cs)), [len(c) for c in cs])[keep], minlength=len(cs))
            n = np.maximum(size - width + 1, 1)
            at = np.cumsum(n + width - 1) - (n + width - 1)
            ends = np.cumsum(n)
            padded = np.zeros(ends[-1] + (width - 1) * len(cs), np.uint32)
            padded[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())] = codes[keep]
            start = np.repeat(at - (ends - n), n) + np.arange(ends[-1])

            def gram(i):
                return padded[i:i + width].tobytes().decode("utf-32-le").rstrip("\0")

            key = keys(padded, start)
            if key is None:
                h = np.array([digest(g, lambda: g) for g in map(gram, start.tolist())], np.uint64)
            else:
                distinct, place, of = np.unique(key, return_index=True, return_inverse=True)
                h = np.array([digest(k, lambda: gram(i)) for k, i in zip(distinct.tolist(), start[place].tolist())], np.uint64)[of]
            out = np.zeros(len(cs), np.uint64)
            lane = 16 if n.max() < 1 << 16 else 64  # bits that a count has
            ones = np.uint64(sum(1 << i for i in range(0, 64, lane)))
            for j in range(lane):
                sums = np.add.reduceat((h >> np.uint64(j)) & ones, ends - n)
                for i in range(0, 64, lane):
                    count = sums >> np.uint64(i)
                    if lane < 64:
                        count &= np.uint64((1 << lane) - 1)
                    out |= (2 * count.astype(np.int64) > n).astype(np.uint64) << np.uint64(i + j)
            return out

        for s in batches:
            out = np.zeros(len(s), np.int64)
            for at in range(0, len(s), ROWS):
                out[at:at + ROWS] = signs(s.iloc[at:at + ROWS]).view(np.int64)
            yield pd.Series(out)

    return _simhash(text)
