"""Operators on single texts against brute force, on fixtures and random texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brieflow.llm import pii
from brieflow.llm.bpe_lexicon import Lexicon, compile_lexicon, load_bpe, round_trip
from brieflow.llm.catalog import vocabulary
from brieflow.llm.decontaminate import contamination, contamination_digest, drop_contaminated
from brieflow.llm.pii import KINDS, base_spans, luhn, personal_data, sanitise
from brieflow.llm.secret_scan import RULES, build_index, find_secrets, secrets_digest, trigram_query
from brieflow.llm.token_counts import Pieces, token_counts

from llm_helpers import words_of

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORDS.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def contaminated_by_hand(rows, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in rows:
        w, hit, met = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    met |= own
        met.discard(None)
        out.append((i, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_contamination_matches_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(5)
    items = [(i, words_of(rng, rng.choice([3, 9, 10, 11, 40]), 60)) for i in range(60)]
    items += [(60, items[0][1]), (61, ""), (62, None), (None, words_of(rng, 12, 60)), (63, "three"), (64, "Dé fg, hi")]
    rows = []
    for i in range(250):
        text = words_of(rng, rng.randrange(0, 60), 60)
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(own) + 1)
            text += " " + " ".join(own[a:a + rng.randrange(4, 30)]).upper() + ", " + words_of(rng, 5, 60)
        rows.append((i, text))
    rows += [(4, None), (None, items[4][1]), (5, items[5][1]), (5, items[5][1]), (6, "w1x1 " * 3000 + "one two three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in contamination_digest(contamination(docs, tests)).collect()), key=str)
    want = contaminated_by_hand(rows, items)
    assert got == want and any(w[-1] for w in want)
    left = drop_contaminated(odd_docs, tests)
    assert left.columns == odd_docs.columns and left.count() == sum(not w[-1] for w in contaminated_by_hand([(r.doc_id, r.text) for r in odd_docs.collect()], items))
    assert contamination(no_docs, tests).count() == 0
    nothing = contamination_digest(contamination(odd_docs, tests.limit(0))).collect()
    assert len(nothing) == odd_docs.count() and not any(r.contaminated for r in nothing)


# --- personal data -----------------------------------------------------------------------------------------------

PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def spans_by_hand(text):
    found = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else 0, 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[k]
            if good:
                found.append((m.start(), k, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.b-_1234567890+ ()%é\n0 5", max_size=60))
def test_base_spans_by_definition(text):
    assert base_spans(text) == spans_by_hand(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+1 " * 100_000, "@" * 300_000):
        base_spans(text)


def test_terms_that_disclose_an_entity(spark):
    rng = random.Random(6)
    secret = "ann.lee@mail.example.com"
    rows = [(i, f"{words_of(rng, 30)} report by kestrel {secret} about the {words_of(rng, 3)} budget {words_of(rng, 20)}") for i in range(6)]
    rows += [(100 + i, f"{words_of(rng, 20)} report by the board about the budget {words_of(rng, 20)}") for i in range(300)]
    rows += [(500 + i, f"same words every time zebra other{i % 2}@mail.example.com same words every time") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    texts = dict(rows)
    for i in range(6):
        assert [texts[i][s.start:s.end] for s in found[i]] == ["kestrel", secret]  # "report", "by", "the" tell little
    assert all(not found[100 + i] for i in range(300))
    assert [s.kind for s in found[500]] == ["email"]  # equal contexts count once
    clean = {r.doc_id: r.sanitised for r in sanitise(docs).collect()}
    assert "kestrel" not in clean[0] and secret not in clean[0] and "<email>" in clean[0] and clean[100] == texts[100]


def test_terms_seen_with_an_entity_once_or_twice(spark):
    rng = random.Random(8)
    rows = [(i, f"{words_of(rng, 20)} the board {words_of(rng, 20)}") for i in range(1200)]
    rows += [(2000, f"the board kestrel one@mail.example.com {rows[0][1]}")]
    rows += [(2001 + i, f"the board merlin two@mail.example.com {rows[1 + i][1]}") for i in range(2)]
    found = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    said = {i: {t[s.start:s.end] for s in found[i] if s.kind == "term"} for i, t in rows}
    assert "kestrel" in said[2000] and "merlin" in said[2001] and "merlin" in said[2002]
    assert not any({"the", "board"} & x for x in said.values())


def test_disclosing_terms_far_from_the_entity(spark):
    rng = random.Random(9)
    rows = [(i, f"{words_of(rng, 30)} the board") for i in range(300)]
    rows += [(1000 + i, f"Kestrel {words_of(rng, 50)} ann.lee@mail.example.com {words_of(rng, 9)} the board kestrel") for i in range(6)]
    rows += [(2000, f"{words_of(rng, 5)} a kestrel without the address")]
    found = {r.doc_id: r.spans for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    said = {i: [t[s.start:s.end] for s in found[i]] for i, t in rows}
    assert all(said[1000 + i] == ["Kestrel", "ann.lee@mail.example.com", "kestrel"] for i in range(6))
    assert said[2000] == ["kestrel"] and not any(said[i] for i in range(300))


def test_copies_and_layout_change_no_spans(spark):
    rng = random.Random(10)
    rows = [f"{words_of(rng, 20)} the board" for _ in range(400)]
    rows += [f"kestrel ann.lee@mail.example.com {words_of(rng, 9)} the board" for _ in range(5)]
    rows += [f"{words_of(rng, 5)} the board met in {w}" for w in ("Oslo", "Rome")]

    def spans(texts, parts):
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
        got = {}
        for r in personal_data(docs).collect():
            got.setdefault(texts[r.doc_id], set()).add(tuple((s.start, s.kind, s.end) for s in r.spans))
        assert all(len(x) == 1 for x in got.values())
        return got

    copied = rows + [rows[400]] * 300
    once = spans(rows, 1)
    assert spans(copied, 40) == once and any(k == "term" for _, k, _ in next(iter(once[rows[400]])))


def test_words_beside_long_and_nested_spans():
    text = "ab 10.0.0.1 cd 4111-1111-1111-1111 x@y.zz. ef"
    spans = base_spans(text) + [(0, 3, 9)]
    assert [m.group() for m in pii._free(text, sorted(spans))] == ["cd", "ef"]


def test_personal_data_of_odd_rows(spark, odd_docs, no_docs):
    got = personal_data(odd_docs).collect()
    assert len(got) == odd_docs.count() and not any(r.spans for r in got)
    assert personal_data(no_docs).count() == 0
    assert sanitise(odd_docs).columns == [*odd_docs.columns, "sanitised"]


# --- secrets -----------------------------------------------------------------------------------------------------

def secrets_by_hand(text):
    text = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def test_secrets_match_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(7)
    bits = ["password", "PassWD", "sEcret", "token", "apikey", "API_KEY", "=", ":", " ", "'", '"', "abc", "0123456789abcdef" * 2, "AKIA", "AKIAABCDEFGHIJKL", "é", "😀", "ſecret", "x=1", ".", "\n", "longvalue12"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40)))) for i in range(1500)] + [(None, "token = 'abcdefgh12'"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, [(s.start, s.rank, s.kind, s.end) for s in r.spans if s.rank < 3]) for r in find_secrets(df).collect()), key=str)
    assert got == sorted(((i, secrets_by_hand(t)) for i, t in rows), key=str)
    assert secrets_digest(find_secrets(no_docs)).count() == 0
    assert len(find_secrets(odd_docs).collect()) == odd_docs.count()


def test_further_kinds(spark):
    text = "ghp_" + "a1B2" * 9 + " xoxb-1234567890-abc -----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.abc-_1"
    (row,) = find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [s.kind for s in row.spans] == ["github", "slack", "pem", "jwt"]


def test_trigram_queries():
    asked = {r.kind: trigram_query(r.pattern) for r in RULES}
    assert asked["hex"] is None and asked["access"] == [{"aki", "kia"}]
    assert any({"tok", "oke", "ken"} <= a for a in asked["assign"])
    for pattern, text in ((r"ab?cde", "acde"), (r"(foo|barbaz)+x", "foox"), (r"[xy]abc{2}", "yabcc"), (r"(?i:KeY)12", "kEy12")):
        assert re.fullmatch(pattern, text)
        query = trigram_query(pattern)
        assert query is None or any(all(t in text.lower() for t in a) for a in query)


def test_index_holds_the_asked_trigrams(spark):
    index = build_index(spark.createDataFrame([(1, "A TOKen"), (2, "tok"), (3, None)], "doc_id long, text string"), ["tok", "ken", "zzz"], "doc_id", "text")
    assert sorted((r.trigram, r._id) for r in index.collect()) == [("ken", 1), ("tok", 1), ("tok", 2)]


# --- tokens ------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    return load_bpe(vocabulary("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


ALPHABET = ["a", "B", "s", "'", "'S", " ", "\n", "1", "９", "É", "é", "Σ", "İ", "ß", "\x1c", "\x85", "​", "<|endoftext|>", "<|", "|>", "<|startoftext|>",
            "中", "😀", "\xa0", "ǅ", "ﬁ", "!!", "_", "ing", "the", "tion", "\U000323b0", "꟎"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join))
def test_encoding_equals_the_library(bpe, library, text):
    assert [i for w in bpe.pre_tokens(text) for i in bpe.encode_word(w)] == library.encode(text, add_special_tokens=False).ids


def test_white_space_is_what_splits_pre_tokens(bpe):
    for c in map(chr, range(0x3100)):
        pieces = bpe.pieces(f"a{c}b")
        if pieces is not None:
            assert [w for p in pieces for w in bpe.pattern.findall(p)] == bpe.pre_tokens(f"a{c}b"), hex(ord(c))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join))
def test_pieces_give_the_same_pre_tokens(bpe, text):
    pieces = bpe.pieces(text)
    assert pieces is None or [w for p in pieces for w in bpe.pattern.findall(p)] == bpe.pre_tokens(text)


def test_long_words_merge_alike(bpe, library):
    for text in ("qwertyuiopasdfghjkl" * 200, "a" * 3000, "!?" * 500):
        assert [i for w in bpe.pre_tokens(text) for i in bpe.encode_word(w)] == library.encode(text, add_special_tokens=False).ids


def test_lexicon_gives_ids_of_its_words_only(bpe, tmp_path):
    rng = random.Random(8)
    own = {"".join(rng.choices("abcé", k=rng.randrange(1, 7))) for _ in range(500)}
    data = compile_lexicon({w: bpe.encode_word(w) for w in own})
    (tmp_path / "lexicon").write_bytes(data)
    lexicon = Lexicon(str(tmp_path / "lexicon"))
    for w in own:
        assert lexicon.get(w.encode()) == bpe.encode_word(w)
    others = {"".join(rng.choices("abcéd", k=rng.randrange(0, 9))) for _ in range(500)} - own
    assert all(lexicon.get(w.encode()) is None for w in others)


def test_lexicon_shares_suffixes():
    many = {a + b + "ation": [1] for a in "abcdefgh" for b in "abcdefgh"}
    head = np.frombuffer(compile_lexicon(many)[:32], np.int32)
    states = (head[2] - head[1]) // 4 - 1
    assert states == 8  # start, after one letter, and the shared suffix


def test_round_trip_equals_the_library(spark, odd_docs, no_docs, library):
    got = sorted((tuple(r) for r in round_trip(odd_docs, vocabulary("word_bpe_49k.json")).collect()), key=str)
    want = []
    for r in odd_docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert round_trip(no_docs, vocabulary("word_bpe_49k.json")).count() == 0


def test_token_counts_match_single_words(spark, odd_docs, no_docs):
    pieces = Pieces.from_file(vocabulary("piece_bpe_32k.model"))
    rng = random.Random(9)
    rows = [(i, " ".join("".join(rng.choices("theingaoné中😀", k=rng.randrange(1, 14))) for _ in range(rng.randrange(30)))) for i in range(300)]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts(spark.createDataFrame(rows, "doc_id long, text string"), pieces).collect()}
    assert got == {i: (len(t.split()), sum(pieces.count("▁" + w) for w in t.split())) for i, t in rows}
    got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts(odd_docs, pieces).collect())
    assert got == sorted((r.doc_id or -1, sum(pieces.count("▁" + w) for w in (r.text or "").split())) for r in odd_docs.collect())
    assert token_counts(no_docs, pieces).count() == 0


def test_best_segmentation_by_trying_all():
    pieces = Pieces(["ab", "a", "bc", "b", "abc", "c", "▁"])

    def all_of(word):
        if not word:
            yield 0, 0
        for k in range(1, len(word) + 1):
            if word[:k] in pieces.scores:
                yield from ((pieces.scores[word[:k]] + s, n + 1) for s, n in all_of(word[k:]))

    for word in ("▁abcab", "▁cbcaabc", "▁aaa"):
        assert pieces.count(word) == min((-s, n) for s, n in all_of(word))[1]
