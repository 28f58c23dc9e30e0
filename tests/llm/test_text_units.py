"""Words, shingles, token ids and guess costs without Spark."""

import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from holdfast.llm import text
from holdfast.llm.secrets import ACCESS, ASSIGN, HEX, guess_cost, ranks, spans_of

ALPHABET = "abAB zZ\t\n\x0b\x0c\r\x1c.,!'0é世 — "


def samples(n=300, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)] + ["", None]


def lowered(value):
    return re.sub("[A-Z]", lambda m: m[0].lower(), value or "")


@pytest.mark.parametrize(
    ("alphabet", "pattern"),
    [(text.SPACED, r"[^\x20\x09-\x0D]+"), (text.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")],
)
def test_words_and_hashes_follow_the_pattern(alphabet, pattern, monkeypatch):
    values = samples()
    want = [re.findall(pattern, lowered(v)) for v in values]
    for piece in (1 << 21, 16):  # in one go, and in pieces shorter than a text
        monkeypatch.setattr(text, "PIECE", piece)
        batch = pa.RecordBatch.from_pydict({"t": pa.array(values, pa.string())})
        at, seen = 0, {}
        for part, data, bounds in text.pieces(batch, "t"):
            starts, ends, first = text.word_spans(data, bounds, alphabet)
            hashes = text.span_hashes(data, starts, ends, alphabet.code)
            for i in range(part.num_rows):
                words = want[at + i]
                assert len(words) == first[i + 1] - first[i]
                for word, h in zip(words, hashes[first[i] : first[i + 1]], strict=True):
                    if len(word.encode()) < 16:
                        assert seen.setdefault(word, h) == h
            at += part.num_rows
        assert at == len(values)
        assert len(set(seen.values())) == len(seen)


def test_shingle_sets_count_distinct_runs():
    values = ["a b a b a b", "x y", "", "one two three four"]
    batch = pa.RecordBatch.from_pydict({"t": pa.array(values)})
    (_, sets), = text.texts_shingles(batch, "t", 3)
    assert [len(s) for s in sets] == [2, 1, 0, 2]
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets)


def test_ids_equal_the_library(monkeypatch):
    from public_tokenizers import path

    from holdfast.llm import encoder

    own = encoder.Encoder(path("byte_bpe_50k.json"), keep=200)
    rng = random.Random(2)
    letters = "abstrevmdl'  \n\t.,!9é²½\x85’“世'"
    values = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    values += ["", None, " ", "\n", "'s", "it's", "'re'll", "don''t ", "x' s", "'", "s", "<|endoftext|> a", "a" * 5000]
    batch = pa.RecordBatch.from_pydict({"t": pa.array(values, pa.string())})
    monkeypatch.setattr(text, "PIECE", 5000)
    got = [ids for _, found in own.batch(batch, "t") for ids in found]
    want = own.library.encode_batch([v or "" for v in values], add_special_tokens=False)
    assert [list(g) for g in got] == [w.ids for w in want]


def test_ids_of_added_tokens_equal_a_fresh_library():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    from holdfast.llm import encoder

    fresh = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert fresh.encode("<|endoftext|>", add_special_tokens=False).ids == [50256]
    own = encoder.Encoder(path("byte_bpe_50k.json"))
    values = ["<|endoftext|>", "plain", "one <|endoftext|>  two", "<|endoftext|><|endoftext|>\n", "<|endof", "text|> x", "<|endoftext|", "世 <|endoftext|>", "", "it's"]
    batch = pa.RecordBatch.from_pydict({"t": pa.array(values, pa.string())})
    got = [list(ids) for _, found in own.batch(batch, "t") for ids in found]
    assert got == [x.ids for x in fresh.encode_batch(values, add_special_tokens=False)]


def test_guess_cost_prefers_the_cheapest_cut():
    assert guess_cost("") == 0
    assert guess_cost("password") < 1
    assert guess_cost("P4ssw0rd") < 3
    assert guess_cost("aaaaaaaaaaaa") < 3
    assert guess_cost("qwertyuiop") < 4
    assert guess_cost("19841231") < 6
    assert guess_cost("password1984") <= guess_cost("password") + guess_cost("1984") + 1e-9
    assert guess_cost("x9$Kq2vL!mZ7") > 9
    # Brute force by exhaustive cutting agrees.
    from holdfast.llm.secrets import _spans

    for value in ("dragon1999zz", "aaabcdq1", "Love!2020-01-02x"):
        ends = _spans(value)

        def best(end, ends=ends):
            if end == 0:
                return 0.0
            return min([best(end - 1) + 1.0, *(best(s) + c for s, c in ends.get(end, ()))])

        assert guess_cost(value) == pytest.approx(best(len(value)))


def base_spans(value):
    """The stated patterns, failing matches dropped afterwards."""
    assign = [m for m in re.finditer(ASSIGN.pattern, value, re.I | re.A) if len(m[2]) >= 6]
    access = [m for m in re.finditer(r"AKIA[A-Z0-9]+", value) if len(m[0]) >= 20]
    hexes = [m for m in re.finditer(r"[0-9a-f]+", value) if len(m[0]) >= 24]
    return sorted((m.start(), k, m.end()) for k, found in enumerate((assign, access, hexes)) for m in found)


def test_base_spans_equal_the_stated_patterns():
    assert ACCESS.pattern and HEX.pattern
    rng = random.Random(3)
    parts = ["password", "ToKeN", "api_key", "apikey", ":", "=", " ", '"', "é", "AKIA", "ABCDEFGHIJKLMNOP1234", "0123456789abcdef" * 2, "abc", "hunter22", "ſecret=abcdefg", "\n"]
    for _ in range(3000):
        value = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert [s for s in spans_of(value) if s[1] < 3] == base_spans(value)
    assert spans_of("token: token: hunter22")[:1] == [] or all(s[1] == 3 for s in spans_of("token: token: hunter22"))


def test_quoted_values_are_scored_to_their_closing_quote():
    def guesses(value):
        return [value[a:b] for a, kind, b in spans_of(value) if kind == 3]

    assert guesses('pwd = "aB3(x9{Kq!7TzLw"') == ["aB3(x9{Kq!7TzLw"]
    assert guesses("passphrase: 'Vq Zx Kj Wp' # note") == ["Vq Zx Kj Wp"]
    assert guesses(r'{"pwd": "x\"9$Kq,2vL!m", "n": 1}') == [r'x\"9$Kq,2vL!m']
    assert guesses('pwd="" pwd=x9$Kq2vL!mZ7, other') == ["x9$Kq2vL!mZ7"]
    assert guesses('pwd="x9$Kq2vL!mZ7\n"') == ["x9$Kq2vL!mZ7"]  # never closed on its line
    assert guesses('pwd = "a,b" and pwd = "password"') == []
    rng = random.Random(8)
    printable = [chr(c) for c in range(33, 127) if chr(c) not in "\"'\\\\"]
    for _ in range(500):
        value = "".join(rng.choice(printable) for _ in range(16))
        want = [value] if guess_cost(value) >= 8 else []
        for quote in "\"'":
            assert guesses(f"pwd = {quote}{value}{quote}") == want


def cost_by_enumeration(value, rank_of):
    """Every way of cutting a short value, each piece priced by itself."""
    from functools import lru_cache

    rows = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz"]
    leet = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

    def beside(a, b):
        return any(a in row and b in row and abs(row.index(a) - row.index(b)) == 1 for row in rows)

    def price(piece):
        low, n, best = piece.lower(), len(piece), math.inf
        if n == 1:
            return 1.0
        plain = "".join(leet.get(c, c) for c in low)
        if n >= 3 and plain in rank_of:
            upper = sum(c.isupper() for c in piece)
            if not upper:
                ways = 1
            elif piece.isupper() or (upper == 1 and piece[0].isupper()):
                ways = 2
            else:
                ways = sum(math.comb(n, k) for k in range(1, upper + 1))
            best = min(best, math.log10(rank_of[plain]) + math.log10(ways) + math.log10(2) * sum(c in leet for c in low))
        if n >= 3 and all(beside(a, b) for a, b in zip(low, low[1:])):
            turns = sum(low[k] == low[k - 2] for k in range(2, n))
            best = min(best, math.log10(40 * n) + turns * math.log10(2 * n))
        return best

    @lru_cache(None)
    def cut(start):
        if start == len(value):
            return 0.0
        return min(price(value[start:end]) + cut(end) for end in range(start + 1, len(value) + 1))

    return cut(0)


def test_guess_cost_equals_enumeration_of_cuts():
    rank_of = ranks(["zebra", "information", "qwert", "letters"])
    rng = random.Random(11)
    pieces = ["zebra", "Zebra", "zEBra", "z3br@", "qwert", "letters", "letme1n", "K", "9", "asdfg", "fdsa", "poi", "x", "hgf", "M4st3r"]
    for _ in range(300):
        value = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 4)))
        if re.search(r"(.{1,4})\1", value.lower()) or re.search(r"(19|20)\d\d", value):
            continue  # repeats and dates are priced in a test of their own
        assert guess_cost(value, rank_of) == pytest.approx(cost_by_enumeration(value, rank_of))


def test_walks_pay_for_their_turns():
    assert guess_cost("asdfdsasdfdsa") > guess_cost("asdfghjkl") + 2
    assert guess_cost("asdfghjkl") == pytest.approx(math.log10(360))


def test_long_runs_take_no_time():
    began = time.monotonic()
    for letter in "aeiouy":
        assert spans_of("password = " + letter * 10_000)
        assert spans_of("pwd = " + letter * 5_000 + "bbbb" + letter * 5_000)
        spans_of("pwd = " + "aeiou" * 2_000 + "9")
    spans_of("pwd = " + "qwertrewq" * 1_000 + " secret: '" + "\\'" * 10_000)
    assert time.monotonic() - began < 5


def test_pronounceable_letters_are_brute_force_unless_listed():
    assert guess_cost("tarimolexa") == 10.0
    assert guess_cost("tarimolexa", ranks(["tarimolexa"])) < 2
