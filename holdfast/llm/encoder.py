"""Byte-level BPE ids of whole texts by the tokenizers library, each distinct piece encoded once.

Byte-level BPE first cuts a text into pieces (letters, digits, marks, each with a leading space,
and white space) and then encodes every piece by itself. The cuts are found here for a whole Arrow
batch at a time; the library encodes the pieces not met before. Texts with code points beyond the
ranges below, where character classes depend on the Unicode version, and texts that hold an added token's
content, such as <|endoftext|>, go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

from holdfast.llm.text import mix, pieces, span_hashes

#: Latin letters and general punctuation.
_LATIN, _MARKS = 0x250, (0x2010, 0x2028)
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
#: Code points of white space below _LATIN.
_WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0]

_classes = np.full(_MARKS[1], _OTHER, np.uint8)
for _point in range(_LATIN):
    _kind = unicodedata.category(chr(_point))[0]
    _classes[_point] = {"L": _LETTER, "N": _DIGIT}.get(_kind, _OTHER)
_classes[_WHITE] = _SPACE
_codes = mix(np.arange(1, _MARKS[1] + 1, dtype=np.uint64))


def _cuts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces start, as a mask over code points."""
    n = len(points)
    kind = _classes[points]
    head = np.zeros(n + 1, bool)
    head[bounds] = True
    cut = head[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    # The last white space before anything else starts a piece; a blank takes what follows with it.
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~head[1:n])
    cut[last] = True
    cut[last[points[last] == 32] + 1] = False
    # 's 't 'm 'd 're 've 'll end their piece where the apostrophe started one.
    quote = np.flatnonzero(cut & (points == 0x27))
    if len(quote):
        ends = np.append(bounds[1:], n)[np.searchsorted(bounds[1:], quote, "right")]
        far = np.pad(points, (0, 2))
        one, two = far[quote + 1], far[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"]) & (quote + 1 < ends)
        pairs = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pairs |= (one == ord(a)) & (two == ord(b))
        pairs &= ~short & (quote + 2 < ends)
        for found, size in ((short, 1), (pairs, 2)):
            at = quote[found]
            cut[at + 1] = False
            after = at + 1 + size
            cut[after[after < n]] = True
    return cut


class Encoder:
    """Ids of texts; keeps at most `keep` distinct pieces between calls."""

    def __init__(self, path: str, keep: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # The library takes an added token's content out of a text before it cuts pieces.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.width = 2 if self.library.get_vocab_size(True) <= 1 << 16 else 4
        self.ids = np.dtype(f"<u{self.width}")
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.ids)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.ids) for x in found]

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces, end to end, and where each piece's begin and how many it has."""
        order, flat, sizes = [], [np.zeros(0, self.ids)], [np.zeros(0, np.int64)]
        # Blank and letters: such pieces stay apart when joined, which saves calls.
        plain = [i for i, w in enumerate(words) if w[0] == " " and w[1:].isalpha()]
        rest = set(range(len(words))).difference(plain)
        for at in range(0, len(plain), 2000):
            some = plain[at : at + 2000]
            one = self.library.encode("".join([words[i] for i in some]), add_special_tokens=False)
            counts = np.bincount(np.array(one.word_ids, np.int64), minlength=len(some))
            if len(counts) != len(some) or not counts.all():
                rest.update(some)
                continue
            order += some
            flat.append(np.array(one.ids, self.ids))
            sizes.append(counts)
        found = self.whole([words[i] for i in sorted(rest)])
        order += sorted(rest)
        flat += found
        sizes.append(np.array([len(x) for x in found], np.int64))
        size = np.concatenate(sizes)
        at, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at[order], count[order] = np.cumsum(size) - size, size
        return np.concatenate(flat), at, count

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        flat, place, sizes = self._encode(words)
        into = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, into, hashes)
        self.place = np.insert(self.place, into, place + len(self.flat))
        self.size = np.insert(self.size, into, sizes)
        self.flat = np.concatenate([self.flat, flat])

    def _pieces(self, text: str, points: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        starts = np.flatnonzero(_cuts(points, bounds[bounds < len(points)]))
        ends = np.append(starts[1:], len(points))
        hashes = span_hashes(points, starts, ends, _codes)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            if len(self.known) + new.sum() > self.keep:
                self._forget()
                new[:] = True
            where = first[new]
            words = [text[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            self._learn(distinct[new], words)
            at = np.searchsorted(self.known, distinct)
        size = self.size[at][back]
        place = self.place[at][back]
        upto = np.cumsum(size)
        take = np.arange(upto[-1] if len(upto) else 0) + np.repeat(place - upto + size, size)
        ids = self.flat[take]
        total = np.append(0, upto)
        edges = total[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def _added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def batch(self, batch: pa.RecordBatch, column: str):
        """(slice of the batch, ids of each of its texts) for each slice."""
        for part, data, bounds in pieces(batch, column):
            text = data.tobytes().decode("utf-8")
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
            at = leads[bounds]
            odd = ((points >= _LATIN) & (points < _MARKS[0])) | (points >= _MARKS[1])
            added = self._added(text)
            if not odd.any() and not added:
                yield part, self._pieces(text, points, at)
                continue
            before = np.append(0, np.cumsum(odd))
            strange = before[at[1:]] > before[at[:-1]]
            out: list[np.ndarray] = []
            for i, odd_one in enumerate(strange):
                a, b = at[i], at[i + 1]
                own = text[a:b]
                out += self.whole([own]) if odd_one or (added and self._added(own)) else self._pieces(own, points[a:b], np.array([0, b - a]))
            yield part, out


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for this vocabulary; kept between tasks."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
