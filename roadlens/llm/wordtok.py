"""Whole-text token ids of a word-end BPE vocabulary, vectorised, with a bounded cache of words.

The ids of a text are those of the pieces that the vocabulary's pattern cuts, in
order. Texts are cut to pieces and pieces looked up as arrays, a stretch at a time: a
piece of up to 16 bytes is two integers, exactly. Each worker keeps the ids of pieces it
has met; new ones are merged together, the lowest-ranked pair of each at a time. Texts
beyond the Latin range, texts that hold one of the vocabulary's added tokens, and pieces
of more than 16 bytes go to the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

#: Words kept at most, but for a stretch's; beyond that the cache starts anew. Slots of the table at first; twice the words at least.
CACHE_WORDS, SLOTS = 500_000, 1 << 20
#: Bytes of text cut to pieces at once, about.
STRETCH = 1 << 21
#: NUL and characters whose lower case or normal form is not a matter of one character, and controls that regex engines sort differently.
_BEYOND = re.compile("[\0\x1c-\x1f\u0130\u0250-\U0010ffff]")
#: The vocabulary file's own classes of characters, written out for the Latin range; other ones are spaces or stand for themselves.
_LETTER, _DIGIT, _SPACE = "[a-zªµºß-öø-ɏ]", "[0-9²³¹¼-¾]", "\\s"
#: What its pattern cuts off after an apostrophe that begins a piece.
_CLIPPED = ("s", "t", "m", "d", "re", "ve", "ll")
#: Classes of characters; pieces are runs of letters or of other characters, and single digits.
_OTHERS, _LETTERS, _DIGITS, _SPACES = range(4)
#: Bytes of a piece that is looked up as two integers.
_LONGEST = 16
_NONE = np.int32(1 << 30)
#: The first n of eight bytes.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_SPACED = re.compile(_SPACE)
_CONTROLS = "\0\x1c\x1d\x1e\x1f"


def _byte_names() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordTokenizer:
    """``encode_all(texts)`` gives uint32 arrays equal to the library's ids with add_special_tokens=False."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._lib = Tokenizer.from_file(path)
        told = json.loads(self._lib.to_str())
        model = told["model"]
        # The library gives an added token that stands in a text its own id, whatever its case where it matches normalised text.
        self._added = [t["content"].lower() for t in told["added_tokens"]]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        names = _byte_names()
        self._inner = np.array([vocab[c] for c in names], dtype=np.int32)
        self._final = np.array([vocab[c + end] for c in names], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], dtype=np.int64)
        # Open addressing: a pair's rank is found in a few vectorised probes.
        self._mask = (1 << 19) - 1
        self._slot_key = np.full(self._mask + 1, -1, dtype=np.int64)
        self._slot_rank = np.full(self._mask + 1, _NONE, dtype=np.int32)
        at, left = self._hash(keys), np.arange(len(keys))
        while len(left):
            free = left[self._slot_key[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self._slot_key[at[put]], self._slot_rank[at[put]] = keys[put], put
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + (self._slot_key[at[left]] != keys[left])) & self._mask
        self._kind = np.array([_kind_of(chr(c)) for c in range(0x250)], dtype=np.uint8)
        self._start()

    def _start(self) -> None:
        self._known = 0
        self._long: dict[bytes, int] = {}
        self._slot = np.full(SLOTS, -1, dtype=np.int32)
        self._key = np.zeros((1 << 14, 2), dtype=np.uint64)
        self._flat = np.zeros(1 << 16, dtype=np.uint32)
        self._used = 0
        self._begin, self._size = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(45)).astype(np.int64) & self._mask

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 16 | right
        at = self._hash(keys)
        rank = np.full(keys.shape, _NONE, dtype=np.int32)
        open_ = np.flatnonzero((right >= 0) & (left >= 0))
        flat_at, flat_keys, flat_rank = at.ravel(), keys.ravel(), rank.ravel()
        while len(open_):
            found = self._slot_key[flat_at[open_]]
            hit = found == flat_keys[open_]
            flat_rank[open_[hit]] = self._slot_rank[flat_at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
            flat_at[open_] = (flat_at[open_] + 1) & self._mask
        return flat_rank.reshape(keys.shape)

    def _merge(self, raw: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pieces' places, sizes, ids end to end): merges each one's lowest-ranked, leftmost pair until none is left.

        ``raw`` has a row of bytes for each piece, zeros behind it.
        """
        done: list = []
        size = (raw != 0).sum(axis=1)
        order = np.argsort(size, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 4000)):
            if not len(part):
                continue
            width, length = int(size[part].max()), size[part]
            self._merge_part(raw[part, :width], part, length, width, done)
        return done

    def _merge_part(self, raw: np.ndarray, part: np.ndarray, length: np.ndarray, width: int, done: list) -> None:
        ids = self._inner[raw]
        rows = np.arange(len(part))
        ids[rows, length - 1] = self._final[raw[rows, length - 1]]
        ids[np.arange(width)[None] >= length[:, None]] = -1
        ids = np.concatenate([ids, np.full((len(part), 1), -1, np.int32)], axis=1)
        rank = self._ranks(ids[:, :-1], ids[:, 1:])
        rank = np.concatenate([rank, np.full((len(part), 1), _NONE, np.int32)], axis=1)
        alive = rows
        column = np.arange(width + 1)
        while len(alive):
            best = rank.argmin(axis=1)
            n = np.arange(len(alive))
            low = rank[n, best]
            go = low < _NONE
            if not go.all():
                held = ids[~go]
                done.append((part[alive[~go]], (held >= 0).sum(axis=1), held[held >= 0]))
                alive, ids, rank, best, low = alive[go], ids[go], rank[go], best[go], low[go]
                n = np.arange(len(alive))
                if not len(alive):
                    break
            ids[n, best] = self._merged[low]
            take = np.minimum(column[None] + (column[None] > best[:, None]), width)
            ids = np.take_along_axis(ids, take, axis=1)
            ids[:, -1] = -1
            rank = np.take_along_axis(rank, take, axis=1)
            rank[:, -1] = _NONE
            rank[n, best] = self._ranks(ids[n, best], ids[n, best + 1])
            before = best > 0
            m = n[before]
            rank[m, best[before] - 1] = self._ranks(ids[m, best[before] - 1], ids[m, best[before]])

    def _add(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Codes of new pieces, whose ids stand end to end."""
        first, n = self._known, len(sizes)
        self._flat = _room(self._flat, self._used + len(ids))
        self._flat[self._used : self._used + len(ids)] = ids
        self._begin, self._size = _room(self._begin, first + n), _room(self._size, first + n)
        self._size[first : first + n] = sizes
        self._begin[first : first + n] = self._used + np.cumsum(sizes) - sizes
        self._used += len(ids)
        self._known += n
        return np.arange(first, first + n)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) + keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(24)).astype(np.int64) & (len(self._slot) - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The codes of pieces by their two integers; -1 where one isn't known."""
        at, last = self._place(keys), len(self._slot) - 1
        codes = self._slot[at]
        left = np.flatnonzero((self._key[codes] != keys).any(axis=1) & (codes >= 0))
        while len(left):
            at[left] = (at[left] + 1) & last
            codes[left] = self._slot[at[left]]
            left = left[(self._key[codes[left]] != keys[left]).any(axis=1) & (codes[left] >= 0)]
        return codes

    def _learn(self, keys: np.ndarray) -> None:
        """Merges new pieces, different from each other and from all that are known."""
        done = self._merge(keys.view(np.uint8))
        places, sizes, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        codes = self._add(sizes, ids)
        self._key = _room(self._key, self._known)
        self._key[codes] = keys[places]
        if 2 * self._known > len(self._slot):
            self._slot = np.full(1 << (4 * self._known).bit_length(), -1, dtype=np.int32)
            codes = np.flatnonzero(self._key[: self._known].any(axis=1))  # long pieces have no integers
        at, left, last = self._place(self._key[codes]), np.arange(len(codes)), len(self._slot) - 1
        while len(left):
            free = left[self._slot[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self._slot[at[put]] = codes[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & last

    def _cut(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the pieces of lower-case UTF-8 bytes that end in a space."""
        kind = self._kind[text]
        inner = (text & 0xC0) == 0x80
        wide = np.flatnonzero(text >= 0xC0)  # two bytes each, in the Latin range
        if len(wide):
            kind[wide] = kind[wide + 1] = self._kind[(text[wide] & 0x1F).astype(np.int64) << 6 | (text[wide + 1] & 0x3F)]
        begins = np.empty(len(text), dtype=bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == _DIGITS
        quotes = np.flatnonzero(begins & (text == 39))
        begins &= ~inner
        for tail in _CLIPPED if len(quotes) else ():
            at = quotes[quotes + len(tail) < len(text)]
            for k, c in enumerate(tail.encode(), 1):
                at = at[text[at + k] == c]
            begins[at + 1] = False
            begins[at + 1 + len(tail)] = True  # not inside a character: the tail is plain
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(text))
        real = kind[starts] != _SPACES
        return starts[real], ends[real]

    def _codes(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(begins, codes) of the pieces of lower-case text, which ends in a space."""
        data = np.frombuffer(text + bytes(_LONGEST), np.uint8)
        starts, ends = self._cut(data[: len(text)])
        eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
        n = ends - starts
        keys = np.empty((len(starts), 2), dtype=np.uint64)
        keys[:, 0] = eights[starts] & _MASKS[np.minimum(n, 8)]
        keys[:, 1] = eights[starts + 8] & _MASKS[np.clip(n - 8, 0, 8)]
        short = n <= _LONGEST
        codes = self._find(keys)
        codes[~short] = 0
        new = keys[codes < 0]
        if len(new):
            new = new[np.lexsort((new[:, 1], new[:, 0]))]
            self._learn(new[np.append(True, (new[1:] != new[:-1]).any(axis=1))])
            lack = np.flatnonzero(codes < 0)
            codes[lack] = self._find(keys[lack])
        for i in np.flatnonzero(~short).tolist():
            piece = text[starts[i] : ends[i]]
            code = self._long.get(piece)
            if code is None:
                ids = np.array(self._lib.encode(piece.decode(), add_special_tokens=False).ids, dtype=np.uint32)
                code = self._long[piece] = int(self._add(np.array([len(ids)]), ids)[0])
                self._key = _room(self._key, self._known)
            codes[i] = code
        return starts, codes

    def _ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' ids end to end, and where each one's end."""
        size = self._size[codes]
        ends = np.cumsum(size)
        at = np.repeat(self._begin[codes] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self._flat[at], ends

    def _stretch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of lower-case texts that are cut to pieces together."""
        if self._known > CACHE_WORDS:
            self._start()
        raw = [t.encode() for t in texts]
        borders = np.cumsum([len(r) + 1 for r in raw])
        starts, codes = self._codes(b" ".join([*raw, b""]))
        ids, ends = self._ids(codes)
        pieces = np.searchsorted(starts, borders)
        return np.split(ids, np.append(0, ends)[pieces][:-1])

    def _plain(self, text: str) -> str | None:
        """In lower case; None where the text is one for the library."""
        if not text.isascii() and _BEYOND.search(text) or text.isascii() and any(c in text for c in _CONTROLS):
            return None
        low = text.lower()
        if not low.isascii() and _BEYOND.search(low) or any(a in low for a in self._added):
            return None
        return low

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        held, room = [], 0

        def put() -> None:
            for i, ids in zip([i for i, _ in held], self._stretch([t for _, t in held]), strict=True):
                out[i] = ids

        for i, text in enumerate(texts):
            low = self._plain(text)
            if low is None:
                out[i] = np.array(self._lib.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            elif len(low) > STRETCH:
                out[i] = np.concatenate([self._stretch([part])[0] for part in _parts(low)])
            else:
                if room + len(low) > STRETCH:
                    put()
                    held, room = [], 0
                held.append((i, low))
                room += len(low)
        if held:
            put()
        return out


def _kind_of(c: str) -> int:
    return next((k for k, p in ((_LETTERS, _LETTER), (_DIGITS, _DIGIT), (_SPACES, _SPACE)) if re.fullmatch(p, c)), _OTHERS)


def _parts(text: str) -> Iterator[str]:
    """A long text in stretches that end at spaces, which no piece spans."""
    at = 0
    while at < len(text):
        space = _SPACED.search(text, at + STRETCH)
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    more = np.zeros((max(n, 2 * len(a)), *a.shape[1:]), dtype=a.dtype)
    more[: len(a)] = a
    return more


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and path."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
