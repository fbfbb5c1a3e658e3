"""Token ids by a public tokenizer, with the ids of seen chunks remembered.

A chunk runs from one change of a visible character into white space to the
next, and from a letter to the punctuation mark behind it. The tokenizers used
here never merge across such places, so the ids of a text are those of its
chunks in turn, and a chunk that was seen before needs no second encoding.
Chunks are cut, hashed and looked up for many texts at once. Tests compare
with encoding each text as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

# Places in the table of one worker; it starts anew when this share is taken.
PLACES, FULL = 1 << 21, 0.7
# Bytes cut and looked up together; longer chunks are encoded each time.
TOGETHER, LONGEST = 1 << 19, 64
SPECIAL = b"<|"
# Control characters that some take for white space, and white space beyond ASCII, in UTF-8.
CONTROL = (b"\x1c", b"\x1d", b"\x1e", b"\x1f")
WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
GAP = re.compile(rb"(?<=\S)\s")

KIND = np.zeros(256, "u1")
BLANK, LETTER, MARK = 1, 2, 3
KIND[list(b" \t\n\r\x0b\x0c")] = BLANK
KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KIND[list(b".,;:!?")] = MARK
# Coefficients of two multilinear hashes; the last ones are for the length.
FACTORS = np.random.default_rng(20).integers(1, 1 << 63, (2, LONGEST + 1), dtype="u8") * np.uint64(2) + np.uint64(1)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)

_encoders: dict[tuple[str, bool, int], ChunkEncoder] = {}


class IdTable:
    """Ids by a 128-bit hash, open addressing; all operations take arrays."""

    def __init__(self, places: int, kind: str):
        self.ids = np.empty(1 << 12, kind)
        self.clear(places)

    def clear(self, places: int) -> None:
        self.shift = np.uint64(64 - (places.bit_length() - 1))
        self.first, self.second = np.zeros(places, "u8"), np.zeros(places, "u8")
        self.start, self.count = np.zeros(places, "u4"), np.zeros(places, "u4")
        self.taken = self.used = 0

    def room(self, more: int) -> bool:
        return self.taken + more <= FULL * len(self.first)

    def place(self, first: np.ndarray) -> np.ndarray:
        return (first * GOLDEN >> self.shift).astype("i8")

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it isn't there."""
        at = self.place(first)
        out = np.full(len(at), -1)
        left = np.arange(len(at))
        while len(left):
            key = self.first[at]
            hit = (key == first[left]) & (self.second[at] == second[left])
            out[left[hit]] = at[hit]
            on = ~hit & (key != 0)
            left, at = left[on], (at[on] + 1) & (len(self.first) - 1)
        return out

    def add(self, first: np.ndarray, second: np.ndarray, ids: list[list[int]]) -> None:
        """Enters new keys, all different, with their ids."""
        count = np.fromiter(map(len, ids), "i8", len(ids))
        total = int(count.sum())
        if self.used + total > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used + total), self.ids.dtype)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + total] = [i for row in ids for i in row]
        start = self.used + np.cumsum(count) - count
        self.used += total
        self.taken += len(ids)
        at, left = self.place(first), np.arange(len(first))
        while len(left):
            free = np.flatnonzero(self.first[at] == 0)
            _, one = np.unique(at[free], return_index=True)
            won = free[one]
            to, key = at[won], left[won]
            self.first[to], self.second[to] = first[key], second[key]
            self.start[to], self.count[to] = start[key], count[key]
            on = np.ones(len(left), bool)
            on[won] = False
            left, at = left[on], at[on]
            at = np.where(self.first[at] != 0, (at + 1) & (len(self.first) - 1), at)


class ChunkEncoder:
    """Encodes with ``Tokenizer.encode(text, add_special_tokens=False)``.

    ``lower`` is for tokenizers that lower-case and drop white space: chunks
    are then without white space and have A-Z in lower case, which shares more.
    """

    def __init__(self, path: str, lower: bool, places: int = PLACES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lower = lower
        self.table = IdTable(places, "u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "u4")

    def ids(self, raw: bytes) -> list[int]:
        return self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids

    def encode(self, raws: list[bytes]) -> list[bytes]:
        """Per UTF-8 text its ids as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in raws]
        owners: list[int] = []
        pieces: list[bytes] = []
        size = 0
        for i, raw in enumerate(raws):
            if SPECIAL in raw or any(c in raw for c in CONTROL) or (not raw.isascii() and WIDE.search(raw)):
                out[i].append(np.array(self.ids(raw), "<u4").tobytes())
                continue
            at = 0
            while at < len(raw):
                gap = GAP.search(raw, at + TOGETHER) if len(raw) - at > TOGETHER else None
                end = gap.start() if gap else len(raw)
                owners.append(i)
                pieces.append(raw[at:end])
                size += end - at
                at = end
                if size >= TOGETHER:
                    self._into(out, owners, pieces)
                    owners, pieces, size = [], [], 0
        self._into(out, owners, pieces)
        return [b"".join(parts) for parts in out]

    def _into(self, out: list[list[bytes]], owners: list[int], pieces: list[bytes]) -> None:
        if pieces:
            for i, ids in zip(owners, self.encode_pieces(pieces), strict=True):
                out[i].append(ids.astype("<u4").tobytes())

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        if self.lower:
            pieces = [p.lower() for p in pieces]
        whole = b"".join(pieces)
        text = np.frombuffer(whole, "u1")
        ends = np.cumsum([len(p) for p in pieces])
        kind = KIND[text]
        blank = kind == BLANK
        begins = np.zeros(len(text), bool)
        begins[ends[:-1]] = True
        begins[0] = True
        if self.lower:
            begins[1:] |= blank[:-1]
        else:
            begins[1:] |= blank[1:] & ~blank[:-1]
        begins[1:] |= (kind[1:] == MARK) & (kind[:-1] == LETTER)
        if self.lower:
            begins &= ~blank
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(text))
        if self.lower and len(first):
            # A word ends before the white space behind it.
            seen = np.cumsum(~blank)
            last = first + seen[last - 1] - seen[first] + 1
        ids, counts = self.look_up(whole, text, first, last - first)
        upto = np.concatenate([[0], np.cumsum(counts)])
        cuts = upto[np.searchsorted(first, ends)]
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def look_up(self, whole: bytes, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple:
        """All ids of the chunks in a row, and how many each has."""
        table = self.table
        short = size <= LONGEST
        begin, length = first[short], size[short]
        one, two = self.hashes(text, begin, length)
        found = table.find(one, two)
        new = np.flatnonzero(found < 0)
        _, pick = np.unique(one[new], return_index=True)
        pick = new[pick]
        if not table.room(len(pick)):
            _, pick = np.unique(one, return_index=True)
            new = np.arange(len(one))
            places = len(table.first)
            while len(pick) > FULL * places:
                places *= 2
            table.clear(places)
        if len(pick):
            a, n = begin[pick].tolist(), length[pick].tolist()
            table.add(one[pick], two[pick], [self.ids(whole[i : i + k]) for i, k in zip(a, n, strict=True)])
            found[new] = table.find(one[new], two[new])
        at = np.full(len(first), -1)
        at[short] = found
        starts, counts = table.start[at].astype("i8"), table.count[at].astype("i8")
        pool = table.ids[: table.used]
        long = np.flatnonzero(~short)
        if len(long):
            extra = [np.array(self.ids(whole[first[i] : first[i] + size[i]]), pool.dtype) for i in long]
            counts[long] = [len(e) for e in extra]
            starts[long] = len(pool) + np.cumsum(counts[long]) - counts[long]
            pool = np.concatenate([pool, *extra])
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return pool[np.repeat(starts - ends + counts, counts) + np.arange(total)], counts

    def hashes(self, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of each chunk; the first is never 0."""
        if not len(first):
            return np.zeros(0, "u8"), np.zeros(0, "u8")
        begin = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(begin, size)
        letters = text[np.repeat(first, size) + inside].astype("u8") + np.uint64(1)
        one, two = (
            np.add.reduceat(FACTORS[k][inside] * letters, begin) + FACTORS[k][LONGEST] * size.astype("u8")
            for k in (0, 1)
        )
        return np.maximum(one, np.uint64(1)), two


def encoder(path: str, lower: bool, places: int = PLACES) -> ChunkEncoder:
    """One encoder per worker process, kept between tasks."""
    key = (path, lower, places)
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]
