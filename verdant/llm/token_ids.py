"""Token ids of whole texts by a ``tokenizers`` file, with a memory of units already encoded.

A tokenizer whose pre-tokenizer never joins characters across white space gives a text the concatenation of
its words' ids.  Words of plain letters (ASCII and Latin-1), digits and marks are cut further, where the
pre-tokenizer cuts, and each distinct part goes to the model once per Python worker; any other word (an
apostrophe, other scripts, control characters, ``<|``) is a unit of its own for the full tokenizer.  Units are
known by 64-bit hashes.  Only for files of this kind (``word_bpe_49k.json``); ``tests/llm/test_tokens.py`` compares.
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from verdant.llm.arrays import LOWER, range_hash

#: Distinct units kept by one worker; beyond it the memory starts anew (bounds memory, changes no result).
MEMORY_UNITS = 1_500_000

SPACE, LETTER, DIGIT, MARK, ODD = range(5)
CLASS = np.full(256, ODD, np.uint8)
CLASS[0x21:0x7F] = MARK
CLASS[ord("0") : ord("9") + 1] = DIGIT
CLASS[ord("a") : ord("z") + 1] = CLASS[ord("A") : ord("Z") + 1] = CLASS[0xC3] = LETTER
CLASS[ord("'")] = ODD
CLASS[[ord(" "), ord("\n")]] = SPACE

_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(folded bytes, starts, ends, whether odd) of the units of a batch of texts."""
    n = len(data)
    kind, low = CLASS[data], LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    letter = (after != 0x97) & (after != 0xB7)  # the signs for times and divided by
    kind[lead[letter] + 1] = LETTER
    low[lead[letter & (after < 0x9F)] + 1] += 0x20
    kind[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))] = ODD
    inside = kind != SPACE
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, closes = inside.copy(), np.zeros(n + 1, bool)
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes[1:] = inside & np.append(~inside[1:] | edge[1:-1], True)
    parts = begins | (inside & (kind == DIGIT))
    parts[1:] |= inside[1:] & (kind[1:] != kind[:-1])
    odd = np.flatnonzero(kind == ODD)
    words, ends = np.flatnonzero(begins), np.flatnonzero(closes)
    odd_words = np.unique(np.searchsorted(words, odd, "right") - 1)
    for a, b in zip(words[odd_words].tolist(), ends[odd_words].tolist()):
        parts[a + 1 : b] = False
        low[a:b] = data[a:b]
    starts = np.flatnonzero(parts)
    closes[:-1] |= parts
    bounds = np.flatnonzero(closes)
    return low, starts, bounds[np.searchsorted(bounds, starts, "right")], np.isin(starts, words[odd_words])


class WordEncoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.bits, self.count, self.used = 16, 0, 0
        self.keys, self.slots = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint16)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each unit, -1 for unknown ones: a hash table with open addressing."""
        mask = (1 << self.bits) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        found = np.where(self.keys[at] == hashes, self.slots[at], -1)
        left = np.flatnonzero((found < 0) & (self.keys[at] != 0))
        while len(left):
            at[left] = (at[left] + 1) & mask
            key = self.keys[at[left]]
            hit = key == hashes[left]
            found[left[hit]] = self.slots[at[left[hit]]]
            left = left[~hit & (key != 0)]
        return found

    def _enter(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        if 2 * (self.count + len(hashes)) > len(self.keys):
            old = self.keys != 0
            hashes, slots = np.append(self.keys[old], hashes), np.append(self.slots[old], slots)
            while 2 * len(hashes) > 1 << self.bits:
                self.bits += 1
            self.keys, self.slots = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        mask = (1 << self.bits) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            self.keys[at[free]] = hashes[free]  # of several at one place the last stays
            placed = self.keys[at[left]] == hashes[left]
            self.slots[at[left[placed]]] = slots[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & mask

    def _learn(self, hashes: np.ndarray, texts: list[str], odd: list[bool]) -> None:
        tokenize, letters, new = self.tokenizer.model.tokenize, self.letters, []
        for text, whole in zip(texts, odd):
            if whole:
                new.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                spelled = text if text.isascii() else "".join(map(letters.__getitem__, text.encode()))
                new.append([t.id for t in tokenize(spelled)])
        sizes = np.array([len(x) for x in new])
        ids = np.array([i for x in new for i in x], np.uint16)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while self.count + len(new) > len(self.start):
            self.start, self.size = np.append(self.start, self.start * 0), np.append(self.size, self.size * 0)
        to = slice(self.count, self.count + len(new))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[to] = sizes
        self.start[to] = self.used + np.cumsum(sizes) - sizes
        self._enter(hashes, np.arange(to.start, to.stop, dtype=np.int32))
        self.used += len(ids)
        self.count = to.stop

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """uint16 ids of every text of a batch (``arrays.utf8``)."""
        if not len(data):
            return [np.zeros(0, np.uint16)] * (len(offsets) - 1)
        if self.count > MEMORY_UNITS:
            self.forget()
        low, starts, ends, odd = units(data, offsets)
        hashes = range_hash(low, starts, ends) | np.uint64(1)
        at = self._find(hashes)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            fresh = fresh[np.unique(hashes[fresh], return_index=True)[1]]
            raw = low.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
            self._learn(hashes[fresh], texts, odd[fresh].tolist())
            at = self._find(hashes)
        size = self.size[at]
        reach = np.cumsum(size)
        total = int(reach[-1]) if len(reach) else 0
        ids = self.flat[np.repeat(self.start[at] - reach + size, size) + np.arange(total)]
        return np.split(ids, np.append(0, reach)[np.searchsorted(starts, offsets[1:-1])])


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
