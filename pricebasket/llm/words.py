"""Words of texts as 64-bit hashes, for whole batches at once."""

from __future__ import annotations

import numpy as np

#: Bytes between words: space and tab to carriage return.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: All of ASCII but letters and digits.
MARKS = ~ALNUM & (np.arange(256) < 128)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 1 << 18


def finalize(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two hashes in order."""
    with np.errstate(over="ignore"):
        return finalize(first * np.uint64(0xA0761D6478BD642F) + (second ^ (second >> np.uint64(29))) * np.uint64(0xE7037ED1A0B428DB))


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64, by doubling."""
    found = np.ones(max(count, 1), np.uint64)
    with np.errstate(over="ignore"):
        size, factor = 1, base
        while size < found.size:
            step = min(size, found.size - size)
            found[size : size + step] = found[:step] * np.uint64(factor)
            size, factor = size + step, factor * factor % (1 << 64)
    return found


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of texts, after lower-casing A-Z unless ``lower`` is off.

    ``between`` marks the bytes that part words (one of them the blank), others than those if given.

    ``hashes`` holds all words behind one another; document i has those from ``bounds[i]`` to
    ``bounds[i + 1]``. ``first`` and ``last`` are byte places in ``data``, all texts' UTF-8 bytes, each
    followed by a blank; ``texts`` has the place where each text begins (and the end of all).

    A word's hash is a sum of random byte values times powers of an odd number, modulo 2**64, mixed.
    With ``tails``, one stop or comma that ends a word after a letter or digit of ASCII is a word of its own.
    """

    def __init__(self, texts: list[str | None], tails: bool = False, lower: bool = True, between: np.ndarray = BLANK):
        self._case = LOWER if lower else SAME
        raw = [(text or "").encode("utf-8", "replace") for text in texts]
        self.texts = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(each) + 1 for each in raw], out=self.texts[1:])
        self.data = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
        blank = between[self.data]
        edges = np.diff(blank.astype(np.int8), prepend=1)
        self.first, self.last = np.flatnonzero(edges < 0), np.flatnonzero(edges > 0)
        if tails and self.first.size:
            self._split_tails()
        self.hashes = self._hash()
        self.bounds = np.searchsorted(self.first, self.texts)

    def _split_tails(self) -> None:
        stop = self.data[self.last - 1]
        cut = ((stop == 46) | (stop == 44)) & (self.last - self.first > 1) & ALNUM[self.data[self.last - 2]]
        place = np.repeat(np.arange(cut.size), 1 + cut)
        second = np.concatenate([[False], place[1:] == place[:-1]])
        head = np.concatenate([second[1:], [False]])
        first, last = self.first[place], self.last[place]
        self.first = np.where(second, last - 1, first)
        self.last = np.where(head, last - 1, last)

    def _hash(self) -> np.ndarray:
        """Over blocks that end between words, so that their tables of powers stay small."""
        found, at = [], 0
        while at < self.first.size:
            start = int(self.first[at])
            upto = int(np.searchsorted(self.last, start + _STEP, "right"))
            upto = max(upto, at + 1)
            stop = int(self.last[upto - 1])
            power, inverse = _tables(stop - start + 1)
            with np.errstate(over="ignore"):
                sums = np.zeros(stop - start + 1, np.uint64)
                np.cumsum(_BYTE[self._case[self.data[start:stop]]] * power[: stop - start], out=sums[1:])
                first, last = self.first[at:upto] - start, self.last[at:upto] - start
                value = (sums[last] - sums[first]) * inverse[first]
                found.append(finalize(value + (last - first).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)))
            at = upto
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


_KEPT: list[np.ndarray] = [powers(_BASE, 1 << 12), powers(_INVERSE, 1 << 12)]


def _tables(size: int) -> list[np.ndarray]:
    if _KEPT[0].size < size:
        full = 1 << (size - 1).bit_length()
        made = [powers(_BASE, full), powers(_INVERSE, full)]
        if full > 2 * _STEP:
            return made
        _KEPT[:] = made
    return _KEPT
