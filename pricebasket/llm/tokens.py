"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from pricebasket.llm.words import Words


#: Texts encoded at once.
BATCH = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Encodes each distinct word between blanks once and puts texts' ids together from those.

    The tokenizer lower-cases, drops white space and never joins across it, and a final stop or comma
    after a letter or digit is a piece of its own, so a text's ids are its words' ids in a row. Words
    are known by a 64-bit hash; about ``keep`` are remembered. Texts in which a special token's text may
    stand are encoded in one go.
    """

    def __init__(self, path: str, keep: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._keep = keep
        self._forget()

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # ascending
        self._starts = self._sizes = np.zeros(0, np.int64)
        self._flat = np.zeros(0, self.dtype)

    def _ids(self, texts: list[str]) -> list[array]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self._code, each.ids) for each in found]

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Add ``keys`` (ascending, unknown so far) and their words."""
        found = self._ids(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.frombuffer(b"".join(each.tobytes() for each in found), self.dtype)
        at = np.searchsorted(self._keys, keys)
        starts = self._flat.size + np.cumsum(sizes) - sizes
        self._keys = np.insert(self._keys, at, keys)
        self._starts, self._sizes = np.insert(self._starts, at, starts), np.insert(self._sizes, at, sizes)
        self._flat = np.concatenate([self._flat, flat])

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """The ids of each text (None: empty) and then ``end``."""
        special = [i for i, text in enumerate(texts) if text and "<|" in text]
        of = Words(["" if text and "<|" in text else text for text in texts], tails=True)
        keys, first, place = np.unique(of.hashes, return_index=True, return_inverse=True)
        if self._keys.size > self._keep:
            self._forget()
        at = np.searchsorted(self._keys, keys)
        new = np.concatenate([self._keys, [0]])[at] != keys if self._keys.size else np.ones(keys.size, bool)
        new |= at == self._keys.size
        if new.any():
            raw, low, high = of.data.tobytes(), of.first[first[new]].tolist(), of.last[first[new]].tolist()
            # Lower-cased, as equal words are; bytes.lower() changes A-Z alone.
            self._learn(keys[new], [raw[a:b].lower().decode() for a, b in zip(low, high)])
            at = np.searchsorted(self._keys, keys)
        at = at[place]
        sizes = self._sizes[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._flat[np.repeat(self._starts[at] - total[:-1], sizes) + np.arange(total[-1])]
        ends = total[of.bounds]
        last = np.array([end], self.dtype)
        found = [np.append(ids[a:b], last) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for i in special:
            found[i] = np.append(np.frombuffer(self._ids([texts[i]])[0], self.dtype), last)
        return found


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def encoded(path: str, texts: list[str | None], end: int) -> Iterator[np.ndarray]:
    """The ids of each text in turn, some texts at a time."""
    for at in range(0, len(texts), BATCH):
        yield from encoder(path).encode(texts[at : at + BATCH], end)
