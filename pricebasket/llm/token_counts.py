"""Token counts of whole texts under a sentencepiece BPE model, by merging ragged arrays in step.

The model's own library normalises a text and names the pieces; the merges are done here. A text falls
apart between any two characters that no piece holds side by side, as no merge can cross there. The
parts (pre-tokens) of a block of text lie behind one another in one array of symbols; in each round
every pre-token merges its pair of lowest rank, at all places where that is what one merge at a time
would do, and ranks are looked up again only beside merged places. Equal pre-tokens of a block are merged
once, and a worker remembers the counts of some hundred thousand, known by two 64-bit hashes.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from pricebasket.llm.batches import with_columns
from pricebasket.llm.words import finalize, powers

#: Rank of a pair that is no piece.
NONE = np.int32(2**31 - 1)
#: Characters of pre-tokens merged in one array.
STEP = 1 << 20
#: Symbols from which a pre-token is merged by itself through a heap: rounds there would each scan it whole.
LONG = 4096
#: Pre-tokens whose counts a worker remembers.
KEEP = 400_000
_BASE = 0x9E3779B97F4A7C15 | 1
_POWER, _INVERSE = powers(_BASE, STEP), powers(pow(_BASE, -1, 1 << 64), STEP)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Merger:
    """The merges of one model: BPE with byte fallback and without pieces of the user's own."""

    def __init__(self, path: str):
        import sentencepiece

        self._library = of = sentencepiece.SentencePieceProcessor(model_file=path)
        size = of.get_piece_size()
        if not any(of.is_byte(i) for i in range(size)) or any(of.is_unused(i) for i in range(size)):
            raise ValueError("only models with byte fallback and without unused pieces can be counted")
        number = {of.id_to_piece(i): i for i in range(size) if not (of.is_byte(i) or of.is_control(i) or of.is_unknown(i))}
        joined = [piece for piece in number if len(piece) > 1]
        letters = sorted({letter for piece in joined for letter in piece})
        # A letter of pieces that is none itself still takes part in merges.
        symbol = number | {letter: size + i for i, letter in enumerate(set(letters) - number.keys())}
        self._symbols = size + len(letters)

        # Tokens that a character, or a symbol, counts for if it stays: its bytes unless it is a piece.
        points = np.arange(0x110000)
        self._alone = (1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.uint8)
        self._alone[[ord(piece) for piece in number if len(piece) == 1]] = 1
        self._weight = np.ones(self._symbols, np.int64)
        self._weight[[symbol[letter] for letter in letters]] = self._alone[[ord(letter) for letter in letters]]

        # Letters of pieces by number, and which may stand side by side in one.
        self._letter = np.zeros(0x110000, np.uint16)
        self._letter[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        self._of_letter = np.array([-1, *(symbol[letter] for letter in letters)], np.int32)
        self._codes = np.random.default_rng(7).integers(1, 1 << 63, (2, len(letters) + 1), dtype=np.uint64)
        self._beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for piece in joined:
            places = self._letter[[ord(letter) for letter in piece]]
            self._beside[places[:-1], places[1:]] = True

        # The best score is rank 0; pieces of one score share a rank, and the leftmost goes first.
        ranks = {score: i for i, score in enumerate(sorted({of.get_score(number[piece]) for piece in joined}, reverse=True))}
        rank = np.full(self._symbols, NONE, np.int32)
        pairs = {}
        for piece in joined:
            rank[number[piece]] = ranks[of.get_score(number[piece])]
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self._symbols + right] = number[piece]
        self._table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32), rank)
        self._forget()

    def _table(self, keys: np.ndarray, made: np.ndarray, rank: np.ndarray) -> None:
        """Pairs in an open table at most a quarter full, each at its hash or the next free slot."""
        bits = (4 * keys.size).bit_length()
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, np.int64)
        self._rank, self._made = np.full(1 << bits, NONE, np.int32), np.zeros(1 << bits, np.int32)
        slot = self._slot(keys)
        while keys.size:
            free = self._keys[slot] < 0
            place, one = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[one]
            self._keys[place], self._made[place], self._rank[place] = keys[won], made[won], rank[made[won]]
            rest = np.ones(keys.size, bool)
            rest[won] = False
            keys, made, slot = keys[rest], made[rest], (slot[rest] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys.astype(np.uint64) * np.uint64(_BASE) >> self._shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank, and piece made, of each pair of symbols."""
        key = left.astype(np.int64) * self._symbols + right
        slot = self._slot(key)
        there = self._keys[slot]
        other = np.flatnonzero((there != key) & (there >= 0))
        while other.size:
            slot[other] = (slot[other] + 1) & self._mask
            there = self._keys[slot[other]]
            other = other[(there != key[other]) & (there >= 0)]
        # A free slot has no rank.
        return self._rank[slot], self._made[slot]

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)  # ascending
        self._check, self._count = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The tokens of each text; none for an empty one or None."""
        plain = [self._library.normalize(text) if text else "" for text in texts]
        edges = np.concatenate([[0], np.cumsum([len(text) for text in plain])]).astype(np.int64)
        flat = np.frombuffer("".join(plain).encode("utf-32-le"), "<u4")
        if not flat.size:
            return np.zeros(len(texts), np.int64)
        letter = self._letter[flat]
        cut = np.ones(flat.size, bool)
        cut[1:] = ~self._beside[letter[:-1], letter[1:]]
        cut[edges[:-1][edges[:-1] < flat.size]] = True
        starts = np.flatnonzero(cut)
        tokens = self._alone[flat[starts]].astype(np.int64)
        sizes = np.diff(np.append(starts, flat.size))
        several = np.flatnonzero(sizes > 1)
        ends = np.cumsum(sizes[several])
        low = 0
        while low < several.size:
            before = ends[low] - sizes[several[low]]
            high = max(low + 1, int(np.searchsorted(ends, before + STEP, "right")))
            some = several[low:high]
            tokens[some] = self._distinct(letter, starts[some], sizes[some])
            low = high
        sums = np.concatenate([[0], np.cumsum(tokens)])
        return np.diff(sums[np.searchsorted(starts, edges)])

    def _distinct(self, letter: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The tokens of the pre-tokens at ``starts``, equal ones merged once."""
        if sizes.size == 1:
            return self._tokens(self._of_letter[letter[starts[0] : starts[0] + sizes[0]]], sizes)
        first = np.cumsum(sizes) - sizes
        letters = letter[np.repeat(starts - first, sizes) + np.arange(first[-1] + sizes[-1])]
        keys, checks = (self._hashes(letters, first, sizes, code) for code in self._codes)
        keys, one, place = np.unique(keys, return_index=True, return_inverse=True)
        if (checks[one][place] != checks).any():
            # Two pre-tokens of one first hash: this block is merged as it is.
            return self._tokens(self._of_letter[letters], sizes)
        checks = checks[one]
        if self._known.size > KEEP:
            self._forget()
        at = np.searchsorted(self._known, keys)
        there = np.minimum(at, self._known.size - 1)
        known = (self._known[there] == keys) & (self._check[there] == checks) if self._known.size else np.zeros(keys.size, bool)
        found = np.zeros(keys.size, np.int64)
        found[known] = self._count[there[known]]
        new = np.flatnonzero(~known)
        if new.size:
            kept = sizes[one[new]]
            shift = np.cumsum(kept) - kept
            symbols = self._of_letter[letters[np.repeat(first[one[new]] - shift, kept) + np.arange(kept.sum())]]
            found[new] = self._tokens(symbols, kept)
            self._known = np.insert(self._known, at[new], keys[new])
            self._check, self._count = np.insert(self._check, at[new], checks[new]), np.insert(self._count, at[new], found[new])
        return found[place]

    def _hashes(self, letters: np.ndarray, first: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = np.zeros(letters.size + 1, np.uint64)
            np.cumsum(code[letters] * _POWER[: letters.size], out=sums[1:])
            return finalize((sums[first + sizes] - sums[first]) * _INVERSE[first] + sizes.astype(np.uint64))

    def _tokens(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        found = np.zeros(sizes.size, np.int64)
        long = sizes > LONG
        ends = np.cumsum(sizes)
        for i in np.flatnonzero(long).tolist():
            found[i] = self._by_heap(symbols[ends[i] - sizes[i] : ends[i]].tolist())
        short = np.flatnonzero(~long)
        if short.size:
            found[short] = self._in_step(symbols[np.repeat(~long, sizes)], sizes[short])
        return found

    def _in_step(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Round by round, the lowest-ranked pair of every pre-token."""
        found = np.zeros(sizes.size, np.int64)
        of = np.arange(sizes.size)
        sizes = sizes.copy()
        starts = np.cumsum(sizes) - sizes
        rank, made = np.full(symbols.size, NONE, np.int32), np.zeros(symbols.size, np.int32)
        rank[:-1], made[:-1] = self._pairs(symbols[:-1], symbols[1:])
        rank[starts + sizes - 1] = NONE
        while True:
            low = np.minimum.reduceat(rank, starts)
            done = low == NONE
            if done.any():
                found[of[done]] = np.add.reduceat(self._weight[symbols], starts)[done]
                if done.all():
                    return found
                stay = np.repeat(~done, sizes)
                symbols, rank, made = symbols[stay], rank[stay], made[stay]
                of, sizes, low = of[~done], sizes[~done], low[~done]
                starts = np.cumsum(sizes) - sizes
            # Places of the lowest rank; of places that overlap, every second one from the left.
            owner = np.repeat(np.arange(sizes.size), sizes)
            hits = np.flatnonzero(rank == low[owner])
            order = np.arange(hits.size)
            opens = np.concatenate([[True], np.diff(hits) > 1])
            at = hits[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
            seq, new = owner[at], made[at]
            # A merge that brings up a pair of the same rank or a lower one is the round's last in its pre-token.
            touching = np.concatenate([[False], np.diff(at) == 2])
            left = np.where(touching, np.concatenate([new[:1], new[:-1]]), symbols[np.maximum(at - 1, 0)])
            before = np.where(at > starts[seq], self._pairs(left, new)[0], NONE)
            inside = at + 2 < starts[seq] + sizes[seq]
            after = np.where(inside, self._pairs(new, symbols[np.minimum(at + 2, symbols.size - 1)])[0], NONE)
            stops = np.minimum(before, after) <= low[seq]
            past = np.cumsum(stops) - stops
            good = past == past[np.searchsorted(seq, seq)]
            at, seq = at[good], seq[good]
            symbols[at] = new[good]
            stay = np.ones(symbols.size, bool)
            stay[at + 1] = False
            sizes = sizes - np.bincount(seq, minlength=sizes.size)
            starts = np.cumsum(sizes) - sizes
            here = np.cumsum(stay)[at] - 1
            symbols, rank, made = symbols[stay], rank[stay], made[stay]
            here = np.concatenate([here, here[here > starts[seq]] - 1])
            rank[here], made[here] = self._pairs(symbols[here], symbols[np.minimum(here + 1, symbols.size - 1)])
            rank[starts + sizes - 1] = NONE

    def _by_heap(self, symbols: list[int]) -> int:
        """One very long pre-token: the same merges, the next one from a heap of (rank, place)."""
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        ranks, made = self._pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
        heap = [(rank, i, symbols[i], symbols[i + 1], new) for i, (rank, new) in enumerate(zip(ranks.tolist(), made.tolist())) if rank != NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def push(i: int, j: int) -> None:
            pair = symbols[i], symbols[j]
            if pair not in known:
                rank, new = self._pairs(np.array(pair[:1]), np.array(pair[1:]))
                known[pair] = int(rank[0]), int(new[0])
            rank, new = known[pair]
            if rank != NONE:
                heapq.heappush(heap, (rank, i, *pair, new))

        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j == size or symbols[j] != right:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return int(self._weight[[symbol for symbol in symbols if symbol >= 0]].sum())


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One merger per worker process and model."""
    return Merger(path)


def with_counts(rows: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """The rows with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of ``text``.

    A null or empty text has no bytes and no tokens. All other columns, repeated rows and rows without an
    id stay as they are; of the rows' own columns none may bear a new column's name (``counts`` drops
    them). Nothing is shuffled, and no text is cut: a long one is merged in steps of a million characters.
    """
    path = path or default_path()

    def compute(texts: list[str | None]) -> dict:
        tokens = merger(path).count(texts)
        return {"n_bytes": [len(text.encode()) if text else 0 for text in texts], "n_tokens": tokens, "over_limit": tokens > limit}

    return with_columns(rows, ["text"], compute, "n_bytes long, n_tokens long, over_limit boolean")


def counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: a row for each of ``docs``, whatever further columns they have."""
    return with_counts(docs.select("doc_id", "text"), path, limit).drop("text")
