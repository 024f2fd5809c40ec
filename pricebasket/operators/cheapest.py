"""The lowest total of each cart over all stores that carry it, without a total for every cart and store.

Offers lie in array files in the shared folder, by shards of names: the prices of each name by store, and words of stores for its
cheapest half, quarter and so on. The tasks that hold the carts map these files. A cart looks at stores that are among the cheapest for all of its products; the least
total found there says how dear each product can be in a store that is better still, and that bounds the second, last look. Every total that
could be the least is found; what is shuffled and stored grows with lines and offers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket import array_files, schemas
from pricebasket.operators import basket
from pricebasket.session import broadcast_if_small, new_dir, spread, stage

#: Offers that a shard of names should hold, and words of stores that a task looks at in one go.
SHARD_OFFERS, CHUNK_WORDS = 2_000_000, 1 << 20
#: Level i of a name has words for the cheapest of 2**i parts of its offers; a first look should find so many stores.
LEVELS, AIM = 6, 8
#: No total; totals surely below ``basket.MOST_LONG`` are long integers, others Python's.
NONE = np.iinfo(np.int64).max


def _write_shard(uri: str, name_no: np.ndarray, slot: np.ndarray, price: np.ndarray, words: int) -> None:
    """The offers of a shard, a row per name and slot. Prices are in cents."""
    order = np.lexsort((slot, name_no))
    name_no, slot, price = name_no[order], slot[order], price[order]
    names, starts, counts = np.unique(name_no, return_index=True, return_counts=True)
    index = np.repeat(np.arange(names.size), counts)
    width = words * basket.WORD_BITS
    by_price = np.lexsort((price, index))
    rank = np.empty(price.size, np.int64)
    rank[by_price] = np.arange(price.size) - starts[index]
    # Words for names that fill them with a store each at least; the offers of others are gone through one by one.
    dense = counts >= words
    place = np.where(dense, np.cumsum(dense) - 1, -1)
    cuts, bits = np.full((LEVELS, names.size), NONE), np.zeros((LEVELS, int(dense.sum()), words), "<i8")
    for level in range(LEVELS):
        first = -(-counts // 2**level)
        cut = first < counts
        cuts[level, cut] = price[by_price[(starts + first)[cut]]]
        held = (rank < first[index]) & dense[index]
        flags = np.zeros((bits.shape[1], width), bool)
        flags[place[index[held]], slot[held]] = True
        bits[level] = np.packbits(flags, axis=1, bitorder="little").view("<i8")
    # How many offers of the name lie in words before each: an offer's place is that and its bit's rank.
    ones = np.bitwise_count(bits[0].view(np.uint64)).astype(np.int32)
    before = np.cumsum(ones, axis=1, dtype=np.int32) - ones
    array_files.write_arrays(uri, {
        "names": names, "starts": starts.astype(np.int64), "counts": counts.astype(np.int64), "place": place.astype(np.int64), "cuts": cuts.ravel(),
        "low": price[by_price[starts]], "high": price[by_price[starts + counts - 1]], "keys": index * width + slot, "price": price, "bits": bits.ravel(), "before": before.ravel()})


def write_offers(words: DataFrame, names: DataFrame) -> tuple[str, int, list[int], int]:
    """Array files of all offers: their folder, the number of shards, those that have names, and the number of words of stores.

    ``words`` as from ``basket.product_words``; ``names``: name, name_no.
    """
    folder = new_dir(words.sparkSession, "offer-arrays")
    offers, last = words.agg(F.sum(F.size("prices")), F.max("word")).first()
    width, shards = (-1 if last is None else last) + 1, 1 << max(0, -(-(offers or 0) // SHARD_OFFERS) - 1).bit_length()

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def written(shard: int) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held.pop(shard))
            _write_shard(f"{folder}/{shard}.bin", *(rows[column].to_numpy() for column in ("name_no", "slot", "cents")), width)
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64())})

        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            for shard in np.unique(numbers).tolist():
                # Rows come by shard: what is held of another one is whole.
                yield from [written(other) for other in [*held] if other != shard]
                held.setdefault(shard, []).append(batch.filter(pa.array(numbers == shard)))
        yield from [written(other) for other in [*held]]

    entry = F.explode(F.map_entries("prices")).alias("of")
    rows = words.join(broadcast_if_small(names), "name").select("name_no", "word", entry).select(
        F.pmod("name_no", F.lit(shards)).alias("shard"), "name_no", (F.col("word") * basket.WORD_BITS + F.col("of.key")).cast("long").alias("slot"),
        (F.col("of.value").cast(schemas.PRICE) * 100).cast("long").alias("cents"))
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard")
    found = sorted({row["shard"] for row in dealt.mapInArrow(gathered, "shard long").collect()})
    return folder, shards, found, width


class _Offers:
    """Mapped arrays of all shards; a name is known by its place among the names of all of them."""

    def __init__(self, folder: str, found: tuple[int, ...], words: int):
        self.words, self.width = words, words * basket.WORD_BITS
        self.shards = [array_files.map_arrays(f"{folder}/{shard}.bin") for shard in found]
        sizes = [shard["names"].size for shard in self.shards]
        self.base = np.cumsum([0, *sizes])[:-1]
        self.shard_of = np.repeat(np.arange(len(sizes)), sizes)
        for column in ("starts", "counts", "place", "low", "high"):
            setattr(self, column, np.concatenate([shard[column] for shard in self.shards]))
        self.cuts = np.concatenate([shard["cuts"].reshape(LEVELS, -1) for shard in self.shards], axis=1)
        self.bits = [np.asarray(shard["bits"]).reshape(LEVELS, -1, words) for shard in self.shards]
        self.before = [np.asarray(shard["before"]).reshape(-1, words) for shard in self.shards]
        names = np.concatenate([shard["names"] for shard in self.shards])
        self._order = np.argsort(names)
        self._sorted = names[self._order]

    def names(self, name_no: np.ndarray) -> np.ndarray:
        return self._order[np.searchsorted(self._sorted, name_no)]

    def by_shard(self, names: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Shards, and where in ``names`` theirs are."""
        of = self.shard_of[names]
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(len(self.shards) + 1))
        for shard in np.flatnonzero(np.diff(edges)).tolist():
            yield shard, order[edges[shard] : edges[shard + 1]]

    def prices(self, names: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prices of names in stores, and whether they are on sale there."""
        price, there = np.zeros(names.size, np.int64), np.zeros(names.size, bool)
        for shard, rows in self.by_shard(names):
            dense = self.place[names[rows]] >= 0
            mine, slot = names[rows[dense]], slots[rows[dense]]
            place, word, bit = self.place[mine], slot // basket.WORD_BITS, (slot % basket.WORD_BITS).astype(np.uint64)
            bits, one = self.bits[shard][0][place, word].view(np.uint64), np.uint64(1)
            there[rows[dense]] = (bits >> bit) & one == one
            at = self.starts[mine] + self.before[shard][place, word] + np.bitwise_count(bits & ((one << bit) - one))
            values = self.shards[shard]["price"]
            price[rows[dense]] = values[np.minimum(at, values.size - 1)]
            few = rows[~dense]
            if few.size:
                keys, wanted = self.shards[shard]["keys"], (names[few] - self.base[shard]) * self.width + slots[few]
                at = np.minimum(np.searchsorted(keys, wanted), keys.size - 1)
                there[few], price[few] = keys[at] == wanted, values[at]
        return price, there

    def slots(self, name: int) -> np.ndarray:
        shard = self.shard_of[name]
        keys = self.shards[shard]["keys"][self.starts[name] : self.starts[name] + self.counts[name]]
        return keys - (name - self.base[shard]) * self.width


@lru_cache(maxsize=4)
def _opened(folder: str, found: tuple[int, ...], words: int) -> _Offers:
    """A worker maps the files once; pages come and go as they are used."""
    return _Offers(folder, found, words)


class _Carts:
    """Some carts: their names and units begin at ``starts``, ``counts`` of each."""

    def __init__(self, offers: _Offers, names: np.ndarray, units: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        self.offers, self.names, self.units, self.starts, self.counts = offers, names, units, starts, counts
        self.lines = int(counts.max()) if counts.size else 0

    def at(self, carts: np.ndarray, line: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``carts`` have that line, and where it is."""
        has = np.flatnonzero(self.counts[carts] > line)
        return has, self.starts[carts[has]] + line

    def carriers(self, carts: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``carts``, slot): stores among each line's cheapest, as far as its level says, for all lines of a cart."""
        common = np.full((carts.size, self.offers.words), -1, np.int64)
        for line in range(self.lines):
            has, at = self.at(carts, line)
            for shard, rows in self.offers.by_shard(self.names[at]):
                mine = at[rows]
                common[has[rows]] &= self.offers.bits[shard][level[mine], self.offers.place[self.names[mine]]]
        cart, word = np.nonzero(common)
        held = np.unpackbits(common[cart, word].astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        of, bit = np.nonzero(held)
        return cart[of], word[of] * basket.WORD_BITS + bit

    def least(self, carts: np.ndarray, cart: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """The least total of each of ``carts`` in the stores given, ``cart`` ascending; ``NONE`` where none of them carries it."""
        total, carried = np.zeros(cart.size, self.units.dtype), np.ones(cart.size, bool)
        for line in range(self.lines):
            has, at = self.at(carts[cart], line)
            price, there = self.offers.prices(self.names[at], slot[has])
            carried[has] &= there
            total[has] += self.units[at] * price
        cart, total = cart[carried], total[carried]
        out = np.full(carts.size, NONE, self.units.dtype)
        if cart.size:
            first = np.flatnonzero(np.concatenate([[True], np.diff(cart) != 0]))
            out[cart[first]] = np.minimum.reduceat(total, first)
        return out

    def one_by_one(self, carts: np.ndarray) -> np.ndarray:
        """``least`` in all stores that sell the name of a cart that the fewest sell."""
        rarest = np.zeros(carts.size, np.int64)
        fewest = np.full(carts.size, NONE)
        for line in range(self.lines):
            has, at = self.at(carts, line)
            n = self.offers.counts[self.names[at]]
            less = n < fewest[has]
            rarest[has[less]], fewest[has[less]] = self.names[at[less]], n[less]
        lists = [self.offers.slots(name) for name in rarest.tolist()]
        cart = np.repeat(np.arange(carts.size), [slots.size for slots in lists])
        return self.least(carts, cart, np.concatenate([np.zeros(0, np.int64), *lists]))

    def by_levels(self, carts: np.ndarray) -> np.ndarray:
        """``least`` in all stores, of carts whose names all have words and whose sums are long integers."""
        offers, best = self.offers, np.full(carts.size, NONE)
        floor = self.units * np.where(self.units > 0, offers.low[self.names], offers.high[self.names])
        floors, likely, bounded = np.zeros(carts.size, np.int64), np.full(carts.size, np.log2(max(1, offers.words * basket.GROUP_FILL))), np.zeros(carts.size)
        stores = likely.copy()
        for line in range(self.lines):
            has, at = self.at(carts, line)
            floors[has] += floor[at]
            likely[has] += np.log2(offers.counts[self.names[at]]) - stores[has]
            bounded[has] += self.units[at] > 0
        level = np.zeros(self.names.size, np.int64)
        first = np.clip((likely - np.log2(AIM)) / np.maximum(bounded, 1), 0, LEVELS - 1).astype(np.int64)
        for line in range(self.lines):
            has, at = self.at(carts, line)
            level[at] = np.where(self.units[at] > 0, first[has], 0)
        open_ = np.arange(carts.size)
        last = np.zeros(carts.size, bool)
        while open_.size:
            mine = carts[open_]
            best[open_] = np.minimum(best[open_], self.least(mine, *self.carriers(mine, level)))
            known = best[open_] != NONE
            changed = np.zeros(open_.size, bool)
            for line in range(self.lines):
                has, at = self.at(mine, line)
                units, names = self.units[at], self.names[at]
                # A store outside a level has that line's cut at least: the level suffices if that is no better than the best.
                wanted = np.where(known[has], 0, np.maximum(level[at] - 2, 0))
                others, found = floors[open_[has]] - floor[at], best[open_[has]]
                for deeper in range(1, LEVELS):
                    cut = offers.cuts[deeper, names]
                    enough = known[has] & (units > 0) & (cut != NONE)
                    enough[enough] = (others + units * np.where(enough, cut, 0))[enough] >= found[enough]
                    wanted[enough] = deeper
                changed[has] |= wanted < level[at]
                level[at] = wanted
            go = changed & ~last[open_]
            last[open_[known]] = True
            open_ = open_[go]
        return best


def _totals(offers: _Offers, rows: pa.RecordBatch, unit: int) -> tuple[np.ndarray, list]:
    """The lowest totals of carts in cents, and whether they have one."""
    lists = rows.column("name_nos")
    counts = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    names = offers.names(lists.flatten().to_numpy(zero_copy_only=False))
    units = rows.column("units").flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(counts) - counts
    of = np.repeat(np.arange(counts.size), counts)
    dearest = np.maximum(np.maximum(np.abs(offers.low.astype(float)), np.abs(offers.high.astype(float))), 1.0)[names]
    most = np.bincount(of, (np.abs(units.astype(float)) + 1) * dearest, counts.size)
    long_ = (most < basket.MOST_LONG / 4) & ~rows.column("wide").is_valid().to_numpy(zero_copy_only=False)
    best = np.full(counts.size, NONE)
    dense = np.bincount(of, offers.place[names] < 0, counts.size) == 0
    carts = _Carts(offers, names, units, starts, counts)
    single = np.flatnonzero(long_ & (counts == 1))
    line = starts[single]
    best[single] = units[line] * np.where(units[line] >= 0, offers.low[names[line]], offers.high[names[line]])
    step = max(1, CHUNK_WORDS // max(1, offers.words))
    for chosen, search in ((dense, carts.by_levels), (~dense, carts.one_by_one)):
        mine = np.flatnonzero(long_ & (counts > 1) & chosen)
        # Carts of as many lines go together.
        mine = mine[np.argsort(counts[mine], kind="stable")]
        for low in range(0, mine.size, step):
            part = mine[low : low + step]
            carts.lines = int(counts[part].max())
            best[part] = search(part)
    there = best != NONE
    sign = np.where(best < 0, -1, 1)
    cents = sign * ((np.where(there, np.abs(best), 0) + unit // 2) // unit)
    out: list = [str(number) if held else None for number, held in zip(cents.tolist(), there.tolist())] if not long_.all() else []
    for row in np.flatnonzero(~long_).tolist():
        exact = rows.column("wide")[row].as_py() or [str(number) for number in units[starts[row] : starts[row] + counts[row]].tolist()]
        span = slice(starts[row], starts[row] + counts[row])
        alone = _Carts(offers, names[span], np.array([int(number) for number in exact], object), np.zeros(1, np.int64), counts[row : row + 1])
        (found,) = alone.one_by_one(np.zeros(1, np.int64)).tolist()
        out[row] = None if found == NONE else str((abs(found) + unit // 2) // unit * (-1 if found < 0 else 1))
    return np.where(there, cents, 0), out if out else there.tolist()


def lowest_totals(carts: DataFrame, words: DataFrame) -> DataFrame:
    """cart_id and min_price_all, the lowest total over all stores that carry the cart: null where it names no quantity.

    ``carts`` as from ``basket.cart_products`` and stored; ``words`` as from ``basket.offered``. A cart without a cart_id, with a line that names no
    product or one that nobody sells has no row.
    """
    names = stage(words.filter("name IS NOT NULL").select("name").distinct().withColumn("name_no", F.monotonically_increasing_id()), "names")
    folder, _, found, width = write_offers(words.filter("name IS NOT NULL"), names)
    kind = carts.schema["quantity"].dataType
    unit = 10 ** kind.scale
    units = (F.coalesce("quantity", F.lit(0).cast(kind)) * unit).cast("decimal(38,0)")
    short = F.abs(units.cast("double")) < basket.MOST_LONG
    line = F.struct("name_no", F.when(short, units.cast("long")).otherwise(F.lit(0).cast("long")).alias("units"), units.cast("string").alias("exact"), short.alias("short"))
    asked = (
        spread(carts.filter(F.col("cart_id").isNotNull()).select("cart_id", "name", "quantity"), "cart_id")
        .join(broadcast_if_small(names), "name", "left")
        .groupBy("cart_id").agg(F.collect_list(line).alias("lines"), F.count("quantity").alias("quantities"), F.count("name_no").alias("named"))
        .filter(F.size("lines") == F.col("named"))
        .select("cart_id", (F.col("quantities") > 0).alias("priced"), F.col("lines.name_no").alias("name_nos"), F.col("lines.units").alias("units"),
                F.when(F.exists("lines.short", lambda enough: ~enough), F.col("lines.exact")).alias("wide"))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and found:
                cents, exact = _totals(_opened(folder, tuple(found), width), batch, unit)
                there = pa.array([entry is not None and entry is not False for entry in exact])
                text = pa.array([entry if isinstance(entry, str) else None for entry in exact], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [column.filter(there) for column in (batch.column("cart_id"), batch.column("priced"), pa.array(cents, pa.int64()), text)],
                    names=["cart_id", "priced", "cents", "exact"])

    cart_type = carts.schema["cart_id"].dataType.simpleString()
    whole = F.coalesce(F.col("exact").cast("decimal(35,0)"), F.col("cents").cast("decimal(35,0)"))
    return asked.mapInArrow(search, f"cart_id {cart_type}, priced boolean, cents long, exact string").select(
        "cart_id", F.when(F.col("priced"), whole * F.lit("0.01").cast("decimal(2,2)")).cast(schemas.TOTAL).alias("min_price_all"))
