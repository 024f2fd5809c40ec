"""Near-duplicate documents by minhash with tensored banding.

Two collections of ``m`` bands of ``rows`` minhashes each are computed; every pair of a band of the first and
a band of the second keys a table. So m*m tables of 2*rows hashes cost 2*m*rows minhashes instead of
2*m*m*rows. Two sets of similarity s meet in some table unless all bands of one collection differ,
with probability 2*(1 - s**rows)**m at most: 1e-5 for s = 0.8, rows = 2, m = 12.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricebasket.llm import batches, files, hash_arrays
from pricebasket.llm.components import components, joined
from pricebasket.llm.words import Words, finalize, pair
from pricebasket.session import new_dir, stage

ROWS, BANDS = 2, 12
HASHES = 2 * ROWS * BANDS
#: All pairs of an entry's first members up to the ninth are compared at first, and its first member with NEAR others.
HEADS, NEAR = 8, 32
#: About as many classes of large entries lie in a block; blocks that share an entry are compared whole.
MEMBERS = 512
#: Of 48 minhashes, a pair of similarity 0.8 shares fewer than these once in 10**8 pairs; of their low bytes, fewer still.
AGREE = 22
_rng = np.random.default_rng(80_02)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingles(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts as hashes, ascending in each text, and where each text's begin.

    A text with fewer words than ``size`` has its whole word sequence as its one shingle.
    """
    of = Words(texts)
    n = np.diff(of.bounds)
    doc = np.repeat(np.arange(n.size), n)
    found = of.hashes
    for step in range(1, size):
        found = pair(found, np.concatenate([of.hashes[step:], np.zeros(min(step, of.hashes.size), np.uint64)]))
    whole = np.arange(doc.size) + size <= of.bounds[doc + 1]
    short = np.flatnonzero((n > 0) & (n < size))
    extra = np.zeros(short.size, np.uint64)
    for i, row in enumerate(short.tolist()):
        for h in of.hashes[of.bounds[row] : of.bounds[row + 1]]:
            extra[i : i + 1] = pair(extra[i : i + 1], np.array([h]))
    doc, found = np.concatenate([doc[whole], short]), np.concatenate([found[whole], extra])
    order = np.lexsort((found, doc))
    doc, found = doc[order], found[order]
    new = np.ones(doc.size, bool)
    new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    return found[new], np.searchsorted(doc[new], np.arange(n.size + 1))


def _signed(texts: list[str | None], size: int) -> dict:
    """Size, 128-bit digest and minhashes (32 bits each; ``tag`` has the low 8 bits) of each text's shingle set."""
    found, bounds = shingles(texts, size)
    n = np.diff(bounds)
    held = n > 0
    starts = bounds[:-1][held]
    digest = np.zeros((2, n.size), np.uint64)
    least = np.zeros((n.size, HASHES), "<u4")
    if starts.size:
        with np.errstate(over="ignore"):
            for k in range(2):
                digest[k][held] = np.add.reduceat(finalize(found + np.uint64(0x51ED27 + k)), starts)
            for f in range(HASHES):
                least[held, f] = np.minimum.reduceat((found * _A[f] + _B[f]) >> np.uint64(32), starts)
    return {"n_shingles": n, "node": digest[0].view(np.int64), "check": digest[1].view(np.int64), "sig": [row.tobytes() for row in least],
            "tag": [row.tobytes() for row in least.astype(np.uint8)]}


def _tables(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, x) of all tables for each class, and the number by which they are dealt.

    Where more than ``NEAR`` members of one entry meet in a block, those past the first ``NEAR`` are dealt
    apart from it, so that a frequent entry sends few rows per block to its place. All members of
    such an entry carry themselves as y. Members are in the order of their names, so that entries of the same
    classes have the same first member, and its pairs are the same pairs in all of them.
    """
    for batch in parts:
        for at in range(0, len(batch), 1024):
            part = batch.iloc[at : at + 1024]
            sig = np.frombuffer(b"".join(part["sig"]), "<u4").reshape(len(part), 2, BANDS, ROWS).astype(np.uint64)
            band = np.zeros(sig.shape[:3], np.uint64)
            for row in range(ROWS):
                band = pair(band, sig[..., row])
            number = np.arange(BANDS * BANDS, dtype=np.uint64).reshape(BANDS, BANDS)
            key = pair(pair(band[:, 0, :, None], band[:, 1, None, :]), np.broadcast_to(number, (len(part), BANDS, BANDS))).reshape(-1)
            node = np.repeat(part["node"].to_numpy(), BANDS * BANDS)
            order = np.lexsort((node, key))
            key, node = key[order].view(np.int64), node[order]
            place, start = _places(key)
            full = np.bincount(start, minlength=key.size)[start] > NEAR
            yield pd.DataFrame({
                "key": key, "x": node, "y": pd.arrays.IntegerArray(node, ~full), "deal": np.where(place >= NEAR, node, key)})


def _places(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place in its run of equal keys, and the row where the run starts."""
    new = np.ones(key.size, bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    start = np.repeat(first, np.diff(np.concatenate([first, [key.size]])))
    return np.arange(key.size) - start, start


def _candidates(parts: Iterator[pd.DataFrame], heads: int) -> Iterator[pd.DataFrame]:
    """From rows sorted by key and name: (null, x, y) to compare, and all (key, x, null) of large entries.

    All pairs of an entry's first ``heads`` + 1 members, so of a whole small entry, and its first member with those up to ``NEAR``.
    """
    open_key, open_nodes, seen = None, np.zeros(0, np.int64), 0
    for batch in parts:
        known = batch[batch["y"].notna()]
        key, node = batch["key"].to_numpy(), batch["x"].to_numpy()
        if key.size and open_key == key[0]:
            before, skip = seen, open_nodes.size
            key = np.concatenate([np.full(skip, open_key), key])
            node = np.concatenate([open_nodes, node])
        else:
            before = skip = 0
        place, start = _places(key)
        fresh = np.arange(key.size) >= skip
        # The carried rows stand for ``before`` rows; later ones of the run come after those.
        place = np.where((start == 0) & fresh, place - skip + before, place) if skip else place
        x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(heads):
            rows = np.flatnonzero(fresh & (place > k) & (place < (NEAR if k == 0 else heads + 1)))
            x.append(node[start[rows] + k])
            y.append(node[rows])
        x, y = np.concatenate(x), np.concatenate(y)
        x, y = np.minimum(x, y), np.maximum(x, y)
        distinct = np.unique(pair(x.view(np.uint64), y.view(np.uint64)), return_index=True)[1]
        large = fresh & (place > heads)
        turned = np.flatnonzero(fresh & (place == heads + 1))
        first = (start[turned][:, None] + np.arange(heads + 1)).reshape(-1)
        rows = np.concatenate([np.flatnonzero(large), first])
        keys = np.concatenate([key[rows], known["key"].to_numpy()])
        nodes = np.concatenate([node[rows], known["x"].to_numpy()])
        if distinct.size or keys.size:
            paired = np.arange(distinct.size + keys.size) < distinct.size
            yield pd.DataFrame({
                "key": pd.arrays.IntegerArray(np.concatenate([np.zeros(distinct.size, np.int64), keys]), paired),
                "x": np.concatenate([x[distinct], nodes]),
                "y": pd.arrays.IntegerArray(np.concatenate([y[distinct], np.zeros(keys.size, np.int64)]), ~paired),
            })
        if key.size:
            last = int(start[-1])
            open_key, seen = key[-1], int(place[-1]) + 1
            open_nodes = node[last : last + heads + 1]


def _similar(size: int, percent: int):
    def test(texts: list[str], others: list[str]) -> dict:
        number: dict[str, int] = {}
        pairs = [[number.setdefault(text, len(number)) for text in side] for side in (texts, others)]
        found, bounds = shingles(list(number), size)
        linked = np.zeros(len(texts), bool)
        for i, (one, other) in enumerate(zip(*pairs)):
            a, b = (found[bounds[k] : bounds[k + 1]] for k in (one, other))
            both = np.intersect1d(a, b, assume_unique=True).size
            linked[i] = both > 0 and 100 * both >= percent * (a.size + b.size - both)
        return {"linked": linked}

    return test


class Grown:
    """A table in the shared folder to which rounds append: later plans read one table, however many rounds there were."""

    def __init__(self, spark: SparkSession, label: str, schema: str):
        self.spark, self.path, self.schema = spark, new_dir(spark, label), schema
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


class Verifier:
    """Confirms pairs (x, y) of classes: by size, by minhashes, then on the full sets of their texts.

    Texts are fetched once, when a class first takes part in a likely pair: late pairs are mostly of known
    classes, and then the documents are not gone through again. The rows to fetch lie in sorted hash arrays that the scanning
    tasks look theirs up in, so at any size only texts of such classes move.
    """

    def __init__(self, classes: DataFrame, docs: DataFrame, size: int, percent: int):
        self.classes, self.docs, self.size, self.percent = classes, docs, size, percent
        self.texts = Grown(docs.sparkSession, "texts", "node long, text string")

    def _side(self, name: str) -> DataFrame:
        return self.classes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n{name}"), F.col("tag").alias(f"s{name}"))

    def _fetch(self, likely: DataFrame) -> DataFrame:
        need = likely.select(F.explode(F.array("x", "y")).alias("node")).distinct().join(
            self.texts.rows().select("node"), "node", "left_anti")
        need = stage(need.join(self.classes.select("node", "doc_id", "h"), "node"), "need")
        if not need.isEmpty():
            row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "h")
            spark = self.docs.sparkSession
            wanted = hash_arrays.save_map(
                need.groupBy(row.alias("id")).agg(F.min("node").alias("value")), f"{new_dir(spark, 'need')}/rows")

            def pick(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in parts:
                    there, node = wanted.find(batch.column("row").to_numpy(zero_copy_only=False))
                    held = pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), batch.column("text")], names=["node", "text"])
                    yield held.filter(pa.array(there))

            self.texts.add(
                self.docs.filter(F.col("text").isNotNull()).select(row.alias("row"), "text").mapInArrow(batches.released(pick), "node long, text string")
                .groupBy("node").agg(F.first("text").alias("text")))
        return self.texts.rows()

    def fetched(self, nodes: DataFrame) -> DataFrame:
        return self._fetch(nodes.select(F.col("node").alias("x"), F.col("node").alias("y")))

    def linked(self, pairs: DataFrame) -> DataFrame:
        def agree(one: list[bytes], other: list[bytes]) -> dict:
            a, b = (np.frombuffer(b"".join(each), np.uint8).reshape(-1, HASHES) for each in (one, other))
            return {"same": (a == b).sum(axis=1)}

        sized = pairs.join(self._side("x"), "x").join(self._side("y"), "y").filter(
            100 * F.least("nx", "ny") >= self.percent * F.greatest("nx", "ny"))
        likely = stage(batches.with_columns(sized.select("x", "y", "sx", "sy"), ["sx", "sy"], agree, "same long", ("sx", "sy")).filter(
            F.col("same") >= AGREE).select("x", "y"), "likely")
        texts = self._fetch(likely)
        x, y = (texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}")) for name in "xy")
        both = likely.join(x, "x").join(y, "y")
        return batches.with_columns(
            both, ["tx", "ty"], _similar(self.size, self.percent), "linked boolean", ("tx", "ty")).filter("linked").select("x", "y")


def _saved(rows: DataFrame, write) -> None:
    """Calls ``write`` (block, its rows) in tasks, once for each value of the column block."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def save(some: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held = None, []
        for batch in some:
            for number, part in batch.groupby("block", sort=False):
                if held and number != block:
                    write(block, pd.concat(held))
                    held = []
                block = number
                held.append(part)
        if held:
            write(block, pd.concat(held))
        yield pd.DataFrame({"n": [1]})

    rows.repartition(parts, "block").sortWithinPartitions("block").mapInPandas(batches.released(save), "n long").agg(F.sum("n")).first()


def _meeting(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct pairs (a, b) of a task's lists of blocks, each block with itself too."""
    held, gathered = [np.zeros((0, 2), np.int64)], 0
    for batch in parts:
        for blocks in batch["blocks"]:
            blocks = np.sort(np.asarray(blocks, np.int64))
            one, other = np.triu_indices(blocks.size)
            held.append(np.stack([blocks[one], blocks[other]], axis=1))
            gathered += one.size
            if gathered > 1_000_000:
                held = [np.unique(np.concatenate(held), axis=0)]
                gathered = 0
                if len(held[0]) > 1_000_000:
                    yield pd.DataFrame(held.pop(), columns=["a", "b"])
    if held:
        yield pd.DataFrame(np.unique(np.concatenate(held), axis=0), columns=["a", "b"])


def _likely(one: dict[str, np.ndarray], other: dict[str, np.ndarray], same_block: bool, percent: int) -> np.ndarray:
    """Which pairs of two blocks are in different components and near enough by size and minhashes."""
    likely = one["root"][:, None] != other["root"][None]
    if same_block:
        likely = np.triu(likely, 1)
    if not likely.any():
        return likely
    n, m = one["n"][:, None], other["n"][None]
    likely &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    same = np.zeros(likely.shape, np.uint8)
    for a, b in zip(one["tag"].reshape(HASHES, -1), other["tag"].reshape(HASHES, -1)):
        same += a[:, None] == b[None]
    return likely & (same >= AGREE)


def _shared(one: list[np.ndarray], other: list[np.ndarray], step: int = 2048) -> np.ndarray:
    """How many shingles each set of ``one`` has in common with each of ``other``."""
    sides = [np.concatenate(side) for side in (one, other)]
    docs = [np.repeat(np.arange(len(side)), [each.size for each in side]) for side in (one, other)]
    common = np.intersect1d(*(np.unique(side) for side in sides), assume_unique=True)
    both = np.zeros((len(one), len(other)), np.float32)
    at = [np.searchsorted(common, side) for side in sides]
    held = [(place < common.size) & (common[np.minimum(place, common.size - 1)] == side) if common.size else np.zeros(side.size, bool)
            for place, side in zip(at, sides)]
    for low in range(0, common.size, step):
        dense = []
        for doc, place, hold, side in zip(docs, at, held, (one, other)):
            mine = np.flatnonzero(hold & (place >= low) & (place < low + step))
            part = np.zeros((len(side), min(step, common.size - low)), np.float32)
            part[doc[mine], place[mine] - low] = 1
            dense.append(part)
        both += dense[0] @ dense[1].T
    return both.astype(np.int64)


def _stars(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join what the pairs of a table join: all of a group with its first row, not each pair."""
    left = linked.any(axis=1)
    while left.any():
        first = int(left.argmax())
        rows, columns = np.zeros(len(x), bool), np.zeros(len(y), bool)
        now = np.array([first])
        while now.size:
            rows[now] = True
            reached = np.flatnonzero(linked[now].any(axis=0) & ~columns)
            columns[reached] = True
            now = np.flatnonzero(linked[:, reached].any(axis=1) & ~rows)
        left &= ~rows
        found = np.concatenate([x[rows], y[columns]])
        found = found[found != x[first]]
        yield np.full(found.size, x[first]), found


def _across(large: DataFrame, classes: DataFrame, roots: DataFrame, verifier: Verifier) -> DataFrame:
    """Links (x, y) that join the components of all classes that share an entry of ``large`` (key, node).

    Classes lie in blocks of about ``MEMBERS``, in files of the shared folder, by the largest entry that
    each is in. Two blocks that share an entry are compared whole: by component, size and minhashes, and what
    is left by its full shingle sets in matrices. No pair is a row, and no entry is gathered.
    """
    spark, size, percent = large.sparkSession, verifier.size, verifier.percent
    folder = new_dir(spark, "blocks")
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    homes = stage(large.join(sizes, "key").groupBy("node").agg(F.max(F.struct("n", "key")).alias("most")).select(
        "node", F.col("most.key").alias("home")), "homes")
    members = stage(homes.groupBy("home").agg(F.count(F.lit(1)).alias("members")), "members")
    few = -(-(members.filter(F.col("members") < MEMBERS).agg(F.sum("members")).first()[0] or 1) // MEMBERS)
    own = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / MEMBERS)))
    block = F.when(F.col("members") < MEMBERS, F.pmod(F.xxhash64("home"), F.lit(few))).otherwise(own)
    blocks = stage(homes.join(members, "home").select("node", block.alias("block")), "blocks")
    meeting = stage(
        large.join(blocks, "node").groupBy("key").agg(F.collect_set("block").alias("blocks")).select("blocks")
        .mapInPandas(batches.released(_meeting), "a long, b long").distinct(), "meeting")

    def put(block: int, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("node")
        tag = np.frombuffer(b"".join(rows["tag"]), np.uint8).reshape(len(rows), HASHES)
        files.write_arrays(f"{folder}/{block}.bin", {
            "node": rows["node"].to_numpy("<i8"), "root": rows["root"].to_numpy("<i8"), "n": rows["n_shingles"].to_numpy("<i8"),
            "tag": tag.T.reshape(-1)})

    _saved(blocks.join(classes.select("node", "n_shingles", "tag"), "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")), put)

    def likely(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
                one, other = (files.map_arrays(f"{folder}/{k}.bin") for k in (a, b))
                near = _likely(one, other, a == b, percent)
                if near.any():
                    nodes = np.unique(np.concatenate([one["node"][near.any(axis=1)], other["node"][near.any(axis=0)]]))
                    yield pd.DataFrame({"a": [a], "b": [b], "nodes": [nodes.tolist()]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = stage(meeting.repartition(parts, "a", "b").mapInPandas(batches.released(likely), "a long, b long, nodes array<long>"), "near")
    need = stage(near.select(F.explode("nodes").alias("node")).distinct(), "nodes")

    def put_sets(block: int, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("node")
        found, bounds = shingles(rows["text"].tolist(), size)
        files.write_arrays(f"{folder}/{block}-sets.bin", {"node": rows["node"].to_numpy("<i8"), "bounds": bounds.astype("<i8"), "found": found})

    if not need.isEmpty():
        _saved(verifier.fetched(need).join(need, "node", "left_semi").join(blocks, "node"), put_sets)

    def sets(block: int, nodes: np.ndarray) -> list[np.ndarray]:
        of = files.map_arrays(f"{folder}/{block}-sets.bin")
        return [of["found"][of["bounds"][at] : of["bounds"][at + 1]] for at in np.searchsorted(of["node"], nodes).tolist()]

    def linked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in parts:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
                one, other = (files.map_arrays(f"{folder}/{k}.bin") for k in (a, b))
                near = _likely(one, other, a == b, percent)
                i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                x, y = one["node"][i], other["node"][j]
                both = _shared(sets(a, x), sets(b, y))
                every = one["n"][i][:, None] + other["n"][j][None] - both
                for left, right in _stars(near[np.ix_(i, j)] & (both > 0) & (100 * both >= percent * every), x, y):
                    yield pd.DataFrame({"x": left, "y": right})

    return stage(near.select("a", "b").repartition(parts, "a", "b").mapInPandas(batches.released(linked), "x long, y long"), "links")


def groups(docs: DataFrame, size: int, percent: int, rounds: int, heads: int) -> DataFrame:
    """(doc_id, h, n_shingles, root) of all rows; ``h`` is the text's xxhash64, ``root`` names the group of links.

    Equal sets are one class first (a map-side sum, so thousands of copies are one row). Table entries
    send a few rows per block of classes. Of an entry with up to ``heads`` + 1 classes all pairs are compared, as rows; of a
    larger one those of its first classes, and all pairs of different components are then compared
    in blocks (`_across`), so nothing depends on who comes first. ``rounds`` is unused: no passes are left to bound.
    """
    raw = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = raw.withColumn("h", F.xxhash64("text"))
    measured = stage(batches.with_columns(
        rows, ["text"], lambda texts: _signed(texts, size), "n_shingles long, node long, check long, sig binary, tag binary", ("text",)), "measured")
    classes = stage(measured.filter("n_shingles > 0").groupBy("node", "check").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("tag").alias("tag"),
        F.min(F.struct("doc_id", "h")).alias("any")
    ).select("node", "n_shingles", "sig", "tag", "any.doc_id", "any.h"), "classes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    triple = "key long, x long, y long"
    found = stage(
        classes.select("node", "sig").mapInPandas(batches.released(_tables), f"{triple}, deal long")
        .repartition(parts, "deal").drop("deal").sortWithinPartitions("key", "x")
        .mapInPandas(batches.released(lambda some: _candidates(some, heads)), triple), "candidates")
    first = stage(found.filter("key is null").select("x", "y").distinct(), "pairs")
    verifier = Verifier(classes, rows, size, percent)
    roots = components(verifier.linked(first))
    large = stage(found.filter("y is null").select("key", F.col("x").alias("node")).distinct(), "large")
    if not large.isEmpty():
        roots = joined(roots, _across(large, classes, roots, verifier))
    return measured.join(roots, "node", "left").select(
        "doc_id", "h", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")).alias("root"))


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80, rounds: int = 12, heads: int = HEADS) -> DataFrame:
    """Link all ``docs`` (doc_id, text) whose shingle sets have 100 * intersection >= percent * union.

    Words are lower-cased (A-Z) and split at blanks; shingles have ``size`` words. Result, one row per input
    row: doc_id, n_shingles, component_id (least doc_id reachable over links), kept (the row with that
    doc_id). Documents without words are linked with nothing. Rows that share a doc_id are separate
    rows; of equal rows all are kept or none. A null doc_id never names a component as long as another
    member has one, and is kept only where it stands alone. An empty table gives no rows. See `groups`.
    """
    named = groups(docs, size, percent, rounds, heads)
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, rounds: int = 12, heads: int = HEADS) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps one: that of the least doc_id.

    A row without words is a group of its own. Rows equal in doc_id and text are one document, of which
    one row stays; among rows with one doc_id or none, the one of the least text hash stays (null last).
    """
    named = groups(docs, size, percent, rounds, heads)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("one")
    grouped = named.filter("root is not null").groupBy("root").agg(least).select("one.doc_id", "one.h")
    stays = grouped.unionByName(named.filter("root is null").select("doc_id", "h").distinct())
    keys = {"_none": F.col("doc_id").isNull(), "_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(0))}
    rows = docs.withColumns({**keys, "_h": F.xxhash64(F.col("text").cast("string"))})
    chosen = stays.withColumns(keys).select("_none", "_key", F.col("h").alias("_h"))
    first = Window.partitionBy("_none", "_key", "_h").orderBy("_key")
    return (
        rows.join(chosen, ["_none", "_key", "_h"], "left_semi").withColumn("_at", F.row_number().over(first))
        .filter("_at = 1").select(*docs.columns)
    )
