"""Balanced label propagation: laws, slots, cut links and hot groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pricebasket.llm import sharding
from pyspark.sql import functions as F


def check(rows, source, shards):
    assert Counter(r["doc_id"] for r in rows) == Counter(k for k, _ in source)
    raw = lambda text: (text or "").encode()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (k, len(raw(t)) + 1, zlib.crc32(raw(t))) for k, t in source)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(shards))
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(each) == list(range(len(each))) for each in slots.values())


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_rows_law(request, which):
    docs = request.getfixturevalue(which)
    check(sharding.shard(docs, 5).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 5)


def test_copies_stay_together(docs):
    rows = sharding.shard(docs, 4)
    texts = docs.select("doc_id", F.sha2("text", 256).alias("grp"))
    kept, pairs = sharding.cut_edges(rows.select("doc_id", "shard").join(texts, "doc_id")).first()
    assert pairs and kept >= 0.95 * float(pairs)


def test_a_group_larger_than_a_shard(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") / 7)).alias("text"))
    rows = sharding.shard(docs, 8).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 8)
    hot = Counter(r["shard"] for r in rows if r["doc_id"] % 3 == 0)
    assert sorted(hot.values())[-2:] == [50, 50]


def test_no_documents(docs):
    assert sharding.shard(docs.limit(0)).collect() == []


def test_quotas_move_as_many_both_ways():
    moves, fills = sharding.quotas({(0, 1): 5, (1, 0): 2, (2, 0): 4}, {1: 1, 0: 9}, 3)
    assert moves == {(0, 1): 3, (1, 0): 2, (2, 0): 4} and fills == {(1, 0): 1, (0, 2): 4}


def plain_wishes(groups, shard):
    """Where each linked node wants to go: its group's fullest shard that the group does not fill, the least of equals."""
    rows = Counter(shard.values())
    wishes = {}
    for members in groups.values():
        if len(members) > 1:
            n = Counter(shard[node] for node in members)
            opened = [(-k, s) for s, k in n.items() if k < rows[s]]
            best = min(opened) if opened else None
            for node in members:
                own = shard[node]
                stays = best is None or n[own] == rows[own] or best[1] == own
                wishes[node] = None if stays else (best[1], -best[0] - n[own] + 1)
    return wishes


@pytest.mark.parametrize("seed", range(3))
def test_a_round_against_plain_python(spark, seed):
    """One round: wishes equal the plain ones; every mover wanted to, with the greatest gains, and sizes stay."""
    draw = random.Random(seed)
    groups = defaultdict(list)
    shard = {node: draw.randrange(4) for node in range(120)}
    for node in shard:
        groups[draw.randrange(30) if node % 4 else 1000 + node].append(node)
    members = spark.createDataFrame([(node, grp) for grp, of in groups.items() for node in of], "node long, grp long")
    labels = spark.createDataFrame(list(shard.items()), "node long, shard int")
    wishes = plain_wishes(groups, shard)
    after = {r["node"]: r["shard"] for r in sharding.propagate(members, labels, 4, 1).collect()}
    assert Counter(after.values()) == Counter(shard.values())
    wanted = Counter((shard[node], wish[0]) for node, wish in wishes.items() if wish)
    free = Counter(s for node, s in shard.items() if node not in wishes)
    moves, fills = sharding.quotas(wanted, free, 4)
    moved = defaultdict(list)
    for node, s in after.items():
        if s != shard[node]:
            moved[shard[node], s, node in wishes].append(node)
    assert {key[:2]: len(of) for key, of in moved.items() if key[2]} == moves
    assert {key[:2]: len(of) for key, of in moved.items() if not key[2]} == fills
    for (a, b, linked), of in moved.items():
        if linked:
            lane = {node: wish[1] for node, wish in wishes.items() if wish and (shard[node], wish[0]) == (a, b)}
            assert set(of) <= set(lane)
            assert sorted((lane[node] for node in of), reverse=True) == sorted(lane.values(), reverse=True)[: len(of)]
