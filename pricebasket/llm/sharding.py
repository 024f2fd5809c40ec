"""Sharding by balanced label propagation: linked documents move together, shard sizes stay even."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.session import stage


#: Members of a linked group that one lane holds.
LANE = 500


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Add ``slot``: each row's number within its group, gapless from 0, in the given order.

    No group is gathered in one task: rows are sorted by range over all tasks, written, and the
    rows that a group has in earlier tasks are added to each row's place within its own task.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}),
        "ranked",
    )
    # One row per task and group.
    counts = placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("_part").alias("_task"), F.col(group).alias("_group"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"),
    )
    same = (placed["_part"] == bases["_task"]) & placed[group].eqNullSafe(bases["_group"])
    return placed.join(bases, same).select(*rows.columns, (placed["_at"] + F.col("_base")).cast("long").alias("slot"))


def propagate(members: DataFrame, labels: DataFrame, shards: int, rounds: int = 8) -> DataFrame:
    """Improve ``labels`` (node, shard) of all nodes, given the groups of linked nodes.

    ``members`` (node, grp) links all nodes of a group with one another; the pairs are never formed: a
    group's counts per shard tell how many neighbours a node has in each. Each round, every linked
    node whose neighbours lie mostly in another shard wants to move there. The quota between
    two shards lets equally many nodes move both ways; where fewer want to come back, unlinked
    nodes of the other shard, which lose nothing, fill up the quota. So no round changes the size
    of any shard. The rounds end early when nobody can move.
    """
    # A large group's members are dealt over ``spread`` lanes, each of which gets the group's decisions.
    # Written first, so that the join below is of two plain exchanges, whose skew Spark can split.
    sizes = stage(members.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "groups")
    spread = F.ceil(F.col("_n") / LANE).cast("int")
    linked = stage(
        members.join(sizes, "grp").select("node", "grp", spread.alias("spread"), F.pmod(F.xxhash64("node"), spread).alias("lane")),
        "linked")
    labels = stage(labels.select("node", "shard"), "labels")
    for _ in range(rounds):
        wishes = stage(_wishes(linked, labels), "wishes")
        # From here on, shards x shards numbers on the driver.
        wanted = {(r["shard"], r["target"]): r["n"] for r in
                  wishes.filter("target is not null").groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()}
        free = {r["shard"]: r["n"] for r in
                wishes.filter("target is null and not linked").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        moves, fills = quotas(wanted, free, shards)
        if not moves:
            break
        labels = stage(_moved(wishes, moves, fills), "labels")
    return labels


def quotas(wanted: dict, free: dict, shards: int) -> tuple[dict, dict]:
    """How many nodes may move between each two shards, and how many unlinked nodes return the move."""
    free, moves, fills = dict(free), {}, {}
    for a in range(shards):
        for b in range(a + 1, shards):
            there, back = wanted.get((a, b), 0), wanted.get((b, a), 0)
            both = min(there, back)
            from_, to, more = (a, b, there - both) if there > back else (b, a, back - both)
            extra = min(more, free.get(to, 0))
            free[to] = free.get(to, 0) - extra
            for pair, n in (((from_, to), both + extra), ((to, from_), both)):
                if n:
                    moves[pair] = n
            if extra:
                fills[(to, from_)] = extra
    return moves, fills


def _wishes(linked: DataFrame, labels: DataFrame) -> DataFrame:
    """Every node with its shard, whether it is linked, and the shard and gain it wishes for (null: stay)."""
    here = linked.join(labels, "node")
    counts = here.groupBy("grp", "spread", "shard").agg(F.count(F.lit(1)).alias("n"))
    # A shard that one group fills is closed to it: the rest of the group gathers elsewhere.
    full = F.broadcast(labels.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")))  # a row per shard
    counts = counts.join(full, "shard").withColumn("closed", F.col("n") == F.col("rows")).drop("rows")
    # The best shard of a group: most members, then the smallest number; a group has at most one row per shard.
    best = counts.filter("not closed").groupBy("grp").agg(
        F.max(F.struct("n", (-F.col("shard")).alias("minus"))).alias("best"))
    to = (-F.col("best.minus")).cast("int")
    decided = counts.join(best, "grp", "left").select(
        "grp", "shard", F.when(~F.col("closed") & (to != F.col("shard")), to).alias("target"),
        (F.col("best.n") - F.col("n") + 1).alias("gain"), F.explode(F.sequence(F.lit(0), F.col("spread") - 1)).alias("lane"))
    wish = here.join(decided, ["grp", "lane", "shard"]).select("node", "target", "gain")
    return labels.join(wish.withColumn("linked", F.lit(True)), "node", "left").select(
        "node", "shard", F.coalesce("linked", F.lit(False)).alias("linked"), "gain",
        "target",
    )


def _moved(wishes: DataFrame, moves: dict, fills: dict) -> DataFrame:
    """Apply the quotas: in each lane the movers of greatest gain, then unlinked nodes in hashed order."""
    spark = wishes.sparkSession
    rows = [(f"{a}>{b}", 0, n, b) for (a, b), n in moves.items()]
    for shard in {a for a, _ in fills}:
        at = 0
        for (a, b), n in sorted(fills.items()):
            if a == shard:
                rows.append((f"{a}>", at, at + n, b))
                at += n
    quota = F.broadcast(spark.createDataFrame(rows, "lane string, low long, high long, goes int"))  # at most shards^2 rows
    lane = F.when(F.col("target").isNotNull(), F.concat_ws(">", "shard", "target")).when(
        ~F.col("linked"), F.concat("shard", F.lit(">")))
    lanes = wishes.withColumn("lane", lane)
    going = ranked(
        lanes.filter("lane is not null").withColumns({"order": -F.coalesce("gain", F.lit(0)), "tie": F.xxhash64("node")}),
        "lane", "order", "tie", "node",
    ).join(quota, "lane").filter("slot >= low and slot < high").select("node", "goes")
    return lanes.join(going, "node", "left").select("node", F.coalesce("goes", "shard").alias("shard"))


def shard(docs: DataFrame, shards: int = 16, rounds: int = 8) -> DataFrame:
    """Put all ``docs`` (doc_id, text) into ``shards`` shards whose row counts differ by one at most.

    Documents with equal texts are linked. Result, one row per input row: doc_id, size (UTF-8 bytes
    of the text, null: none, plus 1), text_crc32, law (`rows`), shard, slot (gapless from 0 in the
    shard, by doc_id), grown_shard (null: only key laws have one).

    Rows are first dealt evenly by their rank in hashed order of the rows, then moved by `propagate`.
    Texts are taken for equal if 64 bits of their SHA-256 are. A group larger than a shard stays
    spread over as many shards as it needs. Null texts are not linked with one another; empty ones
    are. Rows with a null or repeated doc_id are nodes of their own. An empty table gives no rows.
    """
    raw = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"),
    ).select(
        "doc_id", F.monotonically_increasing_id().alias("node"),
        (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(F.encode(raw, "UTF-8")).alias("text_crc32"),
        # Links rest on 64 bits of this.
        F.when(F.col("text").isNotNull(), F.sha2("text", 256)).alias("grp"),
    ), "shard-rows")
    members = rows.filter("grp is not null").select("node", F.xxhash64("grp", F.lit(1)).alias("grp"))
    first = ranked(rows.select("node", F.xxhash64("node").alias("tie"), F.lit(0).alias("all")), "all", "tie", "node")
    labels = propagate(members, first.select("node", F.pmod("slot", F.lit(shards)).cast("int").alias("shard")), shards, rounds)
    placed = rows.drop("grp").join(labels, "node")
    return ranked(placed, "shard", "doc_id", "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_edges(links: DataFrame) -> DataFrame:
    """Linked pairs in one shard and in all, from (grp, shard) rows, by counts instead of pairs."""
    n = links.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
    sums = n.groupBy("grp").agg(F.sum("n").alias("all"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("kept"))
    return sums.agg(F.sum("kept").alias("kept"), F.sum(F.col("all") * (F.col("all") - 1) / 2).alias("pairs"))
