"""The incremental catalogue against the full rebuild, and what a day reads, writes and switches."""

import random
from decimal import Decimal
from pathlib import Path

import pytest
from pricebasket import constants
from pricebasket.operators import consolidate
from pricebasket.sources import catalog_store

OBS = "chain STRING, chain_rank INT, store_id STRING, item_code STRING, item_name STRING, price DECIMAL(12,2), seq INT"
STORES = "chain STRING, store_id STRING, city STRING"
NUMBERS = iter(range(1000))


@pytest.fixture
def place(spark, tmp_path):
    name = f"catalogue_{next(NUMBERS)}"
    yield str(tmp_path / "store"), name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def observations(spark, rows):
    return spark.createDataFrame([(c, constants.CHAINS.index(c), s, code, name, None if p is None else Decimal(p), seq) for c, s, code, name, p, seq in rows], OBS)


def long_rows(df):
    return sorted((str(r["id"]), str(r["name"]), r["chain"], r["store_id"], str(r["price"]), r["chains_count"], r["stores_count"]) for r in df.collect())


def random_days(seed, days, names=12, codes=5):
    """Products move between one chain and several, share ids, lack names, ids and prices, and are seen again."""
    draw = random.Random(seed)
    seq = 0
    for _ in range(days):
        rows = []
        for _ in range(draw.randrange(1, 14)):
            rows.append((draw.choice(constants.CHAINS), f"{draw.randrange(3):03d}", draw.choice([*(f"c{i}" for i in range(codes)), None]),
                         draw.choice([*(f"n{i}" for i in range(names)), None]), draw.choice([None, *range(1, 9)]), seq))
            seq += 1
        yield rows


def test_days_one_by_one_equal_the_rebuild(spark, place):
    root, name = place
    seen = []
    for rows in random_days(4, 4):
        seen += rows
        snapshot = catalog_store.add_observations(spark, root, name, observations(spark, rows), buckets=4)
        want = long_rows(consolidate.catalog(observations(spark, seen)))
        assert long_rows(snapshot.catalog()) == want
        assert long_rows(catalog_store.current(spark, name).catalog()) == want


def test_order_and_replays_do_not_matter(spark, place):
    root, name = place
    days = list(random_days(9, 3))
    for rows in (days[2], days[0], days[2], days[1]):
        snapshot = catalog_store.add_observations(spark, root, name, observations(spark, rows), buckets=3)
    assert long_rows(snapshot.catalog()) == long_rows(consolidate.catalog(observations(spark, [row for rows in days for row in rows])))


def test_a_day_reads_and_writes_only_its_buckets(spark, place):
    """Folders a day does not touch may be unreadable: it neither opens nor rewrites them."""
    root, name = place
    rows = [("victory", "002", f"c{i}", f"n{i}", 5, i) for i in range(60)] + [("ramilevi", "043", f"c{i}", f"n{i}", 6, 100 + i) for i in range(0, 60, 3)]
    before = catalog_store.add_observations(spark, root, name, observations(spark, rows), buckets=16)
    day = [("victory", "002", "c1", "n1", 9, 500), ("shufersal", "001", "c4", "n4", 7, 501)]
    want = long_rows(consolidate.catalog(observations(spark, rows + day)))
    probe = observations(spark, day).select(catalog_store._bucket("item_name", 16), catalog_store._bucket("item_code", 16).alias("by_id")).collect()
    by_name, by_id = {r["bucket"] for r in probe}, {r["by_id"] for r in probe}
    held = {}
    for (part, bucket), path in before.folders.items():
        if part == "buckets" or bucket in (by_id if part in ("singles", "merged") else by_name):
            continue
        for file in Path(path).glob("*.parquet"):
            held[file] = file.read_bytes()
            file.write_bytes(b"not parquet")
    assert len({path.parent for path in held}) > 40
    after = catalog_store.add_observations(spark, root, name, observations(spark, day))
    changed = {key for key in after.folders if before.folders.get(key) != after.folders[key]} - {("buckets", 0)}
    assert {bucket for part, bucket in changed if part in ("partials", "products", "multi")} <= by_name
    assert {bucket for part, bucket in changed if part in ("singles", "merged")} <= by_id
    for file, data in held.items():
        file.write_bytes(data)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert long_rows(after.catalog()) == want


def test_products_and_stores_switch_together(spark, place, monkeypatch):
    root, name = place
    shops = [spark.createDataFrame([("victory", "002", city)], STORES) for city in ("Lod", "Haifa")]
    first = [("victory", "002", "a", "tea", 1, 1)]
    catalog_store.add_observations(spark, root, name, observations(spark, first), shops[0])

    def fails(*_):
        raise RuntimeError("the driver died")

    later = [("victory", "002", "a", "tea", 2, 2)]
    with monkeypatch.context() as broken:
        broken.setattr(catalog_store._Version, "publish", fails)
        with pytest.raises(RuntimeError):
            catalog_store.add_observations(spark, root, name, observations(spark, later), shops[1])
    old = catalog_store.current(spark, name)
    assert [r["price"] for r in old.catalog().collect()] == [Decimal(1)] and old.stores().first()["city"] == "Lod"
    catalog_store.add_observations(spark, root, name, observations(spark, later), shops[1])
    new = catalog_store.current(spark, name)
    assert [r["price"] for r in new.catalog().collect()] == [Decimal(2)] and new.stores().first()["city"] == "Haifa"
    # Who took the old version before still reads it whole, until its folders are forgotten.
    assert [r["price"] for r in old.catalog().collect()] == [Decimal(1)] and old.stores().first()["city"] == "Lod"
    assert catalog_store.forget_old(spark, root, name) > 0
    assert [r["price"] for r in catalog_store.current(spark, name).catalog().collect()] == [Decimal(2)]
    assert catalog_store.forget_old(spark, root, name) == 0


def test_a_day_without_rows(spark, place):
    root, name = place
    assert catalog_store.current(spark, name) is None
    assert catalog_store.add_observations(spark, root, name, observations(spark, [])).catalog().count() == 0
    rows = [("victory", "002", "a", "tea", 1, 1)]
    catalog_store.add_observations(spark, root, name, observations(spark, rows))
    snapshot = catalog_store.add_observations(spark, root, name, observations(spark, []))
    assert long_rows(snapshot.catalog()) == long_rows(consolidate.catalog(observations(spark, rows)))
