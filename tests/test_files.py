"""File formats as the chains publish them, written by hand."""

import gzip
import json
from decimal import Decimal

import pytest
from pricebasket import constants, schemas
from pricebasket.functions import text
from pricebasket.operators import stores
from pricebasket.sources import files
from pyspark.sql import functions as F

CHAIN_IDS = constants.CHAIN_IDS


def item(tag, code, name, price, date="2023-01-01 07:00"):
    return (
        f"<{tag}><PriceUpdateDate>{date}</PriceUpdateDate><ItemCode>{code}</ItemCode><ItemType>1</ItemType>"
        f"<ItemName>{name}</ItemName><ManufactureCountry>x</ManufactureCountry><bIsWeighted>0</bIsWeighted>"
        f"<QtyInPackage>1</QtyInPackage><ItemPrice>{price}</ItemPrice><AllowDiscount>1</AllowDiscount>"
        f"<ItemStatus>1</ItemStatus></{tag}>"
    )


def price_xml(chain, store, items):
    if chain == "victory":
        body = "".join(item("Product", *i) for i in items)
        return f"<?xml version='1.0'?><Prices><ChainID>{CHAIN_IDS[chain]}</ChainID><StoreID>{store}</StoreID><Products>{body}</Products></Prices>"
    root = "root" if chain == "shufersal" else "Root"
    body = "".join(item("Item", *i) for i in items)
    return f"<?xml version='1.0'?><{root}><ChainId>{CHAIN_IDS[chain]}</ChainId><StoreId>{store}</StoreId><Items>{body}</Items></{root}>"


def write_price_file(folder, chain, store, stamp, items):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"PriceFull{CHAIN_IDS[chain]}-{store}-{stamp}.gz"
    path.write_bytes(gzip.compress(price_xml(chain, store, items).encode()))
    return path


@pytest.mark.parametrize("chain", constants.CHAINS)
def test_price_files_of_each_chain(spark, tmp_path, chain):
    write_price_file(tmp_path, chain, "1", "202301010300", [("0012", "milk", "5.90"), ("13", " ", ""), ("0012", "milk", "6.10")])
    write_price_file(tmp_path, chain, "1234", "202301010300", [("9", "tea", "3")])
    rows = files.read_price_files(spark, str(tmp_path), chain, "2023-01-02").orderBy("store_id", "seq").collect()
    assert [(r["store_id"], r["item_code"], r["item_name"], r["price"]) for r in rows] == [
        ("001", "0012", "milk", Decimal("5.90")),
        ("001", "13", None, None),
        ("001", "0012", "milk", Decimal("6.10")),
        ("1234", "9", "tea", Decimal("3.00")),
    ]
    assert {(str(r["price_update_date"]), str(r["pulling_date"]), r["chain_id"]) for r in rows} == {
        ("2023-01-01", "2023-01-02", CHAIN_IDS[chain])
    }


def test_an_empty_file_is_reported(spark, tmp_path):
    write_price_file(tmp_path, "victory", "002", "202301010300", [("1", "milk", "5")])
    (tmp_path / f"PriceFull{CHAIN_IDS['victory']}-008-202301010300.gz").write_bytes(b"")
    obs = files.read_price_files(spark, str(tmp_path), "victory", "2023-01-01")
    expected = stores.allowlist_table(spark, {"victory": ["002", "008"]})
    assert [tuple(r) for r in files.missing_stores(obs, expected).collect()] == [("victory", "008")]


STORE_XML = {
    "shufersal": (
        "<asx:abap xmlns:asx='http://www.sap.com/abapxml'><asx:values><STORES><STORE><STOREID>1</STOREID>"
        "<STORENAME>one</STORENAME><ADDRESS>main 1</ADDRESS><CITY>Haifa</CITY><CHAINNAME>c</CHAINNAME></STORE>"
        "</STORES></asx:values></asx:abap>"
    ),
    "victory": (
        "<Store><Branches><Branch><StoreID>2</StoreID><StoreName>two</StoreName><Address/><City>Lod</City>"
        "<ChainName>c</ChainName></Branch></Branches></Store>"
    ),
    "ramilevi": (
        "<?xml version='1.0' encoding='utf-16'?><Root><ChainId>7</ChainId><ChainName>רמי לוי</ChainName><SubChains><SubChain><Stores>"
        "<Store><StoreId>043</StoreId><StoreName>תלפיות</StoreName><Address>b 2</Address><City>ירושלים</City>"
        "<ZipCode>1</ZipCode></Store></Stores></SubChain></SubChains></Root>"
    ),
}


def test_store_files_of_each_chain(spark, tmp_path):
    read = {}
    for chain, xml in STORE_XML.items():
        folder = tmp_path / chain
        folder.mkdir()
        (folder / "stores.xml").write_bytes(xml.encode("utf-16" if chain == "ramilevi" else "utf-8"))
        read[chain] = files.read_store_files(spark, str(folder), chain)
    rows = {r["chain"]: r for r in stores.stores_union(read).collect()}
    assert (rows["shufersal"]["store_id"], rows["shufersal"]["store_name"], rows["shufersal"]["city"]) == ("001", "one", "Haifa")
    assert (rows["victory"]["store_id"], rows["victory"]["address"]) == ("002", None)
    assert (rows["ramilevi"]["store_name"], rows["ramilevi"]["city"]) == ("תלפיות", "ירושלים")
    assert {chain: r["chain_id"] for chain, r in rows.items()} == CHAIN_IDS


def test_a_day_as_one_json_array(spark, tmp_path):
    row = {
        "id": "0012", "name": "milk", "chains": {"victory": {"002": "5.90"}, "shufersal": {"001": "6.10"}},
        "pulling_date": "2023-01-01", "chains_count": 2, "stores_count": 2,
    }
    (tmp_path / "2023-01-01.json").write_text(json.dumps([row, {**row, "id": "13"}]))
    got = files.read_daily_json(spark, str(tmp_path), one_array_per_file=True).orderBy("id").collect()
    assert [r["id"] for r in got] == ["0012", "13"]
    assert got[0]["chains"] == row["chains"]


def test_snapshots_replace_only_their_day(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = spark.createDataFrame([("2023-01-01", 1), ("2023-01-02", 2)], "pulling_date STRING, v INT")
    files.write_snapshot(rows, path)
    files.write_snapshot(rows.filter("v = 2").withColumn("v", F.lit(3)), path)
    got = spark.read.schema("v INT, pulling_date DATE").parquet(path)
    assert sorted((str(r["pulling_date"]), r["v"]) for r in got.collect()) == [("2023-01-01", 1), ("2023-01-02", 3)]


def test_a_current_table_is_replaced_whole(spark, tmp_path):
    files.publish_current(spark.range(3), "numbers", str(tmp_path / "v1"))
    files.publish_current(spark.range(1), "numbers", str(tmp_path / "v2"))
    assert spark.table("numbers").count() == 1


def test_listing_pages(spark):
    html = '<a href="/f/PriceFull729-001-2023.gz?x=1">d</a> <a href="/o">o</a> <a data-x="1" href="/FileObject?catID=2&page=17">&gt;&gt;</a>'
    pages = spark.createDataFrame([(1, html), (2, "none")], "page_id INT, html STRING")
    got = files.listing_links(pages).collect()
    assert [(r["pos"], r["href"], r["wanted"]) for r in got] == [
        (0, "/f/PriceFull729-001-2023.gz?x=1", True), (1, "/o", False), (2, "/FileObject?catID=2&page=17", False)]
    assert [r[0] for r in pages.orderBy("page_id").select(files.last_page(F.col("html"))).collect()] == [17, None]


@pytest.mark.parametrize("anchor, href", [
    ('<a target="_blank" href="/x">', "/x"), ("<A HREF=/y class=c>", "/y"), ("<a href='/z?a=1&amp;b=&quot;2&quot;'>", '/z?a=1&b="2"'),
    ("<a\n  data-href='/no' title=\" href='/never'\"\n  href = \"/yes\">", "/yes"), ('<a href="">', ""),
    ('<a name="x">', None), ('<abbr href="/no">', None), ('<a title="a>b" href="/gt">', "/gt")])
def test_anchors_of_all_kinds(spark, anchor, href):
    pages = spark.createDataFrame([(1, f"<p>{anchor}t</a>")], "page_id INT, html STRING")
    assert [r["href"] for r in files.listing_links(pages).collect()] == ([] if href is None else [href])


def test_one_row_per_store(spark):
    rows = spark.createDataFrame([("2", "b", "x", "y"), ("002", "a", "x", "y"), ("3", "c", "x", "y")], "StoreID STRING, StoreName STRING, Address STRING, City STRING")
    got = stores.stores_union({"victory": rows}).collect()
    assert sorted((r["store_id"], r["store_name"]) for r in got) == [("002", "a"), ("003", "c")]


def test_other_sessions_see_the_current_table(spark, tmp_path):
    files.publish_current(spark.range(3), "shared_numbers", str(tmp_path / "v1"))
    files.publish_current(spark.range(5), "shared_numbers", str(tmp_path / "v2"))
    assert spark.newSession().table("shared_numbers").count() == 5
    spark.sql("DROP TABLE shared_numbers")


def test_duplicate_addresses_multiply_nothing(spark):
    rows = spark.createDataFrame([("a", "b")], "address STRING, city STRING")
    known = spark.createDataFrame([("a, b", 2.0, 1.0), ("a, b", 1.0, 9.0)], "full_address STRING, latitude DOUBLE, longitude DOUBLE")
    assert [(r["latitude"], r["longitude"]) for r in stores.geocode(rows, known).collect()] == [(1.0, 9.0)]


def test_newest_file_per_store(spark):
    names = ["PriceFull729-001-202301010300.gz", "PriceFull729-001-202301020300.gz", "PriceFull729-1234-2022.gz", "Stores729-000-2021.xml"]
    got = stores.latest_file(spark.createDataFrame([(n,) for n in names], "file_name STRING"))
    assert sorted((r["file_type"], r["store_id"], r["file_name"]) for r in got.collect()) == [
        ("PriceFull", "001", names[1]), ("PriceFull", "1234", names[2]), ("Stores", "000", names[3]),
    ]


@pytest.mark.parametrize("value, want", [("1", "001"), ("012", "012"), ("1234", "1234"), (None, None)])
def test_zero_padding_never_cuts(spark, value, want):
    df = spark.createDataFrame([(value,)], "v STRING")
    assert df.select(text.zero_padded(F.col("v"))).first()[0] == want


def test_allowlist(spark):
    rows = spark.createDataFrame([("victory", "002"), ("victory", "003"), ("shufersal", "001")], "chain STRING, store_id STRING")
    assert stores.apply_allowlist(rows, None).count() == 3
    assert {tuple(r) for r in stores.apply_allowlist(rows, {"victory": ["002"]}).collect()} == {("victory", "002")}
    open_chain = stores.apply_allowlist(rows, {"victory": ["002"], "shufersal": None})
    assert {tuple(r) for r in open_chain.collect()} == {("victory", "002"), ("shufersal", "001")}


def test_unknown_stores_keep_nulls(spark):
    shops = spark.createDataFrame(
        [("victory", "083", "center", 32.0, 34.8)], "chain STRING, store_id STRING, store_name STRING, latitude DOUBLE, longitude DOUBLE"
    )
    keys = spark.createDataFrame([("083@victory",), ("999@victory",), ("083@nowhere",)], "store_key STRING")
    got = {r["store_key"]: (r["display_name"], r["latitude"]) for r in stores.store_lookup(keys, shops).collect()}
    assert got == {
        "083@victory": (f"{constants.CHAIN_NAMES['victory']} center", 32.0),
        "999@victory": (f"{constants.CHAIN_NAMES['victory']} store name not found", None),
        "083@nowhere": (None, None),
    }


def test_addresses_resolve_whatever_their_case(spark):
    rows = spark.createDataFrame([(" Main  ST 1 ", " Haifa"), ("other", "Lod")], "address STRING, city STRING")
    known = spark.createDataFrame([("main st 1, haifa", 32.8, 35.0)], "full_address STRING, latitude DOUBLE, longitude DOUBLE")
    assert {r["full_address"]: r["resolved"] for r in stores.geocode(rows, known).collect()} == {
        "main st 1, haifa": True, "other, lod": False,
    }
    assert [tuple(r) for r in stores.unresolved_addresses(rows, known).collect()] == [("other, lod", 1)]


def test_typed_table_is_created_once(spark):
    assert schemas.create_table_if_absent(spark, "posts_table", schemas.ENRICHED_POST)
    assert not schemas.create_table_if_absent(spark, "posts_table", schemas.ENRICHED_POST)
    types = {f.name: f.dataType.simpleString() for f in spark.table("posts_table").schema}
    assert types["url"] == "string" and types["followers_count"] == "int" and types["current_ts"] == "timestamp"
    spark.sql("DROP TABLE posts_table")


def test_many_stores_are_listed_by_few_tasks_and_written_without_side_files(spark, tmp_path):
    """A file per store: neither a listing task each, nor a second file of checksums each."""
    path = str(tmp_path / "prices")
    rows = spark.range(60).select(
        F.concat(F.lit("PriceFull7290696200003-"), F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-202301010300")).alias("file"),
        F.lit("2023-01-01 03:00").alias("PriceUpdateDate"), F.col("id").cast("string").alias("ItemCode"), F.lit("milk").alias("ItemName"),
        F.lit("5.90").alias("ItemPrice"))
    files.write_xml(rows, path, *files.PRICE_TAGS["victory"], partition="file")
    assert not list((tmp_path / "prices").glob("*/.*.crc"))
    context, before = spark.sparkContext, spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    context.setJobGroup("listing of stores", "")
    try:
        read = files.read_price_files(spark, path, "victory", "2023-01-01")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [stage for job in tracker.getJobIdsForGroup("listing of stores") for stage in tracker.getJobInfo(job).stageIds]
    assert stages and max(tracker.getStageInfo(stage).numTasks for stage in stages) <= 4
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert sorted(row["item_code"] for row in read.collect()) == sorted(str(n) for n in range(60))
