"""The daily job from files to current tables, and a basket answered from them."""

from pricebasket import constants
from pricebasket.plans import daily
from test_files import STORE_XML, write_price_file


def inputs(spark, folder, milk):
    prices, shops = {}, {}
    store = {"victory": "2", "shufersal": "1", "ramilevi": "43"}
    for chain in constants.CHAINS:
        prices[chain] = str(folder / chain / "prices")
        shops[chain] = str(folder / chain / "stores")
        write_price_file(folder / chain / "prices", chain, store[chain], "202301010300", [("7", "milk", milk), ("8", f"only {chain}", "2")])
        # An older file of the same store and a store that is not listed: neither is read.
        write_price_file(folder / chain / "prices", chain, store[chain], "202212310300", [("7", "milk", "99"), ("9", "old", "1")])
        write_price_file(folder / chain / "prices", chain, "999", "202301010300", [("7", "milk", "0.01")])
        (folder / chain / "stores").mkdir(parents=True, exist_ok=True)
        (folder / chain / "stores" / "s.xml").write_bytes(STORE_XML[chain].encode("utf-16" if chain == "ramilevi" else "utf-8"))
    known = spark.createDataFrame([("main 1, haifa", 32.8, 35.0)], "full_address STRING, latitude DOUBLE, longitude DOUBLE")
    return daily.DailyInputs(prices, shops, known, constants.STORE_ALLOWLIST)


def test_days_accumulate_and_the_current_table_follows(spark, tmp_path):
    out = str(tmp_path / "out")
    daily.run_day(spark, inputs(spark, tmp_path / "d1", "5"), "2023-01-01", out)
    tables = daily.run_day(spark, inputs(spark, tmp_path / "d2", "6"), "2023-01-02", out)

    milk = tables["products"].filter("name = 'milk'").collect()
    assert {(r["chain"], r["store_id"], str(r["price"]), r["chains_count"]) for r in milk} == {
        ("victory", "002", "6.00", 3), ("shufersal", "001", "6.00", 3), ("ramilevi", "043", "6.00", 3),
    }
    assert tables["products"].filter("name = 'old'").count() == 0
    # Code 8 names one product per chain: they merge under the smallest name.
    merged = tables["products"].filter("id = '8'").collect()
    assert {(r["name"], r["chain"], r["stores_count"]) for r in merged} == {
        ("only ramilevi", chain, 3) for chain in constants.CHAINS
    }
    history = spark.read.parquet(f"{out}/products/parquet").filter("name = 'milk'")
    assert {(str(r["pulling_date"]), str(r["price"])) for r in history.collect()} == {("2023-01-01", "5.00"), ("2023-01-02", "6.00")}
    assert spark.read.json(f"{out}/products/json").select("pulling_date").distinct().count() == 2

    shops = {r["chain"]: r for r in tables["stores"].collect()}
    assert (shops["shufersal"]["latitude"], shops["ramilevi"]["latitude"]) == (32.8, None)

    messages = spark.createDataFrame([(1, "milk 2", 32.8, 35.0)], "cart_id INT, message STRING, user_lat DOUBLE, user_lon DOUBLE")
    best = daily.answer_messages(messages, tables["products"], tables["stores"]).best.collect()
    assert [(r["store_name"], str(r["store_price"])) for r in best] == [("one", "12.00")]


def test_days_are_taken_into_one_catalogue(spark, tmp_path):
    """A day that lists fewer products keeps the others; stores come with it."""
    root, name = str(tmp_path / "root"), "daily_catalogue"
    first = inputs(spark, tmp_path / "d1", "5")
    write_price_file(tmp_path / "d1" / "victory" / "prices", "victory", "2", "202301010400", [("7", "milk", "5"), ("6", "rye", "3")])
    daily.update_day(spark, first, "2023-01-01", root, name)
    second = inputs(spark, tmp_path / "d2", "6")
    write_price_file(tmp_path / "d2" / "victory" / "prices", "victory", "2", "202301020300", [("7", "milk", "6")])
    snapshot = daily.update_day(spark, second, "2023-01-02", root, name)
    prices = {(r["name"], r["chain"]): str(r["price"]) for r in snapshot.catalog().collect()}
    assert {chain: prices["milk", chain] for chain in constants.CHAINS} == dict.fromkeys(constants.CHAINS, "6.00")
    assert prices["rye", "victory"] == "3.00"
    assert {r["pulling_date"].isoformat() for r in snapshot.stores().collect()} == {"2023-01-02"}
    spark.sql(f"DROP TABLE {name}")
