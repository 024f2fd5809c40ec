"""The registered queries: each runs one operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebasket import constants, schemas
from pricebasket.functions import space_time, text
from pricebasket.operators import basket, chat, consolidate, history, nearby, popularity, posts, search, sentiment, stores
from pricebasket.plans import daily
from pricebasket.session import new_dir, stage
from pricebasket.sources import catalog_store, files, tables
from pricebasket.streaming import jobs, stateful

RUN_DATE = "2023-01-01"
STAMP = "202301010300"
KEYWORDS = ["best", "worthless"]
SNAPSHOT = ["snapshot"]
LONG = ["id", "name", "chain", "store_id", "price", "chains_count", "stores_count"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name (a trailing underscore keeps clear of a module's name)."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


# ---- shared inputs ----------------------------------------------------------------------


def _current_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue over all dates, stored because every basket branch reads it."""
    return stage(consolidate.catalog(tables.price_obs(spark, sf_dir)), "catalog")


def _offered_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue that baskets are priced by: some of its prices are blank."""
    return stage(tables.with_blank_prices(consolidate.catalog(tables.price_obs(spark, sf_dir))), "catalog")


def _order_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = tables.order_items(spark, sf_dir).withColumnRenamed("product_name", "name")
    return stage(basket.cart_products(items), "carts")


def _answers(spark: SparkSession, sf_dir: str) -> daily.CartAnswers:
    return daily.answer_messages(
        tables.cart_messages(spark, sf_dir), _offered_prices(spark, sf_dir), tables.stores(spark, sf_dir)
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.request_records(tables.table(spark, sf_dir, "lineitem"), spark, sf_dir)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table(spark, sf_dir, "documents")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---- scans ------------------------------------------------------------------------------


def _write_price_files(observations: DataFrame, chain: str, path: str) -> None:
    name = F.concat_ws("-", F.concat(F.lit("PriceFull" + constants.CHAIN_IDS[chain])), "store_id", F.lit(STAMP))
    rows = (
        observations.filter(F.col("chain") == chain)
        .select(
            name.alias("file"),
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("PriceUpdateDate"),
            F.col("item_code").alias("ItemCode"),
            F.col("item_name").alias("ItemName"),
            F.lit("1").alias("ItemType"),
            F.col("l_extendedprice").cast(schemas.PRICE).cast("string").alias("ItemPrice"),
            F.lit("0").alias("AllowDiscount"),
        )
    )
    files.write_xml(rows, path, *files.PRICE_TAGS[chain], partition="file")


@query
def xml_price_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    # Joined once; each chain's files have a form of their own.
    observations = stage(tables.raw_observations(spark, sf_dir).select(
        "chain", "store_id", "l_shipdate", "item_code", "item_name", "l_extendedprice"), "observations")
    for chain in constants.CHAINS:
        path = new_dir(spark, f"prices-{chain}")
        _write_price_files(observations, chain, path)
        part = files.read_price_files(spark, path, chain, RUN_DATE).drop("seq")
        out = part if out is None else out.unionByName(part)
    return out


def _store_rows(spark: SparkSession, sf_dir: str, chain: str) -> DataFrame:
    """One chain's stores under the column names of its own file."""
    rows = tables.chain_stores(spark, sf_dir, chain)
    spelling = stores.STORE_COLUMNS[chain]
    return rows.select(
        F.col("StoreId").alias(spelling["store_id"]),
        F.col("StoreName").alias(spelling["store_name"]),
        F.col("Address").alias(spelling["address"]),
        F.col("City").alias(spelling["city"]),
    )


@query
def xml_store_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = {}
    for chain in constants.CHAINS:
        row_tag, encoding = files.STORE_TAGS[chain]
        path = new_dir(spark, f"stores-{chain}")
        files.write_xml(_store_rows(spark, sf_dir, chain), path, "Stores", row_tag, encoding)
        read[chain] = files.read_store_files(spark, path, chain)
    return stores.stores_union(read)


@query
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.table(spark, sf_dir, "pages")
    return files.listing_links(pages, wanted="the")


@query
def daily_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = consolidate.catalog(tables.price_obs(spark, sf_dir), SNAPSHOT)
    nested = consolidate.nest_prices(prices, SNAPSHOT).withColumnRenamed("snapshot", "pulling_date")
    path = new_dir(spark, "daily-json")
    files.write_snapshot(nested, path, "json")
    read = files.read_daily_json(spark, path).withColumn("pulling_date", F.col("pulling_date").cast("date"))
    return consolidate.flatten_prices(read, ["pulling_date"])


@query
def scan_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return events.orderBy("ts", "event_id").limit(10).select("event_id", "user_id", "event_type")


# ---- sinks ------------------------------------------------------------------------------


@query
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = consolidate.catalog(tables.price_obs(spark, sf_dir), SNAPSHOT).withColumnRenamed("snapshot", "pulling_date")
    path = new_dir(spark, "snapshots")
    files.write_snapshot(prices, path)
    # One day again: only that day's folder is replaced.
    first = _stored(spark, path).agg(F.min("pulling_date")).first()[0]
    again = stage(_stored(spark, path).filter(F.col("pulling_date") == F.lit(first)), "first-day")
    files.write_snapshot(again, path)
    return _stored(spark, path).select("pulling_date", *LONG)


@query
def current_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = consolidate.catalog(tables.price_obs(spark, sf_dir))
    return files.publish_current(prices, "current_catalog", new_dir(spark, "current")).select(*LONG)


@query
def catalog_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as it grows: the years to 1998, then 1999, then the rest, each merged into what is stored."""
    obs = stage(tables.price_obs(spark, sf_dir), "observations")
    year, root = F.year("pulling_date"), new_dir(spark, "catalogue")
    name = "catalogue_" + root.rsplit("-", 1)[1]
    for part in (obs.filter(year < 1999), obs.filter(year == 1999), obs.filter(year > 1999)):
        snapshot = catalog_store.add_observations(spark, root, name, part, tables.stores(spark, sf_dir), buckets=16)
    # The version's folders are known now; only its name goes.
    spark.sql(f"DROP TABLE {name}")
    return snapshot.catalog().select(*LONG)


@query
def to_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = consolidate.nest_prices(consolidate.catalog(tables.price_obs(spark, sf_dir)))
    return files.json_messages(nested.select("id", "name", "chains", "chains_count", "stores_count"))


# ---- projections and filters --------------------------------------------------------------


@query
def canonical_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.price_obs(spark, sf_dir).select(
        "chain", text.by_chain(constants.CHAIN_IDS, F.col("chain")).alias("chain_id"), "store_id", "item_code",
        "item_name", "price", "pulling_date", "snapshot",
    )


@query
def stores_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.stores_union({chain: _store_rows(spark, sf_dir, chain) for chain in constants.CHAINS})


@query
def store_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.price_obs(spark, sf_dir).select("chain", "store_id", "item_code", "item_name", "price", "pulling_date")
    return stores.apply_allowlist(obs, constants.STORE_ALLOWLIST)


@query
def parse_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k INT").alias("value")).select("event_id", "value.*")


@query
def post_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.flatten_posts(tables.raw_posts(_posts(spark, sf_dir))).drop("withheld_in_countries")


@query
def post_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = posts.filter_posts(_posts(spark, sf_dir), KEYWORDS, ["en"])
    return kept.select("doc_id", "lang", "text")


@query
def cart_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    carts = tables.cart_messages(spark, sf_dir).select(F.concat(F.lit("p"), "cart_id").alias("cart_id"), "message")
    chat = tables.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("cart_id"), F.col("text").alias("message")
    )
    return basket.parse_carts(carts.unionByName(chat))


@query
def cart_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).status


@query
def cart_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).summary


@query
def message_intent(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = tables.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("kind"), "text")
    short = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("conv_id"),
        F.lit(-1).cast("long").alias("turn"),
        F.col("p_type").alias("kind"),
        F.when(F.col("p_type") == "SMALL", "/start")
        .when(F.col("p_type") == "LARGE", "TOP5")
        .when(F.col("p_type") == "PROMO", "top5")
        .when(F.col("p_type") == "MEDIUM", constants.START_WORDS[2])
        .otherwise(F.col("p_name")).alias("text"),
    )
    return chat.unionByName(short).select(
        "conv_id", "turn", "kind", text.message_intent(F.col("text"), constants.START_WORDS).alias("intent")
    )


@query
def chat_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step that every chat message leads to."""
    return chat.chat_steps(tables.chat_messages(spark, sf_dir)).drop("day")


@query
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).alias("word_count"))


@query
def local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", space_time.local_date(F.col("ts"), constants.LOCAL_ZONE).alias("local_date"))


@query
def event_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        space_time.iso_seconds(F.col("ts")).alias("at"),
    )


@query
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = text.polarity(F.col("text"), constants.LEXICON)
    return _posts(spark, sf_dir).select("doc_id", F.round(score, 6).alias("sentiment"))


def _learned_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    opinions = sentiment.learned_opinions(_posts(spark, sf_dir), tables.table(spark, sf_dir, "labels"))
    return stage(sentiment.lexicon_of(opinions, sentiment.modifiers(spark)), "lexicon")


@query
def lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment of every text by the words of its good and bad labelled texts, with negations and intensifiers."""
    return sentiment.lexicon_scores(_posts(spark, sf_dir).select("doc_id", "text"), _learned_lexicon(spark, sf_dir))


# ---- joins --------------------------------------------------------------------------------


@query
def obs_store_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.price_obs(spark, sf_dir).select("chain", "store_id", "item_code", "item_name", "price", "pulling_date")
    shops = stores_union(spark, sf_dir)
    return stores.join_stores(obs, shops)


@query
def missing_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores of which no price file came."""
    return files.missing_stores(tables.price_obs(spark, sf_dir), tables.stores(spark, sf_dir))


@query
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier as a candidate key, in a chain it need not belong to."""
    chain = F.element_at(F.array(*[F.lit(name) for name in constants.CHAINS]), (F.col("s_nationkey") % 3 + 1).cast("int"))
    candidates = tables.table(spark, sf_dir, "supplier").select(
        F.concat_ws("@", text.zero_padded(F.col("s_suppkey")), chain).alias("store_key")
    )
    found = stores.store_lookup(candidates, tables.stores(spark, sf_dir))
    return found.select("store_key", "display_name", "latitude", "longitude")


@query
def geocode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.geocode(tables.customer_addresses(spark, sf_dir), tables.gazetteer(spark, sf_dir))
    return rows.select("customer_id", "full_address", "latitude", "longitude", "resolved")


@query
def geocode_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misspelt addresses with the place of the nearest spelling."""
    rows = stores.geocode_fuzzy(tables.misspelt_addresses(spark, sf_dir), stage(tables.gazetteer(spark, sf_dir), "gazetteer"))
    return rows.select("customer_id", "full_address", "matched_address", "edits", "latitude", "longitude", "resolved")


@query
def unresolved_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores.unresolved_addresses(tables.customer_addresses(spark, sf_dir), tables.gazetteer(spark, sf_dir))


@query
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain_id = text.by_chain(constants.CHAIN_IDS, F.col("chain"))
    stamp = F.concat(F.date_format("pulling_date", "yyyyMMdd"), F.lit("0300"))
    names = tables.price_obs(spark, sf_dir).select(
        F.concat(F.lit("PriceFull"), F.concat_ws("-", chain_id, "store_id", stamp), F.lit(".gz")).alias("file_name")
    )
    return stores.latest_file(names)


@query
def product_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text the shopping lists ask for, and every bare product word pair and brand."""
    products = stage(consolidate.catalog_products(_current_prices(spark, sf_dir)), "products")
    part = tables.table(spark, sf_dir, "part")
    texts = [
        part.select(tables.item_name().alias("request")),
        part.select(F.col("p_name").alias("request")),
        part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("request")),
        part.select(F.concat_ws(" ", "p_brand", "p_type", "p_name", "p_name").alias("request")),
    ]
    requests = texts[0]
    for more in texts[1:]:
        requests = requests.unionByName(more)
    return search.product_search(requests, products)


# ---- aggregations -------------------------------------------------------------------------


@query
def consolidate_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.consolidate(tables.price_obs(spark, sf_dir), SNAPSHOT).long()


@query
def multi_chain_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    consolidated = consolidate.consolidate(tables.price_obs(spark, sf_dir), SNAPSHOT)
    return consolidated.long(consolidate.multi_chain_products(consolidated.products))


@query
def merge_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.catalog(tables.price_obs(spark, sf_dir), SNAPSHOT).select(*SNAPSHOT, *LONG)


@query
def flatten_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = consolidate.nest_prices(consolidate.catalog(tables.price_obs(spark, sf_dir), SNAPSHOT), SNAPSHOT)
    return consolidate.flatten_prices(consolidate.drop_empty_chains(nested), SNAPSHOT).select(*SNAPSHOT, *LONG)


@query
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = tables.price_obs(spark, sf_dir).select("item_name", "chain", "store_id", "item_code", "price", "seq")
    return consolidate.dedup_first(obs, ["item_name", "chain"], ["seq"]).drop("seq")


@query
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.top_products(_requests(spark, sf_dir))


@query
def basket_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basket.basket_cost(_order_carts(spark, sf_dir), _offered_prices(spark, sf_dir))


@query
def nearest_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals are taken and ranked where a store is among the cart's nearest carriers: no other can get a rank up to k."""
    carts, prices = _order_carts(spark, sf_dir), _offered_prices(spark, sf_dir)
    users, shops, offer = tables.order_users(spark, sf_dir), tables.stores(spark, sf_dir), basket.offered(prices)
    chosen = nearby.carrying_near(carts, offer, users, stage(nearby._places(shops, offer[0]), "places"))
    return basket.nearest_stores(basket.basket_cost(carts, prices, offer, chosen), users, shops)


@query
def nearest_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as ``nearest_stores``, ranked before they are priced."""
    return nearby.nearest_by_cells(
        _order_carts(spark, sf_dir), _offered_prices(spark, sf_dir), tables.order_users(spark, sf_dir), tables.stores(spark, sf_dir)
    )


@query
def best_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearby.cheapest_covering(
        _order_carts(spark, sf_dir), tables.order_users(spark, sf_dir), tables.stores(spark, sf_dir), basket.offered(_offered_prices(spark, sf_dir))
    )


@query
def message_best_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole basket answer from free text: parse, search, cover, price, nearest, cheapest."""
    return _answers(spark, sf_dir).best


@query
def answer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request record of every answered list."""
    sender = {"user_id": "p_partkey", "chat_id": "p_size", "user_first_name": "p_brand", "user_last_name": "p_type", "user_user_name": "p_name"}
    senders = tables.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("cart_id"), *[F.col(column).alias(name) for name, column in sender.items()])
    return daily.request_messages(_answers(spark, sf_dir), senders)


# ---- history ------------------------------------------------------------------------------


@query
def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.price_history(history.daily_prices(tables.price_obs(spark, sf_dir)))


@query
def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.price_change(history.daily_prices(tables.price_obs(spark, sf_dir)))


@query
def chain_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.chain_compare(history.daily_prices(tables.price_obs(spark, sf_dir)))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.daily_prices(tables.price_obs(spark, sf_dir))


@query
def price_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.price_intervals(_daily(spark, sf_dir))


@query
def price_intervals_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals of the years before 1999, then of 1999, then of the rest, each step on what the one before stored."""
    numbers = tables.numbers(spark, sf_dir)
    daily = stage(history.daily_prices(tables.numbered_obs(spark, sf_dir, numbers)), "daily")
    year = F.year("pulling_date")
    found = stage(history.price_intervals(daily.filter(year < 1999)), "intervals")
    for part in (daily.filter(year == 1999), daily.filter(year > 1999)):
        found = stage(history.extend_intervals(found, part), "intervals")
    return numbers.named(found)


@query
def price_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.price_trend(_daily(spark, sf_dir))


@query
def chain_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.chain_rollup(_daily(spark, sf_dir))


@query
def price_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price of every order line's product and store on the order's day; prices not seen for a year are unknown."""
    numbers = tables.numbers(spark, sf_dir)
    daily = history.daily_prices(tables.numbered_obs(spark, sf_dir, numbers))
    intervals = history.price_intervals(daily, stale_after=365)
    # Read for their days and again for their answers, of which the plan would join twice.
    requests = stage(tables.price_requests(spark, sf_dir, numbers), "price-requests")
    return numbers.named(history.price_as_of(requests, intervals))


# ---- streams ------------------------------------------------------------------------------


def _finish(stream_query) -> None:
    stream_query.awaitTermination()


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = jobs.table_source(spark, f"{sf_dir}/events.parquet")
    return events.select(F.to_json(F.struct(*events.columns)).alias("value"))


EVENT = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.parse_messages(_event_messages(spark, sf_dir), EVENT)
    path = new_dir(spark, "ingest")
    _finish(jobs.append_table(rows, path, new_dir(spark, "ingest-log")))
    return _stored(spark, path).select("event_id", "user_id", "event_type", "value", "props")


@query
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = jobs.fan_out(_event_messages(spark, sf_dir), ["archive", "data"])
    path = new_dir(spark, "fanout")
    _finish(jobs.append_table(routed, path, new_dir(spark, "fanout-log"), ["topic"]))
    event = F.from_json("value", EVENT)
    return _stored(spark, path).select("topic", event.alias("e")).select("topic", "e.event_id", "e.user_id", "e.event_type")


@query
def stream_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = jobs.table_source(spark, f"{sf_dir}/lineitem.parquet")
    messages = files.json_messages(tables.request_records(lineitem, spark, sf_dir))
    rows = jobs.parse_messages(messages, schemas.REQUEST_MESSAGE).withColumn(
        "current_ts", F.current_timestamp().cast("string")
    )
    path = new_dir(spark, "requests")
    _finish(jobs.append_table(rows, path, new_dir(spark, "requests-log")))
    return files.read_requests(spark, path).withColumn("stamped", F.col("current_ts").isNotNull()).drop("current_ts")


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.raw_posts(jobs.table_source(spark, f"{sf_dir}/documents.parquet"))
    rows = posts.enrich_posts(posts.flatten_posts(raw).drop("withheld_in_countries"))
    path = new_dir(spark, "enriched")
    _finish(jobs.append_table(rows, path, new_dir(spark, "enriched-log")))
    return _stored(spark, path).select(
        "tweet_id", "name", "wordCount", F.round("sentiment", 6).alias("sentiment"),
        (F.col("hour") == F.hour("current_ts")).alias("hour_fits"),
    )


@query
def stream_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published products as messages, read back by a stream into one row per price."""
    nested = consolidate.nest_prices(_current_prices(spark, sf_dir))
    inbox, path = new_dir(spark, "product-messages"), new_dir(spark, "streamed-products")
    files.json_messages(nested).write.parquet(inbox)
    messages = jobs.parse_messages(jobs.table_source(spark, inbox), schemas.PRODUCT_MESSAGE)
    _finish(jobs.append_table(consolidate.flatten_prices(messages), path, new_dir(spark, "products-log")))
    return _stored(spark, path).select(*LONG)


@query
def stream_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published stores as messages, read back by a stream under the fields of the message."""
    shops = tables.stores(spark, sf_dir).join(tables.store_dim(spark, sf_dir).select("chain", "store_id", "n_name"), ["chain", "store_id"])
    inbox, path = new_dir(spark, "store-messages"), new_dir(spark, "streamed-stores")
    files.json_messages(stores.store_messages(shops.withColumnRenamed("n_name", "city"), RUN_DATE)).write.parquet(inbox)
    rows = jobs.parse_messages(jobs.table_source(spark, inbox), schemas.STORE_MESSAGE)
    _finish(jobs.append_table(rows, path, new_dir(spark, "stores-log")))
    return _stored(spark, path).drop("Address")


@query
def stream_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "first-events")
    for _ in range(2):
        # The second run meets every key again and must add nothing.
        events = jobs.table_source(spark, f"{sf_dir}/events.parquet")
        _finish(jobs.insert_stream(events, path, new_dir(spark, "first-log"), ["user_id"], ["ts", "event_id"]))
    return _stored(spark, path).select("user_id", "event_id", "event_type", "value")


@query
def stream_chat_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of the events' chats by a stream that keeps each chat's state."""
    messages = tables.event_messages(jobs.table_source(spark, f"{sf_dir}/events.parquet"))
    path = new_dir(spark, "chat-steps")
    _finish(jobs.append_table(stateful.chat_steps_stream(messages), path, new_dir(spark, "chat-log")))
    return _stored(spark, path)


@query
def stream_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of requested products, kept by a stream, and the most requested of them."""
    path = new_dir(spark, "running-counts")
    _finish(stateful.count_requests(
        tables.request_records(jobs.table_source(spark, f"{sf_dir}/lineitem.parquet"), spark, sf_dir), path, new_dir(spark, "counts-log")))
    return popularity.top_counts(stateful.running_counts(spark, path))


@query
def stream_lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of ``lexicon_scores`` by a stream over the texts."""
    lexicon, path = _learned_lexicon(spark, sf_dir), new_dir(spark, "scored")
    texts = jobs.table_source(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")
    _finish(jobs.append_batches(texts, lambda batch: sentiment.lexicon_scores(batch, lexicon), path, new_dir(spark, "scored-log")))
    return _stored(spark, path).drop("batch")
