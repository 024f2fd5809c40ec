"""Prices over time: daily and monthly statistics, changes, comparison of chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricebasket.operators.consolidate import last_prices


def daily_prices(obs: DataFrame) -> DataFrame:
    """The price each store ended each day with."""
    return last_prices(obs, ["pulling_date"]).drop("first_seen")


def price_history(daily: DataFrame, period: str = "month") -> DataFrame:
    """Lowest, mean and highest price per product, chain and period."""
    return daily.groupBy(F.trunc("pulling_date", period).alias("period"), "name", "chain").agg(
        F.min("price").alias("min_price"),
        F.round(F.sum("price").cast("double") / F.count(F.lit(1)), 6).alias("avg_price"),
        F.max("price").alias("max_price"),
    )


def price_change(daily: DataFrame) -> DataFrame:
    """Each day's price against the one before, per product, chain and store.

    A history holds one row per day, so its window stays small however often a day repeats.
    """
    history = Window.partitionBy("name", "chain", "store_id").orderBy("pulling_date")
    return daily.withColumn("previous_price", F.lag("price").over(history)).withColumn(
        "change", F.col("price") - F.col("previous_price")
    )


def chain_compare(daily: DataFrame, period: str = "month") -> DataFrame:
    """Cheapest chain per product and period, and the spread between chains' lowest prices."""
    lowest = daily.groupBy(F.trunc("pulling_date", period).alias("period"), "name", "chain").agg(
        F.min("price").alias("price")
    )
    return lowest.groupBy("period", "name").agg(
        F.min_by("chain", F.struct("price", "chain")).alias("cheapest_chain"),
        F.min("price").alias("cheapest_price"),
        (F.max("price") - F.min("price")).alias("spread"),
        F.count(F.lit(1)).cast("int").alias("chains_count"),
    )


# ---- prices as intervals ------------------------------------------------------------------

KEYS = ["name", "chain", "store_id"]


def _folded(points: DataFrame, stale_after: int | None) -> DataFrame:
    """Neighbouring points of one price as one interval. ``points``: KEYS, valid_from, last_seen, price, days."""
    line = Window.partitionBy(*KEYS).orderBy("valid_from")
    before = F.lag(F.struct("price", "last_seen")).over(line)
    starts = F.col("before").isNull() | ~F.col("price").eqNullSafe(F.col("before.price"))
    if stale_after is not None:
        starts = starts | (F.date_diff("valid_from", F.col("before.last_seen")) > stale_after)
    late = F.raise_error(F.concat(F.lit("a day that comes before what is stored: "), F.col("valid_from").cast("string")))
    # A day within an interval already folded cannot be put in without the days that made it.
    checked = F.when(F.col("valid_from") <= F.col("before.last_seen"), late.cast("int")).otherwise(starts.cast("int"))
    islands = points.withColumn("before", before).withColumn("island", F.sum(checked).over(line))
    folded = islands.groupBy(*KEYS, "island").agg(
        F.min("price").alias("price"), F.min("valid_from").alias("valid_from"),
        F.max("last_seen").alias("last_seen"), F.sum("days").alias("days"))
    until = F.lead("valid_from").over(line)
    if stale_after is not None:
        until = F.least(until, F.date_add("last_seen", stale_after + 1))
    return folded.select(*KEYS, "price", "valid_from", "last_seen", until.alias("valid_to"), "days")


def _points(daily: DataFrame) -> DataFrame:
    day = F.col("pulling_date")
    return daily.select(*KEYS, "price", day.alias("valid_from"), day.alias("last_seen"), F.lit(1).cast("long").alias("days"))


def price_intervals(daily: DataFrame, stale_after: int | None = None) -> DataFrame:
    """Daily prices folded to the times in which they held: price, valid_from, last_seen, valid_to, days.

    ``daily`` as from ``daily_prices``, a row per product, chain, store and day. A price holds until the next
    one differs (``valid_to`` is that day, null for the current price), or, with ``stale_after``, until so
    many days after it was last seen. A blank price is a price like any other: from then on none is known. One shuffle, by
    product and store; a history is bounded by its days however often raw rows repeat.
    """
    return _folded(_points(daily), stale_after)


def extend_intervals(intervals: DataFrame, daily: DataFrame, stale_after: int | None = None) -> DataFrame:
    """Stored intervals after further days, equal to folding all days at once.

    Only each line's last interval can change; closed ones are passed through. A day at or before the
    last one stored for its product and store ends the job.
    """
    if stale_after is None:
        # Each interval but a line's last one ends where the next begins.
        marked = intervals.withColumn("is_last", F.col("valid_to").isNull())
    else:
        last = F.max("valid_from").over(Window.partitionBy(*KEYS))
        marked = intervals.withColumn("is_last", F.col("valid_from") == last)
    closed = marked.filter(~F.col("is_last")).drop("is_last")
    ends = marked.filter("is_last").select(*KEYS, "price", "valid_from", "last_seen", "days")
    return closed.select(*KEYS, "price", "valid_from", "last_seen", "valid_to", "days").unionByName(
        _folded(ends.unionByName(_points(daily)), stale_after))


def price_as_of(requests: DataFrame, intervals: DataFrame, day: str = "day") -> DataFrame:
    """Each request with the price of its product in its store on its day, and since when it held.

    ``requests``: KEYS, ``day`` and any other columns. Interval starts and the distinct days asked for lie in one
    line per product and store, and each day takes the last start at or before it: no range join, and
    a product asked for very often is a line of its distinct days. Requests get their answers back by equality, which
    AQE splits where one of them is hot. Before the first price, after ``valid_to``, on a blank price and
    without a day the price is null.
    """
    # One shuffle by line, after which the starts, which lie by line too, meet the days without another.
    asked = requests.filter(F.col(day).isNotNull()).groupBy(*KEYS).agg(F.collect_set(day).alias("days")).select(
        *KEYS, F.explode("days").alias("at"))
    held = F.struct("price", "valid_from", "valid_to")
    starts = intervals.select(*KEYS, F.col("valid_from").alias("at"), F.lit(0).alias("kind"), held.alias("held"))
    none = F.lit(None).cast(starts.schema["held"].dataType)
    line = Window.partitionBy(*KEYS).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answered = (
        starts.unionByName(asked.select(*KEYS, "at", F.lit(1).alias("kind"), none.alias("held")))
        .withColumn("held", F.last("held", ignorenulls=True).over(line))
        .filter("kind = 1")
        .filter(F.col("held.valid_to").isNull() | (F.col("at") < F.col("held.valid_to")))
        .select(*(F.col(key).alias(f"asked_{key}") for key in KEYS), F.col("at").alias("asked_at"),
                F.col("held.price").alias("price"), F.col("held.valid_from").alias("price_since"))
    )
    same = F.col(day) == F.col("asked_at")
    for key in KEYS:
        same = same & F.col(key).eqNullSafe(F.col(f"asked_{key}"))
    return requests.join(answered, same, "left").select(*requests.columns, "price", "price_since")


# ---- trends and totals --------------------------------------------------------------------


def filled_days(lowest: DataFrame, stale_after: int) -> DataFrame:
    """Every day on which a price is known: name, chain, day, price, observed.

    ``lowest``: name, chain, pulling_date, price, a row per line and day. A price is taken on to the day before the next one, for at most ``stale_after``
    days, so a row becomes a bounded number of days.
    """
    line = Window.partitionBy("name", "chain").orderBy("pulling_date")
    last = F.least(F.date_sub(F.lead("pulling_date").over(line), 1), F.date_add("pulling_date", stale_after))
    days = F.sequence("pulling_date", "last", F.expr("INTERVAL 1 DAY"))
    return lowest.withColumn("last", last).select("name", "chain", "price", "pulling_date", F.explode(days).alias("day")).select(
        "name", "chain", "day", "price", (F.col("day") == F.col("pulling_date")).alias("observed"))


def price_trend(daily: DataFrame, days: int = 28, stale_after: int = 30) -> DataFrame:
    """For each product, chain and day with a price: the lowest one, and the mean, slope (a day) and number of the last ``days`` days' prices.

    Days without a file take the last price, up to ``stale_after`` days old. Frames reach over days, not rows, and days are dates: neither a missing day nor
    a change of clocks shifts them. Blank prices are no prices. The slope is null on a single day.
    """
    lowest = daily.filter(F.col("price").isNotNull()).groupBy("name", "chain", "pulling_date").agg(F.min("price").alias("price"))
    number = F.date_diff("day", F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy("name", "chain").orderBy("number").rangeBetween(1 - days, 0)
    value = F.col("price").cast("double")
    return (
        filled_days(lowest, stale_after).withColumn("number", number)
        .withColumns({
            "known_days": F.count(F.lit(1)).over(frame),
            "mean_price": F.round(F.sum("price").over(frame).cast("double") / F.count(F.lit(1)).over(frame), 6),
            "slope": F.round(F.regr_slope(value, F.col("number").cast("double")).over(frame), 6),
        })
        .filter("observed").select("name", "chain", "day", "price", "known_days", "mean_price", "slope")
    )


def chain_rollup(daily: DataFrame, period: str = "month") -> DataFrame:
    """Number, lowest, mean and highest of daily prices by chain, period and product, and their totals.

    Totals over products, over chains, over both and over everything. ``level`` (grouping_id of chain, period, name) tells a total from a row whose
    key is null. Prices are combined per (chain, period, name) before they are multiplied into the totals' rows, and again on the map side there.
    """
    finest = daily.filter(F.col("price").isNotNull()).groupBy("chain", F.trunc("pulling_date", period).alias("period"), "name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"), F.min("price").alias("low"), F.max("price").alias("high"))
    sets = [["chain", "period", "name"], ["chain", "period"], ["period", "name"], ["period"], ["chain"], []]
    columns = {name: F.col(name) for name in ("chain", "period", "name")}
    return finest.groupingSets([[columns[name] for name in each] for each in sets], *columns.values()).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("n").alias("prices"), F.min("low").alias("min_price"),
        F.round(F.sum("total").cast("double") / F.sum("n"), 6).alias("mean_price"), F.max("high").alias("max_price"))
