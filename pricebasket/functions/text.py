"""Column expressions over text: ids, cart lines, search tokens, word counts, polarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricebasket import schemas


def zero_padded(value: Column, width: int = 3) -> Column:
    """Left-pad with zeros up to ``width``; longer values stay whole (``lpad`` alone would cut them)."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def date_part(value: Column) -> Column:
    """The date in front of a ``date time`` text; null when it is no date."""
    return F.to_date(F.try_to_timestamp(F.split_part(F.trim(value), F.lit(" "), F.lit(1)), F.lit("yyyy-MM-dd")))


def search_tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    words = F.split(F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), " ")
    return F.filter(words, lambda word: word != "")


def cart_lines(message: Column) -> Column:
    """``"tomato 1, corn can 2"`` as an array of (product_name, quantity_text, quantity).

    The last word of each comma-separated part is the quantity, the words before it,
    joined by single blanks, the name. A quantity that is no number, is too large or has more
    decimals than a quantity holds becomes null: it is never rounded.
    """

    def line(part):
        words = F.filter(F.split(part, r"\s+"), lambda word: word != "")
        size = F.size(words)
        quantity = F.when(size > 0, F.get(words, size - 1)).otherwise("")
        name = F.when(size > 1, F.array_join(F.slice(words, 1, F.greatest(size - 1, F.lit(0))), " ")).otherwise("")
        return F.struct(
            name.alias("product_name"),
            quantity.alias("quantity_text"),
            F.when(
                quantity.try_cast(schemas.QUANTITY) == quantity.try_cast(schemas.ANY_NUMBER), quantity.try_cast(schemas.QUANTITY)
            ).alias("quantity"),
        )

    return F.transform(F.split(message, ","), line)


def word_count(text: Column) -> Column:
    """Parts between single blanks; doubled blanks count as an empty word."""
    return F.size(F.split(text, " "))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def polarity(text: Column, lexicon: dict[str, float]) -> Column:
    """Mean polarity of the opinion words in ``text``; 0 when there is none, null for null text.

    A projection: each text is tokenised once and its tokens looked up in a hash set, with no
    shuffle and no Python, so it runs in a stream as well.
    """
    polarities = F.create_map(*[F.lit(part) for entry in sorted(lexicon.items()) for part in entry])
    opinions = F.filter(search_tokens(text), lambda token: token.isin(sorted(lexicon)))

    def mean(words: Column) -> Column:
        total = F.aggregate(words, F.lit(0.0), lambda sum_, word: sum_ + polarities[word])
        return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(total / F.size(words))

    return F.when(text.isNotNull(), bind(opinions, mean))


def mentions(text: Column, keywords: list[str]) -> Column:
    """True when any keyword occurs as a whole word, ignoring case."""
    alternatives = "|".join(r"\Q" + word + r"\E" for word in keywords)
    return text.rlike(rf"(?i)\b(?:{alternatives})\b")


def message_intent(text: Column, start_words: tuple[str, ...]) -> Column:
    return (
        F.when(text.isin(list(start_words)), F.lit("start"))
        .when(F.lower(text) == "top5", F.lit("top_products"))
        .otherwise(F.lit("cart"))
    )


def by_chain(values: dict[str, str], chain: Column) -> Column:
    """The value of a per-chain constant table; null for an unknown chain."""
    out = F.lit(None).cast("string")
    for name, value in values.items():
        out = F.when(chain == name, F.lit(value)).otherwise(out)
    return out
