"""Chat messages: what is asked, and for what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import first_capital_word, strip_blanks

# Command words. The test ignores case, the removal does not.
SEARCH_WORDS = ("search", "find")
REMOVED_WORDS = ("search for", "find")
PRICE_WORD = "price"


def route_messages(messages: DataFrame) -> DataFrame:
    """Add intent, search query and ticker to messages with a `message` column."""
    message = F.col("message")
    lowered = F.lower(message)
    searches = lowered.contains(SEARCH_WORDS[0]) | lowered.contains(SEARCH_WORDS[1])
    query = message
    for words in REMOVED_WORDS:
        query = F.replace(query, F.lit(words), F.lit(""))
    ticker = first_capital_word(message)
    quotes = ~searches & lowered.contains(PRICE_WORD) & ticker.isNotNull()
    return messages.withColumns({
        "intent": F.when(searches, "search").when(quotes, "price").otherwise("help"),
        "query": F.when(searches, strip_blanks(query)),
        "ticker": F.when(quotes, ticker),
    })


def answer_prices(routed: DataFrame, quotes: DataFrame) -> DataFrame:
    """Price questions with the quote of their ticker; unknown tickers get no figures."""
    return routed.filter(F.col("intent") == "price").join(quotes, "ticker", "left")


def intent_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("intent").agg(F.count("*").alias("messages"))
