"""Declared schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_STR, _LONG, _INT, _DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_BOOL, _DATE, _TS = T.BooleanType(), T.DateType(), T.TimestampType()
PRICE = T.DecimalType(12, 4)
VECTOR = T.ArrayType(T.FloatType())

BRONZE_PRICES = _table(
    ("ticker", _STR), ("date", _STR), ("open", _DBL), ("high", _DBL), ("low", _DBL),
    ("close", _DBL), ("volume", _LONG),
)
BRONZE_COMPANIES = _table(
    ("ticker", _STR), ("name", _STR), ("sector", _STR), ("industry", _STR),
    ("marketCap", _LONG), ("description", _STR), ("website", _STR), ("employees", _LONG),
    ("country", _STR), ("currency", _STR),
)
BRONZE_NEWS = _table(
    ("ticker", _STR), ("title", _STR), ("source", _STR), ("publishedAt", _LONG),
    ("url", _STR), ("summary", _STR), ("content", _STR),
)
QUOTE_SNAPSHOT = _table(
    ("ticker", _STR), ("longName", _STR), ("currentPrice", _DBL), ("regularMarketPrice", _DBL),
    ("previousClose", _DBL), ("regularMarketChange", _DBL),
    ("regularMarketChangePercent", _DBL), ("dayHigh", _DBL), ("dayLow", _DBL),
    ("volume", _LONG), ("marketCap", _LONG),
)
SILVER_PRICES = _table(
    ("ticker", _STR), ("snapshot_date", _DATE), ("open_price", PRICE), ("close_price", PRICE),
    ("high_price", PRICE), ("low_price", PRICE), ("volume", _LONG),
)
SILVER_COMPANIES = _table(
    ("ticker", _STR), ("company_name", _STR), ("sector", _STR), ("industry", _STR),
    ("market_cap", _LONG), ("company_description", _STR), ("updated_at", _TS),
)
SILVER_NEWS = _table(
    ("ticker", _STR), ("title", _STR), ("source", _STR), ("published_at", _TS), ("url", _STR),
    ("summary", _STR), ("full_text", _STR), ("ingested_at", _TS),
)
CORPUS = _table(
    ("doc_id", _STR), ("doc_type", _STR), ("ticker", _STR), ("title", _STR), ("text", _STR),
    ("metadata_date", _STR), ("metadata_source", _STR),
)
TEXT_EMBEDDINGS = T.StructType([*CORPUS.fields, T.StructField("embedding", VECTOR)])
# The index as stored: what was embedded, and whether that worked.
INDEX = T.StructType([
    *CORPUS.fields,
    T.StructField("text_hash", T.StringType()),
    T.StructField("embedding", VECTOR),
    T.StructField("embed_ok", T.BooleanType()),
])
# Texts on which the encoder failed, with the last error and the runs it failed in.
FAILURES = _table(("doc_id", _STR), ("text_hash", _STR), ("error", _STR), ("tries", _INT))
DOCUMENT_EMBEDDINGS = _table(
    ("ticker", _STR), ("title", _STR), ("text", _STR), ("date", _STR), ("doc_type", _STR),
    ("embedding_array", T.ArrayType(_DBL)),
)
AGENT_TOOL_CALLS = _table(
    ("call_id", _STR, False), ("timestamp", _TS, False), ("user_id", _STR, False),
    ("tool_name", _STR, False), ("ticker", _STR), ("success", _BOOL, False),
    ("error_message", _STR), ("execution_time_ms", _LONG, False),
)
WATCHLIST_MUTATIONS = _table(
    ("mutation_id", _STR), ("timestamp", _TS), ("user_id", _STR), ("ticker", _STR),
    ("operation", _STR), ("source", _STR),
)
FEED_COLUMNS = _table(
    ("_change_type", _STR), ("_commit_version", _LONG), ("_commit_timestamp", _TS),
)
DAILY_USAGE_STATS = _table(
    ("date", _DATE), ("user_id", _STR), ("total_tool_calls", _INT), ("successful_calls", _INT),
    ("failed_calls", _INT), ("watchlist_additions", _INT), ("watchlist_removals", _INT),
    ("unique_tickers_viewed", _INT), ("most_used_tool", _STR), ("last_updated", _TS),
)
USERS = _table(("user_id", _LONG), ("email", _STR), ("display_name", _STR), ("created_at", _TS))
WATCHLISTS = _table(
    ("watchlist_id", _LONG), ("user_id", _LONG), ("name", _STR), ("description", _STR),
    ("created_at", _TS),
)
WATCHLIST_TICKERS = _table(("watchlist_id", _LONG), ("ticker", _STR), ("added_at", _TS))
RESEARCH_NOTES = _table(
    ("note_id", _LONG), ("user_id", _LONG), ("ticker", _STR), ("title", _STR),
    ("content", _STR), ("created_at", _TS),
)

# The declared tables by name, and the columns that partition them.
DECLARED_TABLES = {
    "users": USERS,
    "watchlists": WATCHLISTS,
    "watchlist_tickers": WATCHLIST_TICKERS,
    "price_snapshots": SILVER_PRICES,
    "research_notes": RESEARCH_NOTES,
    "agent_tool_calls": AGENT_TOOL_CALLS,
    "watchlist_mutations": WATCHLIST_MUTATIONS,
    "daily_usage_stats": DAILY_USAGE_STATS,
}
PARTITION_COLUMNS = {"daily_usage_stats": ("date",)}


def feed_of(table: T.StructType) -> T.StructType:
    """Schema of a table's change feed: its columns and the three feed columns."""
    return T.StructType([*table.fields, *FEED_COLUMNS.fields])
