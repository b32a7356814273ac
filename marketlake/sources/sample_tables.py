"""The sample star schema and event tables, shaped as the tables of this library.

Every adapter reads whole tables. Optional date bounds are put on the stored column, so
they reach the parquet scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_ARTICLE = 1704067200  # 2024-01-01 00:00:00 UTC
FIRST_NOTE = 1706659200  # 2024-01-31 00:00:00 UTC
HOUR = 3600
NEWS_TICKERS = 10
NOTE_USERS = 150


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def numbered_ticker(number: Column) -> Column:
    return F.concat(F.lit("SUPPLIER#"), F.lpad(number.cast("string"), 9, "0"))


def customer_email(number: Column) -> Column:
    return F.concat(F.lit("customer#"), F.lpad(number.cast("string"), 9, "0"), F.lit("@example.com"))


def member_email(number: Column) -> Column:
    return F.concat(F.lit("member"), number.cast("string"), F.lit("@example.com"))


def landed_prices(
    spark: SparkSession, folder: str, since: date | Column | None = None, until: date | Column | None = None
) -> DataFrame:
    """One bar per line item; `until` is the first day left out."""
    lines = table(spark, folder, "lineitem")
    if since is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        lines = lines.filter(F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.upper("s_name").alias("ticker"))
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).select(
        "ticker",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        (price - quantity).alias("open"),
        (price + F.col("l_linenumber")).alias("high"),
        (price - quantity - F.col("l_linenumber")).alias("low"),
        price.alias("close"),
        quantity.cast("bigint").alias("volume"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


# Columns that order the landing of bars for the same day.
BAR_ORDER = ("l_orderkey", "l_linenumber", "l_partkey")


def landed_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings per supplier: a bare first one and a full second one.

    The balance gives the ratios; suppliers in debt have no sector and no earnings ratio.
    """
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    balance, debt = F.col("s_acctbal"), F.col("s_acctbal") < 0
    full = (
        suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .select(
            F.upper("s_name").alias("ticker"),
            F.concat(F.lit("Company "), F.col("s_suppkey").cast("string")).alias("name"),
            F.when(~debt, F.col("r_name")).alias("sector"),
            F.col("n_name").alias("industry"),
            (F.floor(balance) * 1_000_000).alias("marketCap"),
            F.concat(F.lit("Supplier in "), "n_name").alias("description"),
            F.lit("").alias("website"),
            F.col("s_suppkey").alias("employees"),
            F.col("n_name").alias("country"),
            F.lit(None).cast("string").alias("currency"),
            F.when(~debt, F.round(balance / 100, 2)).alias("trailingPE"),
            F.lit(None).cast("double").alias("forwardPE"),
            (F.col("s_nationkey") / 1000).alias("dividendYield"),
        )
    )
    landings = F.explode(F.array(F.lit(1), F.lit(2))).alias("landing")
    second = F.col("landing") == 2
    late = ("marketCap", "description", "industry")
    return full.select("*", landings).withColumns({c: F.when(second, F.col(c)) for c in late})


def landed_news(spark: SparkSession, folder: str) -> DataFrame:
    """One article per document: the first line is its headline, the whole text its content."""
    return table(spark, folder, "documents").select(
        numbered_ticker(F.col("doc_id") % NEWS_TICKERS).alias("ticker"),
        F.substring_index("text", "\n", 1).alias("title"),
        "source",
        (F.col("doc_id") * HOUR + FIRST_ARTICLE).alias("publishedAt"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.lit(None).cast("string").alias("summary"),
        F.col("text").alias("content"),
    )


def tickers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(F.upper("s_name").alias("ticker"))


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.when(F.col("label") < 5, "news").otherwise("company_profile").alias("doc_type"),
        numbered_ticker(F.col("vec_id") % NEWS_TICKERS).alias("ticker"),
        "label",
        "embedding",
    )


def mean_vectors(index: DataFrame, key: str) -> DataFrame:
    """Mean vector per key: averaged per place, then put together again."""
    places = index.select(F.col(key).alias("query_id"), F.posexplode("embedding").alias("place", "value"))
    means = places.groupBy("query_id", "place").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    whole = F.sort_array(F.collect_list(F.struct("place", "mean")))
    return means.groupBy("query_id").agg(whole.alias("_m")).select(
        "query_id", F.transform("_m", lambda m: m["mean"]).alias("query_vector")
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    number = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        number.alias("k"),
    )


def _change_columns() -> list[Column]:
    kind = F.col("event_id") % 10
    change = F.when(kind < 7, "insert").when(kind == 7, "update_preimage")
    return [
        change.when(kind == 8, "update_postimage").otherwise("delete").alias("_change_type"),
        F.dayofmonth("ts").cast("long").alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"),
    ]


def tool_call_feed(spark: SparkSession, folder: str) -> DataFrame:
    k, failed = F.col("k"), F.col("event_type") == "error"
    return _events(spark, folder).select(
        F.col("event_id").cast("string").alias("call_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("tool_"), F.lpad((k % 11).cast("string"), 2, "0")).alias("tool_name"),
        F.when(k % 4 != 0, F.concat(F.lit("T"), (k % 8).cast("string"))).alias("ticker"),
        (~failed).alias("success"),
        F.when(failed & (k % 3 != 0), F.concat(F.lit("E"), (k % 5).cast("string"))).alias("error_message"),
        F.floor("value").alias("execution_time_ms"),
        *_change_columns(),
    )


def watchlist_feed(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    events = _events(spark, folder).filter(F.col("event_type").isin("signup", "purchase", "error"))
    return events.select(
        F.col("event_id").cast("string").alias("mutation_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("T"), (k % 8).cast("string")).alias("ticker"),
        F.when(F.col("event_type") == "error", "remove").otherwise("add").alias("operation"),
        F.when(k % 2 == 0, "app").otherwise("agent").alias("source"),
        *_change_columns(),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("display_name"),
        F.lit(date(1995, 1, 1)).cast("timestamp").alias("created_at"),
    )


def watchlists(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("watchlist_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("string").alias("description"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def watchlist_tickers(spark: SparkSession, folder: str) -> DataFrame:
    latest = table(spark, folder, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        F.max("l_shipdate").cast("timestamp").alias("added_at")
    )
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.upper("s_name").alias("ticker"))
    return latest.join(suppliers, latest.l_suppkey == suppliers.s_suppkey).select(
        F.col("l_orderkey").alias("watchlist_id"), "ticker", "added_at"
    )


def add_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups come from customers, purchases from people without an account."""
    k, user = F.col("k"), F.col("user_id")
    events = _events(spark, folder).filter(F.col("event_type").isin("signup", "purchase"))
    return events.select(
        F.when(F.col("event_type") == "signup", customer_email(user)).otherwise(member_email(user)).alias("email"),
        F.when(k % 3 == 1, "1-URGENT").when(k % 3 == 2, "3-MEDIUM").alias("list_name"),
        F.lower(numbered_ticker(k)).alias("ticker"),
        F.col("ts").alias("requested_at"),
    )


def remove_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Failed events ask for a ticker to be taken off; many of them are not listed."""
    k = F.col("k")
    names = F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")))
    return _events(spark, folder).filter(F.col("event_type") == "error").select(
        customer_email(F.col("user_id")).alias("email"),
        F.element_at(names, k % 5 + 1).alias("list_name"),
        F.lower(numbered_ticker(k)).alias("ticker"),
        F.col("ts").alias("requested_at"),
    )


def watchlist_log(spark: SparkSession, folder: str) -> DataFrame:
    """An ordered log of watchlist operations."""
    k = F.col("k")
    return _events(spark, folder).filter(F.col("event_type").isin("signup", "purchase", "error")).select(
        customer_email(F.col("user_id")).alias("email"),
        F.when(k % 2 == 0, "app").otherwise("agent").alias("list_name"),
        F.concat(F.lit("t"), (k % 8).cast("string")).alias("ticker"),
        F.when(F.col("event_type") == "error", "remove").otherwise("add").alias("operation"),
        "ts",
        "event_id",
    )


def research_notes(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("doc_id")
    return table(spark, folder, "documents").select(
        number.alias("note_id"),
        (number % NOTE_USERS).alias("user_id"),
        numbered_ticker(number % NEWS_TICKERS).alias("ticker"),
        F.lit(None).cast("string").alias("title"),
        F.col("text").alias("content"),
        F.timestamp_seconds(number * HOUR + FIRST_ARTICLE).alias("created_at"),
    )


def note_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn saved as a note; users write as customers, others as members."""
    conversation, turn = F.col("conv_id"), F.col("turn")
    return table(spark, folder, "conversations").select(
        F.concat_ws("-", conversation.cast("string"), turn.cast("string")).alias("request_id"),
        F.when(F.col("role") == "user", customer_email(conversation))
        .otherwise(member_email(conversation)).alias("email"),
        F.lower(numbered_ticker(conversation % NEWS_TICKERS)).alias("ticker"),
        F.col("text").alias("note"),
        F.timestamp_seconds(conversation * 60 + turn + FIRST_NOTE).alias("requested_at"),
    )


def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    """What users wrote, put as a search, a price question, a find, or left as it is."""
    conversation, text = F.col("conv_id"), F.col("text")
    form = conversation % 4
    price = F.concat(F.lit("price of T"), (conversation % 8).cast("string"))
    return table(spark, folder, "conversations").filter(F.col("role") == "user").select(
        "conv_id",
        "turn",
        F.when(form == 0, F.concat(F.lit("search for "), text))
        .when(form == 1, price)
        .when(form == 2, F.concat(F.lit("find "), text))
        .otherwise(text)
        .alias("message"),
    )


def range_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One price range per order: its day and number say where it starts and how long it is."""
    number = F.col("o_orderkey")
    since = F.date_sub(F.col("o_orderdate").cast("date"), (number % 40).cast("int"))
    return table(spark, folder, "orders").select(
        number.alias("request_id"),
        F.lower(numbered_ticker(number % NEWS_TICKERS + 1)).alias("ticker"),
        since.alias("since"),
        F.date_add(since, (number * 7 % 800).cast("int")).alias("until"),
    )
