"""Registered queries over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.moments import moment
from marketlake.functions.vectors import SCORE_DIGITS
from marketlake.operators import (
    changefeed,
    corpus,
    embed,
    lsh,
    notes,
    price_ranges,
    prices,
    routing,
    search,
    silver,
    stored_index,
    usage,
    vector_index,
    watchlists,
)
from marketlake.operators.keyed_store import WatchlistStore
from marketlake.plans import medallion, usage_deltas
from marketlake.plans.usage_rollup import UsagePaths, read_daily_stats, run_usage_rollup
from marketlake.schemas import INDEX
from marketlake.session import fresh_path, materialize, prepare
from marketlake.sources import landing, sample_tables, tables
from marketlake.streaming import usage_windows
from marketlake.streaming.usage_stream import start_usage_stream

Query = Callable[[SparkSession, str], DataFrame]

# The clock of the sample tables: last day of prices, end of the event log.
PRICES_AS_OF = date(2001, 11, 4)
LOADED_AT = datetime(2001, 11, 5)
EVENTS_AS_OF = datetime(2024, 1, 31)
# A first commit of the feeds, an earlier index and an earlier snapshot end here.
EVENTS_HALFWAY = datetime(2024, 1, 16)

# Dimensions of the encoder and of the sample vectors.
DIM = embed.DEFAULT_ENCODER.dim
SAMPLE_DIM = 64
INDEX_CLUSTERS = 16
# What the queries for one ticker and one user ask for.
ONE_TICKER = "SUPPLIER#000000003"
NOTES_TICKER = "SUPPLIER#000000007"
ONE_EMAIL = "customer#000000007@example.com"
ENCODER = embed.DEFAULT_ENCODER

_REGISTERED: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    _REGISTERED[function.__name__] = run
    return run


# Tables the queries start from ------------------------------------------------------------


def _bars(spark, folder, since=None) -> DataFrame:
    landed = sample_tables.landed_prices(spark, folder, since=since)
    return silver.clean_prices(landed, sample_tables.BAR_ORDER)


def _bars_back(spark, folder, months: int) -> DataFrame:
    return _bars(spark, folder, since=prices.back_to(PRICES_AS_OF, months))


def _newest_bars(spark, folder) -> DataFrame:
    landed = silver.newest_days(sample_tables.landed_prices(spark, folder), days=2)
    return silver.clean_prices(landed, sample_tables.BAR_ORDER)


def _profiles(spark, folder) -> DataFrame:
    return landing.bronze_companies(sample_tables.landed_companies(spark, folder))


def _companies(spark, folder) -> DataFrame:
    return silver.clean_companies(_profiles(spark, folder), LOADED_AT, ["landing"])


def _news(spark, folder) -> DataFrame:
    bronze = landing.bronze_news(sample_tables.landed_news(spark, folder), limit=None)
    return silver.clean_news(bronze, LOADED_AT)


def _corpus(spark, folder) -> DataFrame:
    return corpus.text_corpus(_news(spark, folder), _companies(spark, folder))


def _text_index(spark, folder) -> DataFrame:
    """The embedded corpus as a stored table: search reads it twice, embedding runs once."""
    return materialize(embed.laid_out(embed.embed_corpus(_corpus(spark, folder))), "text_embeddings")


def _as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for comparison."""
    return df.select(*[
        F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else f.name for f in df.schema
    ])


def _spelled(vector: str):
    """A vector as text, in millionths."""
    scale = 10**SCORE_DIGITS
    return F.array_join(
        F.transform(vector, lambda x: F.round(x.cast("double") * scale).cast("bigint").cast("string")), ","
    )


# Landing and silver -----------------------------------------------------------------------


@_query
def bronze_prices(spark, folder):
    landed = sample_tables.landed_prices(
        spark, folder, since=F.date_sub(F.lit(PRICES_AS_OF), landing.PRICE_DAYS), until=PRICES_AS_OF
    )
    return landing.bronze_prices(landed, PRICES_AS_OF).drop(*sample_tables.BAR_ORDER)


@_query
def bronze_companies(spark, folder):
    return _profiles(spark, folder)


@_query
def bronze_news(spark, folder):
    return landing.bronze_news(sample_tables.landed_news(spark, folder))


@_query
def ingest_report(spark, folder):
    asked = sample_tables.tickers(spark, folder)
    landed = {
        "prices": sample_tables.landed_prices(spark, folder),
        "companies": sample_tables.landed_companies(spark, folder),
        "news": sample_tables.landed_news(spark, folder),
    }
    reports = [landing.ingest_report(asked, rows, source) for source, rows in landed.items()]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@_query
def table_profile(spark, folder):
    profiles = [
        tables.profile(_bars(spark, folder), "silver_prices"),
        tables.profile(_companies(spark, folder), "silver_companies"),
        tables.profile(_news(spark, folder), "silver_news"),
    ]
    return profiles[0].unionByName(profiles[1]).unionByName(profiles[2])


@_query
def corpus_counts(spark, folder):
    return _corpus(spark, folder).groupBy("doc_type").agg(F.count("*").alias("documents"))


@_query
def silver_prices(spark, folder):
    return _as_doubles(_bars(spark, folder))


@_query
def silver_companies(spark, folder):
    return _companies(spark, folder)


@_query
def silver_news(spark, folder):
    return _news(spark, folder)


# Prices -----------------------------------------------------------------------------------


@_query
def price_history(spark, folder):
    start = F.date_sub(F.lit(PRICES_AS_OF), 90)
    return prices.price_history(_bars(spark, folder, since=start), start, PRICES_AS_OF)


@_query
def price_quote(spark, folder):
    return prices.price_quote(_newest_bars(spark, folder), _companies(spark, folder))


@_query
def dashboard_quote(spark, folder):
    return prices.dashboard_quote(_newest_bars(spark, folder), _companies(spark, folder))


def _snapshots(spark, folder) -> DataFrame:
    """Provider snapshots: some carry their own change, some no current price."""
    number = F.col("s_suppkey")
    return sample_tables.table(spark, folder, "supplier").select(
        F.upper("s_name").alias("ticker"),
        F.when(number % 3 != 0, F.concat(F.lit("Company "), number.cast("string"))).alias("longName"),
        F.when(number % 4 != 0, F.col("s_acctbal")).alias("currentPrice"),
        (F.col("s_acctbal") + 1).alias("regularMarketPrice"),
        F.when(number % 5 != 0, F.col("s_acctbal") - F.col("s_nationkey")).alias("previousClose"),
        F.when(number % 2 == 0, F.lit(1.5)).alias("regularMarketChange"),
        F.when(number % 2 == 0, F.lit(0.25)).alias("regularMarketChangePercent"),
        number.cast("bigint").alias("volume"),
        F.lit(None).cast("double").alias("dayHigh"),
        F.col("s_acctbal").alias("dayLow"),
        F.lit(None).cast("bigint").alias("marketCap"),
    )


@_query
def quote_from_snapshot(spark, folder):
    return prices.quote_from_snapshot(_snapshots(spark, folder))


@_query
def price_history_of_ticker(spark, folder):
    start = F.date_sub(F.lit(PRICES_AS_OF), 90)
    return prices.price_history(_bars(spark, folder, since=start), start, PRICES_AS_OF, ticker=ONE_TICKER.lower())


@_query
def compare_listed_tickers(spark, folder):
    listed = ["supplier#000000007", "SUPPLIER#000000002", ONE_TICKER, "NOBODY", "supplier#000000002"]
    return prices.compare_tickers(
        _bars_back(spark, folder, 1), _companies(spark, folder), PRICES_AS_OF, days=30, tickers=listed
    )


@_query
def price_period_summary(spark, folder):
    return prices.price_period_summary(_bars_back(spark, folder, 1), PRICES_AS_OF, days=30)


@_query
def price_period_summary_90_days(spark, folder):
    return prices.price_period_summary(_bars_back(spark, folder, 3), PRICES_AS_OF, days=90)


@_query
def price_period_summary_180_days(spark, folder):
    return prices.price_period_summary(_bars_back(spark, folder, 6), PRICES_AS_OF, days=180)


@_query
def compare_tickers(spark, folder):
    return prices.compare_tickers(
        _bars_back(spark, folder, 1), _companies(spark, folder), PRICES_AS_OF, days=30
    )


@_query
def compare_tickers_90_days(spark, folder):
    return prices.compare_tickers(
        _bars_back(spark, folder, 3), _companies(spark, folder), PRICES_AS_OF, days=90
    )


@_query
def company_fundamentals(spark, folder):
    latest = _latest_profiles(spark, folder)
    year = _bars(spark, folder, since=F.date_sub(F.lit(PRICES_AS_OF), 364))
    return prices.company_fundamentals(latest, year, PRICES_AS_OF)


def _latest_profiles(spark, folder) -> DataFrame:
    return silver.first_per_key(_profiles(spark, folder), ["ticker"], [F.desc("landing")])


@_query
def price_range_summary(spark, folder):
    """Any range per request, from month blocks and the days at both ends."""
    bars = materialize(_bars(spark, folder), "bars")
    blocks = materialize(price_ranges.month_blocks(bars), "month-blocks")
    return price_ranges.summaries(sample_tables.range_requests(spark, folder), blocks, bars)


# Corpus, embedding, search ----------------------------------------------------------------


@_query
def text_corpus(spark, folder):
    return _corpus(spark, folder)


@_query
def corpus_embeddable(spark, folder):
    return corpus.with_text(_corpus(spark, folder)).select("doc_id", "doc_type", F.length("text").alias("chars"))


@_query
def corpus_sentence(spark, folder):
    return corpus.sentence_corpus(_news(spark, folder), _companies(spark, folder))


@_query
def embed_corpus(spark, folder):
    embedded = embed.embed_corpus(_corpus(spark, folder))
    return embedded.select("doc_id", "doc_type", "ticker", "embed_ok", _spelled("embedding").alias("vector"))


def _earlier_corpus(spark, folder) -> DataFrame:
    """Articles up to the halfway time and bare profiles."""
    return corpus.text_corpus(
        _news(spark, folder).filter(F.col("published_at") < moment(EVENTS_HALFWAY)),
        _companies(spark, folder).withColumn("company_description", F.lit(None).cast("string")),
    )


@_query
def embed_incremental(spark, folder):
    """What is new against an index of the earlier corpus."""
    earlier = corpus.unique_documents(corpus.with_text_hash(_earlier_corpus(spark, folder)))
    index = earlier.withColumn("embed_ok", F.lit(True))
    new = embed.embed_incremental(_corpus(spark, folder), index)
    return new.select("doc_id", "text_hash", _spelled("embedding").alias("vector"))


def _read_index(spark, path: str) -> DataFrame:
    index = tables.read_version(spark, path, INDEX)
    return index.select(
        "doc_id", "doc_type", "ticker", "metadata_date", "metadata_source", "embed_ok",
        _spelled("embedding").alias("vector"),
    )


@_query
def index_refresh(spark, folder):
    """An index of the earlier corpus, with other dates, brought up to date."""
    path = fresh_path(spark, "index")
    medallion.refresh_index(_earlier_corpus(spark, folder).withColumn("metadata_date", F.lit("1999")), path)
    medallion.refresh_index(_corpus(spark, folder), path)
    return _read_index(spark, path)


def _failing(texts):
    raise RuntimeError("no answer")


@_query
def index_retry(spark, folder):
    """An index whose first embedding failed throughout, refreshed with a working encoder."""
    path = fresh_path(spark, "index")
    medallion.refresh_index(_corpus(spark, folder), path, _failing)
    medallion.refresh_index(_corpus(spark, folder), path)
    return _read_index(spark, path)


def _picky(texts):
    """An encoder that refuses some texts."""
    if any(len(text) % 41 == 0 for text in texts):
        raise ValueError("refused")
    return ENCODER(texts)


@_query
def embed_failures(spark, folder):
    """Texts that an encoder refused in two refreshes, and nothing but those."""
    path = fresh_path(spark, "index")
    for _ in range(2):
        medallion.refresh_index(_corpus(spark, folder), path, _picky)
    failed = medallion.read_failures(spark, path)
    index = tables.read_version(spark, path, INDEX).select("doc_id", "embed_ok")
    return failed.join(index, "doc_id").select("doc_id", "error", "tries", "embed_ok")


@_query
def embed_clipped(spark, folder):
    """Vectors of the first characters of each text, as for a model with an input limit."""
    embedded = embed.embed_corpus(_corpus(spark, folder), max_chars=embed.MODEL_INPUT_LENGTH)
    return embedded.select("doc_id", _spelled("embedding").alias("vector"))


def _label_queries(index: DataFrame) -> DataFrame:
    return sample_tables.mean_vectors(index, "label")


@_query
def knn_topk(spark, folder):
    """The documents nearest to the mean of the whole index."""
    index = sample_tables.vector_index(spark, folder)
    overall = sample_tables.mean_vectors(index.withColumn("one", F.lit(0)), "one")
    found = search.top_k(index, overall)
    return found.select("doc_id", "score", "rank")


@_query
def knn_batch(spark, folder):
    """The documents nearest to the mean of every label."""
    index = sample_tables.vector_index(spark, folder)
    return search.top_k(index, _label_queries(index))


@_query
def knn_indexed(spark, folder):
    """The same as `knn_batch`, from an index that skips clusters."""
    vectors = sample_tables.vector_index(spark, folder)
    path = fresh_path(spark, "vector-index")
    index = vector_index.build_index(vectors, path, SAMPLE_DIM, INDEX_CLUSTERS)
    return vector_index.search_index(spark, index, _label_queries(vectors))


@_query
def index_reopened(spark, folder):
    """The same as `knn_batch`, from a stored index that is opened again."""
    vectors = sample_tables.vector_index(spark, folder)
    path = fresh_path(spark, "stored-index")
    stored_index.build(vectors, path, SAMPLE_DIM, INDEX_CLUSTERS)
    return stored_index.search(spark, stored_index.open_index(spark, path), _label_queries(vectors))


@_query
def knn_filtered_indexed(spark, folder):
    """News of one ticker nearest to the mean of every label; clusters without any are not read."""
    vectors = sample_tables.vector_index(spark, folder)
    index = stored_index.build(vectors, fresh_path(spark, "stored-index"), SAMPLE_DIM, INDEX_CLUSTERS)
    return stored_index.search(spark, index, _label_queries(vectors), doc_type=corpus.NEWS, ticker=ONE_TICKER.lower())


def _every_twentieth(spark, folder) -> tuple[DataFrame, DataFrame]:
    """All vectors, and as queries those whose id is divisible by 20."""
    vectors = sample_tables.vector_index(spark, folder)
    chosen = vectors.filter(F.col("doc_id") % 20 == 0)
    return vectors, chosen.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))


@_query
def knn_lsh(spark, folder):
    vectors, asked = _every_twentieth(spark, folder)
    return lsh.knn_lsh(lsh.build(vectors, SAMPLE_DIM), asked)


@_query
def knn_lsh_recall(spark, folder):
    """Whether the approximate search finds nine in ten of what the full search finds."""
    vectors, asked = _every_twentieth(spark, folder)
    found = lsh.knn_lsh(lsh.build(vectors, SAMPLE_DIM), asked)
    measured = lsh.recall(found, search.top_k(vectors, asked))
    return measured.select("queries", "wanted", (F.col("hits") >= 0.9 * F.col("wanted")).alias("recall_reached"))


@_query
def knn_many_queries(spark, folder):
    """Every vector of the index as a query."""
    index = sample_tables.vector_index(spark, folder)
    queries = index.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return search.top_k(index, queries, k=3)


@_query
def knn_by_type(spark, folder):
    index = sample_tables.vector_index(spark, folder)
    profiles = index.filter(search.search_filter(doc_type=corpus.COMPANY_PROFILE))
    return search.top_k_documents(profiles, _label_queries(index), ["doc_type", "ticker"])


@_query
def knn_filtered(spark, folder):
    """Both filters: per ticker, its news nearest to the mean of the ticker."""
    index = sample_tables.vector_index(spark, folder)
    queries = sample_tables.mean_vectors(index, "ticker").withColumnRenamed("query_id", "ticker")
    news = index.filter(search.search_filter(doc_type=corpus.NEWS))
    return search.top_k_per_ticker(news, queries, SAMPLE_DIM)


@_query
def knn_by_ticker(spark, folder):
    """Per ticker, its documents nearest to the mean of the ticker."""
    index = sample_tables.vector_index(spark, folder)
    queries = sample_tables.mean_vectors(index, "ticker").withColumnRenamed("query_id", "ticker")
    return search.top_k_per_ticker(index, queries, SAMPLE_DIM)


def _questions(spark, folder) -> DataFrame:
    return sample_tables.table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@_query
def semantic_search(spark, folder):
    index = _text_index(spark, folder)
    found = search.semantic_search(index, _questions(spark, folder), ENCODER, DIM)
    return found.select("query_id", "rank", "score", "doc_id", "doc_type", "ticker", "title", "text")


@_query
def semantic_search_indexed(spark, folder):
    """The same as `semantic_search`, from a clustered index of the texts."""
    path = fresh_path(spark, "text-index")
    index = vector_index.build_index(_text_index(spark, folder), path, DIM, INDEX_CLUSTERS)
    found = search.semantic_search_indexed(spark, index, _questions(spark, folder), ENCODER, DIM)
    return found.select("query_id", "rank", "score", "doc_id", "doc_type", "ticker", "title", "text")


def _corpus_feed(spark, folder) -> DataFrame:
    """Two commits: the earlier corpus, and what leads from it to the whole."""

    def unique(documents: DataFrame) -> DataFrame:
        return materialize(corpus.unique_documents(corpus.with_text_hash(documents)), "snapshot")

    earlier, whole = unique(_earlier_corpus(spark, folder)), unique(_corpus(spark, folder))
    commits = [
        changefeed.committed(changefeed.snapshot_diff(old, new, ["doc_id"]), version, at)
        for version, (old, new, at) in enumerate(((earlier.limit(0), earlier, EVENTS_HALFWAY), (earlier, whole, EVENTS_AS_OF)), 1)
    ]
    return commits[0].unionByName(commits[1])


@_query
def index_from_feed(spark, folder):
    """The same as `semantic_search`, from a stored index that took up two commits of a feed."""
    path = fresh_path(spark, "fed-index")
    feed = materialize(_corpus_feed(spark, folder), "corpus-feed")
    for version in (1, 2):
        medallion.feed_index(spark, path, feed.filter(F.col("_commit_version") <= version), ENCODER, DIM, INDEX_CLUSTERS)
    index = stored_index.open_index(spark, path)
    found = stored_index.semantic_search(spark, index, _questions(spark, folder), ENCODER)
    return found.select("query_id", "rank", "score", "doc_id", "doc_type", "ticker", "title", "text")


@_query
def search_results(spark, folder):
    found = search.semantic_search(_text_index(spark, folder), _questions(spark, folder), ENCODER, DIM)
    shown = search.as_results(found)
    return shown.select("query_id", "rank", "score", "ticker", "title", "text", "date", "doc_type")


@_query
def search_news(spark, folder):
    index = _text_index(spark, folder)
    found = search.search_news(index, _questions(spark, folder), ENCODER, DIM)
    return found.select("query_id", "rank", "score", "doc_id", "ticker", "title", "snippet")


@_query
def search_news_of_ticker(spark, folder):
    index = _text_index(spark, folder)
    found = search.search_news(index, _questions(spark, folder), ENCODER, DIM, ticker=NOTES_TICKER.lower())
    return found.select("query_id", "rank", "score", "doc_id", "ticker", "title", "snippet")


@_query
def search_profiles(spark, folder):
    index = _text_index(spark, folder)
    found = search.search_profiles(index, _questions(spark, folder), ENCODER, DIM)
    return found.select("query_id", "rank", "score", "doc_id", "ticker", "title", "snippet")


@_query
def news_for_ticker(spark, folder):
    index = _text_index(spark, folder)
    found = search.ticker_panel(index, sample_tables.tickers(spark, folder), ENCODER, DIM)
    return found.select("ticker", "rank", "score", "doc_id", "doc_type", "title", "text", "date")


# Watchlists and notes ---------------------------------------------------------------------


def _relations(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        sample_tables.users(spark, folder),
        sample_tables.watchlists(spark, folder),
        sample_tables.watchlist_tickers(spark, folder),
    )


def _added(spark, folder) -> watchlists.Added:
    return watchlists.add_to_watchlists(
        *_relations(spark, folder), sample_tables.add_requests(spark, folder)
    )


def _removed(spark, folder) -> watchlists.Removed:
    return watchlists.remove_from_watchlists(
        *_relations(spark, folder), sample_tables.remove_requests(spark, folder)
    )


@_query
def watchlist_get(spark, folder):
    return watchlists.get_watchlists(*_relations(spark, folder))


@_query
def watchlist_of_user(spark, folder):
    return watchlists.get_watchlists(*_relations(spark, folder), email=ONE_EMAIL, list_name="1-URGENT")


@_query
def watchlist_users(spark, folder):
    users = sample_tables.users(spark, folder)
    return watchlists.ensure_users(users, sample_tables.add_requests(spark, folder)).users


@_query
def watchlist_get_or_create(spark, folder):
    users, lists, _ = _relations(spark, folder)
    requests = sample_tables.add_requests(spark, folder).withColumn(
        "name", F.coalesce("list_name", F.lit(watchlists.DEFAULT_LIST))
    )
    accounts = watchlists.ensure_users(users, requests)
    return watchlists.get_or_create_lists(lists, requests.join(accounts.requested, "email")).requested


@_query
def watchlist_add(spark, folder):
    return _added(spark, folder).tickers


@_query
def watchlist_added_rows(spark, folder):
    return _added(spark, folder).new


@_query
def watchlist_remove(spark, folder):
    return _removed(spark, folder).outcomes


@_query
def watchlist_after_remove(spark, folder):
    return _removed(spark, folder).tickers


def _watchlist_store(spark, folder) -> WatchlistStore:
    database = f"watchlists_{uuid.uuid4().hex}"
    tables.create_database(spark, database, fresh_path(spark, "watchlists"))
    store = WatchlistStore.of(database)
    store.load(*_relations(spark, folder))
    return store


@_query
def watchlist_store_add(spark, folder):
    """All lists after a batch of additions that was appended to bucketed tables."""
    store = _watchlist_store(spark, folder)
    store.add(materialize(sample_tables.add_requests(spark, folder), "requests"), 1)
    return store.listed(spark).select("email", "list_name", "ticker", "added_at")


@_query
def watchlist_store_remove(spark, folder):
    """All lists after a batch of removals that was appended to bucketed tables."""
    store = _watchlist_store(spark, folder)
    store.remove(materialize(sample_tables.remove_requests(spark, folder), "requests"), 1)
    return store.listed(spark).select("email", "list_name", "ticker", "added_at")


@_query
def watchlist_mutation_log(spark, folder):
    """What a batch of additions and a batch of removals log."""
    added = watchlists.mutation_log(_added(spark, folder).new, watchlists.ADD, "added_at", "agent")
    removed = watchlists.mutation_log(_removed(spark, folder).gone, watchlists.REMOVE, "requested_at", "app")
    return added.unionByName(removed)


@_query
def watchlist_replay(spark, folder):
    return watchlists.replay(sample_tables.watchlist_log(spark, folder), ["ts", "event_id"])


@_query
def notes_save(spark, folder):
    saved = notes.save_notes(
        sample_tables.users(spark, folder),
        sample_tables.research_notes(spark, folder),
        sample_tables.note_requests(spark, folder),
    )
    return saved.notes


@_query
def notes_get(spark, folder):
    return notes.get_notes(sample_tables.users(spark, folder), sample_tables.research_notes(spark, folder))


@_query
def notes_of_user(spark, folder):
    return notes.get_notes(
        sample_tables.users(spark, folder),
        sample_tables.research_notes(spark, folder),
        email=ONE_EMAIL,
        ticker=NOTES_TICKER.lower(),
        limit=3,
    )


# Feeds and usage --------------------------------------------------------------------------


@_query
def cdf_read(spark, folder):
    return changefeed.read_changes(sample_tables.tool_call_feed(spark, folder), as_of=EVENTS_AS_OF)


@_query
def snapshot_diff(spark, folder):
    """Changes between the watchlists at the halfway time and at the end of the log."""
    log = sample_tables.watchlist_log(spark, folder)
    earlier = log.filter(F.col("ts") < moment(EVENTS_HALFWAY))
    order = ["ts", "event_id"]
    return changefeed.snapshot_diff(
        watchlists.replay(earlier, order), watchlists.replay(log, order), ["email", "list_name", "ticker"]
    )


@_query
def tool_calls_hourly(spark, folder):
    return usage.tool_calls_hourly(sample_tables.tool_call_feed(spark, folder))


@_query
def watchlist_daily(spark, folder):
    return usage.watchlist_daily(sample_tables.watchlist_feed(spark, folder))


def _daily_stats(spark, folder) -> DataFrame:
    return usage.daily_usage_stats(
        sample_tables.tool_call_feed(spark, folder), sample_tables.watchlist_feed(spark, folder)
    )


@_query
def daily_usage_stats(spark, folder):
    return _daily_stats(spark, folder)


@_query
def usage_last_7_days(spark, folder):
    return usage.usage_last_days(_daily_stats(spark, folder), EVENTS_AS_OF.date())


def _commit_half(
    spark, folder, paths: UsagePaths, first: bool, feeds=("calls", "mutations"), keep: Column | None = None
) -> None:
    halfway = F.col("_commit_timestamp") < moment(EVENTS_HALFWAY)
    chosen = keep if keep is not None else halfway if first else ~halfway
    sources = {
        "calls": (paths.calls, sample_tables.tool_call_feed),
        "mutations": (paths.mutations, sample_tables.watchlist_feed),
    }
    for name in feeds:
        path, feed = sources[name]
        changefeed.write_feed(feed(spark, folder).filter(chosen), path, "timestamp")


def _usage_paths(spark) -> UsagePaths:
    root = fresh_path(spark, "usage")
    return UsagePaths(f"{root}/calls", f"{root}/mutations", f"{root}/rollups")


@_query
def usage_incremental(spark, folder):
    """Two scheduled runs, the second over the later half of the commits."""
    paths = _usage_paths(spark)
    for first in (True, False):
        _commit_half(spark, folder, paths, first)
        run_usage_rollup(spark, paths)
    return read_daily_stats(spark, paths)


@_query
def usage_lagging_feed(spark, folder):
    """Mutations arrive a run later than the calls of the same time."""
    paths = _usage_paths(spark)
    _commit_half(spark, folder, paths, True, feeds=("mutations",), keep=F.lit(False))
    for first in (True, False):
        _commit_half(spark, folder, paths, first, feeds=("calls",))
        run_usage_rollup(spark, paths)
        _commit_half(spark, folder, paths, first, feeds=("mutations",))
    run_usage_rollup(spark, paths)
    return read_daily_stats(spark, paths)


@_query
def usage_stream(spark, folder):
    """The same two halves, taken up by two runs of the stream."""
    paths = _usage_paths(spark)
    for first in (True, False):
        _commit_half(spark, folder, paths, first)
        start_usage_stream(spark, paths, f"{paths.rollups}/_progress").awaitTermination()
    return read_daily_stats(spark, paths)


def _delta_runs(spark, folder) -> UsagePaths:
    """Both halves of the feeds taken up by deltas, and compacted in between."""
    paths = _usage_paths(spark)
    for first in (True, False):
        _commit_half(spark, folder, paths, first)
        usage_deltas.run_usage_deltas(spark, paths)
        if first:
            usage_deltas.compact(spark, paths)
    return paths


@_query
def usage_by_deltas(spark, folder):
    """The same as `usage_incremental`, from parts of the new commits alone."""
    return read_daily_stats(spark, _delta_runs(spark, folder))


@_query
def tool_calls_hourly_by_deltas(spark, folder):
    return usage_deltas.hourly_stats(spark, _delta_runs(spark, folder))


@_query
def watchlist_daily_by_deltas(spark, folder):
    return usage_deltas.watchlist_stats(spark, _delta_runs(spark, folder))


@_query
def usage_distinct(spark, folder):
    """Distinct users, tickers and pairs per day and over all days, counted, and whether the
    estimate from united sketches lies within four times its standard error."""
    paths = _delta_runs(spark, folder)
    calls = sample_tables.tool_call_feed(spark, folder)
    calls = calls.filter(F.col("_change_type").isin(*changefeed.CURRENT_ROWS)).withColumn("date", F.to_date("timestamp"))
    names = ("users", "tickers", "pairs")

    def day(date: Column | str) -> Column:
        return F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("all")).alias("period")

    facts = calls.select("date", F.col("user_id").alias("u"), F.col("ticker").alias("t")).distinct()
    pair = F.when(F.col("t").isNotNull(), F.struct("u", "t"))
    counts = [F.count_distinct("u").alias("users"), F.count_distinct("t").alias("tickers"), F.count_distinct(pair).alias("pairs")]
    exact = facts.rollup("date").agg(*counts).withColumn("period", day("date")).drop("date")
    daily = usage_deltas.distinct_counts(spark, paths, "date").withColumn("period", day("date")).drop("date")
    whole = usage_deltas.distinct_counts(spark, paths, F.lit("all").alias("period"))
    estimated = daily.unionByName(whole).select("period", *[F.col(n).alias(f"about_{n}") for n in names])
    close = [
        (F.abs(F.col(f"about_{n}") - F.col(n)) <= 1 + 4 * usage.SKETCH_ERROR * F.col(n)).alias(f"{n}_close") for n in names
    ]
    return exact.join(estimated, "period", "left").select("period", *names, *close)


@_query
def usage_freshness(spark, folder):
    """How far the rollup is filled."""
    mark = usage.high_water_mark(_daily_stats(spark, folder))
    return spark.createDataFrame([(mark,)], "filled_until string")


@_query
def tool_calls_hourly_windowed(spark, folder):
    """Both halves of the calls taken up by two runs of the stream with state; what is more than a
    day behind comes in on its own."""
    paths = _usage_paths(spark)
    for first in (True, False):
        _commit_half(spark, folder, paths, first, feeds=("calls",))
        for query in usage_windows.start_window_stream(spark, paths, f"{paths.rollups}/_window_progress"):
            query.awaitTermination()
    return usage_windows.hourly_stats(spark, paths)


# Chat -------------------------------------------------------------------------------------


@_query
def chat_route(spark, folder):
    return routing.route_messages(sample_tables.chat_messages(spark, folder))


@_query
def chat_search(spark, folder):
    """The answers to all search messages."""
    routed = routing.route_messages(sample_tables.chat_messages(spark, folder))
    questions = routed.filter(F.col("intent") == "search").select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("query").alias("text"),
    )
    found = search.answer_chat(_text_index(spark, folder), questions, ENCODER, DIM)
    return found.select("query_id", "rank", "score", "doc_id", "ticker", "title", "snippet")


@_query
def chat_intents(spark, folder):
    return routing.intent_counts(routing.route_messages(sample_tables.chat_messages(spark, folder)))


@_query
def chat_prices(spark, folder):
    """The answers to all price messages, whose tickers are short names of the companies."""
    routed = routing.route_messages(sample_tables.chat_messages(spark, folder))
    quotes = prices.price_quote(_newest_bars(spark, folder), _companies(spark, folder))
    short = F.concat(F.lit("T"), F.right("ticker", F.lit(9)).cast("int").cast("string"))
    answers = routing.answer_prices(routed, quotes.withColumn("ticker", short))
    return answers.select("conv_id", "turn", "ticker", "name", "price", "change", "change_pct", "volume")


# Jobs -------------------------------------------------------------------------------------


@_query
def etl_written_rows(spark, folder):
    """What the ETL job reports to have written, table by table."""
    database = f"etl_{uuid.uuid4().hex}"
    tables.create_database(spark, database, fresh_path(spark, "etl"))
    landed = medallion.Landed(
        sample_tables.landed_prices(spark, folder),
        sample_tables.landed_companies(spark, folder),
        sample_tables.landed_news(spark, folder),
    )
    written = medallion.run_medallion(
        spark, database, landed, LOADED_AT, price_order=sample_tables.BAR_ORDER, company_order=("landing",)
    )
    spark.sql(f"DROP DATABASE {database} CASCADE")
    rows = [(name, count) for name, count in written.items() if name != "quarantine"]
    return spark.createDataFrame(rows, "table_name string, rows long")
