"""ANSI SQL for the registered queries, over the same sample tables.

Each statement is a final SELECT; the common table expressions it names are put in front.
"""

from __future__ import annotations

import re

from marketlake.functions.text import BLANK

_DIM = 64

_TABLES: dict[str, str] = {}
_STATEMENTS: dict[str, str] = {}


# Landing and silver -----------------------------------------------------------------------

_TABLES["landed_prices"] = """
SELECT upper(s_name) AS ticker, strftime(l_shipdate, '%Y-%m-%d') AS "date",
       l_extendedprice - l_quantity AS open, l_extendedprice + l_linenumber AS high,
       l_extendedprice - l_quantity - l_linenumber AS low, l_extendedprice AS close,
       CAST(l_quantity AS BIGINT) AS volume, l_orderkey, l_linenumber, l_partkey
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""

_TABLES["silver_prices_t"] = """
SELECT ticker, CAST("date" AS DATE) AS snapshot_date,
       CAST(CAST(open AS DECIMAL(12,4)) AS DOUBLE) AS open_price,
       CAST(CAST(close AS DECIMAL(12,4)) AS DOUBLE) AS close_price,
       CAST(CAST(high AS DECIMAL(12,4)) AS DOUBLE) AS high_price,
       CAST(CAST(low AS DECIMAL(12,4)) AS DOUBLE) AS low_price, volume
FROM landed_prices
QUALIFY row_number() OVER (
  PARTITION BY ticker, "date"
  ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
           close DESC, volume DESC, open DESC, high DESC, low DESC) = 1"""

_TABLES["profiles_t"] = """
SELECT upper(s_name) AS ticker, 'Company ' || s_suppkey AS name,
       coalesce(CASE WHEN s_acctbal >= 0 THEN r_name END, 'Unknown') AS sector,
       CASE WHEN landing = 2 THEN n_name ELSE 'Unknown' END AS industry,
       CASE WHEN landing = 2 THEN CAST(floor(s_acctbal) AS BIGINT) * 1000000 ELSE 0 END AS "marketCap",
       CASE WHEN landing = 2 THEN 'Supplier in ' || n_name ELSE '' END AS description,
       '' AS website, s_suppkey AS employees, n_name AS country, 'USD' AS currency,
       CASE WHEN s_acctbal >= 0 THEN round(s_acctbal / 100, 2) END AS "trailingPE",
       CAST(NULL AS DOUBLE) AS "forwardPE", s_nationkey / 1000 AS "dividendYield", landing
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
     (VALUES (1), (2)) AS landings(landing)"""

_TABLES["companies_t"] = """
SELECT ticker, name AS company_name, sector, industry, "marketCap" AS market_cap,
       description AS company_description, TIMESTAMP '2001-11-05 00:00:00' AS updated_at
FROM profiles_t WHERE landing = 2"""

_TABLES["bronze_news_t"] = """
SELECT 'SUPPLIER#' || lpad(CAST(doc_id % 10 AS VARCHAR), 9, '0') AS ticker,
       split_part(text, chr(10), 1) AS title, source, 1704067200 + 3600 * doc_id AS "publishedAt",
       'https://news.example/' || doc_id AS url, split_part(text, chr(10), 1) AS summary,
       text AS content
FROM documents"""

_TABLES["news_t"] = """
SELECT ticker, title, source,
       TIMESTAMP '1970-01-01 00:00:00' + to_seconds("publishedAt") AS published_at,
       url, summary, content AS full_text, TIMESTAMP '2001-11-05 00:00:00' AS ingested_at
FROM bronze_news_t"""

_STATEMENTS["bronze_prices"] = """
SELECT ticker, "date", open, high, low, close, volume FROM landed_prices
WHERE "date" >= '2000-11-04' AND "date" < '2001-11-04'"""

_STATEMENTS["bronze_companies"] = "SELECT * FROM profiles_t"

_STATEMENTS["bronze_news"] = """
SELECT * FROM bronze_news_t
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY "publishedAt" DESC, url, title) <= 50"""

_STATEMENTS["ingest_report"] = """
SELECT l.source, upper(s_name) AS ticker, coalesce(n, 0) AS "rows",
       CASE WHEN n IS NULL THEN 'missing' ELSE 'ok' END AS status
FROM supplier CROSS JOIN (VALUES ('prices'), ('companies'), ('news')) AS l(source)
LEFT JOIN (
  SELECT 'prices' AS source, ticker, count(*) AS n FROM landed_prices GROUP BY ticker
  UNION ALL SELECT 'companies', ticker, count(*) FROM profiles_t GROUP BY ticker
  UNION ALL SELECT 'news', ticker, count(*) FROM bronze_news_t GROUP BY ticker
) AS r ON r.source = l.source AND r.ticker = upper(s_name)"""

_STATEMENTS["table_profile"] = """
SELECT 'silver_prices' AS table_name, (SELECT count(*) FROM silver_prices_t) AS row_count, c.*
FROM (VALUES (1, 'ticker', 'string'), (2, 'snapshot_date', 'date'),
             (3, 'open_price', 'decimal(12,4)'), (4, 'close_price', 'decimal(12,4)'),
             (5, 'high_price', 'decimal(12,4)'), (6, 'low_price', 'decimal(12,4)'),
             (7, 'volume', 'bigint')) AS c(position, column_name, data_type)
UNION ALL
SELECT 'silver_companies', (SELECT count(*) FROM companies_t), c.*
FROM (VALUES (1, 'ticker', 'string'), (2, 'company_name', 'string'), (3, 'sector', 'string'),
             (4, 'industry', 'string'), (5, 'market_cap', 'bigint'),
             (6, 'company_description', 'string'), (7, 'updated_at', 'timestamp'))
     AS c(position, column_name, data_type)
UNION ALL
SELECT 'silver_news', (SELECT count(*) FROM news_t), c.*
FROM (VALUES (1, 'ticker', 'string'), (2, 'title', 'string'), (3, 'source', 'string'),
             (4, 'published_at', 'timestamp'), (5, 'url', 'string'), (6, 'summary', 'string'),
             (7, 'full_text', 'string'), (8, 'ingested_at', 'timestamp'))
     AS c(position, column_name, data_type)"""

_STATEMENTS["silver_prices"] = "SELECT * FROM silver_prices_t"
_STATEMENTS["silver_companies"] = "SELECT * FROM companies_t"
_STATEMENTS["silver_news"] = "SELECT * FROM news_t"


# Prices -----------------------------------------------------------------------------------

_TABLES["newest_two"] = """
SELECT ticker, max(snapshot_date) AS price_date,
       max(close_price) FILTER (WHERE place = 1) AS price,
       max(close_price) FILTER (WHERE place = 2) AS previous_close,
       max(high_price) FILTER (WHERE place = 1) AS day_high,
       max(low_price) FILTER (WHERE place = 1) AS day_low,
       max(volume) FILTER (WHERE place = 1) AS volume
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) AS place
      FROM silver_prices_t)
WHERE place <= 2 GROUP BY ticker"""

_TABLES["quotes"] = """
SELECT q.*, company_name, coalesce(market_cap, 0) AS market_cap,
       CASE WHEN price IS NOT NULL AND previous_close <> 0
            THEN round(price - previous_close, 4) + 0.0 ELSE 0.0 END AS change,
       CASE WHEN price IS NOT NULL AND previous_close <> 0
            THEN round((price - previous_close) * 100 / previous_close, 4) + 0.0 ELSE 0.0 END AS change_pct
FROM newest_two AS q LEFT JOIN companies_t USING (ticker)"""

_STATEMENTS["price_history"] = """
SELECT ticker, snapshot_date AS "date", open_price AS open, high_price AS high, low_price AS low,
       close_price AS close, volume
FROM silver_prices_t
WHERE snapshot_date >= DATE '2001-11-04' - 90 AND snapshot_date < DATE '2001-11-04'
ORDER BY ticker, "date" """

_STATEMENTS["price_quote"] = """
SELECT ticker, coalesce(company_name, ticker) AS name, price_date, price, previous_close,
       change, change_pct, volume, market_cap
FROM quotes"""

_STATEMENTS["quote_from_snapshot"] = """
SELECT ticker, name, price, previous_close, volume, day_high, day_low, market_cap,
       coalesce(own, CASE WHEN known THEN round(price - previous_close, 4) + 0.0 ELSE 0.0 END) AS change,
       coalesce(own_pct, CASE WHEN known THEN round((price - previous_close) * 100 / previous_close, 4) + 0.0
                         ELSE 0.0 END) AS change_pct
FROM (
  SELECT *, price IS NOT NULL AND previous_close IS NOT NULL AND previous_close <> 0 AS known FROM (
    SELECT upper(s_name) AS ticker, CASE WHEN s_suppkey % 3 <> 0 THEN 'Company ' || s_suppkey ELSE upper(s_name) END AS name,
           CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal ELSE s_acctbal + 1 END AS price,
           CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal - s_nationkey END AS previous_close,
           CAST(s_suppkey AS BIGINT) AS volume, 0.0::DOUBLE AS day_high, s_acctbal AS day_low, 0::BIGINT AS market_cap,
           CASE WHEN s_suppkey % 2 = 0 THEN 1.5::DOUBLE END AS own,
           CASE WHEN s_suppkey % 2 = 0 THEN 0.25::DOUBLE END AS own_pct
    FROM supplier))"""

_STATEMENTS["price_history_of_ticker"] = _STATEMENTS["price_history"].replace(
    "WHERE", "WHERE ticker = 'SUPPLIER#000000003' AND"
)

_STATEMENTS["dashboard_quote"] = """
SELECT ticker, coalesce(price, 0) AS price, change, change_pct, coalesce(volume, 0) AS volume,
       coalesce(day_high, 0) AS day_high, coalesce(day_low, 0) AS day_low, market_cap
FROM quotes"""


def _period_summary(months: int) -> str:
    return f"""
SELECT ticker, min(snapshot_date) AS from_date, max(snapshot_date) AS to_date, count(*) AS bars,
       arg_min(close_price, snapshot_date) AS start_price,
       arg_max(close_price, snapshot_date) AS end_price,
       max(high_price) AS high, min(low_price) AS low, round(avg(volume), 4) AS avg_volume,
       round((arg_max(close_price, snapshot_date) - arg_min(close_price, snapshot_date)) * 100
             / arg_min(close_price, snapshot_date), 4) + 0.0 AS change_pct
FROM silver_prices_t
WHERE snapshot_date >= DATE '2001-11-04' - INTERVAL {months} MONTH AND snapshot_date <= DATE '2001-11-04'
GROUP BY ticker"""


def _comparison(months: int) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY change_pct DESC, ticker) AS rank, ticker, price, change_pct,
       coalesce(market_cap, 0) AS market_cap
FROM (
  SELECT ticker, arg_max(close_price, snapshot_date) AS price,
         round((arg_max(close_price, snapshot_date) - arg_min(close_price, snapshot_date)) * 100
               / arg_min(close_price, snapshot_date), 4) + 0.0 AS change_pct
  FROM silver_prices_t
  WHERE snapshot_date >= DATE '2001-11-04' - INTERVAL {months} MONTH
    AND snapshot_date <= DATE '2001-11-04'
  GROUP BY ticker) LEFT JOIN companies_t USING (ticker)
ORDER BY rank"""


_STATEMENTS["price_period_summary"] = _period_summary(1)
_STATEMENTS["price_period_summary_90_days"] = _period_summary(3)
_STATEMENTS["price_period_summary_180_days"] = _period_summary(6)
_STATEMENTS["compare_tickers"] = _comparison(1)
_STATEMENTS["compare_tickers_90_days"] = _comparison(3)
_ASKED = "(VALUES ('SUPPLIER#000000007', 0), ('SUPPLIER#000000002', 1), ('SUPPLIER#000000003', 2)) AS asked(ticker, place)"
_STATEMENTS["compare_listed_tickers"] = f"""
SELECT row_number() OVER (ORDER BY change_pct DESC, place) AS rank, ticker, price, change_pct, market_cap
FROM ({_comparison(1)}) JOIN {_ASKED} USING (ticker)"""

_STATEMENTS["company_fundamentals"] = """
SELECT ticker, name, sector, industry, employees, "marketCap" AS market_cap,
       "trailingPE" AS trailing_pe, "forwardPE" AS forward_pe,
       round("dividendYield" * 100, 4) AS dividend_yield_pct,
       high_52_weeks, low_52_weeks, substr(description, 1, 500) AS description
FROM profiles_t LEFT JOIN (
  SELECT ticker, max(high_price) AS high_52_weeks, min(low_price) AS low_52_weeks
  FROM silver_prices_t
  WHERE snapshot_date >= DATE '2001-11-04' - 364 AND snapshot_date <= DATE '2001-11-04'
  GROUP BY ticker) USING (ticker)
WHERE landing = 2"""


_STATEMENTS["price_range_summary"] = """
SELECT request_id, ticker, min(snapshot_date) AS from_date, max(snapshot_date) AS to_date, count(*) AS bars,
       arg_min(close_price, snapshot_date) AS start_price, arg_max(close_price, snapshot_date) AS end_price,
       max(high_price) AS high, min(low_price) AS low, round(avg(volume), 4) AS avg_volume,
       CASE WHEN arg_min(close_price, snapshot_date) <> 0 THEN
         round((arg_max(close_price, snapshot_date) - arg_min(close_price, snapshot_date)) * 100
               / arg_min(close_price, snapshot_date), 4) + 0.0 END AS change_pct
FROM (SELECT *, since + CAST(request_id * 7 % 800 AS INT) AS until
      FROM (SELECT o_orderkey AS request_id, 'SUPPLIER#' || lpad(CAST(o_orderkey % 10 + 1 AS VARCHAR), 9, '0') AS ticker,
                   CAST(o_orderdate AS DATE) - CAST(o_orderkey % 40 AS INT) AS since FROM orders))
JOIN silver_prices_t USING (ticker)
WHERE snapshot_date >= since AND snapshot_date < until
GROUP BY request_id, ticker"""


# Corpus, embedding, search ----------------------------------------------------------------


def _corpus(news: str, description: str) -> str:
    return f"""
SELECT ticker || ' | ' || title AS doc_id, 'news' AS doc_type, ticker, title,
       concat_ws(chr(10) || chr(10), title, summary, full_text) AS text,
       CAST(published_at AS VARCHAR) AS metadata_date, source AS metadata_source
FROM news_t WHERE {news}
UNION ALL
SELECT ticker, 'company_profile', ticker, company_name,
       concat_ws(chr(10) || chr(10), company_name, 'Sector: ' || sector, 'Industry: ' || industry,
                 {description}),
       CAST(updated_at AS VARCHAR), 'Company Profile'
FROM companies_t"""


_TABLES["corpus_t"] = _corpus("true", "company_description")
_TABLES["earlier_corpus"] = _corpus("published_at < TIMESTAMP '2024-01-16 00:00:00'", "NULL")

_NEWEST = """
QUALIFY row_number() OVER (
  PARTITION BY doc_id ORDER BY metadata_date DESC, md5(text) DESC, metadata_source DESC) = 1"""
_TABLES["unique_docs"] = "SELECT * FROM corpus_t" + _NEWEST
_TABLES["earlier_docs"] = "SELECT * FROM earlier_corpus" + _NEWEST


def _encoded(texts: str, key: str) -> str:
    """Unit vectors of hashed words, as (key, place, value) for the places that are not 0."""
    return f"""
SELECT {key}, place, CAST(CAST(weight / sqrt(sum(weight * weight) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS value
FROM (
  SELECT {key}, CAST('0x' || substr(hash, 1, 8) AS BIGINT) % {_DIM} AS place,
         CAST(sum(CASE WHEN substr(hash, 9, 1) < '8' THEN 1 ELSE -1 END) AS DOUBLE) AS weight
  FROM (SELECT {key}, md5(unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+'))) AS hash
        FROM {texts})
  GROUP BY 1, 2)
WHERE weight <> 0"""


def _spelled(vectors: str, key: str, documents: str) -> str:
    """One text per vector: its values in millionths, in order."""
    return f"""
SELECT {key}, string_agg(CAST(CAST(round(coalesce(value, 0) * 1000000) AS BIGINT) AS VARCHAR), ','
                         ORDER BY place) AS vector
FROM (SELECT {key}, unnest(range({_DIM})) AS place FROM {documents})
LEFT JOIN {vectors} USING ({key}, place)
GROUP BY {key}"""


_TABLES["doc_vectors"] = _encoded("unique_docs", "doc_id")
_TABLES["doc_spelled"] = _spelled("doc_vectors", "doc_id", "unique_docs")

_STATEMENTS["text_corpus"] = "SELECT * FROM corpus_t"
_STATEMENTS["corpus_counts"] = "SELECT doc_type, count(*) AS documents FROM corpus_t GROUP BY doc_type"

_STATEMENTS["corpus_sentence"] = """
SELECT ticker, company_name AS title,
       concat_ws(' ', company_name || '.', 'Sector: ' || sector || '.', 'Industry: ' || industry || '.',
                 company_description) AS text,
       '2024-01-01' AS "date", 'company_profile' AS doc_type
FROM companies_t
UNION ALL
SELECT ticker, title, concat_ws(' ', title || '.', summary, full_text),
       strftime(published_at, '%Y-%m-%d'), 'news_article'
FROM news_t"""

_STATEMENTS["embed_corpus"] = """
SELECT doc_id, doc_type, ticker, doc_id IN (SELECT doc_id FROM doc_vectors) AS embed_ok, vector
FROM unique_docs JOIN doc_spelled USING (doc_id)"""

_STATEMENTS["embed_failures"] = """
SELECT doc_id, 'ValueError: refused' AS error, 2 AS tries, false AS embed_ok
FROM unique_docs WHERE text <> '' AND length(text) % 41 = 0"""

_TABLES["clipped_docs"] = "SELECT * REPLACE (substr(text, 1, 8000) AS text) FROM unique_docs"
_TABLES["clipped_vectors"] = _encoded("clipped_docs", "doc_id")
_STATEMENTS["embed_clipped"] = _spelled("clipped_vectors", "doc_id", "clipped_docs")

_STATEMENTS["corpus_embeddable"] = """
SELECT doc_id, doc_type, length(text) AS chars FROM corpus_t WHERE text <> ''"""

_STATEMENTS["index_refresh"] = """
SELECT doc_id, doc_type, ticker, metadata_date, metadata_source,
       doc_id IN (SELECT doc_id FROM doc_vectors) AS embed_ok, vector
FROM unique_docs JOIN doc_spelled USING (doc_id)"""
_STATEMENTS["index_retry"] = _STATEMENTS["index_refresh"]

_STATEMENTS["embed_incremental"] = """
SELECT d.doc_id, md5(d.text) AS text_hash, vector
FROM unique_docs AS d JOIN doc_spelled USING (doc_id)
WHERE NOT EXISTS (SELECT 1 FROM earlier_docs AS e WHERE e.doc_id = d.doc_id AND e.text = d.text)"""

_TABLES["vector_index"] = """
SELECT vec_id AS doc_id, CASE WHEN label < 5 THEN 'news' ELSE 'company_profile' END AS doc_type,
       'SUPPLIER#' || lpad(CAST(vec_id % 10 AS VARCHAR), 9, '0') AS ticker, label,
       CAST(embedding AS DOUBLE[]) AS embedding
FROM embeddings"""


def _means(key: str) -> str:
    return f"""
SELECT {key} AS query_id, list(mean ORDER BY place) AS query_vector
FROM (SELECT {key}, place, avg(value) AS mean
      FROM (SELECT {key}, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS place
            FROM vector_index)
      GROUP BY {key}, place)
GROUP BY {key}"""


_TABLES["overall_query"] = """
SELECT 0 AS query_id, list(mean ORDER BY place) AS query_vector
FROM (SELECT place, avg(value) AS mean
      FROM (SELECT unnest(embedding) AS value, generate_subscripts(embedding, 1) AS place
            FROM vector_index)
      GROUP BY place)"""
_TABLES["label_queries"] = _means("label")
_TABLES["ticker_queries"] = _means("ticker")

_COSINE = "round(list_cosine_similarity(embedding, query_vector), 6) + 0.0"


def _nearest(queries: str, where: str = "true") -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, doc_id) AS rank
FROM (SELECT query_id, doc_id, doc_type, ticker, {_COSINE} AS score
      FROM vector_index CROSS JOIN {queries} WHERE {where})
QUALIFY rank <= 5"""


_STATEMENTS["knn_topk"] = f"SELECT doc_id, score, rank FROM ({_nearest('overall_query')})"
_STATEMENTS["knn_batch"] = f"SELECT query_id, doc_id, score, rank FROM ({_nearest('label_queries')})"
_STATEMENTS["knn_indexed"] = _STATEMENTS["knn_batch"]
_STATEMENTS["index_reopened"] = _STATEMENTS["knn_batch"]
_STATEMENTS["knn_filtered_indexed"] = f"""
SELECT query_id, doc_id, score, rank
FROM ({_nearest('label_queries', "doc_type = 'news' AND ticker = 'SUPPLIER#000000003'")})"""
_STATEMENTS["knn_lsh_recall"] = """
SELECT count(*) AS queries, CAST(sum(least(5, n)) AS BIGINT) AS wanted, true AS recall_reached
FROM vector_index, (SELECT count(*) AS n FROM vector_index) WHERE doc_id % 20 = 0"""
_TABLES["vector_queries"] = "SELECT doc_id AS query_id, embedding AS query_vector FROM vector_index"
_STATEMENTS["knn_many_queries"] = f"""
SELECT query_id, doc_id, score, rank FROM ({_nearest('vector_queries')}) WHERE rank <= 3"""
_STATEMENTS["knn_by_type"] = f"""
SELECT query_id, doc_id, score, rank, doc_type, ticker
FROM ({_nearest('label_queries', "doc_type = 'company_profile'")})"""
_STATEMENTS["knn_filtered"] = f"""
SELECT ticker, doc_id, score, rank
FROM ({_nearest('ticker_queries', "doc_type = 'news' AND ticker = query_id")})"""
_STATEMENTS["knn_by_ticker"] = f"""
SELECT ticker, doc_id, score, rank FROM ({_nearest('ticker_queries', 'ticker = query_id')})"""

_TABLES["questions"] = "SELECT item_id AS query_id, text FROM benchmark"
_TABLES["question_vectors"] = _encoded("questions", "query_id")
_TABLES["panel_questions"] = """
SELECT DISTINCT upper(s_name) AS query_id, 'recent news and analysis for ' || upper(s_name) AS text
FROM supplier"""
_TABLES["panel_vectors"] = _encoded("panel_questions", "query_id")


def _answers(questions: str, vectors: str, where: str, k: int = 5) -> str:
    """The best documents per question; both sides are scaled again, as 4-byte values lose length."""
    return f"""
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC NULLS LAST, doc_id) AS rank
FROM (
  SELECT query_id, d.*, CASE WHEN dn.norm IS NOT NULL AND qn.norm IS NOT NULL
         THEN round(coalesce(dot, 0) / (dn.norm * qn.norm), 6) + 0.0 END AS score
  FROM (SELECT query_id FROM {questions}) AS q CROSS JOIN unique_docs AS d
  LEFT JOIN (SELECT query_id, doc_id, sum(a.value * b.value) AS dot
             FROM doc_vectors AS a JOIN {vectors} AS b USING (place) GROUP BY ALL) USING (query_id, doc_id)
  LEFT JOIN (SELECT doc_id, sqrt(sum(value * value)) AS norm FROM doc_vectors GROUP BY doc_id) AS dn USING (doc_id)
  LEFT JOIN (SELECT query_id, sqrt(sum(value * value)) AS norm FROM {vectors} GROUP BY query_id) AS qn
       USING (query_id)
  WHERE {where})
QUALIFY rank <= {k}"""


_STATEMENTS["semantic_search"] = f"""
SELECT query_id, rank, score, doc_id, doc_type, ticker, title, text
FROM ({_answers('questions', 'question_vectors', 'true')})"""
_STATEMENTS["semantic_search_indexed"] = _STATEMENTS["semantic_search"]
_STATEMENTS["index_from_feed"] = _STATEMENTS["semantic_search"]
_STATEMENTS["search_results"] = f"""
SELECT query_id, rank, score, ticker, coalesce(title, 'No title') AS title,
       CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '...' ELSE text END AS text,
       coalesce(metadata_date, 'N/A') AS "date", doc_type
FROM ({_answers('questions', 'question_vectors', 'true')})"""
_STATEMENTS["search_news"] = f"""
SELECT query_id, rank, score, doc_id, ticker, title, substr(text, 1, 200) || '...' AS snippet
FROM ({_answers('questions', 'question_vectors', "doc_type = 'news'")})"""
_STATEMENTS["search_news_of_ticker"] = f"""
SELECT query_id, rank, score, doc_id, ticker, title, substr(text, 1, 200) || '...' AS snippet
FROM ({_answers('questions', 'question_vectors', "doc_type = 'news' AND ticker = 'SUPPLIER#000000007'")})"""
_STATEMENTS["search_profiles"] = f"""
SELECT query_id, rank, score, doc_id, ticker, title, substr(text, 1, 300) || '...' AS snippet
FROM ({_answers('questions', 'question_vectors', "doc_type = 'company_profile'")})"""
_STATEMENTS["news_for_ticker"] = f"""
SELECT ticker, rank, score, doc_id, doc_type, title,
       CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '...' ELSE text END AS text,
       coalesce(metadata_date, 'N/A') AS "date"
FROM ({_answers('panel_questions', 'panel_vectors', 'd.ticker = query_id')})"""


# Watchlists and notes ---------------------------------------------------------------------

_TABLES["users_t"] = """
SELECT c_custkey AS user_id, lower(c_name) || '@example.com' AS email, c_name AS display_name,
       TIMESTAMP '1995-01-01 00:00:00' AS created_at
FROM customer"""

_TABLES["watchlists_t"] = """
SELECT o_orderkey AS watchlist_id, o_custkey AS user_id, o_orderpriority AS name FROM orders"""

_TABLES["watchlist_tickers_t"] = """
SELECT l_orderkey AS watchlist_id, upper(s_name) AS ticker, max(l_shipdate) AS added_at
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""

_TABLES["events_t"] = """
SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"""

_CUSTOMER = "'customer#' || lpad(CAST({0} AS VARCHAR), 9, '0') || '@example.com'"
_MEMBER = "'member' || {0} || '@example.com'"

_TABLES["adds"] = f"""
SELECT CASE WHEN event_type = 'signup' THEN {_CUSTOMER.format('user_id')}
            ELSE {_MEMBER.format('user_id')} END AS email,
       CASE k % 3 WHEN 1 THEN '1-URGENT' WHEN 2 THEN '3-MEDIUM' ELSE 'default' END AS name,
       'SUPPLIER#' || lpad(CAST(k AS VARCHAR), 9, '0') AS ticker, min(ts) AS requested_at
FROM events_t WHERE event_type IN ('signup', 'purchase') GROUP BY ALL"""


def _with_new_users(requests: str) -> str:
    return f"""
SELECT * FROM users_t
UNION ALL
SELECT (SELECT max(user_id) FROM users_t) + row_number() OVER (ORDER BY created_at, email),
       email, NULL, created_at
FROM (SELECT email, min(requested_at) AS created_at FROM {requests}
      WHERE email NOT IN (SELECT email FROM users_t) GROUP BY email)"""


_TABLES["users_after"] = _with_new_users("adds")

_TABLES["lists_wanted"] = """
SELECT user_id, name, min(requested_at) AS created_at FROM adds JOIN users_after USING (email) GROUP BY ALL"""

_TABLES["lists_found"] = """
SELECT user_id, name, watchlist_id, false AS created
FROM lists_wanted JOIN (SELECT user_id, name, min(watchlist_id) AS watchlist_id
                        FROM watchlists_t GROUP BY ALL) USING (user_id, name)
UNION ALL
SELECT user_id, name,
       (SELECT max(watchlist_id) FROM watchlists_t)
       + row_number() OVER (ORDER BY created_at, user_id, name), true
FROM lists_wanted WHERE (user_id, name) NOT IN (SELECT (user_id, name) FROM watchlists_t)"""

_TABLES["rows_added"] = """
SELECT watchlist_id, ticker, requested_at AS added_at, email, name AS list_name
FROM adds JOIN users_after USING (email) JOIN lists_found USING (user_id, name)
WHERE NOT EXISTS (SELECT 1 FROM watchlist_tickers_t AS t
                  WHERE t.watchlist_id = lists_found.watchlist_id AND t.ticker = adds.ticker)"""

_TABLES["removals"] = f"""
SELECT {_CUSTOMER.format('user_id')} AS email,
       ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][k % 5 + 1] AS list_name,
       'SUPPLIER#' || lpad(CAST(k AS VARCHAR), 9, '0') AS ticker, min(ts) AS requested_at
FROM events_t WHERE event_type = 'error' GROUP BY ALL"""

_TABLES["doomed"] = """
SELECT r.*, watchlist_id
FROM removals AS r JOIN users_t USING (email)
JOIN watchlists_t AS w ON w.user_id = users_t.user_id AND w.name = r.list_name"""

_STATEMENTS["watchlist_get"] = """
SELECT email, name AS list_name, watchlist_id, ticker, added_at
FROM watchlist_tickers_t JOIN watchlists_t USING (watchlist_id) JOIN users_t USING (user_id)
ORDER BY email, list_name, added_at DESC, ticker, watchlist_id"""
_STATEMENTS["watchlist_of_user"] = _STATEMENTS["watchlist_get"].replace(
    "ORDER BY", "WHERE email = 'customer#000000007@example.com' AND list_name = '1-URGENT' ORDER BY"
)
_STATEMENTS["watchlist_users"] = "SELECT * FROM users_after"
_STATEMENTS["watchlist_get_or_create"] = "SELECT * FROM lists_found"
_STATEMENTS["watchlist_add"] = """
SELECT watchlist_id, ticker, added_at FROM watchlist_tickers_t
UNION ALL SELECT watchlist_id, ticker, added_at FROM rows_added"""
_STATEMENTS["watchlist_added_rows"] = "SELECT * FROM rows_added"
_STATEMENTS["watchlist_remove"] = """
SELECT email, list_name, ticker, count(added_at) AS rows_removed
FROM removals LEFT JOIN (
  SELECT * FROM doomed JOIN watchlist_tickers_t USING (watchlist_id, ticker)
) USING (email, list_name, ticker)
GROUP BY ALL"""
_STATEMENTS["watchlist_store_add"] = """
SELECT email, name AS list_name, ticker, added_at
FROM watchlist_tickers_t JOIN watchlists_t USING (watchlist_id) JOIN users_t USING (user_id)
UNION ALL SELECT email, list_name, ticker, added_at FROM rows_added"""
_STATEMENTS["watchlist_store_remove"] = """
SELECT email, name AS list_name, ticker, added_at
FROM watchlist_tickers_t JOIN watchlists_t USING (watchlist_id) JOIN users_t USING (user_id)
WHERE (watchlist_id, ticker) NOT IN (SELECT (watchlist_id, ticker) FROM doomed)"""
_STATEMENTS["watchlist_mutation_log"] = """
SELECT md5(concat_ws('-', operation, watchlist_id, ticker, epoch_us("timestamp"))) AS mutation_id,
       "timestamp", email AS user_id, ticker, operation, source
FROM (
  SELECT watchlist_id, ticker, email, added_at AS "timestamp", 'add' AS operation, 'agent' AS source
  FROM rows_added
  UNION ALL
  SELECT watchlist_id, ticker, email, requested_at, 'remove', 'app'
  FROM doomed JOIN watchlist_tickers_t USING (watchlist_id, ticker))"""
_STATEMENTS["watchlist_after_remove"] = """
SELECT watchlist_id, ticker, added_at FROM watchlist_tickers_t
WHERE (watchlist_id, ticker) NOT IN (SELECT (watchlist_id, ticker) FROM doomed)"""


def _replayed(where: str) -> str:
    return f"""
SELECT email, list_name, ticker, ts AS added_at
FROM (
  SELECT {_CUSTOMER.format('user_id')} AS email, CASE WHEN k % 2 = 0 THEN 'app' ELSE 'agent' END AS list_name,
         'T' || k % 8 AS ticker, event_type, ts, event_id
  FROM events_t WHERE event_type IN ('signup', 'purchase', 'error') AND {where})
QUALIFY row_number() OVER (PARTITION BY email, list_name, ticker ORDER BY ts DESC, event_id DESC) = 1
    AND event_type <> 'error'"""


_TABLES["lists_end"] = _replayed("true")
_TABLES["lists_halfway"] = _replayed("ts < TIMESTAMP '2024-01-16 00:00:00'")
_STATEMENTS["watchlist_replay"] = "SELECT * FROM lists_end"

_TABLES["note_requests"] = f"""
SELECT conv_id || '-' || turn AS request_id,
       CASE WHEN role = 'user' THEN {_CUSTOMER.format('conv_id')}
            ELSE {_MEMBER.format('conv_id')} END AS email,
       'SUPPLIER#' || lpad(CAST(conv_id % 10 AS VARCHAR), 9, '0') AS ticker, text,
       TIMESTAMP '2024-01-31 00:00:00' + to_seconds(conv_id * 60 + turn) AS requested_at
FROM conversations"""

_TABLES["note_users"] = _with_new_users("note_requests")

_TABLES["notes_t"] = """
SELECT doc_id AS note_id, doc_id % 150 AS user_id,
       'SUPPLIER#' || lpad(CAST(doc_id % 10 AS VARCHAR), 9, '0') AS ticker,
       CAST(NULL AS VARCHAR) AS title, text AS content,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(3600 * doc_id) AS created_at
FROM documents"""

_STATEMENTS["notes_save"] = """
SELECT * FROM notes_t
UNION ALL
SELECT (SELECT max(note_id) FROM notes_t)
       + row_number() OVER (ORDER BY requested_at, request_id),
       user_id, ticker, NULL, text, requested_at
FROM note_requests JOIN note_users USING (email)"""

_STATEMENTS["notes_get"] = """
SELECT user_id, note_id, ticker, substr(content, 1, 200) || '...' AS snippet, created_at, email
FROM (SELECT * FROM notes_t
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, note_id DESC) <= 10)
JOIN (SELECT user_id, email FROM users_t) USING (user_id)"""

_STATEMENTS["notes_of_user"] = """
SELECT user_id, note_id, ticker, substr(content, 1, 200) || '...' AS snippet, created_at, email
FROM notes_t JOIN users_t USING (user_id)
WHERE email = 'customer#000000007@example.com' AND ticker = 'SUPPLIER#000000007'
""".replace("created_at, email", "notes_t.created_at, email") + "ORDER BY notes_t.created_at DESC, note_id DESC LIMIT 3"


# Feeds and usage --------------------------------------------------------------------------

_CHANGE = """
CASE WHEN event_id % 10 < 7 THEN 'insert' WHEN event_id % 10 = 7 THEN 'update_preimage'
     WHEN event_id % 10 = 8 THEN 'update_postimage' ELSE 'delete' END AS _change_type,
CAST(day(ts) AS BIGINT) AS _commit_version, ts AS _commit_timestamp"""

_TABLES["call_feed"] = f"""
SELECT CAST(event_id AS VARCHAR) AS call_id, ts AS "timestamp", CAST(user_id AS VARCHAR) AS user_id,
       'tool_' || lpad(CAST(k % 11 AS VARCHAR), 2, '0') AS tool_name,
       CASE WHEN k % 4 <> 0 THEN 'T' || k % 8 END AS ticker, event_type <> 'error' AS success,
       CASE WHEN event_type = 'error' AND k % 3 <> 0 THEN 'E' || k % 5 END AS error_message,
       CAST(floor(value) AS BIGINT) AS execution_time_ms, {_CHANGE}
FROM events_t"""

_TABLES["mutation_feed"] = f"""
SELECT CAST(event_id AS VARCHAR) AS mutation_id, ts AS "timestamp", CAST(user_id AS VARCHAR) AS user_id,
       'T' || k % 8 AS ticker, CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS operation,
       {_CHANGE}
FROM events_t WHERE event_type IN ('signup', 'purchase', 'error')"""

_TABLES["current_calls"] = """
SELECT *, CAST("timestamp" AS DATE) AS "date" FROM call_feed
WHERE _change_type IN ('insert', 'update_postimage')"""

_TABLES["current_mutations"] = """
SELECT *, CAST("timestamp" AS DATE) AS "date" FROM mutation_feed WHERE _change_type = 'insert'"""

_TABLES["daily_stats"] = """
SELECT "date", user_id, CAST(coalesce(calls, 0) AS INT) AS total_tool_calls,
       CAST(coalesce(good, 0) AS INT) AS successful_calls,
       CAST(coalesce(calls, 0) - coalesce(good, 0) AS INT) AS failed_calls,
       CAST(coalesce(additions, 0) AS INT) AS watchlist_additions,
       CAST(coalesce(removals, 0) AS INT) AS watchlist_removals,
       CAST(coalesce(tickers, 0) AS INT) AS unique_tickers_viewed, tool_name AS most_used_tool,
       greatest(calls_until, mutations_until) AS last_updated
FROM (SELECT "date", user_id, count(*) AS calls, count(*) FILTER (WHERE success) AS good,
             count(DISTINCT ticker) AS tickers, max(_commit_timestamp) AS calls_until
      FROM current_calls GROUP BY ALL)
FULL JOIN (SELECT "date", user_id, count(*) FILTER (WHERE operation = 'add') AS additions,
                  count(*) FILTER (WHERE operation = 'remove') AS removals,
                  max(_commit_timestamp) AS mutations_until
           FROM current_mutations GROUP BY ALL) USING ("date", user_id)
LEFT JOIN (SELECT "date", user_id, tool_name
           FROM (SELECT "date", user_id, tool_name, count(*) AS n FROM current_calls GROUP BY ALL)
           QUALIFY row_number() OVER (PARTITION BY "date", user_id ORDER BY n DESC, tool_name) = 1)
     USING ("date", user_id)"""

_STATEMENTS["cdf_read"] = """
SELECT * FROM call_feed WHERE _commit_timestamp >= TIMESTAMP '2024-01-24 00:00:00'"""

_STATEMENTS["snapshot_diff"] = """
SELECT email, list_name, ticker, n.added_at, 'insert' AS _change_type
FROM lists_end AS n ANTI JOIN lists_halfway USING (email, list_name, ticker)
UNION ALL
SELECT email, list_name, ticker, o.added_at, 'delete'
FROM lists_halfway AS o ANTI JOIN lists_end USING (email, list_name, ticker)
UNION ALL
SELECT email, list_name, ticker, unnest([o.added_at, n.added_at]),
       unnest(['update_preimage', 'update_postimage'])
FROM lists_halfway AS o JOIN lists_end AS n USING (email, list_name, ticker)
WHERE o.added_at <> n.added_at"""

_STATEMENTS["tool_calls_hourly"] = """
SELECT date_trunc('hour', "timestamp") AS hour, tool_name, user_id, count(*) AS call_count,
       CAST(sum(CAST(success AS INT)) AS BIGINT) AS success_count, count(error_message) AS error_count,
       count(*) - count(error_message) AS successful_calls
FROM current_calls GROUP BY ALL"""

_STATEMENTS["watchlist_daily"] = """
SELECT "date", operation, user_id, count(*) AS mutation_count, count(DISTINCT ticker) AS unique_tickers
FROM current_mutations GROUP BY ALL"""

_STATEMENTS["daily_usage_stats"] = "SELECT * FROM daily_stats"
_STATEMENTS["usage_incremental"] = "SELECT * FROM daily_stats"
_STATEMENTS["usage_stream"] = "SELECT * FROM daily_stats"
_STATEMENTS["usage_lagging_feed"] = "SELECT * FROM daily_stats"

_STATEMENTS["usage_by_deltas"] = "SELECT * FROM daily_stats"
_STATEMENTS["tool_calls_hourly_by_deltas"] = _STATEMENTS["tool_calls_hourly"]
_STATEMENTS["tool_calls_hourly_windowed"] = _STATEMENTS["tool_calls_hourly"]
_STATEMENTS["watchlist_daily_by_deltas"] = _STATEMENTS["watchlist_daily"]
_STATEMENTS["usage_distinct"] = """
SELECT coalesce(strftime("date", '%Y-%m-%d'), 'all') AS period, count(DISTINCT user_id) AS users,
       count(DISTINCT ticker) AS tickers, count(DISTINCT (user_id, ticker)) FILTER (WHERE ticker IS NOT NULL) AS pairs,
       true AS users_close, true AS tickers_close, true AS pairs_close
FROM current_calls GROUP BY ROLLUP ("date")"""
_STATEMENTS["usage_freshness"] = "SELECT CAST(max(last_updated) AS VARCHAR) AS filled_until FROM daily_stats"

_STATEMENTS["usage_last_7_days"] = """
SELECT "date", CAST(sum(total_tool_calls) AS BIGINT) AS total_calls,
       CAST(sum(successful_calls) AS BIGINT) AS successful, CAST(sum(failed_calls) AS BIGINT) AS failed
FROM daily_stats WHERE "date" >= DATE '2024-01-31' - 7 GROUP BY "date" ORDER BY "date" DESC"""


# Chat -------------------------------------------------------------------------------------

_TABLES["messages"] = """
SELECT conv_id, turn,
       CASE conv_id % 4 WHEN 0 THEN 'search for ' || text WHEN 1 THEN 'price of T' || conv_id % 8
                        WHEN 2 THEN 'find ' || text ELSE text END AS message
FROM conversations WHERE role = 'user'"""

_TABLES["routed"] = rf"""
SELECT conv_id, turn, message, intent,
       CASE WHEN intent = 'search' THEN
         regexp_replace(replace(replace(message, 'search for', ''), 'find', ''),
                        '^{BLANK}+|{BLANK}+$', '', 'g') END AS query,
       CASE WHEN intent = 'price' THEN word END AS ticker
FROM (
  SELECT *, CASE WHEN contains(lower(message), 'search') OR contains(lower(message), 'find') THEN 'search'
                 WHEN contains(lower(message), 'price') AND word IS NOT NULL THEN 'price'
                 ELSE 'help' END AS intent
  FROM (SELECT *, list_filter(string_split_regex(message, '{BLANK}+'),
               lambda w: w = upper(w) AND w <> lower(w) AND length(w) <= 5)[1] AS word
        FROM messages))"""

_STATEMENTS["chat_route"] = "SELECT * FROM routed"
_TABLES["chat_questions"] = """
SELECT conv_id || '-' || turn AS query_id, query AS text FROM routed WHERE intent = 'search'"""
_TABLES["chat_vectors"] = _encoded("chat_questions", "query_id")

_STATEMENTS["chat_search"] = f"""
SELECT query_id, rank, score, doc_id, ticker, title, substr(text, 1, 200) || '...' AS snippet
FROM ({_answers('chat_questions', 'chat_vectors', 'true', 3)})"""
_STATEMENTS["chat_intents"] = "SELECT intent, count(*) AS messages FROM routed GROUP BY intent"


def _named_in(sql: str) -> list[str]:
    return [name for name in _TABLES if re.search(rf"\b{name}\b", sql)]


def _needed(sql: str, done: list[str]) -> list[str]:
    for name in _named_in(sql):
        if name not in done:
            _needed(_TABLES[name], done)
            done.append(name)
    return done


_STATEMENTS["chat_prices"] = """
SELECT conv_id, turn, r.ticker, CASE WHEN q.ticker IS NOT NULL THEN coalesce(company_name, q.ticker) END AS name, price, change, change_pct, volume
FROM routed AS r LEFT JOIN quotes AS q ON r.ticker = 'T' || CAST(CAST(right(q.ticker, 9) AS INT) AS VARCHAR)
WHERE intent = 'price'"""


# Jobs -------------------------------------------------------------------------------------

_STATEMENTS["etl_written_rows"] = """
SELECT 'ingest_report' AS table_name,
       (SELECT count(DISTINCT ticker) FROM landed_prices) + (SELECT count(DISTINCT ticker) FROM profiles_t)
       + (SELECT count(DISTINCT ticker) FROM bronze_news_t) AS "rows"
UNION ALL SELECT 'bronze_prices', count(*) FROM landed_prices
UNION ALL SELECT 'bronze_companies', count(*) FROM profiles_t
UNION ALL SELECT 'bronze_news', count(*) FROM bronze_news_t
UNION ALL SELECT 'silver_prices', count(*) FROM silver_prices_t
UNION ALL SELECT 'silver_companies', count(*) FROM companies_t
UNION ALL SELECT 'silver_news', count(*) FROM news_t"""

# Left out: `knn_lsh` returns what an approximate search happens to find.


def statements() -> dict[str, str]:
    """One runnable statement per registered query that has one."""
    full = {}
    for key, select in _STATEMENTS.items():
        tables = ",\n".join(f"{name} AS ({_TABLES[name].strip()})" for name in _needed(select, []))
        full[key] = f"WITH {tables}\n{select.strip()}" if tables else select.strip()
    return full
