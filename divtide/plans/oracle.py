"""The registered queries in plain SQL for DuckDB, written apart from the Spark code."""

RAW = """
raw AS (
  SELECT
    CASE WHEN l_partkey % 23 = 0 THEN 'n/a'
         ELSE CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || '.25' END AS cash_amount,
    CASE l_returnflag WHEN 'A' THEN ' usd' WHEN 'N' THEN 'cad ' END AS currency,
    CASE WHEN l_partkey % 7 <> 0 THEN strftime(CAST(l_shipdate AS DATE) + (-20), '%Y-%m-%d') END AS declaration_date,
    l_linestatus AS dividend_type,
    strftime(CAST(l_shipdate AS DATE) + (-1), '%Y-%m-%d') AS ex_dividend_date,
    CASE l_linenumber WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '4' WHEN 4 THEN '12' WHEN 5 THEN '4.0'
         WHEN 6 THEN 'x' END AS frequency,
    CASE WHEN l_orderkey % 97 <> 0 THEN 'D' || CAST(l_orderkey AS VARCHAR) END AS id,
    CASE WHEN l_partkey % 11 = 0 THEN 'bad-date'
         ELSE strftime(CAST(l_shipdate AS DATE) + 30, '%Y-%m-%d') END AS pay_date,
    CASE WHEN l_partkey % 13 <> 0 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') END AS record_date,
    CASE WHEN l_suppkey % 50 = 7 THEN 'NA'
         ELSE ' tk' || CAST(l_suppkey % 50 AS VARCHAR) || ' ' END AS ticker
  FROM lineitem
)"""

LATEST = """
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY
      record_date DESC NULLS FIRST, cash_amount DESC NULLS FIRST, currency DESC NULLS FIRST,
      declaration_date DESC NULLS FIRST, dividend_type DESC NULLS FIRST, ex_dividend_date DESC NULLS FIRST,
      frequency DESC NULLS FIRST, pay_date DESC NULLS FIRST, ticker DESC NULLS FIRST) AS rn
    FROM raw WHERE id IS NOT NULL)
  WHERE rn = 1
)"""


def typed(source: str) -> str:
    return f"""
typed AS (
  SELECT id AS dividend_id, upper(trim(ticker)) AS ticker,
    TRY_CAST(ex_dividend_date AS DATE) AS ex_dividend_date, TRY_CAST(pay_date AS DATE) AS pay_date,
    TRY_CAST(record_date AS DATE) AS record_date, TRY_CAST(declaration_date AS DATE) AS declaration_date,
    dividend_type, TRY_CAST(frequency AS BIGINT) AS frequency, TRY_CAST(cash_amount AS DOUBLE) AS cash_amount,
    upper(trim(currency)) AS currency
  FROM {source}
)"""


STAGED = """
stg AS (
  SELECT *, CASE
      WHEN pay_date <= DATE '1999-06-30' THEN 'completed'
      WHEN ex_dividend_date <= DATE '1999-06-30' AND pay_date > DATE '1999-06-30' THEN 'awaiting_payment'
      WHEN ex_dividend_date > DATE '1999-06-30' THEN 'upcoming'
      WHEN declaration_date IS NULL THEN 'announced'
      ELSE 'in_progress' END AS dividend_lifecycle_stage
  FROM typed
)"""

LABEL = """CASE frequency WHEN 1 THEN 'annual' WHEN 2 THEN 'semi_annual' WHEN 4 THEN 'quarterly'
    WHEN 12 THEN 'monthly' ELSE 'unknown' END AS dividend_frequency"""

DIM = f"dim AS (SELECT *, {LABEL} FROM stg)"

TOTALS = """
totals AS (
  SELECT ticker, CAST(year(pay_date) AS INTEGER) AS year, sum(cash_amount) AS total_cashes
  FROM dim GROUP BY 1, 2
)"""

CHANGES = """
changes AS (
  SELECT *, round(total_cashes - coalesce(total_cashes_previous_year, 0), 2) AS year_over_year_change
  FROM (
    SELECT *, lag(total_cashes) OVER (PARTITION BY ticker ORDER BY year ASC NULLS LAST) AS total_cashes_previous_year
    FROM totals)
)"""

SUMMARY = """
summary AS (
  SELECT ticker, sum(cash_amount) OVER w AS total_dividend_amount_of_year,
    avg(cash_amount) OVER w AS average_dividend_amount_of_year,
    max(pay_date) OVER w AS last_pay_date_of_year, min(pay_date) OVER w AS first_pay_date_of_year
  FROM dim WINDOW w AS (PARTITION BY ticker, year(pay_date), record_date)
)"""

TRENDS = """
trends AS (
  SELECT ticker, year, total_cashes AS total_cashes_current_year, total_cashes_previous_year, year_over_year_change
  FROM changes
  ORDER BY year_over_year_change DESC NULLS FIRST, ticker ASC NULLS LAST, year ASC NULLS LAST
  LIMIT 10
)"""

FIRST = "first_part AS (SELECT * FROM raw WHERE frequency = '1')"
OTHER = "other_part AS (SELECT * FROM raw WHERE frequency IS DISTINCT FROM '1')"

LOG = """
log AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS run, event_id AS page,
    CAST(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS INTEGER) AS status,
    CASE WHEN event_id % 5 <> 0 THEN 'p' || CAST(event_id AS VARCHAR) END AS next_url
  FROM events
)"""

# Counts, for each page, the pages up to it that stop the walk.
ADMITTED = """
placed AS (
  SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS seq, lag(next_url) OVER w AS link
  FROM log WINDOW w AS (PARTITION BY run ORDER BY page)
), walked AS (
  SELECT *, sum(CASE WHEN status NOT BETWEEN 200 AND 299 OR (seq > 0 AND coalesce(link, '') = '') THEN 1 ELSE 0 END)
    OVER (PARTITION BY run ORDER BY page ROWS UNBOUNDED PRECEDING) AS stops
  FROM placed
)"""

PEOPLE = """
people AS (
  SELECT CAST((c_custkey // 64) % 20 AS INTEGER) AS number, c_mktsegment AS craft, c_name AS name FROM customer
)"""

FALLBACK = """
fallback(craft, name) AS (VALUES
  ('ISS', 'Oleg Kononenko'), ('ISS', 'Nikolai Chub'), ('ISS', 'Tracy Caldwell Dyson'), ('ISS', 'Matthew Dominick'),
  ('ISS', 'Michael Barratt'), ('ISS', 'Jeanette Epps'), ('ISS', 'Alexander Grebenkin'), ('ISS', 'Butch Wilmore'),
  ('ISS', 'Sunita Williams'), ('Tiangong', 'Li Guangsu'), ('Tiangong', 'Li Cong'), ('Tiangong', 'Ye Guangfu')
)"""

# Words a CSV reader commonly takes for a missing value.
TOKENS = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>',
    'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""

RAW_NAMES = [
    "cash_amount",
    "currency",
    "declaration_date",
    "dividend_type",
    "ex_dividend_date",
    "frequency",
    "id",
    "pay_date",
    "record_date",
    "ticker",
]


def sql(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)}\n{select}"


STG_CHAIN = (RAW, LATEST, typed("latest"), STAGED)
DIM_CHAIN = (*STG_CHAIN, DIM)
CHANGE_CHAIN = (*DIM_CHAIN, TOTALS, CHANGES)
TYPED_CHAIN = (RAW, typed("raw"))
ALL_RAW = sql(RAW, select="SELECT * FROM raw")

ORACLES = {
    "json_pages_scan": ALL_RAW,
    "page_admission": sql(
        LOG, ADMITTED, select="SELECT run, page, status, next_url, seq FROM walked WHERE stops = 0 AND seq < 5"
    ),
    "page_ok_filter": sql(LOG, select="SELECT * FROM log WHERE status < 400"),
    "empty_page": """
        SELECT CASE o_orderkey % 3 WHEN 0 THEN 'missing' WHEN 1 THEN 'empty' ELSE 'filled' END AS kind,
          count(*) AS pages, CAST(sum(CASE WHEN o_orderkey % 3 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS row_count,
          CAST(10 AS INTEGER) AS column_count
        FROM orders GROUP BY o_orderkey % 3""",
    "fallback_relation": sql(
        PEOPLE,
        FALLBACK,
        select="""SELECT number, craft, name, 'landed' AS source FROM people
        UNION ALL SELECT CAST(12 AS INTEGER), craft, name, 'fallback' FROM fallback""",
    ),
    "explode_rows": sql(
        PEOPLE,
        select="""SELECT number, craft, name,
          name || ' is currently in space flying on the ' || craft || '! Hello! :)' AS message FROM people""",
    ),
    "nested_flatten": sql(
        RAW,
        select="""SELECT id, TRY_CAST(cash_amount AS DOUBLE) AS amount_cash, currency AS amount_currency,
          ex_dividend_date AS dates_ex, pay_date AS dates_due_pay, record_date AS dates_due_record,
          TRY_CAST(frequency AS BIGINT) AS frequency FROM raw""",
    ),
    "history_evolve": sql(
        RAW,
        FIRST,
        OTHER,
        select="""SELECT CAST(TRY_CAST(cash_amount AS DOUBLE) AS VARCHAR) AS cash_amount,
          CAST(NULL AS VARCHAR) AS currency, declaration_date, dividend_type, ex_dividend_date,
          CAST(TRY_CAST(frequency AS BIGINT) AS VARCHAR) AS frequency, id, pay_date,
          CAST(TRY_CAST(record_date AS DATE) AS VARCHAR) AS record_date, ticker FROM first_part
        UNION ALL SELECT * FROM other_part""",
    ),
    "history_append": ALL_RAW,
    "history_append_new": sql(
        RAW,
        FIRST,
        select="SELECT * FROM first_part UNION ALL (SELECT * FROM raw EXCEPT SELECT * FROM first_part)",
    ),
    "history_compacted": ALL_RAW,
    "batch_repeat": sql(
        RAW,
        OTHER,
        select="SELECT *, 'history' AS sink FROM other_part UNION ALL SELECT *, 'table' AS sink FROM other_part",
    ),
    "rejected_pages": """
        SELECT CASE o_orderkey % 5
          WHEN 1 THEN '{"status":"OK","results":"' || o_orderkey || '"}'
          WHEN 2 THEN '{"status":"OK","results":{"id":"' || o_orderkey || '"}}'
          WHEN 3 THEN '{"status":"OK","results":[{"id":"' || o_orderkey || '"},7]}'
          ELSE '{"status":"OK","results":[{"id":"' || o_orderkey || '"' END AS page
        FROM orders WHERE o_orderkey % 5 <> 0""",
    "union_all": sql(RAW, FIRST, select="SELECT * FROM raw UNION ALL SELECT * FROM first_part"),
    "strict_union": ALL_RAW,
    "staging_csv_roundtrip": ALL_RAW,
    "staging_csv_clear": """
        SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after, CAST(10 AS INTEGER) AS column_count
        FROM lineitem""",
    "null_tokens": sql(
        RAW,
        select="SELECT "
        + ", ".join(f"CASE WHEN {c} NOT IN {TOKENS} THEN {c} END AS {c}" for c in RAW_NAMES)
        + " FROM raw",
    ),
    "warehouse_append": ALL_RAW,
    "microbatch_replay": sql(
        RAW, select="SELECT *, 'history' AS sink FROM raw UNION ALL SELECT *, 'table' AS sink FROM raw"
    ),
    "admitted_ingest": sql(
        LOG,
        ADMITTED,
        select=" UNION ALL ".join(
            f"""SELECT 'E' || CAST(page AS VARCHAR) AS id, run AS ticker, '{sink}' AS sink FROM walked WHERE stops = 0
            UNION ALL SELECT 'O' || CAST(o_orderkey AS VARCHAR), 'loose', '{sink}' FROM orders WHERE o_orderkey % 4 IN (2, 3)"""
            for sink in ("history", "table")
        ),
    ),
    "batch_metrics": sql(
        RAW,
        select="""SELECT count(*) FILTER (WHERE frequency = '1') AS rows_in_batch,
          count(*) FILTER (WHERE frequency IS DISTINCT FROM '1') AS rows_before, count(*) AS rows_after FROM raw""",
    ),
    "normalize_schema": """
        SELECT CAST(floor(l_quantity) + 0.25 AS VARCHAR) AS cash_amount, CAST(NULL AS VARCHAR) AS currency,
          CAST(NULL AS VARCHAR) AS declaration_date, l_linestatus AS dividend_type,
          CAST(NULL AS VARCHAR) AS ex_dividend_date, CAST(l_linenumber AS VARCHAR) AS frequency,
          CAST(l_orderkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS pay_date,
          strftime(l_shipdate, '%Y-%m-%d') AS record_date, CAST(l_suppkey AS VARCHAR) AS ticker
        FROM lineitem""",
    "clean_strings": sql(
        RAW, select="SELECT id, upper(trim(ticker)) AS ticker, upper(trim(currency)) AS currency FROM raw"
    ),
    # Of the declaration dates only those without other text after them are dates.
    "typed_casts": sql(
        *TYPED_CHAIN,
        select="""SELECT * EXCLUDE (ticker, currency, dividend_type) REPLACE (
          CASE WHEN ticker <> 'NA' AND NOT frequency IN (1, 2) IS TRUE THEN declaration_date END AS declaration_date)
        FROM typed""",
    ),
    "lifecycle_stage": sql(*TYPED_CHAIN, STAGED, select="SELECT * FROM stg"),
    "frequency_label": sql(*TYPED_CHAIN, select=f"SELECT dividend_id, frequency, {LABEL} FROM typed"),
    "drop_null_ids": sql(RAW, select="SELECT * FROM raw WHERE id IS NOT NULL"),
    "dedup_latest": sql(RAW, LATEST, select="SELECT * FROM latest"),
    "stg_dividends": sql(*STG_CHAIN, select="SELECT * FROM stg"),
    "dim_dividends": sql(*DIM_CHAIN, select="SELECT * FROM dim"),
    "fct_dividend_summary": sql(*DIM_CHAIN, SUMMARY, select="SELECT * FROM summary"),
    "ticker_year_totals": sql(*DIM_CHAIN, TOTALS, select="SELECT * FROM totals"),
    "lag_prev_year": sql(
        *CHANGE_CHAIN, select="SELECT ticker, year, total_cashes, total_cashes_previous_year FROM changes"
    ),
    "yoy_change": sql(*CHANGE_CHAIN, select="SELECT * FROM changes"),
    "fct_dividend_trends": sql(*CHANGE_CHAIN, TRENDS, select="SELECT * FROM trends"),
    "not_null_checks": sql(
        *STG_CHAIN,
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM stg"
            for c in ("ticker", "ex_dividend_date", "cash_amount", "pay_date")
        ),
    ),
    "model_build": sql(
        *CHANGE_CHAIN,
        SUMMARY,
        TRENDS,
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS relation, count(*) AS row_count FROM {cte}"
            for name, cte in {
                "stg_stock_dividends": "stg",
                "dim_dividends": "dim",
                "fct_dividend_summary": "summary",
                "fct_dividend_trends": "trends",
            }.items()
        ),
    ),
    "stored_summary": sql(*DIM_CHAIN, SUMMARY, select="SELECT * FROM summary"),
    "stage_refresh": sql(
        *DIM_CHAIN,
        select="""SELECT * REPLACE (CASE
          WHEN pay_date <= DATE '2000-01-31' THEN 'completed'
          WHEN ex_dividend_date <= DATE '2000-01-31' AND pay_date > DATE '2000-01-31' THEN 'awaiting_payment'
          WHEN ex_dividend_date > DATE '2000-01-31' THEN 'upcoming'
          WHEN declaration_date IS NULL THEN 'announced'
          ELSE 'in_progress' END AS dividend_lifecycle_stage) FROM dim""",
    ),
    "model_refresh": sql(*DIM_CHAIN, select="SELECT * FROM dim"),
    "single_run": sql(*CHANGE_CHAIN, TRENDS, select="SELECT * FROM trends"),
    "trends_refresh": sql(*CHANGE_CHAIN, TRENDS, select="SELECT * FROM trends"),
    "summary_refresh": sql(*DIM_CHAIN, SUMMARY, select="SELECT * FROM summary"),
    "audited_build": sql(
        RAW,
        "complete AS (SELECT * FROM raw WHERE cash_amount <> 'n/a' AND pay_date <> 'bad-date')",
        LATEST.replace("FROM raw", "FROM complete"),
        typed("latest"),
        STAGED,
        DIM,
        select="SELECT * FROM dim",
    ),
    "load_ledger": sql(
        RAW,
        OTHER,
        select="""SELECT 'a' AS batch, CAST(0 AS BIGINT) AS rows, count(*) AS rows_after FROM other_part
        UNION ALL SELECT 'b', count(*), count(*) FROM other_part""",
    ),
}
