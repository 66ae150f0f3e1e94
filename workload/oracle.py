"""An independent DuckDB statement for each query."""

from __future__ import annotations

from clicklake.functions.time import as_day
from workload.feeds import ARRIVALS, LEAVING, RENAMED, RENAMING_DAYS, REPEATS
from workload.queries import CALENDAR, GAP_SECONDS, MIN_VIEWS, RANGES, REPEAT_DELAY, RULE, SLICE

_CLICK = """click AS (
  SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS event_date, user_id, event_type, value,
         json_extract_string(props, '$.k') AS product_id
  FROM events)"""

# What a reader of the message feed must see.
_WIRE = f"""{_CLICK},
wire AS (
  SELECT event_id AS n, value <= 150 AS readable, value <= 150 AND value >= 1 AS dated,
         CASE WHEN value <= 150 THEN CAST(event_id AS VARCHAR) END AS event_id,
         CASE WHEN value <= 150 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN value <= 150 AND event_type <> 'signup' THEN product_id END AS product_id,
         CASE WHEN value <= 150 THEN event_type END AS event_type,
         CASE WHEN value > 150 OR event_type = 'signup' THEN NULL
              WHEN event_type = 'click' AND value < 3 THEN '' ELSE p_type END AS category,
         CASE WHEN value > 150 THEN NULL WHEN value < 1 THEN 'some day'
              ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END AS "timestamp",
         CASE WHEN value <= 150 AND value >= 1 THEN event_time END AS event_time
  FROM click JOIN part ON CAST(p_partkey AS VARCHAR) = product_id),
lake AS (SELECT *, CAST(event_time AS DATE) AS event_date FROM wire WHERE dated)"""

_FIELDS = 'event_id, user_id, product_id, event_type, category, "timestamp", event_time'
_VP = "count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases"
_RATE = "CASE WHEN views > 0 THEN CAST(CAST(purchases / views AS FLOAT) AS DOUBLE) ELSE 0.0::DOUBLE END AS conversion_rate"
_LINE = (
    "printf('Category: %-12s | CR: %5.2f%% (Views: %d, Purchases: %d)', "
    "coalesce(nullif(category, ''), 'Other'), conversion_rate * 100, views, purchases)"
)
_DAILY_USERS = f"users AS (SELECT event_date, user_id, {_VP} FROM click GROUP BY ALL)"


def _three_way(min_views: int) -> str:
    return (
        f"CASE WHEN purchases > 0 THEN 'Buyer' WHEN views >= {min_views} AND purchases = 0 THEN 'Window Shopper' "
        "ELSE 'Casual Visitor' END AS segment"
    )


_TWO_WAY = "CASE WHEN purchases > 0 THEN 'Buyer' ELSE 'Window Shopper' END AS segment"
_DISTRIBUTION = (
    f"{_DAILY_USERS}, segments AS (SELECT *, {_three_way(MIN_VIEWS)} FROM users), "
    "dist AS (SELECT event_date, segment, count(*) AS users FROM segments GROUP BY ALL)"
)
_DAILY_TOP = """counts AS (SELECT event_date, product_id, count(*) AS view_count FROM click WHERE event_type = 'view' GROUP BY ALL),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_date ORDER BY view_count DESC, product_id) AS INTEGER) AS rank
  FROM counts QUALIFY rank <= 5)"""
_TOP_LINES = """top_lines AS (
  SELECT DISTINCT event_date AS report_date, 1 AS line_no, 'Top 5 Most Viewed Products:' AS line FROM click
  UNION ALL SELECT DISTINCT event_date, 2, repeat('-', 30) FROM click
  UNION ALL SELECT event_date, rank + 2, 'Product: ' || product_id || ' | Views: ' || view_count FROM top)"""


def _rate_lines(source: str) -> str:
    """Lines from ``source (event_date, category, views, purchases)``."""
    return f"""rates AS (SELECT *, {_RATE} FROM {source}),
rate_lines AS (
  SELECT DISTINCT event_date AS report_date, 1 AS line_no, 'Category Conversion Rates:' AS line FROM rates
  UNION ALL SELECT DISTINCT event_date, 2, repeat('-', 30) FROM rates
  UNION ALL SELECT event_date, CAST(2 + row_number() OVER (PARTITION BY event_date ORDER BY conversion_rate DESC, category NULLS FIRST) AS INTEGER),
    {_LINE} FROM rates)"""


_BY_TYPE = f"by_type AS (SELECT event_date, p_type AS category, {_VP} FROM click JOIN part ON CAST(p_partkey AS VARCHAR) = product_id GROUP BY ALL)"
_BY_LAKE = f"by_lake AS (SELECT event_date, category, {_VP} FROM lake GROUP BY ALL)"
_STOCKED = "stocked AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category FROM part WHERE p_size <= 40)"


def _alerts(source: str) -> str:
    """Six-hour windows, one starting every hour."""
    return f"""hits AS (
  SELECT date_trunc('hour', event_time) - to_hours(CAST(i AS INTEGER)) AS s, product_id, {_VP}
  FROM {source}, range(6) AS r(i) GROUP BY ALL),
alerts AS (
  SELECT s AS start, s + INTERVAL 6 HOUR AS "end", product_id, views AS view_count, purchases AS purchase_count,
         'Flash Sale Recommended' AS action
  FROM hits WHERE views >= 2 AND purchases < 3)"""


_STREAMED = f"""{_WIRE}, valid AS (SELECT * FROM lake WHERE product_id IS NOT NULL), {_alerts('valid')},
closed AS (SELECT * FROM alerts WHERE "end" <= (SELECT max(event_time) FROM valid) - INTERVAL 10 MINUTE)"""

_SESSIONS = f"""paused AS (
  SELECT *, epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id)) AS pause FROM click),
numbered AS (
  SELECT *, sum(CASE WHEN pause <= {GAP_SECONDS * 1_000_000} THEN 0 ELSE 1 END)
    OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM paused)"""


_WEEKS = " + ".join(f"CAST(CAST(ts AS DATE) >= DATE '{day}' AS INTEGER)" for day in ARRIVALS)
_LATE = f"""fed AS (
  SELECT event_id, user_id, json_extract_string(props, '$.k') AS product_id, event_type, ts AS event_time,
         {_WEEKS} + CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 1 ELSE 0 END AS batch FROM events),
marks AS (SELECT batch + 1 AS batch, max(max(event_time)) OVER (ORDER BY batch) - INTERVAL 10 MINUTE AS mark FROM fed GROUP BY batch)"""
# Each delivery with its number among those of its id; one is behind if its time is not after the mark of the parts before.
_DELIVERED = f"""fed AS (
  SELECT event_id, ts, {_WEEKS} AS week FROM events),
sent AS (
  SELECT event_id, ts, week AS part FROM fed{"".join(f" UNION ALL SELECT event_id, ts, week + {weeks} FROM fed WHERE event_id % {every} = 0" for every, weeks in REPEATS)}),
marks AS (SELECT part + 1 AS part, max(max(ts)) OVER (ORDER BY part) - INTERVAL {REPEAT_DELAY} AS mark FROM sent GROUP BY part),
numbered AS (
  SELECT event_id, coalesce(ts <= mark, false) AS behind, row_number() OVER (PARTITION BY event_id ORDER BY part) AS n FROM sent LEFT JOIN marks USING (part))"""
_EDGE = RULE.slide_seconds * 1_000_000
_MISSED = f"""(least(epoch_us(mark), epoch_us(event_time) + {RULE.window_seconds * 1_000_000}) // {_EDGE} - epoch_us(event_time) // {_EDGE})"""
_RANGES = " UNION ALL ".join(f"SELECT DATE '{as_day(a)}' AS first_day, DATE '{as_day(b)}' AS last_day" for a, b in RANGES)


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


_ORDER = _with(
    _CLICK,
    """compared AS (SELECT user_id, event_time, lag(event_time) OVER (PARTITION BY user_id
  ORDER BY event_id * 10 + CASE WHEN event_type = 'purchase' THEN 505 ELSE 0 END) AS before FROM click)""",
    select="SELECT user_id, count(*) AS events, count(*) FILTER (event_time < before) AS violations FROM compared GROUP BY 1",
)
_RENAME = f"TIMESTAMP '{RENAMED}' + to_days(CAST(p_partkey % {RENAMING_DAYS} AS INTEGER))"
_DATED = f"""dated AS (
  SELECT event_id, json_extract_string(props, '$.k') AS product_id, ts, p_type, p_brand, p_size, {_RENAME} AS renamed
  FROM events LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = json_extract_string(props, '$.k'))"""
_OUTCOMES = """SELECT user_id, min(event_time) AS session_start, count(*) AS events,
  last(event_type ORDER BY event_time, event_id) AS last_event_type, bool_or(event_type = 'click') AS has_cart,
  last(event_type ORDER BY event_time, event_id) = 'purchase' AS ends_in_purchase
FROM numbered GROUP BY user_id, session_no"""


def all_oracles() -> dict[str, str]:
    lake_columns = f"{_FIELDS}, event_date"
    return {
        "decode_events": _with(_WIRE, select=f"SELECT {_FIELDS} FROM wire"),
        "decode_valid_for_alerts": _with(
            _WIRE,
            select=f"SELECT {_FIELDS} FROM wire WHERE product_id IS NOT NULL AND event_type IS NOT NULL AND event_time IS NOT NULL",
        ),
        "decode_valid_for_archive": _with(_WIRE, select=f"SELECT {lake_columns} FROM lake"),
        "product_view_counts": _with(
            _CLICK, select="SELECT product_id, count(*) AS view_count FROM click WHERE event_type = 'view' GROUP BY 1"
        ),
        "user_activity": _with(_CLICK, select=f"SELECT user_id, {_VP} FROM click GROUP BY 1"),
        "daily_user_activity": _with(_CLICK, _DAILY_USERS, select="SELECT * FROM users"),
        "user_segments_3way": _with(
            _CLICK, f"u AS (SELECT user_id, {_VP} FROM click GROUP BY 1)", select=f"SELECT *, {_three_way(5)} FROM u"
        ),
        "daily_user_segments_3way": _with(_CLICK, _DAILY_USERS, select=f"SELECT *, {_three_way(MIN_VIEWS)} FROM users"),
        "daily_user_segments_3way_default": _with(_CLICK, _DAILY_USERS, select=f"SELECT *, {_three_way(5)} FROM users"),
        "daily_user_segments_2way": _with(_CLICK, _DAILY_USERS, select=f"SELECT *, {_TWO_WAY} FROM users"),
        "segment_distribution": _with(_CLICK, _DISTRIBUTION, select="SELECT * FROM dist"),
        "segment_distribution_2way": _with(
            _CLICK,
            _DAILY_USERS,
            f"segments AS (SELECT *, {_TWO_WAY} FROM users)",
            select="SELECT event_date, segment, count(*) AS users FROM segments GROUP BY ALL",
        ),
        "daily_run_statistics": _with(
            _WIRE,
            select="SELECT event_date, count(*) AS records_processed, count(DISTINCT product_id) AS unique_products, "
            "count(DISTINCT user_id) AS unique_users FROM lake GROUP BY 1",
        ),
        "duplicate_catalogue_conversion": _with(
            _CLICK,
            """twice AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category FROM part
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), CASE WHEN length(p_type) % 2 = 0 THEN NULL ELSE reverse(p_type) END FROM part)""",
            "once AS (SELECT product_id, min(category) AS category FROM twice GROUP BY 1)",
            f"c AS (SELECT coalesce(category, 'Other') AS category, {_VP} FROM click LEFT JOIN once USING (product_id) GROUP BY 1)",
            select=f"SELECT *, {_RATE} FROM c",
        ),
        "partition_metadata": """SELECT CAST(ts AS DATE) AS event_date,
  round_even(sum(strlen(event_type) + 1 + 400 * strlen(props) + 1) / 1048576.0::DOUBLE, 2) AS total_size_mb, true AS has_files, true AS is_dated
FROM events GROUP BY 1""",
        "daily_rerun_shrunk": _with(
            _WIRE,
            f"""counts AS (
  SELECT event_date AS report_date, product_id, count(*) AS view_count FROM lake
  WHERE event_type = 'view' AND event_date NOT IN (DATE '{SLICE[0]}', DATE '{SLICE[1]}') GROUP BY ALL)""",
            select="SELECT *, CAST(row_number() OVER (PARTITION BY report_date ORDER BY view_count DESC, product_id NULLS FIRST) AS INTEGER) AS rank "
            "FROM counts QUALIFY rank <= 5",
        ),
        "daily_empty_range": _with(
            _WIRE,
            select="SELECT product_id, count(*) AS view_count, 1::INTEGER AS rank, event_date AS report_date FROM lake "
            "WHERE event_date BETWEEN DATE '2031-01-01' AND DATE '2031-01-31' GROUP BY ALL",
        ),
        "session_outcomes_ties": _with(
            _CLICK.replace("ts AS event_time", "make_timestamp((epoch_us(ts) // 21600000000) * 21600000000) AS event_time"),
            _SESSIONS,
            select=_OUTCOMES,
        ),
        "band_activity_null_times": _with(
            _CLICK,
            "timed AS (SELECT * FROM click WHERE event_type <> 'signup')",
            "span AS (SELECT epoch_us(min(event_time)) AS a, epoch_us(max(event_time)) - epoch_us(min(event_time)) AS d FROM timed)",
            select="""SELECT CASE WHEN epoch_us(event_time) BETWEEN a + CAST(round_even(d * 0.4::DOUBLE, 0) AS BIGINT)
    AND a + CAST(round_even(d * 0.6::DOUBLE, 0) AS BIGINT) THEN 'peak' ELSE 'off_peak' END AS band, event_type, count(*) AS events
FROM timed, span GROUP BY ALL""",
        ),
        "time_order_inversions": _with(
            _CLICK, _FEEDS, select="SELECT feed, count(*) AS events, 0::BIGINT AS inversions FROM merged GROUP BY 1"
        ),
        "category_conversion": _with(
            _WIRE, f"c AS (SELECT category, {_VP} FROM wire GROUP BY 1)", select=f"SELECT *, {_RATE} FROM c"
        ),
        "daily_category_conversion": _with(_WIRE, _BY_LAKE, select=f"SELECT *, {_RATE} FROM by_lake"),
        "catalogue_conversion": _with(
            _CLICK,
            _STOCKED,
            f"c AS (SELECT coalesce(category, 'Other') AS category, {_VP} FROM click LEFT JOIN stocked USING (product_id) GROUP BY 1)",
            select=f"SELECT *, {_RATE} FROM c",
        ),
        "daily_catalogue_conversion": _with(_CLICK, _BY_TYPE, select=f"SELECT *, {_RATE} FROM by_type"),
        "run_statistics": _with(
            _WIRE,
            select="SELECT count(*) AS records_processed, count(DISTINCT product_id) AS unique_products, "
            "count(DISTINCT user_id) AS unique_users FROM wire",
        ),
        "top_products": _with(
            _CLICK,
            select="SELECT product_id, count(*) AS view_count FROM click WHERE event_type = 'view' GROUP BY 1 "
            "ORDER BY view_count DESC, product_id LIMIT 5",
        ),
        "daily_top_products": _with(_CLICK, _DAILY_TOP, select="SELECT * FROM top"),
        "category_conversion_ranked": _with(
            _CLICK,
            _BY_TYPE,
            f"r AS (SELECT *, {_RATE} FROM by_type)",
            select="SELECT *, CAST(row_number() OVER (PARTITION BY event_date ORDER BY conversion_rate DESC, category) AS INTEGER) AS rank FROM r",
        ),
        "category_conversion_ordered": _with(
            _CLICK,
            _STOCKED,
            f"c AS (SELECT coalesce(category, 'Other') AS category, {_VP} FROM click LEFT JOIN stocked USING (product_id) GROUP BY 1)",
            select=f"SELECT *, {_RATE} FROM c ORDER BY conversion_rate DESC, category",
        ),
        "segment_summary_lines": _with(
            _CLICK, _DISTRIBUTION, select="SELECT event_date, segment || ': ' || users AS line FROM dist"
        ),
        "top_products_report": _with(_CLICK, _DAILY_TOP, _TOP_LINES, select="SELECT * FROM top_lines"),
        "conversion_report": _with(_WIRE, _BY_LAKE, _rate_lines("by_lake"), select="SELECT * FROM rate_lines"),
        "daily_report_body": _with(
            _CLICK,
            _DAILY_TOP,
            _TOP_LINES,
            _BY_TYPE,
            _rate_lines("by_type"),
            "t AS (SELECT report_date, string_agg(line, chr(10) ORDER BY line_no) AS txt FROM top_lines GROUP BY 1)",
            "c AS (SELECT report_date, string_agg(line, chr(10) ORDER BY line_no) AS txt FROM rate_lines GROUP BY 1)",
            select="""SELECT report_date, concat_ws(chr(10),
  '<h3>Daily Analytics Report - ' || report_date || '</h3>',
  '<p>The daily processing pipeline has completed successfully.</p>',
  '<p><b>1. Top 5 Most Viewed Products:</b></p>',
  '<pre style="background: #f4f4f4; padding: 10px; border: 1px solid #ddd;">' || t.txt || '</pre>',
  '<p><b>2. Category Conversion Rates:</b></p>',
  '<pre style="background: #f4f4f4; padding: 10px; border: 1px solid #ddd;">' || c.txt || '</pre>',
  '<p><i>Full datasets available under: /lake/reports/*/report_date=' || report_date || '</i></p>') AS body
FROM t JOIN c USING (report_date)""",
        ),
        "flash_sale_alerts": _with(_CLICK, _alerts("click"), select="SELECT * FROM alerts"),
        "flash_sale_stream": _with(_STREAMED, select="SELECT * FROM closed"),
        "alert_messages": _with(
            _STREAMED,
            select="""SELECT '{"start":"' || strftime(start, '%Y-%m-%dT%H:%M:%S') || '.000Z","end":"' ||
  strftime("end", '%Y-%m-%dT%H:%M:%S') || '.000Z","product_id":"' || product_id || '","view_count":' || view_count ||
  ',"purchase_count":' || purchase_count || ',"action":"' || action || '"}' AS value FROM closed""",
        ),
        "archive_stream": _with(_WIRE, select=f"SELECT {lake_columns} FROM lake"),
        "lake_day_slice": _with(
            _WIRE,
            select=f"SELECT {lake_columns} FROM lake WHERE event_date BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'",
        ),
        "late_events": _with(
            _LATE,
            select=f"""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, product_id, event_type, event_time,
  (epoch_us(mark) - epoch_us(event_time)) / 1000000 AS behind_seconds, {_MISSED}::BIGINT AS missed_windows, batch
FROM fed JOIN marks USING (batch) WHERE event_time < mark""",
        ),
        "session_stream": _with(
            _CLICK,
            _SESSIONS,
            f"""found AS (
  SELECT user_id, min(event_time) AS session_start, max(event_time) AS last_event, count(*) AS events,
    (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000 AS duration_seconds FROM numbered GROUP BY user_id, session_no)""",
            select=f"""SELECT * FROM found WHERE epoch_us(last_event) + {GAP_SECONDS * 1_000_000}
  <= (SELECT epoch_ms(max(ts)) * 1000 - 600000000 FROM events)""",
        ),
        "archive_once": _with(
            _CLICK,
            select="""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, product_id, event_type, event_time, event_date
FROM click""",
        ),
        "archive_once_accounts": _with(
            _DELIVERED,
            select="""SELECT count(*) AS delivered, count(*) FILTER (NOT behind AND n = 1) AS archived, count(*) FILTER (NOT behind AND n > 1) AS copies,
  count(*) FILTER (behind) AS behind FROM numbered""",
        ),
        "top_products_stream": _with(
            _CLICK,
            select="SELECT product_id, count(*) AS view_count FROM click WHERE event_type = 'view' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        ),
        "open_alert_windows": _with(
            _STREAMED,
            select="""SELECT s AS start, s + INTERVAL 6 HOUR AS "end", product_id, views, purchases FROM hits
WHERE s + INTERVAL 6 HOUR > (SELECT max(event_time) FROM valid) - INTERVAL 10 MINUTE""",
        ),
        "user_totals_stream": _with(_CLICK, _DAILY_USERS, select="SELECT * FROM users"),
        "category_totals_stream": _with(_CLICK, _BY_TYPE, select=f"SELECT *, {_RATE} FROM by_type"),
        "order_violations_stream": _ORDER,
        "statistics_of_ranges": _with(
            _WIRE,
            f"asked AS ({_RANGES})",
            select="""SELECT first_day, last_day, count(DISTINCT event_date) AS days, count(event_date) AS records_processed,
  count(DISTINCT product_id) AS products, count(DISTINCT user_id) AS users, true AS products_close, true AS users_close
FROM asked LEFT JOIN lake ON event_date BETWEEN first_day AND last_day GROUP BY ALL""",
        ),
        "lake_date_forms": _with(
            _WIRE,
            select=f"""SELECT unnest(['text', 'unpadded', 'date', 'datetime']) AS form, event_date, count(*) AS events
FROM lake WHERE event_date BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}' GROUP BY event_date""",
        ),
        "partition_presence": _with(
            _WIRE,
            f"days AS (SELECT CAST(unnest(generate_series(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY)) AS DATE) AS event_date)",
            select="""SELECT event_date, 'event_date=' || event_date AS partition,
  event_date IN (SELECT event_date FROM lake) AS "exists" FROM days""",
        ),
        "json_roundtrip": _with(
            _CLICK,
            _DAILY_USERS,
            select=f"SELECT user_id, views, purchases, {_three_way(MIN_VIEWS)}, event_date AS report_date FROM users",
        ),
        "json_directory_top_products": _with(
            _WIRE,
            select="SELECT product_id, count(*) AS view_count FROM wire WHERE event_type = 'view' GROUP BY 1 "
            "ORDER BY view_count DESC, product_id NULLS FIRST LIMIT 5",
        ),
        "csv_roundtrip": _with(
            _CLICK, _DAILY_TOP, select="SELECT product_id, view_count, rank, event_date AS report_date FROM top"
        ),
        "text_roundtrip": _with(_CLICK, _DAILY_TOP, _TOP_LINES, select="SELECT line, report_date FROM top_lines"),
        "segments_rerun": _with(
            _CLICK, _DAILY_USERS, select=f"SELECT event_date AS report_date, user_id, views, purchases, {_TWO_WAY} FROM users"
        ),
        "daily_reports": _with(
            _WIRE,
            f"users AS (SELECT event_date, user_id, {_VP} FROM lake GROUP BY ALL)",
            f"segments AS (SELECT *, {_three_way(MIN_VIEWS)} FROM users)",
            "dist AS (SELECT event_date, segment, count(*) AS users FROM segments GROUP BY ALL)",
            f"counts AS (SELECT event_date, product_id, {_VP} FROM lake GROUP BY ALL)",
            """top AS (SELECT event_date, coalesce(product_id, 'None') AS product_id, views AS view_count,
  row_number() OVER (PARTITION BY event_date ORDER BY views DESC, product_id NULLS FIRST) AS rank
  FROM counts WHERE views > 0 QUALIFY rank <= 5)""",
            _TOP_LINES.replace("FROM click", "FROM lake"),
            _BY_LAKE,
            _rate_lines("by_lake"),
            select="""SELECT 'segment_summary' AS report, event_date AS report_date, segment || ': ' || users AS line FROM dist
UNION ALL SELECT 'top_products_text', report_date, line FROM top_lines
UNION ALL SELECT 'category_conversion_text', report_date, line FROM rate_lines""",
        ),
        "batch_reports": _with(
            _WIRE,
            f"u AS (SELECT user_id, {_VP} FROM wire GROUP BY 1)",
            select=f"SELECT *, {_three_way(5)}, DATE '2024-02-01' AS report_date FROM u",
        ),
        "enrich_category": _with(
            _CLICK,
            _STOCKED,
            select="SELECT event_id, product_id, coalesce(category, 'Other') AS category FROM click LEFT JOIN stocked USING (product_id)",
        ),
        "enrich_category_as_of": _with(
            _DATED,
            select=f"""SELECT event_id, product_id, CASE WHEN p_type IS NULL THEN 'Other' WHEN ts < renamed THEN p_type
  WHEN p_size > 40 AND ts >= renamed + INTERVAL '{LEAVING}' THEN 'Other' ELSE p_brand END AS category FROM dated""",
        ),
        "user_sessions": _with(
            _CLICK,
            _SESSIONS,
            select="""SELECT user_id, min(event_time) AS session_start, max(event_time) AS last_event, count(*) AS events,
  (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000 AS duration_seconds
FROM numbered GROUP BY user_id, session_no""",
        ),
        "session_outcomes": _with(
            _CLICK,
            _SESSIONS,
            select=_OUTCOMES,
        ),
        "event_mix": _with(
            _CLICK,
            "counts AS (SELECT date_trunc('hour', event_time) AS bucket, event_type, count(*) AS events FROM click GROUP BY ALL)",
            select="SELECT *, events / sum(events) OVER (PARTITION BY bucket) AS share FROM counts",
        ),
        "event_mix_drift": _with(
            _CLICK,
            "counts AS (SELECT event_date AS bucket, event_type, count(*) AS n FROM click GROUP BY ALL)",
            "wanted(event_type, w) AS (VALUES ('view', 0.7::DOUBLE), ('add_to_cart', 0.25::DOUBLE), ('purchase', 0.05::DOUBLE))",
            "expected AS (SELECT bucket, event_type, w FROM (SELECT DISTINCT bucket FROM counts), wanted)",
            """merged AS (
  SELECT bucket, event_type, CAST(coalesce(n, 0) AS BIGINT) AS events, coalesce(w, 0::DOUBLE) AS expected_share
  FROM counts FULL JOIN expected USING (bucket, event_type))""",
            "shares AS (SELECT *, events / sum(events) OVER (PARTITION BY bucket) AS share FROM merged)",
            select="SELECT *, share - expected_share AS drift FROM shares",
        ),
        "band_activity": _with(
            _CLICK,
            "span AS (SELECT epoch_us(min(event_time)) AS a, epoch_us(max(event_time)) - epoch_us(min(event_time)) AS d FROM click)",
            select="""SELECT CASE WHEN epoch_us(event_time) BETWEEN a + CAST(round_even(d * 0.4::DOUBLE, 0) AS BIGINT)
    AND a + CAST(round_even(d * 0.6::DOUBLE, 0) AS BIGINT) THEN 'peak' ELSE 'off_peak' END AS band, event_type, count(*) AS events
FROM click, span GROUP BY ALL""",
        ),
        "merge_feeds": _with(_CLICK, _FEEDS, select="SELECT * FROM merged"),
        "time_ordered_feed": _with(_CLICK, _FEEDS, select="SELECT * FROM merged"),
        "dq_missing_fields": _with(
            _WIRE,
            select=" UNION ALL ".join(
                f"SELECT '{f}' AS field, count(*) FILTER (\"{f}\" IS NULL) AS missing FROM wire"
                for f in ("event_id", "user_id", "product_id", "event_type", "category", "timestamp")
            ),
        ),
        "dq_rule_counts": _with(
            _WIRE,
            select="""SELECT 'user_id_in_range' AS rule, count(*) FILTER (CAST(user_id AS BIGINT) NOT BETWEEN 5 AND 1000) AS violations FROM wire
UNION ALL SELECT 'event_type_known', count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) FROM wire
UNION ALL SELECT 'timestamp_in_range', count(*) FILTER ("timestamp" IS NOT NULL AND (event_time IS NULL OR
  event_time NOT BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00')) FROM wire""",
        ),
        "dq_unknown_products": _with(
            _CLICK,
            _STOCKED,
            select="SELECT product_id, count(*) AS events FROM click WHERE product_id NOT IN (SELECT product_id FROM stocked) GROUP BY 1",
        ),
        "dq_duplicate_ids": """WITH deliveries AS (
  SELECT event_id FROM events
  UNION ALL SELECT event_id FROM events WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT event_id FROM events WHERE event_type = 'error')
SELECT event_id, count(*) AS copies FROM deliveries GROUP BY 1 HAVING count(*) > 1""",
        "dq_category_mismatch": _with(
            _WIRE,
            select="""SELECT product_id, category, count(*) AS events, p_type AS expected_category
FROM wire JOIN part ON CAST(p_partkey AS VARCHAR) = product_id WHERE category IS DISTINCT FROM p_type GROUP BY ALL""",
        ),
        "dq_order_violations": _ORDER,
    }


_FEEDS = """merged AS (
  SELECT CASE event_type WHEN 'signup' THEN 'account' WHEN 'error' THEN 'faults' ELSE 'shop' END AS feed, event_id, event_time,
         CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN product_id END AS product_id
  FROM click)"""
