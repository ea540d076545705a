"""The same queries as plain SQL over the given tables, written independently of the operators."""

from __future__ import annotations

from tidemark import settings as S
from tidemark.sources.bindings import TYPED_UPLOAD

_WORDS = ", ".join(f"'{w}'" for w in (*S.STOPWORDS, *S.EXTRA_STOPWORDS))
_LENGTHS = {"1h": "1 HOUR", "6h": "6 HOUR", "24h": "24 HOUR", "1d": "1 DAY", "7d": "7 DAY"}


def _at(key: str) -> str:
    return f"(TIMESTAMP '2024-01-01' + to_seconds(({key}) * 104729 % 2592000))"


def _iso(key: str) -> str:
    return f"strftime({_at(key)}, '%Y-%m-%dT%H:%M:%SZ')"


def _clean(text: str) -> str:
    no_links = f"lower(regexp_replace({text}, 'https?://\\S+|www\\.\\S+', ' ', 'g'))"
    letters = f"regexp_replace({no_links}, '[^a-z0-9\\s#@]', ' ', 'g')"
    return f"trim(regexp_replace({letters}, '\\s{{2,}}', ' ', 'g'), ' ')"


def _windows(events: str, labels, sourced: bool) -> str:
    source, keys = ("source", "keyword, source") if sourced else ("'__all__'", "keyword")
    parts = []
    for label in labels:
        span = f"INTERVAL {_LENGTHS[label]}"
        start = f"time_bucket({span}, \"timestamp\", TIMESTAMP '1970-01-01')"
        parts.append(
            f"SELECT keyword, {start} AS window_start, {start} + {span} AS window_end, "
            f"count(*) AS frequency, '{label}' AS \"window\", {source} AS source "
            f"FROM {events} WHERE \"timestamp\" IS NOT NULL GROUP BY {keys}, {start}"
        )
    return " UNION ALL ".join(parts)


def _trend(freq: str, emerging: str = "z > 2") -> str:
    return f"""
    SELECT keyword, "window", window_start, window_end, frequency, source, growth_rate,
           growth_rate AS velocity, growth_rate - before AS acceleration, z AS z_score,
           CASE WHEN abs(z) > 2.5 THEN 1 ELSE 0 END AS is_anomaly,
           CASE WHEN z > 2.5 THEN 'up' WHEN z < -2.5 THEN 'down' ELSE 'none' END AS spike_direction,
           CASE WHEN z > 3 AND "window" = '1h' THEN 'viral' WHEN {emerging} THEN 'emerging'
                WHEN growth_rate < -0.5 THEN 'declining' ELSE 'stable' END AS trend_label
    FROM (
      SELECT *, CASE WHEN s IS NULL OR s < 1e-12 OR growth_rate IS NULL THEN 0.0
                     ELSE round((growth_rate - m) / s, 9) END AS z
      FROM (
        SELECT *, lag(growth_rate) OVER (PARTITION BY keyword, "window", source ORDER BY window_start) AS before,
               avg(growth_rate) OVER (PARTITION BY keyword, "window", source) AS m,
               stddev_samp(growth_rate) OVER (PARTITION BY keyword, "window", source) AS s
        FROM (
          SELECT *, CAST(frequency - p AS DOUBLE) / (CAST(p AS DOUBLE) + 1) AS growth_rate
          FROM (SELECT *, lag(frequency) OVER (PARTITION BY keyword, "window", source ORDER BY window_start) AS p
                FROM {freq}))))"""


_FLOAT_FEATURES = ("freq_1h", "freq_6h", "growth_rate_1h", "growth_rate_24h", "z_score_1h")


def _each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(c=c) for c in _FLOAT_FEATURES)


def _pick(label: str, column: str) -> str:
    return f"max(CASE WHEN \"window\" = '{label}' THEN {column} END)"


def _forecast(limit: str) -> str:
    return f"""
    SELECT keyword, last_ts + to_hours(step) AS predicted_at, '24h' AS forecast_period,
           yhat AS predicted_freq, greatest(yhat - band, 0) AS lower_bound, yhat + band AS upper_bound,
           trend_class,
           greatest(0.1, least(0.95, 1 - avg((yhat + band - greatest(yhat - band, 0)) / greatest(yhat, 1))
             OVER (PARTITION BY keyword))) AS confidence
    FROM (
      SELECT *, greatest(yhat * 0.15, 1.0) AS band
      FROM (
        SELECT keyword, last_ts, trend_class, step, greatest(last_y + delta * step, 0.0) AS yhat
        FROM (
          SELECT keyword, max(ts) AS last_ts, max_by(y, ts) AS last_y,
                 CASE WHEN count(*) > 1 THEN (max_by(y, ts) - min_by(y, ts)) / (count(*) - 1) ELSE 0.0 END AS delta,
                 max_by(trend_label, ts) AS trend_class
          FROM (SELECT keyword, "timestamp" AS ts, CAST(freq_1h AS DOUBLE) AS y, trend_label,
                       row_number() OVER (PARTITION BY keyword ORDER BY "timestamp" DESC) AS rn
                FROM feat {limit})
          WHERE rn <= 12 GROUP BY keyword)
        CROSS JOIN (SELECT CAST(unnest(range(1, 25)) AS INTEGER) AS step)))"""


_SUMMARY_PARTS = (
    ("viral", "exploding right now"),
    ("emerging", "gaining steady momentum"),
    ("stable", "consistent activity"),
    ("declining", "losing steam"),
)

_CTES: dict[str, tuple[str, str]] = {}


def _cte(name: str, needs: str, sql: str) -> None:
    _CTES[name] = (needs, sql)


_cte("posts", "", f"""
    SELECT CAST(doc_id AS VARCHAR) AS id, text, {_at('doc_id')} AS "timestamp", source,
           CAST(n_chars AS INTEGER) AS engagement, lang FROM documents""")
_cte("cleaned", "posts", f"SELECT *, {_clean('text')} AS clean_text FROM posts WHERE lang IS NULL OR lang = 'en'")
_cte("tok", "cleaned", f"""
    SELECT * FROM (SELECT id, "timestamp", source, unnest(regexp_split_to_array(clean_text, '\\s+')) AS keyword FROM cleaned)
    WHERE length(keyword) >= 3 AND regexp_matches(keyword, '[a-z]')
      AND NOT regexp_full_match(keyword, '[\\d\\W]+') AND keyword NOT IN ({_WORDS})""")
_cte("part_mentions", "", """
    SELECT unnest(string_split(p_name, ' ')) AS keyword, l_shipdate AS "timestamp", l_returnflag AS source
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
_cte("event_mentions", "", """
    SELECT event_type AS keyword, ts AS "timestamp", 'group' || CAST(user_id % 4 AS VARCHAR) AS source FROM events""")
_cte("gfreq", "tok", _windows("tok", S.WINDOWS, False))
_cte("sfreq", "tok", _windows("tok", S.WINDOWS, True))
_cte("freq", "gfreq sfreq", "SELECT * FROM gfreq UNION ALL SELECT * FROM sfreq")
_cte("trend", "freq", _trend("freq"))
_cte("gtrend", "gfreq", _trend("gfreq"))
_cte("board", "trend", 'SELECT *, window_start AS "timestamp" FROM trend')
_cte("gboard", "gtrend", 'SELECT *, window_start AS "timestamp" FROM gtrend')
_cte("metrics", "gtrend", f"""
    SELECT keyword, window_start AS "timestamp",
           {_pick('1h', 'growth_rate')} AS growth_rate_1h, {_pick('24h', 'growth_rate')} AS growth_rate_24h,
           {_pick('1h', 'z_score')} AS z_score_1h, {_pick('24h', 'z_score')} AS z_score_24h,
           {_pick('24h', 'velocity')} AS velocity, {_pick('24h', 'acceleration')} AS acceleration,
           max(is_anomaly) AS is_anomaly,
           CASE max(CASE trend_label WHEN 'viral' THEN 4 WHEN 'emerging' THEN 3 WHEN 'declining' THEN 2 ELSE 1 END)
                WHEN 4 THEN 'viral' WHEN 3 THEN 'emerging' WHEN 2 THEN 'declining' ELSE 'stable' END AS trend_label
    FROM gtrend GROUP BY ALL""")
_cte("wide", "gfreq", """
    SELECT keyword, window_start AS "timestamp", """ + ", ".join(
    f"CAST(coalesce({_pick(w, 'frequency')}, 0) AS BIGINT) AS freq_{w}" for w in S.WINDOWS
) + " FROM gfreq GROUP BY ALL")
_cte("diversity", "sfreq", """
    SELECT keyword, window_start AS "timestamp", count(DISTINCT source) AS source_diversity FROM sfreq GROUP BY ALL""")
_cte("feat", "wide metrics diversity", """
    SELECT keyword, "timestamp", freq_1h, freq_6h, freq_24h, freq_7d, growth_rate_1h, growth_rate_24h,
           z_score_1h, z_score_24h, velocity, acceleration, CAST(0 AS FLOAT) AS avg_sentiment,
           CAST(coalesce(source_diversity, 0) AS INTEGER) AS source_diversity,
           coalesce(is_anomaly, 0) AS is_anomaly, coalesce(trend_label, 'stable') AS trend_label
    FROM wide LEFT JOIN metrics USING (keyword, "timestamp") LEFT JOIN diversity USING (keyword, "timestamp")""")
_cte("medians", "feat", "SELECT " + _each("quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}") + " FROM feat")
_cte("filled", "feat medians", "SELECT keyword, feat.\"timestamp\", " + _each(
    "coalesce(CAST(feat.{c} AS DOUBLE), (SELECT {c} FROM medians), 0) AS {c}") + " FROM feat")
_cte("moments", "filled", "SELECT " + _each("avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}") + " FROM filled")
_cte("zs", "filled moments", "SELECT keyword, \"timestamp\", " + _each(
    "CASE WHEN s_{c} < 1e-12 THEN 0 ELSE abs(round(({c} - m_{c}) / s_{c}, 9)) END AS {c}") + " FROM filled, moments")
_cte("quartiles", "filled", "SELECT " + _each(
    "quantile_cont({c}, 0.25) AS l_{c}, quantile_cont({c}, 0.75) AS h_{c}") + " FROM filled")
_cte("zflag", "zs", "SELECT keyword, \"timestamp\", " + _each("{c} > 2.5", " OR ")
     + " AS is_anomaly, greatest(" + _each("{c}") + ") AS anomaly_score FROM zs")
_cte("iqrflag", "filled quartiles", "SELECT keyword, \"timestamp\", " + _each(
    "{c} < l_{c} - 1.5 * (h_{c} - l_{c}) OR {c} > h_{c} + 1.5 * (h_{c} - l_{c})", " OR ")
     + " AS is_anomaly FROM filled, quartiles")
_cte("cand", "feat", """
    SELECT keyword, CAST(sum(freq_1h) AS BIGINT) AS total_freq FROM feat GROUP BY keyword
    ORDER BY total_freq DESC, keyword LIMIT 20""")
_cte("pred20", "feat cand", _forecast("WHERE keyword IN (SELECT keyword FROM cand)"))
_cte("pred", "feat", _forecast(""))
_cte("terms", "tok", "SELECT id, keyword, count(*) AS tf FROM tok GROUP BY ALL")
_cte("tfidf", "terms cleaned", """
    SELECT keyword, round(CAST(sum(tf * tf) AS DOUBLE) / CAST(sum(tf) AS DOUBLE) * CASE WHEN count(*) >= 2
             THEN ln(((SELECT count(*) FROM cleaned) + 1) / CAST(count(*) + 1 AS DOUBLE)) ELSE 0 END, 6) AS avg_tfidf_score
    FROM terms GROUP BY keyword""")
_cte("top500", "tok", """
    SELECT keyword, count(*) AS frequency FROM tok GROUP BY keyword ORDER BY frequency DESC, keyword LIMIT 500""")
_cte("tweets", "", f"""
    SELECT 'tw_' || CAST(doc_id AS VARCHAR) AS id, text, {_iso('doc_id')} AS created_at,
           CAST(user_id AS VARCHAR) AS author_id, CASE WHEN lang <> 'es' THEN lang END AS lang, source,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS retweet_count,
           CAST(floor(value) AS INTEGER) AS like_count,
           CASE WHEN user_id % 3 > 0 THEN CAST(user_id AS INTEGER) END AS reply_count, event_type
    FROM documents LEFT JOIN events ON event_id = doc_id""")
_cte("forum", "", """
    SELECT 'rd_' || CAST(conv_id AS VARCHAR) || '_' || CAST(turn AS VARCHAR) AS id,
           CASE WHEN (conv_id * 8 + turn) % 5 = 0 THEN concat_ws(' ', role, text) ELSE role END AS title,
           CASE WHEN (conv_id * 8 + turn) % 5 <> 0 THEN text END AS selftext, 'r' || CAST(conv_id % 7 AS VARCHAR) AS subreddit,
           CAST(turn * 3 AS INTEGER) AS score, CASE WHEN role = 'user' THEN CAST(turn AS INTEGER) END AS num_comments,
           1704067200 + (conv_id * 8 + turn) * 104729 % 2592000 AS created_utc,
           'https://forum.example/' || CAST(conv_id AS VARCHAR) AS url, 'reddit' AS data_source
    FROM conversations""")
_NEWS_ID = "'n_' || substr(sha1(url), 1, 14)"
_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"
_cte("news", "", f"""
    SELECT {_NEWS_ID} AS id, {_TITLE} AS title, regexp_replace(html, '<[^>]*>', ' ', 'g') AS summary,
           {_iso('page_id')} AS published, {_HOST} AS source, url AS link FROM pages""")
_cte("npost_t", "tweets", """
    SELECT id, text, created_at AS "timestamp", 'twitter' AS source,
           coalesce(like_count, 0) + coalesce(retweet_count, 0) + coalesce(reply_count, 0) AS engagement,
           coalesce(lang, 'en') AS lang FROM tweets""")
_cte("npost_f", "forum", """
    SELECT id, concat_ws(' ', title, selftext) AS text, CAST(created_utc AS VARCHAR) AS "timestamp",
           'reddit' AS source, coalesce(score, 0) + coalesce(num_comments, 0) AS engagement, 'en' AS lang FROM forum""")
_cte("npost_n", "news", """
    SELECT id, concat_ws(' ', title, summary) AS text, published AS "timestamp", 'news' AS source,
           CAST(0 AS INTEGER) AS engagement, 'en' AS lang FROM news""")
_cte("unified", "npost_t npost_f npost_n", """
    SELECT * FROM (SELECT * FROM npost_t UNION ALL SELECT * FROM npost_f UNION ALL SELECT * FROM npost_n)
    WHERE text IS NOT NULL AND trim(text, ' ') <> ''""")
_cte("entries", "", f"""
    SELECT page_id, {_TITLE} AS title, {_HOST} AS source, url AS link, html AS summary, {_at('page_id')} AS moment,
           page_id % 5 AS k FROM pages""")
_cte("items", "", f"""
    SELECT list_filter(regexp_split_to_array({_clean('text')}, '\\s+'), lambda x: x <> '') AS w FROM benchmark""")
_cte("dict", "items", """
    SELECT DISTINCT * FROM (
      SELECT lower(n_name) AS entity, 'GPE' AS label FROM nation UNION ALL SELECT lower(r_name), 'GPE' FROM region UNION ALL
      SELECT w, 'EVENT' FROM (SELECT unnest(w) AS w FROM items) WHERE regexp_full_match(w, '[a-z]{8,}') UNION ALL
      SELECT w[1] || ' ' || w[2], 'PERSON' FROM items WHERE len(w) > 1 UNION ALL
      SELECT w[-2] || ' ' || w[-1], 'ORG' FROM items WHERE len(w) > 1)""")
_cte("runs", "cleaned", """
    SELECT id, unnest(range(1, len(ws) + 1)) AS pos, unnest(ws) AS entity FROM
      (SELECT id, list_filter(regexp_split_to_array(clean_text, '\\s+'), lambda x: x <> '') AS ws FROM cleaned)""")
_cte("pairs", "runs", """
    SELECT id, pos, entity FROM runs UNION ALL
    SELECT id, pos, entity || ' ' || lead(entity) OVER (PARTITION BY id ORDER BY pos) FROM runs""")
_cte("tagged", "pairs dict", """
    SELECT id, string_agg(label || ':' || entity, ',' ORDER BY pos, entity, label) AS entities
    FROM pairs JOIN dict USING (entity) GROUP BY id""")
_cte("arrivals", "cleaned", """
    SELECT id, "timestamp", least(CAST(floor(epoch("timestamp" - TIMESTAMP '2024-01-01') / 691200) AS BIGINT)
        + CASE WHEN id::BIGINT % 9 = 0 THEN 1 + id::BIGINT % 2 ELSE 0 END, 3) AS batch FROM cleaned""")
_cte("marks", "arrivals", """
    SELECT b AS batch, (SELECT max("timestamp") FROM arrivals WHERE batch < b) - INTERVAL 2 DAY AS watermark
    FROM (SELECT unnest(range(0, 5)) AS b)""")
_cte("typed", "", "SELECT event_id, " + ", ".join(
    f'{sql} AS "{name.strip().lower()}"' for name, sql in TYPED_UPLOAD.items()) + " FROM events")


def _number(column: str) -> str:
    value = f"TRY_CAST(trim(regexp_replace({column}, '[,%+]', '', 'g')) AS DOUBLE)"
    return f"CASE WHEN {value} IS NULL OR isnan({value}) THEN 0.0 ELSE {value} END"


_LABEL = """CASE trim(lower(coalesce(trend_label, 'stable'))) WHEN 'trending' THEN 'viral' WHEN 'hot' THEN 'viral'
    WHEN 'growing' THEN 'emerging' WHEN 'rising' THEN 'emerging' WHEN 'normal' THEN 'stable' WHEN 'flat' THEN 'stable'
    WHEN 'dropping' THEN 'declining' WHEN 'falling' THEN 'declining' WHEN 'nan' THEN 'stable' WHEN '' THEN 'stable'
    ELSE trim(lower(coalesce(trend_label, 'stable'))) END"""
_UPLOAD_TIME = "coalesce(TRY_CAST(\"timestamp\" AS TIMESTAMP), TIMESTAMP '2024-02-01')"
_FLAG = "CAST(coalesce(TRY_CAST(is_anomaly AS DOUBLE), 0) AS INTEGER)"


def _with(needs: str, select: str) -> str:
    """A query with every table expression it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in _CTES[name][0].split():
                add(need)
            ordered.append(name)

    for name in needs.split():
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n][1]})" for n in ordered) + "\n" + select


_TREND_COLUMNS = (
    'keyword, "window", window_start, window_end, frequency, source, growth_rate, velocity, acceleration, '
    "floor(z_score * 1e6 + 0.5) / 1e6 AS z_score, is_anomaly, spike_direction, trend_label"
)
_BOARD_COLUMNS = _TREND_COLUMNS + ', "timestamp"'
_FREQ_COLUMNS = 'keyword, window_start, window_end, frequency, "window"'
_PRED_COLUMNS = (
    "keyword, predicted_at, forecast_period, predicted_freq, lower_bound, upper_bound, trend_class, "
    "round(CAST(CAST(confidence AS FLOAT) AS DOUBLE), 4) AS confidence"
)
_FEATURE_ROUNDED = '* REPLACE (floor(z_score_1h * 1e6 + 0.5) / 1e6 AS z_score_1h, floor(z_score_24h * 1e6 + 0.5) / 1e6 AS z_score_24h)'
_BOARD_TIE = 'keyword, "timestamp", "window", source'


def _simple_window(label: str) -> str:
    return _with("tok", f"SELECT {_FREQ_COLUMNS} FROM ({_windows('tok', [label], False)})")


def _sliding(size: int, slide: int, label: str) -> str:
    """Every window of `size` hours, `slide` hours apart, that holds a mention."""
    start = f"time_bucket(INTERVAL {slide} HOUR, \"timestamp\", TIMESTAMP '1970-01-01') - to_hours(CAST(back * {slide} AS INTEGER))"
    return f"""SELECT keyword, s AS window_start, s + INTERVAL {size} HOUR AS window_end, count(*) AS frequency,
        '{label}' AS "window" FROM (SELECT keyword, {start} AS s FROM tok
        CROSS JOIN (SELECT unnest(range(0, {size // slide})) AS back)) GROUP BY ALL"""


def _profile() -> str:
    columns = ["id", "text", "created_at", "author_id", "lang", "source", "retweet_count", "like_count",
               "reply_count", "hashtags", "data_source"]
    present = {"hashtags": "event_type", "data_source": "'twitter'"}
    return " UNION ALL ".join(
        f"SELECT count(*) AS row_count, CAST({len(columns)} AS INTEGER) AS column_count, '{c}' AS \"column\", "
        f"count(*) - count({present.get(c, c)}) AS null_count, "
        f"round((count(*) - count({present.get(c, c)})) / CAST(count(*) AS DOUBLE), 4) AS null_fraction FROM tweets"
        for c in columns
    )


def _bucket(keyword: str) -> str:
    """The first eight hex digits of the MD5 as a number, modulo the dimensions."""
    digits = f"list_transform(string_split(left(md5({keyword}), 8), ''), lambda c: strpos('0123456789abcdef', c)::BIGINT - 1)"
    return f"CAST(list_reduce({digits}, lambda a, b: a * 16 + b) % {S.TFIDF_DIMENSIONS} AS INTEGER)"


def _cut_lines() -> str:
    """One line in sixteen is cut off."""
    return """SELECT source, posts, "lines", first_line, last_line
        FROM (SELECT source, count(*) AS posts FROM unified WHERE left(md5(id), 1) <> '0' GROUP BY source) FULL JOIN
             (SELECT source, count(*) AS "lines", min('{"id":"' || id) AS first_line, max('{"id":"' || id) AS last_line
              FROM (SELECT source, id FROM npost_t UNION ALL SELECT source, id FROM npost_f UNION ALL SELECT source, id FROM npost_n)
              WHERE left(md5(id), 1) = '0' GROUP BY source) USING (source)"""


def _percent(value: str) -> str:
    return f"(CASE WHEN round({value} * 100, 1) >= 0 THEN '+' ELSE '' END || printf('%.1f', round({value} * 100, 1)) || '%')"


def _summary() -> str:
    counted = ", ".join(f"count(*) FILTER (lower(trend_label) = '{n}') AS {n}" for n, _ in _SUMMARY_PARTS)
    told = ", ".join(
        f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || ' {n}' || CASE WHEN {n} > 1 THEN ' trends' ELSE ' trend' END || ' - {t}' END"
        for n, t in _SUMMARY_PARTS
    )
    names = ", ".join(n for n, _ in _SUMMARY_PARTS)
    return f"""SELECT concat_ws(' ', 'Tracking ' || CAST(keywords AS VARCHAR) || ' keywords in this snapshot.', {told},
        CASE WHEN anomalies > 0 THEN CAST(anomalies AS VARCHAR) || ' anomalies detected - unusual spikes worth investigating' END)
        AS summary, keywords, {names}, anomalies
        FROM (SELECT count(DISTINCT keyword) AS keywords, {counted}, CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM board)"""


def _last_known(column: str) -> str:
    return f"max_by({column}, predicted_at) FILTER ({column} IS NOT NULL) AS {column}"


def _snapshot_days(factor_of_second: str) -> str:
    base = _windows("tok", ["24h"], False)
    return (
        f"SELECT keyword, window_start, frequency, '2024-01-01' AS dt FROM ({base}) UNION ALL "
        f"SELECT keyword, window_start, {factor_of_second} * frequency AS frequency, '2024-01-02' AS dt FROM ({base})"
    )


_EXPORT = """SELECT keyword, "timestamp", "window", frequency, growth_rate, trend_label FROM gboard
    WHERE trend_label IN ('viral', 'emerging') AND frequency >= 5 AND growth_rate >= 0"""
_PRIORITY = "round({change}, 6) AS change_pct"
_FLAT = "event_id % 4 = 0"
_LIKES = "CAST(floor(value) AS INTEGER)"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_jsonl_lenient": _with("unified", _cut_lines()),
    "scan_jsonl": _with("unified", "SELECT * FROM unified"),
    "sink_jsonl": _with("forum", "SELECT * FROM forum"),
    "sink_parquet_partitioned": _with("gfreq", "SELECT * FROM gfreq"),
    "partition_pruned_read": _with("event_mentions", """
        SELECT keyword, "timestamp", source FROM event_mentions WHERE source = 'group1'
        AND "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-16'"""),
    "sink_dt_snapshot": _with("tok", _snapshot_days("-1")),
    "sink_csv": _with("forum", "SELECT id, title, score, created_utc, url FROM forum"),
    "scan_csv": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
    "board_load": _with("feat typed part_mentions", """
        SELECT keyword, "timestamp", freq_24h AS frequency, growth_rate_24h AS growth_rate,
               floor(z_score_24h * 1e6 + 0.5) / 1e6 AS z_score, trend_label FROM feat UNION ALL
        SELECT keyword, TRY_CAST("timestamp" AS TIMESTAMP), NULL, NULL, NULL, lower(trim(trend_label)) FROM typed UNION ALL
        SELECT DISTINCT keyword, CAST(NULL AS TIMESTAMP), NULL, NULL, NULL, lower(source) FROM part_mentions"""),
    "board_load_trends": _with("trend", """
        SELECT keyword, window_start AS "timestamp", "window", nullif(source, '__all__') AS source, frequency,
               CASE WHEN source <> '__all__' THEN growth_rate END AS growth_rate, trend_label FROM trend"""),
    "export_board": _with("gboard", _EXPORT),
    "export_board_json": _with("gboard", _EXPORT),
    # normalisation
    "normalize_tweets": _with("npost_t", "SELECT * FROM npost_t"),
    "normalize_forum": _with("npost_f", "SELECT * FROM npost_f"),
    "normalize_news": _with("npost_n", "SELECT * FROM npost_n"),
    "unified_posts": _with("unified", "SELECT * FROM unified"),
    "infer_source": """SELECT 'twitter' AS source, count(*) AS records FROM documents UNION ALL
        SELECT 'reddit', count(*) FROM conversations UNION ALL SELECT 'news', count(*) FROM pages""",
    "flatten_nested_posts": f"""
        SELECT CAST(event_id AS VARCHAR) AS id, props AS text, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               CAST(user_id AS VARCHAR) AS author_id,
               CASE WHEN event_id % 5 > 0 THEN 'de' WHEN {_FLAT} THEN NULL ELSE 'en' END AS lang,
               CASE WHEN event_id % 7 > 0 THEN 'app' WHEN {_FLAT} THEN NULL ELSE 'Twitter Web App' END AS source,
               CASE WHEN {_FLAT} THEN {_LIKES} ELSE {_K} END AS retweet_count, {_LIKES} AS like_count,
               CASE WHEN event_id % 2 = 0 THEN {_LIKES} ELSE 0 END AS reply_count,
               CASE WHEN {_FLAT} THEN 'a,b' WHEN event_id % 3 = 0 THEN 'u' || CAST(user_id AS VARCHAR)
                    ELSE event_type || ',u' || CAST(user_id AS VARCHAR) END AS hashtags,
               'twitter' AS data_source FROM events""",
    "coerce_ints": _with("typed", """
        SELECT CAST(event_id AS VARCHAR) AS id, '' AS title, '' AS selftext, growth_rate AS subreddit,
               CASE WHEN regexp_full_match(frequency, '[+-]?\\d+') THEN CAST(frequency AS BIGINT) ELSE 0 END AS score,
               CASE WHEN regexp_full_match(is_anomaly, '[+-]?\\d+') THEN CAST(is_anomaly AS BIGINT) ELSE 0 END AS num_comments,
               CASE WHEN regexp_full_match(growth_rate, '[+-]?\\d+') THEN CAST(growth_rate AS BIGINT) ELSE 0 END AS created_utc,
               '' AS url, 'reddit' AS data_source FROM typed"""),
    "link_id": f"SELECT page_id, {_NEWS_ID} AS link_id FROM pages",
    "truncate_text": """SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text
        ELSE substr(text, 1, 997) || '...' END AS text FROM documents""",
    "parse_feed_dates": _with("entries", """
        SELECT link, CASE k WHEN 1 THEN strftime(moment - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ')
            WHEN 2 THEN strftime(moment, '%Y-%m-%dT00:00:00Z') WHEN 4 THEN 'soon'
            ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS published FROM entries"""),
    "parse_feed_dates_wallclock": _with("entries", """
        SELECT link, CASE k WHEN 2 THEN strftime(moment, '%Y-%m-%dT00:00:00Z') WHEN 4 THEN 'soon'
            ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS published FROM entries"""),
    "feed_to_news": _with("entries", """
        SELECT 'n_' || substr(sha1(link), 1, 14) AS id, title,
            CASE WHEN length(summary) <= 1000 THEN summary ELSE substr(summary, 1, 997) || '...' END AS summary,
            CASE k WHEN 2 THEN strftime(moment, '%Y-%m-%dT00:00:00Z') WHEN 4 THEN 'soon'
            ELSE strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS published, source, link, 'news' AS data_source FROM entries"""),
    "dedup_links": _with("entries", """
        SELECT link, title, source, page_id, feed FROM (
          SELECT *, row_number() OVER (PARTITION BY link ORDER BY feed, page_id) AS rn FROM (
            SELECT link, title, source, page_id, CAST(0 AS INTEGER) AS feed FROM entries UNION ALL
            SELECT 'https://' || source, title, source, page_id, 1 FROM entries UNION ALL
            SELECT 'https://' || source, 'late', source, page_id, 2 FROM entries)) WHERE rn = 1"""),
    "ingest_counts": """SELECT 'twitter' AS source, count(*) AS records FROM documents UNION ALL
        SELECT 'reddit', count(*) FROM conversations UNION ALL SELECT 'news', count(*) FROM pages UNION ALL
        SELECT 'total', (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations) + (SELECT count(*) FROM pages)""",
    "align_schema": """SELECT CAST(doc_id AS VARCHAR) AS id, text, CAST(NULL AS VARCHAR) AS clean_text, source,
        CAST(n_chars AS INTEGER) AS engagement, lang FROM documents""",
    "normalize_timestamps": """SELECT event_id, CASE event_id % 5 WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
        WHEN 4 THEN NULL ELSE date_trunc('second', ts) END AS "timestamp" FROM events""",
    # text
    "clean_text": _with("cleaned", "SELECT id, clean_text FROM cleaned"),
    "lang_filter": _with("posts", "SELECT id, lang, source FROM posts WHERE lang IS NULL OR lang = 'en'"),
    "tokenize": _with("cleaned", f"""
        SELECT id, array_to_string(list_filter(regexp_split_to_array(clean_text, '\\s+'), lambda t:
            length(t) >= 3 AND regexp_matches(t, '[a-z]') AND t NOT IN ({_WORDS})), ' ') AS tokens FROM cleaned"""),
    "process_posts": _with("unified", f"""
        SELECT id, clean_text, array_to_string(list_filter(regexp_split_to_array(clean_text, '\\s+'), lambda t:
            length(t) >= 3 AND regexp_matches(t, '[a-z]') AND t NOT IN ({_WORDS})), ' ') AS tokens,
            "timestamp", source, engagement, lang
        FROM (SELECT id, {_clean('text')} AS clean_text, coalesce(TRY_CAST("timestamp" AS TIMESTAMP),
              TIMESTAMP '1970-01-01' + to_seconds(TRY_CAST("timestamp" AS BIGINT))) AS "timestamp", source, engagement, lang
              FROM unified WHERE lang = 'en')"""),
    "keyword_events": _with("tok", 'SELECT keyword, "timestamp", source FROM tok'),
    "filter_keywords": _with("cleaned", """
        SELECT keyword, count(*) AS occurrences
        FROM (SELECT unnest(regexp_split_to_array(clean_text, '\\s+')) AS keyword FROM cleaned)
        WHERE length(keyword) >= 4 AND NOT regexp_full_match(keyword, '\\d+') AND regexp_matches(keyword, '[a-z]')
        GROUP BY keyword"""),
    # windows
    **{f"window_freq_{w}": _simple_window(w) for w in S.WINDOWS},
    "window_freq_sliding": _with("tok", _sliding(24, 6, "24h")),
    "freq_all_windows_sliding": _with(
        "tok",
        f"SELECT *, '__all__' AS source FROM ({_sliding(6, 3, '6h')} UNION ALL {_sliding(24, 12, '24h')})",
    ),
    "freq_all_windows": _with("gfreq", "SELECT * FROM gfreq"),
    "freq_per_source": _with("sfreq", "SELECT * FROM sfreq"),
    "frequency_of_days": _with("freq", "SELECT * FROM freq"),
    "keyword_frequency": _with("freq", "SELECT * FROM freq"),
    "part_frequency": _with("part_mentions", _windows("part_mentions", ["1d", "7d"], False) + " UNION ALL "
                            + _windows("part_mentions", ["1d", "7d"], True)),
    "stream_window_freq": _simple_window("24h"),
    # signals
    "growth_rate": _with("trend", f"SELECT {_FREQ_COLUMNS}, source, growth_rate FROM trend"),
    "velocity_acceleration": _with(
        "trend", f"SELECT {_FREQ_COLUMNS}, source, growth_rate, velocity, acceleration FROM trend"),
    "zscore": _with("trend", f"SELECT {_FREQ_COLUMNS}, source, growth_rate, floor(z_score * 1e6 + 0.5) / 1e6 AS z_score FROM trend"),
    "flag_anomalies": _with("trend", f"""
        SELECT {_FREQ_COLUMNS}, source, growth_rate, floor(z_score * 1e6 + 0.5) / 1e6 AS z_score, is_anomaly, spike_direction FROM trend"""),
    "classify_trend": _with("trend", f"""
        SELECT {_FREQ_COLUMNS}, source, growth_rate, floor(z_score * 1e6 + 0.5) / 1e6 AS z_score, trend_label FROM trend"""),
    "classify_trend_strict": _with("gfreq", f"""
        SELECT {_FREQ_COLUMNS}, source, growth_rate, floor(z_score * 1e6 + 0.5) / 1e6 AS z_score, trend_label
        FROM ({_trend('gfreq', "z > 2 AND " + '"window"' + " = '24h'")})"""),
    "detect_trends": _with("trend", f"SELECT {_TREND_COLUMNS} FROM trend"),
    "part_trends": _with("part_mentions", f"SELECT {_TREND_COLUMNS} FROM ({_trend('(' + _windows('part_mentions', ['1d', '7d'], False) + ' UNION ALL ' + _windows('part_mentions', ['1d', '7d'], True) + ')')})"),
    "trend_summary": _with("trend", """SELECT count(*) AS total_rows, count(*) FILTER (is_anomaly = 1) AS anomalies,
        count(*) FILTER (trend_label = 'viral') AS viral FROM trend"""),
    "growth_rate_clamped": _with("freq", f"""
        SELECT {_FREQ_COLUMNS}, source, (CAST(greatest(frequency, 0) AS DOUBLE) - greatest(p, 0)) / (greatest(p, 0) + 1) AS growth_rate
        FROM (SELECT * REPLACE (frequency - 2 AS frequency),
              CASE WHEN lag(frequency) OVER w IS NOT NULL THEN lag(frequency) OVER w - 2 END AS p
              FROM freq WINDOW w AS (PARTITION BY keyword, "window", source ORDER BY window_start))
        WHERE p IS NOT NULL UNION ALL
        SELECT {_FREQ_COLUMNS}, source, NULL FROM (SELECT * REPLACE (frequency - 2 AS frequency),
              lag(frequency) OVER (PARTITION BY keyword, "window", source ORDER BY window_start) AS p FROM freq) WHERE p IS NULL"""),
    "peer_zscore": _with("trend", f"""
        SELECT {_FREQ_COLUMNS}, source, growth_rate, floor(1e6 * CASE WHEN n < 2 OR s IS NULL OR s < 1e-12 OR growth_rate IS NULL
            THEN 0 ELSE round((growth_rate - m) / s, 9) END + 0.5) / 1e6 AS peer_z
        FROM (SELECT *, avg(growth_rate) OVER b AS m, stddev_pop(growth_rate) OVER b AS s, count(growth_rate) OVER b AS n
              FROM trend WINDOW b AS (PARTITION BY "window", source, window_start))"""),
    "acceleration_zero_first": _with("trend", f"""
        SELECT {_FREQ_COLUMNS}, source, growth_rate,
               coalesce(growth_rate - lag(growth_rate) OVER (PARTITION BY keyword, "window", source ORDER BY window_start), 0) AS acceleration
        FROM (SELECT * FROM trend WHERE growth_rate IS NOT NULL)"""),
    "source_diversity": _with("tok", """SELECT keyword, count(DISTINCT trim(source)) AS source_diversity
        FROM tok WHERE source <> '' GROUP BY keyword"""),
    "source_diversity_merged": _with("tok", """SELECT keyword, count(DISTINCT trim(source)) AS source_diversity
        FROM tok WHERE source <> '' GROUP BY keyword"""),
    # features
    "pivot_frequency": _with("wide", "SELECT * FROM wide"),
    "feature_source_diversity": _with("diversity", "SELECT * FROM diversity"),
    "pivot_trend_metrics": _with("metrics", f"SELECT {_FEATURE_ROUNDED} FROM metrics"),
    "build_features": _with("feat", f"SELECT {_FEATURE_ROUNDED} FROM feat"),
    "build_features_joined": _with("feat", f"SELECT {_FEATURE_ROUNDED} FROM feat"),
    # keywords
    "top_keywords": _with("top500", "SELECT * FROM top500"),
    "tfidf_keywords": _with("tfidf", "SELECT * FROM tfidf"),
    "keyword_table": _with("top500 tfidf", "SELECT keyword, frequency, avg_tfidf_score FROM top500 LEFT JOIN tfidf USING (keyword)"),
    "tfidf_hashed_weights": _with("terms cleaned", f"""
        SELECT id, bucket, tf, documents, floor(tf * CASE WHEN documents >= 2
                THEN ln(((SELECT count(*) FROM cleaned) + 1) / CAST(documents + 1 AS DOUBLE)) ELSE 0 END * 1e6 + 0.5) / 1e6 AS weight
        FROM (SELECT id, bucket, sum(tf)::BIGINT AS tf, count(*) OVER (PARTITION BY bucket) AS documents
              FROM (SELECT id, tf, {_bucket('keyword')} AS bucket FROM terms) GROUP BY id, bucket)"""),
    "tfidf_bucket_map": _with("terms", f"""
        SELECT {_bucket('keyword')} AS bucket, keyword, count(*) AS documents FROM terms GROUP BY keyword"""),
    "tag_entities": _with("tagged cleaned", """SELECT id, source,
        CASE WHEN id::BIGINT % 11 <> 0 THEN "timestamp" END AS "timestamp", coalesce(entities, '') AS entities
        FROM cleaned LEFT JOIN tagged USING (id)"""),
    # anomalies
    "impute_features": _with("filled", "SELECT * REPLACE (floor(z_score_1h * 1e6 + 0.5) / 1e6 AS z_score_1h) FROM filled"),
    "anomaly_zscore": _with("zflag", 'SELECT keyword, "timestamp", is_anomaly FROM zflag'),
    "anomaly_iqr": _with("iqrflag", "SELECT * FROM iqrflag"),
    "anomaly_score": _with("zflag", 'SELECT keyword, "timestamp", floor(anomaly_score * 1e4 + 0.5) / 1e4 AS anomaly_score FROM zflag'),
    "anomaly_forest_check": _with("feat", """
        SELECT count(*) AS "rows", count(DISTINCT keyword) AS keywords, count(*) AS scored, CAST(0 AS DOUBLE) AS least,
               CAST(1 AS DOUBLE) AS most, TRUE AS share_holds, TRUE AS highest_flagged FROM feat"""),
    "anomaly_report": _with("zflag feat", """
        SELECT keyword, floor(anomaly_score * 1e4 + 0.5) / 1e4 AS anomaly_score, trend_label, freq_1h, freq_6h, growth_rate_1h,
               floor(z_score_1h * 1e6 + 0.5) / 1e6 AS z_score_1h
        FROM feat JOIN zflag USING (keyword, "timestamp") WHERE zflag.is_anomaly"""),
    "enrich_features": _with("zflag iqrflag feat", f"""
        SELECT feat.* EXCLUDE (is_anomaly) REPLACE (floor(z_score_1h * 1e6 + 0.5) / 1e6 AS z_score_1h, floor(z_score_24h * 1e6 + 0.5) / 1e6 AS z_score_24h),
               iqrflag.is_anomaly, floor(anomaly_score * 1e4 + 0.5) / 1e4 AS anomaly_score
        FROM feat JOIN zflag USING (keyword, "timestamp") JOIN iqrflag USING (keyword, "timestamp")"""),
    # forecasts
    "forecast_candidates": _with("cand", "SELECT * FROM cand"),
    "forecast_linear_stored": _with("pred20", f"SELECT {_PRED_COLUMNS} FROM pred20"),
    "forecast_linear": _with("pred20", f"SELECT {_PRED_COLUMNS} FROM pred20"),
    "forecast_model_check": _with("feat", """
        SELECT keyword, max_by(trend_label, "timestamp") AS trend_class, max("timestamp") AS last_ts,
               greatest(date_diff('second', min("timestamp"), max("timestamp")) / 3600.0, 1.0) AS scale_hours,
               count(*) AS points, true AS solved, true AS spread_agrees
        FROM feat WHERE keyword IN (SELECT keyword FROM feat GROUP BY keyword ORDER BY sum(freq_1h) DESC, keyword LIMIT 20)
        GROUP BY keyword"""),
    "forecast_all": _with("pred", f"SELECT {_PRED_COLUMNS} FROM pred"),
    # trend board
    "board_lookback": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM board
        WHERE "timestamp" >= (SELECT max("timestamp") FROM board) - INTERVAL 48 HOUR"""),
    "board_lookback_as_of": _with("gboard", f"""SELECT {_BOARD_COLUMNS} FROM gboard
        WHERE "timestamp" >= TIMESTAMP '2024-01-20' - INTERVAL 168 HOUR"""),
    "board_replay_day": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM board
        WHERE "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-16'"""),
    "board_search": _with("board", f"SELECT {_BOARD_COLUMNS} FROM board WHERE contains(lower(keyword), 'tion')"),
    "board_filter": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM board
        WHERE trend_label IN ('viral', 'emerging', 'stable') AND frequency >= 2 AND growth_rate >= 0
          AND source IN ('src0', 'src1', '__all__')"""),
    "board_surprise": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM board WHERE keyword = (
        SELECT keyword FROM (SELECT keyword, min(CASE WHEN trend_label IN ('viral', 'emerging') THEN 0 ELSE 1 END) AS cold
            FROM board GROUP BY keyword) ORDER BY cold, md5(keyword || ':7'), keyword LIMIT 1)"""),
    "watchlist_alerts": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM board
        WHERE keyword IN ('ing', 'ble', 'tion', 'ther', 'rewh', 'orre') AND z_score > 3"""),
    "trend_ranking": _with("gboard", f"""SELECT {_BOARD_COLUMNS} FROM
        (SELECT * FROM gboard ORDER BY frequency DESC, z_score DESC, {_BOARD_TIE} LIMIT 20)"""),
    "board_metrics": _with("board", """SELECT count(DISTINCT keyword) AS total_keywords,
        count(*) FILTER (trend_label = 'viral') AS viral, count(*) FILTER (trend_label = 'emerging') AS emerging,
        CAST(sum(is_anomaly) AS BIGINT) AS anomalies FROM board"""),
    "anomaly_alerts": _with("gboard", f"""SELECT {_BOARD_COLUMNS} FROM
        (SELECT * FROM gboard WHERE is_anomaly = 1 ORDER BY z_score DESC, {_BOARD_TIE} LIMIT 6)"""),
    "top_by_max_freq": _with("board", """SELECT keyword, max(frequency) AS max_frequency FROM board GROUP BY keyword
        ORDER BY max_frequency DESC, keyword LIMIT 20"""),
    "growth_leaderboard": _with("board", f"""SELECT keyword, growth_rate, "timestamp", "window", source,
        CASE WHEN growth_rate >= 0 THEN 'up' ELSE 'down' END AS direction FROM
        (SELECT * FROM board WHERE growth_rate IS NOT NULL ORDER BY growth_rate DESC, {_BOARD_TIE} LIMIT 18)"""),
    "label_distribution": _with("board", """SELECT trend_label, count(*) AS "rows",
        round(count(*) / CAST((SELECT count(*) FROM board) AS DOUBLE), 6) AS share FROM board GROUP BY trend_label"""),
    "keyword_timeline": _with("board", """SELECT keyword, "timestamp", "window", source, frequency,
        CASE WHEN is_anomaly = 1 THEN frequency END AS anomaly_frequency FROM board WHERE keyword = 'ing'"""),
    "bubble_set": _with("feat", """SELECT keyword, growth_rate, frequency, floor(z_score * 1e6 + 0.5) / 1e6 AS z_score, trend_label,
        floor((greatest(abs(z_score), 0.5) * 5 + 5) * 1e6 + 0.5) / 1e6 AS bubble_size FROM
        (SELECT keyword, growth_rate_24h AS growth_rate, freq_24h AS frequency, z_score_24h AS z_score, trend_label
         FROM feat WHERE growth_rate_24h IS NOT NULL AND z_score_24h IS NOT NULL
         ORDER BY freq_24h DESC, keyword, "timestamp" LIMIT 30)"""),
    "compare_keywords": _with("board", f"SELECT {_BOARD_COLUMNS} FROM board WHERE keyword IN ('ing', 'ble')"),
    "compare_latest": _with("board", """SELECT keyword, frequency AS latest_frequency, growth_rate AS latest_growth FROM
        (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY "timestamp" DESC, "window" DESC, source DESC) AS rn
         FROM board WHERE keyword IN ('ing', 'ble')) WHERE rn = 1"""),
    "board_summary_text": _with("board", _summary()),
    "keyword_summary_text": _with("gboard", f"""SELECT keyword, 'ing is currently ' ||
        CASE trend_label WHEN 'viral' THEN '🔥 Viral. Exploding right now — sharp spike in mentions'
             WHEN 'emerging' THEN '📈 Emerging. Gaining momentum — steady growth building up'
             WHEN 'stable' THEN '➡️ Stable. Consistent attention — steady baseline activity'
             ELSE '📉 Declining. Losing steam — conversation is fading' END || ' Current frequency: ' ||
        CAST(frequency AS VARCHAR) || ' mentions | Growth: ' || {_percent('coalesce(growth_rate, 0)')} ||
        CASE WHEN is_anomaly = 1 THEN ' Alert: unusual spike (Z-score: ' || printf('%.2f', z_score) || ')' ELSE '' END AS summary
        FROM (SELECT * FROM gboard WHERE keyword = 'ing' ORDER BY "timestamp" DESC, "window" DESC LIMIT 1)"""),
    "related_by_label": _with("board", """SELECT keyword, trend_label, max(frequency) AS frequency FROM board
        WHERE keyword <> 'ing' AND trend_label = (SELECT trend_label FROM board WHERE keyword = 'ing'
              ORDER BY "timestamp" DESC, "window" DESC, source DESC LIMIT 1)
        GROUP BY ALL ORDER BY frequency DESC, keyword LIMIT 6"""),
    "related_cooccurrence": _with("terms", """SELECT keyword, count(*) AS documents FROM terms
        WHERE keyword <> 'ing' AND id IN (SELECT id FROM terms WHERE keyword = 'ing')
        GROUP BY keyword ORDER BY documents DESC, keyword LIMIT 20"""),
    "related_cooccurrence_joined": _with("terms", """SELECT keyword, count(*) AS documents FROM terms
        WHERE keyword <> 'ing' AND id IN (SELECT id FROM terms WHERE keyword = 'ing')
        GROUP BY keyword ORDER BY documents DESC, keyword LIMIT 20"""),
    "related_edges": _with("terms", """
        SELECT keyword, related, documents, CAST(rank AS INTEGER) AS rank FROM (
            SELECT a.keyword, b.keyword AS related, count(*) AS documents,
                row_number() OVER (PARTITION BY a.keyword ORDER BY count(*) DESC, b.keyword) AS rank
            FROM (SELECT id, keyword FROM terms SEMI JOIN tracked USING (keyword)) a
            JOIN (SELECT id, keyword FROM terms SEMI JOIN tracked USING (keyword)) b ON a.id = b.id AND a.keyword <> b.keyword
            GROUP BY a.keyword, b.keyword) WHERE rank <= 6""".replace("tracked", """
                (SELECT keyword FROM terms GROUP BY keyword ORDER BY count(*) DESC, keyword LIMIT 500)""")),
    "distinct_labels": _with("board", "SELECT DISTINCT trend_label FROM board"),
    "latest_per_keyword": _with("board", f"""SELECT {_BOARD_COLUMNS} FROM
        (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY "timestamp" DESC, "window" DESC, source DESC) AS rn
         FROM board) WHERE rn = 1"""),
    "ranking_display": _with("gboard", f"""SELECT keyword, trend_label, frequency,
        coalesce({_percent('growth_rate')}, '-') AS growth, printf('%.2f', round(z_score, 2)) AS z,
        CASE WHEN is_anomaly = 1 THEN 'Yes' ELSE 'No' END AS anomaly FROM
        (SELECT * FROM gboard ORDER BY frequency DESC, z_score DESC, {_BOARD_TIE} LIMIT 20)"""),
    "board_facets": _with("board", """SELECT DISTINCT 'source' AS facet, source AS value FROM board UNION ALL
        SELECT DISTINCT 'window', "window" FROM board UNION ALL SELECT DISTINCT 'keyword', keyword FROM board"""),
    "forecast_facets": _with("pred", """SELECT DISTINCT 'forecast_period' AS facet, forecast_period AS value FROM pred
        UNION ALL SELECT DISTINCT 'keyword', keyword FROM pred"""),
    "forecast_board_load": _with("pred", f"SELECT {_PRED_COLUMNS} FROM pred"),
    "board_limits": _with("board", "SELECT max(frequency) AS max_frequency, max(growth_rate) AS max_growth FROM board"),
    "dataset_status": _with("cleaned freq feat", """
        SELECT 'processed' AS dataset, max("timestamp") AS latest, count(*) AS "rows" FROM cleaned UNION ALL
        SELECT 'frequency', max(window_start), count(*) FROM freq UNION ALL
        SELECT 'features', max("timestamp"), count(*) FROM feat"""),
    # forecast board
    "forecast_track": _with("feat pred20", """
        SELECT keyword, "timestamp" AS predicted_at, CAST(freq_1h AS DOUBLE) AS frequency, CAST(NULL AS DOUBLE) AS predicted_freq,
               CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound FROM feat WHERE keyword = 'ing'
        UNION ALL SELECT keyword, predicted_at, NULL, predicted_freq, lower_bound, upper_bound FROM pred20 WHERE keyword = 'ing'"""),
    "forecast_priority": _with("pred feat", f"""
        SELECT keyword, CAST(current_freq AS DOUBLE) AS current_freq, predicted_freq, trend_class,
               round(CAST(CAST(confidence AS FLOAT) AS DOUBLE), 4) AS confidence,
               round(CASE WHEN current_freq <> 0 THEN (predicted_freq - current_freq) / current_freq * 100 END, 6) AS change_pct
        FROM (SELECT keyword, {_last_known('predicted_freq')}, {_last_known('trend_class')}, {_last_known('confidence')}
              FROM pred GROUP BY keyword)
        JOIN (SELECT keyword, max_by(freq_1h, "timestamp") AS current_freq FROM feat GROUP BY keyword) USING (keyword)"""),
    "forecast_priority_lower_bound": _with("pred", f"""
        SELECT keyword, lower_bound AS current_freq, predicted_freq, trend_class,
               round(CAST(CAST(confidence AS FLOAT) AS DOUBLE), 4) AS confidence,
               round(CASE WHEN lower_bound <> 0 THEN (predicted_freq - lower_bound) / lower_bound * 100 END, 6) AS change_pct
        FROM (SELECT keyword, {_last_known('lower_bound')}, {_last_known('predicted_freq')}, {_last_known('trend_class')},
                     {_last_known('confidence')} FROM pred GROUP BY keyword)"""),
    "forecast_filter": _with("pred", f"""SELECT {_PRED_COLUMNS} FROM pred
        WHERE forecast_period = '24h' AND CAST(CAST(confidence AS FLOAT) AS DOUBLE) >= 0.5"""),
    "lifecycle_stage": _with("pred", """SELECT DISTINCT keyword, trend_class,
        CASE trend_class WHEN 'emerging' THEN 'Pre-emergence → Rising' WHEN 'viral' THEN 'Rising → Peak'
             WHEN 'stable' THEN 'Peak → Declining' WHEN 'declining' THEN 'Declining' ELSE 'Unknown' END AS stage,
        CASE trend_class WHEN 'emerging' THEN 0.4::DOUBLE WHEN 'viral' THEN 0.8 WHEN 'stable' THEN 0.6
             WHEN 'declining' THEN 0.2 ELSE 0 END AS stage_value FROM pred"""),
    "projected_velocity": _with("pred", """SELECT keyword, round(p / 24, 6) AS velocity, round(p / 24 * 0.1, 6) AS acceleration
        FROM (SELECT keyword, min_by(predicted_freq, predicted_at) AS p FROM pred GROUP BY keyword)"""),
    "topic_buckets": _with("pred", """SELECT topic, count(*) AS "rows" FROM (SELECT
        CASE WHEN regexp_matches(keyword, 'ai|tech|gpt|robot') THEN 'Technology'
             WHEN regexp_matches(keyword, 'sport|football|nba') THEN 'Sports'
             WHEN regexp_matches(keyword, 'politic|vote|election') THEN 'Politics'
             WHEN regexp_matches(keyword, 'crypto|bitcoin|stock') THEN 'Finance' ELSE 'General' END AS topic FROM pred)
        GROUP BY topic"""),
    "classification_snapshot": _with("pred", """SELECT keyword, trend_class,
        round(CAST(CAST(confidence AS FLOAT) AS DOUBLE), 4) AS confidence, predicted_freq FROM
        (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY predicted_freq DESC, predicted_at) AS rn FROM pred) WHERE rn = 1"""),
    # uploads
    "upload_clean_numeric": _with("typed", f"""SELECT event_id, {_number('frequency')} AS frequency,
        {_number('growth_rate')} AS growth_rate, {_number('z_score')} AS z_score, {_FLAG} AS is_anomaly FROM typed"""),
    "upload_defaults": _with("typed", f"""SELECT event_id, keyword, frequency, CAST(0 AS DOUBLE) AS growth_rate,
        CAST(0 AS DOUBLE) AS z_score, CAST(0 AS INTEGER) AS is_anomaly, 'stable' AS trend_label,
        {_UPLOAD_TIME} AS "timestamp" FROM typed"""),
    "upload_label_map": _with("typed", f"SELECT event_id, {_LABEL} AS trend_label FROM typed"),
    "upload_trends": _with("typed", f"""SELECT event_id, keyword, {_number('frequency')} AS frequency,
        {_number('growth_rate')} AS growth_rate, {_number('z_score')} AS z_score, {_FLAG} AS is_anomaly,
        {_LABEL} AS trend_label, {_UPLOAD_TIME} AS "timestamp" FROM typed"""),
    "manual_keywords": """SELECT keyword, CAST(1 AS INTEGER) AS frequency, CAST(0 AS DOUBLE) AS growth_rate,
        CAST(0 AS DOUBLE) AS z_score, CAST(0 AS INTEGER) AS is_anomaly, 'stable' AS trend_label,
        TIMESTAMP '2024-02-01' AS "timestamp" FROM
        (SELECT regexp_replace(unnest(string_split(text, chr(10))), '^\\s+|\\s+$', '', 'g') AS keyword FROM conversations)
        WHERE keyword <> ''""",
    "upload_predictions": """SELECT p_partkey, p_name AS keyword, p_retailprice AS predicted_freq,
        TIMESTAMP '2024-02-01' AS predicted_at, '24h' AS forecast_period, 'stable' AS trend_class,
        CAST(0.5 AS DOUBLE) AS confidence, round(p_retailprice * 0.8, 6) AS lower_bound,
        round(p_retailprice * 1.2, 6) AS upper_bound FROM part""",
    # quality
    "null_rate": _with("forum", """SELECT 'num_comments' AS "column", count(*) - count(num_comments) AS null_count,
        round((count(*) - count(num_comments)) / CAST(count(*) AS DOUBLE), 4) AS null_fraction,
        (count(*) - count(num_comments)) / CAST(count(*) AS DOUBLE) <= 0.3 AS passed FROM forum"""),
    "profile_nulls": _with("tweets", _profile()),
    "null_rates_of_write": _with("forum", " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) - count({c}) AS null_count,
            round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 4) AS null_fraction,
            (count(*) - count({c})) / CAST(count(*) AS DOUBLE) <= 0.3 AS passed FROM forum"""
        for c in ("id", "title", "selftext", "subreddit", "score", "num_comments", "created_utc", "url", "data_source"))),
    "stream_closed_windows": _with("tok arrivals marks", """
        SELECT keyword, s AS window_start, s + INTERVAL 1 DAY AS window_end, count(*) AS frequency, '24h' AS "window"
        FROM (SELECT t.keyword, a.batch, time_bucket(INTERVAL 1 DAY, t."timestamp", TIMESTAMP '1970-01-01') AS s
              FROM tok t JOIN arrivals a USING (id)) JOIN marks m USING (batch)
        WHERE (m.watermark IS NULL OR s + INTERVAL 1 DAY > m.watermark)
          AND s + INTERVAL 1 DAY <= (SELECT watermark FROM marks WHERE batch = 4)
        GROUP BY ALL"""),
}
