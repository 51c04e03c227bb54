"""SQL forms of the test-table mappings in :mod:`tidemark.sources.testdata`."""

RAW = "raw AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS kk FROM events)"

MESSAGES = f"""{RAW},
msg AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 101 = 0 THEN 'soon' ELSE strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
         CASE WHEN event_id % 101 <> 0 THEN date_trunc('second', ts) END AS sent,
         'u' || user_id AS author,
         CASE WHEN event_id % 11 = 0 THEN [event_type, 'k' || kk, 'k' || kk] ELSE [event_type, 'k' || kk] END AS tags,
         CASE WHEN event_id % 3 = 0 THEN [] ELSE ['u' || ((user_id + kk) % 150)] END AS named,
         ' #' || CASE WHEN user_id % 2 = 1 THEN upper(event_type) ELSE event_type END
           || ' #k' || kk || ' @u' || ((user_id + kk) % 150) || ' hello  world' || chr(13) || chr(10) AS text
  FROM raw WHERE event_id % 7 <> 0),
gone AS (SELECT event_id AS id FROM raw WHERE event_id % 7 = 0),
topics AS (SELECT id, unnest(tags) AS topic FROM msg),
users AS (SELECT id, author AS "user" FROM msg),
mentions AS (SELECT id, unnest(named) AS mention FROM msg),
counted AS (SELECT topic, count(*) AS num_tweets FROM topics GROUP BY topic),
ranked AS (
  SELECT topic, num_tweets,
         CAST(dense_rank() OVER (ORDER BY num_tweets DESC, topic) AS INTEGER) AS num_tweets_rnk
  FROM counted)"""

METRICS = f"""{RAW},
device AS (
  SELECT *, epoch_us(ts) // 1000 AS t,
         CASE WHEN user_id % 2 = 0 THEN 'Fast_1s' ELSE 'Medium_30s' END AS g,
         CASE WHEN event_id % 97 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS v
  FROM raw),
metrics AS (
  SELECT g, event_type AS k, t, v, TRY_CAST(v AS DOUBLE) AS num FROM device
  UNION ALL
  SELECT g, event_type || '_k', t, CAST(kk AS VARCHAR), CAST(kk AS DOUBLE) FROM device)"""

BROKER = f"""{RAW},
broker AS (
  SELECT *, '/applications/in/' || user_id || CASE WHEN kk % 2 = 0 THEN '/public/' ELSE '/private/' END
            || event_type AS topic
  FROM raw)"""

NGRAMS = """words AS (SELECT doc_id, string_split_regex(text, '[ \\t\\r\\n]') AS ws FROM documents),
pairs AS (
  SELECT doc_id, unnest(range(0, len(ws) - 1)) AS pos, unnest(ws[1:len(ws) - 1]) AS w1, unnest(ws[2:]) AS w2
  FROM words WHERE len(ws) > 1),
lines AS (
  SELECT CAST(doc_id % 100 AS INTEGER) AS file_no, doc_id, CAST(pos AS INTEGER) AS pos, w1, w2,
         w1 || ' ' || w2 AS bi_gram, CAST(1900 + doc_id % 100 AS INTEGER) AS year,
         CAST(1 + length(w1) % 5 AS BIGINT) AS match_count
  FROM pairs),
cleaned AS (
  SELECT file_no, w1 AS gram0, w2 AS gram1, match_count FROM lines
  WHERE regexp_full_match(w1, '[A-Za-z]+') AND regexp_full_match(w2, '[A-Za-z]+')),
totals AS (SELECT gram0, gram1, CAST(sum(match_count) AS BIGINT) AS n FROM cleaned GROUP BY gram0, gram1),
cdf AS MATERIALIZED (
  SELECT gram0, gram1, n,
         CAST(sum(n) OVER (PARTITION BY gram0 ORDER BY gram1 ROWS UNBOUNDED PRECEDING) - n AS BIGINT) AS cum_lo,
         CAST(sum(n) OVER (PARTITION BY gram0 ORDER BY gram1 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_hi,
         CAST(sum(n) OVER (PARTITION BY gram0) AS BIGINT) AS total
  FROM totals)"""

SENSOR = """sensor AS (
  SELECT l_orderkey AS product_id, l_linenumber AS qc_lot, strftime(l_shipdate, '%Y-%m-%d') AS "time",
         l_quantity AS w_x, l_extendedprice AS w_y, CASE WHEN l_discount > 0 THEN l_discount END AS w_z
  FROM lineitem)"""
