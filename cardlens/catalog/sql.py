"""SQL texts of the transaction tables, for the reference statements.

They state the same tables as ``cardlens.sources.star`` independently of it.
"""

TX = """
SELECT CAST(e.event_id AS STRING) AS transaction_id,
       e.ts AS transaction_ts,
       CAST(e.user_id AS STRING) AS card_id,
       concat('fraud_m', regexp_extract(e.props, '([0-9]+)', 1)) AS merchant,
       e.value AS amount,
       CASE WHEN e.value > 200 OR e.event_id % 97 = 0 THEN 1 ELSE 0 END AS is_fraud,
       e.event_type AS category,
       CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       n.n_name AS state,
       CAST(25 + n.n_nationkey AS DOUBLE) AS lat,
       CAST(-125 + 2 * n.n_nationkey AS DOUBLE) AS long,
       CAST(25 + n.n_nationkey AS DOUBLE) + CAST(e.event_id % 21 - 10 AS DOUBLE) / CAST(10 AS DOUBLE)
         + CAST(CASE WHEN e.event_id % 13 = 0 THEN 4 ELSE 0 END AS DOUBLE) AS merch_lat,
       CASE WHEN e.event_id % 101 = 0 THEN NULL
            ELSE CAST(-125 + 2 * n.n_nationkey AS DOUBLE) + CAST(e.event_id % 17 - 8 AS DOUBLE) / CAST(10 AS DOUBLE)
       END AS merch_long,
       CAST(1000 + (e.user_id * 7919) % 900000 AS BIGINT) AS city_pop,
       CASE WHEN e.user_id % 29 = 0 THEN NULL
            ELSE CAST(make_date(CAST(1940 + (e.user_id * 7) % 66 AS INT), CAST(1 + e.user_id % 12 AS INT),
                                CAST(1 + e.user_id % 28 AS INT)) AS STRING) END AS dob,
       CAST(1704067200 + e.event_id AS BIGINT) AS unix_time,
       CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE CAST(10000 + e.event_id % 89999 AS STRING) END AS merch_zipcode
FROM events e
JOIN customer c ON c.c_custkey = e.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
"""

ORDERS = """
SELECT concat(CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING)) AS transaction_id,
       o.o_orderdate AS transaction_ts,
       CAST(o.o_custkey AS STRING) AS card_id,
       s.s_name AS merchant,
       l.l_extendedprice AS amount,
       CASE WHEN l.l_returnflag = 'R' AND l.l_discount > 0.085 THEN 1 ELSE 0 END AS is_fraud,
       p.p_type AS category,
       n.n_name AS state
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey
JOIN part p ON p.p_partkey = l.l_partkey
"""

# tx with the per-row features.
FX = """
SELECT t.*,
       CAST(hour(transaction_ts) AS INT) AS tx_hour,
       CAST(dayofweek(transaction_ts) + 1 AS INT) AS tx_day_of_week,
       CAST(month(transaction_ts) AS INT) AS tx_month,
       CASE WHEN dayofweek(transaction_ts) IN (0, 6) THEN 1 ELSE 0 END AS tx_is_weekend,
       CASE WHEN hour(transaction_ts) BETWEEN 0 AND 5 THEN 'night'
            WHEN hour(transaction_ts) BETWEEN 6 AND 11 THEN 'morning'
            WHEN hour(transaction_ts) BETWEEN 12 AND 17 THEN 'afternoon'
            ELSE 'evening' END AS tx_time_of_day,
       ln(1 + amount) AS amount_log1p,
       CASE WHEN amount < 10 THEN 'micro' WHEN amount < 100 THEN 'small'
            WHEN amount < 500 THEN 'medium' ELSE 'large' END AS amount_bin,
       CASE WHEN lat IS NULL OR long IS NULL OR merch_lat IS NULL OR merch_long IS NULL THEN NULL
            ELSE 2 * 6371.0 * asin(sqrt(
                 pow(sin(radians(merch_lat - lat) / 2), 2)
                 + cos(radians(lat)) * cos(radians(merch_lat))
                 * pow(sin(radians(merch_long - long) / 2), 2))) END AS merch_distance_km,
       CAST(floor(epoch(transaction_ts)) AS BIGINT) AS tx_unix,
       CAST(floor(date_diff('day', CAST(dob AS DATE), CAST(transaction_ts AS DATE)) / 365.25) AS BIGINT)
           AS cardholder_age,
       CASE WHEN upper(gender) = 'M' THEN 1 ELSE 0 END AS gender_encoded
FROM tx t
"""

# Fields of the published CSV, from tx. The names and places it lacks are made from its keys.
RAW = """
SELECT CAST(transaction_id AS BIGINT) AS row_number,
       strftime(transaction_ts, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
       card_id AS cc_num, merchant, category, amount AS amt,
       concat('first', card_id) AS first, concat('last', card_id) AS last, gender,
       concat(card_id, ' Main St') AS street, concat('city of ', state) AS city, state,
       concat('0', card_id) AS zip, lat, long, city_pop, concat('job', card_id) AS job, dob,
       transaction_id AS trans_num, unix_time, merch_lat, merch_long, is_fraud, merch_zipcode
FROM tx
"""


def on_tx(select: str) -> str:
    return f"WITH tx AS ({TX})\n{select}"


def on_features(select: str) -> str:
    return f"WITH tx AS ({TX}), fx AS ({FX})\n{select}"


def on_orders(select: str) -> str:
    return f"WITH tx_orders AS ({ORDERS})\n{select}"


def on_raw(select: str) -> str:
    return f"WITH tx AS ({TX}), raw AS ({RAW})\n{select}"


# Profiles of the cards whose measures are all known, from fx.
CARD_PROFILES = """, profiles AS (
  SELECT card_id, CAST(count(*) AS BIGINT) AS tx_count, round(avg(amount_log1p), 2) AS avg_amount,
         round(stddev_samp(amount_log1p), 2) AS std_amount, round(sum(amount_log1p), 2) AS total_spend,
         round(avg(tx_hour), 2) AS avg_tx_hour, round(avg(tx_is_weekend), 3) AS weekend_ratio,
         round(avg(merch_distance_km), 2) AS avg_dist_km, round(avg(city_pop), 0) AS avg_city_pop,
         round(avg(is_fraud) * 100, 3) AS fraud_rate_pct,
         first(gender_encoded ORDER BY transaction_ts, transaction_id) AS gender_bin,
         first(cardholder_age ORDER BY transaction_ts, transaction_id) AS age
  FROM fx GROUP BY card_id),
complete AS (
  SELECT * FROM profiles
  WHERE std_amount IS NOT NULL AND avg_dist_km IS NOT NULL AND age IS NOT NULL AND gender_bin IS NOT NULL)
"""

def fine(value: str) -> str:
    """``value`` rounded to binary steps, as the ``FINE`` rounding of results."""
    return f"round(({value}) * 1048576) / 1048576"


# Portfolio measures shared by several reports.
FRAUD_AMOUNT = "round(coalesce(sum(CASE WHEN is_fraud = 1 THEN amount END), 0), 2) AS fraud_amount"
FRAUD_SHARE = "round(sum(is_fraud) * 100.0 / nullif(count(is_fraud), 0), 6) AS fraud_rate"
AVG_AMOUNT = f"{fine('avg(amount)')} AS avg_amount"
LABELLED = "CAST(count(is_fraud) AS BIGINT) AS total"
FRAUDS = "CAST(sum(is_fraud) AS BIGINT) AS fraud"
