"""Equivalent SQL (DuckDB dialect) for the registered queries.

These strings are the correctness oracle: the driver runs them on the same
Parquet tables and compares results with the Spark queries. They repeat the
semantics of the operators in plain SQL: the test-data mapping, the
enrichment window, the rules and the aggregations. Rounding is ROUND on
DECIMAL (halves away from zero); rates are counted in whole numbers.
"""

from __future__ import annotations

from types import SimpleNamespace

# Expected labels, headings and columns, written out here on their own so that
# a wrong one in the operators does not pass.
L = SimpleNamespace(
    AMOUNT_HIGH='Alto',
    AMOUNT_LOW='Bajo',
    AMOUNT_MEDIUM='Medio',
    AMOUNT_VERY_HIGH='Muy Alto',
    PERIOD_WEEKDAY='Entre Semana',
    PERIOD_WEEKEND='Fin de Semana',
    PRIORITY_CRITICAL='CRÍTICA',
    PRIORITY_HIGH='ALTA',
    PRIORITY_LOW='BAJA',
    PRIORITY_MEDIUM='MEDIA',
    REASON_HIGH_DECLINED='Monto alto rechazado',
    REASON_NIGHT='Transacción nocturna sospechosa',
    REASON_SEPARATOR=' | ',
    REASON_STATUS='Estado FRAUD',
    REASON_VELOCITY='Velocidad sospechosa',
    SLOT_AFTERNOON='Tarde',
    SLOT_EVENING='Noche',
    SLOT_MORNING='Mañana',
    SLOT_NIGHT='Madrugada',
    VELOCITY_FAST='Rápida',
    VELOCITY_FIRST='Primera Transacción',
    VELOCITY_NORMAL='Normal',
    VELOCITY_SLOW='Lenta',
    VELOCITY_VERY_FAST='Muy Rápida',
)
STATUSES = (("APPROVED", "Aprobadas", "approved"), ("DECLINED", "Rechazadas", "declined"),
            ("FRAUD", "Fraude", "fraud"), ("PENDING", "Pendientes", "pending"))
SECTIONS = ("resumen", "estados", "alertas", "pais", "categoria", "temporal", "conclusiones")
RAW_COLUMNS = [
    'transaction_id', 'customer_id', 'account_type', 'country', 'amount', 'currency',
    'category', 'channel', 'timestamp', 'status', 'merchant_id', 'card_last4',
]
PROCESSED_COLUMNS = [
    'transaction_id', 'customer_id', 'account_type', 'country', 'amount', 'currency',
    'category', 'channel', 'timestamp', 'status', 'merchant_id', 'card_last4',
    'timestamp_dt', 'hour', 'day_of_week', 'time_slot', 'is_weekend', 'amount_category',
    'minutes_since_last_transaction', 'customer_transaction_count', 'transaction_velocity', 'is_suspicious_night', 'is_suspicious_velocity', 'risk_score',
    'year', 'month', 'day',
]
ALERT_CSV_COLUMNS = [
    'transaction_id', 'customer_id', 'account_type', 'country', 'amount', 'currency',
    'category', 'timestamp', 'status', 'alert_priority', 'risk_score', 'fraud_reasons',
]


def q(name: str) -> str:
    return f'"{name}"'


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def round2(x: str) -> str:
    """ROUND to cents, halves away from zero, on the number as written."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def money_sum(c: str = "amount") -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(25,10))) AS DOUBLE)"


def money_total(c: str = "amount") -> str:
    return round2(money_sum(c))


def money_avg(c: str = "amount") -> str:
    return round2(f"{money_sum(c)} / CAST(COUNT({c}) AS DOUBLE)")


def pct(part: str, whole: str) -> str:
    """Hundredths of a percent by whole numbers, halves up."""
    n, d = f"CAST({part} AS HUGEINT)", f"CAST(NULLIF({whole}, 0) AS HUGEINT)"
    return f"(CAST(({n} * 20000 + {d}) // ({d} * 2) AS DOUBLE) / CAST(100 AS DOUBLE))"


def count_if(cond: str) -> str:
    return f"COUNT(CASE WHEN {cond} THEN 1 END)"


def cols(names) -> str:
    return ", ".join(q(c) for c in names)


RAW_CTE = """raw AS (
  SELECT
    CAST(e.event_id AS BIGINT) AS transaction_id,
    CAST(e.user_id AS BIGINT) AS customer_id,
    c.c_mktsegment AS account_type,
    n.n_name AS country,
    CAST(CAST(e.value * 10 AS DECIMAL(18,2)) AS DOUBLE) AS amount,
    r.r_name AS currency,
    'cat_' || CAST(e.k % 10 AS VARCHAR) AS category,
    'ch_' || CAST((e.k // 10) % 4 AS VARCHAR) AS channel,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
    CASE WHEN e.k = 0 THEN 'FRAUD'
         WHEN e.event_type = 'error' THEN 'DECLINED'
         WHEN e.event_type = 'signup' THEN 'PENDING'
         ELSE 'APPROVED' END AS status,
    'M' || CAST(10000 + e.event_id % 90000 AS VARCHAR) AS merchant_id,
    lpad(CAST(e.event_id % 10000 AS VARCHAR), 4, '0') AS card_last4
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events) e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DIRTY_CTE = RAW_CTE + """,
faulty AS (
  SELECT
    transaction_id,
    CASE WHEN transaction_id % 101 = 0 THEN -customer_id ELSE customer_id END AS customer_id,
    account_type,
    CASE WHEN transaction_id % 41 = 0 THEN '  ' || country || ' ' ELSE country END AS country,
    CAST(CASE WHEN transaction_id % 97 = 0 THEN NULL
              WHEN transaction_id % 89 = 0 THEN -amount
              WHEN transaction_id % 83 = 0 THEN 0.0
              ELSE amount END AS DOUBLE) AS amount,
    currency,
    category,
    CASE WHEN transaction_id % 71 = 0 THEN 'ch_x' ELSE channel END AS channel,
    CASE WHEN transaction_id % 103 = 0 THEN 'not a date'
         WHEN transaction_id % 107 = 0 THEN ''
         ELSE "timestamp" END AS "timestamp",
    status, merchant_id, card_last4
  FROM raw
),
dirty AS (
  SELECT * FROM faulty
  UNION ALL SELECT * FROM faulty WHERE transaction_id % 50 = 0
  UNION ALL SELECT transaction_id, customer_id, account_type, country, amount, currency,
                   category, channel, "timestamp", CAST(NULL AS VARCHAR) AS status,
                   merchant_id, card_last4
            FROM faulty WHERE transaction_id % 53 = 0
)"""


def temporal_cte(src: str) -> str:
    return f"""t_time AS (
  SELECT *,
    CAST(year(timestamp_dt) AS INTEGER) AS year,
    CAST(month(timestamp_dt) AS INTEGER) AS month,
    CAST(day(timestamp_dt) AS INTEGER) AS day,
    CAST(hour(timestamp_dt) AS INTEGER) AS hour,
    CAST(dayofweek(timestamp_dt) + 1 AS INTEGER) AS day_of_week
  FROM (SELECT *, try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp_dt FROM {src})
),
t_slot AS (
  SELECT *,
    CASE WHEN hour >= 6 AND hour < 12 THEN {lit(L.SLOT_MORNING)}
         WHEN hour >= 12 AND hour < 18 THEN {lit(L.SLOT_AFTERNOON)}
         WHEN hour >= 18 AND hour < 23 THEN {lit(L.SLOT_EVENING)}
         ELSE {lit(L.SLOT_NIGHT)} END AS time_slot,
    COALESCE(day_of_week IN (1, 7), false) AS is_weekend,
    CASE WHEN amount < 50 THEN {lit(L.AMOUNT_LOW)}
         WHEN amount < 200 THEN {lit(L.AMOUNT_MEDIUM)}
         WHEN amount < 1000 THEN {lit(L.AMOUNT_HIGH)}
         ELSE {lit(L.AMOUNT_VERY_HIGH)} END AS amount_category
  FROM t_time
)"""


def enriched_cte(src: str) -> str:
    return temporal_cte(src) + f""",
t_win AS (
  SELECT *,
    lag(timestamp_dt) OVER (PARTITION BY customer_id
        ORDER BY timestamp_dt ASC NULLS FIRST, transaction_id ASC NULLS FIRST) AS prev_ts,
    COUNT(*) OVER (PARTITION BY customer_id) AS customer_transaction_count
  FROM t_slot
),
t_gap AS (
  SELECT *,
    CASE WHEN prev_ts IS NOT NULL THEN
      CAST(CAST(epoch(timestamp_dt) AS BIGINT) - CAST(epoch(prev_ts) AS BIGINT) AS DOUBLE)
        / CAST(60 AS DOUBLE) END AS minutes_since_last_transaction
  FROM t_win
),
t_vel AS (
  SELECT *,
    CASE WHEN minutes_since_last_transaction < 5 THEN {lit(L.VELOCITY_VERY_FAST)}
         WHEN minutes_since_last_transaction < 30 THEN {lit(L.VELOCITY_FAST)}
         WHEN minutes_since_last_transaction < 120 THEN {lit(L.VELOCITY_NORMAL)}
         WHEN minutes_since_last_transaction >= 120 THEN {lit(L.VELOCITY_SLOW)}
         ELSE {lit(L.VELOCITY_FIRST)} END AS transaction_velocity
  FROM t_gap
),
t_risk AS (
  SELECT *,
    COALESCE(time_slot = {lit(L.SLOT_NIGHT)} AND amount > 1000, false) AS is_suspicious_night,
    COALESCE(transaction_velocity = {lit(L.VELOCITY_VERY_FAST)} AND amount > 500, false)
      AS is_suspicious_velocity
  FROM t_vel
),
enriched AS (
  SELECT {cols(c for c in PROCESSED_COLUMNS if c != 'risk_score')},
    CAST((CASE WHEN status = 'DECLINED' THEN 2 ELSE 0 END)
       + (CASE WHEN is_suspicious_night THEN 3 ELSE 0 END)
       + (CASE WHEN is_suspicious_velocity THEN 3 ELSE 0 END)
       + (CASE WHEN amount > 2000 THEN 2 ELSE 0 END) AS INTEGER) AS risk_score
  FROM t_risk
)"""


SCORED_CTE = f"""rules AS (
  SELECT *,
    COALESCE(status = 'FRAUD', false) AS fraud_rule_status,
    COALESCE(status = 'DECLINED' AND amount > 2000, false) AS fraud_rule_high_declined,
    is_suspicious_night AS fraud_rule_night,
    is_suspicious_velocity AS fraud_rule_velocity
  FROM enriched
),
scored AS (
  SELECT *,
    COALESCE(fraud_rule_status OR fraud_rule_high_declined OR fraud_rule_night
             OR fraud_rule_velocity OR risk_score >= 7, false) AS is_fraud_detected,
    CASE WHEN fraud_rule_status THEN {lit(L.PRIORITY_CRITICAL)}
         WHEN risk_score >= 8 THEN {lit(L.PRIORITY_HIGH)}
         WHEN risk_score >= 5 THEN {lit(L.PRIORITY_MEDIUM)}
         ELSE {lit(L.PRIORITY_LOW)} END AS alert_priority,
    concat_ws({lit(L.REASON_SEPARATOR)},
      CASE WHEN fraud_rule_status THEN {lit(L.REASON_STATUS)} END,
      CASE WHEN fraud_rule_high_declined THEN {lit(L.REASON_HIGH_DECLINED)} END,
      CASE WHEN fraud_rule_night THEN {lit(L.REASON_NIGHT)} END,
      CASE WHEN fraud_rule_velocity THEN {lit(L.REASON_VELOCITY)} END,
      CASE WHEN risk_score >= 7 THEN printf('Risk score alto (%d)', risk_score) END
    ) AS fraud_reasons
  FROM rules
)"""

ENRICHED = "WITH " + RAW_CTE + ",\n" + enriched_cte("raw")
SCORED = ENRICHED + ",\n" + SCORED_CTE


def over_enriched(select: str) -> str:
    return ENRICHED + "\n" + select


def over_scored(select: str) -> str:
    return SCORED + "\n" + select


def over_raw(select: str) -> str:
    return "WITH " + RAW_CTE + "\n" + select


def over_dirty(select: str) -> str:
    return "WITH " + DIRTY_CTE + "\n" + select


# ---------------------------------------------------------------- analyses

def _group(key: str, extra: str = "") -> str:
    return (f"SELECT {key}, COUNT(*) AS total_transactions, {money_total()} AS total_amount, "
            f"{money_avg()} AS avg_amount{extra} FROM enriched GROUP BY {key}")


APPROVED = count_if("status = 'APPROVED'")
DECLINED = count_if("status = 'DECLINED'")

ANALYSES_SQL = {
    "summary_stats": f"""SELECT COUNT(*) AS total_transactions,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {money_total()} AS total_amount, {money_avg()} AS avg_amount,
  {round2('MIN(amount)')} AS min_amount, {round2('MAX(amount)')} AS max_amount,
  {APPROVED} AS approved, {DECLINED} AS declined,
  {pct(APPROVED, 'COUNT(*)')} AS approval_rate
FROM enriched""",
    "by_country": f"""SELECT country, COUNT(*) AS total_transactions,
  {money_total()} AS total_amount, {money_avg()} AS avg_amount,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {pct(APPROVED, 'COUNT(*)')} AS approval_rate
FROM enriched GROUP BY country ORDER BY total_amount DESC NULLS LAST, country""",
    "by_currency": _group("currency") + " ORDER BY total_transactions DESC, currency",
    "by_category": f"""SELECT category, total_transactions, total_amount, avg_amount,
  {pct('total_transactions', 'SUM(total_transactions) OVER ()')} AS percentage
FROM ({_group('category')}) g ORDER BY total_transactions DESC, category""",
    "by_time_slot": f"""SELECT time_slot, COUNT(*) AS total_transactions,
  {money_total()} AS total_amount, {money_avg()} AS avg_amount,
  {DECLINED} AS declined_count
FROM enriched GROUP BY time_slot""",
    "top_customers": f"""SELECT customer_id, COUNT(*) AS total_transactions,
  {money_total()} AS total_spent, {money_avg()} AS avg_transaction,
  MAX(account_type) AS account_type, {DECLINED} AS declined_count
FROM enriched GROUP BY customer_id
ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 20""",
    "fraud_rate_by_hour": f"""SELECT hour, COUNT(*) AS total_transactions,
  {count_if('risk_score >= 7')} AS high_risk_count,
  {pct(count_if('risk_score >= 7'), 'COUNT(*)')} AS high_risk_rate
FROM enriched GROUP BY hour ORDER BY hour""",
    "weekend_vs_weekday": f"""SELECT CASE WHEN is_weekend THEN {lit(L.PERIOD_WEEKEND)}
    ELSE {lit(L.PERIOD_WEEKDAY)} END AS period_type,
  COUNT(*) AS total_transactions, {money_total()} AS total_amount,
  {money_avg()} AS avg_amount, COUNT(DISTINCT customer_id) AS unique_customers
FROM enriched GROUP BY is_weekend""",
    "by_channel": f"""SELECT channel, COUNT(*) AS total_transactions,
  {money_total()} AS total_amount, {money_avg()} AS avg_amount,
  {pct(APPROVED, 'COUNT(*)')} AS approval_rate
FROM enriched GROUP BY channel""",
    "high_value_declined": """SELECT transaction_id, customer_id, country, amount, currency,
  category, "timestamp", risk_score
FROM enriched WHERE status = 'DECLINED' AND amount > 1000
ORDER BY amount DESC, transaction_id LIMIT 20""",
}

# The analysis cube as one plain GROUP BY per grouping set, straight from
# the transactions (the Spark side reads the customer sets off a profile).
CUBE_DIMS = ["country", "currency", "category", "time_slot", "hour", "is_weekend",
             "channel", "customer_id", "account_type"]
CUBE_TABLE_SETS = {"all": [], "country": ["country"], "currency": ["currency"],
                   "category": ["category"], "time_slot": ["time_slot"], "hour": ["hour"],
                   "weekend": ["is_weekend"], "channel": ["channel"]}
CUBE_CUSTOMER_SETS = {"customer": ["customer_id"],
                      "customer_account": ["customer_id", "account_type"],
                      "country_customer": ["country", "customer_id"],
                      "weekend_customer": ["is_weekend", "customer_id"]}


def _cube_part(name: str, keys: list[str], full: bool) -> str:
    dims = ", ".join(q(d) if d in keys else f"NULL AS {q(d)}" for d in CUBE_DIMS)
    amount_sum = "CAST(SUM(CAST(amount AS DECIMAL(25,10))) AS DOUBLE)"
    measures = [("n", "COUNT(*)"), ("amount_sum", amount_sum),
                ("amount_rest", "CAST(NULL AS DOUBLE)"), ("amount_n", "COUNT(amount)"),
                ("amount_min", "MIN(amount)"), ("amount_max", "MAX(amount)"),
                ("approved", APPROVED), ("declined", DECLINED),
                ("fraud", count_if("status = 'FRAUD'")),
                ("pending", count_if("status = 'PENDING'")),
                ("high_risk", count_if("risk_score >= 7")),
                ("alerts", count_if("is_fraud_detected")),
                ("ts_min", "strftime(MIN(timestamp_dt), '%Y-%m-%d %H:%M:%S')"),
                ("ts_max", "strftime(MAX(timestamp_dt), '%Y-%m-%d %H:%M:%S')")]
    profile = {"n", "amount_sum", "amount_n", "declined"}
    ms = ", ".join(f"{e if full or m in profile else 'NULL'} AS {q(m)}" for m, e in measures)
    group = f" GROUP BY {', '.join(q(k) for k in keys)}" if keys else ""
    return f"SELECT '{name}' AS grouping_set, {dims}, {ms} FROM scored{group}"


CUBE_SQL = "\nUNION ALL ".join(
    [_cube_part(n, k, True) for n, k in CUBE_TABLE_SETS.items()]
    + [_cube_part(n, k, False) for n, k in CUBE_CUSTOMER_SETS.items()])

ALERT_OUTPUT_COLUMNS = [c for c in PROCESSED_COLUMNS if c != "timestamp_dt"] + [
    "fraud_rule_status", "fraud_rule_high_declined", "fraud_rule_night",
    "fraud_rule_velocity", "is_fraud_detected", "alert_priority", "fraud_reasons",
]

RULES_SQL = {
    "fraud_alerts": f"SELECT {cols(ALERT_OUTPUT_COLUMNS)} FROM scored WHERE is_fraud_detected",
    "fraud_totals": f"""SELECT COUNT(*) AS total_transactions,
  {count_if('is_fraud_detected')} AS fraud_detected,
  COALESCE({pct(count_if('is_fraud_detected'), 'COUNT(*)')}, 0.0) AS detection_rate
FROM scored""",
    "fraud_by_priority": """SELECT alert_priority, COUNT(*) AS "count" FROM scored
WHERE is_fraud_detected GROUP BY alert_priority""",
    "fraud_by_country": """SELECT country, COUNT(*) AS "count" FROM scored
WHERE is_fraud_detected GROUP BY country ORDER BY "count" DESC, country LIMIT 5""",
    "fraud_rule_hits": " UNION ALL ".join(
        f"SELECT '{r}' AS rule, {count_if(r)} AS hits FROM scored"
        for r in ("fraud_rule_status", "fraud_rule_high_declined", "fraud_rule_night",
                  "fraud_rule_velocity")),
    "fraud_cube_summaries": "SELECT 'fraud_totals' AS summary, 'total_transactions' AS item, COUNT(*) AS rows FROM scored"
        " UNION ALL SELECT 'fraud_totals', 'fraud_detected', COUNT(*) FROM scored WHERE is_fraud_detected"
        " UNION ALL SELECT 'fraud_by_priority', alert_priority, COUNT(*) FROM scored WHERE is_fraud_detected GROUP BY alert_priority"
        " UNION ALL SELECT * FROM (SELECT 'fraud_by_country', country, COUNT(*) AS k FROM scored WHERE is_fraud_detected"
        " GROUP BY country ORDER BY k DESC, country LIMIT 5)" + "".join(
            f" UNION ALL SELECT 'fraud_rule_hits', '{r}', {count_if(r)} FROM scored"
            for r in ("fraud_rule_status", "fraud_rule_high_declined", "fraud_rule_night", "fraud_rule_velocity")),
    "fraud_top_risk": """SELECT transaction_id, customer_id, amount, country, "timestamp",
  status, alert_priority, risk_score FROM scored WHERE is_fraud_detected
ORDER BY risk_score DESC, amount DESC NULLS LAST, transaction_id LIMIT 10""",
    "fraud_rules": """SELECT transaction_id, fraud_rule_status, fraud_rule_high_declined,
  fraud_rule_night, fraud_rule_velocity FROM scored""",
    "fraud_flag": "SELECT transaction_id, risk_score, is_fraud_detected FROM scored",
    "fraud_priority": "SELECT transaction_id, risk_score, alert_priority FROM scored",
    "fraud_reasons": "SELECT transaction_id, fraud_reasons FROM scored",
    "analysis_cube": CUBE_SQL,
}

FEATURE_SQL = {
    "enriched_by_days": f"SELECT {cols(c for c in PROCESSED_COLUMNS if c != 'timestamp_dt')} FROM enriched",
    "feat_temporal": """SELECT transaction_id, year, month, day, hour, day_of_week,
  CAST(epoch(timestamp_dt) AS BIGINT) AS epoch_seconds FROM enriched""",
    "feat_time_slot": "SELECT transaction_id, hour, time_slot FROM enriched",
    "feat_weekend": "SELECT transaction_id, day_of_week, is_weekend FROM enriched",
    "feat_amount_category": "SELECT transaction_id, amount, amount_category FROM enriched",
    "feat_prev_gap": "SELECT transaction_id, customer_id, minutes_since_last_transaction FROM enriched",
    "feat_customer_count": """SELECT customer_id, customer_transaction_count,
  COUNT(*) AS rows_seen FROM enriched GROUP BY customer_id, customer_transaction_count""",
    "feat_velocity": """SELECT transaction_velocity, COUNT(*) AS n FROM enriched
GROUP BY transaction_velocity""",
    "feat_risk_flags": """SELECT transaction_id, is_suspicious_night, is_suspicious_velocity
FROM enriched""",
    "feat_risk_score": "SELECT risk_score, COUNT(*) AS n FROM enriched GROUP BY risk_score",
    "enriched_transactions": f"SELECT {cols(c for c in PROCESSED_COLUMNS if c != 'timestamp_dt')} FROM enriched",
}

ALERT_CSV_SQL = f"SELECT {cols(ALERT_CSV_COLUMNS)} FROM scored WHERE is_fraud_detected"


# ------------------------------------------------------- quality and clean

STRING_RAW = ["account_type", "country", "currency", "category", "channel", "timestamp",
              "status", "merchant_id", "card_last4"]

TRIMMED_CTE = "trimmed AS (SELECT " + ", ".join(
    f"trim({q(c)}) AS {q(c)}" if c in STRING_RAW else q(c) for c in RAW_COLUMNS
) + " FROM dirty)"

INCOMPLETE = ('(transaction_id IS NULL OR customer_id IS NULL OR amount IS NULL '
              'OR isnan(amount) OR "timestamp" IS NULL OR status IS NULL)')


def null_like(c: str) -> str:
    if c == "amount":
        return f"({q(c)} IS NULL OR isnan({q(c)}))"
    if c in STRING_RAW:
        return f"({q(c)} IS NULL OR {q(c)} = '')"
    return f"{q(c)} IS NULL"


def dedup_cte(src: str) -> str:
    rest = [c for c in RAW_COLUMNS if c not in ("transaction_id", "timestamp")]
    order = ", ".join([f"CAST({INCOMPLETE} AS INTEGER)", '"timestamp" NULLS FIRST']
                      + [f"{q(c)} NULLS FIRST" for c in rest])
    return (f"deduped AS (SELECT {cols(RAW_COLUMNS)} FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY transaction_id ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1)")


def over_trimmed(select: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return "WITH " + DIRTY_CTE + ",\n" + TRIMMED_CTE + extra + "\n" + select


def quality_sql(domains) -> dict[str, str]:
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {count_if(null_like(c))} AS null_count FROM dirty"
        for c in RAW_COLUMNS)
    invalid = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", "
        f"{count_if('NOT (' + q(c) + ' IN (' + ', '.join(lit(v) for v in vals) + '))')} "
        f"AS invalid_count FROM dirty"
        for c, vals in domains.as_dict().items())
    numeric = " UNION ALL ".join([
        f"SELECT 'negative_amounts' AS issue, {count_if('amount < 0')} AS \"count\" FROM dirty",
        f"SELECT 'zero_amounts' AS issue, {count_if('amount = 0')} AS \"count\" FROM dirty",
        f"SELECT 'invalid_customer_ids' AS issue, {count_if('customer_id < 0')} AS \"count\" FROM dirty",
    ])
    distinct = ("(COUNT(DISTINCT transaction_id) + MAX(CASE WHEN transaction_id IS NULL "
                "THEN 1 ELSE 0 END))")
    report = " UNION ALL ".join(
        ["SELECT 'total' AS \"check\", '*' AS \"column\", COUNT(*) AS n FROM dirty",
         f"SELECT 'duplicates', 'transaction_id', COUNT(*) - {distinct} FROM dirty"]
        + [f"SELECT 'nulls', \"column\", null_count FROM ({nulls}) WHERE null_count > 0"]
        + [f"SELECT 'invalid', \"column\", invalid_count FROM ({invalid}) WHERE invalid_count > 0"]
        + [f"SELECT 'numeric', issue, \"count\" FROM ({numeric}) WHERE \"count\" > 0"])
    return {
        "quality_schema": ENRICHED + "\nSELECT column_name AS \"column\", 'extra' AS issue "
        "FROM (DESCRIBE SELECT * FROM enriched) WHERE column_name NOT IN ("
        + ", ".join(lit(c) for c in RAW_COLUMNS) + ")",
        "quality_null_counts": over_dirty(f"SELECT * FROM ({nulls}) WHERE null_count > 0"),
        "quality_duplicates": over_dirty(
            f"SELECT COUNT(*) AS total_rows, {distinct} AS distinct_keys, "
            f"COUNT(*) - {distinct} AS duplicates FROM dirty"),
        "quality_invalid_categorical": over_dirty(
            f"SELECT * FROM ({invalid}) WHERE invalid_count > 0"),
        "quality_numeric_issues": over_dirty(f"SELECT * FROM ({numeric}) WHERE \"count\" > 0"),
        "quality_report": over_dirty(report),
        "clean_trim": over_trimmed("SELECT * FROM trimmed"),
        "clean_dedup": over_dirty("SELECT * FROM deduped").replace(
            "\nSELECT * FROM deduped", ",\n" + dedup_cte("dirty") + "\nSELECT * FROM deduped"),
        "clean_drop_nulls": over_dirty(
            "SELECT * FROM dirty WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL "
            "AND amount IS NOT NULL AND NOT isnan(amount) AND \"timestamp\" IS NOT NULL "
            "AND status IS NOT NULL"),
        "clean_transactions": over_trimmed(
            f"SELECT * FROM deduped WHERE NOT {INCOMPLETE}", dedup_cte("trimmed")),
        "ingest_summary": over_trimmed(
            "SELECT SUM(c) AS original_records, "
            "COUNT(CASE WHEN inc = 0 AND transaction_id IS NOT NULL THEN 1 END) AS validated_records, "
            "SUM(c) - COUNT(*) AS duplicates_removed FROM (SELECT transaction_id, COUNT(*) AS c, "
            f"MIN(CAST({INCOMPLETE} AS INTEGER)) AS inc FROM trimmed GROUP BY transaction_id)"),
    }


# ------------------------------------------------------------ io, catalog

ENRICHED_NO_TS = [c for c in PROCESSED_COLUMNS if c != "timestamp_dt"]

IO_SQL = {
    "io_csv_scan": over_raw(f"SELECT {cols(RAW_COLUMNS)} FROM raw"),
    "io_parquet_roundtrip": over_raw(f"SELECT {cols(RAW_COLUMNS)} FROM raw"),
    "io_partitioned_roundtrip": over_enriched(f"SELECT {cols(ENRICHED_NO_TS)} FROM enriched"),
    "io_partition_prune": over_enriched(
        "SELECT year, month, day, COUNT(*) AS n FROM enriched GROUP BY year, month, day"),
    "io_publish_days": over_enriched(
        f"SELECT {cols(ENRICHED_NO_TS)} FROM enriched WHERE day % 2 = 0 OR hour >= 6"),
    "catalog_incremental": over_enriched(
        """SELECT year, month, day, COUNT(*) AS n, MIN(transaction_id) AS first_id, MAX(transaction_id) AS last_id
FROM enriched WHERE day % 2 = 0 OR hour >= 6 GROUP BY year, month, day"""),
    "io_csv_quarantine": over_raw("""SELECT 'broken' AS kind, CAST(transaction_id AS VARCHAR) || ',cut' AS line, 1 AS n
FROM raw WHERE transaction_id % 97 = 0
UNION ALL SELECT 'broken', CAST(transaction_id AS VARCHAR) || ',7,a,b,1.0,c,d,e,2024-01-01 00:00:00,f,g,h,one,more', 1
FROM raw WHERE transaction_id % 97 = 1
UNION ALL SELECT 'broken', 'x' || CAST(transaction_id AS VARCHAR) || ',7,a,b,1.0,c,d,e,2024-01-01 00:00:00,f,g,h', 1
FROM raw WHERE transaction_id % 97 = 2
UNION ALL SELECT 'kept', NULL, COUNT(*) FROM raw WHERE transaction_id % 97 > 2"""),
    "io_alerts_csv": over_scored(ALERT_CSV_SQL),
    "io_write_verify": over_enriched(
        "SELECT COUNT(*) AS written_rows, COUNT(*) AS read_rows FROM enriched"),
    "io_json_roundtrip": over_enriched(" UNION ALL ".join(
        f"SELECT '{n}' AS result, COUNT(*) AS \"rows\", CAST(SUM("
        f"{'transaction_id' if n == 'high_value_declined' else 'total_transactions'}) AS BIGINT) AS total "
        f"FROM ({sql})" for n, sql in ANALYSES_SQL.items())),
    "catalog_transactions": over_enriched(f"SELECT {cols(ENRICHED_NO_TS)} FROM enriched"),
    "catalog_alerts": over_scored(
        "SELECT " + cols(["transaction_id", "customer_id", "account_type", "country", "amount",
                          "currency", "category", "channel", "timestamp", "status",
                          "alert_priority", "risk_score", "fraud_reasons", "fraud_rule_status",
                          "fraud_rule_high_declined", "fraud_rule_night", "fraud_rule_velocity",
                          "is_fraud_detected"])
        + " FROM scored WHERE is_fraud_detected"),
    "catalog_counts": over_scored(
        "SELECT 'transactions_processed' AS table_name, COUNT(*) AS total FROM scored "
        "UNION ALL SELECT 'fraud_alerts', COUNT(*) FROM scored WHERE is_fraud_detected"),
    "preview": over_enriched(
        f"SELECT {cols(ENRICHED_NO_TS)} FROM enriched ORDER BY transaction_id LIMIT 5"),
    # the alerts table exists only when there are alerts
    "catalog_list": over_scored(
        "SELECT 'default' AS namespace, 'transactions_processed' AS \"tableName\", "
        "false AS \"isTemporary\" UNION ALL SELECT 'default', 'fraud_alerts', false "
        "WHERE EXISTS (SELECT 1 FROM scored WHERE is_fraud_detected)"),
    # DESCRIBE: the computed column types in Spark's names, then the
    # partition section
    "catalog_describe": over_enriched(
        "SELECT column_name AS col_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' "
        "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
        "WHEN 'TIMESTAMP' THEN 'timestamp' WHEN 'INTEGER' THEN 'int' "
        "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END AS data_type, "
        "CAST(NULL AS VARCHAR) AS \"comment\" "
        f"FROM (DESCRIBE SELECT {cols(PROCESSED_COLUMNS)} FROM enriched) "
        "UNION ALL SELECT '# Partition Information', '', '' "
        "UNION ALL SELECT '# col_name', 'data_type', 'comment' "
        "UNION ALL SELECT 'year', 'int', NULL UNION ALL SELECT 'month', 'int', NULL "
        "UNION ALL SELECT 'day', 'int', NULL"),
}


# ---------------------------------------------------------------- workflow

def _groups(c: str) -> str:
    """Groups of a GROUP BY on ``c`` (a NULL group counts)."""
    return f"(SELECT COUNT(*) FROM (SELECT DISTINCT {q(c)} FROM enriched))"


CLEANED_CTE = TRIMMED_CTE + ",\n" + dedup_cte("trimmed") + f""",
cleaned AS (SELECT * FROM deduped WHERE NOT {INCOMPLETE})"""
# Rows per stage of the six-stage run over the dirty variant: validated,
# processed, alerts, table rows, ten analyses, and the report lines: 31 fixed
# lines (with the date), up to 10 countries, the categories and the time slots.
STAGE_SQL = (
    "WITH " + DIRTY_CTE + ",\n" + CLEANED_CTE + ",\n" + enriched_cte("cleaned") + ",\n" + SCORED_CTE + "\n"
    "SELECT 'ingest' AS stage, 'ok' AS status, (SELECT COUNT(*) FROM cleaned) AS \"rows\" "
    "UNION ALL SELECT 'transform', 'ok', (SELECT COUNT(*) FROM enriched) "
    "UNION ALL SELECT 'fraud', 'ok', (SELECT COUNT(*) FROM scored WHERE is_fraud_detected) "
    "UNION ALL SELECT 'tables', 'ok', (SELECT COUNT(*) FROM enriched) "
    "UNION ALL SELECT 'analyses', 'ok', CAST(10 AS BIGINT) "
    f"UNION ALL SELECT 'reports', 'ok', 31 + LEAST(10, {_groups('country')}) "
    f"+ {_groups('category')} + {_groups('time_slot')}")


# ---------------------------------------------------------------- reports

def fmt_int(x: str) -> str:
    return f"format('{{:,}}', {x})"


def fmt_dec(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


def report_ctes() -> str:
    status_rows = " UNION ALL ".join(
        f"SELECT {i} AS position, {lit(s)} AS status, {lit(label)} AS label, {s_col} AS cnt, "
        f"total_transactions FROM summary"
        for i, (s, label, s_col) in enumerate(STATUSES, start=1))
    return f""",
summary AS (
  SELECT COUNT(*) AS total_transactions, COUNT(DISTINCT customer_id) AS unique_customers,
    {money_total()} AS total_amount, {money_avg()} AS avg_amount,
    {APPROVED} AS approved, {DECLINED} AS declined,
    {count_if("status = 'FRAUD'")} AS fraud, {count_if("status = 'PENDING'")} AS pending,
    {pct(APPROVED, 'COUNT(*)')} AS approval_rate,
    {count_if('is_fraud_detected')} AS total_alerts,
    {pct(count_if('is_fraud_detected'), 'COUNT(*)')} AS detection_rate,
    strftime(MIN(timestamp_dt), '%Y-%m-%d') AS period_start,
    strftime(MAX(timestamp_dt), '%Y-%m-%d') AS period_end
  FROM scored
),
status_dist AS (
  SELECT position, status, label, cnt AS "count", {pct('cnt', 'total_transactions')} AS percentage
  FROM ({status_rows})
),
by_country AS ({ANALYSES_SQL['by_country'].replace(' ORDER BY total_amount DESC NULLS LAST, country', '')}),
by_category AS ({ANALYSES_SQL['by_category'].replace(' ORDER BY total_transactions DESC, category', '')}),
by_time_slot AS ({ANALYSES_SQL['by_time_slot']})"""


def report_sql() -> dict[str, str]:
    base = SCORED + report_ctes() + "\n"

    def fixed(section: int, lines: list[str]) -> str:
        name = SECTIONS[section - 1]
        return " UNION ALL ".join(
            f"SELECT {section} AS section_no, '{name}' AS section, {i} AS line_no, {expr} AS line "
            f"FROM summary" for i, expr in enumerate(lines))

    def table(section: int, heading: str, header, src: str, order: str, line: str) -> str:
        name = SECTIONS[section - 1]
        head = fixed(section, [lit(heading), lit(header[0]), lit(header[1])])
        return (head + f" UNION ALL SELECT {section}, '{name}', "
                f"CAST(ROW_NUMBER() OVER (ORDER BY {order}) + 2 AS INTEGER), {line} FROM {src}")

    def cells(*parts: str) -> str:
        return "'| ' || " + " || ' | ' || ".join(parts) + " || ' |'"

    money, cents, rate, plain = (
        lambda c: f"'€' || {fmt_dec(c)}", lambda c: f"printf('%.2f', {c})",
        lambda c: f"CAST({c} AS VARCHAR) || '%'", lambda c: f"CAST({c} AS VARCHAR)")
    slot_rank = ("CASE time_slot WHEN 'Madrugada' THEN 1 WHEN 'Mañana' THEN 2 WHEN 'Tarde' THEN 3 "
                 "WHEN 'Noche' THEN 4 END")
    parts = [
        fixed(1, [
            lit("# REPORTE DE ANÁLISIS BANCARIO"),
            "'Período analizado: ' || period_start || ' a ' || period_end",
            lit("## RESUMEN EJECUTIVO"),
            f"'- Total de transacciones procesadas: ' || {fmt_int('total_transactions')}",
            f"'- Clientes únicos: ' || {fmt_int('unique_customers')}",
            f"'- Monto total procesado: ' || {money('total_amount')}",
            f"'- Monto promedio por transacción: €' || {cents('avg_amount')}",
        ]),
        fixed(2, [lit("## Distribución de Estados"), lit("| Estado | Cantidad | Porcentaje |"),
                  lit("|--------|----------|------------|")]),
        "SELECT 2, 'estados', CAST(position + 2 AS INTEGER), "
        + cells("label", fmt_int('"count"'), rate("percentage")) + " FROM status_dist",
        fixed(3, [lit("## Alertas de Fraude"), f"'- Total de alertas detectadas: ' || {plain('total_alerts')}",
                  f"'- Tasa de detección: ' || {rate('detection_rate')}"]),
        table(4, "## ANÁLISIS POR PAÍS",
              ("| País | Transacciones | Monto Total | Monto Promedio | Tasa Aprobación |",
               "|------|---------------|-------------|----------------|------------------|"),
              "(SELECT * FROM by_country ORDER BY total_amount DESC NULLS LAST, country LIMIT 10)",
              "total_amount DESC NULLS LAST, country",
              cells("country", fmt_int("total_transactions"), money("total_amount"),
                    "'€' || " + cents("avg_amount"), rate("approval_rate"))),
        table(5, "## ANÁLISIS POR CATEGORÍA",
              ("| Categoría | Transacciones | Monto Total | Porcentaje |",
               "|-----------|---------------|-------------|------------|"),
              "by_category", "total_transactions DESC, category",
              cells("category", fmt_int("total_transactions"), money("total_amount"), rate("percentage"))),
        table(6, "## ANÁLISIS TEMPORAL",
              ("| Franja Horaria | Transacciones | Monto Total | Rechazadas |",
               "|----------------|---------------|-------------|------------|"),
              "by_time_slot", f"{slot_rank} NULLS LAST, time_slot",
              cells("time_slot", fmt_int("total_transactions"), money("total_amount"), plain("declined_count"))),
        fixed(7, [
            lit("## CONCLUSIONES"),
            f"'1. Se procesaron ' || {fmt_int('total_transactions')} || ' transacciones'",
            f"'2. Tasa de aprobación: ' || {rate('approval_rate')}",
            f"'3. Se detectaron ' || {plain('total_alerts')} || ' alertas de posible fraude'",
        ]),
    ]
    lines = " UNION ALL ".join(f"({p})" for p in parts)
    rule, blank = lit("=" * 80), "''"
    text_items = [
        rule, lit('REPORTE DE ANÁLISIS BANCARIO'), rule, blank,
        f"{lit('Período analizado: ')} || period_start || ' a ' || period_end",
        blank, rule, lit('RESUMEN EJECUTIVO'), rule, blank, lit('MÉTRICAS GENERALES:'),
        f"{lit('  - Total transacciones procesadas: ')} || {fmt_int('total_transactions')}",
        f"{lit('  - Clientes únicos: ')} || {fmt_int('unique_customers')}",
        f"{lit('  - Monto total procesado: ')} || {fmt_dec('total_amount')}",
        f"{lit('  - Monto promedio: ')} || printf('%.2f', avg_amount)",
        blank, lit('DISTRIBUCIÓN DE ESTADOS:'),
        f"{lit('  - Aprobadas: ')} || {fmt_int('approved')} || ' (' || "
        f"CAST(approval_rate AS VARCHAR) || '%)'",
        f"{lit('  - Rechazadas: ')} || {fmt_int('declined')}",
        f"{lit('  - Fraude: ')} || {fmt_int('fraud')}",
        f"{lit('  - Pendientes: ')} || {fmt_int('pending')}",
        blank, lit('ALERTAS DE FRAUDE:'),
        f"{lit('  - Total alertas detectadas: ')} || CAST(total_alerts AS VARCHAR)",
        f"{lit('  - Tasa de detección: ')} || CAST(detection_rate AS VARCHAR) || '%'",
        blank, rule,
    ]
    text = " UNION ALL ".join(f"SELECT {i} AS line_no, {e} AS line FROM summary"
                              for i, e in enumerate(text_items))
    return {
        "report_text": base + text,
        "report_summary": base + "SELECT * FROM summary",
        "report_summary_json": base + """SELECT '2025-01-01 00:00:00' AS fecha_generacion,
  period_start || ' a ' || period_end AS periodo_analizado,
  total_transactions AS total_transacciones, unique_customers AS clientes_unicos,
  total_amount AS monto_total, avg_amount AS monto_promedio, approved AS aprobadas,
  declined AS rechazadas, fraud AS fraude, pending AS pendientes, approval_rate AS tasa_aprobacion,
  total_alerts AS total_alertas, detection_rate AS tasa_deteccion FROM summary""",
        "report_status": base + "SELECT * FROM status_dist",
        "report_country": base + "SELECT * FROM by_country ORDER BY total_amount DESC NULLS LAST, "
                                 "country LIMIT 10",
        "report_category": base + "SELECT category, total_transactions, total_amount, percentage "
                                  "FROM by_category",
        "report_time": base + "SELECT time_slot, total_transactions, total_amount, declined_count "
                              "FROM by_time_slot",
        "report_lines": base + lines,
    }
