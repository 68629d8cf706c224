"""The ten analyses as SQL text over the registered view.

For users who query the processed table by text: ``register`` makes the view,
``analysis`` runs one of the texts (or any text of the user's own goes through
``spark.sql``). The texts give what the functions of ``operators.analytics``
give, in the same order; money is summed as DECIMAL next to the amounts that no
DECIMAL holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import labels as L
from ..sources import catalog as K

VIEW = "transactions_view"      # not the name of the run's table, which it would hide

# what sums and averages are made of; a CTE column each
MONEY = """
  SUM(CASE WHEN ABS(amount) < 1e15 THEN CAST(amount AS DECIMAL(25,10)) END) AS exact,
  SUM(CASE WHEN ABS(amount) >= 1e15 THEN amount END) AS rest,
  COUNT(amount) AS filled"""
SUM = "CASE WHEN rest IS NULL THEN CAST(exact AS DOUBLE) ELSE COALESCE(CAST(exact AS DOUBLE), 0D) + rest END"
TOTAL = f"ROUND({SUM}, 2)"
AVERAGE = f"ROUND(({SUM}) / CASE WHEN filled > 0 THEN CAST(filled AS DOUBLE) END, 2)"


def _share(part: str, whole: str) -> str:
    return (f"CAST(ROUND(CAST({part} AS DECIMAL(20,0)) * 100.0BD / "
            f"CASE WHEN {whole} <> 0 THEN CAST({whole} AS DECIMAL(20,0)) END, 2) AS DOUBLE)")


def _grouped(view: str, key: str, more: str = "") -> str:
    return f"WITH g AS (SELECT {key}, COUNT(*) AS n, {MONEY}{more} FROM {view} GROUP BY {key})"


APPROVED = ", COUNT_IF(status = 'APPROVED') AS approved"
DECLINED = ", COUNT_IF(status = 'DECLINED') AS declined"
CUSTOMERS = ", COUNT(DISTINCT customer_id) AS customers"


def texts(view: str = VIEW) -> dict[str, str]:
    """Name of the analysis -> its text over ``view``."""
    return {
        "summary_stats": f"""
WITH g AS (SELECT COUNT(*) AS n, {MONEY}, MIN(amount) AS low, MAX(amount) AS high{APPROVED}{DECLINED}{CUSTOMERS} FROM {view})
SELECT n AS total_transactions, customers AS unique_customers, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount,
  ROUND(low, 2) AS min_amount, ROUND(high, 2) AS max_amount, approved, declined,
  {_share("approved", "n")} AS approval_rate FROM g""",
        "by_country": _grouped(view, "country", APPROVED + CUSTOMERS) + f"""
SELECT country, n AS total_transactions, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount,
  customers AS unique_customers, {_share("approved", "n")} AS approval_rate FROM g
ORDER BY total_amount DESC NULLS LAST, country NULLS LAST""",
        "by_currency": _grouped(view, "currency") + f"""
SELECT currency, n AS total_transactions, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount FROM g
ORDER BY total_transactions DESC, currency NULLS LAST""",
        "by_category": _grouped(view, "category") + f"""
SELECT category, n AS total_transactions, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount,
  {_share("n", "(SELECT SUM(n) FROM g)")} AS percentage FROM g
ORDER BY total_transactions DESC, category NULLS LAST""",
        "by_time_slot": _grouped(view, "time_slot", DECLINED) + f"""
SELECT time_slot, n AS total_transactions, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount, declined AS declined_count
FROM g ORDER BY CASE time_slot {" ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(L.SLOT_ORDER))} END
  NULLS LAST, time_slot""",
        "top_customers": _grouped(view, "customer_id", DECLINED + ", MAX(account_type) AS account_type") + f"""
SELECT customer_id, n AS total_transactions, {TOTAL} AS total_spent, {AVERAGE} AS avg_transaction, account_type,
  declined AS declined_count FROM g ORDER BY total_spent DESC NULLS LAST, customer_id NULLS LAST LIMIT 20""",
        "fraud_rate_by_hour": f"""
WITH g AS (SELECT hour, COUNT(*) AS n, COUNT_IF(risk_score >= 7) AS high FROM {view} GROUP BY hour)
SELECT hour, n AS total_transactions, high AS high_risk_count, {_share("high", "n")} AS high_risk_rate FROM g
ORDER BY hour NULLS LAST""",
        "weekend_vs_weekday": _grouped(view, "is_weekend", CUSTOMERS) + f"""
SELECT CASE WHEN is_weekend THEN '{L.PERIOD_WEEKEND}' ELSE '{L.PERIOD_WEEKDAY}' END AS period_type, n AS total_transactions,
  {TOTAL} AS total_amount, {AVERAGE} AS avg_amount, customers AS unique_customers FROM g ORDER BY is_weekend""",
        "by_channel": _grouped(view, "channel", APPROVED) + f"""
SELECT channel, n AS total_transactions, {TOTAL} AS total_amount, {AVERAGE} AS avg_amount,
  {_share("approved", "n")} AS approval_rate FROM g ORDER BY total_transactions DESC, channel NULLS LAST""",
        "high_value_declined": f"""
SELECT transaction_id, customer_id, country, amount, currency, category, timestamp, risk_score FROM {view}
WHERE status = 'DECLINED' AND amount > 1000 ORDER BY amount DESC, transaction_id LIMIT 20""",
    }


def register(df: DataFrame, view: str = VIEW) -> DataFrame:
    """The processed table as a view of the session."""
    return K.register_view(df, view)


def analysis(spark: SparkSession, name: str, view: str = VIEW) -> DataFrame:
    """One of the ten analyses, by its text over ``view``."""
    return spark.sql(texts(view)[name])
