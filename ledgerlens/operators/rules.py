"""Fraud rules and alert summaries.

Rules are one projection of boolean expressions over the processed table;
the summaries are single aggregations (the reference ran one job per
figure).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions import exprs as X
from ..functions import labels as L

RULE_COLUMNS = [
    "fraud_rule_status", "fraud_rule_high_declined", "fraud_rule_night",
    "fraud_rule_velocity",
]


def rule_conditions(t: Thresholds = Thresholds()) -> dict[str, Column]:
    """F1-F4 over the processed columns, by rule column name."""
    status, amount = F.col("status"), F.col("amount")
    return {
        "fraud_rule_status": X.flag(status == L.STATUS_FRAUD),
        "fraud_rule_high_declined": X.flag(
            (status == L.STATUS_DECLINED) & (amount > t.high_amount)),
        "fraud_rule_night": F.col("is_suspicious_night"),
        "fraud_rule_velocity": F.col("is_suspicious_velocity"),
    }


def alert_condition(t: Thresholds = Thresholds()) -> Column:
    """F5 over the processed columns: any rule fired or a high risk score."""
    r1, r2, r3, r4 = rule_conditions(t).values()
    return X.flag(r1 | r2 | r3 | r4 | (F.col("risk_score") >= t.alert_score))


def detect_fraud_patterns(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Four rules, the alert flag, its priority and readable reasons."""
    score = F.col("risk_score")
    df = df.withColumns(rule_conditions(t))
    r1, r2, r3, r4 = (F.col(c) for c in RULE_COLUMNS)
    high_score = score >= t.alert_score
    return df.withColumns({
        "is_fraud_detected": X.flag(r1 | r2 | r3 | r4 | high_score),
        "alert_priority": (
            F.when(r1, L.PRIORITY_CRITICAL)
            .when(score >= t.high_priority_score, L.PRIORITY_HIGH)
            .when(score >= t.medium_priority_score, L.PRIORITY_MEDIUM)
            .otherwise(L.PRIORITY_LOW)
        ),
        "fraud_reasons": F.concat_ws(
            L.REASON_SEPARATOR,
            F.when(r1, F.lit(L.REASON_STATUS)),
            F.when(r2, F.lit(L.REASON_HIGH_DECLINED)),
            F.when(r3, F.lit(L.REASON_NIGHT)),
            F.when(r4, F.lit(L.REASON_VELOCITY)),
            F.when(high_score, F.format_string(L.REASON_SCORE_FORMAT, score)),
        ),
    })


def fraud_alerts(scored: DataFrame) -> DataFrame:
    """F8: rows with an alert."""
    return scored.filter(F.col("is_fraud_detected"))


def fraud_totals(scored: DataFrame) -> DataFrame:
    """total rows, alerts and detection rate (0 when empty), one pass."""
    total = F.count(F.lit(1))
    alerts = X.count_if(F.col("is_fraud_detected"))
    return scored.agg(
        total.alias("total_transactions"),
        alerts.alias("fraud_detected"),
        F.coalesce(X.pct(alerts, total), F.lit(0.0)).alias("detection_rate"),
    )


def fraud_by_priority(scored: DataFrame) -> DataFrame:
    """alerts per priority."""
    return (
        fraud_alerts(scored).groupBy("alert_priority")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "alert_priority")
    )


def fraud_by_country(scored: DataFrame, n: int = 5) -> DataFrame:
    """top-n countries by alerts (ties by country name)."""
    return (
        fraud_alerts(scored).groupBy("country")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("country").asc_nulls_last())
        .limit(n)
    )


def fraud_rule_hits(scored: DataFrame) -> DataFrame:
    """rows per rule, long format (rule, hits), one aggregation."""
    wide = scored.agg(*[X.count_if(F.col(c)).alias(c) for c in RULE_COLUMNS])
    return wide.unpivot([], RULE_COLUMNS, "rule", "hits")


def fraud_top_risk(scored: DataFrame, n: int = 10) -> DataFrame:
    """top-n alerts by risk score (ties: amount desc, then id)."""
    return top_risk(fraud_alerts(scored), n)


def top_risk(alerts: DataFrame, n: int = 10) -> DataFrame:
    """F13 over the alerts themselves, such as the written ones."""
    return (
        alerts
        .select("transaction_id", "customer_id", "amount", "country", "timestamp",
                "status", "alert_priority", "risk_score")
        .orderBy(F.col("risk_score").desc(), F.col("amount").desc_nulls_last(),
                 "transaction_id")
        .limit(n)
    )


# ------------------------------------------------ all summaries from the alerts

# grouping sets over the alerts: by priority, by country, all
SUMMARY_SETS = {"priority": ("alert_priority",), "country": ("country",), "all": ()}


def alert_cube(alerts: DataFrame) -> DataFrame:
    """F9-F12 as one ``GROUPING SETS`` aggregate over the alerts alone:
    ``grouping_set, alert_priority, country, n`` and the hits of every rule. A
    rule that fires makes an alert, so the hits among the alerts are those of
    the whole table."""
    dims = ["alert_priority", "country"]
    cube = alerts.groupingSets([list(d) for d in SUMMARY_SETS.values()], *dims).agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("n"),
        *[X.count_if(F.col(c)).alias(c) for c in RULE_COLUMNS])
    # bit of a dimension (from the left) is 1 where the set leaves it out
    name = F.when(F.col("_gid") == 1, "priority").when(F.col("_gid") == 2, "country").otherwise("all")
    return cube.select(name.alias("grouping_set"), *dims, "n", *RULE_COLUMNS)


def summaries_from_cube(cube: DataFrame, total: int, n: int = 5) -> dict[str, DataFrame]:
    """F9-F12 read off the alert cube; ``total``: rows of the whole table
    (also right without any alert, when the cube has no row)."""
    of = lambda name: cube.filter(F.col("grouping_set") == name)
    whole = of("all").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *RULE_COLUMNS)])
    rows = F.lit(total).cast("bigint")
    return {
        "fraud_totals": whole.select(
            rows.alias("total_transactions"), F.col("n").alias("fraud_detected"),
            F.coalesce(X.pct(F.col("n"), rows), F.lit(0.0)).alias("detection_rate")),
        "fraud_by_priority": of("priority").select("alert_priority", F.col("n").alias("count")).orderBy(
            F.col("count").desc(), "alert_priority"),
        "fraud_by_country": of("country").select("country", F.col("n").alias("count")).orderBy(
            F.col("count").desc(), F.col("country").asc_nulls_last()).limit(n),
        "fraud_rule_hits": whole.select(*RULE_COLUMNS).unpivot([], RULE_COLUMNS, "rule", "hits"),
    }
