"""Boundary rows of every feature and rule (hand-written inputs)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import features as T
from ledgerlens.operators import rules as R
from ledgerlens.schema import RAW_COLUMNS, RAW_SCHEMA


def raw_rows(spark, rows):
    """rows: dicts with some raw columns; the rest get neutral defaults."""
    base = dict(transaction_id=1, customer_id=1, account_type="A", country="C", amount=10.0,
                currency="X", category="cat_1", channel="ch_1",
                timestamp="2025-10-06 10:00:00", status="APPROVED", merchant_id="M1",
                card_last4="0001")
    full = []
    for i, r in enumerate(rows):
        d = dict(base, transaction_id=i + 1, customer_id=100 + i)
        d.update(r)
        full.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(full, RAW_SCHEMA)


def col_values(df, c):
    return [r[c] for r in df.orderBy("transaction_id").collect()]


def test_time_slot_boundaries(spark):
    hours = [5, 6, 11, 12, 17, 18, 22, 23, 0]
    rows = [{"timestamp": f"2025-10-06 {h:02d}:30:00"} for h in hours] + [{"timestamp": None}]
    out = T.extract_temporal_features(raw_rows(spark, rows))
    assert col_values(out, "time_slot") == [
        "Madrugada", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche", "Madrugada",
        "Madrugada", "Madrugada"]


def test_unparsable_timestamp_is_null_not_error(spark):
    out = T.extract_temporal_features(raw_rows(spark, [{"timestamp": "garbage"},
                                                        {"timestamp": ""}]))
    rows = out.orderBy("transaction_id").collect()
    assert [r["timestamp_dt"] for r in rows] == [None, None]
    assert [r["time_slot"] for r in rows] == ["Madrugada", "Madrugada"]
    assert [r["is_weekend"] for r in rows] == [False, False]
    assert [r["year"] for r in rows] == [None, None]


def test_weekend(spark):
    rows = [{"timestamp": d + " 12:00:00"} for d in ("2025-10-04", "2025-10-05", "2025-10-06")]
    out = T.extract_temporal_features(raw_rows(spark, rows))
    assert col_values(out, "is_weekend") == [True, True, False]
    assert col_values(out, "day_of_week") == [7, 1, 2]


def test_amount_category(spark):
    amounts = [49.99, 50.0, 199.99, 200.0, 999.99, 1000.0]
    out = T.create_amount_categories(raw_rows(spark, [{"amount": a} for a in amounts]))
    assert col_values(out, "amount_category") == [
        "Bajo", "Medio", "Medio", "Alto", "Alto", "Muy Alto"]


def gaps_for(spark, minutes):
    """One customer, first row at 00:00, then rows at the given gaps."""
    t = 0.0
    rows = [{"customer_id": 7, "timestamp": "2025-10-06 00:00:00"}]
    for m in minutes:
        t += m
        s = int(round(t * 60))
        rows.append({"customer_id": 7,
                     "timestamp": f"2025-10-06 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"})
    df = raw_rows(spark, rows)
    df = df.withColumn("customer_id", F.lit(7).cast("bigint"))
    return T.add_velocity_features(T.extract_temporal_features(df))


def test_velocity_labels(spark):
    out = gaps_for(spark, [0, 4.98, 5, 29.98, 30, 119.98, 120]).orderBy("transaction_id")
    assert col_values(out, "transaction_velocity") == [
        "Primera Transacción", "Muy Rápida", "Muy Rápida", "Rápida", "Rápida", "Normal",
        "Normal", "Lenta"]
    assert col_values(out, "customer_transaction_count") == [8] * 8
    assert col_values(out, "minutes_since_last_transaction")[:3] == [None, 0.0, 4.983333333333333]


def enrich_one(spark, rows):
    return T.enrich(raw_rows(spark, rows))


def test_suspicious_night(spark):
    out = enrich_one(spark, [
        {"timestamp": "2025-10-06 23:10:00", "amount": 1000.0},
        {"timestamp": "2025-10-06 23:10:00", "amount": 1000.01},
        {"timestamp": None, "amount": 1000.01},
    ])
    assert col_values(out, "is_suspicious_night") == [False, True, True]


def test_suspicious_velocity(spark):
    def pair(gap_min, amount, cust):
        s = gap_min * 60
        return [{"customer_id": cust, "timestamp": "2025-10-06 10:00:00", "amount": 1.0},
                {"customer_id": cust, "timestamp": f"2025-10-06 10:{s // 60:02d}:{s % 60:02d}",
                 "amount": amount}]
    rows = pair(4, 500.0, 1) + pair(4, 500.01, 2) + pair(5, 900.0, 3)
    out = T.enrich(raw_rows(spark, rows)).filter(F.col("amount") > 1.0)
    assert col_values(out, "is_suspicious_velocity") == [False, True, False]


def test_risk_score(spark):
    out = enrich_one(spark, [
        {"status": "DECLINED", "timestamp": "2025-10-06 10:00:00", "amount": 2000.0},
        {"status": "DECLINED", "timestamp": "2025-10-06 03:00:00", "amount": 2000.01},
    ])
    assert col_values(out, "risk_score") == [2, 7]


def test_max_score_is_ten(spark):
    rows = [{"customer_id": 5, "timestamp": "2025-10-06 03:00:00", "amount": 1.0},
            {"customer_id": 5, "timestamp": "2025-10-06 03:01:00", "amount": 2500.0,
             "status": "DECLINED"}]
    df = raw_rows(spark, rows).withColumn("customer_id", F.lit(5).cast("bigint"))
    assert col_values(T.enrich(df), "risk_score") == [0, 10]


def scored_of(spark, rows):
    return R.detect_fraud_patterns(enrich_one(spark, rows))


def test_priority(spark):
    out = scored_of(spark, [{"status": "FRAUD", "amount": 10.0}])
    assert col_values(out, "alert_priority") == ["CRÍTICA"]
    assert col_values(out, "is_fraud_detected") == [True]
    assert col_values(out, "fraud_reasons") == ["Estado FRAUD"]


@pytest.mark.parametrize("score,expected", [(8, "ALTA"), (7, "MEDIA"), (5, "MEDIA"), (4, "BAJA")])
def test_priority_bands(spark, score, expected):
    df = enrich_one(spark, [{}]).withColumn("risk_score", F.lit(score))
    assert col_values(R.detect_fraud_patterns(df), "alert_priority") == [expected]


def test_score_two_is_no_alert(spark):
    out = scored_of(spark, [{"status": "APPROVED", "amount": 2000.01}])
    assert col_values(out, "risk_score") == [2]
    assert col_values(out, "is_fraud_detected") == [False]
    assert col_values(out, "fraud_reasons") == [""]


def test_reasons_text(spark):
    out = scored_of(spark, [{"status": "DECLINED", "timestamp": "2025-10-06 03:00:00",
                             "amount": 2500.0}])
    assert col_values(out, "risk_score") == [7]
    assert col_values(out, "fraud_reasons") == [
        "Monto alto rechazado | Transacción nocturna sospechosa | Risk score alto (7)"]


def test_gap_is_whole_seconds(spark):
    rows = [{"customer_id": 9, "timestamp": "2025-10-06 10:00:00"},
            {"customer_id": 9, "timestamp": "2025-10-06 10:00:30"}]
    df = raw_rows(spark, rows).withColumn("customer_id", F.lit(9).cast("bigint"))
    assert col_values(T.enrich(df), "minutes_since_last_transaction") == [None, 0.5]


def test_processed_schema_order(spark):
    from ledgerlens.schema import PROCESSED_COLUMNS
    assert enrich_one(spark, [{}]).columns == PROCESSED_COLUMNS
    assert len(PROCESSED_COLUMNS) == 27


def test_example_row_shape(spark):
    """2555, 339, 1390.24, 2025-10-05 00:50:01, DECLINED -> score 5, MEDIA."""
    out = scored_of(spark, [{"transaction_id": 2555, "customer_id": 339, "amount": 1390.24,
                             "timestamp": "2025-10-05 00:50:01", "status": "DECLINED"}])
    r = out.first()
    assert (r["risk_score"], r["alert_priority"], r["is_fraud_detected"]) == (5, "MEDIA", True)
    assert datetime(2025, 10, 5, 0, 50, 1) == r["timestamp_dt"]
