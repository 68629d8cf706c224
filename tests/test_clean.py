"""Cleaning and quality semantics."""

import math

from pyspark.sql import functions as F

from ledgerlens.config import Domains
from ledgerlens.operators import clean as C
from ledgerlens.operators import quality as V
from ledgerlens.schema import RAW_COLUMNS, RAW_SCHEMA


def rows(spark, data):
    base = dict(transaction_id=1, customer_id=1, account_type="A", country="C", amount=10.0,
                currency="X", category="c", channel="h", timestamp="2025-10-06 10:00:00",
                status="APPROVED", merchant_id="M", card_last4="0001")
    return spark.createDataFrame(
        [tuple(dict(base, **d)[c] for c in RAW_COLUMNS) for d in data], RAW_SCHEMA)


def test_trim_spaces_only(spark):
    df = C.trim_strings(rows(spark, [{"country": "  ES "}, {"country": "\tES"}]))
    assert sorted(r["country"] for r in df.collect()) == ["\tES", "ES"]


def test_dedup_prefers_complete_row(spark):
    df = rows(spark, [{"status": None, "timestamp": "2025-10-01 00:00:00"},
                      {"status": "APPROVED", "timestamp": "2025-10-09 00:00:00"}])
    out = C.clean_data(df).collect()
    assert len(out) == 1 and out[0]["status"] == "APPROVED"


def test_dedup_earliest_timestamp_then_values(spark):
    df = rows(spark, [{"timestamp": "2025-10-02 00:00:00", "amount": 1.0},
                      {"timestamp": "2025-10-01 00:00:00", "amount": 5.0},
                      {"timestamp": "2025-10-01 00:00:00", "amount": 3.0}])
    out = C.deduplicate(df).collect()
    assert [(r["timestamp"], r["amount"]) for r in out] == [("2025-10-01 00:00:00", 3.0)]


def test_drop_nan_and_null_but_not_empty(spark):
    df = rows(spark, [{"transaction_id": 1, "amount": float("nan")},
                      {"transaction_id": 2, "amount": None},
                      {"transaction_id": 3, "timestamp": ""},
                      {"transaction_id": 4}])
    assert sorted(r["transaction_id"] for r in C.drop_incomplete(df).collect()) == [3, 4]


def test_null_counts_per_type(spark):
    df = rows(spark, [{"amount": float("nan")}, {"country": ""}, {"customer_id": None}])
    got = {r["column"]: r["null_count"] for r in V.check_nulls(df).collect()}
    assert got == {"amount": 1, "country": 1, "customer_id": 1}


def test_duplicates_count_null_as_key(spark):
    df = rows(spark, [{"transaction_id": None}, {"transaction_id": None},
                      {"transaction_id": 1}, {"transaction_id": 1}, {"transaction_id": 2}])
    r = V.check_duplicates(df).first()
    assert (r["total_rows"], r["distinct_keys"], r["duplicates"]) == (5, 3, 2)


def test_categorical_null_not_invalid(spark):
    dom = Domains(("A",), ("C",), ("X",), ("APPROVED",), ("h",), ("c",))
    df = rows(spark, [{"country": None}, {"country": "ZZ"}, {}])
    got = {r["column"]: r["invalid_count"] for r in V.validate_categorical_values(df, dom).collect()}
    assert got == {"country": 1}


def test_schema_check(spark):
    df = rows(spark, [{}]).drop("card_last4").withColumn("extra", F.lit(1))
    issues = {(r["column"], r["issue"]) for r in V.validate_schema(df, RAW_SCHEMA).collect()}
    assert issues == {("card_last4", "missing"), ("extra", "extra")}
    assert not V.schema_is_valid(V.validate_schema(df, RAW_SCHEMA))


def test_ingest_summary(spark):
    df = rows(spark, [{"transaction_id": 1}, {"transaction_id": 1},
                      {"transaction_id": 2, "status": None}, {"transaction_id": 3}])
    r = C.ingest_summary(df).first()
    assert (r["original_records"], r["validated_records"], r["duplicates_removed"]) == (4, 2, 1)
    assert C.clean_data(df).count() == 2


def test_validation_report_one_job_shape(spark):
    dom = Domains(("A",), ("C",), ("X",), ("APPROVED",), ("h",), ("c",))
    df = rows(spark, [{"amount": -1.0}, {"amount": 0.0}, {"customer_id": -4}])
    rep = {(r["check"], r["column"]): r["n"]
           for r in V.generate_validation_report(df, RAW_SCHEMA, dom).collect()}
    assert rep[("total", "*")] == 3
    assert rep[("duplicates", "transaction_id")] == 2
    assert rep[("numeric", "negative_amounts")] == 1
    assert rep[("numeric", "zero_amounts")] == 1
    assert rep[("numeric", "invalid_customer_ids")] == 1
    assert not math.isnan(rep[("total", "*")])
