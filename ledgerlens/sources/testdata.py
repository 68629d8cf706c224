"""Raw transactions from the driver's tables (mapping of FIXTURES.md §5-6).

``events`` is the fact table; ``customer``, ``nation`` and ``region`` are its
dimensions. The result has exactly the raw schema (S1), so every downstream
operator is the same as for a CSV source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Domains
from ..functions import labels as L
from ..schema import RAW_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean raw transactions, one per event."""
    events = _table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions:
    # their size bound is the spec, so broadcasting them is always safe.
    geo = (
        _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
        .join(F.broadcast(_table(spark, sf_dir, "region").select("r_regionkey", "r_name")),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    # customer grows with the scale factor: no hint, AQE picks broadcast only
    # when the measured size is below the threshold, else a sort-merge join
    # (with skew splitting for hot users).
    dims = customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.expr("try_cast(regexp_extract(props, '([0-9]+)', 1) AS INT)")
    ev = events.withColumn("_k", k)
    j = ev.join(dims, F.col("user_id") == F.col("c_custkey"))
    status = (
        F.when(F.col("_k") == 0, L.STATUS_FRAUD)
        .when(F.col("event_type") == "error", L.STATUS_DECLINED)
        .when(F.col("event_type") == "signup", L.STATUS_PENDING)
        .otherwise(L.STATUS_APPROVED)
    )
    return j.select(
        F.col("event_id").cast("bigint").alias("transaction_id"),
        F.col("user_id").cast("bigint").alias("customer_id"),
        F.col("c_mktsegment").alias("account_type"),
        F.col("n_name").alias("country"),
        (F.col("value") * 10).cast("decimal(18,2)").cast("double").alias("amount"),
        F.col("r_name").alias("currency"),
        F.concat(F.lit("cat_"), (F.col("_k") % 10).cast("string")).alias("category"),
        F.concat(F.lit("ch_"), (F.expr("_k div 10") % 4).cast("string")).alias("channel"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        status.alias("status"),
        F.concat(F.lit("M"), (F.lit(10000) + F.col("event_id") % 90000).cast("string"))
        .alias("merchant_id"),
        F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0").alias("card_last4"),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean mapping with faults injected by fixed rules on event_id.

    Every row of ``events`` is kept; some are altered and some appended
    again, so that every quality check and clean step has work to do.
    """
    t = transactions(spark, sf_dir)
    i = F.col("transaction_id")
    faulty = t.select(
        i,
        F.when(i % 101 == 0, -F.col("customer_id")).otherwise(F.col("customer_id"))
        .alias("customer_id"),
        "account_type",
        F.when(i % 41 == 0, F.concat(F.lit("  "), F.col("country"), F.lit(" ")))
        .otherwise(F.col("country")).alias("country"),
        F.when(i % 97 == 0, F.lit(None).cast("double"))
        .when(i % 89 == 0, -F.col("amount"))
        .when(i % 83 == 0, F.lit(0.0))
        .otherwise(F.col("amount")).alias("amount"),
        "currency",
        "category",
        F.when(i % 71 == 0, F.lit("ch_x")).otherwise(F.col("channel")).alias("channel"),
        F.when(i % 103 == 0, F.lit("not a date"))
        .when(i % 107 == 0, F.lit(""))
        .otherwise(F.col("timestamp")).alias("timestamp"),
        "status",
        "merchant_id",
        "card_last4",
    )
    copies = faulty.filter(i % 50 == 0)
    null_status = faulty.filter(i % 53 == 0).withColumn(
        "status", F.lit(None).cast("string")).select(*RAW_COLUMNS)
    return faulty.unionByName(copies).unionByName(null_status)


# Domains of the mapped data (FIXTURES.md §5), for the categorical check.
def testdata_domains() -> Domains:
    return Domains(
        account_type=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
        country=tuple(f"NATION_{n}" for n in range(25)),
        currency=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
        status=(L.STATUS_APPROVED, L.STATUS_DECLINED, L.STATUS_PENDING, L.STATUS_FRAUD),
        channel=tuple(f"ch_{n}" for n in range(4)),
        category=tuple(f"cat_{n}" for n in range(10)),
    )
