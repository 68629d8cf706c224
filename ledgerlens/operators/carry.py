"""Enrichment carried over between runs (T6-T14, one day after another).

What an earlier day means for a later one is, per customer, the last time and
the number of transactions: the *carry*, two numbers a customer. A new day is
enriched from its own rows and the carry alone; history is neither read nor
shuffled. Gaps, labels, flags and scores are final when their day is enriched.
The number of transactions of a customer grows with every day, so it is not
written with the rows but joined from the newest carry (``with_counts``); the
days then equal one enrichment of everything.

Late rows, those of a customer before the last time the carry knows, would
change gaps that were given out already. They are not enriched but handed back
(``split_late``); ``affected`` gives all rows of their customers, to be enriched
at once and published again.

Rows without a time have no gap and move no last time; they count. Rows of the
NULL customer are one group like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_SETTINGS, Settings
from ..functions import exprs as X
from ..schema import PROCESSED_COLUMNS
from . import features as T

CARRY = "customer_id bigint, last_time timestamp, transactions bigint"
COUNT = "customer_transaction_count"


def no_carry(spark) -> DataFrame:
    """The carry before the first day."""
    return spark.createDataFrame([], CARRY)


def _own(rows: DataFrame) -> DataFrame:
    """The carry of these rows alone: fixed-width buffers, combined per task."""
    return rows.groupBy("customer_id").agg(
        F.max("timestamp_dt").alias("last_time"), F.count(F.lit(1)).alias("transactions"))


def next_carry(carry: DataFrame, day: DataFrame) -> DataFrame:
    """The carry after ``day`` (rows with ``timestamp_dt``, late ones left
    out): both tables have a row per customer."""
    both = carry.unionByName(_own(day))
    return both.groupBy("customer_id").agg(
        F.max("last_time").alias("last_time"), F.sum("transactions").alias("transactions"))


def _met(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Rows with the customer's ``_last`` time. Joined on the customers of the
    day, one row each; a hot customer's rows are split by AQE."""
    known = carry.select(F.col("customer_id").alias("_cc"), F.col("last_time").alias("_last"))
    return rows.join(known, F.col("customer_id").eqNullSafe(F.col("_cc")), "left").drop("_cc")


def split_late(day: DataFrame, carry: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> tuple[DataFrame, DataFrame]:
    """``(in time, late)`` rows of a raw day, raw columns."""
    timed = _met(T.extract_temporal_features(day, settings.thresholds), carry)
    late = X.flag(F.col("timestamp_dt") < F.col("_last"))
    return timed.where(~late).select(*day.columns), timed.where(late).select(*day.columns)


def enrich_day(day: DataFrame, carry: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """The processed columns of a raw day without late rows, but for the
    customer's count. The first timed row of a customer takes its gap from the
    carry, all others from the day."""
    t = settings.thresholds
    rows = (day.transform(T.extract_temporal_features, t).transform(T.create_amount_categories, t)
            .transform(T.add_velocity_features, t, settings.skew))
    since = (F.unix_timestamp("timestamp_dt") - F.unix_timestamp("_last")) / 60.0
    gap = F.coalesce(F.col("minutes_since_last_transaction"), since)       # NULL without a time or a last one
    rows = _met(rows, carry).withColumn("minutes_since_last_transaction", gap).drop("_last")
    rows = rows.withColumn("transaction_velocity", X.velocity_label("minutes_since_last_transaction", t))
    return rows.transform(T.add_risk_indicators, t).select(*[c for c in PROCESSED_COLUMNS if c != COUNT])


def with_counts(enriched: DataFrame, carry: DataFrame) -> DataFrame:
    """Enriched days with the customers' counts of the newest carry, columns
    as in the processed table."""
    known = carry.select(F.col("customer_id").alias("_cc"), F.col("transactions").alias(COUNT))
    joined = enriched.drop(COUNT).join(known, F.col("customer_id").eqNullSafe(F.col("_cc")), "left")
    return joined.select(*PROCESSED_COLUMNS)


def affected(history: DataFrame, late: DataFrame) -> DataFrame:
    """All raw rows, early and late, of the customers that have late rows."""
    who = late.select(F.col("customer_id").alias("_lc")).distinct()
    return history.unionByName(late).join(who, F.col("customer_id").eqNullSafe(F.col("_lc")), "left_semi")
