"""Enrichment (T1-T14): calendar, amount band, per-customer velocity, risk.

Every step is ``DataFrame -> DataFrame`` and built from Spark expressions.
The only shuffle of full rows in the enrichment is the per-customer window
of ``add_velocity_features``; customers with very many rows are cut into
time slices and their large tie groups spread first, so that one hot
customer (or one hot customer-second) never becomes one task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_SETTINGS, Settings, SkewConfig, Thresholds
from ..functions import exprs as X
from ..functions import labels as L
from ..schema import PROCESSED_COLUMNS

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def extract_temporal_features(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Parse ``timestamp``; calendar parts; time slot; weekend flag.

    Unparsable strings give a NULL ``timestamp_dt`` (never an error), whose
    slot is the night slot and which is no weekend.
    """
    ts = F.try_to_timestamp(F.col("timestamp"), F.lit(TS_FORMAT))
    df = df.withColumn("timestamp_dt", ts)
    dt = F.col("timestamp_dt")
    df = df.withColumns({
        "year": F.year(dt),
        "month": F.month(dt),
        "day": F.dayofmonth(dt),
        "hour": F.hour(dt),
        "day_of_week": F.dayofweek(dt),
    })
    return df.withColumns({
        "time_slot": X.time_slot("hour", t),
        "is_weekend": X.flag(F.col("day_of_week").isin(1, 7)),
    })


def create_amount_categories(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """T5: amount band."""
    return df.withColumn("amount_category", X.amount_category("amount", t))


# Quantiles of time kept per hot customer: the most slices it is cut into.
SPLIT_POINTS = 4095


def _hot_customers(df: DataFrame, skew: SkewConfig) -> DataFrame:
    """``(customer_id, _n)`` of customers with more than ``rows_per_split``
    rows: a partial (map-side) aggregate with at most
    ``rows / rows_per_split`` rows, which bounds the broadcasts below."""
    return df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n")).filter(
        F.col("_n") > skew.rows_per_split)


def _cut_points(df: DataFrame, skew: SkewConfig) -> DataFrame:
    """``(_hc, _n, _points)`` of the hot customers: the times that cut each
    into ``ceil(rows / rows_per_split)`` slices of equal depth, from a partial
    quantile aggregate over the hot customers' rows. All points together are
    at most ``2 * rows / rows_per_split``."""
    hot = _hot_customers(df, skew).withColumnRenamed("customer_id", "_hc")
    rows = df.select("customer_id", F.unix_micros("timestamp_dt").alias("_t")).join(
        F.broadcast(hot), F.col("customer_id").eqNullSafe(F.col("_hc")))
    # one literal (folded), not an expression per share
    shares = F.from_json(F.lit(json.dumps([k / (SPLIT_POINTS + 1) for k in range(1, SPLIT_POINTS + 1)])), "array<double>")
    every = rows.groupBy("_hc", "_n").agg(
        F.percentile_approx("_t", shares, 10 * SPLIT_POINTS).alias("_q"))
    slices = F.least(F.ceil(F.col("_n") / F.lit(skew.rows_per_split)), F.lit(SPLIT_POINTS + 1))
    return every.withColumn("_s", slices).select(
        "_hc", "_n", F.coalesce(F.array_distinct(F.expr(
            f"transform(sequence(1L, _s - 1), j -> _q[cast(j * {SPLIT_POINTS + 1} div _s as int) - 1])")),
            F.array().cast("array<bigint>")).alias("_points"))


def _slice_of(micros: Column, points: Column) -> Column:
    """How many points lie before the time, found in two steps of about a
    square root of their number."""
    step = F.ceil(F.sqrt(F.size(points))).cast("int")
    before = lambda xs: F.size(F.filter(xs, lambda p: p < micros))
    heads = F.transform(F.sequence(F.lit(1), F.floor(F.size(points) / step).cast("int")),
                        lambda k: F.element_at(points, (k * step).cast("int")))
    chunk = before(heads) * step
    found = chunk + before(F.slice(points, chunk + 1, step))
    return F.when(F.size(points) == 0, F.lit(0)).otherwise(found).cast("bigint")


def _window_slices(df: DataFrame, skew: SkewConfig) -> tuple[DataFrame, DataFrame]:
    """Window partition keys for every row, and the slice-edge table. One
    lazy plan for any input: building it starts no job, and without a hot
    customer AQE drops the branches over the empty tables at run time.

    Rows of ordinary customers stay in slice 0. A hot customer is cut into
    slices of equal depth (``_cut_points``), so a burst gets as many slices as
    its rows need. A tie group (rows of one customer with one timestamp)
    larger than ``rows_per_split`` cannot be cut by time; its rows after the
    first all follow a row with the same timestamp, so their gap is known (0,
    or NULL for a NULL timestamp) and they are spread over
    ``ceil(rows / rows_per_split)`` partitions of their own (``_spread``).
    The first row stays in its slice, so the lag chain is unchanged. (Rows
    without a transaction id stay there too; the clean step drops them.)

    Returns (rows with ``_n``, ``_slice``, ``_tie``, ``_spread``; edges
    ``customer_id, _slice, _edge``: the last timestamp before each slice).
    Every broadcast table has at most a few times ``rows / rows_per_split``
    rows. The joins are NULL-safe: a NULL customer is one group, too.
    """
    ts, tid = F.col("timestamp_dt"), F.col("transaction_id")
    r = skew.rows_per_split
    timed = df.join(F.broadcast(_cut_points(df, skew)),
                    F.col("customer_id").eqNullSafe(F.col("_hc")), "left").drop("_hc").withColumn(
        "_slice",
        F.when(F.col("_n").isNull(), F.lit(0).cast("bigint"))
        .when(ts.isNull(), F.lit(-1).cast("bigint"))
        .otherwise(_slice_of(F.unix_micros(ts), F.col("_points"))),
    ).drop("_points")
    # one aggregation over the hot customers' rows: the last time of each
    # slice (grouping id 1) and the size of each tie group (grouping id 2)
    stats = (
        timed.filter(F.col("_n").isNotNull())
        .groupingSets([["customer_id", "_slice"], ["customer_id", "timestamp_dt"]],
                      "customer_id", "_slice", "timestamp_dt")
        .agg(F.grouping_id().alias("_g"), F.max(ts).alias("_last"),
             F.count(F.lit(1)).alias("_c"), F.min(tid).alias("_first"),
             F.count_if(tid.isNull()).alias("_null_ids"))
    )
    edges = stats.filter(F.col("_g") == 1).select(
        "customer_id", "_slice",
        F.lag("_last").over(Window.partitionBy("customer_id").orderBy("_slice")).alias("_edge"),
    )
    ties = stats.filter((F.col("_g") == 2) & (F.col("_c") > r)).select(
        F.col("customer_id").alias("_tc"), F.col("timestamp_dt").alias("_tt"),
        "_first", "_null_ids", F.ceil(F.col("_c") / F.lit(r)).alias("_k"))
    j = timed.join(F.broadcast(ties), F.col("customer_id").eqNullSafe(F.col("_tc"))
                   & ts.eqNullSafe(F.col("_tt")), "left")
    # every row of a large tie group but its first (NULL ids sort first)
    spread = X.flag(F.col("_k").isNotNull() & tid.isNotNull()
                    & ((F.col("_null_ids") > 0) | (tid != F.col("_first"))))
    rows = j.withColumn("_spread", spread).withColumns({
        "_slice": F.when(F.col("_spread"), -2 - F.pmod(F.xxhash64(tid), F.col("_k")))
        .otherwise(F.col("_slice")),
        "_tie": F.when(F.col("_spread"), ts),
    }).drop("_tc", "_tt", "_first", "_null_ids", "_k")
    return rows, edges


def add_velocity_features(df: DataFrame, t: Thresholds = Thresholds(),
                          skew: SkewConfig = SkewConfig()) -> DataFrame:
    """Gap to the previous transaction of the customer, count, label.

    Order within a customer is (timestamp_dt, transaction_id), NULL
    timestamps first. Hot customers are split into time slices of equal depth
    and their large tie groups spread (``_window_slices``); the first row of
    a slice takes its previous timestamp from the last timestamp of the
    slice before (a small aggregate joined back), so the result equals one
    window over the whole customer.
    """
    ts = F.col("timestamp_dt")
    rows, edges = _window_slices(df, skew)
    # dealt by every key of the window: rows that a join left clustered by
    # customer alone would stay there, all slices of a hot customer in one task
    rows = rows.repartition("customer_id", "_slice", "_tie")
    w = Window.partitionBy("customer_id", "_slice", "_tie").orderBy(
        ts.asc_nulls_first(), F.col("transaction_id").asc_nulls_first())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    windowed = rows.withColumns({
        "_prev": F.lag(ts).over(w),
        "_cnt": F.count(F.lit(1)).over(whole),
    })
    edges = edges.select(F.col("customer_id").alias("_ec"), F.col("_slice").alias("_es"), "_edge")
    j = windowed.join(F.broadcast(edges), F.col("customer_id").eqNullSafe(F.col("_ec"))
                      & (F.col("_slice") == F.col("_es")), "left").drop("_ec", "_es")
    prev = F.coalesce(F.col("_prev"), F.col("_edge"))
    gap = (
        F.when(F.col("_spread"), F.when(ts.isNotNull(), F.lit(0.0)))
        .when(prev.isNotNull(), (F.unix_timestamp(ts) - F.unix_timestamp(prev)) / 60.0)
    )
    out = j.withColumns({
        "minutes_since_last_transaction": gap,
        "customer_transaction_count": F.coalesce(F.col("_n"), F.col("_cnt")),
    })
    out = out.withColumn(
        "transaction_velocity",
        X.velocity_label("minutes_since_last_transaction", t))
    return out.drop("_n", "_slice", "_tie", "_spread", "_prev", "_cnt", "_edge")


def add_risk_indicators(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Suspicious-night, suspicious-velocity, risk score 0..10."""
    amount = F.col("amount")
    df = df.withColumns({
        "is_suspicious_night": X.flag(
            (F.col("time_slot") == L.SLOT_NIGHT) & (amount > t.night_amount)),
        "is_suspicious_velocity": X.flag(
            (F.col("transaction_velocity") == L.VELOCITY_VERY_FAST)
            & (amount > t.velocity_amount)),
    })
    wd, wn, wv, wa = t.score_weights
    score = (
        F.when(F.col("status") == L.STATUS_DECLINED, wd).otherwise(0)
        + F.when(F.col("is_suspicious_night"), wn).otherwise(0)
        + F.when(F.col("is_suspicious_velocity"), wv).otherwise(0)
        + F.when(amount > t.high_amount, wa).otherwise(0)
    )
    return df.withColumn("risk_score", score.cast("int"))


def enrich(df: DataFrame, settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """All features, columns in the processed-table order."""
    t = settings.thresholds
    out = (
        df.transform(extract_temporal_features, t)
        .transform(create_amount_categories, t)
        .transform(add_velocity_features, t, settings.skew)
        .transform(add_risk_indicators, t)
    )
    return out.select(*PROCESSED_COLUMNS)
