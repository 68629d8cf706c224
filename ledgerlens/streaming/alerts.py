"""Fraud alerts over a stream of raw transactions (extension X1).

The stateless features and rules are the batch expressions unchanged. The
per-customer gap (T6-T8) becomes keyed state: for each customer the last
timestamp and the number of rows seen so far. Within a micro-batch a
customer's rows are ordered by (timestamp, transaction_id), as in batch; the
first row continues from the stored state. ``customer_transaction_count`` is
the running count (the stream has no final total). The state keeps the
customer's latest timestamp: a row that arrives after a later one has no gap
(NULL) and leaves the state as it is, as do rows without a timestamp; feed
files in time order for batch-equal results.

A customer's rows of one micro-batch are held together in one task, so the
micro-batch size (``maxFilesPerTrigger``) bounds the memory per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..config import DEFAULT_SETTINGS, Settings, configure
from ..functions import exprs as X
from ..operators import features as T
from ..operators import rules as RU
from ..schema import PROCESSED_COLUMNS, RAW_SCHEMA

STATE_SCHEMA = StructType([
    StructField("last_micros", LongType(), True),
    StructField("seen", LongType(), False),
])

_GAP_FIELDS = [
    StructField("minutes_since_last_transaction", DoubleType(), True),
    StructField("customer_transaction_count", LongType(), False),
]


def _gap_state(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Gaps for one customer's rows of a micro-batch, continuing the state."""
    pdf = pd.concat(list(pdfs), ignore_index=True)
    pdf = pdf.sort_values(["_micros", "transaction_id"], na_position="first", kind="stable")
    last, seen = (state.get if state.exists else (None, 0))
    micros = pdf["_micros"].astype("Float64")
    prev = micros.shift(1)
    if len(prev):
        prev.iloc[0] = np.nan
        if last is not None:
            # rows up to the stored time (late, or without a time) do not hide it
            behind = prev.isna() | (prev < float(last))
            prev = prev.mask(behind, float(last))
    secs_now = (micros // 1_000_000)
    secs_prev = (prev // 1_000_000)
    gap = ((secs_now - secs_prev) / 60.0).astype("float64")
    # a row that arrives after a later one has no gap: what it followed is gone
    pdf["minutes_since_last_transaction"] = gap.where(prev.notna() & micros.notna() & (gap >= 0))
    pdf["customer_transaction_count"] = np.arange(seen + 1, seen + 1 + len(pdf), dtype="int64")
    # late rows and rows without a time never set the state back
    known = [int(m) for m in pdf["_micros"].dropna()] + ([] if last is None else [int(last)])
    state.update((max(known) if known else None, int(seen + len(pdf))))
    yield pdf.drop(columns=["_micros"])


def stream_alerts(spark: SparkSession, stream: DataFrame,
                  settings: Settings = DEFAULT_SETTINGS) -> DataFrame:
    """Alerts of a streaming DataFrame with the raw schema."""
    configure(spark)
    t = settings.thresholds
    feats = (
        stream.transform(T.extract_temporal_features, t)
        .transform(T.create_amount_categories, t)
        .withColumn("_micros", F.unix_micros("timestamp_dt"))
    )
    out_schema = StructType(
        [f for f in feats.schema.fields if f.name != "_micros"] + _GAP_FIELDS)
    gaps = feats.groupBy("customer_id").applyInPandasWithState(
        _gap_state, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    enriched = gaps.withColumn(
        "transaction_velocity", X.velocity_label("minutes_since_last_transaction", t))
    enriched = T.add_risk_indicators(enriched, t).select(*PROCESSED_COLUMNS)
    return RU.fraud_alerts(RU.detect_fraud_patterns(enriched, t))


def read_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream of raw transactions (Parquet or CSV with header)."""
    reader = spark.readStream.schema(RAW_SCHEMA).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_to_parquet(alerts: DataFrame, out: str, checkpoint: str) -> None:
    """Process everything available, append alerts as Parquet, then stop."""
    q = (alerts.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
