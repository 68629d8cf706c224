"""Streaming alerts equal batch alerts when files arrive in time order."""

from pyspark.sql import functions as F

from ledgerlens.config import scratch_path
from ledgerlens.operators import rules as RU
from ledgerlens.plans import registry
from ledgerlens.streaming.alerts import read_stream, run_to_parquet, stream_alerts

from tables import SF001


def test_stream_matches_batch(spark):
    raw = registry.raw(spark, SF001)
    src = scratch_path(spark, "stream-src")
    # three files, written one after another, each a later time range
    bounds = ["2024-01-11", "2024-01-21"]
    parts = [F.col("timestamp") < bounds[0],
             (F.col("timestamp") >= bounds[0]) & (F.col("timestamp") < bounds[1]),
             F.col("timestamp") >= bounds[1]]
    for i, cond in enumerate(parts):
        raw.filter(cond).coalesce(1).write.mode("append").parquet(src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    run_to_parquet(stream_alerts(spark, read_stream(spark, src, files_per_trigger=1)), out, ckpt)
    got = spark.read.parquet(out)
    want = RU.fraud_alerts(registry.scored(spark, SF001))
    cols = [c for c in want.columns if c not in ("customer_transaction_count", "timestamp_dt")]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert len(b) == 57
    assert a == b
