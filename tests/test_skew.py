"""The hot-customer split gives exactly the single-window result."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.config import SkewConfig
from ledgerlens.operators import features as T
from ledgerlens.sources.testdata import dirty_transactions, transactions

from tables import SF001


def plain_velocity(df):
    """Reference semantics: one window over the whole customer."""
    w = Window.partitionBy("customer_id").orderBy(
        F.col("timestamp_dt").asc_nulls_first(), F.col("transaction_id").asc_nulls_first())
    prev = F.lag("timestamp_dt").over(w)
    return df.select(
        "transaction_id",
        F.when(prev.isNotNull(),
               (F.unix_timestamp("timestamp_dt") - F.unix_timestamp(prev)) / 60.0)
        .alias("minutes_since_last_transaction"),
        F.count(F.lit(1)).over(Window.partitionBy("customer_id"))
        .alias("customer_transaction_count"),
    )


def split_velocity(df, rows_per_split):
    out = T.add_velocity_features(df, skew=SkewConfig(rows_per_split=rows_per_split))
    return out.select("transaction_id", "minutes_since_last_transaction",
                      "customer_transaction_count")


def same(a, b):
    """Equal multisets of rows (sorted by repr: rows may hold NULL ids)."""
    ka = sorted((tuple(r) for r in a.collect()), key=repr)
    kb = sorted((tuple(r) for r in b.collect()), key=repr)
    return ka == kb


def test_split_equals_window_on_testdata(spark):
    df = T.extract_temporal_features(transactions(spark, SF001))
    for r in (7, 20, 66):
        assert same(split_velocity(df, r), plain_velocity(df)), r


def test_split_with_null_timestamps(spark):
    # the dirty variant has unparsable timestamps, NULL ids are dropped first
    df = T.extract_temporal_features(
        dirty_transactions(spark, SF001).dropDuplicates(["transaction_id"])
        .filter(F.col("customer_id").isNotNull()))
    assert df.filter(F.col("timestamp_dt").isNull()).count() > 0
    assert same(split_velocity(df, 9), plain_velocity(df))


def test_one_customer_holding_a_third(spark):
    """Re-key a third of all rows onto one customer: it must be split."""
    base = transactions(spark, SF001)
    hot = base.withColumn(
        "customer_id",
        F.when(F.col("transaction_id") % 3 == 0, F.lit(424242)).otherwise(F.col("customer_id")))
    df = T.extract_temporal_features(hot)
    assert same(split_velocity(df, 25), plain_velocity(df))
    # the hot customer is cut into several window partitions
    from ledgerlens.operators.features import _hot_customers
    h = _hot_customers(df, SkewConfig(rows_per_split=25)).filter("customer_id = 424242").first()
    assert h is not None and h["_n"] > 300


def test_identical_timestamps_in_hot_customer(spark):
    rows = [(i, 1, "2025-10-06 10:00:00") for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id long, timestamp string")
    df = T.extract_temporal_features(df)
    assert same(split_velocity(df, 5), plain_velocity(df))


def partition_sizes(df, rows_per_split):
    rows, _ = T._window_slices(df, SkewConfig(rows_per_split=rows_per_split))
    return [r[-1] for r in rows.groupBy("customer_id", "_slice", "_tie").count()
            .collect()]


def test_large_tie_group_is_spread(spark):
    """400 rows of one customer at one second: the time split cannot cut
    them, the tie spreading does, and the result is still exact."""
    rows = [(i, 1, "2025-10-06 10:00:00") for i in range(400)]
    rows += [(1000 + i, 1, f"2025-10-06 {9 + i % 3:02d}:{i:02d}:00") for i in range(30)]
    rows += [(2000 + i, 2, f"2025-10-06 10:{i:02d}:00") for i in range(10)]
    df = T.extract_temporal_features(spark.createDataFrame(
        rows, "transaction_id long, customer_id long, timestamp string"))
    assert same(split_velocity(df, 50), plain_velocity(df))
    sizes = partition_sizes(df, 50)
    assert max(sizes) <= 100, sorted(sizes)
    assert sum(sizes) == len(rows)


def test_tie_group_with_null_ids(spark):
    """NULL ids sort first inside a tie group: they keep the first place."""
    rows = [(None if i < 2 else i, 1, "2025-10-06 10:00:00") for i in range(60)]
    rows += [(100 + i, 1, f"2025-10-06 09:{i:02d}:00") for i in range(5)]
    rows += [(200, 1, None)]
    df = T.extract_temporal_features(spark.createDataFrame(
        rows, "transaction_id long, customer_id long, timestamp string"))
    assert same(split_velocity(df, 10), plain_velocity(df))
    assert max(partition_sizes(df, 10)) < 60


def test_hot_null_customer_is_split(spark):
    """A NULL customer is one window group; as a hot group it is split too."""
    rows = [(i, None, f"2025-10-06 {i % 24:02d}:{i % 60:02d}:{i % 7:02d}") for i in range(300)]
    rows += [(1000 + i, 5, f"2025-10-06 10:{i:02d}:00") for i in range(20)]
    df = T.extract_temporal_features(spark.createDataFrame(
        rows, "transaction_id long, customer_id long, timestamp string"))
    assert same(split_velocity(df, 40), plain_velocity(df))
    assert max(partition_sizes(df, 40)) < 300


def test_burst_inside_one_slice_is_cut_again(spark):
    """2,000 rows over ten days and a burst of 3,000 distinct seconds in one
    hour: the burst's slice is cut again, the result stays exact."""
    rows = [(i, 7, f"2025-10-{1 + i % 10:02d} {i % 24:02d}:{(i * 7) % 60:02d}:{i % 60:02d}")
            for i in range(2000)]
    rows += [(10000 + i, 7, f"2025-10-05 13:{i // 60:02d}:{i % 60:02d}") for i in range(3000)]
    df = T.extract_temporal_features(spark.createDataFrame(
        rows, "transaction_id long, customer_id long, timestamp string"))
    assert same(split_velocity(df, 200), plain_velocity(df))
    sizes = partition_sizes(df, 200)
    assert sum(sizes) == len(rows)
    assert max(sizes) <= 400, sorted(sizes)[-5:]


def test_nine_tenths_in_one_hour_over_ten_years(spark):
    """Equal-depth slices: the narrow burst is cut as finely as its rows need."""
    rows = [(i, 7, f"{2015 + i % 10}-{1 + i % 12:02d}-{1 + i % 28:02d} 08:{i % 60:02d}:00") for i in range(400)]
    rows += [(10000 + i, 7, f"2020-10-05 13:{i // 60:02d}:{i % 60:02d}") for i in range(3600)]
    df = T.extract_temporal_features(spark.createDataFrame(
        rows, "transaction_id long, customer_id long, timestamp string"))
    assert same(split_velocity(df, 200), plain_velocity(df))
    sizes = partition_sizes(df, 200)
    assert sum(sizes) == len(rows) and max(sizes) <= 400 and len(sizes) >= 20


def test_slices_of_a_joined_hot_customer_lie_in_several_tasks(spark):
    """Rows that come clustered by customer from a sort-merge join are dealt
    again by slice: no task of the window holds all rows of the hot customer."""
    rows = 4_000
    i = F.col("id")
    events = spark.range(rows).select(
        i.alias("transaction_id"), F.when(i % 4 < 3, 7).otherwise(i).alias("user"),
        F.timestamp_seconds(1_704_067_200 + i * 60).alias("timestamp_dt"))
    customers = spark.range(rows).select(i.alias("customer_id"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = events.join(customers, F.col("user") == F.col("customer_id")).drop("user")
        out = T.add_velocity_features(df, skew=SkewConfig(rows_per_split=250))
        tasks = out.filter("customer_id = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(t["count"] for t in tasks) == out.filter("customer_id = 7").count() >= rows * 3 // 4
        assert max(t["count"] for t in tasks) <= rows * 3 // 8, tasks
        assert same(out.select("transaction_id", "minutes_since_last_transaction", "customer_transaction_count"),
                    plain_velocity(df))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
