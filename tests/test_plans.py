"""Physical-plan checks: pushdown, pruning, shuffles, top-k."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import scratch_path
from ledgerlens.operators import analytics as A
from ledgerlens.operators import clean as C
from ledgerlens.operators import features as T
from ledgerlens.sources import files as IO
from ledgerlens.sources.testdata import transactions

from tables import SF001


def scans(p):
    """Parquet scan nodes in a formatted plan."""
    return len(re.findall(r"^\(\d+\) Scan parquet", p, re.M))


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    raw = transactions(spark, SF001)
    validated = scratch_path(spark, "plan-validated")
    IO.write_parquet(raw, validated)
    processed = scratch_path(spark, "plan-processed")
    IO.write_partitioned(T.enrich(spark.read.parquet(validated)), processed)
    return spark.read.parquet(validated), spark.read.parquet(processed)


def test_filter_pushed_to_scan(tables):
    _, processed = tables
    p = plan(A.high_value_declined(processed))
    assert "PushedFilters: [IsNotNull(status), IsNotNull(amount), EqualTo(status,DECLINED), " \
           "GreaterThan(amount,1000.0)]" in p
    assert "TakeOrderedAndProject" in p


def test_columns_pruned(tables):
    _, processed = tables
    p = plan(A.by_currency(processed))
    assert "ReadSchema: struct<amount:double,currency:string>" in p


def test_partition_pruning(tables):
    _, processed = tables
    p = plan(processed.filter((F.col("month") == 1) & (F.col("day") == 15)).select("amount"))
    assert "PartitionFilters: [isnotnull(month" in p
    assert "(day" in p and "= 15)" in p


def test_enrichment_has_one_wide_shuffle(tables):
    """With hot customers (a small split size): the full rows move once; the
    skew tables are broadcast, their size bounded by ``rows_per_split``."""
    from ledgerlens.config import SkewConfig
    validated, _ = tables
    feats = T.extract_temporal_features(validated)
    p = plan(T.add_velocity_features(feats, skew=SkewConfig(rows_per_split=20)))
    widths = [int(n) for n in re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]", p)]
    # the full rows (12 raw columns and more) move once, by (customer,
    # slice, tie group); every other exchange carries aggregated
    # or broadcast rows of a few columns
    assert len([w for w in widths if w >= 12]) == 1, widths
    assert all(w <= 8 for w in widths if w < 12), widths
    assert "BroadcastExchange" in p


def test_building_a_query_starts_no_job(spark, tables):
    """Operators are lazy: the enrichment and what is built on it run no job
    before an action, whatever the skew."""
    from ledgerlens.config import Settings, SkewConfig
    validated, _ = tables
    tracker, group = spark.sparkContext.statusTracker(), "lazy-build"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        for r in (20, 2_000_000):
            df = T.enrich(validated, Settings(skew=SkewConfig(rows_per_split=r)))
            A.by_time_slot(df), A.analysis_cube(df)
            assert len(tracker.getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_plan_whatever_the_size(tables):
    """The same operators for any number of hot customers."""
    from ledgerlens.config import SkewConfig
    validated, _ = tables
    feats = T.extract_temporal_features(validated)
    shapes = {re.sub(r"[^A-Za-z+:\n ]|plan_id.*", "", re.sub(r"\[.*|\(.*", "", line))
              for r in (20, 100, 2_000_000)
              for line in ["|".join(re.findall(r"[A-Z][A-Za-z]+(?:Exec|Join|Exchange|Aggregate|Window|Expand|Sort|Scan)?", x.split("(")[0].split("[")[0])[0]
                                    for x in plan(T.add_velocity_features(feats, skew=SkewConfig(rows_per_split=r)), "simple").splitlines()
                                    if re.search("[A-Z]", x.split("(")[0].split("[")[0]))]}
    assert len(shapes) == 1


def test_enrichment_without_hot_customers_runs_one_window(spark, tables):
    """With no hot customer the broadcast side is empty and AQE drops the
    skew branches at run time: one scan, one exchange, one window."""
    validated, _ = tables
    df = T.enrich(validated)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0].split("\n\n")[0]
    assert final.count("Scan parquet") == 1
    assert final.count("Exchange (") == 1
    assert "Window" in final and "BroadcastHashJoin" not in final


def test_top_customers_is_top_k(tables):
    _, processed = tables
    assert "TakeOrderedAndProject" in plan(A.top_customers(processed))


def test_dedup_is_partial_aggregate_not_window(tables):
    validated, _ = tables
    p = plan(C.deduplicate(validated))
    assert "partial_min" in p
    assert "Window" not in p


def test_category_share_scans_once(tables):
    """The total is a subquery over the reused exchange of the categories:
    no window, and the table is read once."""
    _, processed = tables
    df = A.by_category(processed)
    df.collect()
    p = plan(df, "simple").split("== Initial Plan ==")[0]
    assert "Window" not in p and "ReusedExchange" in plan(df, "simple")


def test_distinct_customers_in_one_scan_by_hash(spark, tables):
    """Measures and distinct customers from one scan, hash
    aggregates only, and no exchange that holds a row per customer."""
    from ledgerlens.operators import report as R
    from ledgerlens.operators import rules as RU
    _, processed = tables
    for df in (R.executive_summary(RU.detect_fraud_patterns(processed)),
               A.summary_stats(processed), A.by_country(processed), A.weekend_vs_weekday(processed)):
        p = plan(df)
        assert scans(p) == 1
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
        blocks = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", p)
        assert len([b for b in blocks if "bit_or" in b]) == 1 and not any("customer_id" in b for b in blocks), blocks


def test_a_million_dirty_categories_stay_apart(spark):
    """Shares, row numbers and the report of very many categories: no
    exchange brings them into one task."""
    from ledgerlens.operators import report as R
    n = 1_000_000
    t = spark.range(n, numPartitions=8).select("id")
    t = t.unionByName(t.where("id in (7, 55555, 999999)")).select(
        F.concat(F.lit("cat"), F.col("id")).alias("category"), (F.col("id") % 100).cast("double").alias("amount"))
    g = A.by_category(t)
    lines = R.numbered(R.report_category(g), [F.col("total_transactions").desc(), F.col("category")])
    for p in (plan(g), plan(lines)):
        for block in re.findall(r"\(\d+\) Exchange\n(.*)\nArguments: SinglePartition", p):
            assert "category" not in block
    got = lines.agg(F.count(F.lit(1)), F.min("row_no"), F.max("row_no"), F.countDistinct("row_no")).first()
    assert tuple(got) == (n, 1, n, n)
    first = {r.row_no: r.category for r in lines.where("row_no <= 6 or row_no = 1000000").collect()}
    assert first == {1: "cat55555", 2: "cat7", 3: "cat999999", 4: "cat0", 5: "cat1", 6: "cat10", n: "cat999998"}


def test_partitioned_write_rebalances_by_day(spark, tables):
    """Rows of every day in every task (as after the per-customer shuffle)
    would write one file per (task, day); rebalancing by the partition
    columns writes about one file per day."""
    import glob
    validated, _ = tables
    enriched = T.enrich(validated)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # keep every shuffle partition a task
    try:
        counts = {}
        for rebalance in (False, True):
            path = scratch_path(spark, f"plan-layout-{rebalance}")
            IO.write_partitioned(enriched, path, rebalance=rebalance)
            files = glob.glob(f"{path}/year=*/month=*/day=*/*.parquet")
            days = glob.glob(f"{path}/year=*/month=*/day=*")
            counts[rebalance] = (len(files), len(days))
            assert spark.read.parquet(path).count() == enriched.count()
    finally:
        spark.conf.set(key, old)
    files, days = counts[True]
    assert files == days
    assert counts[False][0] > 2 * days


def test_verified_write_counts_in_the_write_stage(tables):
    """The observation sits above the rebalance exchange (result stage)."""
    validated, _ = tables
    df = IO.rebalanced(T.enrich(validated), "year", "month", "day")
    from pyspark.sql import Observation
    p = plan(df.observe(Observation("o"), F.count(F.lit(1)).alias("n")), "simple")
    lines = p.splitlines()
    metrics = next(i for i, line in enumerate(lines) if "CollectMetrics" in line)
    rebalance = next(i for i, line in enumerate(lines) if "REBALANCE_PARTITIONS_BY_COL" in line)
    assert metrics < rebalance


def test_validation_report_shuffles_only_keys(tables):
    """The distinct-key count shuffles the key alone; the check counters
    meet in one partial aggregate per task."""
    from ledgerlens.config import REFERENCE_DOMAINS
    from ledgerlens.operators import quality as V
    from ledgerlens.schema import RAW_SCHEMA
    validated, _ = tables
    p = plan(V.generate_validation_report(validated, RAW_SCHEMA, REFERENCE_DOMAINS))
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]: .*\nArguments: (\w+)", p)
    by_key = [int(n) for n, kind in blocks if kind == "hashpartitioning"]
    assert blocks and all(n <= 3 for n in by_key), blocks
    assert scans(p) == 2


def test_configure_keeps_the_sessions_sizing(spark):
    """Semantics are enforced (UTC); sizing set by the session is kept."""
    from ledgerlens.config import configure
    key, zone = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "256m")
    spark.conf.set(zone, "America/New_York")
    try:
        configure(spark)
        assert spark.conf.get(key) == "256m"
        assert spark.conf.get(zone) == "UTC"
    finally:
        spark.conf.set(key, old)
        configure(spark)


def test_csv_export_writes_sized_files(spark, tables):
    """A filter over many tasks: rebalanced, the (small) export is one file;
    kept as is, it is one file per task."""
    validated, _ = tables
    many = validated.repartition(8).filter(F.col("amount") > 100)
    counts = {}
    for rebalance in (True, False):
        path = scratch_path(spark, f"plan-csv-{rebalance}")
        IO.write_csv(many, path, rebalance=rebalance)
        counts[rebalance] = len(spark.read.csv(path).inputFiles())
    assert counts[True] == 1
    assert counts[False] == 8


def test_skew_tables_are_broadcast_by_hint(spark, tables):
    """The tie and edge joins are broadcast by their hints
    (automatic broadcasting off, so only a hint can broadcast)."""
    from ledgerlens.config import SkewConfig
    validated, _ = tables
    feats = T.extract_temporal_features(validated)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        p = plan(T.add_velocity_features(feats, skew=SkewConfig(rows_per_split=20)), "simple")
    finally:
        spark.conf.set(key, old)
    joins = [line for line in p.splitlines() if "Join" in line]
    edge_join = next(line for line in joins if "_ec#" in line)
    tie_join = next(line for line in joins if "_tc#" in line)
    assert "BroadcastHashJoin" in edge_join and "BroadcastHashJoin" in tie_join


def test_a_windows_partitions_stay_small(spark):
    """The default partition size bounds the rows that one task of a window
    holds, however many there are."""
    from pyspark.sql import Window

    from ledgerlens.config import SIZING_DEFAULTS
    size, width = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"
    old = {k: spark.conf.get(k) for k in (size, width)}
    try:
        spark.conf.set(size, SIZING_DEFAULTS[size])
        spark.conf.set(width, "64")
        wide = spark.range(2_000_000).select((F.col("id") % 5003).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
        before = wide.withColumn("before", F.lag("x").over(Window.partitionBy("k").orderBy("id")))
        rows = before.groupBy(F.spark_partition_id().alias("task")).agg(F.count("before").alias("n")).agg(F.max("n"))
        assert rows.first()[0] <= 500_000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
