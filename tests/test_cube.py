"""The analysis cube: every result read off it equals the direct analysis,
also with NULL groups, a customer holding a third of the rows, and an empty
table; its plan scans the table twice and aggregates by hash."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import analytics as A
from ledgerlens.operators import report as R
from ledgerlens.operators import rules as RU
from ledgerlens.plans import registry

from tables import SF001


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def assert_cube_matches(table):
    cube = A.analysis_cube(table).cache()
    try:
        for name, derive in A.FROM_CUBE.items():
            want, got = A.ANALYSES[name](table), derive(cube)
            assert got.columns == want.columns, name
            assert rows(got) == rows(want), name
        want = R.executive_summary(RU.detect_fraud_patterns(table))
        got = R.executive_summary_from_cube(cube)
        assert got.columns == want.columns
        assert rows(got) == rows(want)
    finally:
        cube.unpersist()


@pytest.fixture(scope="module")
def processed(spark):
    return registry.written_processed(spark, SF001)


def test_cube_equals_direct_analyses(processed):
    assert_cube_matches(processed)


def test_cube_with_null_groups_and_hot_customer(processed):
    i = F.col("transaction_id")
    odd = processed.withColumns({
        # a third of all rows belong to one customer
        "customer_id": F.when(i % 3 == 0, F.lit(1).cast("bigint"))
        .when(i % 17 == 0, F.lit(None).cast("bigint")).otherwise(F.col("customer_id")),
        "country": F.when(i % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("country")),
        "account_type": F.when(i % 11 == 0, F.lit(None).cast("string"))
        .when(i % 7 == 0, F.lit("ZZZ")).otherwise(F.col("account_type")),
        "amount": F.when(i % 19 == 0, F.lit(None).cast("double")).otherwise(F.col("amount")),
    })
    assert_cube_matches(odd)


def test_cube_of_empty_table(processed):
    empty = processed.limit(0)
    assert rows(A.summary_from_cube(A.analysis_cube(empty))) == rows(A.summary_stats(empty))
    got = R.executive_summary_from_cube(A.analysis_cube(empty)).first()
    assert got["total_transactions"] == 0 and got["total_alerts"] == 0


def test_cube_plan_two_scans_hash_aggregates(processed):
    p = plan(A.analysis_cube(processed))
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 2
    assert "SortAggregate" not in p
    assert "Expand" in p
    # table sets, customer profile, sets over the profile
    assert len(re.findall(r"^Arguments: hashpartitioning", p, re.M)) == 3


def test_top_customers_shuffles_customers_once_by_hash(processed):
    """Fixed-width buffers per customer, one exchange by customer; strings are
    looked up for the rows of the top-k alone, which are broadcast."""
    p = plan(A.top_customers(processed))
    blocks = re.findall(r"\(\d+\) Exchange\nInput \[(\d+)\]: \[(.*)\]\nArguments: hashpartitioning\((.*?), \d+\)", p)
    alone = [keys for _, _, keys in blocks if re.fullmatch(r"customer_id#\d+L", keys)]
    assert len(alone) == 1, blocks
    first = p.split("\n\n")[1:]
    scans = [b for b in first if "ReadSchema" in b]
    assert len(scans) == 2 and any("struct<customer_id:bigint,account_type:string>" in b for b in scans)
    assert "TakeOrderedAndProject" in p and "BroadcastHashJoin" in p


def test_top_customers_of_hot_tied_and_null_customers(spark):
    """A third of the rows on one customer, ties of the spend, NULL customers,
    types and amounts, the largest type found outside the first rows."""
    data = ([(1, "B", 1.0)] * 500 + [(1, "Z", 0.0)] + [(c, t, 10.0) for c in range(2, 40) for t in ("A", None)]
            + [(None, "Q", 7.5)] * 3 + [(77, None, None), (78, None, 500.0)])
    df = spark.createDataFrame(data, "customer_id long, account_type string, amount double").withColumns(
        {"status": F.lit("DECLINED"), "risk_score": F.lit(1), "timestamp_dt": F.lit(None).cast("timestamp"),
         "is_suspicious_night": F.lit(False), "is_suspicious_velocity": F.lit(False)})
    got = [tuple(r) for r in A.top_customers(df, 5).collect()]
    assert got == [(1, 501, 500.0, round(500 / 501, 2), "Z", 501), (78, 1, 500.0, 500.0, None, 1),
                   (None, 3, 22.5, 7.5, "Q", 3), (2, 2, 20.0, 10.0, "A", 2), (3, 2, 20.0, 10.0, "A", 2)]
    assert A.top_customers(df.limit(0), 5).collect() == []


def test_unique_customers_equal_count_distinct(spark):
    """The bitmaps count like countDistinct: NULL groups and customers,
    neighbouring, far apart, negative and extreme ids, grouped and global, also
    on an empty input."""
    ids = [*range(0, 1030), 511, 512, 513, -1, -64, -512, -513, 2 ** 63 - 1, -2 ** 63, 2 ** 40 + 5, None, None]
    data = [(["ES", "FR", None][i % 3], c, float(i % 7)) for i, c in enumerate(ids * 2)]
    df = spark.createDataFrame(data, "country string, customer_id long, amount double").repartition(5)
    measures = [F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.min("amount").alias("amount_min")]
    for frame in (df, df.limit(0)):
        for keys in (["country"], []):
            got = A.with_unique_customers(frame, keys, measures)
            want = frame.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"), F.min("amount").alias("amount_min"),
                F.countDistinct("customer_id").alias("unique_customers"))
            if frame.count():
                assert rows(got) == rows(want), keys
            else:
                assert [r.unique_customers for r in got.collect()] == [0] * (not keys)
