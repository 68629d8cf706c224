"""Day by day equals at once; late rows; what the plan reads."""

import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import Settings, SkewConfig, scratch_path
from ledgerlens.operators import carry as D
from ledgerlens.operators import features as T
from ledgerlens.plans import registry
from ledgerlens.schema import PROCESSED_COLUMNS, RAW_SCHEMA
from ledgerlens.sources import files as IO
from tables import SF001
from test_plans import plan, scans


def step(spark, day, carry, settings=Settings()):
    """In-time rows enriched, late rows, the next carry (written)."""
    new, late = D.split_late(day, carry, settings)
    path = scratch_path(spark, "test-carry")
    IO.write_parquet(D.next_carry(carry, T.extract_temporal_features(new)), path)
    return D.enrich_day(new, carry, settings), late, IO.read_parquet(spark, path)


def rows(df):
    return sorted(map(str, df.select(*PROCESSED_COLUMNS).collect()))


def row(i, customer, time, amount=600.0):
    return (i, customer, "a", "ES", amount, "EUR", "c", "ch", time, "APPROVED", "M1", "0001")


@pytest.fixture(scope="module")
def month(spark):
    """Customers over days: a hot one, a NULL one, ties, rows without a time,
    a customer who comes back after days."""
    data = [row(i, 1, f"2024-01-{1 + i // 40:02d} {i % 24:02d}:{i % 60:02d}:00") for i in range(160)]
    data += [row(1000 + i, None, f"2024-01-{1 + i % 4:02d} 10:00:00") for i in range(12)]
    data += [row(2000 + i, 2 + i % 5, f"2024-01-{1 + i % 4:02d} 12:0{i % 3}:00") for i in range(40)]
    data += [row(3000, 9, "2024-01-01 00:00:00"), row(3001, 9, "2024-01-04 23:59:59"), row(3002, 8, "2024-01-03 00:03:00")]
    data += [row(4000 + i, 1 + i % 3, None) for i in range(6)]
    return spark.createDataFrame(data, RAW_SCHEMA).repartition(5)


@pytest.mark.parametrize("split", [2_000_000, 10])
def test_day_by_day_equals_at_once(spark, month, split):
    settings = Settings(skew=SkewConfig(rows_per_split=split))
    number, carry, parts = F.dayofmonth(F.try_to_timestamp("timestamp")), D.no_carry(spark), []
    for k in (1, 2, 3, 4):
        day = month.where((number == k) | (F.lit(k) == 2) & F.col("timestamp").isNull())
        out, late, carry = step(spark, day, carry, settings)
        assert late.count() == 0
        parts.append(out)
    got = D.with_counts(reduce(DataFrame.unionByName, parts), carry)
    assert rows(got) == rows(T.enrich(month, settings))
    assert carry.count() == month.select("customer_id").distinct().count()


def test_the_plan_reads_the_day_and_the_carry_alone(spark, month):
    history, new = scratch_path(spark, "c-history"), scratch_path(spark, "c-new")
    month.where("timestamp < '2024-01-04'").write.parquet(history)
    month.where("timestamp >= '2024-01-04'").write.parquet(new)
    _, _, carry = step(spark, spark.read.parquet(history), D.no_carry(spark))
    day, late = D.split_late(spark.read.parquet(new), carry)
    p = plan(D.enrich_day(day, carry))
    assert scans(p) >= 2 and "c-history" not in p and "c-new" in p and "test-carry" in p
    assert set(re.findall(r"ReadSchema: struct<customer_id:bigint,last_time:timestamp.*?>", p)) == {
        "ReadSchema: struct<customer_id:bigint,last_time:timestamp>"}


def test_late_rows_are_handed_back_and_repaired(spark, month):
    first, _, carry = step(spark, month.where("timestamp >= '2024-01-03'"), D.no_carry(spark))
    second = month.where("timestamp < '2024-01-03'")
    new, late = D.split_late(second, carry)
    seen = {r.customer_id: r.last_time for r in carry.collect()}
    ids = {r.transaction_id for r in T.extract_temporal_features(second).collect()
           if r.customer_id in seen and seen[r.customer_id] and r.timestamp_dt < seen[r.customer_id]}
    assert {r.transaction_id for r in late.collect()} == ids and ids
    assert new.count() + late.count() == second.count()
    # their customers enriched again, all others as given out: as if at once
    history = month.where("timestamp is not null and not transaction_id in (%s)" % ",".join(map(str, ids)))
    again = T.enrich(D.affected(history, late))
    everything = T.enrich(month.where("timestamp is not null"))
    who = [r.customer_id for r in late.select("customer_id").distinct().collect()]
    keep = F.col("customer_id").isin([c for c in who if c is not None]) | F.col("customer_id").isNull()
    assert rows(again) == rows(everything.where(keep))
    # equal to the last known time is not late
    tie = spark.createDataFrame([row(9000, 9, "2024-01-04 23:59:59"), row(9001, 9, "2024-01-04 23:59:58")], RAW_SCHEMA)
    assert [r.transaction_id for r in D.split_late(tie, carry)[1].collect()] == [9001]


def test_empty_days(spark, month):
    out, late, carry = step(spark, month, D.no_carry(spark))
    none, late, same = step(spark, month.where("false"), carry)
    assert none.count() == 0 and late.count() == 0
    assert sorted(map(str, same.collect())) == sorted(map(str, carry.collect()))


def test_the_registered_query_has_no_late_rows(spark):
    assert registry.enriched_by_days(spark, SF001).count() == 1000
