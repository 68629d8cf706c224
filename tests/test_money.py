"""Exact money sums and ROUND as SQL has it."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators import analytics as A


def figures(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    return df.agg(X.money_total("amount").alias("total"), X.money_avg("amount").alias("avg")).first()


@pytest.mark.parametrize(("amounts", "total", "avg"), [
    ([1.005], 1.01, 1.01),
    ([-1.005], -1.01, -1.01),
    ([0.004] * 1000, 4.0, 0.0),
    ([0.1] * 10, 1.0, 0.1),
    ([1e17, 0.25], 1e17, 5e16),
    ([1e300, 1.0], 1e300, 5e299),
    ([math.inf, 2.0], math.inf, math.inf),
    ([-math.inf, 2.0], -math.inf, -math.inf),
    ([None, 2.5], 2.5, 2.5),
])
def test_totals_and_averages(spark, amounts, total, avg):
    assert tuple(figures(spark, amounts)) == (total, avg)


def test_nan_stays_and_nothing_gives_null(spark):
    assert all(map(math.isnan, figures(spark, [math.nan, 1.0])))
    assert tuple(figures(spark, [None])) == (None, None)


@pytest.mark.parametrize(("part", "whole", "rate"), [(201, 20000, 1.01), (1, 3, 33.33), (2, 3, 66.67), (0, 5, 0.0), (1, 0, None)])
def test_rates(spark, part, whole, rate):
    row = spark.range(1).select(X.pct(F.lit(part).cast("long"), F.lit(whole).cast("long")).alias("r")).first()
    assert row.r == rate


def test_cube_and_analyses_agree_on_extreme_amounts(spark):
    from tables import SF001

    from ledgerlens.plans.registry import processed
    df = processed(spark, SF001).withColumn("amount", F.when(
        F.col("transaction_id") % 97 == 0, F.lit(1e17)).when(F.col("transaction_id") % 89 == 0, F.lit(math.inf))
        .when(F.col("transaction_id") % 83 == 0, F.lit(0.004)).otherwise(F.col("amount")))
    cube = A.analysis_cube(df)
    for name in ("by_country", "by_currency", "top_customers", "summary_stats"):
        assert A.FROM_CUBE[name](cube).collect() == A.ANALYSES[name](df).collect()


ORDERS = {
    "by_country": lambda r: (-r.total_amount, r.country), "by_currency": lambda r: (-r.total_transactions, r.currency),
    "by_category": lambda r: (-r.total_transactions, r.category), "by_channel": lambda r: (-r.total_transactions, r.channel),
    "by_time_slot": lambda r: ["Madrugada", "Mañana", "Tarde", "Noche"].index(r.time_slot),
    "top_customers": lambda r: (-r.total_spent, r.customer_id), "fraud_rate_by_hour": lambda r: r.hour,
    "weekend_vs_weekday": lambda r: ["Entre Semana", "Fin de Semana"].index(r.period_type),
    "high_value_declined": lambda r: (-r.amount, r.transaction_id),
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order_of_the_rows(spark, name):
    from tables import SF001

    from ledgerlens.plans.registry import queries
    rows = queries()[name](spark, SF001).collect()
    assert rows == sorted(rows, key=ORDERS[name]) and rows
