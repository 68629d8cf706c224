"""Property tests: the hot-customer split equals one window for any data,
and group counts always add up to the total."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators import analytics as A
from ledgerlens.operators import features as T

from test_skew import plain_velocity, same, split_velocity

ROW = st.tuples(
    st.integers(min_value=1, max_value=4),                       # customer
    st.one_of(st.none(), st.integers(min_value=0, max_value=50)),  # minute of the day
    st.sampled_from(["APPROVED", "DECLINED", "FRAUD", "PENDING"]),
    st.floats(min_value=0.01, max_value=5000, allow_nan=False).map(lambda x: round(x, 2)),
)


def frame(spark, rows):
    data = [
        (i, c, None if m is None else f"2025-10-06 {m // 60:02d}:{m % 60:02d}:00", s, a)
        for i, (c, m, s, a) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data, "transaction_id long, customer_id long, timestamp string, status string, "
              "amount double")
    return T.extract_temporal_features(df)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=40), split=st.integers(min_value=1, max_value=8))
def test_split_equals_window(spark, rows, split):
    df = frame(spark, rows)
    assert same(split_velocity(df, split), plain_velocity(df))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=40))
def test_groups_add_up(spark, rows):
    df = frame(spark, rows).withColumn("risk_score", F.lit(0))
    total = df.count()
    for fn in (A.by_time_slot, A.fraud_rate_by_hour):
        assert fn(df).agg(F.sum("total_transactions")).first()[0] == total
    s = A.summary_stats(df).first()
    assert s["approved"] + s["declined"] <= s["total_transactions"]


CUBE_ROW = st.tuples(
    st.one_of(st.none(), st.integers(min_value=1, max_value=5)),     # customer
    st.one_of(st.none(), st.sampled_from(["ES", "FR"])),             # country
    st.sampled_from(["A", "B", None]),                               # account type
    st.one_of(st.none(), st.integers(min_value=0, max_value=50)),    # minute of the day
    st.sampled_from(["APPROVED", "DECLINED", "FRAUD", "PENDING"]),
    st.one_of(st.none(), st.floats(min_value=0.01, max_value=5000, allow_nan=False)
              .map(lambda x: round(x, 2))),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(CUBE_ROW, min_size=0, max_size=30))
def test_cube_equals_direct_analyses(spark, rows):
    from ledgerlens.functions import labels as L
    from ledgerlens.operators import report as R
    from ledgerlens.operators import rules as RU
    from test_cube import rows as collected
    data = [
        (i, c, co, a, None if m is None else f"2025-10-0{4 + i % 3} {m // 60:02d}:{m % 60:02d}:00",
         s, amt, "EUR", f"cat_{i % 3}", f"ch_{i % 2}")
        for i, (c, co, a, m, s, amt) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data, "transaction_id long, customer_id long, country string, account_type string, "
              "timestamp string, status string, amount double, currency string, "
              "category string, channel string")
    df = T.extract_temporal_features(df).withColumns({
        "risk_score": (F.col("transaction_id") % 9).cast("int"),
        "is_suspicious_night": F.col("time_slot") == L.SLOT_NIGHT,
        "is_suspicious_velocity": F.col("transaction_id") % 4 == 0,
    })
    cube = A.analysis_cube(df)
    for name, derive in A.FROM_CUBE.items():
        assert collected(derive(cube)) == collected(A.ANALYSES[name](df)), name
    assert collected(R.executive_summary_from_cube(cube)) == collected(
        R.executive_summary(RU.detect_fraud_patterns(df)))
