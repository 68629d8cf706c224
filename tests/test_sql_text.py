"""The analyses by SQL text over the registered view."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import analytics as A
from ledgerlens.operators import rules as RU
from ledgerlens.plans import registry
from ledgerlens.plans import sql_analyses as Q
from tables import SF001


@pytest.fixture(scope="module")
def processed(spark):
    return registry.written_processed(spark, SF001)


@pytest.mark.parametrize("name", sorted(A.ANALYSES))
def test_text_equals_the_function_in_rows_and_order(spark, processed, name):
    Q.register(processed)
    got, want = Q.analysis(spark, name), A.ANALYSES[name](processed)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_texts_over_extreme_amounts_and_an_empty_view(spark, processed):
    odd = processed.withColumn("amount", F.when(F.col("transaction_id") % 3 == 0, F.lit(float(2 ** 60))).when(
        F.col("transaction_id") % 3 == 1, F.lit(None).cast("double")).otherwise(F.col("amount")))
    for frame in (odd, processed.limit(0)):
        Q.register(frame, "odd_view")
        for name in A.ANALYSES:
            assert [tuple(r) for r in Q.analysis(spark, name, "odd_view").collect()] == [
                tuple(r) for r in A.ANALYSES[name](frame).collect()], name


def test_a_free_text_over_the_view(spark, processed):
    Q.register(processed)
    got = spark.sql(f"SELECT COUNT(*) AS n FROM {Q.VIEW} WHERE status = 'DECLINED'").first()["n"]
    assert got == processed.where("status = 'DECLINED'").count()


def test_summaries_from_the_alerts_equal_those_of_the_table(processed):
    scored = RU.detect_fraud_patterns(processed)
    for frame in (scored, scored.where("false"), scored.where("not is_fraud_detected")):
        alerts = RU.fraud_alerts(frame)
        own = RU.summaries_from_cube(RU.alert_cube(alerts), frame.count())
        rows = lambda df: [tuple(r) for r in df.collect()]
        assert rows(own["fraud_totals"]) == rows(RU.fraud_totals(frame))
        assert rows(own["fraud_by_priority"]) == rows(RU.fraud_by_priority(frame))
        assert rows(own["fraud_by_country"]) == rows(RU.fraud_by_country(frame))
        assert sorted(rows(own["fraud_rule_hits"])) == sorted(rows(RU.fraud_rule_hits(frame)))
        assert rows(RU.top_risk(alerts)) == rows(RU.fraud_top_risk(frame))
