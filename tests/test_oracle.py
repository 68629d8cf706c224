"""Every registered query against its DuckDB oracle (sf0.001)."""


from tables import SF001
from oracle_compare import compare


def test_all_queries_match_oracle(spark):
    from ledgerlens.plans import registry
    bad = compare(spark, SF001, sorted(registry.queries()))
    assert bad == []


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() == 57
    assert "fraud_reasons" in df.columns


def test_every_query_has_oracle_or_is_rows_only():
    from ledgerlens.plans.registry import oracle_sql, queries
    rows_only = set(queries()) - set(oracle_sql())
    assert rows_only == set()
    assert set(oracle_sql()) <= set(queries())


def test_queries_match_with_ansi_off(spark):
    """The expressions do not depend on ANSI mode (Spark 3 sessions run
    without it): parsing, integer division, casts, dedup and rates."""
    key = "spark.sql.ansi.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        bad = compare(spark, SF001, ["feat_temporal", "fraud_alerts", "by_country",
                                     "quality_report", "clean_transactions", "summary_stats"])
    finally:
        spark.conf.set(key, old)
    assert bad == []
