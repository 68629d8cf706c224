"""Six-stage run, sinks and the anchors of FIXTURES.md §5."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlens.config import scratch_path
from ledgerlens.operators import analytics as A
from ledgerlens.operators import report as R
from ledgerlens.operators import rules as RU
from ledgerlens.plans import registry
from ledgerlens.plans.workflow import STAGES, run_all
from ledgerlens.sources import files as IO

from tables import SF001


def test_run_all_stages_ok(spark):
    res = run_all(spark, registry.raw(spark, SF001))
    assert [m[0] for m in res.metrics] == list(STAGES)
    assert res.ok(), res.values.get("error")
    rows = dict((m[0], m[2]) for m in res.metrics)
    assert rows["ingest"] == 1000 and rows["transform"] == 1000 and rows["fraud"] == 57
    report = spark.read.text(f"{res.paths['reports']}/report_md").collect()
    assert report[0]["value"].startswith("# ")
    assert any("57 alertas" in r["value"] for r in report)
    csv = IO.read_csv(spark, res.paths["alerts_csv"], IO.alert_csv_schema())
    assert csv.count() == 57
    text = [r["value"] for r in spark.read.text(f"{res.paths['reports']}/report_txt").collect()]
    assert text[0] == "=" * 80 and text[-1] == "=" * 80
    assert any(line.startswith(R.TXT_GENERATED) for line in text)
    assert R.TXT_ALERT_TOTAL + "57" in text
    assert sum(line.startswith("  ✅ Fase ") for line in text) == len(STAGES)


def test_anchors_sf0001(spark):
    s = registry.scored(spark, SF001)
    hits = {r["rule"]: r["hits"] for r in RU.fraud_rule_hits(s).collect()}
    assert hits == {"fraud_rule_status": 14, "fraud_rule_high_declined": 2,
                    "fraud_rule_night": 40, "fraud_rule_velocity": 3}
    prio = {r["alert_priority"]: r["count"] for r in RU.fraud_by_priority(s).collect()}
    assert prio == {"CRÍTICA": 14, "MEDIA": 13, "BAJA": 30}
    vel = {r["transaction_velocity"]: r["n"]
           for r in s.groupBy("transaction_velocity").agg(F.count("*").alias("n")).collect()}
    assert vel == {"Primera Transacción": 15, "Muy Rápida": 10, "Rápida": 44, "Normal": 123,
                   "Lenta": 808}
    amt = {r["amount_category"]: r["n"]
           for r in s.groupBy("amount_category").agg(F.count("*").alias("n")).collect()}
    assert amt == {"Bajo": 92, "Medio": 225, "Alto": 547, "Muy Alto": 136}
    assert s.filter("risk_score >= 7").count() == 0


def test_group_counts_add_up(spark):
    p = registry.processed(spark, SF001)
    total = p.count()
    for fn in (A.by_country, A.by_currency, A.by_category, A.by_time_slot, A.by_channel,
               A.fraud_rate_by_hour, A.weekend_vs_weekday):
        assert fn(p).agg(F.sum("total_transactions")).first()[0] == total
    pct = A.by_category(p).agg(F.sum("percentage")).first()[0]
    assert abs(pct - 100.0) < 0.1


def test_missing_csv_fails(spark):
    with pytest.raises(AnalysisException):
        IO.read_csv(spark, "/nonexistent/ledgerlens/transactions.csv").count()


def test_missing_saved_results_is_none(spark):
    from pyspark.sql.types import StructType
    assert IO.read_results_json(spark, scratch_path(spark, "none"), "by_country",
                                StructType()) is None


def test_report_without_saved_results(spark):
    s = R.executive_summary(registry.scored(spark, SF001))
    sections = {r["section"] for r in R.report_lines(s).collect()}
    assert sections == {"resumen", "estados", "alertas", "pais", "categoria", "temporal", "conclusiones"}


def test_status_always_four_rows(spark):
    s = R.executive_summary(registry.scored(spark, SF001).filter("status = 'APPROVED'"))
    got = {r["status"]: r["count"] for r in R.status_distribution(s).collect()}
    assert set(got) == {"APPROVED", "DECLINED", "FRAUD", "PENDING"}
    assert got["FRAUD"] == 0


def test_write_verify_counts(spark):
    r = IO.write_verified(registry.raw(spark, SF001), scratch_path(spark, "wv")).first()
    assert r["written_rows"] == r["read_rows"] == 1000


def test_corrupt_record_column(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("transaction_id,customer_id,account_type,country,amount,currency,category,"
                 "channel,timestamp,status,merchant_id,card_last4\n"
                 "1,2,A,ES,notanumber,EUR,c,h,2025-10-06 10:00:00,APPROVED,M1,0001\n")
    df = IO.read_csv(spark, str(p), corrupt_column="_corrupt")
    r = df.first()
    assert r["amount"] is None and r["_corrupt"] is not None


def test_observed_validation_equals_report(spark):
    """The one-pass ingest reports the same checks as the standalone report."""
    from ledgerlens.operators import quality as V
    from ledgerlens.schema import RAW_SCHEMA
    from ledgerlens.sources.testdata import testdata_domains
    from ledgerlens.config import Settings
    dirty = registry.dirty(spark, SF001)
    res = run_all(spark, dirty, Settings(domains=testdata_domains()))
    assert res.metrics[0][1] == "ok", res.values.get("error")
    want = sorted(tuple(r) for r in V.generate_validation_report(
        dirty, RAW_SCHEMA, testdata_domains()).collect())
    assert sorted(res.values["validation"]) == want
    assert res.metrics[0][2] == registry.queries()["clean_transactions"](spark, SF001).count()


def test_msck_repair_recovers_partitions(spark):
    from ledgerlens.sources import catalog as K
    path = scratch_path(spark, "msck")
    IO.write_partitioned(registry.processed(spark, SF001), path)
    spark.sql("DROP TABLE IF EXISTS msck_probe")
    spark.sql(K.transactions_ddl(path, "msck_probe"))
    assert spark.table("msck_probe").count() == 0
    spark.sql("MSCK REPAIR TABLE msck_probe")
    assert spark.table("msck_probe").count() == 1000
    assert K.table_exists(spark, "msck_probe")
    desc = {r["col_name"] for r in K.describe(spark, "msck_probe").collect()}
    assert {"risk_score", "year", "month", "day"} <= desc
    spark.sql("DROP TABLE msck_probe")


def test_summary_json_groups(spark):
    s = R.executive_summary(registry.scored(spark, SF001))
    j = R.summary_json(s).first().asDict(recursive=True)
    assert j["alertas_fraude"]["total_alertas"] == 57
    assert j["metricas_generales"]["total_transacciones"] == 1000
    assert set(j) == {"fecha_generacion", "periodo_analizado", "metricas_generales",
                      "distribucion_estados", "alertas_fraude"}


def test_run_stops_at_the_first_failing_stage(spark):
    """A failing stage ends the run; later stages are not started."""
    res = run_all(spark, registry.raw(spark, SF001).drop("amount"))
    assert [(m[0], m[1]) for m in res.metrics] == [("ingest", "failed")]
    assert not res.ok()
    assert res.values["error"].startswith("ingest: ")
    assert "processed" not in res.paths


def test_command_runs_the_stages_on_a_csv(spark, capsys):
    """``python -m ledgerlens INPUT``: the six stages over a raw CSV folder."""
    from ledgerlens.__main__ import main
    src = scratch_path(spark, "cli-raw")
    IO.write_csv(registry.raw(spark, SF001), src)
    out = scratch_path(spark, "cli-out")
    assert main([src, "--out", out, "--csv-files", "1"]) == 0
    printed = capsys.readouterr().out
    assert printed.count(" ok ") == len(STAGES)
    assert spark.read.parquet(f"{out}/fraud_alerts.parquet").count() == 57
    assert len(spark.read.csv(f"{out}/fraud_alerts.csv").inputFiles()) == 1
