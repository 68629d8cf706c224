"""What a run tells, and what it must not touch."""

import pytest
from dataclasses import replace

from tables import SF001

from ledgerlens.config import DEFAULT_SETTINGS, Thresholds, remove_scratch, scratch_dir, scratch_path
from ledgerlens.operators import quality as V
from ledgerlens.plans import registry
from ledgerlens.plans.workflow import _rows, run_all
from ledgerlens.schema import RAW_SCHEMA
from ledgerlens.sources import catalog as K
from ledgerlens.sources.testdata import testdata_domains


@pytest.fixture(scope="module")
def run(spark):
    return run_all(spark, registry.dirty(spark, SF001), replace(DEFAULT_SETTINGS, domains=testdata_domains()))


def test_findings_are_written(spark, run):
    assert run.ok(), run.values.get("error")
    told = spark.read.schema(V.REPORT_SCHEMA).json(f"{run.paths['ingest']}/validation_report").collect()
    want = V.generate_validation_report(registry.dirty(spark, SF001), RAW_SCHEMA, testdata_domains()).collect()
    assert sorted(map(tuple, told)) == sorted(map(tuple, want))
    summary = spark.read.json(f"{run.paths['ingest']}/ingest_summary").first()
    assert summary.original_records - summary.duplicates_removed >= summary.validated_records == run.metrics[0][2]
    for name in ("fraud_totals", "fraud_by_priority", "fraud_by_country", "fraud_rule_hits", "fraud_top_risk"):
        assert spark.read.json(f"{run.paths['fraud_summary']}/{name}").count() > 0


def test_report_keeps_its_date_and_headings(spark, run):
    lines = [r.value for r in spark.read.text(f"{run.paths['reports']}/report_md").collect()]
    assert any(x.startswith("Fecha de generación: ") for x in lines)
    assert sum(x.startswith("## ") for x in lines) == 7


def test_a_run_without_alerts_shows_none(spark, run):
    """No table of an earlier run is left under the name."""
    assert spark.catalog.tableExists(K.ALERTS_TABLE)
    never = Thresholds(night_amount=1e12, velocity_amount=1e12, high_amount=1e12, alert_score=99)
    clean = registry.raw(spark, SF001).filter("status <> 'FRAUD'")
    res = run_all(spark, clean, replace(DEFAULT_SETTINGS, thresholds=never))
    assert res.ok(), res.values.get("error")
    assert dict((m[0], m[2]) for m in res.metrics)["fraud"] == 0
    assert K.ALERTS_TABLE not in res.values["table_counts"]
    assert not spark.catalog.tableExists(K.ALERTS_TABLE)


@pytest.mark.parametrize("kind", ["managed", "external", "view"])
def test_tables_of_others_survive(spark, tmp_path, kind):
    name = f"user_{kind}"
    spark.sql(f"DROP VIEW IF EXISTS {name}") if kind == "view" else spark.sql(f"DROP TABLE IF EXISTS {name}")
    if kind == "managed":
        spark.range(3).write.mode("overwrite").saveAsTable(name)
    elif kind == "external":
        spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable(name)
    else:
        spark.range(3).createOrReplaceTempView(name)
    with pytest.raises(ValueError):
        K.create_transactions_table(spark, str(tmp_path / "other"), name)
    with pytest.raises(ValueError):
        K.create_alerts_table(spark, None, name)
    assert spark.table(name).count() == 3


def test_every_missing_column_is_reported(spark):
    df = registry.dirty(spark, SF001)
    for column in RAW_SCHEMA.fieldNames():
        rows = V.generate_validation_report(df.drop(column), RAW_SCHEMA, testdata_domains()).collect()
        assert ("schema_missing", column, 1) in {tuple(r) for r in rows}
        assert not any(r["column"] == column and r["check"] != "schema_missing" for r in rows)


def test_a_short_write_fails_the_stage(spark):
    counts = spark.createDataFrame([(5, 4)], "written_rows long, read_rows long")
    with pytest.raises(RuntimeError):
        _rows(counts)
    same = spark.createDataFrame([(4, 4)], "written_rows long, read_rows long")
    assert _rows(same) == 4
    with pytest.raises(RuntimeError):
        _rows(same, 5)


def test_scratch_tables_can_be_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(2).write.parquet(path)
    assert remove_scratch(spark, path)
    with pytest.raises(ValueError):
        remove_scratch(spark, "/somewhere/else")


def test_a_cluster_without_a_shared_folder_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError):
        scratch_dir(Session())


def test_stream_state_keeps_the_latest_time():
    import pandas as pd

    from ledgerlens.streaming.alerts import _gap_state

    class State:
        exists, get = False, (None, 0)

        def update(self, value):
            self.exists, self.get = True, value
    state, minute = State(), 60_000_000

    def batch(*micros):
        pdf = pd.DataFrame({"transaction_id": range(len(micros)), "_micros": pd.array(micros, dtype="Int64")})
        out = pd.concat(list(_gap_state((1,), iter([pdf]), state)))
        return [None if pd.isna(x) else x for x in out["minutes_since_last_transaction"]]
    assert batch(100 * minute) == [None]
    assert batch(40 * minute) == [None]              # late: no gap, the state stays
    assert state.get == (100 * minute, 2)
    assert batch(None) == [None] and state.get == (100 * minute, 3)
    assert batch(50 * minute, 103 * minute) == [None, 3.0]
    assert state.get == (103 * minute, 5)
