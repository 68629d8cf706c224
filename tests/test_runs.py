"""Runs that stop and go on, broken lines, days published again."""

import glob
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import scratch_path
from ledgerlens.operators import rules as RU
from ledgerlens.plans import registry, workflow
from ledgerlens.plans import manifest as M
from ledgerlens.plans.workflow import STAGES, run_all
from ledgerlens.schema import PARTITION_COLUMNS, RAW_COLUMNS
from ledgerlens.sources import catalog as K
from ledgerlens.sources import files as IO
from ledgerlens.sources import publish as P
from tables import SF001


@pytest.fixture(scope="module")
def raw_path(spark):
    path = scratch_path(spark, "runs-raw")
    IO.write_parquet(registry.raw(spark, SF001), path)
    return path


def jobs_of(spark, name, run):
    """Jobs that ``run`` started."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = run()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def local(path):
    return path.replace("file:", "")


def files(path):
    return {f: hashlib.sha256(open(f, "rb").read()).hexdigest()
            for f in sorted(glob.glob(f"{local(path)}/**/*.parquet", recursive=True))}


# ------------------------------------------------------------------ resume, clean-up

def test_a_run_stopped_in_stage_four_goes_on_there(spark, raw_path, monkeypatch):
    raw, base = spark.read.parquet(raw_path), scratch_path(spark, "resumed")

    def stopped(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(workflow, "tables", stopped)
        first = run_all(spark, raw, base=base)
    assert [x[:2] for x in first.metrics] == [("ingest", "ok"), ("transform", "ok"), ("fraud", "ok"), ("tables", "failed")]
    before = files(f"{base}/processed") | files(f"{base}/validated")
    with monkeypatch.context() as m:
        for name in ("ingest", "transform", "fraud"):
            m.setattr(workflow, name, stopped)       # none of them may run again
        second = run_all(spark, spark.read.parquet(raw_path), base=base, keep=True)
    assert second.ok() and second.values["taken_over"] == ["ingest", "transform", "fraud"]
    assert files(f"{base}/processed") | files(f"{base}/validated") == before
    whole = run_all(spark, raw)
    assert [x[:3] for x in second.metrics] == [x[:3] for x in whole.metrics]
    assert second.values["validation"] == whole.values["validation"]


def test_intermediate_tables_go_with_success(spark, raw_path):
    base = scratch_path(spark, "cleaned")
    res = run_all(spark, spark.read.parquet(raw_path), base=base)
    assert res.ok()
    assert sorted(os.listdir(local(base))) == sorted(
        ["processed", "fraud_alerts.parquet", "fraud_alerts.csv", "fraud_summary", "ingest", "analytics", "reports", "manifest"])
    assert not set(workflow.INTERMEDIATE) & set(res.paths)
    # a finished run is taken over whole, without its intermediate tables
    again, jobs = jobs_of(spark, "again", lambda: run_all(spark, spark.read.parquet(raw_path), base=base))
    assert again.ok() and again.values["taken_over"] == list(STAGES)
    assert jobs <= 2 * len(STAGES)
    assert all(os.path.exists(local(p)) for p in again.paths.values())


def test_other_input_settings_or_lost_tables_run_again(spark, raw_path):
    from dataclasses import replace
    from ledgerlens.config import DEFAULT_SETTINGS, Thresholds
    base, raw = scratch_path(spark, "changed"), spark.read.parquet(raw_path)
    assert run_all(spark, raw, base=base, keep=True).ok()
    other = replace(DEFAULT_SETTINGS, thresholds=Thresholds(high_amount=1.0))
    changed = run_all(spark, raw, other, base=base, keep=True)
    assert changed.ok() and changed.values["taken_over"] == []
    M.delete(spark, f"{base}/analytics", base)
    lost = run_all(spark, raw, other, base=base, keep=True)
    assert lost.ok() and lost.values["taken_over"] == ["ingest", "transform", "fraud", "tables"]
    fewer = scratch_path(spark, "fewer")
    raw.limit(900).write.parquet(fewer)
    assert run_all(spark, spark.read.parquet(fewer), other, base=base).values["taken_over"] == []
    with pytest.raises(ValueError):
        M.delete(spark, f"{base}-other", base)


def test_fraud_stage_reads_the_table_once(spark, raw_path):
    """One scan of the processed table, the rest reads the alerts."""
    res = run_all(spark, spark.read.parquet(raw_path), keep=True)
    processed = IO.read_parquet(spark, res.paths["processed"])
    seen = []
    real = IO.read_parquet
    try:
        IO.read_parquet = lambda s, p: seen.append(p) or real(s, p)
        workflow.fraud(spark, scratch_path(spark, "fraud-again"), registry.S, res)
    finally:
        IO.read_parquet = real
    assert seen.count(res.paths["processed"]) == 1
    scored = RU.detect_fraud_patterns(processed)
    path = res.paths["fraud_summary"]
    for name in ("fraud_totals", "fraud_by_priority", "fraud_by_country", "fraud_rule_hits", "fraud_top_risk"):
        want = getattr(RU, name)(scored)
        got = spark.read.schema(want.schema).json(f"{path}/{name}")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


# ------------------------------------------------------------------ broken lines

LINES = ["1,7,a,ES,1.5,EUR,c,d,2024-01-01 00:00:00,APPROVED,M1,0001", "2,short", "",
         "3,7,a,ES,x1.5,EUR,c,d,2024-01-01 00:00:00,APPROVED,M1,0001", "4,,,,,,,,,,,",
         "5,7,a,ES,1.5,EUR,c,d,2024-01-01 00:00:00,APPROVED,M1,0001,extra", "\"unclosed,1", "nonsense"]


@pytest.fixture(scope="module")
def broken_csv(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("broken") / "in"
    path.mkdir()
    for k in range(2):
        (path / f"part-{k}.csv").write_text("\n".join([",".join(RAW_COLUMNS), *LINES]) + "\n")
    return str(path)


def test_every_line_is_kept_or_quarantined(spark, broken_csv):
    rows, broken = IO.read_csv_split(spark, broken_csv)
    assert rows.columns == RAW_COLUMNS
    assert sorted(r.transaction_id for r in rows.collect()) == [1, 1, 4, 4]
    lines = sorted(r.line for r in broken.collect())
    assert lines == sorted([x for x in LINES if x[:2] not in ("1,", "4,", "")] * 2)
    # the same whatever columns are asked for
    assert rows.count() == 4 and rows.select("status").count() == 4 and broken.count() == 10
    assert broken.select("line").count() == 10 and broken.select("file").distinct().count() == 2
    assert rows.where("amount > 1").select("country").count() == 2


def test_the_run_counts_and_keeps_broken_lines(spark, broken_csv, capsys):
    from ledgerlens.__main__ import main
    out = scratch_path(spark, "quarantine-run")
    assert main([broken_csv, "--out", out]) == 0
    printed = capsys.readouterr().out
    assert "validation broken_lines *: 10" in printed and "validation total *: 4" in printed
    assert "processed:" in printed and "|1             |" in printed       # the preview
    assert spark.read.parquet(f"{out}/quarantine").count() == 10


# ------------------------------------------------------------------ days

@pytest.fixture(scope="module")
def processed(spark):
    return registry.written_processed(spark, SF001)


def test_a_day_published_again_leaves_the_others(spark, processed):
    path = scratch_path(spark, "days")
    told = P.publish_days(processed, path)
    assert told.where("written_rows <> read_rows").count() == 0
    assert told.agg(F.sum("read_rows")).first()[0] == processed.count()
    before, day = files(path), processed.select(*PARTITION_COLUMNS).orderBy("day").first()
    one = processed.where(F.col("day") == day["day"])
    again = P.publish_days(one.withColumn("amount", F.col("amount") + 1), path)
    assert [tuple(r)[:3] for r in again.collect()] == [tuple(day)]
    after = files(path)
    folder = "/year={}/month={}/day={}/".format(*day)
    assert {f: h for f, h in before.items() if folder not in f} == {f: h for f, h in after.items() if folder not in f}
    assert [f for f in after if folder in f] and not set(f for f in before if folder in f) & set(after)
    assert spark.read.parquet(path).count() == processed.count()


def test_a_write_that_fails_leaves_the_table(spark, processed):
    path = scratch_path(spark, "half")
    P.publish_days(processed, path)
    before = files(path)
    bad = processed.withColumn("amount", F.when(F.col("transaction_id") % 50 == 7, F.raise_error(F.lit("lost")).cast(
        "double")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="lost"):
        P.publish_days(bad, path, P.day_counts(processed))
    assert files(path) == before


def test_rows_that_are_missing_raise(spark, processed):
    wrong = P.day_counts(processed).withColumn("rows", F.col("rows") + (F.col("day") == 3).cast("int"))
    with pytest.raises(RuntimeError, match="other rows than written"):
        P.publish_days(processed, scratch_path(spark, "wrong"), wrong)


def test_an_empty_publication_changes_nothing(spark, processed):
    path = scratch_path(spark, "none")
    P.publish_days(processed, path)
    before = files(path)
    assert P.publish_days(processed.where("false"), path).count() == 0
    assert files(path) == before


def test_days_added_one_by_one_equal_a_repair(spark, processed):
    path = scratch_path(spark, "added")
    P.publish_days(processed, path)
    days = sorted(tuple(r) for r in processed.select(*PARTITION_COLUMNS).distinct().collect())
    K.create_transactions_table(spark, path, "by_day", recover=False)
    K.create_transactions_table(spark, path, "by_repair")
    assert spark.table("by_day").count() == 0
    assert P.add_days(spark, "by_day", days[:-1]) == len(days) - 1
    assert P.add_days(spark, "by_day", days[-1:]) == 1                 # one day, one partition
    assert P.add_days(spark, "by_day", days) == 0 and P.add_days(spark, "by_day", []) == 0
    shown = lambda t: sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect())
    assert shown("by_day") == shown("by_repair")
    rows = lambda t: sorted(map(str, spark.table(t).collect()))
    assert rows("by_day") == rows("by_repair")
    for t in ("by_day", "by_repair"):
        spark.sql(f"DROP TABLE {t}")
