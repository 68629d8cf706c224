"""The six stages in one session.

ingest + validate -> enrich -> rules -> tables -> analyses -> reports.
Each stage ends in a write to the shared scratch folder and the next stage
reads that table back: the written table cuts lineage, so a lost executor
recomputes at most one stage, and every later scan is a pruned Parquet read.
Stops at the first failing stage; returns per-stage metrics. A run in the
folder of an earlier one goes on where that one stopped (``plans.manifest``),
and tables that no later stage reads are removed when the run has succeeded.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_SETTINGS, Settings, configure, scratch_path
from ..operators import analytics as A
from ..operators import clean as C
from ..operators import features as T
from ..operators import quality as V
from ..operators import report as R
from ..operators import rules as RU
from ..schema import PARTITION_COLUMNS, RAW_SCHEMA
from ..sources import catalog as K
from ..sources import files as IO
from . import manifest as M

STAGES = ("ingest", "transform", "fraud", "tables", "analyses", "reports")

# Tables that only later stages read; they go when the run has succeeded.
INTERMEDIATE = ("validated", "alert_cube", "analysis_cube")

# Local property naming the stage that submitted a job.
STAGE_PROPERTY = "ledgerlens.stage"


@dataclass
class RunResult:
    metrics: list[tuple[str, str, int | None, float]] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)
    values: dict[str, object] = field(default_factory=dict)

    def ok(self) -> bool:
        return all(m[1] == "ok" for m in self.metrics) and len(self.metrics) == len(STAGES)

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.metrics, "stage string, status string, rows long, seconds double")


def _rows(verify: DataFrame, expected: int | None = None) -> int:
    """The rows read back; raises when they differ from those written (or
    from those expected)."""
    got = verify.first()
    for want in (got["written_rows"], expected):
        if want is not None and got["read_rows"] != want:
            raise RuntimeError(f"{got['read_rows']} rows read back, {want} expected")
    return got["read_rows"]


def ingest(spark: SparkSession, raw: DataFrame, base: str, s: Settings, res: RunResult,
           broken: DataFrame | None = None) -> int:
    """Validate, then clean and write. ``broken`` lines (``read_csv_split``)
    are written to a table of their own and counted in the report.

    The checks are one aggregation over the raw rows (partial per task, no
    extra shuffle volume); the number of distinct keys is observed in the
    write stage after the dedup shuffle. Both are exact when an executor is
    lost: the aggregate is data, and result-stage observations are applied
    once per partition. (Observing the raw rows before the shuffle would be
    one scan less but could count twice if that stage were recomputed.)
    """
    got = raw.agg(*V.validation_metrics(raw, s.domains)).first()
    metrics = got.asDict()
    keys = Observation("keys")
    deduped = C.deduplicate(C.trim_strings(raw)).observe(keys, F.count(F.lit(1)).alias("keys"))
    path = f"{base}/validated"
    n = _rows(IO.write_verified(C.drop_incomplete(deduped), path))
    metrics["duplicates__transaction_id"] = metrics["total__*"] - keys.get["keys"]
    missing = [f.name for f in RAW_SCHEMA.fields if f.name not in raw.columns]
    # one row per column and check: bounded by the schema, not the data
    res.values["validation"] = V.report_rows(metrics, missing)
    if broken is not None:
        lost = _rows(IO.write_verified(broken, f"{base}/quarantine", rebalance=True))
        res.values["validation"].append(("broken_lines", "*", lost))
        res.paths["quarantine"] = f"{base}/quarantine"
    res.values["validated_rows"] = n
    res.paths["validated"] = path
    found = {
        "validation_report": spark.createDataFrame(res.values["validation"], V.REPORT_SCHEMA).coalesce(1),
        "ingest_summary": spark.createDataFrame(
            [(metrics["total__*"], n, metrics["duplicates__transaction_id"])],
            "original_records long, validated_records long, duplicates_removed long").coalesce(1),
    }
    IO.write_results_json(found, f"{base}/ingest")
    res.paths["ingest"] = f"{base}/ingest"
    return n


def transform(spark: SparkSession, base: str, s: Settings, res: RunResult) -> int:
    validated = IO.read_parquet(spark, res.paths["validated"])
    path = f"{base}/processed"
    n = _rows(IO.write_verified(T.enrich(validated, s), path, PARTITION_COLUMNS),
              res.values["validated_rows"])
    res.paths["processed"] = path
    res.values["processed_rows"] = n
    return n


def fraud(spark: SparkSession, base: str, s: Settings, res: RunResult) -> int:
    """One scan of the processed table writes the alerts; all summaries are
    read off the alerts (the total is the row count checked one stage before)."""
    processed = IO.read_parquet(spark, res.paths["processed"])
    scored = RU.detect_fraud_patterns(processed, s.thresholds)
    path = f"{base}/fraud_alerts.parquet"
    # a selective filter over every scan task: rebalanced into sized files
    n = _rows(IO.write_verified(RU.fraud_alerts(scored), path, rebalance=True))
    # the summaries read the written alerts: one grouping-sets aggregate, one top-k
    alerts = IO.read_parquet(spark, path)
    cube_path = f"{base}/alert_cube"
    res.paths["alert_cube"] = cube_path
    IO.write_parquet(RU.alert_cube(alerts), cube_path)
    summaries = RU.summaries_from_cube(IO.read_parquet(spark, cube_path), res.values["processed_rows"])
    summaries["fraud_top_risk"] = RU.top_risk(alerts)
    IO.write_results_json(summaries, f"{base}/fraud_summary")
    res.paths["fraud_summary"] = f"{base}/fraud_summary"
    if n > 0:
        res.paths["alerts"] = path
        # read back from the sized alert files: no second rebalance
        IO.write_alerts_csv(alerts, f"{base}/fraud_alerts.csv", s.csv_files, rebalance=False)
        res.paths["alerts_csv"] = f"{base}/fraud_alerts.csv"
    return n


def tables(spark: SparkSession, base: str, s: Settings, res: RunResult) -> int:
    K.create_transactions_table(spark, res.paths["processed"])
    K.create_alerts_table(spark, res.paths.get("alerts"))
    counts = K.count_tables(spark, [K.TRANSACTIONS_TABLE, K.ALERTS_TABLE]).collect()
    res.values["table_counts"] = {r["table_name"]: r["total"] for r in counts}
    return res.values["table_counts"][K.TRANSACTIONS_TABLE]


def analyses(spark: SparkSession, base: str, s: Settings, res: RunResult) -> int:
    """One scan of the table: the analysis cube (every grouping set in one
    aggregation) is written, and A1-A9 are read off the written cube; A10 is
    a pushed-down top-k over the table."""
    table = spark.table(K.TRANSACTIONS_TABLE)
    cube_path = f"{base}/analysis_cube"
    # a folder per grouping set: each result reads its own rows only
    A.analysis_cube(table, s.thresholds).write.mode("overwrite").partitionBy("grouping_set").parquet(cube_path)
    res.paths["analysis_cube"] = cube_path
    cube = IO.read_parquet(spark, cube_path)
    results = A.analyses_from_cube(cube, table)
    path = f"{base}/analytics"
    IO.write_results_json(results, path)
    res.paths["analytics"] = path
    return len(results)


def reports(spark: SparkSession, base: str, s: Settings, res: RunResult) -> int:
    """The summary is read off the written analysis cube (no table scan)."""
    processed = spark.table(K.TRANSACTIONS_TABLE)
    if "analysis_cube" in res.paths:
        summary = R.executive_summary_from_cube(IO.read_parquet(spark, res.paths["analysis_cube"]))
    else:
        summary = R.executive_summary(RU.detect_fraud_patterns(processed, s.thresholds))
    path = f"{base}/reports"
    R.write_summary_json(summary, f"{path}/summary")
    # read back with the schema it was written with (no inference pass)
    summary = spark.read.schema(R.summary_json(summary).schema).json(f"{path}/summary")
    flat = summary.select(
        "fecha_generacion", "periodo_analizado", "metricas_generales.*",
        "distribucion_estados.*", "alertas_fraude.*")
    saved = {}
    if "analytics" in res.paths:
        for name in ("by_country", "by_category", "by_time_slot"):
            saved[name] = IO.read_results_json(
                spark, res.paths["analytics"], name,
                A.ANALYSES[name](processed).schema)
    lines = R.report_lines(_summary_from_json(flat), saved.get("by_country"),
                           saved.get("by_category"), saved.get("by_time_slot"),
                           F.lit(flat.first()["fecha_generacion"]))     # one row
    R.write_report(lines, f"{path}/report_md")
    done = [m[0] for m in res.metrics if m[1] == "ok"] + ["reports"]
    R.write_text_report(
        R.text_report_lines(_summary_from_json(flat), F.col("fecha_generacion"), done),
        f"{path}/report_txt")
    res.paths["reports"] = path
    return spark.read.text(f"{path}/report_md").count()


def _summary_from_json(flat: DataFrame) -> DataFrame:
    """Column names of ``executive_summary`` from the saved JSON summary."""
    rename = {key: src for group in R.JSON_GROUPS.values() for key, src in group}
    period = F.split(F.col("periodo_analizado"), " a ")
    return flat.select(
        "fecha_generacion",
        *[F.col(k).alias(v) for k, v in rename.items()],
        period[0].alias("period_start"), period[1].alias("period_end"),
    )


def _taken_over(spark: SparkSession, base: str, state: str, res: RunResult) -> list[str]:
    """The first stages that an earlier run in this folder has finished on
    the same input; their paths and values are put into ``res``."""
    taken, gone = [], tuple(INTERMEDIATE)
    if M.finished(spark, base, STAGES[-1], state, gone) is None:
        gone = ()                # a run that has not ended needs its intermediate tables
    for name in STAGES:
        entry = M.finished(spark, base, name, state, gone)
        if entry is None:
            break
        taken.append(name)
        res.metrics.append((name, "ok", entry["rows"], 0.0))
        res.paths.update(entry["paths"])
        res.values.update(entry["values"])
    if "validation" in res.values:
        res.values["validation"] = [tuple(r) for r in res.values["validation"]]
    return taken


def run_all(spark: SparkSession, raw: DataFrame, settings: Settings = DEFAULT_SETTINGS,
            base: str | None = None, broken: DataFrame | None = None, keep: bool = False) -> RunResult:
    """Run the six stages over ``raw`` (raw schema). Writes below ``base``
    (default: a fresh folder under ``spark.checkpoint.dir``).

    In a folder that holds an earlier run over the same input and settings the
    finished stages are taken over (``values["taken_over"]``). ``keep`` leaves
    the intermediate tables, which else are removed after the last stage.
    """
    configure(spark)
    base = (base or scratch_path(spark, "run")).rstrip("/")
    res = RunResult()
    state = M.input_state(raw, settings)
    taken = _taken_over(spark, base, state, res)
    res.values["taken_over"] = taken
    M.forget(spark, base, [name for name in STAGES if name not in taken])
    steps = {
        "ingest": lambda: ingest(spark, raw, base, settings, res, broken),
        "transform": lambda: transform(spark, base, settings, res),
        "fraud": lambda: fraud(spark, base, settings, res),
        "tables": lambda: tables(spark, base, settings, res),
        "analyses": lambda: analyses(spark, base, settings, res),
        "reports": lambda: reports(spark, base, settings, res),
    }
    if "tables" in taken and taken[-1] != STAGES[-1]:
        steps["tables"]()       # the catalog of another session does not know them
    sc = spark.sparkContext
    outer = sc.getLocalProperty(STAGE_PROPERTY)
    try:
        for name in STAGES[len(taken):]:
            # jobs of this stage carry its name (event log, listeners); the
            # caller's job group and description are left as they are
            sc.setLocalProperty(STAGE_PROPERTY, name)
            t0 = time.time()
            try:
                rows = steps[name]()
                M.finish(spark, base, name, {
                    "state": state, "rows": int(rows), "paths": res.paths,
                    "values": {k: v for k, v in res.values.items() if k != "taken_over"}})
            except Exception as e:  # noqa: BLE001 - a failed stage ends the run
                res.metrics.append((name, "failed", None, round(time.time() - t0, 3)))
                res.values["error"] = f"{name}: {type(e).__name__}: {e}"
                break
            res.metrics.append((name, "ok", int(rows), round(time.time() - t0, 3)))
    finally:
        sc.setLocalProperty(STAGE_PROPERTY, outer)
    if res.ok() and not keep:
        for name in INTERMEDIATE:
            if name in res.paths:
                M.delete(spark, res.paths.pop(name), base)
    return res
