"""Run the six stages over raw transactions (P1 as a command).

    python -m ledgerlens INPUT [--format csv|parquet] [--out DIR]
                               [--shuffle-partitions N] [--csv-files N] [--keep]
                               [--preview N] [--ui]

INPUT is a CSV (with header) or Parquet folder in the raw 12-column schema.
CSV lines that do not fit it go to a table of their own (``quarantine``) and are
counted in the validation report. Outputs go below ``--out``, else below
``spark.checkpoint.dir``; with the ``--out`` of an earlier run over the same
input the finished stages are taken over. Under
``spark-submit`` the session is the cluster's; the exit code is non-zero when
a stage fails.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from .config import DEFAULT_SETTINGS, configure
from .plans.workflow import run_all
from .sources import files as IO


# what the run found, one small JSON result each
FINDINGS = {
    "ingest": ("ingest_summary",),
    "fraud_summary": ("fraud_totals", "fraud_by_priority", "fraud_by_country", "fraud_rule_hits", "fraud_top_risk"),
}
# printed from the results, so many rows each
PREVIEWS = {
    "processed": ("transaction_id", "customer_id", "amount", "timestamp", "time_slot", "amount_category",
                  "transaction_velocity", "risk_score"),
    "alerts": ("transaction_id", "customer_id", "amount", "country", "alert_priority", "fraud_reasons"),
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerlens", description=__doc__.splitlines()[0])
    parser.add_argument("input", help="raw transactions folder or file")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--out", help="output folder (default: below spark.checkpoint.dir)")
    parser.add_argument("--shuffle-partitions", type=int,
                        help="initial shuffle width for the input size (AQE coalesces)")
    parser.add_argument("--csv-files", type=int,
                        help="files of the alert CSV (default: sized by the data)")
    parser.add_argument("--keep", action="store_true",
                        help="keep the intermediate tables of the run")
    parser.add_argument("--preview", type=int, default=5,
                        help="rows of the processed table and of the alerts to print (default 5)")
    parser.add_argument("--ui", action="store_true",
                        help="start Spark's web UI (off unless asked)")
    args = parser.parse_args(argv)

    spark = (SparkSession.builder.appName("ledgerlens")
             .config("spark.ui.enabled", "true" if args.ui else "false").getOrCreate())
    configure(spark, args.shuffle_partitions)
    broken = None
    if args.format == "csv":
        raw, broken = IO.read_csv_split(spark, args.input)
    else:
        raw = IO.read_parquet(spark, args.input)
    settings = replace(DEFAULT_SETTINGS, csv_files=args.csv_files)
    res = run_all(spark, raw, settings, base=args.out, broken=broken, keep=args.keep)
    if res.values["taken_over"]:
        print(f"taken over from an earlier run: {', '.join(res.values['taken_over'])}")
    for stage, status, rows, seconds in res.metrics:
        print(f"{stage:10s} {status:7s} rows={rows if rows is not None else '-':>10} "
              f"{seconds:8.2f}s")
    for check, column, n in res.values.get("validation", []):
        print(f"validation {check} {column}: {n}")
    for folder, names in FINDINGS.items():
        for name in names if folder in res.paths else ():
            for line in spark.read.text(f"{res.paths[folder]}/{name}").toLocalIterator():
                print(f"{name} {line['value']}")      # a few rows each
    for name, columns in PREVIEWS.items() if args.preview > 0 else ():
        if name in res.paths:
            print(f"{name}:")
            IO.preview(IO.read_parquet(spark, res.paths[name]).select(*columns), args.preview).show(truncate=False)
    print(json.dumps({"ok": res.ok(), "paths": res.paths,
                      "error": res.values.get("error")}))
    return 0 if res.ok() else 1


if __name__ == "__main__":
    sys.exit(main())
