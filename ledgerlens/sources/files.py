"""File sources and sinks.

Parquet is the working format; CSV only at the edges. No sink funnels data
through one task unless the caller asks for a file count.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.util import inheritable_thread_target

from ..schema import ALERT_CSV_COLUMNS, PARTITION_COLUMNS, RAW_SCHEMA

# Upper bound of rows per output file of partitioned writes, so that a day
# holding a large share of the data is still written as many files.
MAX_RECORDS_PER_FILE = 5_000_000


def read_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
             corrupt_column: str | None = None) -> DataFrame:
    """CSV with header and a fixed schema, PERMISSIVE (bad fields -> NULL).

    A missing path fails at analysis with PATH_NOT_FOUND (S3). With
    ``corrupt_column`` the raw text of malformed lines is kept in that column.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


BROKEN = "_broken_line"


def read_csv_split(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S2 with a quarantine: ``(rows, broken)``. ``rows`` are the lines that
    fit the schema; ``broken`` holds ``line`` and ``file`` of those that do not
    (too few or too many fields, a field that is none of its type), which the
    plain scan would fill with NULL. Every line but blank ones is in one of
    them. Both are lazy scans of the files that parse every column, so a line is
    broken or not whatever columns are asked for."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", BROKEN).schema(
        StructType(schema.fields + [StructField(BROKEN, StringType(), True)])).csv(path)
    # always true, and reads every field: the scan finds broken only what it parses
    whole = F.concat_ws("", F.lit("x"), *[F.col(f.name).cast("string") for f in schema.fields])
    lines = lines.where(whole != "")
    # no filter that the scan would take over: it decides before the line is known to be broken
    fits = F.coalesce(F.col(BROKEN), F.lit("")) == ""
    rows = lines.where(fits).drop(BROKEN)
    broken = lines.where(~fits).select(F.col(BROKEN).alias("line"), F.col("_metadata.file_path").alias("file"))
    return rows, broken


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Output partitions of about the advisory size, clustered by ``columns``.

    The ``REBALANCE`` hint is a shuffle whose partitions AQE coalesces when
    small and splits when skewed, so a sink writes files of a useful size
    whatever the layout of its input: a filter over many scan tasks does not
    leave one small file per task, and a value holding a large share of the
    rows is still written by many tasks.
    """
    return df.hint("rebalance", *columns)


def write_csv(df: DataFrame, path: str, files: int | None = None,
              rebalance: bool = True) -> None:
    """CSV with a header; ``files`` fixes the file count, else the rows are
    rebalanced into files of about the advisory size (``rebalance=False``
    keeps the input's tasks, e.g. when reading an already sized table)."""
    if files:
        out = df.repartition(files)    # only the export is dealt to so few tasks
    else:
        out = rebalanced(df) if rebalance else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, rebalance: bool = False) -> None:
    """Parquet, overwrite, Snappy. ``rebalance`` for inputs whose task
    layout does not match the output size (e.g. a selective filter)."""
    out = rebalanced(df) if rebalance else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; partition directories are discovered as columns."""
    return spark.read.parquet(path)


def write_partitioned(df: DataFrame, path: str,
                      partition_by: list[str] = PARTITION_COLUMNS,
                      rebalance: bool = True) -> None:
    """One directory per (year, month, day).

    The rows are rebalanced by the partition columns first: rows arriving
    from a per-customer shuffle hold every day in every task, which would
    write one small file per (task, day). After the rebalance a task holds
    one or a few days, a large day is split over several tasks (AQE skew
    split), and ``maxRecordsPerFile`` caps the file size. ``rebalance=False``
    for inputs already laid out by day.
    """
    out = rebalanced(df, *partition_by) if rebalance else df
    (out.write.mode("overwrite").option("compression", "snappy")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*partition_by).parquet(path))


def write_alerts_csv(alerts: DataFrame, path: str, files: int | None = None,
                     rebalance: bool = True) -> None:
    """The 12 review columns of the alerts, with a header.

    ``files=1`` gives the reference's single file; the default writes files
    of about the advisory size, so the export scales with the alert count.
    """
    write_csv(alerts.select(*ALERT_CSV_COLUMNS), path, files, rebalance)


def alert_csv_schema() -> StructType:
    from ..schema import PROCESSED_SCHEMA, RULE_FIELDS
    fields = {f.name: f for f in list(PROCESSED_SCHEMA.fields) + RULE_FIELDS}
    return StructType([fields[c] for c in ALERT_CSV_COLUMNS])


def write_verified(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   rebalance: bool | None = None) -> DataFrame:
    """Write, then compare the rows observed while writing with a read-back
    count. Returns one row (written_rows, read_rows).

    ``rebalance`` defaults to True for partitioned and False for plain
    writes. The rows are counted above the rebalance exchange, in the
    writing (result) stage, whose observations are applied once per
    partition even when earlier stages are recomputed.
    """
    if rebalance is None:
        rebalance = bool(partition_by)
    if rebalance:
        df = rebalanced(df, *(partition_by or []))
    obs = Observation("written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        write_partitioned(observed, path, partition_by, rebalance=False)
    else:
        write_parquet(observed, path)
    written = obs.get["rows"]
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("read_rows")).select(
        F.lit(written).cast("bigint").alias("written_rows"), "read_rows")


def write_results_json(results: dict[str, DataFrame], base: str, parallel: int = 4) -> None:
    """One JSON directory per result, written by the executors.

    The results are independent jobs; up to ``parallel`` are submitted at
    once so that small jobs fill the slots left idle by each other's tails.
    The writer threads inherit the caller's job group and description, so
    the jobs can be cancelled and accounted together.
    """
    if not results:
        return
    spark = next(iter(results.values())).sparkSession

    @inheritable_thread_target(spark)
    def write(item):
        name, df = item
        df.write.mode("overwrite").json(f"{base}/{name}")

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(write, results.items()))


def read_results_json(spark: SparkSession, base: str, name: str,
                      schema: StructType) -> DataFrame | None:
    """A saved result, or None when it was never written."""
    try:
        return spark.read.schema(schema).json(f"{base}/{name}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def preview(df: DataFrame, n: int = 5, order: str = "transaction_id") -> DataFrame:
    """First rows in a stable order (top-k, not a sample)."""
    return df.orderBy(order).limit(n)
