"""Publishing of single days into the partitioned table.

A day is published again by writing its rows alone: dynamic partition overwrite
stages the new files beside the table and swaps them in when every task has
finished, so the files of other days are not touched and a write that fails
leaves the table as it was. What was read back is compared with what was meant
to be written, day by day, and the catalog learns of the new days alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PARTITION_COLUMNS
from .files import MAX_RECORDS_PER_FILE, rebalanced

Day = tuple[int | None, ...]


def day_counts(df: DataFrame, name: str = "rows") -> DataFrame:
    """Rows per day."""
    return df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias(name))


def publish_days(df: DataFrame, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Replace the days that occur in ``df`` below ``path``; all others stay,
    file by file. Returns ``year, month, day, written_rows, read_rows``, one row
    per published day, and raises when a day differs.

    ``expected`` holds the rows per day (:func:`day_counts`); without it they
    are counted from ``df``, which runs it a second time.
    """
    spark = df.sparkSession
    expected = (day_counts(df) if expected is None else expected).select(
        *PARTITION_COLUMNS, F.col("rows").alias("written_rows"))
    days = expected.collect()                                  # one row a day
    (rebalanced(df, *PARTITION_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*PARTITION_COLUMNS).parquet(path))
    fields = ", ".join(f"{c} int" for c in PARTITION_COLUMNS)
    meant = spark.createDataFrame([tuple(d) for d in days], f"{fields}, written_rows long")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"m.{c}")) for c in PARTITION_COLUMNS]
    # the days are partition columns: only their directories are read back
    back = day_counts(spark.read.schema(df.schema).parquet(path).alias("t").join(
        F.broadcast(meant.alias("m")), same, "left_semi"), "read_rows")
    out = meant.alias("m").join(F.broadcast(back.alias("t")), same, "left").select(
        *[F.col(f"m.{c}") for c in PARTITION_COLUMNS], "written_rows", F.coalesce("read_rows", F.lit(0)).alias("read_rows"))
    found = out.collect()                                      # one row a day
    wrong = [tuple(r) for r in found if r["written_rows"] != r["read_rows"]]
    if wrong:
        raise RuntimeError(f"days read back with other rows than written: {wrong[:5]}")
    return spark.createDataFrame([tuple(r) for r in found], f"{fields}, written_rows long, read_rows long")


def add_days(spark: SparkSession, table: str, days: list[Day]) -> int:
    """Tell the catalog of published days, in place of a repair that lists
    every directory of the table: one statement, nothing listed but the days
    given. Days it knows already stay. Returns the partitions that are new.
    A day with a NULL part can only be found by a repair."""
    if any(v is None for d in days for v in d):
        spark.sql(f"MSCK REPAIR TABLE {table}")
        return len(days)
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if days else set()
    new = [d for d in days if "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, d)) not in known]
    if new:
        parts = " ".join("PARTITION (" + ", ".join(f"{c}={int(v)}" for c, v in zip(PARTITION_COLUMNS, d)) + ")" for d in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    return len(new)
