"""Catalog layer (S10-S17): views, external Parquet tables, checks.

The DDL is executed (not only printed): ``CREATE TABLE ... USING PARQUET
PARTITIONED BY ... LOCATION`` followed by ``MSCK REPAIR TABLE``, which works
with Spark's own catalog and needs no Hive metastore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schema import (
    ALERT_TABLE_COLUMNS, PARTITION_COLUMNS, PROCESSED_SCHEMA, RULE_FIELDS, column_ddl,
)


TRANSACTIONS_TABLE = "transactions_processed"
ALERTS_TABLE = "fraud_alerts"


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Session view."""
    df.createOrReplaceTempView(name)
    return df


# marks the tables this library made; others of the same name are left alone
OWNED = "ledgerlens.created"


def transactions_ddl(location: str, name: str = TRANSACTIONS_TABLE) -> str:
    cols = column_ddl(PROCESSED_SCHEMA)
    parts = ", ".join(PARTITION_COLUMNS)
    return (f"CREATE TABLE {name} ({cols}) USING PARQUET "
            f"PARTITIONED BY ({parts}) LOCATION '{location}' TBLPROPERTIES ('{OWNED}' = 'true')")


def alerts_ddl(location: str, name: str = ALERTS_TABLE) -> str:
    fields = {f.name: f for f in list(PROCESSED_SCHEMA.fields) + RULE_FIELDS}
    schema = StructType([fields[c] for c in ALERT_TABLE_COLUMNS])
    return (f"CREATE TABLE {name} ({column_ddl(schema)}) USING PARQUET LOCATION '{location}' "
            f"TBLPROPERTIES ('{OWNED}' = 'true')")


def drop_own(spark: SparkSession, name: str) -> None:
    """Drop an external table of an earlier run (its files stay). A table,
    managed or not, or a view of this name that the library did not make is
    never touched: the call raises."""
    if not spark.catalog.tableExists(name):
        return
    marks = {}
    if spark.catalog.getTable(name).tableType == "EXTERNAL":
        marks = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if marks.get(OWNED) != "true":
        raise ValueError(f"{name} exists and was not made by this library; choose another name or schema")
    spark.sql(f"DROP TABLE {name}")


def create_transactions_table(spark: SparkSession, location: str,
                              name: str = TRANSACTIONS_TABLE, recover: bool = True) -> str:
    """S11 + S13: external partitioned table over written Parquet, then
    partition recovery (``recover=False``: ``publish.add_days`` names the days).
    Returns the DDL that was run. ``name`` may carry a schema (``db.table``)."""
    ddl = transactions_ddl(location, name)
    drop_own(spark, name)
    spark.sql(ddl)
    if recover:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return ddl


def create_alerts_table(spark: SparkSession, location: str | None,
                        name: str = ALERTS_TABLE) -> str | None:
    """Alerts table with the 18 DDL columns; without alerts (None) there
    is no table, and one of an earlier run goes."""
    drop_own(spark, name)
    if location is None:
        return None
    ddl = alerts_ddl(location, name)
    spark.sql(ddl)
    return ddl


def list_tables(spark: SparkSession) -> DataFrame:
    """Tables and views of the current database."""
    return spark.sql("SHOW TABLES")


def table_exists(spark: SparkSession, name: str) -> bool:
    """S15."""
    return spark.catalog.tableExists(name)


def count_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    """(table_name, total) for every existing table, through SQL."""
    parts = [f"SELECT '{n}' AS table_name, COUNT(*) AS total FROM {n}"
             for n in names if table_exists(spark, n)]
    return spark.sql(" UNION ALL ".join(parts))


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Column names and types."""
    return spark.sql(f"DESCRIBE {name}")
