"""Data-quality checks (V1-V6).

Every check is one aggregation producing long-format rows, and the full
report fuses the per-row checks into a single aggregation plus a key-only
distinct count (the reference ran one job per column and check).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from ..config import Domains
from ..functions import exprs as X


def validate_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """V1: (column, issue, expected_type, actual_type) for missing, extra and
    retyped columns. Missing columns make the schema invalid; extra columns
    are only reported. Works on metadata, reads no rows."""
    spark = df.sparkSession
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    rows += [(c, "extra", None, t) for c, t in have.items() if c not in want]
    rows += [(c, "type", want[c], have[c]) for c in want
             if c in have and want[c] != have[c]]
    return spark.createDataFrame(
        rows, "column string, issue string, expected_type string, actual_type string")


def schema_is_valid(issues: DataFrame) -> bool:
    return issues.filter(F.col("issue") == "missing").isEmpty()


def _null_like(df: DataFrame, name: str) -> Column:
    """NULL, NaN for floating columns, empty for strings (typed per column)."""
    c = F.col(name)
    dt = df.schema[name].dataType
    cond = c.isNull()
    if isinstance(dt, (DoubleType, FloatType)):
        cond = cond | F.isnan(c)
    elif isinstance(dt, StringType):
        cond = cond | (c == "")
    return cond


def _long(wide: DataFrame, names: list[str], key: str, value: str) -> DataFrame:
    return wide.unpivot([], names, key, value)


def null_count_columns(df: DataFrame) -> list[Column]:
    return [X.count_if(_null_like(df, c)).alias(c) for c in df.columns]


def check_nulls(df: DataFrame) -> DataFrame:
    """V2: (column, null_count) for columns with at least one null-like value."""
    wide = df.agg(*null_count_columns(df))
    return _long(wide, df.columns, "column", "null_count").filter(F.col("null_count") > 0)


def _distinct_with_null(key: Column) -> Column:
    """Distinct values of ``key``, NULL counted as one value."""
    return F.count_distinct(key) + F.max(F.when(key.isNull(), 1).otherwise(0))


def check_duplicates(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """V3: total rows, distinct keys and duplicates = total - distinct."""
    k = F.col(key)
    total = F.count(F.lit(1))
    distinct = _distinct_with_null(k)
    return df.agg(
        total.alias("total_rows"),
        distinct.alias("distinct_keys"),
        (total - distinct).alias("duplicates"),
    )


def invalid_columns(domains: Domains) -> list[Column]:
    return [X.count_if(~F.col(c).isin(list(v))).alias(c)
            for c, v in domains.as_dict().items()]


def validate_categorical_values(df: DataFrame, domains: Domains) -> DataFrame:
    """V4: (column, invalid_count) for values outside the domain; NULL is not
    counted as invalid."""
    names = list(domains.as_dict())
    wide = df.agg(*invalid_columns(domains))
    return _long(wide, names, "column", "invalid_count").filter(F.col("invalid_count") > 0)


NUMERIC_ISSUES = ["negative_amounts", "zero_amounts", "invalid_customer_ids"]


def numeric_issue_columns() -> list[Column]:
    return [
        X.count_if(F.col("amount") < 0).alias("negative_amounts"),
        X.count_if(F.col("amount") == 0).alias("zero_amounts"),
        X.count_if(F.col("customer_id") < 0).alias("invalid_customer_ids"),
    ]


def validate_numeric_ranges(df: DataFrame) -> DataFrame:
    """V5: (issue, count) for negative or zero amounts and negative customers."""
    wide = df.agg(*numeric_issue_columns())
    return _long(wide, NUMERIC_ISSUES, "issue", "count").filter(F.col("count") > 0)


def validation_conditions(df: DataFrame, domains: Domains) -> dict[str, Column]:
    """Every check except duplicates as a per-row boolean, named
    ``check__column`` (NULL counts as false); checks of absent columns are
    left out."""
    have = set(df.columns)
    conds = {"total__*": F.lit(True)}
    conds.update({f"nulls__{c}": _null_like(df, c) for c in df.columns})
    conds.update({f"invalid__{c}": ~F.col(c).isin(list(v))
                  for c, v in domains.as_dict().items() if c in have})
    numeric = {
        "amount": {"numeric__negative_amounts": F.col("amount") < 0, "numeric__zero_amounts": F.col("amount") == 0},
        "customer_id": {"numeric__invalid_customer_ids": F.col("customer_id") < 0},
    }
    for c, own in numeric.items():
        conds.update(own if c in have else {})
    return conds


def validation_metrics(df: DataFrame, domains: Domains) -> list[Column]:
    """The checks as aggregate columns (one aggregation for all of them)."""
    return [X.count_if(c).alias(n) for n, c in validation_conditions(df, domains).items()]


REPORT_SCHEMA = "check string, column string, n long"


def report_rows(metrics: dict, missing: list[str] = ()) -> list[tuple[str, str, int]]:
    """Long rows from named metric values: totals and duplicates always,
    other checks only where positive, one row per missing column."""
    rows = []
    for name, n in metrics.items():
        check, column = name.split("__", 1)
        if n > 0 or check in ("total", "duplicates"):
            rows.append((check, column, int(n)))
    rows += [("schema_missing", c, 1) for c in missing]
    return rows


def generate_validation_report(df: DataFrame, expected: StructType, domains: Domains,
                               key: str = "transaction_id") -> DataFrame:
    """V6: every check as (check, column, n) rows.

    ``total``/``*`` always; ``schema_missing`` per missing column;
    ``nulls``, ``invalid``, ``numeric`` only where the count is positive;
    ``duplicates``/``key`` always. A check whose column is missing is left
    out, so each missing column is reported instead of failing the report.

    Two aggregations: the per-row checks are one global aggregate (a partial
    per task, no shuffle of rows), and the distinct keys a key-only
    aggregate. A distinct count inside the checks aggregate would group by
    the key first and carry every check counter through that shuffle, for
    each key. ``duplicates = rows - distinct keys`` is summed from one row of
    each part (NULL counts as one key, as ``groupBy`` groups it).
    """
    cols = df.columns
    wide = df.agg(*validation_metrics(df, domains))
    # the rows half of the duplicate count, unpivoted with the checks
    if key in cols:
        wide = wide.withColumn(f"duplicates__{key}", F.col("`total__*`"))
    long = _long(wide, wide.columns, "_k", "n")
    parts = F.split(F.col("_k"), "__")
    checks = long.select(parts[0].alias("check"), parts[1].alias("column"), "n")
    if key in cols:
        keys = df.select(key).distinct().agg(F.count(F.lit(1)).alias("_keys"))
        checks = checks.unionByName(keys.select(
            F.lit("duplicates").alias("check"), F.lit(key).alias("column"), (-F.col("_keys")).alias("n")))
    out = (
        checks.groupBy("check", "column").agg(F.sum("n").cast("long").alias("n"))
        .filter((F.col("n") > 0) | F.col("check").isin("total", "duplicates"))
    )
    missing = [f.name for f in expected.fields if f.name not in cols]
    if missing:
        spark: SparkSession = df.sparkSession
        out = out.unionByName(spark.createDataFrame(report_rows({}, missing), REPORT_SCHEMA))
    return out
