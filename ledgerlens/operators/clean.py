"""Cleaning (V7-V11): trim, deterministic dedup, drop incomplete rows.

The dedup is an aggregation, not a window: copies of one key are combined
map-side (partial aggregate) before the shuffle, so a key holding a large
share of all rows never arrives whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from ..schema import CRITICAL_FIELDS


def trim_strings(df: DataFrame) -> DataFrame:
    """V7: trim spaces (only the space character) from every string column."""
    return df.select(*[
        F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def incomplete(df: DataFrame, fields: list[str] = CRITICAL_FIELDS) -> Column:
    """True where a critical field is NULL (or NaN for floating columns)."""
    cond = F.lit(False)
    for name in fields:
        c = F.col(name)
        part = c.isNull()
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            part = part | F.isnan(c)
        cond = cond | part
    return cond


def deduplicate(df: DataFrame, key: str = "transaction_id",
                order: list[str] | None = None) -> DataFrame:
    """V8: one row per key; the survivor is the row with all critical fields
    present first, then the earliest ``timestamp``, then the smallest values
    of the remaining columns in schema order (NULLs first).

    Implemented as ``min(struct(rank..., row...))`` per key: a partial
    aggregate, so hot keys are combined before the shuffle.
    """
    order = order or ["timestamp"]
    rest = [c for c in df.columns if c != key and c not in order]
    ranked = F.struct(
        incomplete(df).cast("int").alias("_incomplete"),
        *[F.col(c) for c in order], *[F.col(c) for c in rest],
    )
    best = df.groupBy(key).agg(F.min(ranked).alias("_best"))
    return best.select(*[
        F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns
    ])


def drop_incomplete(df: DataFrame, fields: list[str] = CRITICAL_FIELDS) -> DataFrame:
    """V9: drop rows with NULL (or NaN) in a critical field."""
    return df.na.drop(subset=fields)


def clean_data(df: DataFrame) -> DataFrame:
    """Trim, then dedup, then drop incomplete rows (this order)."""
    return df.transform(trim_strings).transform(deduplicate).transform(drop_incomplete)


def ingest_summary(raw: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Original rows, rows kept by ``clean_data``, duplicates removed.

    One pass: a per-key partial aggregate (count, best completeness), then a
    global one. A key survives when its best row is complete.
    """
    trimmed = trim_strings(raw)
    per_key = trimmed.groupBy(key).agg(
        F.count(F.lit(1)).alias("_c"),
        F.min(incomplete(trimmed).cast("int")).alias("_inc"),
    )
    return per_key.agg(
        F.sum("_c").alias("original_records"),
        F.count_if((F.col("_inc") == 0) & F.col(key).isNotNull()).alias("validated_records"),
        (F.sum("_c") - F.count(F.lit(1))).alias("duplicates_removed"),
    )
