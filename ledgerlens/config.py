"""Thresholds, value domains, skew settings and session configuration.

Every literal the rules depend on lives here so that operators take a config
object instead of reading module globals.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Thresholds:
    """Rule thresholds. Defaults are the reference's fixed values."""

    # Fixed values (must equal the reference for identical results):
    # high amount 2000, night amount 1000, velocity amount 500,
    # fast-gap minutes 5, 30, 120, amount bands 50, 200, 1000,
    # alert score 7, priority bands ALTA 8 and MEDIA 5,
    # night = hour >= 23 or hour < 6 (slots start at 6, 12, 18, 23).
    high_amount: float = 2000.0
    night_amount: float = 1000.0
    velocity_amount: float = 500.0
    velocity_minutes: tuple[float, float, float] = (5.0, 30.0, 120.0)
    amount_bands: tuple[float, float, float] = (50.0, 200.0, 1000.0)
    slot_hours: tuple[int, int, int, int] = (6, 12, 18, 23)
    alert_score: int = 7
    high_priority_score: int = 8
    medium_priority_score: int = 5
    # risk score weights: declined, night, velocity, high amount
    score_weights: tuple[int, int, int, int] = (2, 3, 3, 2)


@dataclass(frozen=True)
class Domains:
    """Allowed values of the categorical columns (used by the V4 check)."""

    account_type: tuple[str, ...]
    country: tuple[str, ...]
    currency: tuple[str, ...]
    status: tuple[str, ...]
    channel: tuple[str, ...]
    category: tuple[str, ...]

    def as_dict(self) -> dict[str, tuple[str, ...]]:
        return {
            "account_type": self.account_type,
            "country": self.country,
            "currency": self.currency,
            "status": self.status,
            "channel": self.channel,
            "category": self.category,
        }


# The reference's domain lists, in its order.
REFERENCE_DOMAINS = Domains(
    account_type=("Corriente", "Ahorro", "Empresarial", "Premium"),
    country=("ES", "FR", "DE", "UK", "US", "MX"),
    currency=("EUR", "USD", "GBP", "MXN"),
    status=("APPROVED", "DECLINED", "PENDING", "FRAUD"),
    channel=("Online", "Movil", "Presencial", "ATM"),
    category=(
        "Supermercado", "Restaurante", "Gasolinera", "Hotel", "E-commerce",
        "Transferencia", "Cajero", "Farmacia", "Entretenimiento", "Transporte",
    ),
)


@dataclass(frozen=True)
class SkewConfig:
    """How hot keys are split.

    ``rows_per_split``: a customer with more rows than this is cut into time
    slices of about this many rows each, so that the per-customer window never
    lands in a single task; a larger tie group (one customer, one timestamp) is
    spread. The tables of hot customers, cut points, ties and slice edges have
    at most a few times ``total_rows / rows_per_split`` rows: the size bound
    that makes broadcasting them safe. Sizing rule: keep ``rows_per_split >=
    total_rows / 500_000``, which bounds each at about a million narrow rows
    (the 2 M default covers 1e12 rows).
    """

    rows_per_split: int = 2_000_000


@dataclass(frozen=True)
class Settings:
    thresholds: Thresholds = field(default_factory=Thresholds)
    domains: Domains = REFERENCE_DOMAINS
    skew: SkewConfig = field(default_factory=SkewConfig)
    # files written by the single-file alert CSV sink; None keeps one file per task
    csv_files: int | None = None


DEFAULT_SETTINGS = Settings()

# SQL-level settings applied to a session (P2). Shuffle partition count is
# deliberately left to the cluster and AQE's coalescing.
# Always enforced: results and the plans the operators rely on depend on them.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}
# Sizing defaults: applied only where the session (or the cluster) has no
# value of its own.
SIZING_DEFAULTS = {
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce to the advisory partition size instead of keeping many tiny ones
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # post-shuffle partitions (and so rebalanced output files, which come out
    # two to four times smaller than their shuffle bytes). A window or a sort
    # holds its partition's rows unpacked, about 15 times the compressed shuffle
    # bytes of the full rows, so this bounds the memory of a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the session settings the operators rely on (UTC, AQE, Snappy)
    and the sizing defaults the session does not set itself.

    ``shuffle_partitions`` sets the initial shuffle width for the target
    scale (about input bytes / 256 MB, e.g. ~400k for 100 TB); AQE then
    coalesces small ones. Left unset, the session's value is kept.
    """
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in SIZING_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``.

    On a cluster this must name shared storage and is used as given; without
    it the call raises, since a folder of the driver's own machine would leave
    tables incomplete. Only a local master (tests, single machine) gets a
    private folder when none is set.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(
                f"set spark.checkpoint.dir to a folder shared by driver and executors (master {sc.master})")
        d = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared scratch folder."""
    return f"{scratch_dir(spark)}/ledgerlens/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one scratch table made by :func:`scratch_path`; refuses others."""
    if not path.startswith(f"{scratch_dir(spark)}/ledgerlens/"):
        raise ValueError(f"not below the scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
