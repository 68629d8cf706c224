"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import configure, scratch_path

# white space of the operators' contracts: [\x20\x09-\x0D]
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once an application:
    a zip that the driver serves (skipped where it runs from a zip itself)."""
    app, package = spark.sparkContext.applicationId, Path(__file__).parent.parent
    if app in _shipped or not package.is_dir():
        return
    _shipped.add(app)
    path = Path(tempfile.mkdtemp(prefix="ledgerlens-py-"), "ledgerlens_py.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package, set the session up: few rows and bytes per Arrow
    batch, so that a batch of very long documents stays small."""
    configure(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts the
    lineage and fixes row ids and sampled cut points for every later use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_held: dict = {}              # key -> [object, time of its last use], of this process
IDLE = 5.0                    # seconds without use after which another operator's tables may go


def held(key: object, make: Callable):
    """An object of a worker process that its tasks share, made once."""
    entry = _held.get(key)
    if entry is None:
        release()
        _trim()               # also what stages that hold nothing here have left
        entry = _held[key] = [make(), 0.0]
    entry[1] = time.monotonic()
    return entry[0]


def release(idle: float = IDLE) -> None:
    """Let go of what the stages before have left in this process, and give
    the memory back: workers live longer than a stage."""
    old = [k for k, (_, used) in _held.items() if time.monotonic() - used > idle]
    for k in old:
        del _held[k]
    if old:
        _trim()


def _trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()     # batches that Arrow keeps room for
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
