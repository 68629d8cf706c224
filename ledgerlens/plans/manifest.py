"""What a run has finished, kept beside its results so that it can go on.

A stage that ends writes one small JSON file with the paths and values that
later stages use, and the state of the input it was made from. A run over the
same input and settings, in the same folder, takes the finished stages over and
starts at the first one that is missing; after another input, other settings or
lost tables the stages run again from there.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str, base: str) -> None:
    """Delete what lies at ``path``; only below the run's own folder."""
    if not path.startswith(base.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {base}")
    p, fs = _path(spark, path)
    fs.delete(p, True)


def input_state(raw: DataFrame, settings: object) -> str:
    """A digest of the input files (names, lengths, times), the plan over them
    and the settings. The files are those Spark has listed for the scan; an
    input without files is told by its plan alone."""
    spark = raw.sparkSession
    told = hashlib.sha256(repr(settings).encode())
    told.update(str(raw.schema.simpleString()).encode())
    names = sorted(raw.inputFiles())
    for name in names:
        p, fs = _path(spark, name)
        found = fs.getFileStatus(p)
        told.update(f"{name} {found.getLen()} {found.getModificationTime()}\n".encode())
    if not names:
        told.update(str(raw.semanticHash()).encode())
    return told.hexdigest()


def _file(base: str, stage: str) -> str:
    return f"{base}/manifest/{stage}.json"


def finish(spark: SparkSession, base: str, stage: str, entry: dict) -> None:
    """Write the entry of a finished stage: under another name first, so that
    a half-written one is never read."""
    target, fs = _path(spark, _file(base, stage))
    draft, _ = _path(spark, _file(base, stage) + ".draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise RuntimeError(f"cannot write {target}")


def finished(spark: SparkSession, base: str, stage: str, state: str, skip: tuple[str, ...] = ()) -> dict | None:
    """The entry of a stage that ended on this input and whose tables are all
    there (those named in ``skip`` need not be); else None."""
    if not exists(spark, _file(base, stage)):
        return None
    text = "\n".join(r["value"] for r in spark.read.text(_file(base, stage)).collect())      # one line
    entry = json.loads(text)
    entry["paths"] = {k: p for k, p in entry["paths"].items() if k not in skip}
    if entry["state"] != state or not all(exists(spark, p) for p in entry["paths"].values()):
        return None
    return entry


def forget(spark: SparkSession, base: str, stages: list[str]) -> None:
    for stage in stages:
        delete(spark, _file(base, stage), base)
