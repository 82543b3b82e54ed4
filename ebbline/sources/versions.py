"""Versions of a table beside its path, so that a rewrite never takes away what a reader has open.

A writer claims the next number, writes ``<path>.versions/data-<n>`` and then
publishes it by renaming a finished manifest to ``<n>.json``.  Readers take the
manifest with the highest number and never see a half-written version; older
folders stay until ``drop_old_versions``.  A manifest may name files at the
path itself that its folder replaces: an append-only log is compacted so,
while appends go on.
"""
from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NUMBER = 9   # digits of a version's number


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return sorted(str(st.getPath()) for st in fs.globStatus(p) or [])


def _claim(spark: SparkSession, path: str) -> str:
    """The next free number; ``createNewFile`` gives it to one writer only."""
    claimed = _glob(spark, f"{path}.versions/*.claim")
    n = int(claimed[-1].rsplit("/", 1)[-1].split(".")[0]) + 1 if claimed else 1
    while True:
        fs, p = _fs(spark, f"{path}.versions/{n:0{NUMBER}d}.claim")
        if fs.createNewFile(p):
            return f"{n:0{NUMBER}d}"
        n += 1


def publish(spark: SparkSession, path: str, write: Callable[[str], None], replaces: list[str] = ()) -> str:
    """Let ``write`` fill a new folder, then make it the current version; the folder."""
    number = _claim(spark, path)
    folder = f"{path}.versions/data-{number}"
    write(folder)
    fs, tmp = _fs(spark, f"{path}.versions/{number}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"folder": folder, "replaces": list(replaces)}).encode()))
    out.close()
    if not fs.rename(tmp, _fs(spark, f"{path}.versions/{number}.json")[1]):
        raise OSError(f"could not publish version {number} of {path}")
    return folder


def manifests(spark: SparkSession, path: str) -> list[str]:
    return _glob(spark, f"{path}.versions/*.json")


def read_manifest(spark: SparkSession, manifest: str) -> dict:
    """One small file, read through Spark so that any store will do."""
    return json.loads(spark.read.option("wholetext", "true").text(manifest).first()[0])


def current(spark: SparkSession, path: str) -> dict | None:
    """folder and replaces of the newest published version; None where nothing was published."""
    found = manifests(spark, path)
    return read_manifest(spark, found[-1]) if found else None


def log_paths(spark: SparkSession, path: str) -> list[str]:
    """What holds a log's rows now: the compacted folder, and the files appended since."""
    version = current(spark, path)
    files = [f for f in _glob(spark, f"{path}/*") if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
    if version is None:
        return files
    gone = set(version["replaces"])
    return [version["folder"], *(f for f in files if f.rsplit("/", 1)[-1] not in gone)]


def compact_log(spark: SparkSession, path: str, read: Callable[[list[str]], DataFrame]) -> str | None:
    """One version with all rows of a log in files of Spark's target size; None where there is nothing.

    Rows appended meanwhile are in files that the version does not name, so
    they are read beside it; a writer that failed leaves no version behind.
    """
    paths = log_paths(spark, path)
    if not paths:
        return None
    version = current(spark, path)
    named = set(version["replaces"]) if version else set()
    named.update(p.rsplit("/", 1)[-1] for p in paths if not version or p != version["folder"])
    return publish(spark, path, lambda folder: read(paths).hint("rebalance").write.parquet(folder), sorted(named))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions, and the log files that every kept version replaces."""
    found = manifests(spark, path)
    if len(found) <= keep:
        return
    kept = [read_manifest(spark, m) for m in found[-keep:]]
    for name in set.intersection(*(set(v["replaces"]) for v in kept)):
        fs, p = _fs(spark, f"{path}/{name}")
        fs.delete(p, False)
    for m in found[:-keep]:
        folder = read_manifest(spark, m)["folder"]
        fs, p = _fs(spark, m)
        fs.delete(p, False)
        fs.delete(_fs(spark, folder)[1], True)
