"""Versioned tables: write a new version beside the old ones, then name it in a manifest.

A version's rows are in a folder of their own that never changes.  What makes it a
version is a small manifest that names the folder.  It is written last, and for a
new stamp only if no other writer has done so, so readers see a version whole or not
at all, and nothing is renamed, which object stores cannot do in one step.
"""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage


def _manifests(base: str, logical: str) -> str:
    return f"{base}/{logical}/_manifest"


def versions(spark: SparkSession, base: str, logical: str) -> list[str]:
    """Names of versions, newest first.

    A version is there once its manifest is, so a crashed or half-written version
    is never seen.
    """
    names = storage.child_files(spark, _manifests(base, logical))
    return sorted({n.rpartition(".")[0] for n in names if n.startswith("v=")}, reverse=True)


def _newest(spark: SparkSession, base: str, logical: str, version: str) -> str | None:
    """The manifest that counts for a version: the one with the highest edition."""
    names = [n for n in storage.child_files(spark, _manifests(base, logical)) if n.rpartition(".")[0] == version]
    return max(names, default=None)


def read_version(spark: SparkSession, base: str, logical: str, version: str) -> DataFrame:
    """The rows of a version as its newest manifest names them."""
    text = storage.read_text(spark, f"{_manifests(base, logical)}/{_newest(spark, base, logical, version)}")
    return spark.read.parquet(f"{base}/{logical}/{json.loads(text)['folder']}")


def current(spark: SparkSession, base: str, logical: str) -> DataFrame | None:
    """The newest version, or None before the first publish."""
    names = versions(spark, base, logical)
    return read_version(spark, base, logical, names[0]) if names else None


def publish_version(
    df: DataFrame,
    base: str,
    logical: str,
    stamp: str,
    retain: int = 3,
    check: Callable[[DataFrame], None] | None = None,
    view: str | None = None,
) -> str:
    """Write ``df`` to a folder that no reader knows, check it, then make it version ``stamp``.

    If writing or ``check`` fails, what was written is removed and nothing changes.
    ``retain`` keeps that many newest versions; 0 keeps all.  Publishing the same
    stamp again adds an edition of it that replaces the one before, so a repeated
    micro-batch does no harm; rows of the edition replaced stay until the next
    version goes out, for readers that have begun.  Of writers that publish one
    edition at the same time the first wins and the others go on to the next.
    ``view`` names a temporary view that is pointed at the new version.
    """
    spark = df.sparkSession
    folder = f"rows-{stamp}-{uuid.uuid4().hex}"
    path = f"{base}/{logical}/{folder}"
    try:
        df.write.mode("errorifexists").parquet(path)
        if check:
            check(spark.read.parquet(path))
    except Exception:
        storage.delete_folder(spark, path)
        raise
    text = json.dumps({"folder": folder})
    before = _newest(spark, base, logical, f"v={stamp}")
    first = 0 if before is None else int(before.rpartition(".")[2]) + 1
    for edition in itertools.count(first):  # one that is there belongs to another writer, or to one that stopped
        if storage.write_text(spark, f"{_manifests(base, logical)}/v={stamp}.{edition:06d}", text, replace=False):
            break
    if view:
        spark.read.parquet(path).createOrReplaceTempView(view)
    _forget(spark, base, logical, stamp, retain)
    return path


def _forget(spark: SparkSession, base: str, logical: str, stamp: str, retain: int) -> None:
    """Remove versions beyond ``retain``, and replaced editions of versions other than ``stamp``."""
    kept = versions(spark, base, logical)
    kept = set(kept[:retain] if retain else kept)
    at = _manifests(base, logical)
    for name in storage.child_files(spark, at):
        version = name.rpartition(".")[0]
        if not name.startswith("v=") or (version in kept and (version == f"v={stamp}" or name == _newest(spark, base, logical, version))):
            continue
        folder = json.loads(storage.read_text(spark, f"{at}/{name}"))["folder"]
        storage.delete_folder(spark, f"{at}/{name}")
        storage.delete_folder(spark, f"{base}/{logical}/{folder}")


def version_rows(spark: SparkSession, base: str, logical: str) -> DataFrame:
    """Row count of each complete version and which one is current."""
    names = versions(spark, base, logical)
    out = None
    for i, name in enumerate(names):
        row = read_version(spark, base, logical, name).agg(F.count("*").alias("row_count")).select(
            F.lit(name[2:]).alias("version"), "row_count", F.lit(i == 0).alias("is_current")
        )
        out = row if out is None else out.unionByName(row)
    return out
