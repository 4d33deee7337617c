"""Keyed state in hash buckets, with a manifest for every batch.

Rows of a state live in the bucket of their key.  A batch reads the buckets of the
keys it names and writes these buckets anew under its own number; its manifest, a
small file that is written last, says for each bucket in which batch's folder its
rows are and how long its files.  So what a batch reads and writes follows the batch and the
size of a bucket, not the size of the state.

A batch starts from the newest manifest before its own number.  When it runs again
it replaces its own folder and manifest and nothing else.  The number of buckets
follows the rows, by the bytes of a row when they were last dealt out: once buckets
hold more than twice ``ROWS`` on average, the next batch deals all rows to twice as
many or more.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import storage

#: Rows that a bucket should hold on average.
ROWS = 50_000
#: Manifests that are kept; older ones go, and folders that only they name.
RETAIN = 5


def stamp(batch_id: int) -> str:
    return f"{batch_id:012d}"


class BucketState:
    """The state ``name`` under ``base``: one row per key; a null part of a key equals another.

    ``first`` are the rows before any batch; they are dealt to buckets once, by the
    first batch.  ``rows`` is the size of a bucket.
    """

    def __init__(self, spark: SparkSession, base: str, name: str, keys: Sequence[str], first: DataFrame | None = None, rows: int | None = None):
        self.spark, self.folder, self.keys, self.first, self.rows = spark, f"{base}/{name}", list(keys), first, rows or ROWS
        self._known: tuple[int, set[int]] | None = None

    def manifest(self, before: int) -> dict | None:
        """The newest manifest of a batch below ``before``: bucket count, schema, bytes of a row, and [batch, bytes] of each bucket."""
        names = [n for n in storage.child_files(self.spark, f"{self.folder}/manifest") if n.endswith(".json")]
        older = [n for n in names if n < f"{stamp(before)}.json"]
        return json.loads(storage.read_text(self.spark, f"{self.folder}/manifest/{max(older)}")) if older else None

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _rows(self, manifest: dict, wanted: set[int] | None = None) -> DataFrame:
        """All rows of the named buckets (of all without names), with their bucket."""
        paths = [
            f"{self.folder}/data/batch={batch}/bucket={bucket}"
            for bucket, (batch, _) in manifest["held"].items()
            if wanted is None or int(bucket) in wanted
        ]
        schema = T.StructType.fromJson(manifest["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def start(self) -> None:
        """Deal ``first`` to buckets, unless that has been done."""
        if self.first is None or self.manifest(2**62) is not None:
            return
        self._lay_out(self.first, self.first.count(), -1)

    def _named(self, changes: DataFrame, buckets: int) -> set[int]:
        """The buckets that the keys of ``changes`` fall into."""
        return {r[0] for r in changes.select(self._bucket(buckets)).distinct().collect()}

    def _lay_out(self, rows: DataFrame, total: int, batch_id: int) -> None:
        """Deal ``total`` rows to buckets anew."""
        self._commit(rows, batch_id, max(1, -(-total // self.rows)), {}, total)

    def _joined(self, rows: DataFrame, changes: DataFrame, how: str) -> DataFrame:
        named = changes.select(*[F.col(k).alias(f"__of_{k}") for k in self.keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in self.keys]
        return rows.join(named, same, how)

    def touched(self, changes: DataFrame, before: int) -> DataFrame | None:
        """The rows whose bucket some key of ``changes`` falls into; None before there is a state."""
        self.start()
        manifest = self.manifest(before)
        if manifest is None:
            return None
        self._known = (before, self._named(changes, manifest["buckets"]))
        return self._rows(manifest, self._known[1])

    def of(self, changes: DataFrame, before: int) -> DataFrame | None:
        """The rows of the keys of ``changes``."""
        held = self.touched(changes, before)
        return None if held is None else self._joined(held, changes, "left_semi")

    def all(self, before: int = 2**62) -> DataFrame | None:
        self.start()
        manifest = self.manifest(before)
        return None if manifest is None else self._rows(manifest)

    def update(self, changes: DataFrame, merge: Callable[[DataFrame], DataFrame], batch_id: int) -> None:
        """Write the buckets of the keys of ``changes`` as ``merge`` makes them from all their rows.

        ``merge`` may only add or change rows whose keys are among those of ``changes``.
        There must be a state.
        """
        self.start()
        manifest = self.manifest(batch_id)
        buckets, held = manifest["buckets"], manifest["held"]
        total = int(sum(size for _, size in held.values()) / manifest["row_bytes"])
        if total > 2 * self.rows * buckets:
            self._lay_out(merge(self._rows(manifest)), total, batch_id)
            return
        # the keys that were asked for before this batch take in those that it changes
        named = self._known[1] if self._known and self._known[0] == batch_id else self._named(changes, buckets)
        others = {b: v for b, v in held.items() if int(b) not in named}
        self._commit(merge(self._rows(manifest, named)), batch_id, buckets, others, None, manifest["row_bytes"])

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """Put ``changes`` (one row per key) in the place of the rows with their keys.

        Keys that this object was asked for at the same batch must take in those of ``changes``.
        """
        self.start()
        if self.manifest(batch_id) is None:
            self._lay_out(changes, changes.count(), batch_id)
            return

        def replaced(rows: DataFrame) -> DataFrame:
            return self._joined(rows, changes, "left_anti").unionByName(changes.select(*rows.columns))

        self.update(changes, replaced, batch_id)

    def _commit(self, rows: DataFrame, batch_id: int, buckets: int, held: dict, total: int | None = None, row_bytes: float = 0.0) -> None:
        """Write whole buckets, then the manifest that names them; ``total`` counts the rows where all are written."""
        number = stamp(batch_id) if batch_id >= 0 else "first"
        path = f"{self.folder}/data/batch={number}"
        placed = rows.withColumn("bucket", self._bucket(buckets))
        placed.repartition("bucket").sortWithinPartitions("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(path)
        sizes = {n.removeprefix("bucket="): size for n, size in storage.child_sizes(self.spark, path).items() if n.startswith("bucket=")}
        held = {**held, **{bucket: [number, size] for bucket, size in sizes.items()}}
        if total is not None:
            row_bytes = max(1.0, sum(sizes.values()) / max(1, total))
        text = json.dumps({"buckets": buckets, "schema": json.loads(rows.schema.json()), "row_bytes": row_bytes, "held": held})
        storage.write_text(self.spark, f"{self.folder}/manifest/{number if batch_id >= 0 else '-'}.json", text)
        self._forget()

    def _forget(self) -> None:
        """Drop manifests beyond those kept, and the buckets that no kept one names."""
        at = f"{self.folder}/manifest"
        names = sorted(n for n in storage.child_files(self.spark, at) if n.endswith(".json"))
        if len(names) <= RETAIN:
            return
        read = lambda n: {(b, v[0]) for b, v in json.loads(storage.read_text(self.spark, f"{at}/{n}"))["held"].items()}
        kept = set().union(*(read(n) for n in names[-RETAIN:]))
        for name in names[:-RETAIN]:
            for bucket, batch in read(name) - kept:
                storage.delete_folder(self.spark, f"{self.folder}/data/batch={batch}/bucket={bucket}")
            storage.delete_folder(self.spark, f"{at}/{name}")
