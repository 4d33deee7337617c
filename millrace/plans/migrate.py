"""Moving tables from one system to another, and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import canonical_names, cross_system_name, rename_to_target
from ..sources import publish
from . import load
from .spec import spec_of

REPORT = "table_name string, target_name string, status string, action string, added_columns string"


def migrate(
    spark: SparkSession,
    source: Mapping[str, str],
    target_base: str,
    stamp: str,
    tables: Sequence[str] = ("*",),
    action: str = "reset",
    keys: Mapping[str, Sequence[str]] | None = None,
    order_by: Mapping[str, Sequence[str]] | None = None,
    source_system: str = "crm",
    target_system: str = "relational",
) -> DataFrame:
    """Load each named table into the target folder and report on all of them.

    ``source`` maps table names to parquet paths.  Each table is one plan: read,
    rename to the target's names, load, publish as a new version.  A table that
    cannot be read is skipped and listed; any other error stops the run.  Columns
    the target lacks are added to it, empty in the rows it has, and reported.
    ``order_by`` (in the target's names) picks the last of several rows per key.
    """
    names = list(source) if list(tables) == ["*"] else list(tables)
    named = spark.createDataFrame([(n,) for n in names], "name string")
    targets = {
        r[0]: r[1]
        for r in named.select("name", cross_system_name(F.col("name"), source_system, target_system)).collect()
    }
    report = []
    counts: DataFrame | None = None
    for name in names:
        goal = targets[name]
        try:
            incoming = spark.read.parquet(source[name])
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            report.append((name, goal, "skipped", action, ""))
            continue
        held = publish.current(spark, target_base, goal)
        columns = held.columns if held is not None else list(canonical_names(spark, incoming.columns).values())
        renamed = rename_to_target(incoming, columns)
        added: list[str] = []
        if held is None:
            loaded = spec_of(renamed, goal).apply(renamed)
        else:
            fresh = [c for c in renamed.columns if c not in held.columns]
            spelled = canonical_names(spark, fresh) if fresh else {}
            renamed = renamed.withColumnsRenamed(spelled)
            added = list(spelled.values())
            held = held.withColumns({c: F.lit(None).cast(renamed.schema[c].dataType) for c in added})
            loaded = load.load(held, renamed, action, (keys or {}).get(name, ()), (order_by or {}).get(name))
        publish.publish_version(loaded, target_base, goal, stamp)
        report.append((name, goal, "migrated", action, ",".join(added)))
        written = publish.current(spark, target_base, goal).agg(F.count("*").alias("row_count"))
        row = written.select(F.lit(name).alias("table_name"), "row_count")
        counts = row if counts is None else counts.unionByName(row)
    lines = spark.createDataFrame(report, REPORT)
    if counts is None:
        return lines.withColumn("row_count", F.lit(None).cast("bigint"))
    return lines.join(counts, "table_name", "left")


class RunLog:
    """Messages of one run, appended as they happen so they outlive a failed step."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, enabled: bool = True):
        self.spark, self.path, self.run_id, self.enabled = spark, path, run_id, enabled

    def write(self, source: str, message: str, payload: str | None = None) -> None:
        if not self.enabled:
            return
        row = self.spark.createDataFrame(
            [(self.run_id, source, message, payload)],
            "run_id string, source string, message string, payload string",
        )
        row.coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)
