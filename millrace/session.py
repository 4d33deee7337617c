"""Session helpers: configuration and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution does the runtime work (coalescing, skewed-join splitting,
    broadcast only below the size threshold); session windows pre-merge on the
    map side so a hot key is reduced before it is shuffled.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Local runs without the setting (tests) get a temporary folder; a cluster
    without it is refused, because executors could not read each other's files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder for a table written on the way."""
    return f"{checkpoint_root(spark)}/millrace/{purpose}-{uuid.uuid4().hex}"


#: Rows of a task that works hard on each of them.
SPREAD_ROWS = 100_000


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for hard work on so many rows: one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, rows // SPREAD_ROWS)


def spread(df: DataFrame) -> DataFrame:
    """Deal an input out to all cores, in tasks of a bounded number of rows, before heavy work on each row.

    Takes a table as read.  Splits alone say little: those of a file whose rows lie in
    few row groups are mostly empty.  So the rows of each split are counted, which takes
    file footers only, and an input that is dealt evenly already is left where it is.
    """
    splits = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    rows = sum(splits)
    wanted = task_count(df.sparkSession, rows)
    even = len(splits) >= wanted and max(splits) * len(splits) <= 2 * rows
    return df if even else df.repartition(wanted)


def spread_in_order(df: DataFrame, *order_by: str) -> DataFrame:
    """Deal an input out as ``spread`` does, but by ranges of columns, for work that is sorted by them afterwards.

    Takes a table as read.  A range sort reads its input twice; here that input is the
    table, and a later sort by the same columns moves no rows, so the work before it runs once.
    """
    return df.repartitionByRange(task_count(df.sparkSession, df.count()), *order_by)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions read many times.

    The optimizer otherwise copies an expression into every place that uses it,
    so a document would be parsed once per selection.  A one-element generator
    keeps the value: it is computed once per row and stays inside the JVM.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so later stages cannot see it change."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
