"""JSON lines, parquet, batches, folders as tables, JSON records, schema notes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .delimited import load_all_csvs, read_rows


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Newline-delimited JSON; give a schema to spare the pass that infers one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def read_fast(spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True) -> DataFrame:
    """Typed CSV with a header; types are inferred only when no schema is given.

    With a schema, files are read in blocks also where quoted fields hold line ends;
    to infer types from such files Spark reads each in one task, unless
    ``multi_line=False`` says that no field holds one.
    """
    if schema and multi_line:
        return read_rows(spark, path, T.StructType.fromDDL(schema))
    reader = spark.read.schema(schema) if schema else spark.read.option("inferSchema", True)
    return reader.csv(path, header=True, quote='"', escape='"', multiLine=multi_line)


def read_table(
    spark: SparkSession, source: str, columns: Sequence[str] = (), binds: dict | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """Listed columns of a table under equality binds.

    ``source`` is a parquet path, a catalog table, or with ``jdbc`` options a
    database table; projection and filter are pushed into each of them.
    """
    if jdbc:
        frame = spark.read.format("jdbc").options(dbtable=source, fetchsize="10000", **jdbc).load()
    elif "/" in source:
        frame = spark.read.parquet(source)
    else:
        frame = spark.table(source)
    for name, value in (binds or {}).items():
        frame = frame.where(F.col(name) == F.lit(value))
    return frame.select(*columns) if columns else frame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def convert_dir_to_parquet(spark: SparkSession, folder: str, out: str, pattern: str = "*.csv") -> None:
    write_parquet(load_all_csvs(spark, folder, pattern, infer=True), out)


def write_batches(df: DataFrame, path: str, size: int) -> None:
    """Files of at most ``size`` rows each."""
    df.write.mode("overwrite").option("maxRecordsPerFile", size).parquet(path)


#: Files that a task may have open at once; beyond them it sorts its rows by folder.
OPEN_FILES = 64


def write_folders(df: DataFrame, path: str, column: str) -> None:
    """A folder with one text file for each value of ``column``.

    A task keeps the files of its folders open side by side, so the rows that it
    gets are written as they come: it neither sorts nor holds them.
    """
    conf = df.sparkSession.conf
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(setting, None)
    conf.set(setting, str(OPEN_FILES))
    try:
        df.repartition(column).write.partitionBy(column).text(path)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)


def append_submission(df: DataFrame, path: str) -> None:
    """Append form rows, each under a generated id."""
    df.withColumn("id", F.expr("uuid()")).write.mode("append").parquet(path)


def read_files_as_rows(
    spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True,
    larger_than: int | None = None, modified_after: str | None = None,
) -> DataFrame:
    """Name, extension, size and time of each file; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    name = F.substring_index("path", "/", -1)
    rows = reader.load(folder).select(
        "path",
        name.alias("name"),
        F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    return rows if larger_than is None else rows.where(F.col("size") > larger_than)


def rows_to_json(df: DataFrame, columns: Sequence[str], as_text: Sequence[str] = ()) -> Column:
    """JSON record with a fixed column order; columns the frame lacks are null.

    Dates are ISO, binary is base64, ``as_text`` columns (big integers) are
    quoted.
    """
    def cell(name: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("string").alias(name)
        value = F.col(name)
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.regexp_replace(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")
        if name in as_text:
            value = value.cast("string")
        return value.alias(name)

    return F.to_json(F.struct(*[cell(c) for c in columns]), {"ignoreNullFields": "false"})


def write_json_array(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """One JSON record per line in a fixed column order."""
    df.select(rows_to_json(df, columns).alias("value")).write.mode("overwrite").text(path)


CONTEXT = "load_context"


def attach_schema_metadata(df: DataFrame, context: dict) -> DataFrame:
    """Note where the data came from on its first column; the note survives parquet."""
    first = df.columns[0]
    return df.withMetadata(first, {**df.schema[first].metadata, CONTEXT: json.dumps(context, sort_keys=True)})


def schema_metadata(df: DataFrame) -> dict | None:
    for field in df.schema.fields:
        if CONTEXT in field.metadata:
            return json.loads(field.metadata[CONTEXT])
    return None
