"""Delimited text: external tables with rejects, exports, folders of files, text columns."""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import MAX_TEXT_LENGTH
from ..functions.names import strip
from . import quoted

# Delimiters and line endings an export may use.
DELIMITERS = {"comma": ",", "tab": "\t", "semicolon": ";", "pipe": "|", "caret": "^", "backquote": "`"}
LINE_ENDINGS = {"LF": "\n", "CRLF": "\r\n"}


def read_delimited(
    spark: SparkSession, path: str | list[str], columns: dict[str, str],
    delimiter: str = ",", header: bool = True, date_mask: str = "yyyy-MM-dd", multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows with a reason).

    Columns are read as text, so a value that does not convert, or text longer
    than a column may hold, rejects its row instead of stopping the load.
    Missing trailing fields are null.  Quoted fields may hold line ends; files are
    read in blocks all the same (``quoted.records``).  ``multi_line=False`` saves the
    search for record borders where no field holds a line end.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = read_rows(spark, path, schema, delimiter, header, multi_line, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    typed: dict[str, Column] = {}
    reasons = []
    for name, kind in columns.items():
        text = F.when(strip(F.col(name)) != "", F.col(name))
        if kind == "string":
            typed[name] = text
            reasons.append(F.when(F.length(text) > MAX_TEXT_LENGTH, F.lit(f"{name} too long")))
            continue
        value = F.try_to_date(text, date_mask) if kind == "date" else strip(text).try_cast(kind)
        typed[name] = value
        reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"{name} is not {kind}")))
    reason = F.concat_ws("; ", *reasons)
    return (
        raw.where(reason == "").select(*[v.alias(n) for n, v in typed.items()]),
        raw.where(reason != "").withColumn("reject_reason", reason),
    )


def read_rows(
    spark: SparkSession, path: str | list[str], schema: T.StructType, delimiter: str = ",", header: bool = True, multi_line: bool = True, **options
) -> DataFrame:
    """The fields of every record by the given schema; a header record of each file is left out."""
    if not multi_line:
        return spark.read.schema(schema).csv(path, sep=delimiter, header=header, quote='"', escape='"', mode="PERMISSIVE", **options)
    records = quoted.records(spark, path)
    kept = records.where(~quoted.is_header()) if header else records
    return parse_records(kept, schema, delimiter, **options)


def parse_records(records: DataFrame, schema: T.StructType, delimiter: str, **options) -> DataFrame:
    """Columns of ``record``, one delimited record each; quoted fields may hold line ends."""
    wanted = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", **options}
    row = F.from_csv("record", _ddl(schema), {k: str(v) for k, v in wanted.items()})
    return records.select(row.alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def append_load(df: DataFrame, path: str, filler: Sequence[str] = ()) -> None:
    """Append rows to a table, leaving out columns that were read only to be skipped."""
    df.drop(*filler).write.mode("append").parquet(path)


def headers(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``header, files``: the first records that occur, quoted line ends included, and the files that begin with each."""
    firsts = quoted.records(spark, folder, pattern).where(quoted.is_header())
    return firsts.groupBy(F.col("record").alias("header")).agg(F.sort_array(F.collect_list("file")).alias("files"))


def load_all_csvs(
    spark: SparkSession, folder: str, pattern: str = "*.csv", delimiter: str = ",", infer: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Every matching file of a folder; the result has the union of all columns.

    Files are grouped by header, one row for each distinct one, so there is one scan
    per header and not one per file.  ``infer`` looks for the types of columns.
    """
    frames = []
    for row in headers(spark, folder, pattern).orderBy("header").collect():
        if infer or not multi_line:
            read = spark.read.csv(row["files"], sep=delimiter, header=True, inferSchema=infer, quote='"', escape='"', multiLine=multi_line)
        else:
            read = read_rows(spark, row["files"], _text_columns(row["header"], delimiter), delimiter)
        frames.append(read)
    if not frames:
        raise FileNotFoundError(f"no file in {folder} matches {pattern}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _text_columns(header: str, delimiter: str) -> T.StructType:
    """A text column for each field of a header record; nameless and repeated ones get their place."""
    found = next(csv.reader(io.StringIO(header, newline=""), delimiter=delimiter))
    names = [n if n and n not in found[:k] else f"{n}{k}" if n else f"_c{k}" for k, n in enumerate(found)]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def export_csv(
    df: DataFrame, path: str, delimiter: str = "comma", line_ending: str = "LF", mode: str = "overwrite"
) -> None:
    """Header, doubled quotes, quotes only where needed, null as empty."""
    df.write.mode(mode).csv(
        path, sep=DELIMITERS.get(delimiter, delimiter), lineSep=LINE_ENDINGS.get(line_ending, line_ending),
        header=True, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def parse_csv_column(df: DataFrame, column: str, wanted: Sequence[str], delimiter: str = ",") -> DataFrame:
    """Records of delimited text held in a column, one row each.

    The first record names the fields; fields may be quoted and then hold
    delimiters, line ends and doubled quotes; carriage returns are dropped;
    missing fields are empty text.  A quote that is never closed runs to the end of
    the text.
    """
    text = F.replace(F.col(column), F.lit("\r"), F.lit(""))
    d = "\\" + delimiter
    # possessive and without alternatives per character: long fields neither recurse nor go back
    record = r'(?:"[^"]*+(?:"|\z)|[^"\n]++)++'
    records = F.regexp_extract_all(text, F.lit(record), F.lit(0))
    field = rf'{d}("[^"]*+(?:""[^"]*+)*+|[^{d}]*+)'  # a quoted field without its closing quote

    def fields(line: Column) -> Column:
        parts = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(field), F.lit(1))

        def inner(p: Column) -> Column:
            held = F.substring(p.cast("binary"), 2, 2**31 - 1).cast("string")  # in bytes: no character is counted
            return F.replace(held, F.lit('""'), F.lit('"'))

        return F.transform(parts, lambda p: F.when(p.startswith('"'), inner(p)).otherwise(p))

    split = df.withColumn("__records", F.transform(records, fields))
    others = [c for c in df.columns if c != column]
    names = F.get("__records", F.lit(0))
    rows = split.select(
        *others, names.alias("__names"),
        F.posexplode(F.slice("__records", 2, F.greatest(F.size("__records") - 1, F.lit(0)))).alias("record_no", "__f"),
    )

    def value(name: str) -> Column:
        at = F.array_position("__names", name).cast("int")
        return F.coalesce(F.when(at > 0, F.get("__f", at - 1)), F.lit("")).alias(name)

    return rows.select(*others, (F.col("record_no") + 1).alias("record_no"), *[value(n) for n in wanted])
