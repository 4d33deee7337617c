"""Line-wise work on text columns.

A document's lines live in its own row, so all of this happens inside the row:
nothing is shuffled, however long or numerous the documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search_lines(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """Matching lines with their document and 1-based line number."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("i", "line"))
    return lines.where(F.col("line").rlike(pattern)).select(key, (F.col("i") + 1).alias("line_no"), "line")


def matching_documents(df: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    return df.where(F.exists(F.split(text, "\n"), lambda l: l.rlike(pattern))).agg(
        F.count("*").alias("documents")
    )


def count_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Line ends per document."""
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return df.select(key, ends.cast("bigint").alias("line_count"))


def replace_text(df: DataFrame, text: str, find: str, replacement: str) -> DataFrame:
    """Rewrite matching documents; the original stays in ``<text>_before``."""
    changed = F.col(text).rlike(find)
    return df.withColumns(
        {
            "changed": changed,
            f"{text}_before": F.when(changed, F.col(text)),
            text: F.when(changed, F.regexp_replace(text, find, replacement)).otherwise(F.col(text)),
        }
    )


def context_lines(df: DataFrame, key: str, text: str, pattern: str, around: int) -> DataFrame:
    """Lines within ``around`` of a match, each once, with a flag for the match itself."""
    split = df.select(key, F.split(text, "\n").alias("lines"))
    hits = F.filter(
        F.transform(F.col("lines"), lambda l, i: F.when(l.rlike(pattern), i)), lambda i: i.isNotNull()
    )
    found = split.withColumn("hits", hits).where(F.size("hits") > 0)
    last = F.size("lines") - 1
    near = F.flatten(
        F.transform(
            "hits",
            lambda h: F.sequence(F.greatest(h - around, F.lit(0)), F.least(h + around, last)),
        )
    )
    rows = found.select(key, "lines", F.explode(F.array_distinct(near)).alias("i"))
    line = F.get("lines", F.col("i"))
    return rows.select(key, (F.col("i") + 1).alias("line_no"), line.alias("line"), line.rlike(pattern).alias("is_match"))


def lines_between(df: DataFrame, key: str, text: str, start: str, end: str) -> DataFrame:
    """Lines from a start line to the next end line inclusive, range after range.

    A range without an end line runs to the end of the document; the end is
    looked for from the line after the start.  One pattern finds all ranges.
    """
    opening = f"^[^\\n]*(?:{start})[^\\n]*$"
    closing = f"\\n[^\\n]*(?:{end})[^\\n]*$"
    pattern = f"(?m){opening}(?:[\\s\\S]*?{closing}|[\\s\\S]*)"
    ranges = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = df.select(key, F.posexplode(ranges).alias("r", "block"))
    rows = found.select(key, (F.col("r") + 1).alias("range_no"), F.posexplode(F.split("block", "\n")).alias("i", "line"))
    return rows.select(key, "range_no", (F.col("i") + 1).alias("line_in_range"), "line")


def split_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """Paragraphs separated by blank lines; outer blank lines do not count."""
    trimmed = F.regexp_replace(F.regexp_replace(text, r"^(?:[^\S\n]*\n)+", ""), r"(?:\n[^\S\n]*)+$", "")
    blocks = F.filter(F.split(trimmed, r"\n(?:[^\S\n]*\n)+"), lambda b: ~b.rlike(r"^\s*$"))
    return df.select(key, F.posexplode(blocks).alias("i", "block")).select(
        key, (F.col("i") + 1).alias("block_no"), "block"
    )


def split_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """Runs that start at an unindented line and reach to the next one."""
    sections = F.split(text, r"\n(?=\S)")
    return df.select(key, F.posexplode(sections).alias("i", "section")).select(
        key, (F.col("i") + 1).alias("section_no"), "section"
    )


def live_lines(stream: DataFrame, column: str, pattern: str) -> DataFrame:
    """Keep matching lines of a (streaming) text source."""
    return stream.where(F.col(column).rlike(pattern))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")
