"""Row filters, decoding and cleaning of whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    LEDGER_DATE,
    LEDGER_GAP,
    LEDGER_HEADER,
    LEDGER_MONEY,
    SKIPPED_ENDINGS,
    SKIPPED_OBJECTS,
)
from ..functions import cells
from ..functions.names import strip
from ..session import compute_once

INLINE_VALUES = 1000
UNIT = "\u001f"


def filter_isin(
    df: DataFrame, column: str, values: Sequence | DataFrame, exclude: bool = False
) -> DataFrame:
    """Rows whose value is (or is not) in a list.  Exclusion keeps nulls.

    A short list becomes a literal predicate that reaches the scan.  A long list
    or a one-column DataFrame becomes a semi or anti join.
    """
    if not isinstance(values, DataFrame):
        values = list(values)
        if len(values) <= INLINE_VALUES:
            hit = F.coalesce(F.col(column).isin(values), F.lit(False))
            return df.where(~hit if exclude else hit)
        kind = df.schema[column].dataType
        values = df.sparkSession.createDataFrame([(v,) for v in values], f"v {kind.simpleString()}")
    listed = values.toDF("__listed")
    how = "left_anti" if exclude else "left_semi"
    return df.join(listed, F.col(column) == F.col("__listed"), how)


def filter_equal(df: DataFrame, binds: dict) -> DataFrame:
    """Every bind must equal its column."""
    return df.where(reduce(and_, [F.col(c) == F.lit(v) for c, v in binds.items()]))


def decode(column: Column, labels: dict[str, str]) -> Column:
    """Code to label; unknown codes stay visible as ``UNKNOWN (code)``."""
    case = None
    for code, label in labels.items():
        case = F.when(column == code, label) if case is None else case.when(column == code, label)
    return case.otherwise(F.concat(F.lit("UNKNOWN ("), column, F.lit(")")))


def eligible_objects(
    catalog: DataFrame,
    skip_names: Sequence[str] = SKIPPED_OBJECTS,
    skip_endings: Sequence[str] = SKIPPED_ENDINGS,
) -> DataFrame:
    """Catalog objects worth migrating.

    Needs columns name, queryable, retrieveable, layoutable, searchable.
    """
    endings = "(" + "|".join(skip_endings) + ")$"
    return catalog.where(
        F.col("queryable")
        & F.col("retrieveable")
        & (F.col("layoutable") | F.col("searchable"))
        & ~F.col("name").rlike(endings)
        & ~F.col("name").isin(*skip_names)
    )


def normalise_cells(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.withColumns({c: cells.normalise_cell(F.col(c), k) for c, k in kinds.items()})


def unknown_fields(df: DataFrame, payload: str, known: Sequence[str], table: str) -> DataFrame:
    """Fields of a JSON object column that the table does not have, with row counts."""
    fields = df.select(F.explode(F.json_object_keys(payload)).alias("field"))
    return (
        fields.where(~F.col("field").isin(*known))
        .groupBy("field")
        .agg(F.count("*").alias("rows_with_field"))
        .select(F.lit(table).alias("table_name"), "field", "rows_with_field")
    )


def require_known_columns(df: DataFrame, known: Sequence[str], table: str) -> DataFrame:
    """The frame itself, or an error naming the first unknown column and the table."""
    for name in df.columns:
        if name not in known:
            raise ValueError(f"column '{name}' is not part of table '{table}'")
    return df


CAST_KINDS = {
    "int": "bigint",
    "integer": "bigint",
    "long": "bigint",
    "double": "double",
    "percent": "double",
    "currency": "string",
    "boolean": "boolean",
    "date": "date",
    "datetime": "timestamp",
    "time": "string",
}


def cast_record(df: DataFrame, field_types: dict[str, str]) -> DataFrame:
    """Cast text fields; the raw text of values that do not convert is kept aside.

    A column has one type, so a value that will not convert is null in the typed
    column and unchanged in ``<column>__raw``; ``cast_failures`` counts them.
    """
    typed, raw, bad = {}, {}, []
    for name, kind in field_types.items():
        text = F.when(F.col(name) != "", F.col(name))
        target = CAST_KINDS.get(kind, "string")
        if kind == "boolean":
            value = F.when(text.isNotNull(), F.lower(text) == "true")
        elif kind == "date":
            day = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2})", 1)
            value = F.when(text.isNotNull(), day.try_cast("date"))
        elif kind == "time":
            value = F.regexp_replace(text, "Z$", "")
        elif target == "bigint":
            number = text.try_cast("decimal(38,18)")  # holds every long as it is written
            value = F.when(number == F.floor(number), number.try_cast("bigint"))
        elif kind == "datetime":
            zoned = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
            value = zoned.try_cast("timestamp")
        else:
            value = text.try_cast(target)
        failed = text.isNotNull() & value.isNull()
        typed[name] = value
        raw[f"{name}__raw"] = F.when(failed, text)
        bad.append(failed.cast("int"))
    extra = {**raw, "cast_failures": reduce(lambda a, b: a + b, bad)}
    return df.withColumns({**typed, **extra})


def prepare_for_write(
    df: DataFrame, writable: Sequence[str], cleared: str | None = None, out: str = "record"
) -> DataFrame:
    """JSON record per row, ready to send: null fields absent, cleared fields null.

    ``cleared`` names an array column listing fields to set to null explicitly.
    Values are text: booleans true/false, dates ISO, nested values JSON.
    """
    entries = []
    for name in writable:
        kind = df.schema[name].dataType.simpleString()
        value = F.to_json(name) if kind.startswith(("struct", "array", "map")) else F.col(name).cast("string")
        wipe = F.array_contains(F.col(cleared), name) if cleared else F.lit(False)
        entries.append(
            F.struct(
                F.lit(name).alias("key"),
                F.when(~wipe, value).alias("value"),
                (wipe | F.col(name).isNotNull()).alias("keep"),
            )
        )
    kept = F.filter(F.array(*entries), lambda e: e["keep"])
    record = F.map_from_arrays(
        F.transform(kept, lambda e: e["key"]), F.transform(kept, lambda e: e["value"])
    )
    return df.withColumn(out, F.to_json(record))


def ledger_pattern() -> str:
    date, money, gap = f"({LEDGER_DATE})", f"({LEDGER_MONEY})", LEDGER_GAP
    parts = [date, money, date, "(.*?)", *[money] * 6]
    return r"^\s*" + gap.join(parts) + r"\s*$"


def _bare(value: Column) -> Column:
    return F.translate(value, " $,-", "").try_cast("decimal(38,2)")


def money_text(value: Column) -> Column:
    """``-$1,234.56`` style."""
    sign = F.when(value.startswith("-"), "-").otherwise("")
    return F.concat(sign, F.lit("$"), F.format_number(_bare(value), 2))


def parse_ledger_lines(df: DataFrame, line: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ten fields of each ledger line, and the lines that do not parse or hold an amount beyond 36 digits.

    One regular expression pass packs the groups with a unit separator and one
    split takes them apart.  Blank lines are skipped.  With ``strict`` the first
    bad line stops the job.
    """
    lines = df.where(~cells.is_blank(F.col(line)))
    packed = F.regexp_replace(
        F.col(line), ledger_pattern(), UNIT.join(f"${i}" for i in range(1, 11))
    )
    split = compute_once(lines, __f=F.split(packed, UNIT))
    money = [1, 4, 5, 6, 7, 8, 9]
    amounts = [_bare(F.get("__f", F.lit(i))).isNotNull() for i in money]  # written as text only in rows that are kept
    good = (F.size("__f") == 10) & reduce(lambda a, b: a & b, amounts)
    if strict:
        message = F.concat(F.lit("could not parse line: "), F.col(line))
        split = split.withColumn("__f", F.when(good, F.col("__f")).otherwise(F.raise_error(message)))
    names = [h.lower().replace(" ", "_") for h in LEDGER_HEADER]
    fields = {
        n: money_text(F.get("__f", F.lit(i))) if i in money else strip(F.get("__f", F.lit(i)))
        for i, n in enumerate(names)
    }
    parsed = split.where(good).withColumns(fields).drop("__f", line)
    rejects = split.where(~good).drop("__f")
    return parsed, rejects


def ledger_header(first_line: Column) -> Column:
    """Header fields of a file from its first line; the standard ones if not ten."""
    raw = F.regexp_replace(strip(first_line), "^﻿", "")
    by_tab = F.filter(F.transform(F.split(raw, "\t"), strip), lambda p: p != "")
    by_comma = F.transform(F.split(raw, ","), strip)
    by_gap = F.filter(F.transform(F.split(raw, r"\s{2,}"), strip), lambda p: p != "")
    parts = F.when(raw.contains("\t"), by_tab).when(raw.contains(","), by_comma).otherwise(by_gap)
    return F.when(F.size(parts) == 10, parts).otherwise(F.array(*[F.lit(h) for h in LEDGER_HEADER]))


def lookup_replace(column: Column, mapping: dict, default=None) -> Column:
    """Strict mapping of values; others become ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))


def add_audit_columns(df: DataFrame, user: str, at: Column, existing: bool = False) -> DataFrame:
    """Who wrote a row and when; an update leaves the creation columns alone."""
    stamps = {"updated_at": at, "updated_by": F.lit(user)}
    if not existing:
        stamps = {"created_at": at, "created_by": F.lit(user), **stamps}
    return df.withColumns(stamps)
