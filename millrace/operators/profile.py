"""Column profiles: counts, shares, ranges, types.  Each report is one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A numeric column is narrowed only when its extremes lie strictly
# inside the range of the smaller type.
INTEGER_STEPS = (
    ("tinyint", -128, 127),
    ("smallint", -32768, 32767),
    ("int", -2147483648, 2147483647),
)
FLOAT32_MAX = 3.4028234663852886e38


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each non-null value.

    The grand total is a scalar subquery over the grouped rows, so no single
    task sees all groups and nothing is cross joined.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        column, "count", (F.col("count") / total * F.lit(100.0)).alias("percentage")
    )


def _long(wide: DataFrame, names: Sequence[str], fields) -> DataFrame:
    """Turn a one-row wide aggregate into one row per column name."""
    rows = [F.struct(F.lit(n).alias("column_name"), *fields(n)) for n in names]
    return wide.select(F.inline(F.array(*rows)))


def missing_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage of rows per column, most missing first."""
    names = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(n).isNull()).alias(f"__nulls_{i}") for i, n in enumerate(names)],
    )
    at = {n: F.col(f"__nulls_{i}") for i, n in enumerate(names)}
    report = _long(
        wide,
        names,
        lambda n: [
            at[n].alias("missing_count"),
            (at[n] / F.when(F.col("__rows") > 0, F.col("__rows")) * F.lit(100.0)).alias("percentage"),
        ],
    )
    return report.orderBy(F.desc("percentage"), "column_name")


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("null_count"))


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and extent of numeric columns."""
    wide = df.agg(
        *[F.min(F.col(n).cast("double")).alias(f"__min_{i}") for i, n in enumerate(columns)],
        *[F.max(F.col(n).cast("double")).alias(f"__max_{i}") for i, n in enumerate(columns)],
    )
    at = {n: (F.col(f"__min_{i}"), F.col(f"__max_{i}")) for i, n in enumerate(columns)}
    return _long(
        wide,
        list(columns),
        lambda n: [
            at[n][0].alias("min_value"),
            at[n][1].alias("max_value"),
            (at[n][1] - at[n][0]).alias("extent"),
        ],
    )


def flag_extrema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mark the rows holding a column's smallest or largest value."""
    bounds = df.agg(F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]))
    bound = bounds.scalar()
    flagged = {}
    for c in columns:
        flagged[f"{c}_is_min"] = F.col(c) == bound[c]["lo"]
        flagged[f"{c}_is_max"] = F.col(c) == bound[c]["hi"]
    return df.withColumns(flagged)


def narrowing_report(df: DataFrame) -> DataFrame:
    """For each numeric column: its extremes and the smallest type that holds them."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    wide = df.agg(
        *[F.min(f.name).alias(f"__min_{f.name}") for f in fields],
        *[F.max(f.name).alias(f"__max_{f.name}") for f in fields],
    )

    def row(name: str):
        field = df.schema[name]
        low, high = F.col(f"__min_{name}"), F.col(f"__max_{name}")
        if isinstance(field.dataType, T.IntegralType):
            chosen = F.coalesce(
                *[
                    F.when((low > lo) & (high < hi), F.lit(kind))
                    for kind, lo, hi in INTEGER_STEPS
                ],
                F.lit(field.dataType.simpleString()),
            )
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            chosen = F.when(
                (low > -FLOAT32_MAX) & (high < FLOAT32_MAX), F.lit("float")
            ).otherwise(F.lit(field.dataType.simpleString()))
        else:
            chosen = F.lit(field.dataType.simpleString())
        return [
            F.lit(field.dataType.simpleString()).alias("old_type"),
            chosen.alias("new_type"),
            low.cast("double").alias("min_value"),
            high.cast("double").alias("max_value"),
        ]

    return _long(wide, [f.name for f in fields], row)


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the type chosen by :func:`narrowing_report`.

    The report has one row per column, so collecting it is bounded by the schema.
    """
    chosen = {r["column_name"]: r["new_type"] for r in narrowing_report(df).collect()}
    return df.select(*[F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns])


def _split_types(text: str, separator: str) -> list[str]:
    """Parts of a type expression at its outermost level."""
    parts, depth = [""], 0
    for c in text:
        depth += (c in "<(") - (c in ">)")
        if c == separator and depth == 0:
            parts.append("")
        else:
            parts[-1] += c
    return [p.strip() for p in parts]


def _mismatch(value: Column, kind: str) -> Column:
    """Whether a text that is not null is no value of ``kind``.

    ``a | b`` is either; ``array<t>`` a JSON array or a comma separated list;
    ``map<string,t>`` a JSON object; ``tuple<a, b>`` a JSON array of just these.
    They nest.
    """
    either = _split_types(kind, "|")
    if len(either) > 1:
        return reduce(and_, [_mismatch(value, k) for k in either])
    outer, _, inner = kind.partition("<")
    inner = inner[:-1]
    if outer == "array":
        items = F.when(value.startswith("["), F.from_json(value, "array<string>")).otherwise(F.split(value, ","))
        return items.isNull() | F.exists(items, lambda x: x.isNull() | _mismatch(F.trim(x), inner))
    if outer == "map":
        member = _split_types(inner, ",")[1]
        items = F.from_json(value, "map<string,string>")
        return items.isNull() | F.exists(F.map_values(items), lambda x: x.isNull() | _mismatch(x, member))
    if outer == "tuple":
        kinds = _split_types(inner, ",")
        items = F.from_json(value, "array<string>")
        wrong = [F.get(items, F.lit(i)).isNull() | _mismatch(F.get(items, F.lit(i)), k) for i, k in enumerate(kinds)]
        return items.isNull() | (F.size(items) != len(kinds)) | reduce(or_, wrong)
    return value.try_cast(kind).isNull()


def conform_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Values that do not convert to the expected type, per column.

    ``expected`` maps a text column to a Spark type name or to a nested type
    (``array``, ``map``, ``tuple``, alternatives with ``|``); nulls conform.
    """
    checks = {n: F.col(n).isNotNull() & F.coalesce(_mismatch(F.col(n), k), F.lit(True)) for n, k in expected.items()}
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(c).alias(f"__bad_{n}") for n, c in checks.items()],
    )
    return _long(
        wide,
        list(expected),
        lambda n: [
            F.lit(expected[n]).alias("expected_type"),
            F.col("__rows").alias("checked"),
            F.col(f"__bad_{n}").alias("mismatched"),
            (F.col(f"__bad_{n}") == 0).alias("conforms"),
        ],
    )


def member_types(df: DataFrame, column: str) -> DataFrame:
    """Types and sizes of the members of a JSON object column."""
    members = df.select(F.explode(F.from_json(column, "map<string,variant>")).alias("member", "value"))
    return (
        members.select(
            "member",
            F.schema_of_variant("value").alias("value_type"),
            F.length(F.to_json("value")).alias("size"),
        )
        .groupBy("member", "value_type")
        .agg(
            F.count("*").alias("occurrences"),
            F.min("size").alias("min_size"),
            F.max("size").alias("max_size"),
        )
    )


def describe_declared(spark: SparkSession, spec) -> DataFrame:
    """What a table specification declares of each column: keys, references, nullability, defaults, limits."""
    rows = [
        (
            spec.name, c.name, i, c.logical, c.primary_key, c.indexed or c.unique or c.primary_key, c.nullable and not c.primary_key,
            c.references, c.default, c.max_length, list(c.enum_values) or None,
        )
        for i, c in enumerate(spec.columns, 1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, column_name string, column_id int, logical_type string, primary_key boolean, indexed boolean, "
        "nullable boolean, foreign_key string, default_value string, max_length int, allowed array<string>",
    )


def describe_frame(
    df: DataFrame, table: str, primary_key: Sequence[str] = ()
) -> DataFrame:
    """Columns of a table joined with what one pass over the data shows."""
    names = df.columns
    keys = list(primary_key)
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(n).isNull()).alias(f"__nulls_{n}") for n in names],
    )
    if keys:
        # Uniqueness by counting rows per key: partial counts shrink before the shuffle.
        repeated = (
            df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*")).scalar()
        )
        unique = repeated == 0
    else:
        unique = F.lit(None).cast("boolean")
    return _long(
        wide,
        names,
        lambda n: [
            F.lit(table).alias("table_name"),
            F.lit(names.index(n) + 1).alias("column_id"),
            F.lit(df.schema[n].dataType.simpleString()).alias("data_type"),
            F.lit(n in keys).alias("primary_key"),
            F.col("__rows").alias("row_count"),
            F.col(f"__nulls_{n}").alias("null_count"),
            (unique if n in keys else F.lit(None).cast("boolean")).alias("key_is_unique"),
        ],
    )


def expect_count(df: DataFrame, condition: Column, expected: int, label: str) -> DataFrame:
    """One expectation row: how many rows met ``condition`` and whether that was right."""
    return df.agg(F.count_if(condition).alias("observed")).select(
        F.lit(label).alias("expectation"),
        "observed",
        F.lit(expected).cast("bigint").alias("expected"),
        F.when(F.col("observed") == expected, "SUCCESS").otherwise("FAIL").alias("outcome"),
    )
