"""Aggregates that build one value from a group's rows, in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .numbering import number_rows


def _parts(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], part_rows: int | None) -> tuple[DataFrame, list[str]]:
    """The rows and the columns to group by: the keys, and ``part`` where slices are asked for.

    Rows are numbered globally by key and order, and a group is sliced by distance
    from its first number, so no task ever holds more of a group than a slice.
    """
    if part_rows is None:
        return df, [*keys]
    numbered = number_rows(df, [*keys, *order_by], "__row")
    firsts = cut_lineage(numbered.groupBy(*keys).agg(F.min("__row").alias("__first")))
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    joined = numbered.alias("l").join(firsts.alias("r"), on)
    part = F.floor((F.col("__row") - F.col("__first")) / part_rows).cast("bigint")
    return joined.select("l.*", part.alias("part")).drop("__row"), [*keys, "part"]


def _collected(value: Column, order_by: Sequence[str]) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(*order_by, value.alias("__v"))))
    return F.transform(rows, lambda r: r["__v"])


def ordered_list(
    df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[str], separator: str,
    name: str = "list", part_rows: int | None = None, count: str | None = None,
) -> DataFrame:
    """Text values of each group joined in order (nulls left out), one row per group.

    ``count`` names a column for the number of values.  With ``part_rows`` every
    group comes in slices of that many rows, told apart by ``part``; that is for
    groups that are too long for one value.
    """
    parted, by = _parts(df.where(F.col(value).isNotNull()), keys, order_by, part_rows)
    joined = F.array_join(_collected(F.col(value).cast("string"), order_by), separator)
    counted = [F.count("*").alias(count)] if count else []
    return parted.groupBy(*by).agg(joined.alias(name), *counted)


def json_array_agg(
    df: DataFrame, keys: Sequence[str], value: Column, order_by: Sequence[str],
    name: str = "items", null_on_null: bool = False, part_rows: int | None = None,
) -> DataFrame:
    """JSON array of each group's values in order; nulls absent unless asked for.

    One row per group, or slices of ``part_rows`` rows (see ``ordered_list``).
    """
    rows = df.select(*keys, *[c for c in order_by if c not in keys], value.alias("__value"))
    if not null_on_null:
        rows = rows.where(F.col("__value").isNotNull())
    parted, by = _parts(rows, keys, order_by, part_rows)
    return parted.groupBy(*by).agg(
        F.to_json(_collected(F.col("__value"), order_by), {"ignoreNullFields": "false"}).alias(name)
    )


def json_object_agg(
    df: DataFrame, keys: Sequence[str], key: str, value: str, name: str = "object",
    unique_keys: bool = False, absent_on_null: bool = False, part_rows: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """JSON object of each group, members sorted by name.

    Of a repeated name the last value by ``order_by`` stays (the greatest one
    without an order), or with ``unique_keys`` the job stops.  Members are
    reduced to one row per name before they are collected.
    """
    rows = df.where(F.col(value).isNotNull()) if absent_on_null else df
    last = F.max_by(value, F.struct(*order_by, value)) if order_by else F.max(value)
    members = rows.groupBy(*keys, key).agg(last.alias("__v"), F.count("*").alias("__n"))
    if unique_keys:
        message = F.concat(F.lit("repeated key: "), F.col(key).cast("string"))
        stop = F.raise_error(message).cast(df.schema[value].dataType)
        members = members.withColumn("__v", F.when(F.col("__n") > 1, stop).otherwise(F.col("__v")))
    parted, by = _parts(members.drop("__n"), keys, [key], part_rows)
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col("__v").alias("v"))))
    return parted.groupBy(*by).agg(
        F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}).alias(name)
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key.

    A maximum over (order, row) combines on the map side, so a key with a third
    of the rows is reduced before the shuffle; no window sort is needed.  The
    keys come out as grouping columns, so a later filter on them goes below the
    aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_by)).alias("__row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
