"""Loads: a target snapshot and incoming rows make a new snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import latest_per_key
from ..operators.joins import lookup_join, with_group_count
from ..session import cut_lineage
from .spec import TableSpec


def _matchable(keys: Sequence[str]):
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _shaped(df: DataFrame, target: DataFrame) -> DataFrame:
    """Incoming rows in the target's columns; columns they lack are null."""
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]
    )


def _single(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, one for each key; a key that repeats stops the job (counted on the map side)."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.lit(1).alias("__one"), *rest)
    one = df.groupBy(*keys).agg(F.any_value(row).alias("__row"), F.count("*").alias("__n"))
    message = F.concat_ws(" ", F.lit("several rows without an order for key"), *[F.col(k).cast("string") for k in keys])
    kind = one.schema["__row"].dataType
    checked = one.withColumn("__row", F.when(F.col("__n") > 1, F.raise_error(message).cast(kind)).otherwise(F.col("__row")))
    checked = checked.where(F.col("__row.__one") == 1)
    return checked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def insert(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(_shaped(source, target))


def reset(target: DataFrame, source: DataFrame) -> DataFrame:
    return _shaped(source, target)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    insert_new: bool = True,
    update_existing: bool = True,
    insert_only: Sequence[str] = (),
) -> DataFrame:
    """Rows matched on all keys take the incoming values, others are added.

    Null key parts match nothing: such rows go around the join, which also keeps
    a pile of them from landing in one task.  ``order_by`` picks the last of
    several incoming rows per key; without it a repeated key stops the load.  ``insert_only`` columns (creation stamps)
    are not overwritten on a match.
    """
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    whole = _matchable(keys)
    known = set(source.columns)
    lone, keyed = source.where(~whole), source.where(whole)
    keyed = latest_per_key(keyed, keys, order_by) if order_by else _single(keyed, keys)
    rest = [c for c in target.columns if c not in keys]
    new = _shaped(keyed, target).select(*keys, F.lit(True).alias("__new"), *[F.col(c).alias(f"__n_{c}") for c in rest])
    old = target.where(whole).withColumn("__old", F.lit(True))
    how = "full_outer" if insert_new else "left"
    both = old.join(new, list(keys), how)
    hit = F.col("__new").isNotNull()
    held = F.col("__old").isNotNull()

    def value(c: str):
        if c in insert_only or not update_existing or c not in known:
            take = hit & ~held
        else:
            take = hit
        return F.when(take, F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c)

    merged = both.select(*[F.col(c) if c in keys else value(c) for c in target.columns])
    out = merged.unionByName(target.where(~whole))
    if insert_new:
        out = out.unionByName(_shaped(lone, target))
    return out


def update(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Only rows the target already has change; other incoming rows are ignored."""
    return upsert(target, source, keys, order_by, insert_new=False)


def delete(target: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Remove rows by key; the id frame may carry nothing but the key."""
    if ids.columns != [key]:
        raise ValueError(f"a delete takes rows with only '{key}', got {ids.columns}")
    return target.join(ids, key, "left_anti")


def load(target: DataFrame, source: DataFrame, action: str, keys: Sequence[str] = (), order_by=None) -> DataFrame:
    if action == "insert":
        return insert(target, source)
    if action == "reset":
        return reset(target, source)
    if action == "upsert":
        return upsert(target, source, keys, order_by)
    if action == "update":
        return update(target, source, keys, order_by)
    raise ValueError(f"unknown load action: {action}")


def validate(
    df: DataFrame,
    spec: TableSpec,
    parents: dict[str, tuple[DataFrame, str]] | None = None,
    check_unique: bool = True,
) -> DataFrame:
    """Add ``error_msg`` (broken constraints, null if none) and ``warning_msg``.

    Not-null, length and enumeration checks are expressions of the row.  Unique
    columns use a skew-safe group count; foreign keys check each distinct value
    once.  Constraints that are not enforced only warn.
    """
    problems: list[tuple[str, bool]] = []
    checks = {}

    def add(condition, message: str, enforced: bool):
        name = f"__c{len(checks)}"
        checks[name] = F.when(condition, F.lit(message))
        problems.append((name, enforced))

    for c in spec.columns:
        if not c.nullable:
            add(F.col(c.name).isNull(), f"{c.name} is null", c.enforced)
        if c.max_length is not None and c.logical == "string":
            add(F.length(c.name) > c.max_length, f"{c.name} is longer than {c.max_length}", c.enforced)
        if c.enum_values:
            add(~F.col(c.name).isin(*c.enum_values), f"{c.name} is not an allowed value", c.enforced)
    out = df
    for c in spec.columns:
        if check_unique and c.unique:
            out = with_group_count(out, [c.name], f"__n_{c.name}")
            add((F.col(f"__n_{c.name}") > 1) & F.col(c.name).isNotNull(), f"{c.name} is repeated", c.enforced)
    for name, (parent, parent_key) in (parents or {}).items():
        held = parent.select(F.col(parent_key).alias(name))
        orphans = df.select(name).where(F.col(name).isNotNull()).distinct().join(held, name, "left_anti")
        out = lookup_join(out, orphans.withColumn(f"__o_{name}", F.lit(True)), [name])
        column = spec.column_map.get(name)
        add(F.col(f"__o_{name}"), f"{name} has no parent", column.enforced if column else True)
    out = out.withColumns(checks)

    def text(enforced: bool):
        parts = [n for n, e in problems if e == enforced]
        if not parts:
            return F.lit(None).cast("string")
        joined = F.concat_ws("; ", *parts)
        return F.when(joined != "", joined)

    return out.withColumns({"error_msg": text(True), "warning_msg": text(False)}).select(
        *df.columns, "error_msg", "warning_msg"
    )


def load_report(
    validated: DataFrame, batch: str, max_failures: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Successful, failed and unprocessed rows.

    A batch with more than ``max_failures`` failed rows is abandoned: its clean
    rows count as unprocessed.
    """
    validated = cut_lineage(validated)  # the checks run once for all three sets
    bad = F.col("error_msg").isNotNull()
    dead = (
        validated.groupBy(batch).agg(F.count_if(bad).alias("n")).where(F.col("n") > max_failures).select(batch)
    )
    clean = validated.where(~bad)
    return (
        clean.join(dead, batch, "left_anti"),
        validated.where(bad),
        clean.join(dead, batch, "left_semi"),
    )
