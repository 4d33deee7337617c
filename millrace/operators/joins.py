"""Joins that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_SHARE = 1000
COMBINATIONS_PER_TASK = 1_000_000


def equi_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner"
) -> DataFrame:
    """Join on differently named keys and drop the right-hand copies."""
    on = reduce(and_, [left[a] == right[b] for a, b in pairs])
    joined = left.join(right, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[right[b] for _, b in pairs])


HOWS = ("inner", "left", "right", "outer")


def all_join_row_counts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``how, rows_before, rows_after, change`` for every kind of join, without producing joined rows.

    Both sides shrink to a count per key once; null keys never match.
    """
    a = left.groupBy(*on).agg(F.count("*").alias("__a"))
    b = right.groupBy(*on).agg(F.count("*").alias("__b"))
    both = a.join(b, list(on), "full_outer")
    n, m = F.coalesce("__a", F.lit(0)), F.coalesce("__b", F.lit(0))
    rows = {
        "inner": n * m,
        "left": n * F.greatest(m, F.lit(1)),
        "right": F.greatest(n, F.lit(1)) * m,
        "outer": F.when(n * m > 0, n * m).otherwise(n + m),
    }
    sums = both.agg(
        F.coalesce(F.sum("__a"), F.lit(0)).alias("rows_before"), *[F.coalesce(F.sum(rows[how]), F.lit(0)).alias(how) for how in HOWS]
    )
    each = F.inline(F.array(*[F.struct(F.lit(how).alias("how"), F.col(how).alias("rows_after")) for how in HOWS]))
    return sums.select("rows_before", each).select("how", "rows_before", "rows_after", (F.col("rows_after") - F.col("rows_before")).alias("change"))


def join_row_counts(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Rows before and after a join, without producing the joined rows."""
    return all_join_row_counts(left, right, on).where(F.col("how") == how).drop("how")


def safe_merge(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> tuple[DataFrame, DataFrame]:
    """The merged rows and a one-row report of how the row count moved."""
    return left.join(right, list(on), how), join_row_counts(left, right, on, how)


def observed_merge(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The merged rows, and a function that says how the row count moved once they have been written.

    Both counts are taken while the join runs, so nothing is read for them; the
    function waits for the first job that uses all merged rows.
    """
    before, after = Observation(), Observation()
    counted = left.observe(before, F.count(F.lit(1)).alias("rows"))
    merged = counted.join(right, list(on), how).observe(after, F.count(F.lit(1)).alias("rows"))

    def report() -> dict[str, int]:
        n, m = before.get.get("rows", 0), after.get.get("rows", 0)
        return {"rows_before": n, "rows_after": m, "change": m - n}

    return merged, report


def _split_lookup(df: DataFrame, keys: Sequence[str], hot: DataFrame, cold: DataFrame, how: str) -> DataFrame:
    """Look rows up by key: a bounded broadcast for hot keys, a plain join for the rest.

    ``hot`` and ``cold`` hold one row per key, the keys renamed ``__k0``...; rows
    of hot keys never move and no remaining key is heavy.  Null keys match nulls.
    """
    renamed = [f"__k{i}" for i in range(len(keys))]
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)])
    found = [c for c in cold.columns if c not in renamed]
    first = df.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), same, "left")
    done = first.where("__hot").drop("__hot", *renamed)
    rest = first.where("__hot is null").drop("__hot", *renamed, *found)
    return done.unionByName(rest.join(cold, same, how).drop(*renamed))


def with_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Attach the size of each row's group (null keys form a group too).

    A window would gather a whole group in one task.  Here groups are counted
    with map-side partial counts.  Keys above 1/1000 of all rows number at most
    1000, so their counts are broadcast and their rows never move; the rest is an
    ordinary join in which no key is heavy.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    total = counts.agg(F.sum(name)).scalar()
    heavy = F.col(name) * HOT_SHARE > total
    side = counts.toDF(*[f"__k{i}" for i in range(len(keys))], name)
    return _split_lookup(df, keys, side.where(heavy), side.where(~heavy), "inner")


def lookup_join(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a table that holds each key once, whatever the skew of ``df``.

    Only table rows of keys above 1/1000 of all rows are broadcast, at most 1000.
    """
    renamed = [f"__k{i}" for i in range(len(keys))]
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    heavy = counts.where(F.col("__n") * HOT_SHARE > total).drop("__n").toDF(*renamed)
    side = table.withColumnsRenamed(dict(zip(keys, renamed)))
    return _split_lookup(df, keys, heavy.join(side, renamed, "left"), side, "left")


def not_in_history(df: DataFrame, column: str, history: DataFrame, seen: str) -> DataFrame:
    """Rows whose value, whatever its case, is not in the history."""
    past = history.select(F.lower(seen).alias("__seen"))
    return df.join(past, F.lower(column) == F.col("__seen"), "left_anti")


def word_patterns(word_lists: dict[str, DataFrame], patterns: Sequence[Sequence[str]], suffix: str) -> DataFrame:
    """Every concatenation of one word from each list of a pattern, de-duplicated.

    The size of the result is the product of the list sizes.  Combination
    numbers are generated in parallel and each position looks its word up by
    number with an equi-join, so no side is replicated against another.
    """
    from .numbering import number_rows

    numbered, sizes = {}, {}
    for name in {n for p in patterns for n in p}:
        words = word_lists[name].toDF("word").select(F.lower("word").alias("word")).distinct()
        numbered[name] = number_rows(words, ["word"], "no", start=0)
        sizes[name] = numbered[name].count()
    outputs = []
    for pattern in patterns:
        total = 1
        for name in pattern:
            total *= sizes[name]
        spark = numbered[pattern[0]].sparkSession
        slots = max(spark.sparkContext.defaultParallelism, total // COMBINATIONS_PER_TASK + 1)
        combos = spark.range(0, total, 1, slots).withColumn("text", F.lit(""))
        block = total
        for name in pattern:
            block //= max(sizes[name], 1)
            position = F.pmod(F.floor(F.col("id") / F.lit(max(block, 1))), F.lit(max(sizes[name], 1)))
            combos = (
                combos.withColumn("no", position.cast("bigint"))
                .join(numbered[name], "no")
                .select("id", F.concat("text", "word").alias("text"))
            )
        outputs.append(combos.select("text"))
    every = reduce(lambda a, b: a.unionByName(b), outputs)
    return every.distinct().select(F.concat("text", F.lit(suffix)).alias("candidate"))


def _leaves(schema: T.StructType, path: str = "") -> list[str]:
    names = []
    for field in schema.fields:
        here = f"{path}.{field.name}" if path else field.name
        if isinstance(field.dataType, T.StructType):
            names += _leaves(field.dataType, here)
        else:
            names.append(here)
    return names


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per changed field (nested fields by dotted path) of two snapshots.

    Keys on either side are covered; a side that lacks the key reads as null.
    """
    fields = sorted(set(_leaves(old.schema)) | set(_leaves(new.schema)))
    fields = [f for f in fields if f not in keys]
    had, has = set(_leaves(old.schema)), set(_leaves(new.schema))
    a = old.select(F.struct(*keys).alias("__key"), F.struct(*old.columns).alias("o"))
    b = new.select(F.struct(*keys).alias("__key"), F.struct(*new.columns).alias("n"))
    both = a.join(b, "__key", "full_outer")

    def text(side: str, name: str, present: set) -> Column:
        return F.col(f"{side}.{name}").cast("string") if name in present else F.lit(None).cast("string")

    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed")
    cells = []
    for f in fields:
        before, after = text("o", f, had), text("n", f, has)
        differs = ~before.eqNullSafe(after)
        if f in had and f in has:
            differs = ~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}"))
        cells.append(
            F.struct(
                F.lit(f).alias("field"), before.alias("old_value"), after.alias("new_value"), differs.alias("d")
            )
        )
    changed = F.filter(F.array(*cells), lambda c: c["d"])
    return both.select("__key", change.alias("change"), F.inline(changed)).select(
        *[F.col(f"__key.{k}").alias(k) for k in keys], "change", "field", "old_value", "new_value"
    )
