"""Identifier rules as column expressions, plus their use on a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import RESERVED_WORDS


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))


def canonical_snake(
    name: Column,
    max_len: int = 128,
    reserved: Sequence[str] = RESERVED_WORDS,
    forced_prefix: str | None = None,
    suffix: str = "COL",
) -> Column:
    """Upper snake case that leaves its own output unchanged.

    Borders between cases and between letters and digits become underscores,
    other characters too; a leading digit, a reserved word and an over-long
    result are repaired.
    """
    word = strip(name)
    for border in ("([a-z0-9])([A-Z])", "([A-Za-z])([0-9])", "([0-9])([A-Za-z])"):
        word = F.regexp_replace(word, border, "$1_$2")
    word = F.regexp_replace(word, "[^A-Za-z0-9_]+", "_")
    word = F.upper(F.regexp_replace(word, "^_+|_+$", ""))
    # Each repair is one replacement on the word, so the expression stays linear in size.
    front = f"{forced_prefix or 'C'}_"
    any_reserved = "^(" + "|".join(reserved) + ")$"
    repairs = [
        ("^$", suffix),
        ("^([0-9])", f"{front}$1"),
        (any_reserved, f"{forced_prefix}_$1" if forced_prefix else f"$1_{suffix}"),
    ]
    too_long = f"^(?=.{{{max_len + 1}}})"
    if forced_prefix:
        repairs.append((f"{too_long}{forced_prefix}(.{{0,{max_len - len(forced_prefix)}}}).*$", "$1"))
    repairs += [
        (f"{too_long}(.{{{max_len - len(suffix) - 1}}}).*_{suffix}$", "$1\u0001"),
        ("_*\u0001$", f"_{suffix}"),
        (f"^(.{{{max_len}}}).+$", "$1"),
        ("_+$", ""),
        ("^$", suffix),
    ]
    for pattern, replacement in repairs:
        word = F.regexp_replace(word, pattern, replacement)
    return word


def name_collisions(names: DataFrame, column: str) -> DataFrame:
    """Canonical names that more than one distinct identifier maps to."""
    return (
        names.select(column)
        .distinct()
        .groupBy(canonical_snake(F.col(column)).alias("canonical"))
        .agg(F.count("*").alias("identifiers"))
        .where("identifiers > 1")
    )


def cross_system_name(name: Column, source: str, target: str) -> Column:
    """Name of a table on the other side; ``crm`` and ``relational`` systems.

    A name that already carries the target's own mark goes home without it.
    """
    if source == target:
        return name
    if (source, target) == ("crm", "relational"):
        home = F.regexp_replace(name, "(?i)^ora_", "")
        home = F.regexp_replace(home, "(?i)__c$", "")
        return F.when(F.lower(name).startswith("ora_"), canonical_snake(home)).otherwise(
            F.concat(F.lit("SF_"), canonical_snake(name))
        )
    if (source, target) == ("relational", "crm"):
        return F.when(F.upper(name).startswith("SF_"), F.substr(name, F.lit(4))).otherwise(
            F.concat(F.lit("ora_"), F.lower(name), F.lit("__c"))
        )
    raise ValueError(f"unknown pair of systems: {source}, {target}")


def canonical_names(spark: SparkSession, names: Sequence[str]) -> dict[str, str]:
    """Canonical form of schema names; one row per column name, so always small."""
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    return {r[0]: r[1] for r in frame.select("name", canonical_snake(F.col("name"))).collect()}


def rename_to_target(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Give columns the target's spelling where canonical names agree."""
    canon = canonical_names(df.sparkSession, [*df.columns, *target_columns])
    wanted = {canon[t]: t for t in target_columns}
    renames = {c: wanted[canon[c]] for c in df.columns if canon[c] in wanted}
    return df.withColumnsRenamed(renames)


def slug_name(name: Column) -> Column:
    """Lower case; drop all but word characters, spaces and dashes; runs of those become ``_``."""
    text = F.regexp_replace(strip(F.lower(name)), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(text, r"(?U)[\s-]+", "_")


def slugify_columns(df: DataFrame) -> DataFrame:
    frame = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(df.columns)], "i int, name string")
    names = [r[0] for r in frame.orderBy("i").select(slug_name(F.col("name"))).collect()]
    return df.toDF(*names)


def leaf_columns(schema: T.StructType, sep: str, parent: str = "", path: str = "") -> list[tuple[str, str]]:
    """(path, flat name) of every non-struct field, in schema order."""
    leaves = []
    for field in schema.fields:
        here = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        flat = f"{parent}{sep}{field.name}" if parent else field.name
        if isinstance(field.dataType, T.StructType):
            leaves += leaf_columns(field.dataType, sep, flat, here)
        else:
            leaves.append((here, flat))
    return leaves


def flatten_columns(df: DataFrame, sep: str = "_") -> DataFrame:
    """Lift nested struct fields to the top level, joining names with ``sep``."""
    return df.select(*[F.col(path).alias(flat) for path, flat in leaf_columns(df.schema, sep)])


def unflatten_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Inverse of :func:`flatten_columns`: ``a.b`` columns become nested structs."""
    tree: dict = {}
    for name in df.columns:
        node = tree
        *parents, last = name.split(sep)
        for part in parents:
            node = node.setdefault(part, {})
        node[last] = F.col(f"`{name}`")

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()])

    return df.select(*[(build(v) if isinstance(v, dict) else v).alias(k) for k, v in tree.items()])
