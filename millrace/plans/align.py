"""Bringing a target schema in line with a source: drift report, lengths, aligned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import LENGTH_HEADROOM, MAX_TEXT_LENGTH
from .spec import TableSpec


def observed_profile(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """One row per column: longest text, null count and values that do not cast."""
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.max(F.length(F.col(c).cast("string"))).alias(f"__len_{c}") for c in kinds],
        *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in kinds],
        *[
            F.count_if(
                F.col(c).isNotNull() & F.col(c).cast("string").try_cast(k if k != "variant" else "string").isNull()
            ).alias(f"__bad_{c}")
            for c, k in kinds.items()
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("__rows").alias("row_count"),
            F.coalesce(f"__len_{c}", F.lit(0)).alias("max_length"),
            F.col(f"__null_{c}").alias("null_count"),
            F.col(f"__bad_{c}").alias("failed_casts"),
        )
        for c in kinds
    ]
    return wide.select(F.inline(F.array(*rows)))


def schema_drift(
    df: DataFrame, source: TableSpec, target: TableSpec | None, trusted: bool = True
) -> DataFrame:
    """What must change so that ``target`` can hold the source rows.

    One aggregate over the data gives the lengths; everything else comes from
    the two specifications.  Text is only ever widened.  An untrusted source
    does not tighten nullability.  The changes are complete in one pass, because
    each depends on the specifications and not on other changes.
    """
    kinds = {c.name: c.spark_type for c in source.columns}
    observed = observed_profile(df, kinds)
    have = target.column_map if target else {}
    rows = []
    for i, c in enumerate(source.columns):
        t = have.get(c.name)
        rows.append(
            (
                i,
                c.name,
                c.logical,
                t.logical if t else None,
                t.max_length if t else None,
                c.nullable,
                t.nullable if t else None,
                c.primary_key or c.unique,
                c.max_length,
            )
        )
    declared = df.sparkSession.createDataFrame(
        rows,
        "ordinal int, column_name string, logical string, old_logical string, old_length int, "
        "nullable boolean, old_nullable boolean, is_key boolean, stated_length int",
    )
    seen = F.greatest("max_length", F.coalesce("stated_length", F.lit(0)))
    length = F.least(seen + LENGTH_HEADROOM, F.lit(MAX_TEXT_LENGTH))
    text = F.col("logical") == "string"
    missing = F.col("old_logical").isNull()
    first = F.lit("create table") if target is None else F.lit("add column")
    actions = F.array_compact(
        F.array(
            F.when(text & (seen > MAX_TEXT_LENGTH), F.lit("reject: text too long")),
            F.when(missing, first),
            F.when(
                text & (F.col("old_logical") == "string") & (length > F.coalesce("old_length", F.lit(0)))
                & (seen <= MAX_TEXT_LENGTH),
                F.concat(F.lit("widen to "), length),
            ),
            F.when(~missing & (F.col("logical") != F.col("old_logical")), F.concat(F.lit("change type to "), "logical")),
            F.when(
                ~missing & F.col("nullable") & ~F.col("old_nullable"), F.lit("allow null")
            ).when(
                ~missing & ~F.col("nullable") & F.col("old_nullable") & F.lit(trusted), F.lit("forbid null")
            ),
        )
    )
    return declared.join(observed, "column_name").select(
        "ordinal",
        "column_name",
        "row_count",
        "null_count",
        "failed_casts",
        F.when(text, length).alias("declared_length"),
        F.when(F.size(actions) > 0, F.concat_ws(", ", actions)).otherwise("keep").alias("action"),
        "is_key",
    )


def align_frame(df: DataFrame, target: TableSpec) -> DataFrame:
    """Source rows in the target's columns and types; columns they lack are null."""
    return target.apply(
        df.select(
            *[
                (
                    F.col(c.name).try_cast(c.spark_type)
                    if c.name in df.columns
                    else F.lit(None).cast(c.spark_type)
                ).alias(c.name)
                for c in target.columns
            ]
        )
    )


def widen_on_overflow(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, TableSpec]:
    """(rows that fit, rows that cannot fit, widened specification).

    One pass finds the longest text per column, so no load has to fail and be
    tried again.  Rows beyond the longest text a column may hold are rejected.
    """
    text = [c for c in spec.columns if c.logical == "string" and c.max_length is not None]
    if not text:
        return df, df.where(F.lit(False)), spec
    fits = F.lit(True)
    for c in text:
        fits = fits & (F.coalesce(F.length(c.name), F.lit(0)) <= MAX_TEXT_LENGTH)
    good = df.where(fits)
    longest = good.agg(*[F.max(F.length(c.name)).alias(c.name) for c in text]).first()
    lengths = {
        c.name: min(longest[c.name] + LENGTH_HEADROOM, MAX_TEXT_LENGTH)
        for c in text
        if longest[c.name] is not None and longest[c.name] > c.max_length
    }
    wider = spec.widened(lengths)
    return wider.apply(good), df.where(~fits), wider
