"""JSON documents in text columns: query, build and edit them with column expressions.

Paths are not parsed here: a selection is an ordinary expression on a typed
struct (``from_json``), on a ``map<string,variant>`` or on a VARIANT.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import compute_once, cut_lineage

MEMBERS = "map<string,variant>"


# ---- testing and comparing -------------------------------------------------

def is_json(text: Column, strict: bool = False, scalars: bool = False) -> Column:
    """Whether text is a JSON object or array (any JSON value with ``scalars``).

    ``strict`` rejects objects that repeat a name.
    """
    value = F.try_parse_json(text)
    ok = value.isNotNull()
    if not scalars:
        ok = ok & F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")
    if not strict:
        ok = ok | (F.from_json(text, MEMBERS).isNotNull() & text.rlike(r"^\s*\{"))
    return text.isNotNull() & ok


def is_not_json(text: Column, strict: bool = False) -> Column:
    return text.isNotNull() & ~is_json(text, strict)


def json_equal(a: Column, b: Column) -> Column:
    """Same value whatever the white space and the order of names."""
    return F.to_json(F.try_parse_json(a)) == F.to_json(F.try_parse_json(b))


# ---- selecting ---------------------------------------------------------------

def _is_scalar(value: Column) -> Column:
    return ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)")


#: How text that converts to a whole number begins, white space and controls before it.
_WHOLE_START = r"^[\x00-\x20\x7F-\x9F]*[-+.0-9]"


def _scalar(doc: Column, path: str, returning: str) -> Column:
    """``try_variant_get``, which throws and catches for text that is no number; other text is told apart by its start."""
    value = F.try_variant_get(doc, path, returning)
    if returning not in ("tinyint", "smallint", "int", "bigint"):
        return value
    text = F.try_variant_get(doc, path, "string")
    other = (F.schema_of_variant(F.try_variant_get(doc, path, "variant")) == "STRING") & ~text.rlike(_WHOLE_START)
    return F.when(~other, value)


def json_value(
    doc: Column, path: str, returning: str = "string",
    on_error: str = "null", default_on_error=None, default_on_empty=None,
) -> Column:
    """One scalar of a VARIANT document.

    Missing: null or ``default_on_empty``.  An object, an array or a value that
    does not convert: null, ``default_on_error``, or the job stops
    (``on_error="error"``).
    """
    found = F.try_variant_get(doc, path, "variant")
    value = F.when(_is_scalar(found), _scalar(doc, path, returning))
    failed = found.isNotNull() & value.isNull() & (F.schema_of_variant(found) != "VOID")
    if on_error == "error":
        value = F.when(failed, F.raise_error(F.lit(f"no {returning} at {path}")).cast(returning)).otherwise(value)
    elif default_on_error is not None:
        value = F.when(failed, F.lit(default_on_error).cast(returning)).otherwise(value)
    if default_on_empty is not None:
        value = F.when(found.isNull(), F.lit(default_on_empty).cast(returning)).otherwise(value)
    return value


def json_query(matches: Column, wrapper: str = "without", empty: str = "null") -> Column:
    """JSON text of the values a selection matched (an array column).

    ``with`` always wraps them in an array, ``conditional`` only when there are
    several, ``without`` gives null for several.  ``empty="array"`` gives ``[]``
    when nothing matched.
    """
    n = F.size(F.coalesce(matches, F.array().cast("array<string>")) if empty == "array" else matches)
    one = F.to_json(F.struct(F.get(matches, F.lit(0)).alias("v")), {"ignoreNullFields": "false"})
    # Peel {"v":...} off so that scalars and nested values render alike.
    single = F.regexp_extract(one, r'(?s)^\{"v":(.*)\}$', 1)
    many = F.to_json(matches, {"ignoreNullFields": "false"})
    none = F.lit("[]") if empty == "array" else F.lit(None).cast("string")
    if wrapper == "with":
        filled = many
    elif wrapper == "conditional":
        filled = F.when(n == 1, single).otherwise(many)
    else:
        filled = F.when(n == 1, single)
    return F.when(matches.isNull() | (n == 0), none).otherwise(filled)


def as_array(value: Column, kind: T.DataType) -> Column:
    """Relaxed access: a single value stands for a one-element array."""
    return value if isinstance(kind, T.ArrayType) else F.when(value.isNotNull(), F.array(value))


def relaxed_items(doc: Column, name: str, item_type: str) -> Column:
    """Member ``name`` as an array, whether the document holds one item or many."""
    many = F.try_variant_get(doc, f"$.{name}", f"array<{item_type}>")
    single = F.try_variant_get(doc, f"$.{name}", item_type)
    return F.coalesce(many, F.when(single.isNotNull(), F.array(single)))


def steps(array: Column, wanted: Sequence[int | tuple[int, int]]) -> Column:
    """Elements by zero-based index, inclusive ranges or a mix, in the order asked for."""
    picked = []
    for step in wanted:
        if isinstance(step, tuple):
            low, high = step
            picked.append(F.slice(array, low + 1, high - low + 1))
        else:
            picked.append(F.slice(array, step + 1, 1))
    return F.concat(*picked)


def descendants(value: Column, kind: T.DataType, name: str) -> Column:
    """Every member called ``name`` at any depth, as JSON text, in document order.

    The walk follows the declared type, so it happens once while the plan is
    built; VARIANT elements are looked into one level.
    """
    if isinstance(kind, T.StructType):
        found = []
        for field in kind.fields:
            child = value.getField(field.name)
            if field.name == name:
                found.append(F.when(child.isNotNull(), F.array(_text(child, field.dataType))))
            inner = descendants(child, field.dataType, name)
            if inner is not None:
                found.append(inner)
        if not found:
            return None
        empty = F.array().cast("array<string>")
        return F.concat(*[F.coalesce(f, empty) for f in found])
    if isinstance(kind, T.ArrayType):
        probe = descendants(F.col("x"), kind.elementType, name)
        if probe is None:
            return None
        return F.flatten(F.transform(value, lambda x: descendants(x, kind.elementType, name)))
    if isinstance(kind, T.VariantType):
        return F.array_compact(F.array(F.try_variant_get(value, f"$.{name}", "string")))
    return None


def deep_descendants(df: DataFrame, doc: str, name: str, out: str = "found") -> DataFrame:
    """``df`` with every member called ``name`` at any depth of VARIANT ``doc``, as an array of JSON texts.

    For documents of unknown shape: a recursive query opens objects and arrays level
    by level.  Members stand in order of their paths, a parent before what is in it;
    VARIANT keeps the members of an object by name.  No such member gives an empty
    array; rows without a document give null.
    """
    spark = df.sparkSession
    rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    nested = "schema_of_variant({}) RLIKE '^(OBJECT|ARRAY)'"
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")  # the rows are those of the documents
    try:
        found = spark.sql(
            f"""
            WITH RECURSIVE walk(row_no, path, member, value) AS (
              SELECT __row, CAST(array() AS array<string>), CAST(NULL AS string), __doc FROM {{docs}}
              UNION ALL
              SELECT row_no, array_append(path, coalesce(e.key, lpad(CAST(e.pos AS string), 10, '0'))), e.key, e.value
              FROM walk, LATERAL variant_explode(walk.value) AS e WHERE {nested.format("walk.value")}
            )
            SELECT row_no AS __of, array_sort(collect_list(struct(path, to_json(value) AS text))) AS __found
            FROM walk WHERE member = :name GROUP BY row_no
            """,
            args={"name": name},
            docs=rows.select("__row", F.col(doc).alias("__doc")),
        )
        found = cut_lineage(found)
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)
    joined = rows.join(found, F.col("__row") == F.col("__of"), "left")
    texts = F.coalesce(F.transform("__found", lambda x: x["text"]), F.array().cast("array<string>"))
    return joined.withColumn(out, F.when(F.col(doc).isNotNull(), texts)).drop("__row", "__of", "__found")


def _text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def safe_get(doc: Column, path: str, default: str | None = None) -> Column:
    """Text at a dotted path (numbers index arrays); missing or null gives the default."""
    parts = [f"[{p}]" if p.isdigit() else f".{p}" for p in path.split(".")]
    value = F.try_variant_get(doc, "$" + "".join(parts), "string")
    return F.coalesce(value, F.lit(default))


# ---- item methods --------------------------------------------------------------

def only(values: Column, kind: str) -> Column:
    """Keep the elements of an ``array<variant>`` that are of one JSON type."""
    pattern = {
        "string": "^STRING$",
        "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
        "boolean": "^BOOLEAN$",
        "null": "^VOID$",
        "object": "^OBJECT",
        "array": "^ARRAY",
    }[kind]
    return F.filter(values, lambda v: F.schema_of_variant(v).rlike(pattern))


def json_type(value: Column) -> Column:
    """string, number, boolean, null, object or array; SQL null when missing."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "null")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.isNotNull(), "number")
    )


def json_size(text: Column) -> Column:
    """Members of an object, elements of an array, 1 for a scalar."""
    value = F.try_parse_json(text)
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), F.size(F.json_object_keys(text)))
        .when(kind.startswith("ARRAY"), F.json_array_length(text))
        .when(kind.isNotNull(), 1)
    )


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 date, date-time, offset, Z or fraction to a UTC timestamp without zone."""
    wall = text.try_cast("timestamp_ntz")  # ignores a zone, so the offset is taken off here
    offset = r"T.*([+-])(\d{2}):?(\d{2})$"
    hours = F.regexp_extract(text, offset, 2).try_cast("int")
    minutes = F.regexp_extract(text, offset, 3).try_cast("int")
    sign = F.when(F.regexp_extract(text, offset, 1) == "-", 1).otherwise(-1)
    shift = F.coalesce((hours * 60 + minutes) * sign, F.lit(0))
    return F.timestamp_add("MINUTE", shift, wall)


# ---- building -----------------------------------------------------------------

def json_object(pairs: dict[str, Column], absent_on_null: bool = False) -> Column:
    """Object from name/value pairs; nulls are written unless ``absent_on_null``."""
    fields = [v.alias(k) for k, v in pairs.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "true" if absent_on_null else "false"})


def json_array(values: Sequence[Column], null_on_null: bool = False) -> Column:
    """Array of values of any types; nulls are left out unless ``null_on_null``."""
    empty = F.parse_json(F.lit("null")) if null_on_null else F.lit(None).cast("variant")
    items = F.array(*[F.coalesce(v.cast("variant"), empty) for v in values])
    return F.to_json(items if null_on_null else F.array_compact(items))


def embedded(text: Column) -> Column:
    """Text that already is JSON, to be nested as a value rather than as a string."""
    return F.parse_json(text)


def rendered(value: Column, kind: T.DataType) -> Column:
    """A value ready for JSON: binary as hex, NaN and infinities as text."""
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        special = (
            F.when(F.isnan(value), "Nan")
            .when(value == float("inf"), "Inf")
            .when(value == float("-inf"), "-Inf")
        )
        return F.coalesce(special.cast("variant"), value.cast("variant"))
    return value


def pretty(doc: Column, schema: str) -> Column:
    """Indented text of a document of known shape."""
    return F.to_json(F.from_json(doc, schema), {"pretty": "true"})


def compact(doc: Column) -> Column:
    return F.to_json(F.try_parse_json(doc))


# ---- editing ---------------------------------------------------------------------

def members(text: Column) -> Column:
    """The members of an object document as a map."""
    return F.from_json(text, MEMBERS)


def text_of(doc: Column) -> Column:
    return F.to_json(doc)


def put(doc: Column, name: str, value: Column) -> Column:
    """Set a member (a JSON null when the value is null)."""
    cell = F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))
    return F.map_concat(remove(doc, name), F.create_map(F.lit(name), cell))


def put_json(doc: Column, name: str, text: Column) -> Column:
    """Set a member to an object or array given as JSON text."""
    return F.map_concat(remove(doc, name), F.create_map(F.lit(name), F.parse_json(text)))


def remove(doc: Column, *names: str) -> Column:
    return F.map_filter(doc, lambda k, v: ~k.isin(*names))


def pick(doc: Column, names: Sequence[str]) -> Column:
    return F.map_filter(doc, lambda k, v: k.isin(*names))


def rename_key(doc: Column, old: str, new: str) -> Column:
    """Rename a member; an existing member of the new name gives way."""
    cleared = F.when(F.map_contains_key(doc, old), F.map_filter(doc, lambda k, v: k != new)).otherwise(doc)
    return F.transform_keys(cleared, lambda k, v: F.when(k == old, F.lit(new)).otherwise(k))


def merge_in(doc: Column, other: Column) -> Column:
    """Shallow merge; the other document's members win."""
    kept = F.map_filter(doc, lambda k, v: ~F.map_contains_key(other, k))
    return F.map_concat(kept, other)


def array_insert(array: Column, index: int, value: Column) -> Column:
    """Insert before a zero-based index."""
    return F.array_insert(array, index + 1, value)


def array_put(array: Column, index: int, value: Column) -> Column:
    """Overwrite the element at a zero-based index."""
    return F.transform(array, lambda x, i: F.when(i == index, value).otherwise(x))


def array_remove_at(array: Column, index: int) -> Column:
    return F.filter(array, lambda x, i: i != index)


def _patch(base, patch, delete_nulls: bool):
    if not isinstance(patch, dict):
        return patch
    out = dict(base) if isinstance(base, dict) else {}
    for name, value in patch.items():
        if value is None and delete_nulls:
            out.pop(name, None)
        elif isinstance(value, dict) and (delete_nulls or isinstance(out.get(name), dict)):
            out[name] = _patch(out.get(name), value, delete_nulls)
        else:
            out[name] = value
    return out


class _Number(str):
    """A number as it is written, so that no digit changes."""

    __slots__ = ()


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def _loads(text: str):
    return json.loads(text, parse_float=_Number, parse_int=_Number, parse_constant=_refuse)


def _quoted(text: str) -> str:
    out = json.dumps(text, ensure_ascii=False)
    # a lone surrogate cannot be sent as it is; its escape is JSON all the same
    return out if out.isascii() or not _SURROGATE.search(out) else json.dumps(text)


_SURROGATE = re.compile("[\ud800-\udfff]")
_CONSTANTS = {None: "null", True: "true", False: "false"}


def _dumps(value) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, str):
        return _quoted(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{_quoted(k)}:{_dumps(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_dumps, value)) + "]"
    return _CONSTANTS[value]


def _patcher(delete_nulls: bool) -> Callable:
    @F.pandas_udf("result string, error string")
    def apply(base: pd.Series, patch: pd.Series) -> pd.DataFrame:
        def one(b, p):
            if b is None or p is None:
                return None, None
            sides = []
            for name, text in (("document", b), ("patch", p)):
                try:
                    sides.append(_loads(text))
                except (ValueError, RecursionError) as error:
                    return None, f"{name}: {error or 'nested too deep'}"[:200]
            try:
                return _dumps(_patch(*sides, delete_nulls)), None
            except RecursionError:
                return None, "nested too deep"

        return pd.DataFrame([one(b, p) for b, p in zip(base, patch, strict=True)], columns=["result", "error"], dtype=object)

    return apply


def merge_patch(doc: Column, patch: Column) -> Column:
    """RFC 7396 merge patch: null deletes, objects recurse, anything else replaces.

    Documents have unknown shapes and a typed parse cannot tell null from
    absent, so this runs as an Arrow-batched function.  Numbers keep their text;
    null where either side is no JSON (``merge_patch_checked`` says which and why).
    """
    return _patcher(True)(doc, patch)["result"]


def merge_patch_checked(doc: Column, patch: Column) -> Column:
    """``result`` and ``error`` of a merge patch; one of them is null, both are for a null side."""
    return _patcher(True)(doc, patch)


def deep_merge(doc: Column, other: Column) -> Column:
    """Like :func:`merge_patch`, but null is a value and nothing is deleted."""
    return _patcher(False)(doc, other)["result"]


# ---- tables from documents -----------------------------------------------------------

def json_table(
    df: DataFrame, doc: str, schema: str, columns: dict[str, Callable[[Column], Column]],
    nested: Callable[[Column], Column] | None = None,
    nested_columns: dict[str, Callable[[Column], Column]] | None = None,
    ordinality: str | None = None, outer: bool = True, keep: Sequence[str] = (),
) -> DataFrame:
    """Rows from documents.

    ``columns`` select from the parsed document; ``nested`` selects an array
    whose elements become rows (documents without elements stay when ``outer``)
    and ``nested_columns`` select from an element.  The document is parsed once;
    leave fields that no column needs out of ``schema``.
    """
    parsed = compute_once(df, __d=F.from_json(doc, schema))
    out = [F.col(k) for k in keep] + [f(F.col("__d")).alias(n) for n, f in columns.items()]
    if nested is None:
        return parsed.select(*out)
    explode = F.posexplode_outer if outer else F.posexplode
    rows = parsed.select(*out, explode(nested(F.col("__d"))).alias("__i", "__e"))
    cells = [f(F.col("__e")).alias(n) for n, f in (nested_columns or {}).items()]
    if ordinality:
        cells.append((F.col("__i") + 1).alias(ordinality))
    return rows.select(*keep, *columns, *cells)


def flatten_json_column(df: DataFrame, column: str, schema: str | None = None) -> DataFrame:
    """Replace a JSON object column by one column per leaf, named ``column_a.b``.

    Without a schema, one aggregate over the whole column finds it, so no shape
    is missed by sampling.
    """
    from .names import leaf_columns

    if schema is None:
        found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
        schema = found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    parsed = compute_once(df, __d=F.from_json(column, schema))
    inner = parsed.select("__d.*").schema
    leaves = leaf_columns(inner, ".")
    others = [c for c in df.columns if c != column]
    return parsed.select(*others, *[F.col(f"__d.{p}").alias(f"{column}_{n}") for p, n in leaves])


def convert(text: Column, source: str, target: str, schema: str) -> Column:
    """A column of json, xml or csv text in another of these formats."""
    if source == "xml":
        value = F.from_xml(text, schema)
    else:
        value = F.from_json(text, schema) if source == "json" else F.from_csv(text, schema)
    if target == "json":
        return F.to_json(value, {"ignoreNullFields": "false"})
    return F.to_xml(value) if target == "xml" else F.to_csv(value)
