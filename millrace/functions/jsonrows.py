"""A table function for SQL: rows out of documents whose shape is not known.

``json_rows(TABLE(t), path, columns)`` gives a row for each element that ``path``
leads to in the text column ``doc`` of each row of ``t``.  Its columns are the other
columns of ``t``, ``element_no``, and those that ``columns`` asks for; they are known
when the query is analysed, because the last two arguments are constants.
"""

from __future__ import annotations

import datetime
import decimal
import functools
import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf

KINDS = {"string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType()}


@functools.cache
def wanted_columns(text: str) -> list[tuple[str, str, list[str]]]:
    """``name kind [path]`` entries by comma: a column's name, kind and the members that lead to it."""
    out = []
    for entry in text.split(","):
        name, kind, *path = entry.split()
        if kind.lower() not in KINDS:
            raise ValueError(f"{kind} is none of {', '.join(KINDS)}")
        out.append((name, kind.lower(), (path[0].removeprefix("$.") if path else name).split(".")))
    return out


def elements(value, path: list[str]) -> list:
    """What members and ``[*]`` steps lead to; an array is gone through at a member too."""
    found = [value]
    for step in path:
        after = []
        for x in found:
            if step == "[*]":
                after += x if isinstance(x, list) else [x]
                continue
            for y in x if isinstance(x, list) else [x]:
                if isinstance(y, dict) and step in y:
                    after.append(y[step])
        found = after
    return found


def first_element(value, path: list[str]):
    """The first of ``elements``, or None; plain members are followed without lists."""
    for n, step in enumerate(path):
        if type(value) is not dict or step == "[*]":
            return next(iter(elements(value, path[n:])), None)
        if step not in value:
            return None
        value = value[step]
    return value


@functools.cache
def _steps(path: str) -> list[str]:
    return [s for s in path.removeprefix("$").replace("[*]", ".[*]").split(".") if s]


def convert(value, kind: str):
    """A JSON value as a column's kind; what does not fit is null, objects and arrays are text."""
    if value is None:
        return None
    if kind == "string":
        return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False, default=str)
    if kind == "boolean":
        return value if isinstance(value, bool) else None
    if type(value) is int and -(2**63) < value < 2**63:
        if kind == "bigint":
            return value
        if kind == "double":
            return float(value)
    if kind == "double" and type(value) is decimal.Decimal:
        return float(value)
    try:
        if kind == "date":
            return datetime.date.fromisoformat(value[:10])
        if isinstance(value, bool):
            return None
        number = decimal.Decimal(str(value))
        if kind == "double":
            return float(number)
        return int(number) if number == int(number) and abs(number) < 2**63 else None
    except (ValueError, TypeError, ArithmeticError):
        return None


@udtf
class JsonRows:
    """Every document gives a row at least: without an element its own columns are null."""

    def __init__(self):
        self.kept = self.doc = None

    @staticmethod
    def analyze(docs: AnalyzeArgument, path: AnalyzeArgument, columns: AnalyzeArgument) -> AnalyzeResult:
        if not docs.isTable or "doc" not in docs.dataType.fieldNames():
            raise ValueError("the first argument is a table with a column doc")
        if path.value is None or columns.value is None:
            raise ValueError("path and columns are constants")
        kept = [f for f in docs.dataType.fields if f.name != "doc"]
        made = [T.StructField(n, KINDS[k]) for n, k, _ in wanted_columns(columns.value)]
        return AnalyzeResult(T.StructType([*kept, T.StructField("element_no", T.IntegerType()), *made]))

    def eval(self, row, path: str, columns: str) -> Iterator[tuple]:
        wanted = wanted_columns(columns)
        if self.kept is None:
            self.kept = [i for i, n in enumerate(row.__fields__) if n != "doc"]
            self.doc = row.__fields__.index("doc")
        kept = [row[i] for i in self.kept]
        doc = row[self.doc]
        try:
            found = elements(json.loads(doc, parse_float=decimal.Decimal), _steps(path)) if doc is not None else []
        except (ValueError, RecursionError):
            found = []
        if not found:
            yield (*kept, None, *[None] * len(wanted))
        for k, element in enumerate(found, 1):
            yield (*kept, k, *[convert(first_element(element, p), kind) for _, kind, p in wanted])


def register(spark: SparkSession, name: str = "json_rows") -> None:
    """Make the table function known to SQL under ``name``."""
    spark.udtf.register(name, JsonRows)
