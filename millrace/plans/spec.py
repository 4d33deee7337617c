"""Table specifications kept in Spark schemas: logical types and constraints as field metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import LENGTH_HEADROOM, MAX_TEXT_LENGTH

# Logical type of each source type name.
CRM_TYPES = {
    "id": "string", "string": "string", "textarea": "string", "email": "string", "phone": "string",
    "url": "string", "encryptedstring": "string", "picklist": "string", "multipicklist": "string",
    "combobox": "string", "reference": "string", "anytype": "string", "int": "integer",
    "integer": "integer", "long": "integer", "double": "float", "currency": "float",
    "percent": "float", "boolean": "boolean", "date": "date", "datetime": "datetime",
    "time": "time", "base64": "byte", "complexvalue": "json", "address": "json", "location": "json",
}
RELATIONAL_TYPES = {
    "CLOB": "string", "NCLOB": "string", "ROWID": "string", "UROWID": "string",
    "VARCHAR2": "string", "NVARCHAR2": "string", "CHAR": "string", "NCHAR": "string",
    "FLOAT": "float", "BINARY_FLOAT": "float", "BINARY_DOUBLE": "float", "DATE": "date",
    "BLOB": "byte", "RAW": "byte", "LONG RAW": "byte", "BFILE": "byte", "JSON": "json",
}
# Target declaration of each logical type that needs no length.
TARGET_TYPES = {
    "integer": "NUMBER", "boolean": "VARCHAR2(1 CHAR)", "date": "DATE", "time": "VARCHAR2(15 CHAR)",
    "byte": "BLOB", "json": "JSON",
}
SPARK_TYPES = {
    "string": "string", "integer": "bigint", "float": "double", "boolean": "boolean",
    "datetime": "timestamp_ntz", "date": "date", "time": "string", "byte": "binary",
    "bytearray": "binary", "json": "variant",
}


@dataclass(frozen=True)
class ColumnSpec:
    """One column: its logical type and everything declared about it."""

    name: str
    logical: str = "string"
    alias: str | None = None
    raw_type: str | None = None
    primary_key: bool = False
    unique: bool = False
    nullable: bool = True
    read_only: bool = False
    compound_key: bool = False
    references: str | None = None
    max_length: int | None = None
    precision: int | None = None
    scale: int | None = None
    null_token: str | None = None
    default: str | None = None
    enum_values: tuple[str, ...] = ()
    timezone: str | None = None
    ordinal: int | None = None
    computed: bool = False
    formula: str | None = None
    deprecated: bool = False
    hidden: bool = False
    indexed: bool = False
    enforced: bool = True
    external_key: bool = False
    description: str | None = None
    properties: dict = field(default_factory=dict)

    @property
    def spark_type(self) -> str:
        if self.logical == "float" and self.precision is not None and self.scale is not None:
            return f"decimal({self.precision},{self.scale})"
        if self.logical == "datetime" and self.timezone:
            return "timestamp"
        return SPARK_TYPES[self.logical]

    @property
    def target_type(self) -> str:
        if self.logical == "string":
            fits = self.max_length is not None and self.max_length <= MAX_TEXT_LENGTH
            return f"VARCHAR2({self.max_length} CHAR)" if fits else "CLOB"
        if self.logical == "float":
            exact = self.precision is not None and self.scale is not None
            return f"NUMBER({self.precision}, {self.scale})" if exact else "NUMBER"
        if self.logical == "datetime":
            return "TIMESTAMP WITH TIME ZONE" if self.timezone else "TIMESTAMP"
        return TARGET_TYPES.get(self.logical, "VARCHAR2(255 CHAR)")


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    system: str = "relational"
    environment: str | None = None
    namespace: str | None = None
    prefix: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def column_map(self) -> dict[str, ColumnSpec]:
        return {c.name: c for c in self.columns}

    def schema(self) -> T.StructType:
        """Spark schema whose field metadata carries the declarations."""
        out = T.StructType()
        for c in self.columns:
            declared = {k: v for k, v in asdict(c).items() if v not in (None, (), {})}
            declared["enum_values"] = list(c.enum_values)
            out.add(T.StructField(c.name, T._parse_datatype_string(c.spark_type), c.nullable, declared))
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        """The frame with this specification attached as column metadata."""
        return df.select(
            *[F.col(f.name).alias(f.name, metadata=f.metadata) for f in self.schema().fields]
        )

    def widened(self, lengths: dict[str, int]) -> "TableSpec":
        new = [replace(c, max_length=lengths.get(c.name, c.max_length)) for c in self.columns]
        return replace(self, columns=tuple(new))


def spec_of(df: DataFrame, name: str) -> TableSpec:
    """Read a specification back from the column metadata of a frame."""
    known = {f.name for f in fields(ColumnSpec)}
    columns = []
    for f in df.schema.fields:
        declared = {k: v for k, v in (f.metadata or {}).items() if k in known}
        declared["enum_values"] = tuple(declared.get("enum_values", ()))
        declared.setdefault("logical", logical_of_spark(f.dataType))
        columns.append(ColumnSpec(**{**declared, "name": f.name}))
    return TableSpec(name, tuple(columns))


def logical_of_spark(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "float"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    names = {T.BooleanType: "boolean", T.DateType: "date", T.BinaryType: "byte"}
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return "json"
    return names.get(type(kind), "string")


def logical_of_crm(type_name: str) -> str:
    """Unknown names are text."""
    return CRM_TYPES.get(type_name.lower(), "string")


def logical_of_relational(type_name: str, scale: int | None = None) -> str:
    name = type_name.upper()
    if name == "NUMBER":
        return "integer" if scale == 0 else "float"
    if "TIMESTAMP" in name:
        return "datetime"
    return RELATIONAL_TYPES.get(name, "string")


def declared_length(observed: int) -> int:
    """Length to declare for text of the observed length."""
    if observed > MAX_TEXT_LENGTH:
        raise ValueError(f"observed length {observed} exceeds {MAX_TEXT_LENGTH}")
    return min(observed + LENGTH_HEADROOM, MAX_TEXT_LENGTH)


def external_key(spec: TableSpec, explicit: str | None = None, identity: str = "Id") -> str:
    """Column to match an upsert on: the explicit one, else the flagged one, else the identity."""
    if explicit:
        return explicit
    flagged = [c.name for c in spec.columns if c.external_key]
    return flagged[0] if flagged else identity


def writable(spec: TableSpec, action: str, identity: str = "Id") -> list[str]:
    """Columns a load may send; the identity is left out of an insert."""
    skip: Sequence[str] = [identity] if action == "insert" else []
    return [c.name for c in spec.columns if not c.read_only and not c.computed and c.name not in skip]
