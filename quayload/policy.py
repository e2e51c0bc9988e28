"""Type model and policies: what a source column may become, and under which rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Diagnostic codes.
UNSUPPORTED_TYPE = "UnsupportedArrowType"
LOSSY = "LossyConversionRequiresPolicy"
IDENTIFIER_INVALID = "IdentifierInvalid"
DECIMAL_RANGE = "DecimalOutOfRange"
INTEGER_RANGE = "IntegerOutOfRange"
TIMESTAMP_RANGE = "TimestampOutOfRange"
TIMEZONE = "TimezoneUnsupported"
SCHEMA_MISMATCH = "SchemaMismatch"
POLICY_REQUIRED = "ProfileDependentConversion"
OBSERVATION_REQUIRED = "ObservedDataRequired"
TYPE_MISMATCH = "ValueTypeMismatch"
NULL_VALUE = "NullInNonNullableColumn"
NON_FINITE = "NonFiniteFloat"
TOO_LONG = "ValueTooLong"

# Limits of the target's types.
MAX_DECIMAL_PRECISION = 38
MAX_BINARY_LENGTH = 8000
MAX_NAME_LENGTH = 128

# Source types that stand for one another.
STRING_FAMILY = ("utf8", "large_utf8", "utf8_view")
BINARY_FAMILY = ("binary", "large_binary", "binary_view")
DECIMAL_ALIASES = {
    "decimal32": "decimal", "decimal64": "decimal", "decimal128": "decimal", "decimal256": "wide_decimal",
}

#: Field metadata key that names a source type Spark itself cannot hold.
SOURCE_TYPE_KEY = "source_type"


@dataclass(frozen=True)
class PlanOptions:
    """Policies of a load.

    ``string`` and ``binary`` take ``"max"``, ``"observed"`` or a length;
    ``timestamp`` takes ``"datetime"`` or a datetime2 precision.
    """

    string: str | int = "max"
    binary: str | int = "max"
    timestamp: str | int = 7
    timezone: str = "reject"  # reject | offset | utc
    nanosecond: str = "reject"  # reject | round | truncate
    uint64: str = "reject"  # reject | decimal | bigint
    decimal: str = "reject"  # reject | normalize (negative scale)
    wide_decimal: str = "downcast"  # downcast | reject
    date64: str = "midnight"  # midnight (checked) | datetime2
    datetime_rounding: str = "two_step"  # two_step | one_step
    observed_limit: int = 4000  # observed nvarchar beyond this becomes max
    observed_binary_limit: int = 8000

    def __post_init__(self) -> None:
        choices = {
            "timezone": ("reject", "offset", "utc"),
            "nanosecond": ("reject", "round", "truncate"),
            "uint64": ("reject", "decimal", "bigint"),
            "decimal": ("reject", "normalize"),
            "wide_decimal": ("downcast", "reject"),
            "date64": ("midnight", "datetime2"),
            "datetime_rounding": ("two_step", "one_step"),
        }
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
        for name in ("string", "binary"):
            value = getattr(self, name)
            if not isinstance(value, int) and value not in ("max", "observed"):
                raise ValueError(f"{name} must be 'max', 'observed' or a length")


@dataclass(frozen=True)
class SourceType:
    """A source column type. ``kind`` is one of int8..uint64, float32, float64,
    boolean, utf8, binary (and their families), fixed_binary, decimal, wide_decimal, date32, date64,
    time, timestamp, or an unsupported family."""

    kind: str
    unit: str | None = None  # s, ms, us, ns
    zone: str | None = None
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def text(self) -> str:
        if self.kind in ("decimal", "wide_decimal"):
            return f"{self.kind}({self.precision},{self.scale})"
        if self.kind == "fixed_binary":
            return f"fixed_binary({self.length})"
        if self.kind == "time":
            return f"time({self.unit})"
        if self.kind == "timestamp":
            return f"timestamp({self.unit})" if not self.zone else f"timestamp({self.unit},{self.zone})"
        return self.kind


@dataclass(frozen=True)
class TargetType:
    """A target column type; ``length`` None means ``max`` for variable width."""

    kind: str
    length: int | None = None
    precision: int | None = None
    scale: int | None = None

    @property
    def sql(self) -> str:
        if self.kind in ("nvarchar", "varbinary"):
            return f"{self.kind}({'max' if self.length is None else self.length})"
        if self.kind == "binary":
            return f"binary({self.length})"
        if self.kind == "decimal":
            return f"decimal({self.precision},{self.scale})"
        if self.kind in ("time", "datetime2", "datetimeoffset", "float"):
            return f"{self.kind}({self.precision})"
        return self.kind


@dataclass(frozen=True)
class PlannedColumn:
    """One source field and the target column it becomes."""

    index: int
    name: str
    nullable: bool
    source: SourceType
    target: TargetType
    target_name: str | None = None

    @property
    def column_name(self) -> str:
        return self.target_name or self.name


@dataclass(frozen=True)
class PlanIssue:
    """Why a field has no target column."""

    index: int
    name: str
    code: str
    message: str


@dataclass(frozen=True)
class LoadPlan:
    """Planned columns plus the policies they were planned under."""

    columns: tuple[PlannedColumn, ...]
    options: PlanOptions = field(default_factory=PlanOptions)


class PlanningError(ValueError):
    """All fields of a schema that could not be planned, reported together."""

    def __init__(self, issues: list[PlanIssue]):
        self.issues = issues
        super().__init__("; ".join(f"{i.name}: {i.code} ({i.message})" for i in issues))


def parse_source_type(text: str) -> SourceType:
    """Read the metadata form, e.g. ``uint8``, ``time(ns)``, ``timestamp(ns,UTC)``."""
    kind, _, rest = text.partition("(")
    kind = DECIMAL_ALIASES.get(kind, kind)
    arguments = [part.strip() for part in rest.rstrip(")").split(",")] if rest else []
    if kind in ("decimal", "wide_decimal"):
        return SourceType(kind, precision=int(arguments[0]), scale=int(arguments[1]))
    if kind == "fixed_binary":
        return SourceType(kind, length=int(arguments[0]))
    if kind == "time":
        return SourceType(kind, unit=arguments[0])
    if kind == "timestamp":
        zone = arguments[1] if len(arguments) > 1 and arguments[1] else None
        return SourceType(kind, unit=arguments[0], zone=zone)
    return SourceType(kind)


def source_type_of(field: T.StructField) -> SourceType:
    """Source type of a Spark field; metadata wins over the Spark type."""
    declared = (field.metadata or {}).get(SOURCE_TYPE_KEY)
    if declared:
        return parse_source_type(declared)
    spark_type = field.dataType
    simple = {
        T.BooleanType: "boolean",
        T.ByteType: "int8",
        T.ShortType: "int16",
        T.IntegerType: "int32",
        T.LongType: "int64",
        T.FloatType: "float32",
        T.DoubleType: "float64",
        T.StringType: "utf8",
        T.BinaryType: "binary",
        T.DateType: "date32",
        T.NullType: "null",
    }
    for cls, kind in simple.items():
        if isinstance(spark_type, cls):
            return SourceType(kind)
    if isinstance(spark_type, T.DecimalType):
        return SourceType("decimal", precision=spark_type.precision, scale=spark_type.scale)
    if isinstance(spark_type, T.TimestampNTZType):
        return SourceType("timestamp", unit="us")
    if isinstance(spark_type, T.TimestampType):
        return SourceType("timestamp", unit="us", zone="UTC")
    if isinstance(spark_type, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return SourceType("interval")
    if isinstance(spark_type, (T.ArrayType, T.MapType, T.StructType)):
        return SourceType("nested")
    return SourceType("unsupported")


def carrier_of(source: SourceType) -> T.DataType:
    """The Spark type that carries a source type."""
    simple = {
        "boolean": T.BooleanType, "int8": T.ByteType, "int16": T.ShortType, "int32": T.IntegerType, "int64": T.LongType,
        "uint8": T.ShortType, "uint16": T.IntegerType, "uint32": T.LongType, "float16": T.FloatType, "float32": T.FloatType,
        "float64": T.DoubleType, "date32": T.DateType, "date64": T.LongType, "time": T.LongType, "fixed_binary": T.BinaryType,
        "wide_decimal": T.StringType, **dict.fromkeys(STRING_FAMILY, T.StringType), **dict.fromkeys(BINARY_FAMILY, T.BinaryType),
    }
    if source.kind in simple:
        return simple[source.kind]()
    if source.kind == "uint64":
        return T.DecimalType(20, 0)
    if source.kind == "decimal":
        return T.DecimalType(min(source.precision, MAX_DECIMAL_PRECISION), max(source.scale, 0))
    if source.kind == "timestamp" and source.unit == "us":
        return T.TimestampType() if source.zone else T.TimestampNTZType()
    return T.LongType() if source.kind == "timestamp" else T.NullType()


def carries(field: T.StructField, source: SourceType) -> bool:
    """Whether a column may hold values of ``source``: as it declares, else by its Spark type.

    Unsigned numbers, times and dates in milliseconds may come in any wider integer.
    """
    declared = (field.metadata or {}).get(SOURCE_TYPE_KEY)
    if declared:
        found = parse_source_type(declared)
        return found == source or any(found.kind in f and source.kind in f for f in (STRING_FAMILY, BINARY_FAMILY))
    carrier, own = carrier_of(source), field.dataType
    if isinstance(carrier, T.NullType) or isinstance(own, type(carrier)) and not isinstance(own, T.DecimalType):
        return True
    whole = isinstance(own, T.IntegralType)
    if isinstance(own, T.DecimalType):
        return source.kind in ("uint64", "wide_decimal") and own.scale == 0 or source.kind == "decimal" and own.scale == max(source.scale, 0)
    if source.kind in ("uint64", "wide_decimal", "date64", "time") or source.kind == "timestamp" and source.unit != "us":
        return whole
    if source.kind == "decimal":
        return whole and source.scale < 0
    wider = {"uint8": (T.IntegerType, T.LongType), "uint16": (T.LongType,)}
    return isinstance(own, wider.get(source.kind, ()))
