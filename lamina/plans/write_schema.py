"""Declared and inferred schemas of what is written.

All rules stand in one table, ``KINDS``: for each type that can be declared,
what it is in a file, which parameters it has, which Spark types it can be made
from, and which values it can't hold.  Declaring, inferring, checking and
casting only look things up there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPETITIONS = ("AUTO", "REQUIRED", "OPTIONAL")
#: Fixed by the format: edge interpolations and time units.
ALGORITHMS = ("SPHERICAL", "VINCENTY", "THOMAS", "ANDOYER", "KARNEY")
UNITS = ("MILLIS", "MICROS", "NANOS")


class SchemaError(ValueError):
    """A declaration or a value that can't be written as declared; raised before any byte is written."""


@dataclass(frozen=True)
class WriteField:
    name: str
    physical_type: str
    logical_type: str | None = None
    logical_details: str | None = None
    repetition_type: str = "AUTO"


WRITE_SCHEMA = "name string, physical_type string, logical_type string, logical_details string, repetition_type string"
#: (what is wrong, whether it is) of a column, given its Spark type.
Fault = tuple[str, F.Column]


def one_of(*allowed: str) -> Callable[[object], str]:
    def parse(value: object) -> str:
        if not isinstance(value, str) or value.upper() not in allowed:
            raise SchemaError(f"{value!r} isn't among {', '.join(allowed)}")
        return value.upper()

    return parse


def utc_only(value: object) -> str:
    if value is not True:
        raise SchemaError(f"{value!r}: only instants can be declared, so True")
    return "true"


def crs(value: object) -> str:
    if not isinstance(value, str) or len(value.encode()) > 127:
        raise SchemaError("a text of up to 127 bytes is expected")
    return value


def whole(low: int, high: int, only_inexact: bool = False) -> Callable[[F.Column, T.DataType], Iterable[Fault]]:
    """Faults of numbers that are to be whole and lie within bounds; ``only_inexact`` trusts integer columns."""

    def faults(c: F.Column, kind: T.DataType) -> Iterable[Fault]:
        if isinstance(kind, T.FloatType | T.DoubleType):
            yield "it has NaN", F.isnan(c)
        if isinstance(kind, T.FractionalType):
            yield "a number isn't whole", c != F.floor(c)
        if not (only_inexact and isinstance(kind, T.IntegralType)):
            yield f"a number is out of the range {low} to {high}", ~c.between(F.lit(low), F.lit(high))

    return faults


def days(c: F.Column, kind: T.DataType) -> Iterable[Fault]:
    return () if isinstance(kind, T.DateType) else whole(-(1 << 31), (1 << 31) - 1)(c, kind)


def utf8(c: F.Column, _: T.DataType) -> Iterable[Fault]:
    yield "a text isn't valid UTF-8", ~F.is_valid_utf8(c)


@dataclass(frozen=True)
class Kind:
    """One type that can be declared."""

    physical: str
    logical: str | None
    written: T.DataType
    takes: tuple[type, ...]
    made_from: str  # ``takes`` in words
    faults: Callable[[F.Column, T.DataType], Iterable[Fault]] = lambda c, kind: ()
    #: parameter -> (its name in the details, its default, its parser)
    parameters: dict[str, tuple[str, object, Callable]] = field(default_factory=dict)


NUMBER = ((T.NumericType,), "a numeric column")
BYTES = ((T.BinaryType,), "a column of binary values")
_CRS = ("crs", "OGC:CRS84", crs)
KINDS = {
    "BOOLEAN": Kind("BOOLEAN", None, T.BooleanType(), (T.BooleanType,), "a boolean column"),
    # The smallest number stands for a missing one in the mapping contract, so it isn't written.
    "INT32": Kind("INT32", None, T.IntegerType(), *NUMBER, faults=whole(-(1 << 31) + 1, (1 << 31) - 1)),
    # Doubles are whole numbers exactly only so far.
    "INT64": Kind("INT64", None, T.LongType(), *NUMBER, faults=whole(-(1 << 53), 1 << 53, only_inexact=True)),
    "FLOAT": Kind("FLOAT", None, T.FloatType(), *NUMBER),
    "DOUBLE": Kind("DOUBLE", None, T.DoubleType(), *NUMBER),
    "STRING": Kind("BYTE_ARRAY", "STRING", T.StringType(), (T.StringType,), "a text column", faults=utf8),
    "BINARY": Kind("BYTE_ARRAY", None, T.BinaryType(), *BYTES),
    "DATE": Kind("INT32", "DATE", T.DateType(), (T.DateType, T.NumericType), "dates or whole days", faults=days),
    "TIMESTAMP": Kind("INT64", "TIMESTAMP", T.TimestampType(), (T.TimestampType,), "a timestamp column", parameters={"unit": ("unit", "MICROS", one_of(*UNITS)), "is_adjusted_utc": ("adjusted_to_utc", True, utc_only)}),
    "GEOMETRY": Kind("BYTE_ARRAY", "GEOMETRY", T.BinaryType(), *BYTES, parameters={"crs": _CRS}),
    "GEOGRAPHY": Kind("BYTE_ARRAY", "GEOGRAPHY", T.BinaryType(), *BYTES, parameters={"crs": _CRS, "algorithm": ("algorithm", "SPHERICAL", one_of(*ALGORITHMS))}),
}
#: What a column of each Spark type is when nothing is declared; wall clocks and decimals are handled in :func:`natural`.
NATURAL = {T.BooleanType: "BOOLEAN", T.ByteType: "INT32", T.ShortType: "INT32", T.IntegerType: "INT32", T.LongType: "INT64", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.StringType: "STRING", T.DateType: "DATE", T.TimestampType: "TIMESTAMP", T.BinaryType: "BINARY"}
LOCAL = "unit=MICROS, adjusted_to_utc=false"


def declared(name: str, spec: object) -> WriteField:
    """A field from a type's name or from a dict of ``type``, ``repetition_type`` and the type's own parameters."""
    given = {"type": spec} if isinstance(spec, str) else dict(spec) if isinstance(spec, dict) else {}
    at = "type"
    try:
        label = one_of("AUTO", *KINDS)(given.pop("type", None))
        at, value = "repetition_type", given.pop("repetition_type", None)
        repetition = one_of(*REPETITIONS)(value) if value is not None else "AUTO"
        if label == "AUTO":
            kind, known = None, {}
        else:
            kind, known = KINDS[label], KINDS[label].parameters
        for at in given:
            if at not in known:
                raise SchemaError(f"{label} has no such parameter")
        details = []
        for at, (shown, default, parse) in known.items():
            details.append(f"{shown}={parse(default if given.get(at) is None else given[at])}")
    except SchemaError as e:
        raise SchemaError(f"{name}, {at}: {e}") from None
    if kind is None:
        return WriteField(name, "AUTO", repetition_type=repetition)
    return WriteField(name, kind.physical, kind.logical, ", ".join(details) or None, repetition)


def repeated(names: Iterable[str]) -> list[str]:
    seen: set[str] = set()
    return [n for n in names if n in seen or seen.add(n)]


def parquet_schema(columns: dict[str, object] | list[tuple[str, object]] | None = None, **more) -> list[WriteField]:
    """A declaration from ``name=type`` or ``name={"type": ..., ...}`` entries; types in any case."""
    entries = [*(columns.items() if isinstance(columns, dict) else columns or ()), *more.items()]
    if not all(n for n, _ in entries):
        raise SchemaError("every entry needs a column's name")
    if twice := repeated(n for n, _ in entries):
        raise SchemaError(f"{twice[0]} has two entries")
    return [declared(n, s) for n, s in entries]


def natural(name: str, kind: T.DataType) -> WriteField:
    """What a Spark type is written as when nothing is declared."""
    if isinstance(kind, T.DecimalType):
        physical = "INT32" if kind.precision <= 9 else "INT64" if kind.precision <= 18 else "FIXED_LEN_BYTE_ARRAY"
        return WriteField(name, physical, "DECIMAL", f"precision={kind.precision}, scale={kind.scale}")
    if isinstance(kind, T.TimestampNTZType):
        return WriteField(name, "INT64", "TIMESTAMP", LOCAL)
    if type(kind) not in NATURAL:
        raise SchemaError(f"{name}: no flat column of Parquet holds {kind.simpleString()}")
    return declared(name, NATURAL[type(kind)])


def kind_of(w: WriteField) -> Kind | None:
    """The table's entry of a field; None for decimals and wall clocks, which are written as they are."""
    if w.logical_type == "DECIMAL" or w.logical_details == LOCAL:
        return None
    return next(k for k in KINDS.values() if (k.physical, k.logical) == (w.physical_type, w.logical_type))


def column(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def checked_names(df: DataFrame) -> None:
    if not df.columns:
        raise SchemaError("a table without columns can't be written")
    if twice := repeated(df.columns):
        raise SchemaError(f"two columns are called {twice[0]}; names must be unique")


def merged(df: DataFrame, entries: list[WriteField] | None) -> list[WriteField]:
    """The natural schema with the declared entries in place; AUTO keeps the type but may set the repetition."""
    checked_names(df)
    wanted = {w.name: w for w in entries or ()}
    if lost := wanted.keys() - set(df.columns):
        raise SchemaError(f"the schema declares {', '.join(sorted(lost))}, a missing column")
    out = []
    for f in df.schema.fields:
        w = wanted.get(f.name, WriteField(f.name, "AUTO"))
        out.append(replace(natural(f.name, f.dataType), repetition_type=w.repetition_type) if w.physical_type == "AUTO" else w)
    return out


def faults(w: WriteField, now: T.DataType) -> list[Fault]:
    """What may be wrong with a column's values; a SchemaError if its type already is."""
    kind = kind_of(w)
    if kind is None:
        return []
    if not isinstance(now, kind.takes):
        raise SchemaError(f"{w.name}: {kind.logical or kind.physical} is made from {kind.made_from}, not {now.simpleString()}")
    return [(f"{w.name}: {says}", bad) for says, bad in kind.faults(column(w.name), now)]


def absent(w: WriteField) -> str:
    return f"{w.name}: declared REQUIRED, but it has nulls"


def resolve(df: DataFrame, entries: list[WriteField] | None = None) -> list[WriteField]:
    """The schema to write, with every repetition settled, after checking all values in one aggregation.

    Columns that Spark knows to be never null need no look at the data for
    their repetition.
    """
    fields = merged(df, entries)
    types = {f.name: f.dataType for f in df.schema.fields}
    open_to_null = [w.name for w in fields if df.schema[w.name].nullable and w.repetition_type != "OPTIONAL"]
    known = [fault for w in fields for fault in faults(w, types[w.name])]
    asked = [column(n).isNull() for n in open_to_null] + [bad for _, bad in known]
    answers = df.agg(*[F.coalesce(F.bool_or(x), F.lit(False)).alias(str(i)) for i, x in enumerate(asked)]).first() if asked else ()
    for (says, _), bad in zip(known, answers[len(open_to_null) :], strict=True):
        if bad:
            raise SchemaError(says)
    with_nulls = {n for n, some in zip(open_to_null, answers, strict=False) if some}
    out = []
    for w in fields:
        if w.repetition_type == "REQUIRED" and w.name in with_nulls:
            raise SchemaError(absent(w))
        if w.repetition_type == "AUTO":
            w = replace(w, repetition_type="OPTIONAL" if w.name in with_nulls else "REQUIRED")
        out.append(w)
    return out


def guarded(w: WriteField, now: T.DataType) -> F.Column:
    """The column as it is to be written; a bad value fails the write even if it came after the check."""
    c, kind = column(w.name), kind_of(w)
    for says, bad in faults(w, now):
        c = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(says).cast(now)).otherwise(c)
    if kind is None or isinstance(now, type(kind.written)):
        return c
    return F.date_from_unix_date(c.cast("int")) if isinstance(kind.written, T.DateType) else c.cast(kind.written)


def infer_parquet_schema(df: DataFrame) -> DataFrame:
    """``name, physical_type, logical_type, logical_details, repetition_type`` that a write would settle on."""
    return df.sparkSession.createDataFrame([astuple(w) for w in resolve(df)], WRITE_SCHEMA)


def frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A table from lists of Python values by column name.

    Lists of different lengths are refused, not repeated; a column's type is
    that of its values, and one without values is text.
    """
    if not columns:
        raise SchemaError("a table without columns can't be written")
    sizes = {n: len(v) for n, v in columns.items()}
    if len(set(sizes.values())) > 1:
        raise SchemaError("columns differ in length: " + ", ".join(f"{n} has {k}" for n, k in sizes.items()))
    kinds = {n: next((T._infer_type(x) for x in v if x is not None), T.StringType()) for n, v in columns.items()}
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), T.StructType([T.StructField(n, k, True) for n, k in kinds.items()]))
