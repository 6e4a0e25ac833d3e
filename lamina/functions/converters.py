"""Converter id -> the Spark type to read a leaf as, and the expression over it.

All are built-in functions, so that a scan with any of them stays within
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.plans.plan import PlanRow
from lamina.plans.types import Leaf

EXACT = 1 << 53
PER_SECOND = {"millis": 10**3, "micros": 10**6, "nanos": 10**9}


def read_type(leaf: Leaf) -> T.DataType:
    """The type to ask Spark's reader for.

    Times, nanosecond timestamps, UUID and FLOAT16, which that reader refuses
    under their annotations, are read as what stores them.
    """
    kind, physical, d = leaf.logical_type, leaf.physical_type, leaf.details
    if kind == "DECIMAL":
        return T.DecimalType(int(d["precision"]), int(d.get("scale") or 0))
    if physical == "INT32":
        if kind == "DATE":
            return T.DateType()
        if kind == "INTEGER":
            width, signed = int(d["bit_width"]), d["signed"] == "true"
            return {(8, True): T.ByteType(), (16, True): T.ShortType(), (8, False): T.ShortType(), (16, False): T.IntegerType(), (32, False): T.LongType()}.get((width, signed), T.IntegerType())
        return T.IntegerType()
    if physical == "INT64":
        if kind == "TIMESTAMP" and d.get("unit") in ("MILLIS", "MICROS"):
            return T.TimestampType() if d.get("adjusted_to_utc") == "true" else T.TimestampNTZType()
        if kind == "INTEGER" and d.get("signed") == "false":
            return T.DecimalType(20, 0)
        return T.LongType()
    if physical == "BYTE_ARRAY" and kind in ("STRING", "ENUM", "JSON"):
        return T.StringType()
    return {"BOOLEAN": T.BooleanType(), "INT96": T.TimestampType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType()}.get(physical, T.BinaryType())


def int64_double(c: Column) -> Column:
    """Exact within 2^53 either way; else null."""
    return F.when(c.between(-EXACT, EXACT), c.cast("double"))


def int64_bit64(c: Column, unsigned: bool = False) -> Column:
    """All but -2^63, which stands for missing; of unsigned values those up to 2^63 - 1."""
    if unsigned:
        return F.when(c <= F.lit((1 << 63) - 1), c.cast("long"))
    return F.when(c != F.lit(-(1 << 63)), c)


def uint32(c: Column) -> Column:
    return c.cast("double")


def int32(c: Column) -> Column:
    """-2^31 stands for missing."""
    c = c.cast("int")
    return F.when(c != F.lit(-(1 << 31)), c)


def uuid_text(c: Column, name: str = "uuid") -> Column:
    """Lower-case 8-4-4-4-12; null stays null, another width than 16 is an error."""
    h = F.lower(F.hex(c))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    text = F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit("-"), p)])
    return F.when(F.octet_length(c) == 16, text).when(c.isNotNull(), F.raise_error(f"{name}: a UUID isn't 16 bytes long").cast("string"))


def float16(c: Column, name: str = "float16") -> Column:
    """Half precision from two little-endian bytes; another width is an error."""
    h = F.hex(c)
    bits = F.conv(F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2)), 16, 10).cast("int")
    sign = F.when(bits.bitwiseAND(0x8000) != 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent, mantissa = F.shiftright(bits, 10).bitwiseAND(31), bits.bitwiseAND(1023)
    number = F.when(exponent == 0, mantissa * F.lit(2.0**-24)).otherwise((mantissa + 1024) * F.pow(F.lit(2.0), exponent - 25))
    special = F.when(mantissa == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return F.when(F.octet_length(c) == 2, sign * F.when(exponent == 31, special).otherwise(number)).when(c.isNotNull(), F.raise_error(f"{name}: a half-precision number isn't 2 bytes long").cast("double"))


def time_of_day(c: Column, unit: str, mode: str, name: str = "time") -> Column:
    """Seconds since midnight, or a TIME (to the microsecond); a value outside one day is an error."""
    per = PER_SECOND[unit]
    wrong = F.raise_error(f"{name}: a time of day is not within one day")
    inside = (c >= 0) & (c < F.lit(86_400 * per))
    if mode == "hms":
        whole = c.cast("long")
        micros = F.call_function("div", whole, F.lit(per // 10**6)) if per > 10**6 else whole * F.lit(10**6 // per)
        minutes = F.call_function("div", micros, F.lit(60_000_000)).cast("int")
        value = F.make_time((minutes / 60).cast("int"), minutes % 60, (micros % 60_000_000).cast("decimal(16,6)") / F.lit(10**6).cast("decimal(8,0)"))
        return F.when(inside, value).when(c.isNotNull(), wrong.cast("time(6)"))
    return F.when(inside, c.cast("double") / F.lit(float(per))).when(c.isNotNull(), wrong.cast("double"))


def timestamp_nanos(c: Column) -> Column:
    """Microseconds are what Spark's timestamps hold; smaller parts are cut off, toward the past."""
    return F.timestamp_micros(F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000)))


def local_instant(c: Column, tz: str) -> Column:
    """The instant that a wall clock in ``tz`` shows; within a gap it moves on, in an overlap it is the earlier one."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), c).cast("timestamp") if tz not in ("UTC", "GMT") else c.cast("timestamp")


def decimal_double(c: Column) -> Column:
    return c.cast("double")


def bad_byte(c: Column) -> Column:
    """Where (from 1) the first byte stands that isn't UTF-8 or is a NUL.

    Bytes that aren't UTF-8 become U+FFFD; a text's own such characters make
    way for as many other bytes before.
    """
    repaired = F.make_valid_utf8(F.replace(c, F.lit("\ufffd"), F.lit("???")))
    before = F.when(F.is_valid_utf8(c), F.substring_index(c, "\0", 1)).otherwise(F.substring_index(repaired, "\ufffd", 1))
    return F.octet_length(before) + 1


def text(c: Column, name: str, row: Column | None = None) -> Column:
    """The text, or an error that names column, row and byte if its bytes aren't UTF-8 or hold a NUL."""
    at = F.concat(F.lit(f"{name}: invalid UTF-8 or a NUL byte in row "), (row + 1).cast("string") if row is not None else F.lit("?"), F.lit(", byte "), bad_byte(c).cast("string"))
    return F.when(F.is_valid_utf8(c) & ~F.contains(c, F.lit("\0")), c).when(c.isNotNull(), F.raise_error(at).cast("string"))


def convert(row: PlanRow, leaf: Leaf, c: Column, *, validate_text: bool = False, row_index: Column | None = None) -> Column:
    """The plan row's conversion of a column read as ``read_type(leaf)``."""
    kind = row.converter
    if kind == "null_logical":
        return F.lit(None).cast("boolean")
    if kind == "int32":
        return int32(c)
    if kind == "uint32":
        return uint32(c)
    if kind == "int64_double":
        return int64_double(c)
    if kind == "int64_bit64":
        return int64_bit64(c, leaf.details.get("signed") == "false")
    if kind in ("float", "double"):
        return c.cast("double")
    if kind.startswith("decimal_"):
        return decimal_double(c)
    if kind == "uuid":
        return uuid_text(c, row.path)
    if kind == "float16":
        return float16(c, row.path)
    if kind.startswith("time_"):
        _, mode, unit = kind.split("_")
        return time_of_day(c, unit, mode, row.path)
    if kind.startswith("timestamp_"):
        _, anchor, unit, tz = kind.split("_", 3)
        if unit == "nanos":
            c = timestamp_nanos(c)
            return c if anchor == "utc" else local_instant(c.cast("timestamp_ntz"), tz)
        return c if anchor == "utc" else local_instant(c, tz)
    if kind == "text" and validate_text:
        return text(c, row.path, row_index)
    return c


def lossy(row: PlanRow, leaf: Leaf, c: Column) -> Column | None:
    """Whether a present value comes out as null; None if no value of the column can."""
    if row.converter == "int32":
        return c.cast("int") == F.lit(-(1 << 31))
    if row.converter == "int64_double":
        return ~c.between(-EXACT, EXACT)
    if row.converter == "int64_bit64":
        return c > F.lit((1 << 63) - 1) if leaf.details.get("signed") == "false" else c == F.lit(-(1 << 63))
    return None
