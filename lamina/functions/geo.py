"""Bounding boxes and geometry types from well-known binary."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOX = ("xmin", "xmax", "ymin", "ymax", "zmin", "zmax", "mmin", "mmax")
DEPTH = 32
#: Fixed by the format: type codes of a point, the single-part types, and those that hold geometries.
POINT, LINE, POLYGON, COLLECTIONS = 1, 2, 3, (4, 5, 6, 7)


class Invalid(ValueError):
    pass


def walk(raw: bytes) -> tuple[list[float], int]:
    """(xmin, xmax, ymin, ... with NaN where nothing was seen, ISO type code) of one geometry; Invalid if it isn't one."""
    low, high = [math.inf] * 4, [-math.inf] * 4

    def take(form: str, at: int) -> tuple[tuple, int]:
        try:
            return struct.unpack_from(form, raw, at), at + struct.calcsize(form)
        except struct.error as e:
            raise Invalid("the geometry ends too early") from e

    def points(n: int, at: int, order: str, dims: list[int]) -> int:
        for _ in range(n):
            values, at = take(f"{order}{len(dims)}d", at)
            for d, v in zip(dims, values, strict=True):
                if v == v:  # a missing coordinate bounds nothing
                    low[d], high[d] = min(low[d], v), max(high[d], v)
        return at

    def geometry(at: int, depth: int) -> tuple[int, int]:
        if depth > DEPTH:
            raise Invalid("the geometry is nested too deeply")
        (mark,), at = take("B", at)
        if mark not in (0, 1):
            raise Invalid("unknown byte order")
        order = "<" if mark else ">"
        (code,), at = take(f"{order}I", at)
        z, m = bool(code & 0x80000000), bool(code & 0x40000000)
        if code & 0x20000000:  # a reference system's number follows
            _, at = take(f"{order}I", at)
        code &= 0x1FFFFFFF
        kind, group = code % 1000, code // 1000
        if group > 3 or not 1 <= kind <= 7:
            raise Invalid(f"unknown geometry type {code}")
        z, m = z or group in (1, 3), m or group in (2, 3)
        dims = [0, 1, *([2] if z else []), *([3] if m else [])]
        if kind == POINT:
            at = points(1, at, order, dims)
        else:
            (n,), at = take(f"{order}I", at)
            for _ in range(1 if kind == LINE else n):
                if kind in COLLECTIONS:
                    at, _ = geometry(at, depth + 1)
                    continue
                size = n
                if kind == POLYGON:
                    (size,), at = take(f"{order}I", at)
                at = points(size, at, order, dims)
        return at, kind + 1000 * (z + 2 * m)

    end, code = geometry(0, 0)
    if end != len(raw):
        raise Invalid("bytes follow the geometry")
    return [x if math.isfinite(x) else math.nan for pair in zip(low, high, strict=True) for x in pair], code


def bounds(column):
    """A struct of the box, the type code and whether the value is valid WKB; null for null."""

    @F.pandas_udf(", ".join(f"{b} double" for b in BOX) + ", code int, valid boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for raw in batch:
                try:
                    box, code = walk(bytes(raw)) if raw is not None else ([math.nan] * 8, None)
                    rows.append((*box, code, True if raw is not None else None))
                except Invalid:
                    rows.append((*[math.nan] * 8, None, False))
            out = pd.DataFrame(rows, columns=[*BOX, "code", "valid"])
            yield out.astype({"code": "Int32", "valid": "boolean"})

    return run(column)


def statistics(df: DataFrame, by: list[str], wkb: str = "wkb", box: bool = True) -> DataFrame:
    """``by``, the box and the sorted ISO type codes of each group's geometries.

    A coordinate that is NaN bounds nothing; the box is there only with both x
    and y.  One invalid value leaves its group without statistics.
    """
    seen = df.select(*by, bounds(F.col(wkb)).alias("g"))
    ends = [(F.min if b.endswith("min") else F.max)(F.when(~F.isnan(f"g.{b}"), F.col(f"g.{b}"))).alias(b) for b in BOX]
    out = seen.groupBy(*by).agg(*ends, F.array_sort(F.collect_set("g.code")).alias("geometry_types"), F.coalesce(F.bool_and("g.valid"), F.lit(True)).alias("valid"))
    whole = F.col("valid") & F.lit(box) & F.col("xmin").isNotNull() & F.col("ymin").isNotNull()
    return out.select(*by, *[F.when(whole, F.col(b)).alias(b) for b in BOX], F.when(F.col("valid"), F.col("geometry_types")).alias("geometry_types"))
