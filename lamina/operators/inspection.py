"""A file's metadata as relations, bloom filter membership, and structural checks."""

from __future__ import annotations

import datetime
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import geo
from lamina.plans.types import Leaf
from lamina.session import run_dir
from lamina.sources.compact import Reader, get, read
from lamina.sources.footer import ENCRYPTED, MAGIC, FooterError, bound, fetched, hadoop, read_footer, tree_of
from lamina.sources.scan import ParquetFile

#: A bound in the type that its physical type has; at most one field is set.
BOUND = "struct<b:boolean,i:bigint,d:double,s:string,x:binary>"


def schema(f: ParquetFile) -> DataFrame:
    rows = [(x.column, x.name, x.path, x.physical_type, x.logical_type, x.logical_details, x.repetition_type, x.type_length, x.max_definition_level, x.max_repetition_level) for x in f.footer.leaves]
    return f.spark.createDataFrame(rows, "column int, name string, path string, physical_type string, logical_type string, logical_details string, repetition_type string, type_length int, max_definition_level int, max_repetition_level int")


def row_groups(f: ParquetFile) -> DataFrame:
    return f.spark.createDataFrame([(g.row_group, g.rows, g.compressed_bytes, g.uncompressed_bytes) for g in f.footer.row_groups], "row_group int, rows long, compressed_bytes long, uncompressed_bytes long")


def column_chunks(f: ParquetFile) -> DataFrame:
    """Encodings are comma-joined in alphabetical order."""
    rows = [(c.row_group, c.column, c.path, c.physical_type, c.compression, c.num_values, c.compressed_bytes, c.uncompressed_bytes, ",".join(c.encodings), c.dictionary_page, c.bloom_filter, c.page_index) for c in f.footer.chunks]
    return f.spark.createDataFrame(rows, "row_group int, column int, path string, physical_type string, compression string, num_values long, compressed_bytes long, uncompressed_bytes long, encodings string, dictionary_page boolean, bloom_filter boolean, page_index boolean")


def column_statistics(f: ParquetFile) -> DataFrame:
    """Bounds are physical: timestamps and decimals unscaled, text only where it is annotated and valid.

    Zero-length bounds count as absent.
    """
    leaves = f.footer.leaves
    rows = [(c.row_group, c.column, c.path, c.num_values, c.null_count, c.distinct_count, bound(c.min, leaves[c.column - 1]), bound(c.max, leaves[c.column - 1])) for c in f.footer.chunks]
    return f.spark.createDataFrame(rows, f"row_group int, column int, path string, num_values long, null_count long, distinct_count long, min {BOUND}, max {BOUND}")


#: Bytes of page indexes that one call fetches at most.
AT_ONCE = 64 << 20


def page_index(f: ParquetFile) -> DataFrame:
    """One row for each page that an index describes; a side that is missing leaves its columns null.

    The indexes lie together behind the data; they come over in a few large pieces.
    """
    f.still_open()
    # (row group, column, side, offset, bytes) of every index; side 0 says where pages are, side 1 what is in them.
    known = [(g, i, side, get(c, 4 + 2 * side), get(c, 5 + 2 * side)) for g, group in enumerate(get(f.tree, 4, (0, []))[1], 1) for i, c in enumerate(get(group, 1)[1]) for side in (0, 1) if 4 + 2 * side in c]
    found: dict[tuple[int, int, int], dict] = {}
    pieces: list[list] = []
    for x in sorted(known, key=lambda x: x[3]):
        if not pieces or x[3] + x[4] - pieces[-1][0][3] > AT_ONCE:
            pieces.append([])
        pieces[-1].append(x)
    for piece in pieces:
        start = piece[0][3]
        raw = fetched(f.spark, f.path, start, max(x[3] + x[4] for x in piece) - start)
        for g, i, side, at, size in piece:
            found[g, i, side] = read(raw[at - start : at - start + size])
    rows, values = [], lambda index, field: get(index, field, (0, []))[1]
    for g, i in sorted({x[:2] for x in known}):
        places, content, leaf = values(found.get((g, i, 0), {}), 1), found.get((g, i, 1), {}), f.footer.leaves[i]
        empty, lows, highs, nulls = (values(content, k) for k in (1, 2, 3, 5))
        for p in range(len(places) or len(empty)):
            null_page = empty[p] if p < len(empty) else None
            ends = [bound(side[p] if null_page is False else None, leaf) for side in (lows, highs)] if empty else [bound(None, leaf)] * 2
            place = (get(places[p], 3), get(places[p], 1), get(places[p], 2)) if places else (None, None, None)
            rows.append((g, i + 1, leaf.path, p + 1, *place, nulls[p] if p < len(nulls) else None, null_page, *ends))
    return f.spark.createDataFrame(rows, f"row_group int, column int, path string, page int, first_row long, offset long, compressed_bytes int, null_count long, null_page boolean, min {BOUND}, max {BOUND}")


def metadata(f: ParquetFile) -> DataFrame:
    """``key, value`` of the footer, in its order; keys may repeat, values be absent."""
    return f.spark.createDataFrame([tuple(x) for x in f.footer.metadata], "key string, value string")


def sorting(f: ParquetFile) -> DataFrame:
    """``row_group, position, column, path, descending, nulls_first``: the order that each row group declares."""
    rows = [(g.row_group, i, c, f.footer.leaves[c - 1].path, d, n) for g in f.footer.row_groups for i, (c, d, n) in enumerate(g.sorting, 1)]
    return f.spark.createDataFrame(rows, "row_group int, position int, column int, path string, descending boolean, nulls_first boolean")


GEOSPATIAL = "row_group int, column int, path string, " + ", ".join(f"{b} double" for b in geo.BOX) + ", geometry_types array<int>"


def geospatial_statistics(f: ParquetFile, columns: Sequence[str] | None = None) -> DataFrame:
    """Bounding box and geometry types of each row group and geospatial column, as the footer has them.

    There is a row for each, also where the footer says nothing.  Columns of
    well-known binary that aren't marked as geospatial may be named in
    ``columns``; theirs are computed from the values, by row group, partially
    aggregated before the shuffle.
    """
    marked = [x for x in f.footer.leaves if x.logical_type in ("GEOMETRY", "GEOGRAPHY") and (columns is None or x.path in columns)]
    numbers = {x.column for x in marked}
    rows = [(c.row_group, c.column, c.path, *(c.box or [None] * 8), list(c.geometry_types) if c.geometry_types is not None else None) for c in f.footer.chunks if c.column in numbers]
    out = f.spark.createDataFrame(rows, GEOSPATIAL)
    for leaf in [x for x in f.footer.leaves if columns is not None and x.path in columns and x.column not in numbers]:
        values = f.raw([r for r in f.plan() if r.column == leaf.column])
        own = geo.statistics(values.select((f.group_index() + 1).cast("int").alias("row_group"), F.col(f"`{leaf.path}`").alias("wkb")), ["row_group"])
        groups = f.spark.createDataFrame([(g.row_group,) for g in f.footer.row_groups], "row_group int")
        out = out.unionAll(groups.join(own, "row_group", "left").select("row_group", F.lit(leaf.column).alias("column"), F.lit(leaf.path).alias("path"), *geo.BOX, "geometry_types"))
    return out


def reduced(value, leaf: Leaf):
    """A looked-for value as what the column stores; raises where the column could never hold the value's kind.

    Answering "absent" for a value of the wrong kind would hide a mistake.
    """
    kind, physical = leaf.logical_type, leaf.physical_type
    if physical in ("BOOLEAN", "INT96"):
        raise ValueError(f"bloom filters aren't defined for {physical}.")
    if physical in ("INT32", "INT64"):
        if kind == "DATE" and isinstance(value, datetime.date):
            value = (value - datetime.date(1970, 1, 1)).days
        if isinstance(value, bool) or not isinstance(value, int | float) or value != int(value):
            raise ValueError(f"{value!r} isn't a whole number, as column `{leaf.path}` holds.")
        value, bits = int(value), 32 if physical == "INT32" else 64
        unsigned = kind == "INTEGER" and leaf.details.get("signed") == "false"
        low, high = (0, (1 << bits) - 1) if unsigned else (-(1 << (bits - 1)), (1 << (bits - 1)) - 1)
        if not low <= value <= high:
            raise ValueError(f"{value} is out of the range of column `{leaf.path}`.")
        return struct.pack("<i" if bits == 32 else "<q", value - (1 << bits) if value >= 1 << (bits - 1) else value)
    if physical in ("FLOAT", "DOUBLE"):
        if isinstance(value, bool) or not isinstance(value, int | float):
            raise ValueError(f"{value!r} isn't a number, as column `{leaf.path}` holds.")
        return struct.pack("<f" if physical == "FLOAT" else "<d", value)
    if kind in ("STRING", "ENUM", "JSON"):
        if not isinstance(value, str):
            raise ValueError(f"{value!r} isn't text, as column `{leaf.path}` holds.")
        return value.encode()
    if not isinstance(value, bytes | bytearray):
        raise ValueError(f"{value!r} isn't bytes, as column `{leaf.path}` holds.")
    if leaf.type_length and len(value) != leaf.type_length:
        raise ValueError(f"column `{leaf.path}` holds values of {leaf.type_length} bytes.")
    return bytes(value)


#: Fixed by the format: the odd numbers that pick a bit in each of a block's eight words.
SALT = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], dtype=np.uint32)


def bloom_bits(f: ParquetFile, row_group: int, leaf: Leaf) -> np.ndarray | None:
    """The filter's blocks of eight 32-bit words, or None if the column chunk has no filter."""
    meta = get(get(get(f.tree, 4)[1][row_group - 1], 1)[1][leaf.column - 1], 3, {})
    if 14 not in meta:
        return None
    header = Reader(fetched(f.spark, f.path, get(meta, 14), min(64, f.size - get(meta, 14))))
    size = get(header.struct(), 1)
    return np.frombuffer(fetched(f.spark, f.path, get(meta, 14) + header.at, size), "<u4").reshape(-1, 8)


def bloom_filter_may_contain(f: ParquetFile, column: str, values: Sequence, row_group: int = 1) -> list[bool | None]:
    """Whether each value may be in the row group; False is certain, None stands for None.

    The filter comes over once; values are hashed as the plain bytes that the
    column would store, and looked up all together.
    """
    f.still_open()
    (number,) = f.groups([row_group])
    leaf = next((x for x in f.footer.leaves if x.path == column), None)
    if leaf is None:
        raise ValueError(f"the file has no column `{column}`")
    plain = [None if v is None else reduced(v, leaf) for v in values]
    blocks = bloom_bits(f, number, leaf)
    if blocks is None:
        raise ValueError(f"column `{column}` has no bloom filter in row group {number}.")
    return looked_up(blocks, plain)


def looked_up(blocks: np.ndarray, plain: Sequence[bytes | None]) -> list[bool | None]:
    """Whether a filter's blocks hold the hash of each value's plain bytes; None stands for None."""
    some = [i for i, p in enumerate(plain) if p is not None]
    out: list[bool | None] = [None] * len(plain)
    h = np.array([xxhash.xxh64_intdigest(plain[i]) for i in some], dtype=np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(len(blocks)) >> np.uint64(32)).astype(np.int64)
    bits = np.uint32(1) << ((h & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None] * SALT[None, :] >> np.uint32(27))
    for i, held in zip(some, ((blocks[block] & bits) == bits).all(axis=1).tolist(), strict=True):
        out[i] = held
    return out


#: Bytes of bloom filters that one call fetches at most, if one filter has less; a look-up sends each piece out again, from the driver's memory.
FILTERS_AT_ONCE = 2 << 20


def bloom_filters(f: ParquetFile, leaf: Leaf) -> Iterator[list[tuple[int, bytes]]]:
    """(row group, blocks) of each filter of a column, in pieces; filters lie together, and a piece comes over in one call."""
    pieces: list[list] = []
    for g, group in enumerate(get(f.tree, 4, (0, []))[1], 1):
        meta = get(get(group, 1)[1][leaf.column - 1], 3, {})
        if 14 not in meta:
            continue
        x = g, get(meta, 14), get(meta, 15)
        # Without a length in the footer a filter is fetched by its own header.
        if not pieces or x[2] is None or pieces[-1][0][2] is None or not 0 <= x[1] + x[2] - pieces[-1][0][1] <= FILTERS_AT_ONCE:
            pieces.append([])
        pieces[-1].append(x)
    for piece in pieces:
        if piece[0][2] is None:
            yield [(g, bloom_bits(f, g, leaf).tobytes()) for g, _, _ in piece]
            continue
        start = min(at for _, at, _ in piece)
        raw, out = fetched(f.spark, f.path, start, max(at + n for _, at, n in piece) - start), []
        for g, at, n in piece:
            header = Reader(raw[at - start : at - start + n])
            size = get(header.struct(), 1)
            out.append((g, header.raw[header.at : header.at + size]))
        yield out


def bloom_filter_members(f: ParquetFile, column: str, values: DataFrame) -> DataFrame:
    """``row_group, value, found`` for the rows of ``values`` (``row_group int, value``): the distributed form of a look-up.

    Filters go through the shared folder, a piece at a time, and meet the
    values of their row group in a task.  The same errors are raised there.
    """
    f.still_open()
    leaf = next((x for x in f.footer.leaves if x.path == column), None)
    if leaf is None:
        raise ValueError(f"the file has no column `{column}`")
    kind = values.schema["value"].dataType
    folder, held = f"{run_dir(f.spark)}/filters-{uuid.uuid4().hex}", "row_group int, filter binary"
    f.spark.createDataFrame([], held).write.parquet(folder)
    for piece in bloom_filters(f, leaf):
        groups, blocks = zip(*piece, strict=True)
        f.spark.createDataFrame(pa.table({"row_group": pa.array(groups, pa.int32()), "filter": pa.array(blocks, pa.binary())})).write.mode("append").parquet(folder)

    def probe(key: tuple, asked: pa.Table, own: pa.Table) -> pa.Table:
        some = asked.column("value").to_pylist()
        if some and not own.num_rows:
            raise ValueError(f"column `{column}` has no bloom filter in row group {key[0].as_py()}.")
        blocks = np.frombuffer(own.column("filter")[0].as_py(), "<u4").reshape(-1, 8) if some else None
        found = looked_up(blocks, [None if v is None else reduced(v, leaf) for v in some]) if some else []
        return pa.table({"row_group": asked.column("row_group"), "value": asked.column("value"), "found": pa.array(found, pa.bool_())})

    filters = f.spark.read.schema(held).parquet(folder)
    both = values.select("row_group", "value").groupBy("row_group").cogroup(filters.groupBy("row_group"))
    return both.applyInArrow(probe, T.StructType([T.StructField("row_group", T.IntegerType()), T.StructField("value", kind), T.StructField("found", T.BooleanType())]))


def _declared(spark: SparkSession, path: str) -> Iterator[tuple[str, bool]]:
    """What a whole file must be, in the order in which it is looked at: what is wrong otherwise, and whether it holds.

    Each is asked only if all before it hold.
    """
    fs, at = hadoop(spark, path)
    yield f"no file at {path}", fs.exists(at)
    status = fs.getFileStatus(at)
    yield f"{path} is a directory", not status.isDirectory()
    size = status.getLen()
    yield f"{path}: {size} bytes are too few for a Parquet file", size >= 12
    ends = fetched(spark, path, 0, 4), fetched(spark, path, size - 4, 4)
    yield "the footer is encrypted", ENCRYPTED not in ends
    for mark, where in zip(ends, ("its start", "its end; it may be cut off, or not written out"), strict=True):
        yield f"no Parquet marker at {where}", mark == MAGIC
    try:
        tree, body = tree_of(spark, path)
        f = read_footer(spark, path)
    except FooterError as e:
        yield f"both markers are there, but {e}", False
        return
    yield f"{f.declared_rows} rows are declared, {f.rows} are in row groups", f.declared_rows == f.rows
    leaves = len(f.leaves)
    for g, group in enumerate(get(tree, 4, (0, []))[1], 1):
        n = len(get(group, 1)[1])
        yield f"row group {g} has {n} column chunks for {leaves} columns", n == leaves
        for c in (get(x, 3, {}) for x in get(group, 1)[1]):
            start = min(x for x in (get(c, 9), get(c, 11)) if x)
            yield f"row group {g}: a column chunk lies outside the data", 4 <= start and start + get(c, 7, 0) <= body


def validate_parquet(spark: SparkSession, path: str) -> bool:
    """True, or a ValueError with the first problem of the file's structure.  Data pages aren't read."""
    for problem, holds in _declared(spark, path):
        if not holds:
            raise ValueError(problem)
    return True
