"""Typed writes: one file, checked before a byte is written, and safe appends."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.dataframe import DataFrame as ClassicDataFrame

from lamina.functions import converters, geo
from lamina.plans.types import Leaf
from lamina.plans.write_schema import SchemaError, WriteField, absent, checked_names, column, frame, guarded, resolve
from lamina.sources import compact
from lamina.sources.footer import ALGORITHMS, BOX, copy_with_footer, hadoop, read_footer, tree_of
from lamina.sources.scan import DOWNLOADED, open_parquet

#: Names of this API -> Spark's; lz4 means the format's LZ4_RAW, not the deprecated framing.
CODECS = {"snappy": "snappy", "zstd": "zstd", "gzip": "gzip", "lz4": "lz4_raw", "uncompressed": "uncompressed"}
#: A value of each type that can be written.
NEVER = {"boolean": False, "int": 0, "bigint": 0, "float": 0.0, "double": 0.0, "string": "", "binary": b"", "date": datetime.date(1970, 1, 1), "timestamp": datetime.datetime(1970, 1, 1)}
#: Bytes of a row group whose rows are counted; Parquet's writer takes less where the heap is smaller.
BY_ROWS = 1 << 31
#: The share of absent values that a bloom filter may take for present, where it is sized by its row group's rows.
FALSE_POSITIVES = 1e-4
#: Field metadata key under which files of a dataset carry a sort order; a single file has it in its footer.
SORTED = "lamina.sorted_by"
SPARKS_OWN = "org.apache.spark."
#: Names the keys that were given without a value: Spark's reader fails on files that have such, so they get an empty one.
VALUELESS = "lamina.keys_without_value"


def checked_metadata(metadata) -> list[tuple[str, str | None]]:
    """Ordered pairs; a dict or a list of pairs, so that keys may repeat; None as a value is a key without one."""
    if metadata is None:
        return []
    pairs = list(metadata.items()) if isinstance(metadata, dict) else [tuple(p) for p in metadata]
    for p in pairs:
        if len(p) != 2 or not isinstance(p[0], str) or not p[0] or not (p[1] is None or isinstance(p[1], str)):
            raise ValueError("metadata: expected texts (or None) by non-empty names")
    return pairs


def checked_sort(sorted_by, columns: Sequence[str]) -> list[dict]:
    """Column, direction and place of nulls of each sort key; unknown and repeated columns are errors."""
    if sorted_by is None:
        return []
    entries = [sorted_by] if isinstance(sorted_by, str) else list(sorted_by)
    out = []
    for e in entries:
        e = {"name": e} if isinstance(e, str) else dict(e)
        key = {"name": e.pop("name", None), "descending": e.pop("descending", False), "nulls_first": e.pop("nulls_first", False)}
        if e or not isinstance(key["name"], str):
            raise ValueError("sorted_by: a key has name, descending and nulls_first")
        if not isinstance(key["descending"], bool) or not isinstance(key["nulls_first"], bool):
            raise ValueError("sorted_by: descending and nulls_first are True or False")
        if key["name"] not in columns:
            raise ValueError(f"sorted_by: there is no column {key['name']}")
        if key["name"] in [k["name"] for k in out]:
            raise ValueError(f"sorted_by: {key['name']} comes more than once")
        out.append(key)
    return out


def sort_columns(keys: list[dict]) -> list[F.Column]:
    return [getattr(column(k["name"]), ("desc" if k["descending"] else "asc") + ("_nulls_first" if k["nulls_first"] else "_nulls_last"))() for k in keys]


def checked_rows(row_group_size) -> int | None:
    if row_group_size is None:
        return None
    if isinstance(row_group_size, bool) or not isinstance(row_group_size, int | float) or row_group_size != row_group_size or row_group_size in (float("inf"),) or row_group_size < 1 or row_group_size != int(row_group_size):
        raise ValueError("row_group_size: expected a whole number of rows, or None")
    return int(row_group_size)


def cast(df: DataFrame, fields: list[WriteField], notes: dict) -> DataFrame:
    """The columns as declared, guarded against bad values, with their nullability and notes in the schema."""
    chosen = []
    for i, w in enumerate(fields):
        c = guarded(w, df.schema[w.name].dataType)
        now = df.select(c.alias("c")).schema["c"]
        if w.repetition_type == "REQUIRED" and now.nullable:
            # The last value is never reached; it tells Catalyst that there are no nulls.
            kind = now.dataType.simpleString()
            never = F.lit(NEVER[kind]) if kind in NEVER else F.lit(0) if isinstance(now.dataType, T.DecimalType) else F.lit("1970-01-01 00:00:00")
            c = F.coalesce(c, F.raise_error(absent(w)).cast(now.dataType), never.cast(now.dataType))
        elif w.repetition_type == "OPTIONAL" and not now.nullable:
            c = F.try_element_at(F.create_map(F.lit(0), c), F.lit(0))  # may be null, as far as Catalyst can tell
        chosen.append(c.alias(w.name, metadata=dict(notes) if i == 0 else {}))
    return df.select(*chosen)


def with_setting(df: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` in a copy of its session with another setting; the session itself keeps its own."""
    spark = df.sparkSession
    own = spark._jsparkSession.cloneSession()
    own.conf().set(key, value)
    plan = df._jdf.queryExecution().analyzed()
    return ClassicDataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own, plan), SparkSession(spark.sparkContext, own))


def in_unit(df: DataFrame, unit: str | None) -> DataFrame:
    return with_setting(df, "spark.sql.parquet.outputTimestampType", f"TIMESTAMP_{unit}") if unit else df


def annotated(tree: dict, fields: list[WriteField], pairs: list[tuple[str, str | None]], keys: list[dict], statistics: dict[tuple[int, int], tuple]) -> dict:
    """The footer's tree with what Spark's writer has no place for: keys, sort order, geospatial annotations and statistics."""
    text = lambda s: (compact.BINARY, s.encode())
    out = dict(tree)
    if pairs:
        bare = [i for i, (_, v) in enumerate(pairs) if v is None]
        more = [{1: text(k), 2: text(v or "")} for k, v in [*pairs, *([(VALUELESS, json.dumps(bare))] if bare else [])]]
        out[5] = (compact.LIST, (compact.STRUCT, compact.get(tree, 5, (0, []))[1] + more))
    marked = {i: w for i, w in enumerate(fields) if w.logical_type in ("GEOMETRY", "GEOGRAPHY")}
    if marked:
        elements = list(compact.get(tree, 2)[1])
        for i, w in marked.items():
            about = dict(x.split("=", 1) for x in w.logical_details.split(", "))
            kind = {1: text(about["crs"])}
            if w.logical_type == "GEOGRAPHY":
                kind[2] = (compact.I32, ALGORITHMS.index(about["algorithm"]))
            elements[i + 1] = elements[i + 1] | {10: (compact.STRUCT, {17 if w.logical_type == "GEOMETRY" else 18: (compact.STRUCT, kind)})}
        out[2] = (compact.LIST, (compact.STRUCT, elements))
    names = [w.name for w in fields]
    order = [{1: (compact.I32, names.index(k["name"])), 2: (compact.TRUE, k["descending"]), 3: (compact.TRUE, k["nulls_first"])} for k in keys]
    groups = []
    for g, group in enumerate(compact.get(tree, 4, (0, []))[1], 1):
        group = dict(group)
        if order:
            group[4] = (compact.LIST, (compact.STRUCT, order))
        chunks = list(group[1][1][1])
        for i in marked:
            # The order of such bytes is undefined, so they have no bounds; what they have instead is a box.
            meta = dict(compact.get(chunks[i], 3))
            meta[12] = (compact.STRUCT, {k: v for k, v in compact.get(meta, 12, {}).items() if k == 3})
            box, kinds = statistics.get((g, i), (None, None))
            found = {}
            if box is not None:
                found[1] = (compact.STRUCT, {n + 1: (compact.DOUBLE, v) for n, v in enumerate(box) if v is not None})
            if kinds is not None:
                found[2] = (compact.LIST, (compact.I32, list(kinds)))
            if found:
                meta[17] = (compact.STRUCT, found)
            chunks[i] = chunks[i] | {3: (compact.STRUCT, meta)}
        group[1] = (compact.LIST, (compact.STRUCT, chunks))
        groups.append(group)
    out[4] = (compact.LIST, (compact.STRUCT, groups))
    return out


def _geospatial(spark: SparkSession, path: str, fields: list[WriteField]) -> dict[tuple[int, int], tuple]:
    """(box, types) of each row group and geospatial column of a file that has been written."""
    found = {}
    f = open_parquet(spark, path)
    for i, w in enumerate(fields):
        if w.logical_type in ("GEOMETRY", "GEOGRAPHY"):
            rows = f.raw([r for r in f.plan() if r.path == w.name]).select((f.group_index() + 1).alias("row_group"), column(w.name).alias("wkb"))
            for r in geo.statistics(rows, ["row_group"], box=w.logical_type == "GEOMETRY").collect():  # a row for each row group
                box = tuple(r[b] for b in BOX) if r.xmin is not None else None
                found[r.row_group, i] = (box, r.geometry_types)
    return found


def _written(df: DataFrame, path: str, compression: str, row_group_size: int | None, fields: list[WriteField], pairs: list, keys: list[dict], bloom: Sequence[str] = ()) -> None:
    """Writes ``df`` as one file: into a folder beside it, then in its place.

    Where the footer is to say more than Spark's does, the finished file is
    copied once with another footer.  The file system's renames aren't atomic
    exchanges: where a file is replaced there is a moment without one.
    """
    spark = df.sparkSession
    fs, at = hadoop(spark, path)
    folder = f"{at.getParent()}/.{at.getName()}-{uuid.uuid4().hex}"
    writer = in_unit(df.coalesce(1), _unit(fields)).write.option("compression", CODECS[compression])
    if row_group_size:
        # Rows decide, not bytes, where a row group ends, as far as the task's memory lets it.
        writer = writer.option("parquet.block.row.count.limit", row_group_size).option("parquet.block.size", BY_ROWS)
    for w in fields:  # only text gets a dictionary
        if w.logical_type != "STRING":
            writer = writer.option(f"parquet.enable.dictionary#{w.name}", "false")
    for name in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        if row_group_size:  # a row group has no more values; else each filter has 1 MB, and all are held until the file ends
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", row_group_size).option(f"parquet.bloom.filter.fpp#{name}", FALSE_POSITIVES)
    _, temporary = hadoop(spark, folder)
    try:
        writer.parquet(folder)
        parts = [s.getPath() for s in fs.listStatus(temporary) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {folder}, found {len(parts)}")
        done = parts[0]
        if pairs or keys or any(w.logical_type in ("GEOMETRY", "GEOGRAPHY") for w in fields):
            source, target = done.toString(), f"{folder}/whole.parquet"
            tree, body = tree_of(spark, source)
            copy_with_footer(spark, source, target, annotated(tree, fields, pairs, keys, _geospatial(spark, source, fields)), body)
            done = spark._jvm.org.apache.hadoop.fs.Path(target)
        # The old file gives way only now that the new one is whole.
        spare = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}-old")
        had = fs.exists(at)
        if had and not fs.rename(at, spare):
            raise OSError(f"can't replace {path}")
        if not fs.rename(done, at):
            if had:
                fs.rename(spare, at)
            raise OSError(f"can't write {path}")
        if had:
            fs.delete(spare, True)
        for n in (at.getName(), done.getName()):  # checksums that belong to the old name
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{n}.crc"), False)
    finally:
        fs.delete(temporary, True)


def _unit(fields: list[WriteField]) -> str | None:
    """The unit of the file's instants, or None if it has none."""
    units = {w.logical_details.split("=")[1].split(",")[0] for w in fields if w.logical_type == "TIMESTAMP" and w.logical_details.endswith("=true")}
    if "NANOS" in units:
        raise SchemaError("Spark's timestamps hold microseconds; TIMESTAMP(NANOS) can't be written.")
    if len(units) > 1:
        raise SchemaError("All TIMESTAMP columns of a file must have one unit.")
    return units.pop() if units else None


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", schema: list[WriteField] | None = None, row_group_size: int | None = None, metadata=None, sorted_by=None, append: bool = False, *, sort: bool = False, bloom_filters: Sequence[str] = ()) -> None:
    """Writes ``df`` to the single file ``path``.

    Everything is checked before a byte is written: names, declared types,
    every value against its declaration.  ``sorted_by`` records an order in the
    footer and doesn't sort; ``sort=True`` also sorts.  ``metadata`` are footer
    keys, in their order, which may repeat; one without a value gets an empty
    one, which :func:`notes` tells apart.  Geospatial columns are annotated
    and get their statistics.  ``append`` adds rows to a file of the same
    columns, types and annotations; that rewrites the file beside the old one,
    which stays as it was if anything fails, and keeps its keys before the new
    ones.  All rows pass through one task, as one file demands; for a dataset in
    many files use :func:`write_dataset`.  For lists of values see
    :func:`lamina.plans.write_schema.frame`.
    """
    checked_names(df)
    if not isinstance(path, str) or not path:
        raise ValueError("expected a file's path")
    if DOWNLOADED.match(path):
        raise ValueError(f"can't write to a URL: {path}")
    if compression not in CODECS:
        raise ValueError(f"compression: one of {', '.join(CODECS)}")
    rows, pairs = checked_rows(row_group_size), checked_metadata(metadata)
    fields = resolve(df, schema)
    _unit(fields)
    if append:
        fields = compatible(df.sparkSession, path, fields)
    keys = checked_sort(sorted_by, df.columns)
    if unknown := [b for b in bloom_filters if b not in df.columns]:
        raise ValueError(f"bloom_filters: there is no column {', '.join(unknown)}")
    out = cast(df.orderBy(*sort_columns(keys)) if sort and keys else df, fields, {})
    if append:
        old = notes(df.sparkSession, path)
        pairs, keys = old["metadata"] + pairs, keys or old["sorted_by"]
        leaves = read_footer(df.sparkSession, path).leaves
        now = df.sparkSession.read.schema(T.StructType([T.StructField(x.path, converters.read_type(x), True) for x in leaves])).parquet(path)
        # Both sides are declared alike, so the file's rows pass the same guards.
        out = cast(now.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in out.schema.fields]).unionAll(out), [replace(w, logical_type=None, logical_details=None) if w.logical_type in ("GEOMETRY", "GEOGRAPHY") else w for w in fields], {})
    _written(out, path, compression, rows, fields, pairs, keys, bloom_filters)


#: What must agree before rows are appended: of the whole table, then of each column (its name, what of the file's leaf, what of the new field).
TABLE_AGREES = (
    ("nested columns", lambda leaves, fields: [x.path for x in leaves if x.path != x.name], lambda leaves, fields: []),
    ("number of columns", lambda leaves, fields: len(leaves), lambda leaves, fields: len(fields)),
    ("names or their order differ", lambda leaves, fields: [x.name for x in leaves], lambda leaves, fields: [w.name for w in fields]),
)
COLUMN_AGREES = ("physical_type", "logical_type", "logical_details")


def compatible(spark: SparkSession, path: str, fields: list[WriteField]) -> list[WriteField]:
    """``fields`` with the file's nullability, or a SchemaError that says how the file differs."""
    fs, at = hadoop(spark, path)
    if not fs.exists(at):
        raise SchemaError(f"nothing to append to: no file at {path}")
    leaves = read_footer(spark, path).leaves

    def same(what: str, has: object, new: object) -> None:
        if has != new:
            raise SchemaError(f"{what}: {has} in the file, {new} in the new rows")

    for what, of_file, of_rows in TABLE_AGREES:
        same(what, of_file(leaves, fields), of_rows(leaves, fields))
    pairs: list[tuple[Leaf, WriteField]] = list(zip(leaves, fields, strict=True))
    for what in COLUMN_AGREES:
        for x, w in pairs:
            same(f"{w.name}, {what}", getattr(x, what), getattr(w, what))
    for x, w in pairs:
        if (x.repetition_type, w.repetition_type) == ("REQUIRED", "OPTIONAL"):
            raise SchemaError(f"{w.name}: REQUIRED in the file, but the new rows have nulls")
    return [replace(w, repetition_type=x.repetition_type) for x, w in pairs]


def notes(spark: SparkSession, path: str) -> dict:
    """``metadata`` (the footer's pairs, but for Spark's own), ``sorted_by`` and ``logical_types`` of geospatial columns."""
    f = read_footer(spark, path)
    order = f.row_groups[0].sorting if f.row_groups else ()
    pairs = [(k, v) for k, v in f.metadata if not k.startswith(SPARKS_OWN)]
    bare = {i for k, v in pairs if k == VALUELESS for i in json.loads(v)}
    return {
        "metadata": [(k, None if i in bare else v) for i, (k, v) in enumerate(p for p in pairs if p[0] != VALUELESS)],
        "sorted_by": [{"name": f.leaves[c - 1].path, "descending": d, "nulls_first": n} for c, d, n in order],
        "logical_types": {x.path: f"{x.logical_type}({x.logical_details})" for x in f.leaves if x.logical_type in ("GEOMETRY", "GEOGRAPHY")},
    }


def write_dataset(df: DataFrame, path: str, compression: str = "snappy", schema: list[WriteField] | None = None, row_group_size: int | None = None, sorted_by=None, partition_by: Sequence[str] = (), append: bool = False, *, max_records_per_file: int | None = None) -> None:
    """Writes ``df`` as a folder of files, in parallel, with the same checks.

    The form for large data: every task writes its own file, ``append`` adds
    files by Spark's commit protocol, and ``sorted_by`` sorts within tasks so
    that row groups' bounds are narrow.  Footers are Spark's own here.
    """
    if compression not in CODECS:
        raise ValueError(f"compression: one of {', '.join(CODECS)}")
    rows, fields, keys = checked_rows(row_group_size), resolve(df, schema), checked_sort(sorted_by, df.columns)
    out = cast(df, fields, {SORTED: json.dumps(keys)} if keys else {})
    if keys:
        out = out.sortWithinPartitions(*sort_columns(keys))
    writer = in_unit(out, _unit(fields)).write.mode("append" if append else "errorifexists").option("compression", CODECS[compression])
    if rows:
        writer = writer.option("parquet.block.row.count.limit", rows)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


__all__ = ["CODECS", "SchemaError", "compatible", "frame", "notes", "write_dataset", "write_parquet"]
