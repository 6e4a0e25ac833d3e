"""Typed scans: open a file, choose columns by full path and row groups by number."""

from __future__ import annotations

import logging
import re
import urllib.request
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import converters
from lamina.plans.plan import PlanRow, ReadOptions, build_plan, plan_frame
from lamina.plans.types import Leaf
from lamina.session import run_dir
from lamina.sources.footer import Footer, bound, hadoop, parsed, read_footer, tree_of

log = logging.getLogger("lamina")
#: Schemes whose files are copied into the shared folder; any Hadoop file system is read in place.
DOWNLOADED = re.compile(r"^(https?|ftps?)://", re.I)


#: Ranges of rows that a selection of row groups is written out as; more are looked up.
RANGES = 16
#: Bytes of values that a walk fetches at a time.
SPAN = 64 << 20
PLACE = "_row_index"


def numbers(values) -> F.Column:
    """A constant array of whole numbers, however many, made by one expression."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def downloaded(spark: SparkSession, url: str) -> str:
    """A copy of the file in the shared folder, where executors can read it."""
    log.info("downloading %s", url)
    name = re.sub(r"[^A-Za-z0-9._-]", "_", url.split("?")[0].rstrip("/").rsplit("/", 1)[-1])
    path = f"{run_dir(spark)}/downloads/{uuid.uuid4().hex}/{name}"
    fs, at = hadoop(spark, path)
    try:
        with urllib.request.urlopen(url) as source:
            out = fs.create(at, True)
            try:
                while piece := source.read(8 << 20):
                    out.write(piece)
            finally:
                out.close()
    except BaseException:
        fs.delete(at, False)
        raise
    return path


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class ParquetFile:
    """An open Parquet file: its footer, and lazy reads of its data.

    Nothing stays open between calls; closing only ends the handle, and removes
    what was downloaded for it.  ``checksums`` makes the reader verify pages.
    """

    def __init__(self, spark: SparkSession, path: str, checksums: bool = True):
        if not isinstance(path, str) or not path:
            raise ValueError("expected a file's path")
        self.spark, self.asked, self.checksums, self.closed = spark, path, checksums, False
        self.path = downloaded(spark, path) if DOWNLOADED.match(path) else path
        self.footer  # noqa: B018  a file that can't be read fails here

    @cached_property
    def footer(self) -> Footer:
        return parsed(self.path, self.tree)

    @cached_property
    def tree(self) -> dict:
        return tree_of(self.spark, self.path)[0]

    @cached_property
    def size(self) -> int:
        fs, at = hadoop(self.spark, self.path)
        return fs.getFileStatus(at).getLen()

    def close(self) -> None:
        """Ends the handle; may be called again.  Tables that it gave stay readable, unless the file was downloaded for it."""
        if not self.closed and self.path != self.asked:
            fs, at = hadoop(self.spark, self.path)
            fs.delete(at, False)
        self.closed = True

    def still_open(self) -> None:
        if self.closed:
            raise ValueError(f"{self.asked} is closed")

    def __enter__(self) -> ParquetFile:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    @property
    def dim(self) -> tuple[int, int]:
        return self.footer.rows, len(self.footer.leaves)

    @property
    def names(self) -> list[str]:
        return [leaf.path for leaf in self.footer.leaves]

    def __repr__(self) -> str:
        return f"<ParquetFile {self.asked}: {self.dim[0]} rows, {self.dim[1]} columns, {len(self.footer.row_groups)} row groups>"

    def plan(self, options: ReadOptions | None = None) -> list[PlanRow]:
        return build_plan(self.footer.leaves, options)

    def selected(self, columns: Sequence[str] | None, plan: list[PlanRow]) -> list[PlanRow]:
        """The plan's rows to read, in the order asked for; nested leaves are left out with one message."""
        paths = [r.path for r in plan]
        if columns is None:
            chosen = plan
        else:
            if isinstance(columns, str):
                columns = [columns]
            if any(c is None for c in columns):
                raise ValueError("columns: a name is missing")
            for c, n in Counter(columns).items():
                if n > 1:
                    raise ValueError(f"columns: {quoted(c)} comes more than once")
                if paths.count(c) > 1:
                    raise ValueError(f"columns: {quoted(c)} is ambiguous; {paths.count(c)} leaves have this path")
                if c not in paths:
                    raise ValueError(f"columns: the file has no {quoted(c)}")
            chosen = [plan[paths.index(c)] for c in columns]
        left = [r for r in chosen if r.nested]
        if left:
            log.warning("skipping %d nested or repeated column(s) of %s", len(left), self.asked)
        return [r for r in chosen if r.collectible]

    def groups(self, row_groups: Sequence[int] | None) -> list[int] | None:
        """Row groups in file order, or None for all."""
        if row_groups is None:
            return None
        n = len(self.footer.row_groups)
        wanted = [row_groups] if isinstance(row_groups, int) else list(row_groups)
        if any(not isinstance(g, int) or isinstance(g, bool) for g in wanted) or len(set(wanted)) < len(wanted):
            raise ValueError("row_groups: expected distinct whole numbers")
        if any(not 1 <= g <= n for g in wanted):
            raise ValueError(f"row_groups: the file has groups 1 to {n}")
        return sorted(wanted)

    def raw(self, rows: list[PlanRow], row_groups: Sequence[int] | None = None, keep: Sequence = ()) -> DataFrame:
        """The chosen columns as Spark reads them, of the chosen row groups."""
        self.still_open()
        wanted = self.groups(row_groups)
        leaves = self.footer.leaves
        fields = [T.StructField(r.path, converters.read_type(leaves[r.column - 1]), True) for r in rows]
        # Columns that only a filter needs are read too, but not returned.
        for name in keep:
            if name not in [f.name for f in fields]:
                row = self.selected([name], build_plan(leaves))[0]
                fields.append(T.StructField(name, converters.read_type(leaves[row.column - 1]), True))
        around = self.bounds_of(wanted) if wanted is not None else None
        if around and around[0].path not in [f.name for f in fields]:
            fields.append(T.StructField(around[0].path, converters.read_type(around[0]), True))
        df = self.reader(rows).read.option("parquet.page.verify-checksum.enabled", str(self.checksums).lower()).schema(T.StructType(fields)).parquet(self.path)
        if wanted is not None:
            df = df.where(self.within(wanted))
            if around:
                df = df.where(F.col(quoted(around[0].path)).between(*around[1:]))
        return df

    def within(self, wanted: list[int]) -> F.Column:
        """Whether a row is in one of the wanted row groups: by ranges of the row index if they are few, else by a look-up."""
        chosen = set(wanted)
        merged: list[list[int]] = []
        for g in self.footer.row_groups:
            if g.row_group in chosen and g.rows:
                if merged and merged[-1][1] == g.first_row:
                    merged[-1][1] = g.first_row + g.rows
                else:
                    merged.append([g.first_row, g.first_row + g.rows])
        if len(merged) > RANGES:
            return F.get(numbers(int(g.row_group in chosen) for g in self.footer.row_groups), self.group_index()) == 1
        return F.expr(" OR ".join(f"(_metadata.row_index >= {a} AND _metadata.row_index < {b})" for a, b in merged) or "false")

    def group_index(self) -> F.Column:
        """The row group of each row, from 0: by division where the groups are even, else by a binary search of their first rows."""
        at, groups = F.col("_metadata.row_index"), self.footer.row_groups
        sizes = [g.rows for g in groups]
        if len(set(sizes[:-1])) <= 1 and (len(sizes) < 2 or 0 < sizes[-1] <= sizes[0]):
            return F.floor(at / F.lit(max(1, sizes[0] if sizes else 1))).cast("int")
        starts = numbers(g.first_row for g in groups)
        steps = F.lit([1 << i for i in range(len(groups).bit_length(), -1, -1)])
        # Of empty groups that begin with the same row the last is taken, which is the one that has it.
        return F.aggregate(steps, F.lit(0), lambda i, s: F.when(F.get(starts, i + s) <= at, i + s).otherwise(i))

    def bounds_of(self, wanted: list[int]) -> tuple[Leaf, int, int] | None:
        """A column and a range that holds for every row of the wanted groups, and for few other groups.

        A filter on the row index skips no data.  One on a column's values does,
        by the groups' statistics; it changes no result, as it is true of all
        wanted rows.  Only whole numbers without nulls in these groups serve.
        """
        best, others = None, len(self.footer.row_groups) - len(wanted)
        for leaf in self.footer.leaves:
            if leaf.nested or self.names.count(leaf.path) > 1 or leaf.logical_type or leaf.physical_type not in ("INT32", "INT64"):
                continue
            own = [c for c in self.footer.chunks if c.column == leaf.column]
            spans = {c.row_group: (bound(c.min, leaf)[1], bound(c.max, leaf)[1], c.null_count) for c in own}
            inside = [spans[g] for g in wanted]
            if not inside or any(lo is None or hi is None or nulls != 0 for lo, hi, nulls in inside):
                continue
            low, high = min(lo for lo, _, _ in inside), max(hi for _, hi, _ in inside)
            kept = sum(lo is None or hi is None or (lo <= high and hi >= low) for g, (lo, hi, _) in spans.items() if g not in wanted)
            if kept < others and (best is None or kept < best[0]):
                best = (kept, leaf, low, high)
        return best[1:] if best else None

    def reader(self, rows: list[PlanRow]) -> SparkSession:
        """The session to read with.

        Spark's vectorized reader can't decode BYTE_STREAM_SPLIT, and its TIME
        type has to be turned on.  Files that need either are read in a copy of
        the session, so that other reads keep their settings.
        """
        paths, settings = {r.path for r in rows}, {}
        if any("BYTE_STREAM_SPLIT" in c.encodings for c in self.footer.chunks if c.path in paths):
            settings["spark.sql.parquet.enableVectorizedReader"] = "false"
        if any((r.converter or "").startswith("time_hms") for r in rows) and self.spark.conf.get("spark.sql.timeType.enabled", "false") != "true":
            settings["spark.sql.timeType.enabled"] = "true"
        if not settings:
            return self.spark
        own = SparkSession(self.spark.sparkContext, self.spark._jsparkSession.cloneSession())
        for key, value in settings.items():
            own.conf.set(key, value)
        return own

    def collect(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, *, int64: str = "double", time: str = "numeric", tz: str = "UTC", where: str | None = None, where_columns: Sequence[str] = (), validate_text: bool = True, ordered: bool = False, verbose: bool = False, numbered: bool = False) -> DataFrame:
        """A lazy DataFrame of the chosen columns, converted as the plan says.

        ``where`` is a filter over the columns as stored; unlike one over the
        result it reaches the Parquet reader under every conversion.  Columns
        that only it uses are named in ``where_columns``.  ``ordered`` sorts by
        the row's place in the file, ``numbered`` adds it as a column.
        ``validate_text=False`` skips the check of text for invalid UTF-8.
        """
        options = ReadOptions(int64, time, tz)
        plan = self.plan(options)
        rows = self.selected(columns, plan)
        df = self.raw(rows, row_groups, where_columns)
        if any(r.converter and r.converter.startswith("decimal_") for r in rows):
            log.info("DECIMAL columns are read as double, exact within 2^53")
        if where:
            df = df.where(where)
        if ordered:
            df = df.orderBy("_metadata.row_index")
        texts = validate_text and any(r.converter == "text" for r in rows)
        row_index = F.col("_metadata.row_index") if texts else None
        leaves = self.footer.leaves
        out = df.select(*[converters.convert(r, leaves[r.column - 1], F.col(quoted(r.path)), validate_text=validate_text, row_index=row_index).alias(r.path) for r in rows], *([F.col("_metadata.row_index").alias(PLACE)] if numbered else []))
        if verbose:
            log.warning("%s", "\n  ".join(self.report(columns, row_groups, int64=int64, time=time, tz=tz)))
        return out

    def report(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, batch_size: int | None = None, **options) -> list[str]:
        """What a read will do, as lines: how much of the file, and what each chosen column becomes."""
        rows, wanted, n = self.selected(columns, self.plan(ReadOptions(**options))), self.groups(row_groups), len(self.footer.row_groups)
        size = sum(g.rows for g in self.footer.row_groups if wanted is None or g.row_group in wanted)
        batches = f", batches of {batch_size}" if batch_size else ""
        head = f"{size} rows, {len(rows)} of {self.dim[1]} columns, {n if wanted is None else len(wanted)} of {n} row groups{batches}"
        return [head, *(f"{r.path}: {r.physical_type}{f' {r.logical_type}' if r.logical_type else ''} -> {r.r_type} ({r.converter})" for r in rows)]

    def lossy_columns(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, **options) -> DataFrame:
        """``path, lost``: values that the read would turn to null, of the columns that have any; one pass over those columns."""
        chosen = ReadOptions(**options)
        leaves = self.footer.leaves
        rows = [r for r in self.selected(columns, self.plan(chosen)) if converters.lossy(r, leaves[r.column - 1], F.lit(0)) is not None]
        if not rows:
            return self.spark.createDataFrame([], "path string, lost long")
        counts = self.raw(rows, row_groups).agg(*[F.count_if(converters.lossy(r, leaves[r.column - 1], F.col(quoted(r.path)))).alias(str(i)) for i, r in enumerate(rows)])
        pairs = F.explode(F.array(*[F.struct(F.lit(r.path).alias("path"), F.col(str(i)).alias("lost")) for i, r in enumerate(rows)]))
        return counts.select(pairs.alias("x")).select("x.path", "x.lost").where("lost > 0")

    def batches(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, batch_size: int = 65_536, **options) -> Iterator[pa.Table]:
        """Batches of at most ``batch_size`` rows in file order, none across row groups.

        Row groups are fetched in spans of about ``SPAN`` bytes, one job each;
        the next span is read while this one is walked, so that memory holds two.
        """
        self.still_open()
        if not isinstance(batch_size, int) or batch_size < 1:
            raise ValueError("batch_size: expected a whole number of rows")
        wanted = self.groups(row_groups)
        groups = [g for g in self.footer.row_groups if wanted is None or g.row_group in set(wanted)]
        plan = self.plan(ReadOptions(**{k: v for k, v in options.items() if k in ("int64", "time", "tz")}))
        chosen = {r.column for r in self.selected(columns, plan)}
        if not chosen:
            for g in groups:
                yield from (pa.table({"_": pa.nulls(min(batch_size, g.rows - i))}).select([]) for i in range(0, g.rows, batch_size))
            return
        size = {g.row_group: 0 for g in groups}
        for c in self.footer.chunks:
            if c.column in chosen and c.row_group in size:
                size[c.row_group] += c.uncompressed_bytes
        spans: list[list] = []
        room = 0
        for g in groups:
            if not spans or room + size[g.row_group] > SPAN:
                spans.append([])
                room = 0
            spans[-1].append(g)
            room += size[g.row_group]

        def fetch(span: list) -> pa.Table:
            numbers = [g.row_group for g in span]
            whole = self.collect(columns, None if len(numbers) == len(self.footer.row_groups) else numbers, numbered=True, **options).toArrow()
            place = whole.column(PLACE).to_numpy()
            if (place[1:] < place[:-1]).any():  # tasks of one file come in its order, but nothing promises that
                whole = whole.take(pa.array(place.argsort()))
            return whole.drop_columns([PLACE])

        with ThreadPoolExecutor(1) as ahead:
            coming = ahead.submit(fetch, spans[0]) if spans else None
            for i, span in enumerate(spans):
                whole, coming = coming.result(), ahead.submit(fetch, spans[i + 1]) if i + 1 < len(spans) else None
                at = 0
                for g in span:
                    yield from (whole.slice(at + k, min(batch_size, g.rows - k)) for k in range(0, g.rows, batch_size))
                    at += g.rows

    def walk_batches(self, fun: Callable[[pa.Table, int], object], columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, batch_size: int = 65_536, **options) -> None:
        """Calls ``fun(batch, index)`` with each batch, index from 1; what it returns is dropped."""
        for index, batch in enumerate(self.batches(columns, row_groups, batch_size, **options), 1):
            fun(batch, index)

    def numbered_batches(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, batch_size: int = 65_536, *, validate_text: bool = True, **options) -> DataFrame:
        """The rows with ``_row_group`` and ``_batch`` (from 1, in file order): the distributed form of a walk.

        Group by ``_batch`` and apply a function to each; no batch crosses a row
        group.  Numbers come from the row index by arithmetic, without a shuffle.
        """
        if not isinstance(batch_size, int) or batch_size < 1:
            raise ValueError("batch_size: expected a whole number of rows")
        chosen = set(self.groups(row_groups) or [g.row_group for g in self.footer.row_groups] if row_groups is None else self.groups(row_groups))
        rows = self.selected(columns, self.plan(ReadOptions(**options)))
        leaves = self.footer.leaves
        before, total = [], 0
        for g in self.footer.row_groups:
            before.append(total)
            total += -(-g.rows // batch_size) if g.row_group in chosen else 0
        at, index = F.col("_metadata.row_index"), self.group_index()
        batch = F.floor((at - F.get(numbers(g.first_row for g in self.footer.row_groups), index)) / batch_size) + F.get(numbers(before), index) + 1
        values = [converters.convert(r, leaves[r.column - 1], F.col(quoted(r.path)), validate_text=validate_text, row_index=at).alias(r.path) for r in rows]
        return self.raw(rows, row_groups).select((index + 1).cast("int").alias("_row_group"), batch.alias("_batch"), *values)


def open_parquet(spark: SparkSession, path: str, verify_checksums: bool = True) -> ParquetFile:
    return ParquetFile(spark, path, verify_checksums)


#: What leaves of a folder's files must have in common; where one file's column is optional, the folder's is.
SHARED = ("path", "physical_type", "logical_type", "logical_details", "type_length", "max_repetition_level")


class ParquetFolder(ParquetFile):
    """The files of a folder as one table, if their columns agree.

    Rows and row groups have numbers within a file only, so neither can be
    chosen, ordered by or asked for here.
    """

    @cached_property
    def footer(self) -> Footer:
        fs, at = hadoop(self.spark, self.path)
        found = [s for s in fs.listStatus(at) if not s.getPath().getName().startswith(("_", "."))]
        if any(s.isDirectory() for s in found):
            raise ValueError(f"{self.asked} has folders within; open them one by one")
        if not found:
            raise ValueError(f"{self.asked} has no files")
        with ThreadPoolExecutor(8) as pool:
            footers = list(pool.map(lambda path: read_footer(self.spark, path), sorted(s.getPath().toString() for s in found)))
        for f in footers[1:]:
            if [[getattr(x, k) for k in SHARED] for x in f.leaves] != [[getattr(x, k) for k in SHARED] for x in footers[0].leaves]:
                raise ValueError(f"columns of {f.path} differ from those of {footers[0].path}")
        leaves = tuple(max(x, key=lambda leaf: leaf.max_definition_level) for x in zip(*[f.leaves for f in footers], strict=True))
        return Footer(self.path, leaves, tuple(g for f in footers for g in f.row_groups), (), tuple(c for f in footers for c in f.chunks), sum(f.declared_rows for f in footers))

    def groups(self, row_groups: Sequence[int] | None) -> None:
        if row_groups is not None:
            raise ValueError("row_groups: they have numbers within a file, and this is a folder")

    def collect(self, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, *, ordered: bool = False, numbered: bool = False, **options) -> DataFrame:
        if ordered or numbered:
            raise ValueError("ordered, numbered: rows have places within a file, and this is a folder")
        return super().collect(columns, row_groups, **options)


def opened(spark: SparkSession, path: str) -> ParquetFile:
    """A file, or a folder of files."""
    if isinstance(path, str) and path and not DOWNLOADED.match(path):
        fs, at = hadoop(spark, path)
        if fs.exists(at) and fs.getFileStatus(at).isDirectory():
            return ParquetFolder(spark, path)
    return ParquetFile(spark, path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, row_groups: Sequence[int] | None = None, **options) -> DataFrame:
    """Opens a file, or a folder of files with the same columns, and collects.  A downloaded copy stays for the lazy table; clear_shared() removes it."""
    return opened(spark, path).collect(columns, row_groups, **options)


def read_plan(spark: SparkSession, x, *, int64: str = "double", time: str = "numeric", tz: str = "UTC") -> DataFrame:
    """The plan of a path (of a file or a folder of files), an open file, or a list of leaves."""
    options = ReadOptions(int64, time, tz)
    if isinstance(x, str):
        x = opened(spark, x)
    if isinstance(x, ParquetFile):
        x = x.footer.leaves
    if not isinstance(x, list | tuple):
        raise TypeError("expected a path, an open file, or leaves")
    return plan_frame(spark, build_plan(x, options))
