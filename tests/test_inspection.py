"""Metadata relations, bloom filters, checks of broken files, geospatial statistics."""

import datetime
import math
import struct

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.functions import geo
from lamina.operators import inspection
from lamina.plans.write_schema import parquet_schema
from lamina.sources import compact
from lamina.sources.footer import copy_with_footer, tree_of
from lamina.sources.scan import open_parquet
from lamina.sources.write import notes, write_parquet


@pytest.fixture(scope="module")
def sorted_file(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("inspect") / "sorted.parquet")
    df = spark.range(0, 4000, 1, 1).select(F.col("id").alias("key"), F.format_string("item-%05d", "id").alias("label"), ((F.col("id") % 97) / 4).alias("score"))
    write_parquet(df, path, row_group_size=1000, bloom_filters=["key", "label"])
    return open_parquet(spark, path)


def test_relations(sorted_file):
    assert [(r.row_group, r.rows) for r in inspection.row_groups(sorted_file).collect()] == [(1, 1000), (2, 1000), (3, 1000), (4, 1000)]
    chunks = inspection.column_chunks(sorted_file).collect()
    assert len(chunks) == 12 and all(c.num_values == 1000 and c.page_index for c in chunks)
    assert [c.bloom_filter for c in chunks[:3]] == [True, True, False]
    stats = inspection.column_statistics(sorted_file).collect()
    assert [(s.min.i, s.max.i) for s in stats if s.path == "key"] == [(0, 999), (1000, 1999), (2000, 2999), (3000, 3999)]
    assert stats[1].min.s == "item-00000" and stats[2].max.d == 24.0 and stats[0].null_count == 0
    pages = inspection.page_index(sorted_file).collect()
    assert min(p.first_row for p in pages) == 0 and {p.row_group for p in pages} == {1, 2, 3, 4}
    assert "key" in {r.key for r in inspection.metadata(sorted_file).collect()} or inspection.metadata(sorted_file).count() >= 1


def test_int32_bound_and_no_statistics(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    pq.write_table(pa.table({"x": pa.array([-(2**31), 5, None], pa.int32())}), path)
    row = inspection.column_statistics(open_parquet(spark, path)).first()
    assert (row.min.i, row.max.i, row.null_count) == (-(2**31), 5, 1)
    pq.write_table(pa.table({"x": [1, 2]}), path, write_statistics=False)
    row = inspection.column_statistics(open_parquet(spark, path)).first()
    assert row.min.i is None and row.null_count is None
    assert inspection.page_index(open_parquet(spark, path)).count() == 0


def test_bloom(sorted_file):
    present = inspection.bloom_filter_may_contain(sorted_file, "key", list(range(0, 1000, 9)))
    assert all(present)
    absent = inspection.bloom_filter_may_contain(sorted_file, "key", list(range(10_000, 11_000)))
    assert sum(absent) < 100
    assert all(inspection.bloom_filter_may_contain(sorted_file, "label", ["item-03999", "item-03000"], row_group=4))
    assert inspection.bloom_filter_may_contain(sorted_file, "key", [None, 5.0]) == [None, True]


def test_bloom_of_many_values(spark, sorted_file, monkeypatch):
    """The distributed look-up says what the driver's says, in one piece or in many; a row group without a filter is an error."""
    some = [f"item-{i:05d}" for i in range(0, 9000, 7)]
    want = [(g, v, found) for g in (1, 3) for v, found in zip(some, inspection.bloom_filter_may_contain(sorted_file, "label", some, g), strict=True)]
    values = spark.createDataFrame([(g, v) for g, v, _ in want] + [(4, None)], "row_group int, value string")
    for room in (inspection.FILTERS_AT_ONCE, 1):
        monkeypatch.setattr(inspection, "FILTERS_AT_ONCE", room)
        got = inspection.bloom_filter_members(sorted_file, "label", values).collect()
        assert {(r.row_group, r.value, r.found) for r in got} == {*want, (4, None, None)} and len(got) == len(want) + 1
    for column, group in (("score", 1), ("key", 5)):
        with pytest.raises(PySparkException, match="no bloom filter in row group"):
            inspection.bloom_filter_members(sorted_file, column, spark.createDataFrame([(group, 1)], "row_group int, value int")).collect()
    with pytest.raises(ValueError, match="no column"):
        inspection.bloom_filter_members(sorted_file, "nope", values)


def test_filters_come_over_in_small_pieces(spark, tmp_path):
    """Pieces of 16 MB, sent out again as tasks, took a driver over 1,500 MB at 6,000 row groups."""
    write_parquet(spark.range(480_000), str(tmp_path / "ids.parquet"), row_group_size=52_000, bloom_filters=["id"])
    f = open_parquet(spark, str(tmp_path / "ids.parquet"))
    pieces = list(inspection.bloom_filters(f, f.footer.leaves[0]))
    assert [g for p in pieces for g, _ in p] == list(range(1, 11))
    assert 2 << 20 < sum(len(b) for p in pieces for _, b in p)
    assert max(sum(len(b) for _, b in p) for p in pieces) <= 2 << 20


@pytest.mark.parametrize(("column", "value"), [("key", 1.5), ("key", "1"), ("key", 2**63), ("key", True), ("label", 5), ("score", 1.0), ("nope", 1)])
def test_bloom_errors(sorted_file, column, value):
    with pytest.raises(ValueError):
        inspection.bloom_filter_may_contain(sorted_file, column, [value])


def test_bloom_dates_and_unsigned():
    from lamina.plans.types import Leaf

    day = Leaf(1, "d", "d", "INT32", "DATE")
    assert inspection.reduced(datetime.date(1970, 1, 2), day) == struct.pack("<i", 1)
    big = Leaf(1, "u", "u", "INT32", "INTEGER", "bit_width=32, signed=false")
    assert inspection.reduced(2**32 - 1, big) == struct.pack("<i", -1)
    for leaf in (Leaf(1, "b", "b", "BOOLEAN"), Leaf(1, "t", "t", "INT96")):
        with pytest.raises(ValueError):
            inspection.reduced(1, leaf)


def test_validation(spark, tmp_path, sorted_file):
    assert inspection.validate_parquet(spark, sorted_file.path)
    whole = open(sorted_file.path, "rb").read()
    cases = {"small": (b"PAR1", "too few"), "head": (b"XXXX" + whole[4:], "at its start"), "tail": (whole[:-10], "at its end"), "crypt": (whole[:-4] + b"PARE", "encrypted"), "footer": (whole[:-60] + b"\xff" * 52 + whole[-8:], "can't be parsed")}
    for name, (data, says) in cases.items():
        (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError, match=says):
            inspection.validate_parquet(spark, str(tmp_path / name))
    with pytest.raises(ValueError, match="directory"):
        inspection.validate_parquet(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no file"):
        inspection.validate_parquet(spark, str(tmp_path / "missing"))


def wkb(kind, *coordinates, order="<"):
    head = struct.pack("B", order == "<") + struct.pack(f"{order}I", kind)
    return head + b"".join(struct.pack(f"{order}d", c) for c in coordinates)


def line(*points, kind=2):
    return struct.pack("<BII", 1, kind, len(points)) + b"".join(struct.pack(f"<{len(p)}d", *p) for p in points)


def test_wkb():
    box, code = geo.walk(wkb(1, 3, 4))
    assert code == 1 and box[:4] == [3, 3, 4, 4] and math.isnan(box[4])
    assert geo.walk(wkb(1, 3, 4, order=">"))[0][:4] == [3, 3, 4, 4]
    assert geo.walk(wkb(1001, 1, 2, 9))[1] == 1001 and geo.walk(wkb(0x80000001, 1, 2, 9))[1] == 1001
    assert geo.walk(wkb(3001, 1, 2, 3, 4))[0] == [1, 1, 2, 2, 3, 3, 4, 4]
    box, code = geo.walk(line((0, 1), (5, -2)))
    assert code == 2 and box[:4] == [0, 5, -2, 1]
    polygon = struct.pack("<BIII", 1, 3, 1, 3) + struct.pack("<6d", 0, 0, 4, 0, 4, 7)
    multi = struct.pack("<BII", 1, 6, 1) + polygon
    assert geo.walk(multi)[1] == 6 and geo.walk(multi)[0][:4] == [0, 4, 0, 7]
    for bad in (b"", b"\x01", wkb(8, 1, 2), wkb(1, 1), wkb(1, 1, 2) + b"x", b"\x05" + wkb(1, 1, 2)[1:]):
        with pytest.raises(geo.Invalid):
            geo.walk(bad)
    deep = wkb(1, 0, 0)
    for _ in range(40):
        deep = struct.pack("<BII", 1, 7, 1) + deep
    with pytest.raises(geo.Invalid):
        geo.walk(deep)


def test_geospatial_statistics(spark, tmp_path):
    path = str(tmp_path / "geo.parquet")
    rows = [(bytearray(wkb(1, 1, 2)),), (bytearray(wkb(1, float("nan"), 9)),), (None,), (bytearray(line((5, 5), (6, -6))),), (bytearray(b"junk"),), (bytearray(wkb(1, 0, 0)),)]
    df = spark.createDataFrame(rows, "g binary").coalesce(1)
    write_parquet(df, path, schema=parquet_schema(g={"type": "GEOMETRY", "crs": "EPSG:4326"}), row_group_size=4)
    found = {r.row_group: r for r in inspection.geospatial_statistics(open_parquet(spark, path), ["g"]).collect()}
    assert (found[1].xmin, found[1].xmax, found[1].ymin, found[1].ymax, found[1].zmin, found[1].geometry_types) == (1.0, 6.0, -6.0, 9.0, None, [1, 2])
    assert found[2].xmin is None and found[2].geometry_types is None  # one invalid value spoils its group
    assert notes(spark, path)["logical_types"] == {"g": "GEOMETRY(crs=EPSG:4326)"}
    assert inspection.geospatial_statistics(open_parquet(spark, path)).count() == 2  # the file says itself that the column is geospatial
    (leaf,) = open_parquet(spark, path).footer.leaves
    assert (leaf.logical_type, leaf.logical_details) == ("GEOMETRY", "crs=EPSG:4326")
    assert [c.min for c in open_parquet(spark, path).footer.chunks] == [None, None]
    assert [r.g for r in open_parquet(spark, path).collect().collect()] == [r[0] for r in rows]
    write_parquet(df, path, schema=parquet_schema(g={"type": "GEOGRAPHY", "algorithm": "karney"}))
    only = inspection.geospatial_statistics(open_parquet(spark, path)).collect()
    assert len(only) == 1 and only[0].xmin is None and only[0].geometry_types is None
    plain = str(tmp_path / "plain.parquet")
    write_parquet(df.limit(4), plain)
    assert inspection.geospatial_statistics(open_parquet(spark, plain)).count() == 0
    assert [r.geometry_types for r in inspection.geospatial_statistics(open_parquet(spark, plain), ["g"]).collect()] == [[1, 2]]


def test_footer_against_another_reader(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    table = pa.table({"i": pa.array([3, None, 1], pa.int32()), "s": ["b", "", "a"], "l": [[1], [], None], "t": pa.array([1, 2, 3], pa.time64("us")), "d": pa.array([1, 2, 3], pa.decimal128(12, 3)), "u": pa.array([1, 2, 3], pa.uint16())}, metadata={"k": "v"})
    pq.write_table(table, path, row_group_size=2, sorting_columns=[pq.SortingColumn(0, descending=True, nulls_first=True)], write_page_index=True, compression="zstd")
    f, other = open_parquet(spark, path).footer, pq.ParquetFile(path)
    meta = other.metadata
    assert f.declared_rows == f.rows == meta.num_rows == 3 and len(f.row_groups) == meta.num_row_groups == 2
    assert [x.path for x in f.leaves] == [other.schema.column(i).path for i in range(len(other.schema))]
    assert [(x.max_definition_level, x.max_repetition_level) for x in f.leaves] == [(other.schema.column(i).max_definition_level, other.schema.column(i).max_repetition_level) for i in range(len(other.schema))]
    for c in f.chunks:
        o = meta.row_group(c.row_group - 1).column(c.column - 1)
        assert (c.path, c.num_values, c.compressed_bytes, c.uncompressed_bytes, c.compression) == (o.path_in_schema, o.num_values, o.total_compressed_size, o.total_uncompressed_size, o.compression)
        assert set(c.encodings) == set(o.encodings) and c.null_count == o.statistics.null_count and c.dictionary_page == o.has_dictionary_page and c.page_index
    assert f.row_groups[0].sorting == ((1, True, True),) and ("k", "v") in f.metadata
    assert [r.path for r in inspection.sorting(open_parquet(spark, path)).collect()] == ["i", "i"]
    tree, _ = tree_of(spark, path)
    assert compact.read(compact.write(tree)) == tree


def test_a_footer_that_contradicts_itself(spark, tmp_path):
    path, broken = str(tmp_path / "x.parquet"), str(tmp_path / "broken.parquet")
    pq.write_table(pa.table({"a": [1, 2, 3], "b": [1, 2, 3]}), path, row_group_size=2)
    tree, body = tree_of(spark, path)
    copy_with_footer(spark, path, broken, tree, body)
    assert inspection.validate_parquet(spark, broken) and pq.read_table(broken).num_rows == 3
    copy_with_footer(spark, path, broken, tree | {3: (compact.I64, 4)}, body)
    with pytest.raises(ValueError, match="4 rows are declared, 3 are in row groups"):
        inspection.validate_parquet(spark, broken)
    group = tree[4][1][1][0]
    fewer = group | {1: (compact.LIST, (compact.STRUCT, group[1][1][1][:1]))}
    copy_with_footer(spark, path, broken, tree | {4: (compact.LIST, (compact.STRUCT, [fewer, tree[4][1][1][1]]))}, body)
    with pytest.raises(ValueError, match="row group 1 has 1 column chunks for 2 columns"):
        inspection.validate_parquet(spark, broken)
    copy_with_footer(spark, path, broken, tree, body - 40)
    with pytest.raises(ValueError, match="outside the data"):
        inspection.validate_parquet(spark, broken)
