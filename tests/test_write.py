"""Writes, appends and their refusals."""

import datetime
import itertools

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lamina.operators.inspection import schema
from lamina.plans.write_schema import SchemaError, infer_parquet_schema, parquet_schema
from lamina.sources.scan import open_parquet, read_parquet
from lamina.sources.write import CODECS, notes, write_dataset, write_parquet


def frame(spark, n, nulls=False):
    keep = (lambda c: F.when(F.col("id") % 7 != 0, c)) if nulls else (lambda c: c)
    at = F.timestamp_seconds(F.col("id"))
    return spark.range(n).select(*[keep(c).alias(k) for k, c in {"lgl": F.col("id") % 2 == 0, "int": F.col("id").cast("int"), "dbl": F.col("id") / 3, "chr": F.concat(F.lit("v"), F.col("id")), "day": F.date_from_unix_date(F.col("id").cast("int")), "at": at}.items()])


@pytest.mark.parametrize(("codec", "nulls"), list(itertools.product(CODECS, (False, True))))
def test_round_trip(spark, tmp_path, codec, nulls):
    path = str(tmp_path / "x.parquet")
    df = frame(spark, 50, nulls)
    write_parquet(df, path, compression=codec, row_group_size=20)
    assert read_parquet(spark, path).collect() == df.collect()
    f = open_parquet(spark, path)
    assert [g.rows for g in f.footer.row_groups] == [20, 20, 10]
    assert {c.compression for c in f.footer.chunks} == {{"lz4": "LZ4_RAW"}.get(codec, codec.upper())}
    assert {x.repetition_type for x in f.footer.leaves} == {"OPTIONAL" if nulls else "REQUIRED"}


def test_empty_frame_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    write_parquet(frame(spark, 0), path)
    df = read_parquet(spark, path)
    assert df.count() == 0 and df.columns == ["lgl", "int", "dbl", "chr", "day", "at"]


def test_declared(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    df = spark.sql("SELECT 1.0D a, 2 b, 3L c, 4.5D d, 19000 e, timestamp_micros(1500000 + id) f, X'01' g FROM range(1)")
    write_parquet(df, path, schema=parquet_schema(a="int32", b="INT64", c="double", d="Float", e="date", f={"type": "timestamp", "unit": "millis", "repetition_type": "optional"}, g="binary"))
    rows = {r.name: r for r in schema(open_parquet(spark, path)).collect()}
    assert [rows[k].physical_type for k in "abcdefg"] == ["INT32", "INT64", "DOUBLE", "FLOAT", "INT32", "INT64", "BYTE_ARRAY"]
    assert rows["e"].logical_type == "DATE" and rows["f"].logical_details == "unit=MILLIS, adjusted_to_utc=true"
    assert rows["f"].repetition_type == "OPTIONAL" and rows["a"].repetition_type == "REQUIRED"
    assert read_parquet(spark, path).first().e == datetime.date(1970, 1, 1) + datetime.timedelta(19000)


@pytest.mark.parametrize(
    "spec",
    [{"x": "WHAT"}, {"x": {"type": "INT32", "unit": "MILLIS"}}, {"x": {"type": "STRING", "crs": "a"}}, {"x": {"type": "TIMESTAMP", "unit": "DAYS"}}, {"x": {"type": "TIMESTAMP", "is_adjusted_utc": False}}, {"x": {"type": "INT32", "repetition_type": "MAYBE"}}, {"x": {"type": "INT32", "color": 1}}, {"x": 5}, {"x": {"type": "GEOMETRY", "algorithm": "KARNEY"}}, {"x": {"type": "GEOGRAPHY", "algorithm": "FLAT"}}, {"x": {"type": "GEOMETRY", "crs": "c" * 128}}, {"": "INT32"}],
)
def test_bad_declarations(spec):
    with pytest.raises(SchemaError):
        parquet_schema(spec)


@pytest.mark.parametrize(
    ("sql", "declared", "says"),
    [
        ("SELECT CAST('NaN' AS DOUBLE) x", "INT32", "NaN"),
        ("SELECT 1.5D x", "INT32", "whole"),
        ("SELECT -2147483648 x", "INT32", "range"),
        ("SELECT 2147483648L x", "INT32", "range"),
        ("SELECT 1e17D x", "INT64", "range"),
        ("SELECT 'a' x", "INT32", "numeric"),
        ("SELECT 1 x", "STRING", "text"),
        ("SELECT 1 x", "BOOLEAN", "boolean"),
        ("SELECT 1 x", "TIMESTAMP", "timestamp"),
        ("SELECT 'a' x", "DATE", "date"),
        ("SELECT 'a' x", "BINARY", "binary"),
        ("SELECT 'a' x", "GEOMETRY", "GEOMETRY"),
        ("SELECT CAST(NULL AS INT) x", {"type": "INT32", "repetition_type": "REQUIRED"}, "has nulls"),
        ("SELECT timestamp_micros(1) x", {"type": "TIMESTAMP", "unit": "NANOS"}, "NANOS"),
        ("SELECT array(1) x", None, "no flat column"),
        ("SELECT 1 x, 2 x", None, "unique"),
        ("SELECT 1 y", "INT32", "missing column"),
    ],
)
def test_refused_before_a_byte(spark, tmp_path, sql, declared, says):
    path = tmp_path / "x.parquet"
    with pytest.raises(SchemaError, match=says):
        write_parquet(spark.sql(sql), str(path), schema=parquet_schema(x=declared) if declared else None)
    assert not path.exists() and not list(tmp_path.iterdir())


def test_bad_arguments(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "x.parquet")
    for bad in ({"compression": "brotli"}, {"row_group_size": 1.5}, {"row_group_size": 0}, {"metadata": {"": "x"}}, {"metadata": [("a", 5)]}, {"sorted_by": "nope"}, {"sorted_by": ["id", "id"]}, {"sorted_by": [{"name": "id", "descending": None}]}, {"bloom_filters": ["nope"]}):
        with pytest.raises(ValueError):
            write_parquet(df, path, **bad)
    with pytest.raises(ValueError, match="URL"):
        write_parquet(df, "https://example.com/x.parquet")
    assert not list(tmp_path.iterdir())


def test_notes_and_sorting(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "i int")
    keys = [{"name": "i", "descending": True, "nulls_first": True}]
    write_parquet(df, path, metadata=[("k", "1"), ("k", "2"), ("none", None)], sorted_by=keys)
    assert notes(spark, path) == {"metadata": [("k", "1"), ("k", "2"), ("none", None)], "sorted_by": keys, "logical_types": {}}
    assert [r.i for r in read_parquet(spark, path).collect()] == [3, 1, None, 2]  # recorded, not sorted
    write_parquet(df, path, sorted_by=keys, sort=True)
    assert [r.i for r in read_parquet(spark, path).collect()] == [None, 3, 2, 1]


def append_pair(spark):
    kind = "a int, b double, s string"
    return spark.createDataFrame([(1, None, "x"), (2, 2.0, "y")], kind), spark.createDataFrame([(3, 3.0, "z")], kind)


def test_append(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    one, two = append_pair(spark)
    write_parquet(one, path, metadata={"k": "v"})
    write_parquet(two, path, append=True, compression="zstd")
    assert [tuple(r) for r in read_parquet(spark, path).collect()] == [(1, None, "x"), (2, 2.0, "y"), (3, 3.0, "z")]
    assert [x.repetition_type for x in open_parquet(spark, path).footer.leaves] == ["REQUIRED", "OPTIONAL", "REQUIRED"]
    assert notes(spark, path)["metadata"] == [("k", "v")]


@pytest.mark.parametrize(
    ("change", "says"),
    [
        (lambda df: df.drop("s"), "number of columns"),
        (lambda df: df.select("b", "a", "s"), "order differ"),
        (lambda df: df.withColumn("a", F.col("a").cast("double")), "physical_type"),
        (lambda df: df.withColumn("s", F.col("s").cast("binary")), "logical_type"),
        (lambda df: df.withColumn("a", F.lit(None).cast("int")), "REQUIRED"),
    ],
)
def test_append_refusals(spark, tmp_path, change, says):
    path = tmp_path / "x.parquet"
    one, two = append_pair(spark)
    write_parquet(one, str(path))
    before = path.read_bytes()
    with pytest.raises(SchemaError, match=says):
        write_parquet(change(two), str(path), append=True)
    assert path.read_bytes() == before


def test_append_units_and_missing(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    df = spark.sql("SELECT timestamp_micros(1) t")
    with pytest.raises(SchemaError, match="nothing to append to"):
        write_parquet(df, path, append=True)
    write_parquet(df, path)
    with pytest.raises(SchemaError, match="logical_details"):
        write_parquet(df, path, append=True, schema=parquet_schema(t={"type": "TIMESTAMP", "unit": "MILLIS"}))


def test_inference(spark):
    rows = infer_parquet_schema(frame(spark, 10, nulls=True).withColumn("never", F.lit(1))).collect()
    assert [(r.physical_type, r.logical_type, r.repetition_type) for r in rows] == [("BOOLEAN", None, "OPTIONAL"), ("INT32", None, "OPTIONAL"), ("DOUBLE", None, "OPTIONAL"), ("BYTE_ARRAY", "STRING", "OPTIONAL"), ("INT32", "DATE", "OPTIONAL"), ("INT64", "TIMESTAMP", "OPTIONAL"), ("INT32", None, "REQUIRED")]
    with pytest.raises(SchemaError, match="without columns"):
        infer_parquet_schema(spark.range(1).select())


def test_dataset(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    write_dataset(df, path, partition_by=["k"], sorted_by=["id"], row_group_size=10)
    write_dataset(df, path, partition_by=["k"], append=True)
    assert spark.read.parquet(path).count() == 200
    assert {f.suffix for p in (tmp_path / "d").glob("k=*") for f in p.glob("part-*")} == {".parquet"}


def test_read_by_others(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    write_parquet(frame(spark, 20), path, row_group_size=10)
    assert pq.read_table(path).num_rows == 20 and pq.ParquetFile(path).num_row_groups == 2
