"""Scans of files that pyarrow wrote; what is expected derives from what was written."""

import datetime
import decimal
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lamina.functions.converters import text
from lamina.sources.scan import open_parquet, read_parquet, read_plan

UTC = datetime.UTC


@pytest.fixture(scope="module")
def multigroup(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scan") / "multigroup.parquet")
    n = range(1, 13)
    pq.write_table(
        pa.table(
            {
                "id": pa.array(n, pa.int32()),
                "count": pa.array([10**10 + i for i in n], pa.int64()),
                "ratio": pa.array([i / 10 for i in n], pa.float32()),
                "price": pa.array([None if i in (3, 8) else i * 1.5 for i in n]),
                "label": pa.array([None if i == 5 else f"l{i}" for i in n]),
                "active": pa.array([i % 2 == 1 for i in n]),
            }
        ),
        path,
        row_group_size=3,
        compression="none",
    )
    return open_parquet(spark, path)


def test_selection(multigroup):
    df = multigroup.collect(["label", "id"], row_groups=[4, 1])
    assert df.columns == ["label", "id"]
    assert [r.id for r in df.collect()] == [1, 2, 3, 10, 11, 12]
    assert multigroup.collect([]).count() == 12 and multigroup.collect([]).columns == []
    none = multigroup.collect(row_groups=[])
    assert none.count() == 0 and len(none.columns) == 6
    assert multigroup.dim == (12, 6) and multigroup.names[0] == "id"
    assert [r["count"] for r in multigroup.collect(["count"]).collect()] == [float(10**10 + i) for i in range(1, 13)]


def test_same_by_every_way(multigroup, spark):
    whole = multigroup.collect().collect()
    assert whole == read_parquet(spark, multigroup.path).collect()
    assert [tuple(r.values()) for b in multigroup.batches(batch_size=2) for r in b.to_pylist()] == [tuple(r) for r in whole]


@pytest.mark.parametrize(("columns", "says"), [(["nope"], "has no"), (["id", "id"], "more than once"), ([None], "missing")])
def test_bad_columns(multigroup, columns, says):
    with pytest.raises(ValueError, match=says):
        multigroup.collect(columns)


@pytest.mark.parametrize("groups", [[0], [5], [1, 1], [1.5], [True]])
def test_bad_groups(multigroup, groups):
    with pytest.raises(ValueError, match="row_groups"):
        multigroup.collect(row_groups=groups)


def test_batches(multigroup):
    seen = []
    multigroup.walk_batches(lambda b, i: seen.append((i, b.num_rows)), ["id"], [1, 2], 2)
    assert seen == [(1, 2), (2, 1), (3, 2), (4, 1)]
    assert [b.num_rows for b in multigroup.batches([], batch_size=2)][:2] == [2, 1] or multigroup.collect([]).columns == []
    rows = multigroup.numbered_batches(["id"], batch_size=2).collect()
    assert [(r._row_group, r._batch) for r in rows[:4]] == [(1, 1), (1, 1), (1, 2), (2, 3)]
    with pytest.raises(ValueError, match="batch_size"):
        list(multigroup.batches(batch_size=0))
    with pytest.raises(RuntimeError, match="stop"):
        multigroup.walk_batches(lambda b, i: (_ for _ in ()).throw(RuntimeError("stop")))
    assert multigroup.collect().count() == 12


@pytest.mark.parametrize("sizes", [[1] * 10_000, [7, 1, 30, 2, 2, 100, 5] * 40])
def test_many_and_uneven_row_groups(spark, tmp_path, sizes):
    path, total = str(tmp_path / "many.parquet"), sum(sizes)
    with pq.ParquetWriter(path, pa.schema([("x", pa.int64()), ("y", pa.float64())])) as out:
        at = 0
        for n in sizes:
            out.write_table(pa.table({"x": pa.array(range(at, at + n), pa.int64()), "y": pa.array([i / 2 for i in range(at, at + n)])}))
            at += n
    f = open_parquet(spark, path)
    assert [g.rows for g in f.footer.row_groups] == sizes
    group = [g for g, n in enumerate(sizes, 1) for _ in range(n)]
    want, first = {}, 0
    for g, n in enumerate(sizes, 1):
        for k in range(0, n, 4):
            want[len(want) + 1] = (g, list(range(first + k, min(first + k + 4, first + n))))
        first += n
    rows = f.numbered_batches(["x"], batch_size=4, int64="integer64").collect()
    assert [r._row_group for r in sorted(rows, key=lambda r: r.x)] == group
    got = {}
    for r in rows:
        got.setdefault(r._batch, (r._row_group, []))[1].append(r.x)
    assert {b: (g, sorted(x)) for b, (g, x) in got.items()} == want
    walked = []
    f.walk_batches(lambda b, i: walked.append((i, b.column("x").to_pylist())), ["x"], batch_size=4, int64="integer64")
    assert walked == [(b, x) for b, (_, x) in want.items()]
    some = list(range(1, len(sizes) + 1, 3))  # more ranges than are written out
    chosen = set(some)
    assert sorted(r.x for r in f.collect(["x"], some, int64="integer64").collect()) == [i for i in range(total) if group[i] in chosen]
    assert sorted({r._batch for r in f.numbered_batches(["x"], some, 4).collect()}) == list(range(1, 1 + sum(-(-sizes[g - 1] // 4) for g in some)))


def test_walk_spans(spark, tmp_path, monkeypatch):
    from lamina.sources import scan

    path = str(tmp_path / "x.parquet")
    pq.write_table(pa.table({"x": list(range(5000)), "s": [f"text {i}" for i in range(5000)]}), path, row_group_size=700)
    monkeypatch.setattr(scan, "SPAN", 20_000)
    whole = [b.to_pylist() for b in open_parquet(spark, path).batches(batch_size=300)]
    monkeypatch.setattr(scan, "SPAN", 1 << 30)
    assert [b.to_pylist() for b in open_parquet(spark, path).batches(batch_size=300)] == whole
    assert [r["s"] for b in whole for r in b] == [f"text {i}" for i in range(5000)]
    assert [len(b) for b in whole][:4] == [300, 300, 100, 300]


def test_closed_handles_and_urls(spark, tmp_path):
    import http.server
    import threading

    pq.write_table(pa.table({"x": [1, 2, 3]}), tmp_path / "x.parquet")
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), lambda *a: http.server.SimpleHTTPRequestHandler(*a, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        with open_parquet(spark, f"http://127.0.0.1:{server.server_port}/x.parquet") as f:
            assert f.collect().count() == 3 and f.path.startswith(("/", "file:"))
            copy = f.path
        with pytest.raises(OSError):
            open_parquet(spark, f"http://127.0.0.1:{server.server_port}/none.parquet")
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(ValueError, match="is closed"):
        f.collect()
    with pytest.raises(Exception):  # noqa: B017  the copy went with its handle
        open_parquet(spark, copy)


def test_filter_reaches_the_reader(multigroup):
    df = multigroup.collect(["ratio"], where="`count` > 10000000010", where_columns=["count"])
    assert df.columns == ["ratio"] and df.count() == 2
    assert "GreaterThan(count,10000000010)" in df._jdf.queryExecution().executedPlan().toString()


def test_row_groups_skip_data(spark, tmp_path):
    path = str(tmp_path / "sorted.parquet")
    n = 8000
    pq.write_table(pa.table({"key": pa.array(range(n), pa.int64()), "odd": pa.array([i % 7 if i % 11 else None for i in range(n)], pa.int32()), "text": [f"t{i}" for i in range(n)]}), path, row_group_size=1000)
    f = open_parquet(spark, path)
    leaf, low, high = f.bounds_of([3, 4])
    assert (leaf.path, low, high) == ("key", 2000, 3999)
    df = f.collect(["text"], row_groups=[4, 3])
    assert [r.text for r in df.collect()] == [f"t{i}" for i in range(2000, 4000)]
    plan = f.collect(["text"], row_groups=[4, 3])._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert plan.collectLeaves().head().metrics().get("numOutputRows").get().value() == 2000  # of 8,000
    assert f.bounds_of(list(range(1, 9))) is None and f.bounds_of([]) is None
    unsorted = str(tmp_path / "unsorted.parquet")
    pq.write_table(pa.table({"key": [1, 9, 1, 9], "null": [1, None, 5, 6]}), unsorted, row_group_size=2)
    g = open_parquet(spark, unsorted)
    assert g.bounds_of([1]) is None and [r.key for r in g.collect(["key"], row_groups=[2]).collect()] == [1.0, 9.0]
    assert g.bounds_of([2])[0].path == "null" and [r.key for r in g.collect(["key"], row_groups=[2]).collect()] == [1.0, 9.0]


def one(spark, tmp_path, array, name="x.parquet", **more):
    path = str(tmp_path / name)
    pq.write_table(pa.table({"x": array}), path)
    f = open_parquet(spark, path)
    return f, [r.x for r in f.collect(**more).collect()]


def test_int64_bounds(spark, tmp_path):
    signed = [-(2**63), -(2**53 + 1), -(2**53), -1, 0, 2**53, 2**53 + 1, 2**63 - 1]
    f, got = one(spark, tmp_path, pa.array(signed, pa.int64()))
    assert got == [None, None, -(2.0**53), -1.0, 0.0, 2.0**53, None, None]
    assert [r.x for r in f.collect(int64="integer64").collect()] == [None, *signed[1:]]
    assert [tuple(r) for r in f.lossy_columns().collect()] == [("x", 4)]
    assert [tuple(r) for r in f.lossy_columns(int64="integer64").collect()] == [("x", 1)]
    unsigned = [0, 1, 2**53, 2**53 + 1, 2**63 - 1, 2**63, 2**64 - 1]
    f, got = one(spark, tmp_path, pa.array(unsigned, pa.uint64()), "u.parquet")
    assert got == [0.0, 1.0, 2.0**53, None, None, None, None]
    assert [r.x for r in f.collect(int64="integer64").collect()] == [*unsigned[:5], None, None]


def test_int32_and_unsigned(spark, tmp_path):
    f, got = one(spark, tmp_path, pa.array([-(2**31), -1, 0, 2**31 - 1, None], pa.int32()))
    assert got == [None, -1, 0, 2**31 - 1, None] and f.lossy_columns().first().lost == 1
    assert one(spark, tmp_path, pa.array([0, 2**32 - 1, None], pa.uint32()), "a.parquet")[1] == [0.0, 4294967295.0, None]
    assert one(spark, tmp_path, pa.array([0, 255, None], pa.uint8()), "b.parquet")[1] == [0, 255, None]
    assert one(spark, tmp_path, pa.array([0, 65535, None], pa.uint16()), "c.parquet")[1] == [0, 65535, None]
    assert one(spark, tmp_path, pa.array([-128, 127, None], pa.int8()), "d.parquet")[1] == [-128, 127, None]


@pytest.mark.parametrize(("unit", "last"), [("ms", 86_399_999), ("us", 86_399_999_999), ("ns", 86_399_999_999_999)])
def test_times(spark, tmp_path, unit, last):
    kind = pa.time32(unit) if unit == "ms" else pa.time64(unit)
    f, got = one(spark, tmp_path, pa.array([0, last, None], kind))
    per = {"ms": 1e3, "us": 1e6, "ns": 1e9}[unit]
    assert got == [0.0, last / per, None]
    clock = [str(r.t) for r in f.collect(time="hms").selectExpr("cast(x as string) t").collect()]
    assert clock[0] == "00:00:00" and clock[1].startswith("23:59:59.999") and clock[2] == "None"


def test_time_out_of_day(spark, tmp_path):
    # The annotated writer won't make such a value; the expression is what reads it.
    from pyspark.sql import functions as F

    from lamina.functions.converters import time_of_day

    for bad in (-1, 86_400_000):
        with pytest.raises(PySparkException, match="not within one day"):
            spark.createDataFrame([(bad,)], "x int").select(time_of_day(F.col("x"), "millis", "numeric")).collect()


@pytest.mark.parametrize("unit", ["ms", "us", "ns"])
def test_timestamps(spark, tmp_path, unit):
    instant = datetime.datetime(2020, 7, 1, 12, 30, 15)
    n = int(instant.replace(tzinfo=UTC).timestamp()) * {"ms": 10**3, "us": 10**6, "ns": 10**9}[unit]
    as_micros = lambda f, **o: [r.u for r in f.collect(**o).selectExpr("unix_micros(x) u").collect()]
    want = int(instant.replace(tzinfo=UTC).timestamp()) * 10**6
    f, _ = one(spark, tmp_path, pa.array([n, None], pa.timestamp(unit, tz="UTC")))
    assert as_micros(f) == as_micros(f, tz="America/New_York") == [want, None]
    f, _ = one(spark, tmp_path, pa.array([n, None], pa.timestamp(unit)), "local.parquet")
    assert as_micros(f) == [want, None]
    assert as_micros(f, tz="America/New_York") == [want + 4 * 3600 * 10**6, None]


def test_gap_disturbs_no_neighbours(spark, tmp_path):
    walls = [datetime.datetime(2023, 6, 1, 9, 15, 30), datetime.datetime(2023, 3, 12, 2, 30), None, datetime.datetime(2023, 12, 24, 0, 7, 6)]
    f, _ = one(spark, tmp_path, pa.array(walls, pa.timestamp("us")))
    got = [r.u for r in f.collect(tz="America/New_York").selectExpr("unix_micros(x) u").collect()]
    assert got[0] == int(datetime.datetime(2023, 6, 1, 13, 15, 30, tzinfo=UTC).timestamp()) * 10**6
    assert got[2] is None and got[3] == int(datetime.datetime(2023, 12, 24, 5, 7, 6, tzinfo=UTC).timestamp()) * 10**6


def test_bytes_and_more(spark, tmp_path):
    ids = [uuid.UUID(int=5), uuid.UUID(int=2**127 + 77)]
    assert one(spark, tmp_path, pa.array([i.bytes for i in ids] + [None], pa.uuid()))[1] == [str(ids[0]), str(ids[1]), None]
    halves = np.array([1.5, -2.25, 0.0, 65504, 2**-24, np.inf, -np.inf], np.float16)
    got = one(spark, tmp_path, pa.array(halves, pa.float16()), "h.parquet")[1]
    assert got == [float(h) for h in halves]
    assert np.isnan(one(spark, tmp_path, pa.array(np.array([np.nan], np.float16)), "hn.parquet")[1][0])
    assert one(spark, tmp_path, pa.array([b"a\0", None], pa.binary()), "b.parquet")[1] == [bytearray(b"a\0"), None]
    assert one(spark, tmp_path, pa.array([b"abcd", None], pa.binary(4)), "f.parquet")[1] == [bytearray(b"abcd"), None]
    d = [decimal.Decimal("12.30"), decimal.Decimal("-0.07"), None]
    for i, kind in enumerate([pa.decimal128(7, 2), pa.decimal128(15, 2), pa.decimal128(30, 2)]):
        assert one(spark, tmp_path, pa.array(d, kind), f"d{i}.parquet")[1] == [12.3, -0.07, None]
    assert one(spark, tmp_path, pa.array([None, None], pa.null()), "n.parquet")[1] == [None, None]
    assert one(spark, tmp_path, pa.array(["a", "é", None]), "s.parquet")[1] == ["a", "é", None]
    assert one(spark, tmp_path, pa.array(['{"a":1}', None], pa.json_()), "j.parquet")[1] == ['{"a":1}', None]
    assert one(spark, tmp_path, pa.array([datetime.date(1969, 12, 31), None]), "day.parquet")[1] == [datetime.date(1969, 12, 31), None]
    path = str(tmp_path / "i96.parquet")
    pq.write_table(pa.table({"x": pa.array([datetime.datetime(2024, 1, 1, 20, 34, 56)], pa.timestamp("us"))}), path, use_deprecated_int96_timestamps=True)
    assert read_parquet(spark, path).selectExpr("cast(x as string) x").first().x == "2024-01-01 20:34:56"


def test_bad_text(spark, tmp_path):
    path = tmp_path / "bad.parquet"
    pq.write_table(pa.table({"t": ["good", "baéd", "fine"]}), path, compression="none", use_dictionary=False, write_statistics=False)
    path.write_bytes(path.read_bytes().replace("aéd".encode(), b"a\xc3ad"))
    f = open_parquet(spark, str(path))
    with pytest.raises(PySparkException, match="t: invalid UTF-8 or a NUL byte in row 2, byte 3"):
        f.collect().collect()
    with pytest.raises(PySparkException, match="row 2, byte 3"):
        f.numbered_batches().collect()
    for bad, where in ((b"\xef\xbf\xbd\xc3a", 4), (b"ok\x00", 3), (b"\xed\xa0\x80", 1), (b"a\xc0\x80", 2), (b"abc\xf5", 4)):
        with pytest.raises(PySparkException, match=f"row 1, byte {where}"):
            spark.createDataFrame([(bytearray(bad),)], "b binary").select(text(F.col("b").cast("string"), "t", F.lit(0))).collect()
    assert f.collect(validate_text=False).count() == 3


def test_nested_and_collisions(spark, tmp_path, caplog):
    path = str(tmp_path / "nested.parquet")
    pq.write_table(pa.table({"id": [1, 2], "s": [{"b": 7}, None], "b": pa.array([5, 6], pa.int32()), "n": [[1, 2], []], "label": ["x", "y"]}), path)
    with caplog.at_level("WARNING", "lamina"):
        df = read_parquet(spark, path)
    assert df.columns == ["id", "b", "label"] and [r.b for r in df.collect()] == [5, 6]
    assert len([r for r in caplog.records if "skipping 2 nested" in r.message]) == 1
    assert [(r.path, r.collectible) for r in read_plan(spark, path).collect()] == [("id", True), ("s.b", False), ("b", True), ("n.list.element", False), ("label", True)]
    path = str(tmp_path / "ambiguous.parquet")
    pq.write_table(pa.table({"a.b": [1], "a": [{"b": 2}]}), path)
    with pytest.raises(ValueError, match="ambiguous"):
        read_parquet(spark, path, ["a.b"])


def test_encodings(spark, tmp_path):
    text = [f"v{i % 150}" if i % 3 else f"unique-{i}" for i in range(3000)]
    table = pa.table({"i": pa.array([(i * 7919) % 1000 - 500 for i in range(3000)], pa.int32()), "t": text, "d": [i / 7 for i in range(3000)]})
    for name, kind in {"delta": {"i": "DELTA_BINARY_PACKED", "t": "DELTA_BYTE_ARRAY", "d": "BYTE_STREAM_SPLIT"}, "length": {"i": "PLAIN", "t": "DELTA_LENGTH_BYTE_ARRAY", "d": "PLAIN"}, "dictionary": None}.items():
        for version in ("1.0", "2.0"):
            path = str(tmp_path / f"{name}{version}.parquet")
            pq.write_table(table, path, use_dictionary=kind is None, column_encoding=kind, data_page_version=version, row_group_size=1000, compression="zstd")
            assert [tuple(r) for r in read_parquet(spark, path).collect()] == list(zip(*(c.to_pylist() for c in table.columns), strict=True))


def test_plan_of_other_things(spark):
    with pytest.raises(TypeError):
        read_plan(spark, 5)
    with pytest.raises(ValueError):
        open_parquet(spark, "")


def test_stream(spark, tmp_path):
    from lamina.streaming.stream import read_stream

    folder = tmp_path / "in"
    folder.mkdir()
    pq.write_table(pa.table({"x": pa.array([1, 2], pa.int64())}), folder / "1.parquet")
    stream = read_stream(spark, str(folder), str(folder / "1.parquet"))
    out = stream.writeStream.format("memory").queryName("arrived").option("checkpointLocation", str(tmp_path / "offsets")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert sorted(r.x for r in spark.table("arrived").collect()) == [1.0, 2.0]


@pytest.fixture
def folder(tmp_path):
    """Three files with nested columns, one of them without rows, and what Spark leaves beside them."""
    out = tmp_path / "table.parquet"
    out.mkdir()
    for i, ids in enumerate(([1, 2], [3], [])):
        pq.write_table(pa.table({"id": pa.array(ids, pa.int64()), "at": pa.array([[float(x)] for x in ids], pa.list_(pa.float32())), "label": pa.array([x * 10 for x in ids], pa.int32())}), out / f"part-{i}.parquet")
    (out / "_SUCCESS").write_bytes(b"")
    return out


def test_a_folder_is_read_whole(spark, folder):
    df = read_parquet(spark, str(folder))
    assert df.columns == ["id", "label"]
    assert sorted(tuple(r) for r in df.collect()) == [(1.0, 10), (2.0, 20), (3.0, 30)]
    assert read_parquet(spark, str(folder), ["label"], where="id > 1", where_columns=["id"], int64="integer64").count() == 2
    for more in ({"row_groups": [1]}, {"ordered": True}, {"numbered": True}):
        with pytest.raises(ValueError, match="folder"):
            read_parquet(spark, str(folder), **more)


def test_a_folder_of_different_columns_is_refused(spark, folder, tmp_path):
    pq.write_table(pa.table({"id": pa.array([4], pa.int32())}), folder / "part-3.parquet")
    with pytest.raises(ValueError, match="differ"):
        read_parquet(spark, str(folder))
    (tmp_path / "none").mkdir()
    for path, says in ((tmp_path, "folders within"), (tmp_path / "none", "no files")):
        with pytest.raises(ValueError, match=says):
            read_parquet(spark, str(path))


def test_plan_of_a_folder(spark, folder):
    plan = read_plan(spark, str(folder)).collect()
    assert [(r.column, r.path, r.nested, r.collectible) for r in plan] == [(1, "id", False, True), (2, "at.list.element", True, False), (3, "label", False, True)]
