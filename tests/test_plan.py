"""The read plan, on leaves alone."""

import pytest

from lamina.plans.plan import ReadOptions, build_plan
from lamina.plans.types import Leaf


def plan(physical, logical=None, details=None, **options):
    return build_plan([Leaf(1, "x", "x", physical, logical, details)], ReadOptions(**options))[0]


# Fixed values of the mapping contract, in the order of the format's types.
@pytest.mark.parametrize(
    ("physical", "logical", "details", "options", "r_type", "converter"),
    [
        ("BOOLEAN", None, None, {}, "logical", "boolean"),
        ("INT32", None, None, {}, "integer", "int32"),
        ("INT32", "DATE", None, {}, "Date", "date32"),
        ("INT32", "INTEGER", "bit_width=8, signed=true", {}, "integer", "int32"),
        ("INT32", "INTEGER", "bit_width=16, signed=false", {}, "integer", "int32"),
        ("INT32", "INTEGER", "bit_width=32, signed=true", {}, "integer", "int32"),
        ("INT32", "INTEGER", "bit_width=32, signed=false", {}, "double", "uint32"),
        ("INT64", None, None, {}, "double", "int64_double"),
        ("INT64", None, None, {"int64": "integer64"}, "integer64", "int64_bit64"),
        ("INT64", "INTEGER", "bit_width=64, signed=false", {}, "double", "int64_double"),
        ("INT64", "TIMESTAMP", "unit=MICROS, adjusted_to_utc=true", {}, "POSIXct", "timestamp_utc_micros_UTC"),
        ("INT64", "TIMESTAMP", "unit=NANOS, adjusted_to_utc=false", {"tz": "Europe/Berlin"}, "POSIXct", "timestamp_local_nanos_Europe/Berlin"),
        ("INT32", "TIME", "unit=MILLIS, adjusted_to_utc=true", {}, "double", "time_numeric_millis"),
        ("INT64", "TIME", "unit=NANOS, adjusted_to_utc=true", {"time": "hms"}, "hms", "time_hms_nanos"),
        ("INT96", None, None, {}, "POSIXct", "int96"),
        ("FLOAT", None, None, {}, "double", "float"),
        ("INT32", "DECIMAL", "precision=7, scale=2", {}, "double", "decimal_int_2"),
        ("BYTE_ARRAY", "DECIMAL", "precision=7, scale=3", {}, "double", "decimal_binary_3"),
        ("BYTE_ARRAY", "STRING", None, {}, "character", "text"),
        ("BYTE_ARRAY", "ENUM", None, {}, "character", "text"),
        ("BYTE_ARRAY", "JSON", None, {}, "character", "text"),
        ("BYTE_ARRAY", "BSON", None, {}, "list", "binary"),
        ("BYTE_ARRAY", None, None, {}, "list", "binary"),
        ("BYTE_ARRAY", "GEOMETRY", "crs=OGC:CRS84", {}, "list", "binary"),
        ("FIXED_LEN_BYTE_ARRAY", "UUID", None, {}, "character", "uuid"),
        ("FIXED_LEN_BYTE_ARRAY", "FLOAT16", None, {}, "double", "float16"),
        ("FIXED_LEN_BYTE_ARRAY", "INTERVAL", None, {}, "list", "binary"),
        ("INT32", "NULL", None, {}, "logical", "null_logical"),
    ],
)
def test_mapping(physical, logical, details, options, r_type, converter):
    row = plan(physical, logical, details, **options)
    assert (row.r_type, row.converter, row.collectible) == (r_type, converter, True)


def test_notes():
    nested = build_plan([Leaf(1, "b", "a.b", "INT32"), Leaf(2, "element", "n.list.element", "INT32", max_repetition_level=1)])
    assert all(r.nested and not r.collectible and r.note for r in nested)
    assert plan("INT64", "DATE").note == "annotation DATE has no meaning for INT64 here; comes as double"
    assert plan("OTHER").note == "no column is made from OTHER"
    assert plan("INT32", "DATE").note is None
    assert not build_plan([Leaf(1, "x", "x", "INT32", max_definition_level=0)])[0].nullable


@pytest.mark.parametrize("bad", [{"int64": "long"}, {"time": "text"}, {"tz": ""}, {"tz": "Nowhere/City"}, {"tz": None}])
def test_options(bad):
    with pytest.raises(ValueError):
        ReadOptions(**bad)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lamina.session import run_dir, shared_dir

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master, applicationId="app-1"))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
        assert run_dir(session(master, "hdfs://x/shared/")) == "hdfs://x/shared/lamina/app-1"
