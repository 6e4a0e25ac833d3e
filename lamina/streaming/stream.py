"""A folder of Parquet files as a stream, under the same read plan as a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import converters
from lamina.plans.plan import ReadOptions
from lamina.sources.scan import ParquetFile, quoted


def read_stream(spark: SparkSession, folder: str, example: str, columns: Sequence[str] | None = None, *, files_per_trigger: int | None = None, int64: str = "double", time: str = "numeric", tz: str = "UTC") -> DataFrame:
    """Rows of the files that arrive in ``folder``, converted as ``example``'s plan says.

    The schema comes from the file ``example``, never from data, so that every
    micro-batch has the same types.
    """
    f = ParquetFile(spark, example)
    rows = f.selected(columns, f.plan(ReadOptions(int64, time, tz)))
    leaves = f.footer.leaves
    reader = spark.readStream.schema(T.StructType([T.StructField(r.path, converters.read_type(leaves[r.column - 1]), True) for r in rows]))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder).select(*[converters.convert(r, leaves[r.column - 1], F.col(quoted(r.path)), validate_text=True).alias(r.path) for r in rows])
