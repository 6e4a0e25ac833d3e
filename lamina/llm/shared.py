"""Pieces that several operators share: staging, column checks, word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lamina.session import run_dir


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it again.

    Cuts the lineage: a lost executor makes Spark reread the files, not redo
    the work before them, and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for a shuffle whose tasks do much work for few bytes.

    Given explicitly, so that adaptive execution doesn't merge them by size.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The batch's texts as large strings, null as empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")


def text_slices(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; one longer text is a range of its own."""
    sizes = np.asarray(pc.binary_length(texts), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def split_coded(texts: pa.Array, pattern: str = " ") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Splits each text at ``pattern`` (a plain string).

    Returns row offsets into the pieces, the pieces as codes, and the distinct
    pieces that the codes number.
    """
    lists = pc.split_pattern(texts, pattern)
    coded = lists.values.dictionary_encode()
    return np.asarray(lists.offsets, dtype=np.int64), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


class Cache(dict):
    """A dict that forgets all when it is full: bounded memory, same results."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def room(self) -> None:
        if len(self) >= self.most:
            self.clear()


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; by one sort, which beats numpy's hashing here."""
    out = np.sort(values)
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


def gather(codes: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the runs ``flat[starts[c]:starts[c + 1]]`` for all ``c`` in ``codes``.

    Returns the joined values, and the offset of each run in them.
    """
    counts = np.diff(starts)[codes]
    ends = np.concatenate([[0], np.cumsum(counts)])
    kind = np.int32 if max(ends[-1], starts[-1]) < 1 << 31 else np.int64  # half the memory traffic, where it fits
    index = np.arange(ends[-1], dtype=kind) + np.repeat((starts[:-1][codes] - ends[:-1]).astype(kind), counts)
    return flat[index], ends
