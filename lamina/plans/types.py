"""Leaves of a Parquet schema and the physical type registry."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Fixed by the format and the mapping contract, in the format's own order: physical type -> (type it reads as without annotation, converter, what infers it on writing).
PHYSICAL = {
    "BOOLEAN": ("logical", "boolean", "logical"),
    "INT32": ("integer", "int32", "integer"),
    "INT64": ("double", "int64", "numeric (explicit schema)"),
    "INT96": ("POSIXct", "int96", None),
    "FLOAT": ("double", "float", "numeric (explicit schema)"),
    "DOUBLE": ("double", "double", "double"),
    "BYTE_ARRAY": ("list", "binary", "character or factor"),
    "FIXED_LEN_BYTE_ARRAY": ("list", "binary", None),
}


@dataclass(frozen=True)
class Leaf:
    """One physical column; ``path`` is the full dotted path, ``logical_details`` the annotation's parameters as text."""

    column: int
    name: str
    path: str
    physical_type: str
    logical_type: str | None = None
    logical_details: str | None = None
    repetition_type: str = "OPTIONAL"
    type_length: int | None = None
    max_definition_level: int = 1
    max_repetition_level: int = 0

    @property
    def nested(self) -> bool:
        return self.max_repetition_level > 0 or self.path != self.name

    @property
    def details(self) -> dict[str, str]:
        return dict(re.findall(r"(\w+)=([^,]*)", self.logical_details or ""))


def type_mapping(spark: SparkSession) -> DataFrame:
    """``physical_type, r_type, written_from``: the fallbacks of columns without annotation."""
    return spark.createDataFrame([(k, r, w) for k, (r, _, w) in PHYSICAL.items()], "physical_type string, r_type string, written_from string")
