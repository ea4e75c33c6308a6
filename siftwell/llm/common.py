"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from siftwell.plans.session import cut, prepare, read_table

__all__ = ["cut", "prepare", "read_table", "fold", "map_batches", "utf8"]


def fold(key: Column | str, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``parts`` (null id: null)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(parts))


def utf8(column: pa.Array) -> list[bytes]:
    """The column's values as UTF-8 bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | None]], schema: str) -> DataFrame:
    """Arrow map without a shuffle: ``make()`` runs once per task and gives the function applied to each batch.

    Batches are bounded in bytes by Spark (``spark.sql.execution.arrow.maxBytesPerBatch``),
    so the memory of a worker doesn't follow the size of a partition.
    """
    prepare(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            if batch.num_rows and (out := apply(batch)) is not None:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)
