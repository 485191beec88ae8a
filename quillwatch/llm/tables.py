"""Small helpers on DataFrames shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array]], added: T.StructType) -> DataFrame:
    """df with further columns, which ``make`` computes for each Arrow batch inside the tasks.

    A column of df that is called like an added one is replaced."""
    new = {f.name for f in added.fields}
    old = [i for i, f in enumerate(df.schema.fields) if f.name not in new]
    schema = T.StructType([*(df.schema.fields[i] for i in old), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [*(batch.column(i) for i in old), *make(batch)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)
