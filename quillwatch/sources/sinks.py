"""Writers. Unless told to append, they replace what was there before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwatch.functions import safe_title
from quillwatch.session import delete, materialize, replace_folder
from quillwatch.sources import document_store


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write and read back, so that what follows reads the table instead of recomputing it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_raw_by_title(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw records as JSON, a folder per title under its file-safe name. Rebalancing gathers a
    title's rows for few files, and splits a title that is too big for one task. With ``mode``
    append, titles that are already there are left alone."""
    (
        records.withColumn("safe_title", safe_title("article_title"))
        .hint("rebalance", "safe_title")
        .write.mode(mode)
        .partitionBy("safe_title")
        .json(path)
    )


def as_documents(table: DataFrame) -> DataFrame:
    """One JSON document per row in ``value``, nulls kept."""
    return table.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish_documents(
    spark: SparkSession,
    collections: dict[str, DataFrame | None],
    folder: str,
    format: str = "text",
    **options,
) -> DataFrame:
    """Replace every collection by its table, one JSON document per row with nulls kept, and return
    (collection, documents): how many were stored. A missing table is skipped and counts 0.

    Text is written beside the collection and takes its place when it is whole; a write that fails leaves what was there.
    ``format`` documents writes to the store of ``document_store``, which readers see change at one moment. Any
    other ``format`` hands the rows themselves to that connector, with ``options`` and the collection name; they are written
    to a table of their own before, so that those counted are those handed over.
    """
    counts = []
    for name, table in collections.items():
        if table is None:
            counts.append((name, 0))
            continue
        if format == document_store.FORMAT:
            document_store.register(spark)
            as_documents(table).write.format(format).mode("overwrite").option("collection", name).save(folder)
            counts.append((name, document_store.count(folder, name)))
            continue
        if format == "text":
            staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
            try:
                as_documents(table).write.text(staged)
                counts.append((name, spark.read.text(staged).count()))
                replace_folder(spark, staged, f"{folder}/{name}")
            finally:
                delete(spark, staged)
        else:
            rows = materialize(table, "handed-over")
            rows.write.format(format).mode("overwrite").options(collection=name, **options).save()
            counts.append((name, rows.count()))
    return spark.createDataFrame(counts, "collection STRING, documents BIGINT")


def write_metrics(metrics: DataFrame, path: str) -> DataFrame:
    """Model metrics as JSON documents, read back with nested fields."""
    metrics.write.mode("overwrite").json(path)
    return metrics.sparkSession.read.schema(metrics.schema).json(path)
