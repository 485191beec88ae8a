"""Which files of a feed are new, changed or gone since the last run, so that only those are read.

The kept state is a table with a row per file (dataset, path, length, modified) and what was found in it. A file counts as
changed when its length or its time of change differs. The state is replaced when all new and changed files have been
read, so a run that fails is followed by one that reads the same files again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwatch.session import delete, exists, materialize, replace_folder
from quillwatch.sources import raw

NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"
_KEY = ["dataset", "path"]
_COUNTS = ["records", "keyed_records", "unreadable"]
STATE = "dataset STRING, path STRING, length BIGINT, modified TIMESTAMP, file STRING, records BIGINT, keyed_records BIGINT, unreadable BIGINT"


def changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """(dataset, path, change, length, modified) of every file in either manifest; length and time are those of now, or the
    last known ones of a file that is gone. The sides have one row per file."""
    seen = lambda side: F.col(f"{side}.path").isNotNull()
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("length", "modified")]
    change = F.when(~seen("a"), NEW).when(~seen("b"), GONE).when(same[0] & same[1], SAME).otherwise(CHANGED)
    keys = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in _KEY]
    told = lambda c: F.when(seen("b"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return before.alias("a").join(now.alias("b"), keys, "full").select(
        *[F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in _KEY], change.alias("change"), told("length"), told("modified")
    )


def to_read(found: DataFrame, dataset: str) -> list[str]:
    """Paths of the files that are new or changed, as the readers take them: they read some characters as
    patterns, so these are escaped. The list is on the driver, like every file listing of Spark."""
    rows = found.where((F.col("dataset") == dataset) & F.col("change").isin(NEW, CHANGED)).select("path").collect()
    return [re.sub(r"([{}\[\]*?,\\])", r"\\\1", r.path) for r in rows]


def remembered(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(state) if exists(spark, state) else spark.createDataFrame([], STATE)


def feed_counts(spark: SparkSession, datasets: dict[str, tuple[str, str]], state: str, pretty: bool = False) -> DataFrame:
    """``raw.feed_counts`` of every named (path, key field), for which only files are read that are new or changed since
    the last call with this ``state``."""
    now = materialize(raw.file_manifest(spark, {name: path for name, (path, _) in datasets.items()}), "manifest")
    before = remembered(spark, state)
    found = materialize(changes(before, now), "changes")
    counted = found.where(F.col("change") == SAME).select(*_KEY).join(before.select(*_KEY, *_COUNTS), _KEY)
    for name, (_, key_field) in datasets.items():
        if paths := to_read(found, name):
            read = raw.ingest_counts(spark, paths, key_field, pretty)
            files = now.where(F.col("dataset") == name).select(*_KEY, "file")
            counted = counted.unionByName(files.join(read, "file").select(*_KEY, *_COUNTS))
    staged = f"{state}-{uuid.uuid4().hex}"
    try:
        now.join(counted, _KEY).select([c.split()[0] for c in STATE.split(", ")]).write.parquet(staged)
        replace_folder(spark, staged, state)
    finally:
        delete(spark, staged)
    return remembered(spark, state).select("file", *_COUNTS, "dataset")
