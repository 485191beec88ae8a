"""Weekly edit statistics over a growing revision log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillwatch.functions import per
from quillwatch.session import fresh_path

# Windows count from Thursday 1970-01-01; four days later is a Monday.
_MONDAY = "4 days"


def weekly_edit_stream(revisions: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Weekly statistics of a streaming revision table (``edit_timestamp`` as TIMESTAMP).

    Edits are first counted per (week, article, editor), then per (week, article): editors
    come out exact, a giant article spreads over its editors, and state holds counters only.
    A week is final once the watermark passes its end.
    """
    per_editor = (
        revisions.withWatermark("edit_timestamp", lateness)
        .groupBy(F.window("edit_timestamp", "7 days", startTime=_MONDAY), "article_title", "user")
        .agg(F.count("revid").alias("edits"), F.count_if("is_revert").alias("reverts"))
    )
    weeks = F.window(F.window_time("window"), "7 days", startTime=_MONDAY)
    return (
        per_editor.groupBy(weeks.alias("week"), "article_title")
        .agg(
            F.sum("edits").alias("weekly_edits"),
            F.sum("reverts").alias("weekly_reverts"),
            F.count("user").alias("weekly_editors"),
        )
        .select(
            "article_title",
            F.to_date("week.start").alias("week_start"),
            "weekly_edits",
            "weekly_reverts",
            "weekly_editors",
            per("weekly_reverts", "weekly_edits").alias("weekly_reversion_rate"),
        )
    )


def run_available(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Process all input that is there now into a Parquet table and return that table. Given
    the same ``path`` again, it takes up where it left off."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/progress")
        .option("path", f"{path}/table")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")
