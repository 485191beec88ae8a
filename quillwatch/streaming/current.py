"""Weekly edit statistics that show the running weeks, too, and lose no late edit.

Every micro-batch adds what it holds to the weeks that are still open, as counts per article, week and editor in a folder with
the batch's number. A week is closed for a batch when the latest edit of earlier batches lies more than ``lateness``
behind its end; edits of closed weeks, and edits without a time, go to a side table. All of this follows from the
batch and the batches before it, and a batch only writes to folders of its own number, so a batch that is given
again after a failure replaces what it wrote. A batch counts once its mark is written, which comes last.

    weeks/batch=n   article_title, week_start, user, edits, reverts
    apart/batch=n   edits that are in no week, with a reason: late or untimed
    marks/batch=n   one row: edits, apart, latest
    base            weeks and marks of all batches up to a number, summed up by ``compact``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwatch.functions import per, week_start
from quillwatch.session import delete, exists, fresh_path, materialize, replace_folder, scratch

EDIT = "article_title STRING, revid BIGINT, user STRING, edit_timestamp TIMESTAMP, is_revert BOOLEAN"
_WEEKS = "article_title STRING, week_start DATE, user STRING, edits BIGINT, reverts BIGINT"
_APART = f"{EDIT}, reason STRING"
_MARKS = "edits BIGINT, apart BIGINT, latest TIMESTAMP, upto BIGINT"
_COLUMNS = ["article_title", "revid", "user", "edit_timestamp", "is_revert"]
LATE, UNTIMED = "late", "untimed"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table in batches, with ``batch``; empty before the first one."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch BIGINT")
    return spark.read.schema(f"{schema}, batch BIGINT").option("basePath", path).parquet(path)


def _summed_up_to(spark: SparkSession, store: str) -> int:
    """Number of the last batch in the base, -1 without one."""
    if not exists(spark, f"{store}/base"):
        return -1
    return spark.read.schema(_MARKS).parquet(f"{store}/base/marks").first()["upto"]


def _marks(spark: SparkSession, store: str) -> DataFrame:
    """One row per batch, and one for all batches of the base under the number of the last of them."""
    upto = _summed_up_to(spark, store)
    marks = _read(spark, f"{store}/marks", _MARKS).where(F.col("batch") > upto).select("edits", "apart", "latest", "batch")
    if upto < 0:
        return marks
    base = spark.read.schema(_MARKS).parquet(f"{store}/base/marks")
    return marks.unionByName(base.select("edits", "apart", "latest", F.col("upto").alias("batch")))


def _watermark(marks: DataFrame, lateness: str) -> Column:
    return F.lit(marks.agg(F.max("latest") - F.expr(f"INTERVAL {lateness}")).first()[0]).cast("timestamp")


def _closed(week: Column, watermark: Column) -> Column:
    return F.coalesce(F.date_add(week, 7).cast("timestamp") <= watermark, F.lit(False))


def apply_batch(spark: SparkSession, store: str, edits: DataFrame, batch: int, lateness: str = "1 day") -> None:
    """Add the edits of one batch; given again, it replaces what it added."""
    if batch <= _summed_up_to(spark, store):
        return
    with scratch(spark):
        rows = materialize(edits.select(*_COLUMNS).withColumn("week_start", week_start("edit_timestamp")), "batch")
        watermark = _watermark(_marks(spark, store).where(F.col("batch") < batch), lateness)
        reason = F.when(F.col("week_start").isNull(), UNTIMED).when(_closed(F.col("week_start"), watermark), LATE)
        rows = rows.withColumn("reason", reason)
        counted = rows.where("reason IS NULL").groupBy("article_title", "week_start", "user").agg(
            F.count("revid").alias("edits"), F.count_if("is_revert").alias("reverts")
        )
        apart = rows.where("reason IS NOT NULL").select(*_COLUMNS, "reason")
        mark = rows.agg(
            F.count(F.lit(1)).alias("edits"), F.count("reason").alias("apart"),
            F.max("edit_timestamp").alias("latest"), F.lit(batch).cast("bigint").alias("upto"),
        )
        for name, table in (("weeks", counted), ("apart", apart), ("marks", mark)):
            table.write.mode("overwrite").parquet(f"{store}/{name}/batch={batch}")


def follow(edits: DataFrame, store: str | None = None, lateness: str = "1 day") -> str:
    """Add all edits of a stream that are there now, and return the store. Given the same store again, go on from there."""
    spark = edits.sparkSession
    store = store or fresh_path(spark, "weeks")
    add: Callable[[DataFrame, int], None] = lambda rows, batch: apply_batch(rows.sparkSession, store, rows, batch, lateness)
    query = edits.writeStream.foreachBatch(add).option("checkpointLocation", f"{store}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return store


def _contributions(spark: SparkSession, store: str) -> DataFrame:
    """Counts per article, week and editor of all batches that have their mark, one row or more for each."""
    marked = _read(spark, f"{store}/marks", _MARKS).select("batch")
    upto = _summed_up_to(spark, store)
    found = _read(spark, f"{store}/weeks", _WEEKS).where(F.col("batch") > upto).join(marked, "batch", "left_semi").drop("batch")
    return found if upto < 0 else found.unionByName(spark.read.schema(_WEEKS).parquet(f"{store}/base/weeks"))


def _per_editor(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("article_title", "week_start", "user").agg(F.sum("edits").alias("edits"), F.sum("reverts").alias("reverts"))


def weeks(spark: SparkSession, store: str, lateness: str = "1 day") -> DataFrame:
    """The statistics of every week as known now. ``closed`` weeks do not change any more."""
    found = _per_editor(_contributions(spark, store)).groupBy("article_title", "week_start").agg(
        F.sum("edits").alias("weekly_edits"), F.sum("reverts").alias("weekly_reverts"), F.count("user").alias("weekly_editors")
    )
    return found.select(
        "*",
        per("weekly_reverts", "weekly_edits").alias("weekly_reversion_rate"),
        _closed(F.col("week_start"), _watermark(_marks(spark, store), lateness)).alias("closed"),
    )


def set_apart(spark: SparkSession, store: str) -> DataFrame:
    """Edits that are in no week, with the reason and the batch they came in."""
    marked = _read(spark, f"{store}/marks", _MARKS).select("batch")
    return _read(spark, f"{store}/apart", _APART).join(marked, "batch", "left_semi")


def totals(spark: SparkSession, store: str) -> DataFrame:
    """One row: edits that came in, and those set apart. What is left is in the weeks."""
    return _marks(spark, store).agg(F.coalesce(F.sum("edits"), F.lit(0)).alias("edits"), F.coalesce(F.sum("apart"), F.lit(0)).alias("apart"))


def compact(spark: SparkSession, store: str) -> None:
    """Sum up all batches so far into the base, and delete their folders. Not while a batch is added. Marks stay, being one
    row each, since they tell which edits set apart count."""
    last = _marks(spark, store).agg(F.max("batch")).first()[0]
    before = _summed_up_to(spark, store)
    if last is None or last == before:
        return
    staged = fresh_path(spark, "base")
    _per_editor(_contributions(spark, store)).write.parquet(f"{staged}/weeks")
    _marks(spark, store).agg(
        F.sum("edits").alias("edits"), F.sum("apart").alias("apart"), F.max("latest").alias("latest"), F.max("batch").alias("upto")
    ).write.parquet(f"{staged}/marks")
    replace_folder(spark, staged, f"{store}/base")
    for batch in range(before + 1, last + 1):
        delete(spark, f"{store}/weeks/batch={batch}")
