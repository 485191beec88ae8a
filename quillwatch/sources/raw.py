"""Readers of the raw feeds and of files in general."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillwatch import schemas


# What belongs to a feed: every file in its folder and below, compressed ones too. Names that
# begin with a dot or underscore are no data to any reader.
FILES = {"recursiveFileLookup": True}
LENIENT = {**FILES, "mode": "PERMISSIVE", "ignoreCorruptFiles": True, "ignoreMissingFiles": True}


def _scan(spark: SparkSession, path: str, schema: str, pretty: bool) -> DataFrame:
    """JSON records with a fixed schema. A line may hold one record or an array of records;
    unreadable lines become rows of nulls, unreadable or vanished files are passed over.
    ``ingest_counts`` tells how many there were.

    ``pretty`` is for documents spread over several lines: such a file cannot be split, so
    keep it to small files."""
    return spark.read.schema(schema).options(**LENIENT, multiLine=pretty).json(path)


def scan_revisions(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    return _scan(spark, path, schemas.REVISION, pretty)


def stream_revisions(spark: SparkSession, path: str) -> DataFrame:
    """The revision feed as a stream: files that appear under ``path`` are read once each."""
    return spark.readStream.schema(schemas.REVISION).options(**LENIENT).json(path)


def scan_entities(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    return _scan(spark, path, schemas.ENTITY, pretty)


def scan_pageviews(spark: SparkSession, path: str, pretty: bool = False) -> DataFrame:
    return _scan(spark, path, schemas.PAGEVIEW, pretty)


_XML_REVISION = (
    "id BIGINT, parentid BIGINT, timestamp STRING, contributor STRUCT<username: STRING, id: BIGINT, ip: STRING>, "
    "comment STRING, text STRUCT<_bytes: BIGINT, _VALUE: STRING>"
)


def scan_xml_dump(spark: SparkSession, path: str) -> DataFrame:
    """Revisions of XML dumps: one row per <revision>, with the title of its <page>.

    Records end with </revision>, so a file is read in splits wherever a page begins or ends,
    and no page is held as a whole. A record that opens a page carries its title; the records
    after it take it from the nearest one before them in their block of the file, or else from
    the last title of an earlier block. Texts are dropped before that."""
    parts = spark.read.options(**FILES, lineSep="</revision>").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    opening = F.regexp_extract("value", r"(?s).*<page>(.*?)<revision>", 1)
    body = F.concat(F.lit("<revision>"), F.substring_index("value", "<revision>", -1), F.lit("</revision>"))
    page = F.from_xml(F.concat(F.lit("<page>"), opening, F.lit("</page>")), "title STRING, id BIGINT")
    records = parts.filter(F.contains("value", F.lit("<revision>"))).select(
        "file", "block", "at",
        F.when(opening != "", page).alias("page"),
        F.from_xml(body, _XML_REVISION).dropFields("text._VALUE").alias("r"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = records.groupBy("file", "block").agg(F.max_by("page", F.when(F.col("page").isNotNull(), F.col("at"))).alias("page"))
    carried = last.select("file", "block", F.last("page", ignorenulls=True).over(earlier).alias("carried"))
    titled = records.withColumn("page", F.last("page", ignorenulls=True).over(in_block)).join(carried, ["file", "block"], "left")
    r, page = F.col("r"), F.coalesce("page", "carried")
    return titled.select(
        r["id"].alias("revid"),
        r["parentid"].alias("parentid"),
        r["timestamp"].alias("timestamp"),
        F.coalesce(r["contributor"]["username"], r["contributor"]["ip"]).alias("user"),
        F.coalesce(r["contributor"]["id"], F.lit(0)).alias("userid"),
        r["comment"].alias("comment"),
        r["text"]["_bytes"].alias("size"),
        F.translate(page["title"], " ", "_").alias("article_title"),
        page["id"].alias("pageid"),
    )


def file_manifest(spark: SparkSession, datasets: dict[str, str | list[str]]) -> DataFrame:
    """(dataset, path, length, modified, file) of every file a scan of each dataset's path would
    read; ``file`` is the encoded name that scans report. File contents are not read."""
    listings = [
        spark.read.format("binaryFile")
        .options(**FILES)
        .load(path)
        .select(
            F.lit(name).alias("dataset"), "path", "length", F.col("modificationTime").alias("modified"),
            F.col("_metadata.file_path").alias("file"),
        )
        for name, path in datasets.items()
    ]
    out = listings[0]
    for listing in listings[1:]:
        out = out.unionByName(listing)
    return out


def ingest_counts(spark: SparkSession, path: str | list[str], key_field: str, pretty: bool = False) -> DataFrame:
    """(file, records, keyed_records, unreadable) of every file a scan of ``path`` would read:
    arrays count their elements, objects count one; what cannot be parsed is ``unreadable``, and
    a file that cannot be opened has no records."""
    parsed = (
        spark.read.schema(f"{key_field} STRING, _broken STRING")
        .options(**LENIENT, columnNameOfCorruptRecord="_broken", multiLine=pretty)
        .json(path)
        .select(F.col("_metadata.file_path").alias("file"), key_field, "_broken")
    )
    # The record itself is counted, since Spark does not read a file for its damage alone.
    whole = F.when(F.col("_broken").isNull(), F.struct(key_field))
    counts = parsed.groupBy("file").agg(
        F.count(whole).alias("records"), F.count(key_field).alias("keyed_records"), F.count("_broken").alias("unreadable")
    )
    files = file_manifest(spark, {"": path}).select("file")
    return files.join(counts, "file", "left").fillna({"records": 0, "keyed_records": 0, "unreadable": 0})


def feed_counts(spark: SparkSession, datasets: dict[str, tuple[str, str]], pretty: bool = False) -> DataFrame:
    """``ingest_counts`` of every named (path, key field), with a column ``dataset``."""
    counts = None
    for name, (path, key_field) in datasets.items():
        one = ingest_counts(spark, path, key_field, pretty).withColumn("dataset", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return counts


def totals_of(counts: DataFrame) -> DataFrame:
    return counts.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in ("records", "keyed_records", "unreadable")],
        F.count_if(F.col("records") + F.col("unreadable") == 0).alias("silent_files"),
    )


def ingest_totals(spark: SparkSession, datasets: dict[str, tuple[str, str]]) -> DataFrame:
    """(dataset, files, records) per named (path, key field)."""
    return totals_of(feed_counts(spark, datasets)).select("dataset", "files", "records")
