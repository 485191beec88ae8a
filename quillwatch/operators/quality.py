"""Checks over inputs and outputs, as rows (check, observed, expected, passed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwatch.session import materialize

MIN_FILES = 10


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of every table. Each count is a single partial aggregate per task."""
    counts = [
        t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, t in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def with_total(counts: DataFrame) -> DataFrame:
    """Counts per table plus a row ``total``."""
    return counts.unionByName(counts.agg(F.sum("rows").alias("rows")).select(F.lit("total").alias("name"), "rows"))


def at_least(counts: DataFrame, prefix: str, minimum: int) -> DataFrame:
    """Checks that each (name, rows) reaches ``minimum``."""
    return counts.select(
        F.concat(F.lit(prefix + ":"), F.col("name")).alias("check"),
        F.col("rows").alias("observed"),
        F.lit(minimum).cast("bigint").alias("expected"),
        (F.col("rows") >= minimum).alias("passed"),
    )


def min_files(manifest: DataFrame, datasets: list[str], minimum: int = MIN_FILES) -> DataFrame:
    """Each named dataset of a manifest (dataset, path, length) must have enough files; one
    without any file fails."""
    found = manifest.groupBy(F.col("dataset").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    wanted = manifest.sparkSession.createDataFrame([(d,) for d in datasets], "name STRING")
    counts = wanted.join(found, "name", "left").fillna({"rows": 0})
    return at_least(counts, "min_files", minimum)


def required_field(raw: DataFrame, field: str) -> DataFrame:
    """No record may lack ``field``; every record is looked at, not a sample."""
    missing = raw.agg(F.count_if(F.col(field).isNull()).alias("observed"))
    return missing.select(
        F.lit(f"required_field:{field}").alias("check"),
        "observed",
        F.lit(0).cast("bigint").alias("expected"),
        (F.col("observed") == 0).alias("passed"),
    )


def outputs_present(tables: dict[str, DataFrame], may_be_empty: tuple[str, ...] = ()) -> DataFrame:
    """Every table can be read and has rows; those in ``may_be_empty`` need no rows."""
    counts = table_counts(tables)
    optional = F.col("name").isin(*may_be_empty)
    return at_least(counts.filter(~optional), "output", 1).unionByName(
        at_least(counts.filter(optional), "output", 0)
    )


def _equal(observed: DataFrame, check, expected: Column) -> DataFrame:
    """Checks that ``observed`` in each row is as expected."""
    return observed.select(
        check.alias("check"), "observed", expected.cast("bigint").alias("expected"),
        F.coalesce(F.col("observed") == expected, F.lit(False)).alias("passed"),
    )


def unique_key(table: DataFrame, key: str, name: str) -> DataFrame:
    """No key may stand on two rows."""
    repeated = table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _equal(repeated.agg(F.count(F.lit(1)).alias("observed")), F.lit(f"unique:{name}.{key}"), F.lit(0))


def readable(totals: DataFrame) -> DataFrame:
    """No record of a feed may be unreadable. ``totals`` are (dataset, unreadable)."""
    counts = totals.select("dataset", F.col("unreadable").alias("observed"))
    return _equal(counts, F.concat(F.lit("readable:"), "dataset"), F.lit(0))


def not_silent(totals: DataFrame) -> DataFrame:
    """No file of a feed may be without any record, as one is that cannot be opened. ``totals``
    are (dataset, silent_files)."""
    counts = totals.select("dataset", F.col("silent_files").alias("observed"))
    return _equal(counts, F.concat(F.lit("not_silent:"), "dataset"), F.lit(0))


def keyed(totals: DataFrame) -> DataFrame:
    """No record of a feed may lack its key. ``totals`` are (dataset, records, keyed_records)."""
    counts = totals.select("dataset", (F.col("records") - F.col("keyed_records")).alias("observed"))
    return _equal(counts, F.concat(F.lit("required_field:"), "dataset"), F.lit(0))


def complete(totals: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Every record with a key has to be in the clean table. ``cleaned`` are (name, rows), where
    the name is the dataset's."""
    both = totals.join(cleaned.withColumnRenamed("name", "dataset"), "dataset", "left")
    both = both.select("dataset", F.coalesce("rows", F.lit(0)).alias("observed"), "keyed_records")
    return _equal(both, F.concat(F.lit("complete:"), "dataset"), F.col("keyed_records"))


def models_measured(metrics: DataFrame, features: int) -> DataFrame:
    """Every model needs its three scores and a ranking of all features; ``observed`` counts what is there."""
    there = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    observed = there("accuracy") + there("auc") + there("f1") + F.coalesce(F.size("feature_importance"), F.lit(0))
    return _equal(metrics.select("model", observed.cast("bigint").alias("observed")), F.concat(F.lit("model:"), "model"), F.lit(3 + features))


def summary(checks: DataFrame) -> DataFrame:
    """One row per check with its outcome, and the overall tally on each. The checks are
    evaluated once and written."""
    written = materialize(checks, "checks")
    return written.select(
        "check",
        F.when(F.col("passed"), "PASSED").otherwise("NEEDS ATTENTION").alias("outcome"),
        written.agg(F.count_if("passed")).scalar().alias("passed_checks"),
        written.agg(F.count(F.lit(1))).scalar().alias("total_checks"),
    )
