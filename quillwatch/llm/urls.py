"""URL filters: rules on hosts and path prefixes, found by hashed expressions.

A rule names a host and the beginning of a path, as ``example.org/en/1``. It fits its host and all
subdomains, where the path starts with the rule's. A URL is expanded into every pair of a host suffix
and a path prefix that a rule could name (numbers of labels and prefix lengths that no rule has are
not expanded), each expression is hashed, the leading bytes of the hash are joined with the rules',
and the full digest decides. The longest rule wins; of equally long ones that with the longer host.
A rule given twice with different verdicts blocks.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
path follows up to ``?``, ``#`` or the end. Null, or a URL without ``://``, has an empty host and path
and gets the default verdict, as does every URL that no rule fits. A rule with a null or empty host
fits nothing; a null path is empty. Each distinct URL is judged once, so frequent URLs and hosts are
reduced before they are shuffled. Other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwatch.llm.tables import free_name
from quillwatch.session import materialize

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
_SHORT_BYTES = 4


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _digest(host: Column, path: Column) -> Column:
    """Digest of an expression; the line break keeps host and path apart."""
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with digests and rank, one row per host and path."""
    host = F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER)
    rules = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host != ''")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), F.col("path"))
    return rules.select(
        digest.alias("rule_digest"),
        F.substring(digest, 1, _SHORT_BYTES).alias("short"),
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("path_length"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("found"),
    )


def expressions(urls: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """(url, digest, short) for every host suffix of so many labels and path prefix of so many code points."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.lit(labels).cast("array<int>"), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    pairs = urls.where("host != ''").select("url", "path", F.explode(suffixes).alias("suffix"))
    pairs = pairs.select("url", "suffix", F.explode(prefixes).alias("prefix"))
    pairs = pairs.select("url", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
    return pairs.withColumn("short", F.substring("digest", 1, _SHORT_BYTES))


def judge(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule (null: none fits) and verdict; names already taken get underscores in front."""
    host, path, rule, verdict = (free_name(pages, c) for c in ("host", "path", "rule", "verdict"))
    rules = materialize(prepared(rules), "rules")
    # As many numbers as the longest rule has labels or code points, at most.
    labels = [r[0] for r in rules.select("labels").distinct().collect()]
    lengths = [r[0] for r in rules.select("path_length").distinct().collect()]
    urls = pages.select(F.col(url_column).alias("url")).where("url is not null").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fits = expressions(urls, labels, lengths).join(rules, "short").where(F.col("digest") == F.col("rule_digest"))
    judged, found = (free_name(pages, c) for c in ("judged_url", "found"))
    best = fits.groupBy(F.col("url").alias(judged)).agg(F.max("found").alias(found))
    url = F.col(f"p.{url_column}")
    return pages.alias("p").join(best, url == F.col(judged), "left").select(
        "p.*",
        host_of(url).alias(host),
        path_of(url).alias(path),
        F.col(found)["rule"].alias(rule),
        F.coalesce(F.col(found)["verdict"], F.lit(default)).alias(verdict),
    )
