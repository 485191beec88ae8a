"""How filters overlap: what each removes, in every order they may be applied in.

A document's failures are a number with a bit for each filter. What a filter removes at any step of
any order follows from how many documents there are of each number, so documents are read once and
only counts (32 per part for five filters) meet the orders.

The first filters judge a text by itself. The last one, E, removes a text that a document with a smaller id
holds, too: an existential self-join. Hashes that occur once cannot have a partner; for the others the
texts meet on the hash, and a left-semi join on hash, exact text and smaller id marks E. Its partners are one
row per text, that with the smallest id, so a group of copies costs a row per copy and no pairs. A
hash with many copies is dealt out by a number, to as many keys as it has ``COPIES_PER_KEY`` copies; its partner rows
are repeated for each. The marked rows, united with the failures of the other filters, are added up to one number per row.

Null text counts as empty. A null part and an empty one are the part of empty name. Rows of equal id each count;
none of them is smaller than the other. A null id is neither smaller nor larger than any, so such rows never fail E and
have no label. A document has a label if any of its label rows says 1; null labels say nothing. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillwatch.session import materialize

FILTERS = "ABCDE"
COPIES_PER_KEY = 10_000

# Limits of the first four filters.
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SIGNS = "[#$%&*|]"

_BLANKS = "\t\n\x0b\x0c\r"


def own_failures(text: Column) -> list[Column]:
    """Whether a text fails filters A to D, judged by itself."""
    words = F.filter(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), lambda w: w != "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        n_words < LEAST_WORDS,
        100 * distinct < DISTINCT_PERCENT * n_words,
        100 * capitals > CAPITAL_PERCENT * F.length(text),
        text.rlike(SIGNS),
    ]


def _bits(failures: list[Column]) -> Column:
    return reduce(Column.__add__, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures)])


def copies_of_smaller(rows: DataFrame, texts: DataFrame, per_key: int = COPIES_PER_KEY) -> DataFrame:
    """The ``row`` of each text that a smaller id holds, too. rows: (row, id, hash); texts: (id, hash, text), the same
    documents. Rows of one id and text are all marked or none is."""
    shared = rows.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(shared.select("hash", F.ceil(F.col("n") / per_key).alias("keys")), "shared-hashes")
    # Written here, so that Spark can split what a hot hash gets in this join.
    held = materialize(texts.where("id IS NOT NULL").join(shared, "hash"), "shared-texts")
    least = held.groupBy("hash", "text").agg(F.min("id").alias("least"), F.first("keys").alias("keys"))
    partners = least.select("hash", "text", "least", F.explode(F.sequence(F.lit(0), F.col("keys") - 1)).alias("key")).alias("p")
    copies = held.withColumn("key", F.pmod(F.xxhash64("id"), F.col("keys"))).alias("c")
    same = [F.col(f"c.{c}") == F.col(f"p.{c}") for c in ("hash", "key", "text")]
    marked = copies.join(partners, [*same, F.col("p.least") < F.col("c.id")], "left_semi").select("hash", "id").distinct()
    return rows.join(marked, ["hash", "id"], "left_semi").select("row")


def failing_rows(docs: DataFrame, id_column: str = "doc_id", part_column: str = "lang", text_column: str = "text") -> DataFrame:
    """One row per document: (id, part, mask), the mask with a bit for each filter that it fails."""
    text = F.coalesce(text_column, F.lit(""))
    hashed = F.xxhash64(text)
    own = docs.select(
        F.col(id_column).alias("id"), F.coalesce(part_column, F.lit("")).alias("part"),
        _bits(own_failures(text)).alias("mask"), hashed.alias("hash"), F.monotonically_increasing_id().alias("row"),
    )
    own = materialize(own, "failures")
    texts = docs.select(F.col(id_column).alias("id"), hashed.alias("hash"), text.alias("text"))
    copies = copies_of_smaller(own.select("row", "id", "hash"), texts)
    last = 1 << (len(FILTERS) - 1)
    failures = own.select("row", "id", "part", "mask").unionByName(copies.withColumn("mask", F.lit(last)), allowMissingColumns=True)
    return failures.groupBy("row").agg(F.max("id").alias("id"), F.max("part").alias("part"), F.bit_or("mask").alias("mask")).drop("row")


def combinations(failures: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents fail exactly the filters of the mask."""
    says = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(says("quality"), says("toxic"))
    return failures.join(known, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))],
    )


def in_every_order(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts by part and mask."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    steps = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"),
            F.lit(bit[order[k]]).alias("bit"), F.lit(sum(bit[f] for f in order[:k])).alias("before"),
        )
        for order in permutations(filters) for k in range(len(order))
    ]
    # A constant list per row of counts: 600 steps for each of at most 32 masks of a part.
    rows = counts.select("*", F.explode(F.array(*steps)).alias("at")).select("*", "at.*")
    fails, passed = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) == 0
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0))
    found = rows.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & passed).alias("kept"),
        total(fails & passed).alias("removed"),
        total(fails & ~passed).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & passed, "good").alias("good_lost"),
        total(fails & passed, "toxic").alias("toxic_lost"),
    )
    shares = found.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return found.join(shares, ["part", "bit"]).drop("bit")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley by part, filter_order and step."""
    counts = materialize(combinations(failing_rows(docs), labels), "combinations")
    return in_every_order(counts)
