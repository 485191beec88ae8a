"""Column expressions. Everything here compiles to JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comment fragments that mark an edit as undoing another one. The blank
# in "rv " is part of the fragment.
REVERT_WORDS = (
    "revert", "reverted", "rv ", "undid", "undo",
    "rollback", "restored", "reverting", "undone",
)

# Topics that take part in comparisons, in display order, and the label of
# articles that no topic list names.
TOPICS = ("political", "scientific", "cultural")
UNKNOWN_TOPIC = "unknown"

# Fixed value: an article whose reversion rate exceeds this is labelled unstable.
UNSTABLE_ABOVE = 0.15


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _needed(words: Sequence[str]) -> list[str]:
    """A word that contains another word of the list can never decide a match."""
    return [w for w in words if not any(o != w and o in w for o in words)]


def word_pattern(words: Sequence[str]) -> str:
    """Pattern that finds any of ``words`` anywhere in a text, ignoring the case of A to Z."""
    return "(?i)(" + "|".join(_needed(words)) + ")"


def mentions(text: Column | str, words: Sequence[str]) -> Column:
    """Whether any of ``words`` (in lower case) occurs in a text, ignoring the case of A to Z.
    Plain ASCII text is searched as bytes, several times faster than by pattern; lower-casing
    other text could turn foreign letters into these, so there the pattern decides."""
    text = _col(text)
    plain = F.octet_length(text) == F.length(text)
    found = reduce(lambda a, b: a | b, [F.lower(text).contains(w) for w in _needed(words)])
    return (plain & found) | (~plain & text.rlike(word_pattern(words)))


def revert_flag(comment: Column | str) -> Column:
    return F.coalesce(mentions(comment, REVERT_WORDS), F.lit(False))


def event_time(text: Column | str) -> Column:
    """ISO-8601 text to timestamp; unreadable text gives null, also under ANSI mode."""
    return F.try_to_timestamp(_col(text))


def view_date(text: Column | str) -> Column:
    """``yyyyMMddHH`` text to its date."""
    return F.try_to_timestamp(F.substring(_col(text), 1, 8), F.lit("yyyyMMdd")).cast("date")


def per(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient with the denominator raised to at least one."""
    return _col(numerator) / F.greatest(_col(denominator), F.lit(1))


def week_start(time: Column | str) -> Column:
    """Monday of the calendar week."""
    return F.date_trunc("week", _col(time)).cast("date")


def editor_diversity(editors: Column | str, edits: Column | str) -> Column:
    """Entropy of ``editors`` equally active people over the largest entropy that many
    edits allow, at most one; zero for a lone editor."""
    editors, edits = _col(editors), _col(edits)
    ceiling = F.when(edits > 1, F.log2(edits.cast("double"))).otherwise(F.lit(1.0))
    share = F.least(F.log2(editors.cast("double")) / ceiling, F.lit(1.0))
    return F.when((editors > 1) & edits.isNotNull(), share).otherwise(F.lit(0.0))


def stability_label(rate: Column | str, above: Column | float = UNSTABLE_ABOVE) -> Column:
    above = above if isinstance(above, Column) else F.lit(above)
    return F.when(_col(rate) > above, F.lit(1.0)).otherwise(F.lit(0.0))


def safe_title(title: Column | str) -> Column:
    """Title usable as a file name."""
    return F.translate(_col(title), "/\\", "__")


def display_title(title: Column | str) -> Column:
    return F.translate(_col(title), "_", " ")


def topic_label(topic: Column | str) -> Column:
    return F.initcap(_col(topic))


def linked_ids(claims: Column, prop: str) -> Column:
    """Entity ids that the claims of one property point to; other value kinds are skipped."""
    values = F.coalesce(F.try_element_at(claims, F.lit(prop)), F.array())
    to_entities = F.filter(
        values, lambda c: c["mainsnak"]["datavalue"]["type"] == F.lit("wikibase-entityid")
    )
    return F.transform(
        to_entities,
        lambda c: F.coalesce(F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.id"), F.lit("")),
    )
