"""String expressions: whitespace, characters, terms, words. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chroniq import constants as K

# Every code point that is white space to a Unicode-aware regex, spelled for Java.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
WORD_CHAR = r"[\p{L}\p{N}_]"
_MARK = "\u0001"
_METACHARACTERS = re.compile(r"[\\.^$*+?{}\[\]|()]")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def keep_by_walk(
    items: Column, start: dict[str, Column], step: Callable[[Column, Column], Column], run: int = 512
) -> Column:
    """The items that a walk with a state keeps, in their order.

    ``step(state, item)`` gives ``STRUCT<at, kept>``: the next state, and whether the item is kept. The walk leaves one letter per item, and the items
    are filtered by these letters at the end. Letters are gathered in short runs, so that a long list adds no more than its share.
    """
    zero = F.struct(F.struct(*[v.alias(k) for k, v in start.items()]).alias("at"), F.lit("").alias("run"), F.lit("").alias("marks"))

    def walk(state: Column, item: Column) -> Column:
        return let(step(state["at"], item), lambda moved: noted(state, moved))

    def noted(state: Column, moved: Column) -> Column:
        letters = F.concat(state["run"], F.when(moved["kept"], "1").otherwise("0"))
        full = F.octet_length(state["run"]) >= run
        return F.struct(
            moved["at"].alias("at"),
            F.when(full, F.substring(letters, run + 1, 1)).otherwise(letters).alias("run"),
            F.when(full, F.concat(state["marks"], state["run"])).otherwise(state["marks"]).alias("marks"),
        )

    marks = F.aggregate(items, zero, walk, lambda state: F.concat(state["marks"], state["run"]))
    return let(F.split(marks, ""), lambda kept: F.filter(items, lambda _, i: F.get(kept, i) == "1"))


def captures(text: Column, pattern: str, groups: int) -> Column:
    """The groups of an anchored pattern as an array, by one run of the regex; null if it fails."""
    marked = F.regexp_replace(text, pattern, "".join(f"{_MARK}${g}" for g in range(1, groups + 1)))
    return let(
        F.split(marked, _MARK),
        lambda parts: F.when(F.size(parts) == groups + 1, F.slice(parts, F.lit(2), F.lit(groups))),
    )


def literal_map(table: dict[str, object]) -> Column:
    """A constant text map as one expression node, where a map of literals would be hundreds."""
    return F.str_to_map(F.lit(" ".join(f"{k}={v}" for k, v in table.items())), F.lit(" "), F.lit("="))


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    # A single blank is left as it is.
    return F.trim(F.regexp_replace(text, rf"{SPACE}{{2,}}+|[{SPACE}&&[^ ]]", " "))


def strip(text: Column) -> Column:
    """Remove white space at both ends only."""
    space = F.lit(SPACE)

    def start(t: Column) -> Column:
        return F.when(F.rlike(F.substring(t, 1, 1), space), F.regexp_replace(t, rf"\A{SPACE}++", "")).otherwise(t)

    def end(t: Column) -> Column:
        # The look-behind lets a run be tried at its start only, so long runs stay linear.
        return F.when(F.rlike(F.substring(t, -1, 1), space), F.regexp_replace(t, rf"(?<!{SPACE}){SPACE}++\z", "")).otherwise(t)

    return let(text, lambda t: let(start(t), end))


def is_missing(text: Column) -> Column:
    """Null or empty. Text of white space alone is present."""
    return text.isNull() | (text == "")


def is_blocked_page(html: Column) -> Column:
    head = F.substring(html, 1, K.BLOCKED_HEAD_CHARS)
    return F.contains(head, F.lit(K.BLOCKED_HEAD_MARKER)) | F.contains(html, F.lit(K.BLOCKED_BODY_MARKER))


def foreign_fraction(text: Column) -> Column:
    """Share of code points that are no ASCII letter, digit, punctuation mark or space."""
    # The allowed set is exactly the 95 characters 0x20-0x7E.
    foreign = F.length(F.regexp_replace(text, r"[\x20-\x7E]+", ""))
    return F.when(F.length(text) > 0, foreign / F.length(text)).otherwise(F.lit(0.0))


def invalid_percentage(text: Column) -> Column:
    return foreign_fraction(text) * 100


def looks_english(text: Column, limit: float = K.MAX_FOREIGN_FRACTION) -> Column:
    """True below the limit, and for missing text."""
    return foreign_fraction(text) < F.lit(limit)


def count_matches(text: Column, pattern: str) -> Column:
    """Number of non-overlapping matches, case-sensitive; null for null text."""
    if pattern and not _METACHARACTERS.search(pattern):
        # A plain string: compare byte lengths, with no regex and no decoding of the text.
        removed = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(pattern), F.lit("")))
        return (removed / len(pattern.encode())).cast("bigint")
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def words(text: Column, min_chars: int = K.MIN_WORD_CHARS) -> Column:
    """Lower-cased words of at least ``min_chars`` word characters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{WORD_CHAR}{{{int(min_chars)},}}"), F.lit(0))
