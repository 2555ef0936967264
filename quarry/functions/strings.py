"""String column functions with stringr semantics."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.columns import col_of


def str_detect(c: str | Column, pattern: str, ignore_case: bool = False) -> Column:
    return col_of(c).rlike(("(?i)" if ignore_case else "") + pattern)


def str_replace_all(c: str | Column, pattern: str, repl: str) -> Column:
    """``str_replace_all`` / ``gsub``; ``$1`` style back references."""
    return F.regexp_replace(col_of(c), pattern, repl)


def str_replace_first(c: str | Column, pattern: str, repl: str) -> Column:
    """``str_replace``: first match only.  Anchored lazily at the start, so
    the single replacement keeps the text before the match.  That text is a
    group of its own in front, so the numbers of the caller's groups, in
    ``repl`` and in back references of ``pattern``, are moved up by one."""
    up = lambda m: f"{m[1]}{int(m[2]) + 1}"
    moved = re.sub(r"((?<!\\)(?:\\\\)*\\)([1-9]\d*)", up, pattern)
    return F.regexp_replace(col_of(c), f"^((?s:.*?))(?:{moved})", "$1" + re.sub(r"((?<!\\)\$)([1-9]\d*)", up, repl))


def str_extract_group(c: str | Column, pattern: str, group: int = 1) -> Column:
    """``extract(col, into, regex)`` group, NA when no match."""
    return F.nullif(F.regexp_extract(col_of(c), pattern, group), F.lit(""))


def paste(*cols: str | Column, sep: str = " ") -> Column:
    """R ``paste``: NULL is written as "NA" (``concat_ws`` would skip it)."""
    return F.concat_ws(sep, *[F.coalesce(col_of(c).cast("string"), F.lit("NA")) for c in cols])


def parse_number(c: str | Column) -> Column:
    """readr ``parse_number``: the first number in the text, with its sign;
    commas between its digits are grouping marks.  NULL without a number."""
    first = F.regexp_extract(col_of(c), r"-?(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)", 0)
    return F.regexp_replace(first, ",", "").try_cast("double")


def light_stem(c: str | Column) -> Column:
    """Light English suffix stripping (not Porter): removes one of
    -ing, -ed, -es, -s, -ly at the end of words longer than 4 letters."""
    x = col_of(c)
    return F.when(F.length(x) > 4, F.regexp_replace(x, "(ing|ed|es|ly|s)$", "")).otherwise(x)
