"""Text clean-up as plain Column expressions (no Python runs per row)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column
from pyspark.sql import functions as F

from areaneed.constants import (
    AGENCY_REWRITE_WORDS,
    AGENCY_REWRITES,
    COUNTY_REWRITES,
    NULL_TOKENS,
    WORD_DELIMITERS,
    ZIP_PATTERN,
)


def clean_key(col: Column) -> Column:
    """Text as it is compared in joins: lower case, no outer blanks."""
    return F.lower(F.trim(col))


def rewrite(col: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) rules one after the other."""
    return reduce(lambda c, rule: F.regexp_replace(c, F.lit(rule[0]), F.lit(rule[1])), rules, col)


def normalize_county(col: Column) -> Column:
    """'Denver County, CO' -> 'denver'."""
    return F.trim(rewrite(clean_key(col), COUNTY_REWRITES))


def normalize_agency(col: Column) -> Column:
    """Drop 'Police Department' / 'Sheriff' endings and unify task-force names.

    The patterns run for names with their words only. No rewrite can bring such words
    about, so the name as given is asked.
    """
    found, lowered = col, F.lower(col)
    for words, rules in groupby(zip(AGENCY_REWRITE_WORDS, AGENCY_REWRITES, strict=True), itemgetter(0)):
        changed = rewrite(found, [("(?i)" + pattern, new) for _, (pattern, new) in rules])
        found = F.when(F.contains(lowered, F.lit(words)), changed).otherwise(found)
    return F.trim(found)


def normalize_county_list(col: Column) -> Column:
    """'Weld; Adams' -> 'adams, weld'; a single county is only lower-cased."""
    parts = F.transform(F.split(clean_key(col), "[;,]"), lambda part: F.trim(part))
    is_list = F.contains(col, F.lit(";")) | F.contains(col, F.lit(","))
    return F.when(is_list, F.array_join(F.array_sort(parts), ", ")).otherwise(clean_key(col))


def first_listed_county(col: Column) -> Column:
    """The first county of a comma-separated list, as a join key."""
    return clean_key(F.split_part(col, F.lit(","), F.lit(1)))


def initcap_delims(col: Column, delims: str = WORD_DELIMITERS) -> Column:
    """Capitalise words that start after a blank or after any of ``delims``.

    The built-in starts words after spaces only, so a marked space is put after each
    delimiter and taken out again.
    """
    spaced = F.regexp_replace(col, rf"([\t\n\r\f{re.escape(delims)}])", f"$1{_MARK} ")
    return F.replace(F.initcap(spaced), F.lit(f"{_MARK} "), F.lit(""))


_MARK = "\x01"


def clean_zip(col: Column) -> Column:
    """First five digits of a well-formed zip code, else null."""
    return F.when(col.rlike(ZIP_PATTERN), F.substring(col, 1, 5))


def to_whole_number(col: Column) -> Column:
    """'1,234' -> 1234; null when the text is not a number."""
    return F.replace(col, F.lit(","), F.lit("")).try_cast("decimal(38,0)").cast("bigint")


def null_tokens_to_null(col: Column, tokens: list[str] = NULL_TOKENS) -> Column:
    """Missing-value markers of a seed file become null."""
    return F.when(~col.isin(tokens), col)
