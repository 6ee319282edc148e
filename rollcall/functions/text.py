"""Text normalisation as Column expressions (no UDF anywhere)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import ABBREVIATION_STOP_WORDS

# White space by the rule of Python's str.isspace, which Java's classes only approximate.
SPACES = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
SPACE = r"[\s\x1c-\x1f]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip_space(c: Column) -> Column:
    """Trim white space of any alphabet on both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def words(c: Column) -> Column:
    """Non-empty white-space separated tokens."""
    return F.filter(F.split(c, f"(?U){SPACE}+"), lambda w: w != "")


def truthy(c: Column) -> Column:
    """Null for blank text, so that ``coalesce`` falls through it."""
    return F.nullif(c, F.lit(""))


def first_truthy(*cols: Column) -> Column:
    return F.coalesce(*[truthy(c) for c in cols])


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str]:
    """Characters whose canonical decomposition keeps exactly one ASCII character."""
    src, dst = [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        base = "".join(ch for ch in unicodedata.normalize("NFD", chr(cp)) if ord(ch) < 128)
        if len(base) == 1:
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


def fold_accents(c: Column) -> Column:
    """Base letters of accented characters; every other non-ASCII character is dropped.

    Text of as many bytes as characters is ASCII and passes through untouched.
    """
    src, dst = _fold_table()
    folded = F.regexp_replace(F.translate(c, src, dst), r"[^\x00-\x7F]", "")
    plain = F.octet_length(c) == F.length(c)
    return F.coalesce(F.when(plain, c).otherwise(folded), F.lit(""))


def fold_for_match(c: Column) -> Column:
    return F.lower(fold_accents(c))


def slugify(c: Column) -> Column:
    slug = F.regexp_replace(fold_for_match(c), "[^a-z0-9]+", "-")
    return F.coalesce(truthy(F.btrim(slug, F.lit("-"))), F.lit("default"))


def abbreviation(c: Column) -> Column:
    """Upper-case initials of the words that are not stop words."""
    parts = F.split(fold_accents(c), f"(?U)(?:{SPACE}|-)+")
    kept = F.filter(
        parts, lambda w: (w != "") & ~F.lower(w).isin(*ABBREVIATION_STOP_WORDS)
    )
    return F.array_join(F.transform(kept, lambda w: F.upper(F.left(w, F.lit(1)))), "")


def acronym(c: Column) -> Column:
    """Lower-case initials of ALL words, stop words included."""
    text = strip_space(fold_for_match(c))
    word = r"([^\s\x1c-\x1f])[^\s\x1c-\x1f]*" + SPACE + "*"
    return F.regexp_replace(text, word, "$1")


def truncate_text(c: Column, max_chars: int) -> Column:
    """White space collapsed, then cut: struct(text, truncated)."""
    flat = strip_space(F.regexp_replace(c, f"(?U){SPACE}+", " "))
    return F.struct(
        F.left(flat, F.lit(max_chars)).alias("text"),
        (F.length(flat) > max_chars).alias("truncated"),
    )


def format_timestamp(c: Column) -> Column:
    """ISO text -> 'January 02, 2024 at 03:04 UTC'; unreadable text stays, blank is 'unknown'.

    The offset is dropped, not applied: the clock fields are printed as written.
    """
    iso = F.regexp_like(c, F.lit(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}.*)?$"))
    local = F.regexp_replace(c, r"(?<=:\d{2}(?:\.\d{1,9})?)(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)$", "")
    ts = F.when(iso, local.try_cast("timestamp_ntz"))
    shown = F.date_format(ts, "MMMM dd, yyyy 'at' HH:mm 'UTC'")
    return F.coalesce(F.when(truthy(c).isNull(), F.lit("unknown")), shown, c)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Catalyst inlines a column into every place a pushed-down filter uses it; a lambda variable
    is the one binding it keeps.  It is bound by the last step of a fold over nothing: an element of a
    transformed array would walk the whole body for its type again on every row.
    """
    return F.aggregate(F.array(), value, lambda v, _: v, body)


def bind(df: DataFrame, value: Column, fields: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Adds columns made from a costly value that is computed once per row.

    Filters on the new columns are not pushed below a generator, so the value is never inlined
    into them the way it would be with ``withColumn``.
    """

    def row(v: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in fields(v).items()])

    return df.select("*", F.inline(F.transform(F.array(value), row)))


def alternatives(values) -> str:
    """Regular expression for any of some literal texts."""
    return "(?:" + "|".join(re.sub(r"([^\w ])", r"\\\1", v) for v in values) + ")"


def contains_any(c: Column, needles) -> Column:
    """Contains one of a few needles: one regular expression, one use of the argument."""
    return F.regexp_like(c, F.lit(alternatives(needles)))
