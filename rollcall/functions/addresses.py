"""Mail addresses: normalising, syntax, domain part, guess markers, status maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.constants import (
    ACCOUNT_WORDS,
    ADDRESS_SYNTAX,
    CHECKABLE_STATUSES,
    GUESS_SOURCES,
    REACHABILITY,
    ROLE_LOCAL_PARTS,
    VERIFIER_STATUS,
)
from rollcall.functions.hosts import infrastructure_host
from rollcall.functions.text import contains_any, strip_space


def normalize_address(c: Column) -> Column:
    return F.coalesce(F.lower(strip_space(c)), F.lit(""))


def valid_address(c: Column) -> Column:
    return F.regexp_like(normalize_address(c), F.lit(ADDRESS_SYNTAX))


def address_domain(c: Column) -> Column:
    """After the FIRST '@', trimmed and lower-cased; '' when there is none."""
    tail = F.get(F.split(c, "@", 2), F.lit(1))
    return F.coalesce(F.lower(strip_space(tail)), F.lit(""))


def raw_address_domain(c: Column) -> Column:
    """After the FIRST '@' as written, null when there is none."""
    return F.get(F.split(c, "@", 2), F.lit(1))


def mailbox_domain(c: Column) -> Column:
    """After the LAST '@' as written: the form address checking uses."""
    return F.substring_index(c, "@", -1)


def address_in_domain(address: Column, domain: Column) -> Column:
    return F.endswith(address, F.concat(F.lit("@"), domain))


def infrastructure_address(c: Column) -> Column:
    return infrastructure_host(address_domain(c))


def checkable(status: Column) -> Column:
    return F.coalesce(status.isin(*CHECKABLE_STATUSES), F.lit(False))


def guess_only(sources: Column, markers=GUESS_SOURCES) -> Column:
    """Non-empty and every source is a guess marker."""
    all_guesses = F.forall(
        sources,
        lambda s: F.coalesce(F.lower(strip_space(s)).isin(*markers), F.lit(False)),
    )
    return F.coalesce((F.size(sources) > 0) & all_guesses, F.lit(False))


def local_part_rank(c: Column) -> Column:
    """0 for a dot in the local part, 1 for an underscore, 2 otherwise."""
    local = F.substring_index(c, "@", 1)
    return F.when(local.contains("."), 0).when(local.contains("_"), 1).otherwise(2)


def inferred_pattern(c: Column) -> Column:
    """Naming pattern an observed address follows."""
    local = F.substring_index(c, "@", 1)
    return (
        F.when(local.contains("."), F.lit("{first}.{last}"))
        .when(local.contains("_"), F.lit("{first}_{last}"))
        .otherwise(F.lit("{f}{last}"))
    )


def fill_pattern(pattern: Column, first: Column, last: Column) -> Column:
    """Local part for a pattern; {f} and {l} are the initials."""
    out = F.replace(pattern, F.lit("{first}"), first)
    out = F.replace(out, F.lit("{last}"), last)
    out = F.replace(out, F.lit("{f}"), F.left(first, F.lit(1)))
    return F.replace(out, F.lit("{l}"), F.left(last, F.lit(1)))


def role_addresses(domain: Column) -> Column:
    """The fixed role mailboxes of a domain, as an array."""
    return F.array(*[F.concat(F.lit(p + "@"), domain) for p in ROLE_LOCAL_PARTS])


def _mapped(c: Column, table, field: int, default) -> Column:
    out = None
    for key, values in table.items():
        out = (F if out is None else out).when(c == key, F.lit(values[field]))
    return out.otherwise(F.lit(default))


def verifier_status(c: Column) -> Column:
    """struct(status, confidence) for a verifier's own status word; unknown words are unknown."""
    key = F.lower(F.coalesce(c, F.lit("unknown")))
    return F.struct(
        _mapped(key, VERIFIER_STATUS, 0, "unknown").alias("status"),
        _mapped(key, VERIFIER_STATUS, 1, 0.0).alias("confidence"),
    )


def reachability_status(c: Column) -> Column:
    return F.struct(
        _mapped(c, REACHABILITY, 0, "unknown").alias("status"),
        _mapped(c, REACHABILITY, 1, 0.0).alias("confidence"),
    )


def mentions_account(text: Column, whole_word: bool = False) -> Column:
    """Substring test on purpose ('invalid' has 'valid'); ``whole_word`` is the strict form."""
    low = F.lower(text)
    if whole_word:
        hit = F.regexp_like(low, F.lit(rf"\b(?:{'|'.join(ACCOUNT_WORDS)})\b"))
    else:
        hit = contains_any(low, ACCOUNT_WORDS)
    return F.coalesce(hit, F.lit(False))
