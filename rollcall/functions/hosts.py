"""Host names: normalising, syntax, lexical tests."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.constants import (
    DENYLIST,
    HOST_SYNTAX,
    INFRASTRUCTURE_PREFIXES,
    KEYWORD_SKIP_LABELS,
)
from rollcall.functions.text import alternatives, let, strip_space


@lru_cache(maxsize=1)
def _ambiguous_authority() -> str:
    """Characters (for a class) that would turn into a URL delimiter under compatibility folding."""
    hits = [
        f"\\u{cp:04x}"
        for cp in range(0x80, 0x10000)
        if not 0xD800 <= cp <= 0xDFFF
        and any(d in unicodedata.normalize("NFKC", chr(cp)) for d in "/?#@:")
    ]
    return "".join(hits)


@lru_cache(maxsize=1)
def _host_of_url() -> str:
    """One pattern for a whole URL: group 1 is a plain host, group 2 a bracketed address.

    Groups that settle where the host starts are possessive: the scheme and everything up to the
    last '@' are taken whenever present.  Text that fits neither form matches with empty groups.
    """
    user = r"(?:[^/?#]*@)?+"
    plain = rf"(?![^/?#]*[\[\]{_ambiguous_authority()}]){user}(?:www\.)?+([^:/?#]*)"
    bracketed = (
        rf"{user}\[([0-9a-f:.]*:[0-9a-f:.]*)(?:%[^\]/?#]*)?\](?::[^/?#\[\]]*)?(?=[/?#]|$)"
    )
    return rf"(?s)^(?:https?://)?+(?:{plain}|{bracketed}|).*$"


def normalize_host(c: Column) -> Column:
    """Lower-case host of a URL or bare name, one leading ``www.`` removed, '' when unusable.

    ``parse_url`` is not used: it rejects underscores and raises on bad escapes.
    """
    text = F.regexp_replace(F.lower(strip_space(c)), r"[\t\r\n]", "")
    return F.coalesce(F.regexp_replace(text, _host_of_url(), "$1$2"), F.lit(""))


def valid_host(c: Column) -> Column:
    return F.coalesce(F.regexp_like(F.lower(strip_space(c)), F.lit(HOST_SYNTAX)), F.lit(False))


def subdomain_of(line: Column, root: Column) -> Column:
    """First host-like run under ``root`` in a line of text, or null.

    The pattern would differ per row, so the run is found with a constant regex and cut after
    its last ``.root``.  The right end is open and the apex itself never matches.
    """
    suffix = F.concat(F.lit("."), F.lower(root))
    runs = F.regexp_extract_all(F.lower(strip_space(line)), F.lit("[a-z0-9._-]+"), F.lit(0))
    run = F.get(F.filter(runs, lambda r: F.position(suffix, r, F.lit(2)) > 0), F.lit(0))

    def cut(r: Column) -> Column:
        tail = F.position(F.reverse(suffix), F.reverse(r))
        return F.btrim(F.left(r, F.length(r) - tail + 1), F.lit("."))

    return let(let(run, cut), lambda h: F.when((root != "") & valid_host(h), h))


def host_matches_name(host: Column, name: Column, abbreviation: Column) -> Column:
    """Host label and organisation name contain one another, or the host has the abbreviation.

    Accents are dropped here, not folded.
    """
    plain_name = F.regexp_replace(F.lower(name), "[^a-z0-9]", "")
    label = F.regexp_replace(F.lower(F.substring_index(host, ".", 1)), "[^a-z0-9]", "")
    by_name = F.contains(plain_name, label) | F.contains(label, plain_name)
    by_abbr = F.coalesce(
        (abbreviation != "") & F.contains(F.lower(host), F.lower(abbreviation)), F.lit(False)
    )
    usable = (plain_name != "") & (label != "")
    return F.coalesce(usable & (by_name | by_abbr), F.lit(False))


def denylisted(host: Column, label_boundary: bool = False) -> Column:
    """Ends with a denied name.  Without ``label_boundary`` 'fedex.com' ends with 'x.com'."""
    start = r"(?:^|\.)" if label_boundary else ""
    return F.regexp_like(host, F.lit(rf"{start}{alternatives(DENYLIST)}\z"))


def infrastructure_host(c: Column) -> Column:
    h = F.lower(strip_space(c))
    hit = F.regexp_like(h, F.lit("^" + alternatives(INFRASTRUCTURE_PREFIXES)))
    return F.coalesce(hit, F.lit(False))


def host_keyword(c: Column) -> Column:
    """Identifying label: leading service labels are skipped while more than two labels remain."""
    skip = "|".join(KEYWORD_SKIP_LABELS)
    rest = F.regexp_replace(F.lower(c), rf"^(?:(?:{skip})\.)+(?=[^.]*\.)", "")
    return F.coalesce(F.substring_index(rest, ".", 1), F.lit(""))
