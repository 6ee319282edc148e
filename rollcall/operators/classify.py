"""Reliability tiers of people from their position history.

The history is a nested column of the person's own row, so classifying needs no shuffle: it is a
projection over arrays of struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.constants import (
    CURRENT_REASON,
    DEAD_PAGE_PHRASES,
    FORMER_REASON,
    INTERN_REASON,
    INTERN_WORDS,
    LEADERSHIP_REASON,
    LEADERSHIP_WORDS,
    RAW_ONLY_REASON,
    REJECT_REASON,
    TIER_ORDER,
)
from rollcall.functions.hosts import host_keyword
from rollcall.functions.text import acronym, bind, contains_any, fold_for_match, let, strip_space


def _fold_word(word: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", word) if ord(c) < 128).lower()


def name_keys(name: Column) -> Column:
    """struct(short, initials): the words a name is looked for by, padded with spaces.

    Both are null when the name has no such form (a short name must be one word of at most six
    characters, initials at least two).
    """

    def padded(word: Column) -> Column:
        return F.concat(F.lit(" "), word, F.lit(" "))

    def usable(n: Column) -> Column:
        one_word = F.regexp_like(n["short"], F.lit(r"^[^\s\x1c-\x1f]{1,6}$"))
        return F.struct(
            F.when(one_word, padded(n["short"])).alias("short"),
            F.when(F.length(n["initials"]) >= 2, padded(n["initials"])).alias("initials"),
        )

    return let(F.struct(
        strip_space(fold_for_match(name)).alias("short"),
        acronym(F.coalesce(name, F.lit(""))).alias("initials"),
    ), usable)


def position_matches(company: Column, keyword: Column, keys: Column) -> Column:
    """The position's company plausibly is the target.

    Keyword inside the spaceless text, or a short name or the initials of the name (see
    :func:`name_keys`) as a whole word: a padded word inside the padded text.
    """
    text = F.replace(F.replace(fold_for_match(company), F.lit("-"), F.lit(" ")),
                     F.lit("_"), F.lit(" "))

    def test(t: Column) -> Column:
        spaced = F.concat(F.lit(" "), F.regexp_replace(t, r"[\t-\r\x1c-\x1f]", " "), F.lit(" "))
        by_keyword = (keyword != "") & F.contains(F.replace(t, F.lit(" "), F.lit("")), keyword)
        by_name = [F.coalesce(F.contains(spaced, keys[k]), F.lit(False))
                   for k in ("short", "initials")]
        return F.coalesce(by_keyword, F.lit(False)) | by_name[0] | by_name[1]

    return F.coalesce((company != "") & let(text, test), F.lit(False))


def ongoing(end_date: Column) -> Column:
    return F.coalesce(F.lower(strip_space(end_date)), F.lit("")).isin("", "present")


def _titled(titles: Column) -> Column:
    named = F.filter(titles, lambda t: F.coalesce(t != "", F.lit(False)))
    return strip_space(F.coalesce(F.get(named, F.lit(0)), F.lit("")))


def _mentions(text: Column, keywords, whole_word: bool) -> Column:
    folded = [_fold_word(w) for w in keywords]
    if whole_word:
        return F.regexp_like(text, F.lit(r"\b(?:" + "|".join(folded) + r")\b"))
    return contains_any(text, folded)


def classify(
    people: DataFrame,
    keyword: Column | None = None,
    name: Column | None = None,
    whole_word: bool = False,
) -> DataFrame:
    """Adds ``employee_tier``, ``employee_tier_rank`` and ``tier_reason``.

    Titles are tested by substring ('international' holds 'intern'), intern words first;
    ``whole_word`` is the strict form.
    """
    key = host_keyword(F.col("matched_domain")) if keyword is None else keyword
    org = F.col("company_name") if name is None else name

    # each step is a lambda variable, so that it is made once per row however often it is used, and
    # one generator binds the results: no array of positions is copied from step to step
    def titles_of(arr: Column) -> Column:
        return F.coalesce(F.transform(arr, lambda p: p["title"]), F.array().cast("array<string>"))

    def fitting(v: Column) -> Column:
        def fits(p: Column) -> Column:
            return position_matches(p["company_name"], v["key"], v["org"])

        return F.struct(
            titles_of(F.filter(F.col("current_position"), fits)).alias("current"),
            F.transform(F.filter(F.col("all_positions"), fits), lambda p: F.struct(
                p["title"].alias("title"), ongoing(p["end_date"]).alias("ongoing"))).alias("all"))

    def dated(m: Column) -> Column:
        return F.struct(
            F.concat(m["current"], titles_of(F.filter(m["all"], lambda p: p["ongoing"]))).alias("now"),
            titles_of(F.filter(m["all"], lambda p: ~p["ongoing"])).alias("past"))

    def told(m: Column) -> Column:
        joined = F.array_join(F.transform(m["now"], lambda t: F.coalesce(t, F.lit(""))), " ")
        return F.struct(m["now"].alias("now"), m["past"].alias("past"),
                        let(joined, fold_for_match).alias("text"))

    def judged(m: Column) -> dict[str, Column]:
        now, past, text = m["now"], m["past"], m["text"]
        tier = (
            F.when((F.size(now) == 0) & (F.size(past) == 0), "reject")
            .when(F.size(now) == 0, "former_employee")
            .when(_mentions(text, INTERN_WORDS, whole_word), "intern")
            .when(_mentions(text, LEADERSHIP_WORDS, whole_word), "leadership")
            .otherwise("current_employee")
        )
        return {"employee_tier": tier,
                "_t": F.when(F.size(now) > 0, _titled(now)).otherwise(_titled(past))}

    found = let(F.struct(key.alias("key"), name_keys(org).alias("org")), fitting)
    out = bind(people, let(let(found, dated), told), judged)
    t = F.col("employee_tier")
    return out.withColumn("employee_tier_rank", tier_rank(t)).withColumn(
        "tier_reason",
        F.when(t == "reject", REJECT_REASON)
        .when(t == "former_employee", F.format_string(FORMER_REASON, "_t"))
        .when(t == "intern", F.format_string(INTERN_REASON, "_t"))
        .when(t == "leadership", F.format_string(LEADERSHIP_REASON, "_t"))
        .otherwise(F.format_string(CURRENT_REASON, "_t")),
    ).drop("_t")


def tier_rank(tier: Column) -> Column:
    out = None
    for i, name in enumerate(TIER_ORDER):
        out = (F if out is None else out).when(tier == name, i)
    return out


def with_current_position(people: DataFrame) -> DataFrame:
    """An empty ``current_position`` is filled by the first history element at the target domain."""
    no_name = name_keys(F.lit(None).cast("string"))
    staged = people.withColumn("_key", host_keyword(F.col("matched_domain")))
    first = F.get(
        F.filter("all_positions",
                 lambda p: position_matches(p["company_name"], F.col("_key"), no_name)),
        F.lit(0),
    )
    here = F.get(F.col("current_position"), F.lit(0))
    has = F.size("current_position") > 0
    return staged.withColumn("position_now", F.struct(*[
        F.when(has, here[f]).otherwise(first[f]).alias(f) for f in ("title", "company_name")
    ])).drop("_key")


def tier_raw_people(people: DataFrame) -> DataFrame:
    """People without position history: kept as current, with a fixed reason and no rank."""
    return (
        people.withColumn("employee_tier", F.lit("current_employee"))
        .withColumn("employee_tier_rank", F.lit(None).cast("int"))
        .withColumn("tier_reason", F.lit(RAW_ONLY_REASON))
    )


def page_is_live(text: Column, first: Column, last: Column, phrases=None) -> Column:
    """A fetched page looks like the person's live page.

    Null text (not fetched) counts as live; short pages and pages with a dead-page phrase do not;
    a name part of three characters or more must appear when there is one.
    """
    body = strip_space(text)
    low = F.lower(body)
    parts = F.transform(
        F.filter(F.array(first, last), lambda n: F.coalesce(F.length(n) >= 3, F.lit(False))),
        fold_for_match,
    )
    words_of = phrases or DEAD_PAGE_PHRASES

    def judge(x: Column) -> Column:
        dead = x.contains(words_of[0])
        for p in words_of[1:]:
            dead = dead | x.contains(p)
        named = (F.size(parts) == 0) | F.exists(parts, lambda n: F.contains(x, n))
        return ~dead & named

    return F.when(text.isNull(), True).when(F.length(body) < 40, False).otherwise(let(low, judge))
