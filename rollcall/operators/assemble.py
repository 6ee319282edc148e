"""Nested records from one row per element, of bounded size whatever the number of elements.

A plain ``collect_list`` has no bound: one key may hold a third of all elements.  Here elements get
their place in the total order of their key, and every ``limit`` of them make one record; what is
more goes on in further records of the key (``part`` 1, 2, ...).  Places come from counts: a key's
elements are cut into cells by ``seq``, the cells are counted with partial aggregation, running
sums go over the counts, and rows are numbered within their cell only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.compact import exposure_findings

LIMIT = 1000
CELL = 4096


def placed(elements: DataFrame, keys: list[str], seq: str, pos: str, out: str = "place",
           width: int = CELL) -> DataFrame:
    """``elements`` with their 0-based place by (seq, pos) within their key."""
    cut = elements.withColumn("_cell", F.floor(F.col(seq) / width))
    counts = cut.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0))
                           .alias("_start"))
    within = Window.partitionBy(*keys, "_cell").orderBy(seq, pos)
    return cut.withColumn("_row", F.row_number().over(within) - 1).join(
        starts, [*keys, "_cell"]).withColumn(out, F.col("_start") + F.col("_row")).select(
        *elements.columns, out)


def packed(elements: DataFrame, keys: list[str], value: Column, limit: int = LIMIT,
           seq: str = "first_seq", pos: str = "first_pos", first_only: bool = False) -> DataFrame:
    """(keys, part, items): arrays of at most ``limit`` values in order."""
    rows = placed(elements.select(*keys, seq, pos, value.alias("_value")), keys, seq, pos)
    rows = rows.withColumn("part", F.floor(F.col("place") / limit).cast("int"))
    if first_only:
        rows = rows.where("part = 0")
    return rows.groupBy(*keys, "part").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "_value"))),
        lambda x: x["_value"]).alias("items"))


def records_of(sections: dict[str, DataFrame], keys: list[str], limit: int = LIMIT,
               first_only: bool = False) -> DataFrame:
    """(keys, part, one array of JSON texts per section) from (keys, first_seq, first_pos, value).

    A key has as many parts as its largest section needs; a section without elements is empty.
    """
    every = None
    for name, df in sections.items():
        rows = packed(df, keys, F.col("value").cast("string"), limit, first_only=first_only)
        rows = rows.withColumn("_section", F.lit(name))
        every = rows if every is None else every.unionByName(rows)
    none = F.expr("cast(array() as array<string>)")
    return every.groupBy(*keys, "part").agg(*[
        F.coalesce(F.first(F.when(F.col("_section") == n, F.col("items")), ignorenulls=True), none)
        .alias(n) for n in sections])


def exposure_records(
    heads: DataFrame, elements: DataFrame, limit: int = LIMIT, first_only: bool = False,
    items: int | None = None, details: int | None = None,
) -> DataFrame:
    """Address, services and findings; ``elements`` are exposure groups as JSON text.

    ``first_only`` gives a scorer the first ``limit`` groups, ``items`` of a group and ``details`` of
    a report; by default every group is in one of the address's records.
    """
    keys = ["tenant", "email"]
    parts = packed(elements, keys, F.col("element"), limit, first_only=first_only)
    groups = F.transform("items", lambda x: F.try_parse_json(x))
    found = parts.select(*keys, "part", exposure_findings(groups, None, items, details)
                         .alias("findings"))
    kind = dict(found.dtypes)["findings"]
    return heads.join(found, keys, "left").select(
        *keys, F.coalesce("part", F.lit(0)).alias("part"), "services",
        F.coalesce("findings", F.expr(f"cast(array() as {kind})")).alias("findings"))


def infrastructure_records(sections: dict[str, DataFrame], limit: int = LIMIT,
                           first_only: bool = False) -> DataFrame:
    """One organisation domain's raw findings by the tool they come from."""
    return records_of(sections, ["tenant", "target_domain"], limit, first_only)


def slim_views(sections: dict[str, DataFrame], breaches: DataFrame, limit: int = LIMIT) -> DataFrame:
    """A tenant's slim view: parts of every section, and in all parts its counts.

    ``counts`` has the number of elements of every section and of ``breaches`` (which has no
    section of its own).
    """
    counted = breaches.select("tenant", F.lit("breaches").alias("_section"))
    for name, df in sections.items():
        counted = counted.unionByName(df.select("tenant", F.lit(name).alias("_section")))
    names = [*sections, "breaches"]
    counts = counted.groupBy("tenant").agg(F.struct(*[
        F.count_if(F.col("_section") == n).alias(n) for n in names]).alias("counts"))
    parts = records_of(sections, ["tenant"], limit)
    none = F.expr("cast(array() as array<string>)")
    return counts.join(parts, "tenant", "left").select(
        "tenant", F.coalesce("part", F.lit(0)).alias("part"),
        *[F.coalesce(n, none).alias(n) for n in sections],
        F.col("counts.breaches").alias("breach_count"), "counts")
