"""Verdicts: attaching them to records, grounding, and the fixed corrections after scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.constants import (
    CATCH_ALL_STATUS,
    CATCH_ALL_WARNING,
    CATEGORIES,
    EMPTY_TEXT_ERROR,
    FAIL_OPEN_NOTE,
    GUESS_SOURCES,
    INFRASTRUCTURE_NOTE,
    MISSING_FILE_ERROR,
    NO_MENTIONS_NOTE,
    OVERRATED_WARNING,
    RECONCILED_NOTE,
    REJECT_NOTE,
    TEXT_FILE_TYPES,
    UNPROVEN_WARNING,
    UNSUPPORTED_ERROR,
    USABILITY_LEVELS,
)
from rollcall.functions.addresses import guess_only, infrastructure_address
from rollcall.functions.text import first_truthy, strip_space
from rollcall.functions.variants import strict_boolean
from rollcall.plans.session import written


def identity(c: Column) -> Column:
    """Identifiers are compared trimmed and lower-cased; null is blank."""
    return F.coalesce(F.lower(strip_space(c.cast("string"))), F.lit(""))


def _spread_blank(records: DataFrame, key: Column) -> Column:
    """The identity to join on; blank ones match nothing and are spread over the partitions."""
    plain = ("string", "bigint", "int", "double", "boolean")
    cols = [c for c, t in records.dtypes if t in plain]
    return F.when(key != "", key).otherwise(
        F.concat(F.lit("\x00"), F.xxhash64(*cols).cast("string"))
    )


def _no_warnings() -> Column:
    return F.array().cast("array<string>")


# --- the scoring pass -------------------------------------------------------------------------

def attach_verdicts(
    records: DataFrame, verdicts: DataFrame, identifier: str, fields: list[str] | None = None,
    tenant: str = "tenant",
) -> DataFrame:
    """Every record with ``keep`` and its verdict; records without one are kept with a note.

    ``verdicts`` has ``tenant``, ``identifier``, ``keep`` (VARIANT or boolean), ``seq`` and the
    descriptive ``fields``.  Within a tenant the last verdict of an identifier wins; a ``keep``
    that is no boolean is true.  The left join is also the grounding: a verdict for an identifier
    unknown to its tenant meets no record, whoever else may have it.
    """
    fields = fields if fields is not None else ["tier", "note"]
    is_variant = dict(verdicts.dtypes)["keep"] == "variant"
    keep = strict_boolean(F.col("keep")) if is_variant else F.col("keep")
    last = (
        verdicts.withColumn("_id", identity(F.col("identifier")))
        .where(F.col("_id") != "")
        .groupBy(tenant, "_id")
        .agg(F.max_by(F.struct(F.coalesce(keep, F.lit(True)).alias("keep"), *fields), "seq")
             .alias("_v"))
    )
    key = _spread_blank(records, identity(F.col(identifier)))
    joined = records.withColumn("_id", key).join(last, [tenant, "_id"], "left")
    v, unseen = F.col("_v"), F.col("_v").isNull()
    out = joined.select(*records.columns, "_id", "_v").withColumn("keep", F.when(unseen, True).otherwise(v["keep"]))
    for f in fields:
        value = F.when(unseen, FAIL_OPEN_NOTE).otherwise(v["note"]) if f == "note" else v[f]
        out = out.withColumn(f, value)
    return out.drop("_id", "_v")


def verdict_warnings(
    verdicts: DataFrame, records: DataFrame, identifier: str, category: str,
    tenant: str = "tenant",
) -> DataFrame:
    """Verdicts dropped for a blank identifier or one that their tenant's input does not have."""
    keyed = verdicts.select(tenant, "identifier", "seq", identity(F.col("identifier")).alias("_id"))
    known = records.select(tenant, identity(F.col(identifier)).alias("_id")).distinct()
    blank = keyed.where(F.col("_id") == "").withColumn("warning", F.lit("missing identifier"))
    unknown = keyed.where(F.col("_id") != "").join(known, [tenant, "_id"], "left_anti").withColumn(
        "warning", F.lit("identifier not present in input")
    )
    return blank.unionByName(unknown).select(
        F.col(tenant).alias("tenant"), F.lit(category).alias("category"), "identifier", "seq",
        "warning",
    )


Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def score(
    records: DataFrame, scorer: Scorer, schema: str, columns: list[str], batch_size: int = 0
) -> DataFrame:
    """Verdict rows of a user-given scorer, called once per Arrow batch, or on at most ``batch_size`` records.

    Only ``columns`` travel to Python.  A batch that raises yields one row with ``error`` set and
    no verdict, so its records fail open (see :func:`score_batches`).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            step = batch_size if batch_size > 0 else max(len(frame), 1)
            for start in range(0, len(frame), step):
                part = frame.iloc[start:start + step]
                try:
                    yield scorer(part).assign(error=None)
                except Exception as problem:  # a failed batch must not fail the job
                    told = f"{problem}: keeping {len(part)} record(s) unfiltered"
                    yield pd.DataFrame({**dict.fromkeys(names, [None]), "error": [told]})

    full = f"{schema}, error string"
    names = T._parse_datatype_string(full).names
    return records.select(*columns).mapInPandas(run, full)


def score_batches(
    records: DataFrame, scorer: Scorer, schema: str, columns: list[str], batch: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(verdicts, failed batches) of ONE run of a scorer over batches that the records name.

    ``batch`` columns bound a batch (such as the tenant and ``seq div 32``), whose records reach the
    scorer together, in the order of ``columns``.  The run is written once and both results read
    it, so the scorer is called once per batch however often they are used.  A failed batch is one
    row with its size and the error; its records get no verdict and are kept.
    """
    out = written(_batch_run(records, scorer, schema, columns, batch), "scored")
    return (out.where(F.col("error").isNull()).drop("records", "error"),
            out.where(F.col("error").isNotNull()).select(*batch, "records", "error"))


def failed_batches(
    records: DataFrame, scorer: Scorer, schema: str, columns: list[str], batch: list[str]
) -> DataFrame:
    """The failed batches of :func:`score_batches` alone: the scorer runs over every batch, but its
    verdicts neither leave Python nor are written.  Each action on the result runs the scorer."""
    return _batch_run(records, scorer, schema, columns, batch, verdicts=False).select(
        *batch, "records", "error")


def _batch_run(records, scorer, schema, columns, batch, verdicts: bool = True) -> DataFrame:
    made = T._parse_datatype_string(schema).names
    kinds = ", ".join(f"{c} {dict(records.dtypes)[c]}" for c in batch)
    full = f"{kinds}, {schema}, records bigint, error string"
    names = T._parse_datatype_string(full).names

    def scored(frame: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        """Verdicts of the batches from one start to the next, put together in one step."""
        given, keys = frame[columns], frame[batch]
        found, rows, failed, at = [], [], [], []
        for start, end in zip(starts, starts[1:]):
            try:
                part = scorer(given.iloc[start:end])[made]
                if verdicts:
                    found.append(part)
                    rows.append(np.full(len(part), start))
            except Exception as problem:  # a failed batch must not fail the job
                failed.append((end - start, str(problem)))
                at.append(start)
        parts = []
        if found:
            good = pd.concat(found, ignore_index=True).assign(records=None, error=None)
            parts.append(good.assign(**keys.iloc[np.concatenate(rows)].reset_index(drop=True)))
        if failed:
            bad = pd.DataFrame(failed, columns=["records", "error"]).assign(**dict.fromkeys(made))
            parts.append(bad.assign(**keys.iloc[at].reset_index(drop=True)))
        if not found:         # plain objects: text in several Arrow chunks cannot go back to Spark
            parts = [p.astype(object) for p in parts] or [pd.DataFrame(columns=names, dtype=object)]
        return pd.concat([p[names] for p in parts], ignore_index=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if not len(frame):
                continue
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            number = frame.groupby(batch, sort=False, dropna=False).ngroup().to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist()]
            held = frame.iloc[starts[-1]:]                       # it may go on in the next frame
            if len(starts) > 1:
                yield scored(frame, starts)
        if held is not None:
            yield scored(held, [0, len(held)])

    together = records.select(*dict.fromkeys([*batch, *columns])).repartition(*batch)
    return together.sortWithinPartitions(*dict.fromkeys([*batch, *columns])).mapInPandas(run, full)


def failed_batch_warnings(failed: DataFrame, category: str, number: str,
                          tenant: str = "tenant") -> DataFrame:
    """(tenant, category, identifier, warning): one row per failed batch."""
    told = F.concat(F.lit(f"[{category}] Batch "), F.col(number).cast("string"), F.lit(" failed ("),
                    "error", F.lit("): keeping "), F.col("records").cast("string"),
                    F.lit(" record(s) unfiltered"))
    return failed.select(F.col(tenant).alias("tenant"), F.lit(category).alias("category"),
                         F.lit(None).cast("string").alias("identifier"), told.alias("warning"))


def grounding_warnings(verdicts: DataFrame, shaped: DataFrame) -> DataFrame:
    """:func:`verdict_warnings` over all categories at once, against the output shape.

    ``verdicts`` has tenant, category and identifier, and so has ``shaped``, which holds every record
    of every category, whatever became of it (or becomes of it: see :func:`input_identifiers`).
    """
    keyed = verdicts.select("tenant", "category", "identifier",
                            identity(F.col("identifier")).alias("_id"))
    known = shaped.select("tenant", "category", identity(F.col("identifier")).alias("_id")).distinct()
    blank = keyed.where(F.col("_id") == "").withColumn("warning", F.lit("missing identifier"))
    unknown = keyed.where(F.col("_id") != "").join(
        known, ["tenant", "category", "_id"], "left_anti").withColumn(
        "warning", F.lit("identifier not present in input"))
    return blank.unionByName(unknown).drop("_id")


def ungrounded_tenants(verdicts: DataFrame, shaped: DataFrame) -> DataFrame:
    """The tenants of :func:`grounding_warnings`, told by one aggregation of both sides.

    Repeated identifiers go before the shuffle; one that no record has is the verdicts' own.
    """
    def side(df: DataFrame, known: bool) -> DataFrame:
        return df.select("tenant", "category", identity(F.col("identifier")).alias("_id"),
                         F.lit(known).alias("_known"))

    both = side(verdicts, False).unionByName(side(shaped, True).where(F.col("_id") != ""))
    return both.groupBy("tenant", "category", "_id").agg(F.bool_or("_known").alias("_known")).where(
        ~F.col("_known")).select("tenant").distinct()


# --- address corrections: order matters, tier rules -> catch-all -> guesses --------------------

def _warn(df: DataFrame, hit: Column, text: Column) -> DataFrame:
    if "warnings" not in df.columns:
        df = df.withColumn("warnings", _no_warnings())
    return df.withColumn(
        "warnings",
        F.when(hit, F.array_append("warnings", text)).otherwise(F.col("warnings")),
    )


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def enforce_tier_rules(df: DataFrame) -> DataFrame:
    """'confirmed' needs a deliverable status, 'likely' a confidence above zero."""
    zero = F.coalesce("confidence", F.lit(0.0)) == 0
    deliverable = F.coalesce(F.col("validation_status") == "deliverable", F.lit(False))
    over = F.coalesce((F.col("tier") == "confirmed") & ~deliverable, F.lit(False))
    weak = F.coalesce((F.col("tier") == "likely") & zero, F.lit(False))
    new = F.when(over, F.when(zero, "speculative").otherwise("likely")).when(weak, "speculative")
    warned = _warn(df, over | weak, F.when(over, F.format_string(
        OVERRATED_WARNING, _shown("email"), new, _shown("validation_status"),
    )).otherwise(F.format_string(UNPROVEN_WARNING, _shown("email"))))
    return warned.withColumn("tier", F.coalesce(new, F.col("tier")))


def enforce_catch_all(df: DataFrame) -> DataFrame:
    """Addresses at a catch-all domain are flagged and speculative, excluded ones too."""
    hit = F.coalesce(F.col("validation_status") == CATCH_ALL_STATUS, F.lit(False))
    moved = hit & ~F.coalesce(F.col("tier") == "speculative", F.lit(False))
    warned = _warn(df, moved, F.format_string(
        CATCH_ALL_WARNING, _shown("email"), _shown("tier")))
    return warned.withColumn("catchall_unverifiable", hit).withColumn(
        "tier", F.when(hit, "speculative").otherwise(F.col("tier"))
    )


def reconcile_guesses(df: DataFrame, markers=GUESS_SOURCES) -> DataFrame:
    """Kept addresses that nothing but guessing supports become excluded, with a note."""
    hit = (
        F.col("keep")
        & F.coalesce(F.col("tier").isin("speculative", "noise"), F.lit(False))
        & (F.coalesce("confidence", F.lit(0.0)) == 0)
        & guess_only(F.col("sources"), markers)
    )
    listed = F.concat(F.lit("['"), F.array_join("sources", "', '"), F.lit("']"))
    addition = F.format_string(RECONCILED_NOTE, _shown("tier"), listed)
    warned = _warn(df, hit, F.concat(
        F.lit("[emails] "), addition, F.lit(" ("), _shown("email"), F.lit(")")))
    return warned.withColumn(
        "note", F.when(hit, F.concat_ws(" ", F.nullif(F.col("note"), F.lit("")), addition))
        .otherwise(F.col("note"))
    ).withColumn("keep", F.col("keep") & ~hit)


def filter_addresses(addresses: DataFrame, verdicts: DataFrame, markers=GUESS_SOURCES) -> DataFrame:
    """The whole address chain: structural exclusion, verdicts, three corrections."""
    infra = infrastructure_address(F.col("email"))
    judged = attach_verdicts(addresses, verdicts, "email")
    structural = judged.withColumn("_i", infra).withColumn(
        "keep", F.when(F.col("_i"), False).otherwise(F.col("keep"))
    ).withColumn(
        "tier", F.when(F.col("_i"), "noise").otherwise(F.col("tier"))
    ).withColumn(
        "note", F.when(F.col("_i"), INFRASTRUCTURE_NOTE).otherwise(F.col("note"))
    ).drop("_i")
    return reconcile_guesses(enforce_catch_all(enforce_tier_rules(structural)), markers)


def address_warnings(judged: DataFrame) -> DataFrame:
    """(tenant, category, identifier, warning): one row per correction of an address."""
    return judged.select(
        "tenant", F.lit("emails").alias("category"), F.col("email").alias("identifier"),
        F.explode("warnings").alias("warning"))


def exclude_infrastructure(addresses: DataFrame) -> DataFrame:
    """Addresses at infrastructure hosts with the fixed verdict, the others without one."""
    infra = infrastructure_address(F.col("email"))
    return addresses.select(
        *addresses.columns,
        F.when(infra, False).alias("keep"),
        F.when(infra, "noise").alias("tier"),
        F.when(infra, INFRASTRUCTURE_NOTE).alias("note"),
    )


# --- the other chains -------------------------------------------------------------------------

def person_identifier() -> Column:
    return F.coalesce(first_truthy(F.col("public_identifier"), F.col("name")), F.lit(""))


def target_key() -> Column:
    return F.concat(F.col("target"), F.lit("||"), F.col("target_type"))


def filter_people(people: DataFrame, verdicts: DataFrame, fields: list[str]) -> DataFrame:
    """The tier decides: rejects are excluded, all others kept whatever the verdict says."""
    with_id = people.withColumn("identifier", person_identifier())
    reject = F.col("employee_tier") == "reject"
    judged = attach_verdicts(with_id, verdicts, "identifier", fields)
    out = judged.withColumn("keep", ~reject).withColumn("tier", F.col("employee_tier"))
    out = out.withColumn("note", F.when(
        reject, F.coalesce(F.nullif(F.col("tier_reason"), F.lit("")), F.lit(REJECT_NOTE))
    ).otherwise(F.col("note")))
    for f in fields:
        if f not in ("tier", "note"):
            out = out.withColumn(f, F.when(~reject, F.col(f)))
    return out


def filter_mentions(targets: DataFrame, verdicts: DataFrame, count: str, fields=("note",)) -> DataFrame:
    """Targets without mentions are kept with a fixed note, the others judged by target key."""
    keyed = targets.withColumn("target_key", target_key())
    none = F.col(count) == 0
    judged = attach_verdicts(keyed, verdicts, "target_key", list(fields))
    out = judged.withColumn("keep", none | F.col("keep"))
    for f in fields:
        fixed = F.lit(NO_MENTIONS_NOTE) if f == "note" else F.lit(None)
        out = out.withColumn(f, F.when(none, fixed).otherwise(F.col(f)))
    return out


def document_outcome(documents: DataFrame) -> DataFrame:
    """error, summary, usability, mentions_target_company of documents with supplied verdicts.

    Reasons are tried in order: missing file, unsupported type, extraction error, blank text,
    failed verdict.  Out-of-range values are cleaned.
    """
    ext = F.lower(F.regexp_extract("filename", r"^\.*[^.].*(\.[^.]*)$", 1))
    error = (
        F.when(~F.coalesce("file_exists", F.lit(False)), MISSING_FILE_ERROR)
        .when(~ext.isin(*TEXT_FILE_TYPES), F.concat(F.lit(UNSUPPORTED_ERROR), ext))
        .when(F.col("extract_error") != "", F.col("extract_error"))
        .when(strip_space(F.coalesce("text", F.lit(""))) == "", EMPTY_TEXT_ERROR)
        .when(F.col("verdict_error").isNotNull(),
              F.concat(F.lit("LLM summarization failed: "), F.col("verdict_error")))
    )
    ok = F.col("error").isNull()
    return (
        documents.withColumn("error", error)
        .withColumn("summary", F.when(ok, F.col("verdict_summary")))
        .withColumn("usability", F.when(
            ok & F.coalesce(F.col("verdict_usability").isin(*USABILITY_LEVELS), F.lit(False)),
            F.col("verdict_usability")).otherwise("unusable"))
        .withColumn("mentions_target_company", F.when(ok, F.col("verdict_mentions")))
        .drop("extract_error", "verdict_error", "verdict_summary", "verdict_usability",
              "verdict_mentions")
    )


def input_identifiers(parts: dict[str, DataFrame], identifiers: dict[str, Column]) -> DataFrame:
    """(tenant, category, identifier) of every record given, before anything is judged."""
    out = None
    for category, df in parts.items():
        rows = df.select("tenant", F.lit(category).alias("category"),
                         identifiers[category].cast("string").alias("identifier"))
        out = rows if out is None else out.unionByName(rows)
    return out


def output_shape(parts: dict[str, DataFrame], identifiers: dict[str, str]) -> DataFrame:
    """(tenant, category, identifier, keep, note, tier) over all categories given.

    One table with a ``keep`` flag in place of two lists per category; a category that is not
    given simply has no rows, the columns are always the same.
    """
    out = None
    for category in CATEGORIES:
        if category not in parts:
            continue
        df = parts[category]
        cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                for c in ("note", "tier")]
        rows = df.select(
            "tenant", F.lit(category).alias("category"),
            F.col(identifiers[category]).cast("string").alias("identifier"), "keep", *cols,
        )
        out = rows if out is None else out.unionByName(rows)
    return out
