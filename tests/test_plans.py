"""What registered queries must not do twice: plans and written intermediates."""

import pytest

from rollcall.operators import verdicts
from rollcall.plans import queries_addresses, queries_review, views
from rollcall.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def names(monkeypatch):
    """Names of the tables that the review queries write."""
    found, real = [], queries_review.written

    def written(df, name):
        found.append(name)
        return real(df, name)

    monkeypatch.setattr(queries_review, "written", written)
    return found


def test_verdicts_of_strangers_share_one_scan(spark):
    plan = queries_addresses._verdicts(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 3          # orders, customers, parts


@pytest.mark.parametrize("keep, other", [("true", False), ("cast(null as boolean)", None)])
def test_strangers_say_the_opposite_later(spark, keep, other):
    given = spark.sql(f"select 'a' tenant, 'x' identifier, {keep} keep, 7L seq")
    own, strange = sorted(map(tuple, views.with_strangers(given).collect()), key=lambda r: r[3])
    assert own == ("a", "x", True if other is False else None, 7)
    assert strange == ("elsewhere", "x", other, 5_000_000_007)


def test_audit_writes_only_what_it_reads_twice(spark, names):
    QUERIES["exclusion_counts"](spark, SF_DIR)
    assert sorted(names) == ["address-verdicts", "filtered", "shaped"]


def test_grounding_judges_nothing(spark, names):
    """It reads identifiers alone: no record is classified, nothing is written."""
    df = QUERIES["grounding_warnings"](spark, SF_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert names == [] and "stagiaire" not in plan


def test_counts_need_no_reasons(spark, monkeypatch):
    """The records are written without reasons, so people meet no verdicts; nothing is scored to be kept."""
    shaped, real = [], queries_review.written

    def written(df, name):
        if name == "shaped":
            shaped.append(df)
        return real(df, name)

    monkeypatch.setattr(queries_review, "written", written)
    monkeypatch.setattr(verdicts, "written", lambda df, name: pytest.fail(name))
    counts = QUERIES["exclusion_counts"](spark, SF_DIR)
    plan = shaped[0]._jdf.queryExecution().optimizedPlan().toString()
    assert shaped[0].columns == ["tenant", "category", "identifier", "keep"] and "p-" not in plan
    assert counts.columns == ["tenant", "measure", "value"]


def test_tenants_of_ungrounded_verdicts(spark):
    shaped = spark.sql("""select * from values ('a', 'emails', ' X '), ('b', 'emails', 'x'), ('c', 'emails', ''),
        ('d', 'emails', 'y'), ('e', 'emails', null), (null, 'emails', 'z') t(tenant, category, identifier)""")
    given = spark.sql("""select * from values ('a', 'emails', 'x'), ('a', 'emails', 'X'), ('b', 'domains', 'x'),
        ('c', 'emails', ' '), ('d', 'emails', 'x'), ('d', 'emails', 'x'), ('e', 'emails', null),
        ('f', 'emails', 'x') t(tenant, category, identifier)""")
    told = {r.tenant for r in verdicts.grounding_warnings(given, shaped).collect()}
    assert sorted(r.tenant for r in verdicts.ungrounded_tenants(given, shaped).collect()) == sorted(told)
    assert told == {"b", "c", "d", "e", "f"}


@pytest.mark.parametrize("bad", [[], ["t1"], ["t0", "t1", "t2"]])
def test_failed_batches_alone(spark, bad):
    def scorer(rows):
        if set(rows["group"]) & set(bad):
            raise ValueError("no")
        return rows[["group"]].assign(keep=True)

    records = spark.range(30000).selectExpr("'t' || id % 3 tenant", "'t' || id % 3 `group`", "id div 64 batch")
    given = records, scorer, "group string, keep boolean", ["group"], ["tenant", "batch"]
    alone = sorted(map(tuple, verdicts.failed_batches(*given).collect()))
    assert len(alone) == 469 * len(bad) and all(r[2] in (16, 21, 22) and r[3] == "no" for r in alone)
    assert alone == sorted(map(tuple, verdicts.score_batches(*given)[1].collect()))
